"""Plain single-machine versions that the operators are held against."""

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text, n=5):
    w = words(text)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}


def jaccard_components(texts):
    """texts: list of (id, text), ids may repeat. Component of each id."""
    sets = [(i, shingle_set(t)) for i, t in texts]
    by = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for g in s:
            by[g].add(k)
    pairs = {(a, b) for v in by.values() for a in v for b in v if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a][1] & sets[b][1]) >= 80 * len(sets[a][1] | sets[b][1])]
    rows = components(range(len(sets)), links)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[rows[k]] = min(least.get(rows[k], i), i)
    return [(i, len(s), least[rows[k]]) for k, (i, s) in enumerate(sets)]


def base_scores(texts, held_out=1):
    tokens = [(i, [*words(t), None]) for i, t in texts]
    count = Counter(w for i, ws in tokens if crc(i) % 5 != held_out for w in ws)
    n, v = sum(count.values()), len(count)
    return [(i, crc(i) % 5 == held_out, len(ws), sum(w in count for w in ws), n,
             sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)) for i, ws in tokens]


PII = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for n, (kind, p) in enumerate(PII):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), n, m.end()))
    return sorted(out)


def merge_plainly(ranks, symbols):
    """BPE by definition: the earliest merge, its leftmost place first, again and again."""
    s = list(symbols)
    while len(s) > 1:
        k = min(range(len(s) - 1), key=lambda j: (ranks.get((s[j], s[j + 1]), math.inf), j))
        if (s[k], s[k + 1]) not in ranks:
            break
        s[k:k + 2] = [ranks[s[k], s[k + 1]]]
    return s
