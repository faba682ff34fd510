"""Ranked search, URL filters and spelling variants: against plain versions and DuckDB, and on odd rows."""

import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from orderlake.llm import queries, ranked, urlfilter, variants

SF = "/root/testdata/sf0.001"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
LONG = "alpha beta gamma " * 20_000
DOCS = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "The quick-brown fox, the FOX"), (5, "The quick-brown fox, the FOX"), (6, "Élan élan ÉLAN日本"),
        (7, "the quick brown fox jumps"), (8, "beta\x00gamma 42"), (None, "quick fox"), (9, "tiontion tionton tiontion"), (10, "nothing shared")]
EXTRA = ["n", "terms", "item", "block", "rank", "score", "word", "form", "root", "best", "url_length", "fold", "label", "ruled", "host"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in EXTRA}).cache()


def duck(name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con.execute(queries.ORACLE[name])


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=str)


# --- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    own = [(i, plain_terms(t)) for i, t in docs]
    own = [(i, ts) for i, ts in own if ts]
    n_docs, n_terms = len(own), sum(len(ts) for _, ts in own)
    df = Counter(t for _, ts in own for t in set(ts))
    out = []
    for item_id, text in set(items):
        scored = []
        for i, ts in own:
            tf, m = Counter(ts), 75 + 25 * len(ts) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in plain_terms(text))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item_id, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "the quick fox"), (1, "the quick fox"), (2, "fox fox FOX"), (3, None), (4, "zzz"), (5, "Élan 日本 élan"), (6, "alpha beta gamma tiontion"),
         (None, "gamma 42"), (7, "the"), (7, "brown")]


@pytest.mark.parametrize("block_chars", [10, 200_000])
def test_search_of_odd_rows(spark, odd, block_chars):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("clash")).withColumn("score", F.lit(1))
    got = ranked.search(odd, items, k=3, block_chars=block_chars)
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == plain_search(DOCS, ITEMS, 3)


def test_search_with_many_terms_and_ties(spark, monkeypatch):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(150)]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randint(1, 60)))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=n))) for i, n in enumerate((1, 3, 30, 64, 65, 200))]
    monkeypatch.setattr(ranked, "MAX_CELLS", 100)  # many blocks of 64 documents
    got = ranked.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), k=20)
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == plain_search(docs, items, 20)


def test_search_of_empty_tables(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked.search(odd.limit(0), items).count() == 0
    assert ranked.search(odd, items.limit(0)).count() == 0


@data
@pytest.mark.parametrize("name", ["op11_presence_masks", "op13_permuterm_variants"])
def test_queries_equal_duckdb(spark, name):
    want = duck(name)
    cols = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert rows_of(got, *cols) == sorted(want.fetchall(), key=str)


# --- spelling variants


def plain_words(docs, drop_one_in=31, least=7):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if drop_one_in and h % drop_one_in == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= least:
                n[word] += 1
    return {w: c for w, c in n.items() if c >= 2}


def one_off(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def plain_variants(words, times=10):
    near = {w: [v for v in words if one_off(w, v)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


COLS = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_equal_all_pairs(spark):
    rnd = random.Random(6)
    words = {}
    for base in ("aabbccdd", "tiontion", "éèêëàâä", "ÿÿÿÿÿÿÿ", "aaaaaaaa", "a" * 3000):
        words[base] = 10 ** rnd.randint(2, 5)
        for _ in range(60):
            w = list(rnd.choice([x for x in words if abs(len(x) - len(base)) < 4]))
            k = rnd.randrange(len(w))
            rnd.choice([lambda: w.pop(k), lambda: w.insert(k, rnd.choice("abcdÿ")), lambda: w.__setitem__(k, rnd.choice("abcdé"))])()
            words.setdefault("".join(w), rnd.choice([2, 2, 20, 300]))
    words = dict(list(words.items()))
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows_of(variants.group_variants(df), *COLS) == plain_variants(words)
    assert sorted(tuple(r) for r in variants.near_pairs(df).collect()) == sorted((a, b) for a in words for b in words if one_off(a, b))


def test_words_of_odd_rows(spark, odd):
    got = variants.count_words(odd, drop_one_in=31)
    assert dict((r.word, r.n) for r in got.collect()) == plain_words(DOCS)
    assert dict((r.word, r.n) for r in variants.count_words(odd, least_chars=4).collect()) == plain_words(DOCS, drop_one_in=None, least=4)
    whole = variants.group_variants(variants.count_words(odd, least_chars=3).withColumn("form", F.lit("clash")))
    assert rows_of(whole, *COLS) == plain_variants(plain_words(DOCS, drop_one_in=None, least=3))


def test_variants_of_nothing(spark, odd):
    assert variants.group_variants(variants.count_words(odd.limit(0))).count() == 0


# --- URL filters

URLS = [(1, "https://www.Example.com/en/1?a=1&b=2#x"), (2, "https://blog.example.com/en/2"), (3, "http://other.com/fr/3/4.html"), (4, "http://a.net/es/5/"),
        (5, "http://a.net/en/5"), (6, None), (7, ""), (8, "no scheme.com/en/"), (9, "://"), (10, "http://com"), (11, "http://xcom/en/"), (12, "HTTP://A.B.NET/fr/ü?x"),
        (13, "http://net/fr/"), (14, "ftp://x.org/" + "long/" * 4000), (14, "http://a.net/es/5/"), (15, "http://example.com/en/?http://a.net/es/"), (16, "x\n://a.net/\nes/")]


def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[cut:]
    return re.sub("[A-Z]", lambda m: m[0].lower(), rest[:cut]), path[:min((path.index(c) for c in "?#" if c in path), default=len(path))]


def plain_rule(host, path):
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def plain_features(url):
    url = url or ""
    host, path = plain_host_path(url)
    labels = host.split(".")
    segments = [s for s in path.split("/") if s]
    query = re.match(r"(?s)[^?#]*\?([^#]*)", url)
    last = segments[-1] if segments else ""
    n = len(url)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(url).values()) if n else 0.0
    return {"url_length": n, "host_length": len(host), "host_depth": len(labels) if host else 0, "path_depth": len(segments),
            "digit_share": sum(c in "0123456789" for c in url) * 1000 // n if n else 0, "entropy": entropy,
            "n_params": len([p for p in query[1].split("&") if p]) if query else 0, "host_suffix": labels[-1], "domain_suffix": ".".join(labels[-2:]),
            "path_suffix": "/" if path.endswith("/") else "." + last.split(".")[-1] if "." in last else ""}


def plain_model(labelled, n_trees=12, depth=3, n_bins=16, rate=0.3, least=1.0, ridge=1.0, smoothing=10.0):
    """Boosting by definition: every split of every cut is tried on the rows themselves."""
    rows = [(plain_features(u), y, zlib.crc32((u or "").encode()) % 5) for u, y in labelled]
    n, blocked = len(rows), sum(y for _, y, _ in rows)
    prior = blocked / n

    def with_rates(f, fold=None):
        out = dict(f)
        for s in urlfilter.SUFFIXES:
            seen = [y for g, y, k in rows if g[s] == f[s] and k != fold]
            out[f"{s}_rate"] = round((sum(seen) + smoothing * prior) / (len(seen) + smoothing), 6)
        out["entropy"] = round(out["entropy"], 6)
        return out
    xs, ys = [with_rates(f, k) for f, _, k in rows], [y for _, y, _ in rows]
    cuts = {}
    for name in urlfilter.FEATURES:
        v = sorted(x[name] for x in xs)
        points = sorted({v[max(0, math.ceil(k / n_bins * n) - 1)] for k in range(n_bins + 1)})
        cuts[name] = [(a + b) / 2 for a, b in zip(points, points[1:])]
    base = math.log(prior / (1 - prior))
    margins, trees = [base] * n, []

    def build(rows_here, g, h, level):
        total = (sum(g[i] for i in rows_here), sum(h[i] for i in rows_here))
        worth = lambda a, b: (a / urlfilter.UNIT) ** 2 / (b / urlfilter.UNIT + ridge)
        best = None
        if level < depth:
            for name in urlfilter.FEATURES:
                for c in cuts[name]:
                    left = [i for i in rows_here if xs[i][name] <= c]
                    a = (sum(g[i] for i in left), sum(h[i] for i in left))
                    b = (total[0] - a[0], total[1] - a[1])
                    gain = worth(*a) + worth(*b) - worth(*total)
                    if min(a[1], b[1]) >= least * urlfilter.UNIT and gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, name, c)
        if best is None:
            return rate * (total[0] / urlfilter.UNIT) / (total[1] / urlfilter.UNIT + ridge)
        _, name, c = best
        return (name, c, build([i for i in rows_here if xs[i][name] <= c], g, h, level + 1), build([i for i in rows_here if xs[i][name] > c], g, h, level + 1))

    def value(tree, x):
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree
    for _ in range(n_trees):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        tree = build(range(n), [round((y - q) * urlfilter.UNIT) for y, q in zip(ys, p)], [round(q * (1 - q) * urlfilter.UNIT) for q in p], 0)
        if not isinstance(tree, tuple):
            break
        trees.append(tree)
        margins = [m + value(tree, x) for m, x in zip(margins, xs)]
    return lambda url: 1 / (1 + math.exp(-(base + sum(value(t, with_rates(plain_features(url))) for t in trees))))


def test_urls_of_odd_rows(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumns({c: F.lit("clash") for c in EXTRA})
    got = urlfilter.judge(pages, queries.URL_RULES, n_trees=2)
    rows = got.collect()
    want = [(i, *plain_host_path(u)) for i, u in URLS]
    assert sorted((r.page_id, r.host, r.path) for r in rows) == sorted(want)
    for r in rows:
        rule = plain_rule(r.host, r.path)
        assert r.rule == (rule and rule.text)
        assert r.verdict == (rule.verdict if rule else "block" if r.score >= 0.5 else "allow") and 0 <= r.score <= 1


def test_lexical_features(spark):
    rows = urlfilter.lexical(spark.createDataFrame(URLS, "page_id long, url string")).collect()
    for r in rows:
        want = plain_features(r.url)
        assert r.entropy == pytest.approx(want.pop("entropy"), abs=2e-6)
        assert {k: r[k] for k in want} == want


@data
def test_trees_equal_the_plain_version(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    urls = [(r.page_id, r.url) for r in pages.collect()]
    ruled = [(u, int(plain_rule(*plain_host_path(u)).verdict == "block")) for _, u in urls if plain_rule(*plain_host_path(u))]
    judged = plain_model(ruled)
    rows = queries.op12_boosted_urls(spark, SF).collect()
    assert len(rows) == len(urls)
    by_id = dict(urls)
    for r in rows:
        assert r.score == pytest.approx(judged(by_id[r.page_id]), abs=1e-6)


def test_trees_learn_what_letters_tell(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(1500):
        bad = i % 2
        digits = "".join(rnd.choices("0123456789", k=rnd.randint(8, 14) if bad else rnd.randint(0, 4)))
        rows.append((f"http://{rnd.choice(['shop', 'news', 'blog'])}.{'xyz' if bad and rnd.random() < 0.7 else 'org'}/p/{digits}{'?a=1&b=2&c=3' if bad else ''}", bad))
    train, test = rows[:1000], rows[1000:]
    model = urlfilter.train(spark.createDataFrame(train, "url string, label int"), n_trees=6)
    scored = urlfilter.score(spark.createDataFrame(test, "url string, label int"), model).collect()
    assert sum((r.score >= 0.5) == r.label for r in scored) >= 0.97 * len(test)


def test_urls_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://x.org/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urlfilter.judge(pages, queries.URL_RULES).collect()} == {"allow"}
    assert urlfilter.judge(pages.limit(0), queries.URL_RULES).count() == 0
