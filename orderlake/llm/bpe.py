"""BPE encoding and decoding: speculate and verify.

A word's tokens are guessed by greedy longest match and kept if every
adjacent pair is compatible, that is, if merging the two tokens' text gives
just these two. Merges only ever build on earlier ones, so pairwise
compatibility of tokens that are their own encoding implies that the whole
sequence is the encoding. Guessing and checking run over all new words of a
few megabytes of text at once with numpy; only words that fail are merged
step by step. Words seen before come from a bounded cache of the task.

The tokenizer file is read on the driver; its tables (a fixed vocabulary)
are broadcast.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WorkerCache, id_text, text_slices

SPACE = r"\t-\r \x85\xa0  -     　"
_CONTRACTION = "'(?:s|t|re|ve|m|ll|d)"
#: Lower-cased text of ASCII and the letters of Latin-1 and Latin Extended-A/B only.
_LATIN = "a-zß-öø-ɏ"
_ODD = re.compile("[^\\x00-\\x7fß-öø-ɏ]")
_QUICK = re.compile(f"[{_LATIN}]+|{_CONTRACTION}|[0-9]|[^{SPACE}{_LATIN}0-9]+")
END = 256  # added to the id of a word's last byte


@dataclass
class Tables:
    """What a vocabulary needs at run time. ids: 0-255 bytes, 256-511 bytes that
    end a word, then one id for each merge, in the order of the merges."""

    tokens: list[str]
    special: dict[str, int]
    byte_ids: np.ndarray  # id of each byte
    end_ids: np.ndarray  # id of each byte that ends a word
    left: np.ndarray
    right: np.ndarray
    merge_keys: np.ndarray
    merge_ids: np.ndarray
    edges: np.ndarray  # node * 256 + byte, sorted
    edge_to: np.ndarray
    inner: np.ndarray  # token that ends at a node inside a word, or -1
    final: np.ndarray  # token that ends at a node and the word, or -1
    sound: np.ndarray  # the token is the encoding of its own text
    letters: str  # character classes beyond ASCII as the tokenizer's library knows them
    numbers: str
    lower: dict[int, str]  # where its lower case isn't Python's


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    printable Latin-1 stands for itself, the rest from U+0100 on."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


#: No character beyond these planes is assigned but private ones and tags.
LAST = 0x40000


def as_class(codes: list[int]) -> str:
    """Sorted code points as the inside of a character class."""
    starts = [c for k, c in enumerate(codes) if not k or codes[k - 1] != c - 1]
    ends = [c for k, c in enumerate(codes) if k + 1 == len(codes) or codes[k + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


@functools.lru_cache(maxsize=4)
def characters(path: str) -> tuple[str, str, dict[int, str]]:
    """Letters, numbers and lower case of the library that a tokenizer file is made for, asked for each code point
    once a driver: its Unicode tables may be of another year than Python's."""
    import tokenizers
    t = tokenizers.Tokenizer.from_file(path)
    codes = [c for c in range(0x80, LAST) if not 0xD800 <= c <= 0xDFFF]
    cut: dict[int, list[int]] = {}
    for k in range(0, len(codes), 2_000):
        part = codes[k:k + 2_000]
        for _, (a, b) in t.pre_tokenizer.pre_tokenize_str(" ".join(f"a{chr(c) * 2}b" for c in part)):
            cut.setdefault(part[a // 5], []).append(b - a)
    normal = t.normalizer.normalize_str
    lower = {c: n for c in codes if (n := normal(chr(c))) != chr(c) and n != " " and unicodedata.normalize("NFC", chr(c)).lower() == chr(c)}
    return as_class([c for c, v in cut.items() if v == [4]]), as_class([c for c, v in cut.items() if v == [1, 1, 1, 1]]), lower


def load_tables(path: str) -> Tables:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
    letters = byte_letters()
    to_byte = {c: b for b, c in enumerate(letters)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*vocab.values(), *special.values()]) + 1
    tokens = [""] * size
    for t, i in [*vocab.items(), *special.items()]:
        tokens[i] = t
    byte_ids = np.array([vocab[c] for c in letters], dtype=np.int64)
    end_ids = np.array([vocab[c + suffix] for c in letters], dtype=np.int64)
    left, right = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
    keys, ids = [], []
    for m in spec["model"]["merges"]:
        a, b = m if isinstance(m, list) else m.split(" ")
        i = vocab[a + b]
        if not max(vocab[a], vocab[b]) < i:
            raise ValueError("merges must build on earlier merges, with ids in their order")
        left[i], right[i] = vocab[a], vocab[b]
        keys.append(vocab[a] << 32 | vocab[b])
        ids.append(i)
    if ids != sorted(ids):
        raise ValueError("ids must follow the order of the merges")
    by_key = np.argsort(keys)
    # the trie of all tokens' bytes; whether a token ends a word is kept at its node
    edge: dict[int, int] = {}
    inner, final = [-1], [-1]
    for t, i in vocab.items():
        ends = t.endswith(suffix) and len(t) > len(suffix)
        node = 0
        for c in t[: len(t) - len(suffix)] if ends else t:
            k = node << 8 | to_byte[c]
            if k not in edge:
                edge[k] = len(inner)
                inner.append(-1)
                final.append(-1)
            node = edge[k]
        (final if ends else inner)[node] = i
    e = np.array(sorted(edge), dtype=np.int64)
    t = Tables(tokens, special, byte_ids, end_ids, left, right, np.array(keys)[by_key], np.array(ids)[by_key],
               e, np.array([edge[k] for k in e.tolist()], dtype=np.int64), np.array(inner), np.array(final), np.ones(size, dtype=bool), *characters(path))
    made = np.array(ids)
    sound = compatible(t, left[made], right[made], made)
    for i, ok in zip(made.tolist(), sound.tolist()):
        t.sound[i] = ok and t.sound[left[i]] and t.sound[right[i]]
    return t


def find_merge(t: Tables, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Id that each pair merges to, or -1."""
    k = a << 32 | b
    at = np.minimum(np.searchsorted(t.merge_keys, k), len(t.merge_keys) - 1)
    return np.where(t.merge_keys[at] == k, t.merge_ids[at], -1)


def compatible(t: Tables, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
    """Whether tokens a, b side by side stay apart (until the merge ``until``).

    Goes back in time: at each moment the two tokens next to the border are
    known; undo the later one. They would have merged across the border if
    their merge comes before the one that took either of them away from it (of
    equal merges the leftmost comes first).
    """
    never = np.iinfo(np.int64).max
    ok = np.ones(len(a), dtype=bool)
    row, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
    p = np.full(len(a), never) if until is None else until.astype(np.int64)
    q = p.copy()
    while len(row):
        m = find_merge(t, x, y)
        bad = (m >= 0) & (m < p) & (m <= q)
        ok[row[bad]] = False
        undo_x = x > y
        go = ~bad & np.where(undo_x, t.left[x] >= 0, t.left[y] >= 0)
        row, x, y, p, q, undo_x = row[go], x[go], y[go], p[go], q[go], undo_x[go]
        p, q = np.where(undo_x, x, p), np.where(undo_x, q, y)
        x, y = np.where(undo_x, t.right[x], x), np.where(undo_x, y, t.left[y])
    return ok


def merge_exactly(t: Tables, words: list[bytes]) -> list[np.ndarray]:
    """Exact merging of many words side by side: in each round every word does
    its earliest merge, at all places, leftmost first."""
    never = np.iinfo(np.int64).max
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.frombuffer(b"".join(words), dtype=np.uint8)
    last = np.cumsum(lengths) - 1
    sym = t.byte_ids[flat]
    sym[last] = t.end_ids[flat[last]]
    row = np.repeat(np.arange(len(words)), lengths)
    rank = np.full(len(sym), never)  # of a symbol with the next one
    inside = np.flatnonzero(row[1:] == row[:-1])
    m = find_merge(t, sym[inside], sym[inside + 1])
    rank[inside] = np.where(m >= 0, m, never)
    out: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(words)
    while len(sym):
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        size = np.diff(np.r_[starts, len(sym)])
        least = np.minimum.reduceat(rank, starts)
        for s, n in zip(starts[least == never].tolist(), size[least == never].tolist()):
            out[row[s]] = sym[s:s + n]
        open_ = np.repeat(least < never, size)
        sym, row, rank, least = sym[open_], row[open_], rank[open_], np.repeat(least, size)[open_]
        if not len(sym):
            break
        hit = rank == least
        if (hit[1:] & hit[:-1]).any():  # a a a: every other place of a run
            at = np.arange(len(hit))
            run = at - np.maximum.accumulate(np.where(~hit, at, -1)) - 1
            hit &= run % 2 == 0
        sym = np.where(hit, rank, sym)
        keep = np.r_[True, ~hit[:-1]]
        new = hit[keep]
        sym, row, rank = sym[keep], row[keep], rank[keep]
        near = np.flatnonzero(new | np.r_[new[1:], False])  # pairs with a new symbol in them
        nxt = np.minimum(near + 1, len(sym) - 1)
        m = np.where((nxt > near) & (row[nxt] == row[near]), find_merge(t, sym[near], sym[nxt]), -1)
        rank[near] = np.where(m >= 0, m, never)
    return out


def propose(t: Tables, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Greedy longest match of all words at once: (word number, token), in order."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8).astype(np.int64)
    ends = np.cumsum(lengths)
    row, at, node = np.arange(len(words)), ends - lengths, np.zeros(len(words), dtype=np.int64)
    best, best_at = np.full(len(words), -1, dtype=np.int64), at.copy()
    rows, tokens, turns, turn = [], [], [], 0
    while len(row):
        # one byte on, if there is an edge
        k = node << 8 | flat[at]
        e = np.minimum(np.searchsorted(t.edges, k), len(t.edges) - 1)
        on = (t.edges[e] == k) & (at < ends[row])
        node = np.where(on, t.edge_to[e], node)
        at = at + on
        got = np.where(on, np.where(at == ends[row], t.final[node], t.inner[node]), -1)
        best, best_at = np.where(got >= 0, got, best), np.where(got >= 0, at, best_at)
        stop = ~on
        if stop.any():
            rows.append(row[stop])
            tokens.append(best[stop])
            turns.append(np.full(int(stop.sum()), turn))
            turn += 1
            at, node, best = np.where(stop, best_at, at), np.where(stop, 0, node), np.where(stop, -1, best)
            more = ~stop | (at < ends[row])
            row, at, node, best, best_at = row[more], at[more], node[more], best[more], best_at[more]
    r, x, n = (np.concatenate(c) if c else np.empty(0, dtype=np.int64) for c in (rows, tokens, turns))
    order = np.lexsort((n, r))
    return r[order], x[order]


class Encoder:
    """Encodes texts with a cache of words, emptied when ``cache_words`` are in it, or ``CACHE_CHARS``
    characters (a bound on memory; a word that comes again is just encoded again)."""

    CACHE_CHARS = 4_000_000

    def __init__(self, tables: Tables, cache_words: int = 400_000):
        self.t, self.cache_words, self.chars = tables, cache_words, 0
        self.cache: dict[str, bytes] = {}
        self.special = re.compile("(" + "|".join(re.escape(s) for s in sorted(tables.special, key=len, reverse=True)) + ")") if tables.special else None
        self.guessed = self.merged = 0
        self._full_pattern = None

    def words_of(self, text: str) -> list[str]:
        """The pieces that are merged on their own: lower case, NFC, no white space."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ").lower()  # each letter by itself: no final sigma
            if _ODD.search(text):
                return self._full().findall(text.translate(self.t.lower))
            return _QUICK.findall(text)
        return _QUICK.findall(text.lower())

    def _full(self):
        if self._full_pattern is None:
            letters, numbers = "a-zA-Z" + self.t.letters, "0-9" + self.t.numbers
            self._full_pattern = re.compile(f"[{letters}]+|{_CONTRACTION}|[{numbers}]|[^{SPACE}{letters}{numbers}]+")
        return self._full_pattern

    def learn(self, words: Iterable[str]) -> None:
        """Encode words that aren't in the cache, all at once."""
        t, new = self.t, list(words)
        if not new:
            return
        if len(self.cache) > self.cache_words:
            raise RuntimeError("the cache is emptied between slices only")
        self.chars += sum(map(len, new))
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        row, tok = propose(t, raw)
        fine = np.ones(len(new), dtype=bool)
        fine[row[(tok < 0) | ~t.sound[tok]]] = False
        pair = np.flatnonzero(row[1:] == row[:-1])
        pair = pair[fine[row[pair]]]
        codes, back = np.unique(tok[pair] << 32 | tok[pair + 1], return_inverse=True)
        ok = compatible(t, codes >> 32, codes & 0xFFFFFFFF)
        fine[row[pair[~ok[back]]]] = False
        starts = np.searchsorted(row, np.arange(len(new) + 1)) * 4
        data, starts = tok.astype("<u4").tobytes(), starts.tolist()
        for i, w in enumerate(new):
            self.cache[w] = data[starts[i]:starts[i + 1]]
        self.guessed += len(new)
        failed = np.flatnonzero(~fine).tolist()
        self.merged += len(failed)
        for i, ids in zip(failed, merge_exactly(t, [raw[i] for i in failed])):
            self.cache[new[i]] = ids.astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        pieces: list[list] = []
        for text in texts:
            if self.special is not None and any(s in text for s in self.t.special):
                own: list = []
                for part in self.special.split(text):
                    own.extend([self.t.special[part]] if part in self.t.special else self.words_of(part))
            else:
                own = self.words_of(text)
            pieces.append(own)
        if len(self.cache) > self.cache_words or self.chars > self.CACHE_CHARS:
            self.cache.clear()
            self.chars = 0
        seen = set()
        for own in pieces:
            seen.update(own)
        known = self.cache
        self.learn(sorted(w for w in seen if isinstance(w, str) and w not in known))
        for s in seen:
            if not isinstance(s, str):
                known[s] = np.array([s], dtype="<u4").tobytes()  # type: ignore[index]
        return [b"".join(map(known.__getitem__, own)) for own in pieces]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space, as a vocabulary without a decoder does."""
        return " ".join(map(self.t.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_ENCODERS = WorkerCache()


def encode_documents(docs: DataFrame, tokenizer_path: str, keep_ids: bool = True, cache_words: int = 400_000,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256), a row per row of ``docs``.

    ids: array of token ids (null if ``keep_ids`` is false). Null texts count as
    empty and give no tokens, as does white space; special tokens in a text are
    found as such; repeated rows give repeated rows; an empty table gives no
    rows; further columns are ignored. One scan, no shuffle.
    """
    spark = docs.sparkSession
    tables = load_tables(tokenizer_path)
    shared = spark.sparkContext.broadcast(tables)
    key = f"{tokenizer_path}:{cache_words}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _ENCODERS.get_or_make(key, lambda: Encoder(shared.value, cache_words))
        for batch in batches:
            for start, texts in text_slices(batch):
                ids = enc.encode(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(start, len(texts)),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([np.frombuffer(x, dtype="<u4").astype(np.int32) if keep_ids else None for x in ids], pa.list_(pa.int32())),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(enc.decode(x).encode("utf-8", "surrogatepass")).hexdigest() for x in ids], pa.string()),
                ], names=["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    t = id_text(docs, id_col, text_col)
    kind = t.schema["doc_id"].dataType.simpleString()
    return t.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")
