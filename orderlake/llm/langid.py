"""Language identification by a linear-chain conditional random field.

Words of a text are a chain of language labels. A word's emission scores come
from hashed features: prefixes, suffixes, letter n-grams, the word, and the
lexicons that hold it; transitions between the languages of neighbouring
words are learned. Forward-backward gives each word's label probabilities in
its context, so code-switched passages are labelled by themselves; a text's
language is the one with the largest expected number of words.

Only documents' languages are given, so word labels for training come in two
steps: emissions fitted to the documents' languages, then the labels that
these give with sticky transitions; emissions and transitions are then fitted
together to those.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WorkerCache, fold, id_text, text_slices

_WORD = re.compile(r"[^\W\d_]+")
SEGMENT = 512


@dataclass
class Model:
    langs: list[str]
    bits: int
    lexicon: dict[str, int] = field(default_factory=dict)  # word -> bit set of languages
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # feature x language
    transitions: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # logarithms, from x to

    @property
    def key(self) -> bytes:
        return hashlib.sha256(self.weights.tobytes() + self.transitions.tobytes() + repr(self.langs).encode()).digest()


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode's categories L), in lower case."""
    words = _WORD.findall(text.lower())
    if not "".join(words).isalpha():  # re counts numerals such as Roman ones and fractions as letters
        words = [w for own in words for w in "".join(c if c.isalpha() else " " for c in own).split()]
    return words


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray, kind: int = 0) -> np.ndarray:
    x = (x + np.uint64(kind)) * _STEP
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Features:
    """Feature numbers of a list of words, and sums over them by word.

    Of ``^word$``: letter n-grams of 1 to 3, prefixes and suffixes of 2 to 4, the
    whole, and the lexicons that hold it. Numbers are hashes of the code points, made for all words at once.
    """

    def __init__(self, words: list[str], model: Model):
        n = len(words)
        marked = "".join([f"^{w}$" for w in words])
        c = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        size = np.fromiter(map(len, words), dtype=np.int64, count=n) + 2
        start = np.cumsum(size) - size
        word = np.repeat(np.arange(n), size)
        at = np.arange(len(c)) - start[word]
        rest = size[word] - at
        flat, own = [_mixed(c, 1)], [word]
        run = c
        for k in (2, 3, 4):
            run = run[:len(run) - 1] * _STEP + c[k - 1:]  # k characters from each place on
            whole = rest[:len(run)] >= k
            if k < 4:
                flat.append(_mixed(run[whole], k))
                own.append(word[:len(run)][whole])
            long = size >= k
            for kind, place in ((10 + k, start), (20 + k, start + size - k)):
                flat.append(_mixed(run[place[long]], kind))
                own.append(np.flatnonzero(long))
        power = np.multiply.accumulate(np.full(int(size.max(initial=1)), _STEP)) if n else np.zeros(0, np.uint64)
        if n:
            flat.append(_mixed(np.add.reduceat(_mixed(c, 5) * power[at], start), 30))
            own.append(np.arange(n))
        held = [(i, k) for i, w in enumerate(words) if (bits := model.lexicon.get(w)) for k in range(bits.bit_length()) if bits >> k & 1]
        flat.append(_mixed(np.array([k for _, k in held], dtype=np.uint64), 40))
        own.append(np.array([i for i, _ in held], dtype=np.int64))
        self.n, self.word = n, np.concatenate(own)
        self.flat = (np.concatenate(flat) & np.uint64((1 << model.bits) - 1)).astype(np.int64)
        self.scale = 1 / np.sqrt(np.maximum(np.bincount(self.word, minlength=n), 1))[:, None]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        x = weights[self.flat]
        return np.stack([np.bincount(self.word, weights=x[:, k], minlength=self.n) for k in range(x.shape[1])], axis=1) * self.scale

    def gradient(self, g: np.ndarray, n: int) -> np.ndarray:
        g = (g * self.scale)[self.word]
        return np.stack([np.bincount(self.flat, weights=g[:, k], minlength=n) for k in range(g.shape[1])], axis=1)


def forward_backward(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Label probabilities of every word of several chains.

    e: emission scores of all words, chain after chain; trans: transition
    scores; before a chain all labels are alike. Exact for any length: chains
    are cut into segments, whose transfer matrices carry both passes over the
    cuts, so thousands of segments go step by step together. With ``pairs``,
    also the expected number of each transition inside chains.
    """
    k = trans.shape[0]
    n = lengths[lengths > 0]
    if not len(n):
        return np.zeros((0, k)), np.zeros((k, k)) if pairs else None
    p = np.exp(e - e.max(axis=1, keepdims=True))
    t = np.exp(trans - trans.max()).astype(p.dtype)
    parts = -(-n // SEGMENT)
    chain = np.repeat(np.arange(len(n)), parts)
    nth = np.arange(len(chain)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.repeat(np.cumsum(n) - n, parts) + nth * SEGMENT
    size = np.minimum(SEGMENT, np.repeat(n, parts) - nth * SEGMENT)
    order = np.argsort(-size, kind="stable")
    begin, size, chain, nth = begin[order], size[order], chain[order], nth[order]
    active = np.searchsorted(-size, -np.arange(int(size[0])) - 1, side="right")  # segments with a word at each step
    m = len(size)
    into, out = np.full((m, k), 1.0 / k, dtype=p.dtype), np.full((m, k), 1.0, dtype=p.dtype)
    most = int(parts.max())
    if most > 1:
        cut = np.flatnonzero(parts[chain] > 1)  # segments of chains that have several
        place, number = begin[cut], np.full(m, -1, dtype=np.int64)
        number[cut] = np.arange(len(cut))
        mat = np.tile(np.eye(k, dtype=p.dtype), (len(cut), 1, 1))
        for s in range(int(size[cut[0]])):
            a = int(np.searchsorted(-size[cut], -s - 1, side="right"))
            x = (mat[:a].reshape(-1, k) @ t).reshape(-1, k, k) * p[place[:a] + s][:, None, :]
            mat[:a] = x / x.reshape(a, -1).max(axis=1)[:, None, None]
        at = np.full((len(n), most), -1, dtype=np.int64)
        at[chain, nth] = np.arange(m)
        for j in range(1, most):
            h = at[:, j] >= 0
            v = np.einsum("ik,ikl->il", into[at[h, j - 1]], mat[number[at[h, j - 1]]])
            into[at[h, j]] = v / v.sum(axis=1, keepdims=True)
            h = at[:, most - j] >= 0
            v = np.einsum("ikl,il->ik", mat[number[at[h, most - j]]], out[at[h, most - j]])
            out[at[h, most - j - 1]] = v / v.max(axis=1, keepdims=True)
    alpha = np.empty_like(p)
    v = into
    for s, a in enumerate(active):
        x = (v[:a] @ t) * p[begin[:a] + s]
        v[:a] = x / x.sum(axis=1, keepdims=True)
        alpha[begin[:a] + s] = v[:a]
    post = np.empty_like(p)
    edges = np.zeros((k, k)) if pairs else None
    b = out
    for s in range(len(active) - 1, -1, -1):
        a = active[s]
        row = begin[:a] + s
        x = alpha[row] * b[:a]
        post[row] = x / x.sum(axis=1, keepdims=True)
        y = p[row] * b[:a]
        if pairs:
            inner = (nth[:a] > 0) | (s > 0)
            before = alpha[row[inner] - 1]
            z = before[:, :, None] * t[None] * y[inner][:, None, :]
            edges += (z / z.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        y = y @ t.T
        b[:a] = y / y.max(axis=1, keepdims=True)
    return post, edges


def fit(chains: list[tuple[int, list[str]]], langs: list[str], bits: int = 16, lexicon_words: int = 2_000, epochs: int = 4, batch: int = 512, rate: float = 0.15) -> Model:
    """A model from (number of the document's language, words) chains."""
    model, k = Model(langs, bits), len(langs)
    by_lang = [Counter() for _ in langs]
    for y, words in chains:
        by_lang[y].update(words)
    for y, c in enumerate(by_lang):
        for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:lexicon_words]:
            if n >= 5 and n >= 0.8 * sum(o[w] for o in by_lang):
                model.lexicon[w] = model.lexicon.get(w, 0) | 1 << y
    vocab = sorted({w for _, words in chains for w in words})
    number = {w: i for i, w in enumerate(vocab)}
    feats = Features(vocab, model)
    size = 1 << bits
    rng = np.random.default_rng(7)
    ids = [np.array([number[w] for w in words]) for _, words in chains]
    # 1: emissions of words by themselves, to the documents' languages, each language weighing alike
    share = np.zeros((len(vocab), k))
    for y, _ in enumerate(langs):
        for i in (ids[j] for j in range(len(ids)) if chains[j][0] == y):
            np.add.at(share[:, y], i, 1.0)
    share /= np.maximum(share.sum(axis=0), 1)
    total = share.sum(axis=1, keepdims=True)
    w, g2 = np.zeros((size, k)), np.full((size, k), 1e-8)
    for _ in range(30):
        s = feats.scores(w)
        q = np.exp(s - s.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        g = feats.gradient((share - total * q) * len(vocab) / k, size) - 1e-3 * w
        g2 += g * g
        w += 4 * rate * g / np.sqrt(g2)
    # 2: the labels these give to words in their context
    sticky = np.log(np.full((k, k), 0.05 / max(k - 1, 1)) + np.eye(k) * (0.95 - 0.05 / max(k - 1, 1)))
    lengths = np.array([len(i) for i in ids])
    flat = np.concatenate(ids)
    gold = forward_backward(feats.scores(w)[flat], lengths, sticky)[0].argmax(axis=1)
    starts = np.cumsum(lengths) - lengths
    # 3: emissions and transitions together, by the gradient of the conditional likelihood
    trans, t2 = sticky.copy(), np.full((k, k), 1e-8)
    g2 = np.full((size, k), 1e-8)
    for _ in range(epochs):
        turn = rng.permutation(len(ids))
        for c in range(0, len(turn), batch):
            part = np.sort(turn[c:c + batch])
            at = np.concatenate([np.arange(starts[j], starts[j] + lengths[j]) for j in part])
            words, y = flat[at], gold[at]
            post, edges = forward_backward(feats.scores(w)[words], lengths[part], trans, pairs=True)
            d = -post
            d[np.arange(len(y)), y] += 1
            by_word = np.stack([np.bincount(words, weights=d[:, j], minlength=len(vocab)) for j in range(k)], axis=1)
            g = feats.gradient(by_word, size) / len(part) - 1e-4 * w
            g2 += g * g
            w += rate * g / np.sqrt(g2)
            inner = np.ones(len(at), dtype=bool)
            inner[np.cumsum(lengths[part]) - lengths[part]] = False
            seen = np.bincount(y[np.flatnonzero(inner) - 1] * k + y[inner], minlength=k * k).reshape(k, k)
            g = (seen - edges) / len(part) - 1e-3 * (trans - sticky)
            t2 += g * g
            trans += rate * g / np.sqrt(t2)
    model.weights, model.transitions = w.astype(np.float32), trans
    return model


def train(docs: DataFrame, held_out_fold: int = 2, folds: int = 4, docs_per_lang: int = 400, chains_per_doc: int = 4, chain_words: int = 40) -> Model | None:
    """A model from documents whose crc32(id) modulo ``folds`` isn't ``held_out_fold``.

    A bounded sample: of each language the first ``docs_per_lang`` documents in
    the order of a hash of the id; of each up to ``chains_per_doc`` runs of
    ``chain_words`` words, spread evenly over the whole text. None without any.
    """
    own = docs.where("lang is not null and doc_id is not null and text is not null").where(fold(F.col("doc_id"), folds) != held_out_fold)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = own.select("doc_id", "lang").withColumn("r", rank).where(F.col("r") <= docs_per_lang).select("doc_id").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for start, texts in text_slices(batch):
                lang, chain = [], []
                for y, t in zip(langs[start:], texts):
                    words = words_of(t)
                    n = -(-len(words) // chain_words)
                    for c in sorted({int((j + 0.5) * n / chains_per_doc) for j in range(chains_per_doc)} if n > chains_per_doc else range(n)):
                        lang.append(y)
                        chain.append(" ".join(words[c * chain_words:(c + 1) * chain_words]))
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(chain, pa.string())], names=["lang", "chain"])

    # at most docs_per_lang ids a language are broadcast, and so many documents' chains come back
    rows = own.join(F.broadcast(chosen), "doc_id", "left_semi").select("lang", "text").mapInArrow(run, "lang string, chain string").collect()
    rows = sorted((r["lang"], r["chain"]) for r in rows)
    langs = sorted({y for y, _ in rows})
    return fit([(langs.index(y), c.split(" ")) for y, c in rows], langs) if rows else None


class Labeller:
    """Emission scores of words, with a bounded cache."""

    def __init__(self, model: Model, cache_words: int = 300_000):
        self.model, self.cache_words = model, cache_words
        self.number: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.langs)), dtype=np.float32)

    def emissions(self, chains: list[list[str]]) -> np.ndarray:
        if len(self.number) > self.cache_words:
            self.number, self.scores = {}, self.scores[:0]
        new = sorted({w for c in chains for w in c}.difference(self.number))
        for j in range(0, len(new), 20_000):
            part = new[j:j + 20_000]
            self.scores = np.concatenate([self.scores, Features(part, self.model).scores(self.model.weights).astype(np.float32)])
            self.number.update(zip(part, range(len(self.number), len(self.number) + len(part))))
        get = self.number.__getitem__
        at = np.fromiter((i for c in chains for i in map(get, c)), dtype=np.int64)
        return self.scores[at]

    def label(self, texts: list[str]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """Words of each text, their number, and label probabilities of all words."""
        chains = [words_of(t) for t in texts]
        lengths = np.array([len(c) for c in chains], dtype=np.int64)
        return chains, lengths, forward_backward(self.emissions(chains), lengths, self.model.transitions)[0]


_LABELLERS = WorkerCache()


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches), a row per row of ``docs``.

    lang_pred: the language with most expected words (ties: the first by name);
    score: its share of the words; n_switches: neighbouring words whose likeliest
    labels differ. Null and empty texts and texts without a letter are `und` with
    score 0, as is everything without a model. Repeated rows score alike; an empty
    table gives no rows; further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        tool = None if m is None else _LABELLERS.get_or_make(m.key, lambda: Labeller(m))
        for batch in batches:
            for start, texts in text_slices(batch):
                pred, score = np.array(["und"] * len(texts), dtype=object), np.zeros(len(texts))
                count, switches = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
                if tool is not None:
                    _, count, post = tool.label(texts)
                    has = count > 0
                    if has.any():
                        first = np.cumsum(count[has]) - count[has]
                        share = np.add.reduceat(post, first, axis=0, dtype=np.float64) / count[has][:, None]
                        best = share.argmax(axis=1)
                        pred[has] = np.array(m.langs, dtype=object)[best]
                        score[has] = np.minimum(share[np.arange(len(best)), best], 1.0)
                        top = post.argmax(axis=1)
                        turn = np.r_[False, top[1:] != top[:-1]]
                        turn[first] = False
                        switches[has] = np.add.reduceat(turn.astype(np.int64), first)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(texts)), pa.array(pred, pa.string()), pa.array(score),
                                                  pa.array(count), pa.array(switches)], names=["doc_id", "lang_pred", "score", "n_words", "n_switches"])

    t = id_text(docs, id_col, text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, n_words long, n_switches long")
