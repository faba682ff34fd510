"""Spelling variants by permuterm rotations.

A word is marked with a terminator and turned: ``y$xc`` is the rotation of
``xcy$`` that ends with the character c, ``y$x`` a rotation of ``xy$``. Without its last
character a rotation says where c stood and all the rest. In the sorted list of
rotations, those that share this prefix lie together: words with another
character in place of c, and the word without it. One scan over the sorted groups finds
each pair of words that differ by one code point, exactly once.

A group holds one row for each character of the alphabet and one more at most.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_text, text_slices

#: Bytes of UTF-8 with only A-Z lower-cased.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
RUN = "A-Za-zÀ-ÿ"
END = "$"
#: Counted words that a task holds before it passes them on.
HELD_WORDS = 200_000


def count_words(docs: DataFrame, least_chars: int = 7, least_count: int = 2, drop_one_in: int | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n): the maximal runs of letters in whole texts, A-Z lower-cased, with ``least_chars`` code points and ``least_count`` occurrences at least.

    With ``drop_one_in`` (the spelling mistakes of a test corpus): where that number
    divides h, the crc32 of ``<id>:<run>``, a run loses its code point h % length
    before it is counted. Null ids count as the empty text, null texts have no words.
    """
    pattern = re.compile(f"[{RUN}]{{{least_chars},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for start, texts in text_slices(batch):
                for doc_id, text in zip(ids[start:start + len(texts)], texts):
                    found = Counter(pattern.findall(text.encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass")))
                    if drop_one_in:
                        begin = zlib.crc32(("" if doc_id is None else str(doc_id)).encode() + b":")
                        for word, n in found.items():
                            h = zlib.crc32(word.encode(), begin)
                            if h % drop_one_in == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1:]
                                if len(word) < least_chars:
                                    continue
                            held[word] += n
                    else:
                        held.update(found)
                    if len(held) >= HELD_WORDS:
                        yield passed_on()
        if held:
            yield passed_on()

    counted = id_text(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, edited, first, n): a row for each code point of a word, which is ``edited`` and left out of
    the rotation, and one for each rotation of the whole word (``edited`` empty).

    first: the code point isn't the same as the one before it. Leaving out any
    one of a run of equal characters gives the same word; only the run's first counts.
    """
    word, n_chars = F.col("word"), F.length("word")
    at = F.posexplode(F.transform(F.sequence(F.lit(0), n_chars), lambda i: F.struct(
        F.substr(word, i + 1, F.lit(1)).alias("c"), F.when(i > 0, F.substr(word, i, F.lit(1))).otherwise("").alias("before"),
        F.substr(word, F.lit(1), i).alias("x"), F.substr(word, i + 2).alias("rest"))))
    r = words.select("word", "n", at.alias("i", "p"))
    cut = F.struct(F.concat("p.rest", F.lit(END), "p.x").alias("prefix"), F.col("p.c").alias("edited"), (F.col("p.c") != F.col("p.before")).alias("first"))
    whole = F.struct(F.concat("p.c", "p.rest", F.lit(END), "p.x").alias("prefix"), F.lit("").alias("edited"), F.lit(False).alias("first"))
    both = F.when(F.col("i") < n_chars, F.array(cut, whole)).otherwise(F.array(whole))
    return r.select("n", F.explode(both).alias("r")).select("r.prefix", "r.edited", "r.first", "n")


def _word(prefix: str, edited: str) -> str:
    rest, x = prefix.split(END)
    return x + edited + rest


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, str, bool, int]]]:
    """The rows of each prefix that has more than one; input sorted by prefix. Prefixes with one row don't leave Arrow."""
    open_rows: list[tuple[str, str, bool, int]] = []
    for batch in batches:
        prefix = batch.column("prefix")
        if not len(prefix):
            continue
        same = pc.equal(prefix.slice(1), prefix.slice(0, len(prefix) - 1)).to_numpy(zero_copy_only=False) if len(prefix) > 1 else []
        keep = [False] * len(prefix)
        keep = pa.array(keep).to_numpy(zero_copy_only=False).copy()
        keep[0] = keep[-1] = True  # they may go on in the batches beside
        if len(prefix) > 1:
            keep[1:] |= same
            keep[:-1] |= same
        kept = batch.filter(pa.array(keep))
        for row in zip(*(kept.column(c).to_pylist() for c in ("prefix", "edited", "first", "n"))):
            if open_rows and open_rows[0][0] != row[0]:
                if len(open_rows) > 1:
                    yield open_rows
                open_rows = []
            open_rows.append(row)
    if len(open_rows) > 1:
        yield open_rows


def _sorted_rotations(words: DataFrame) -> DataFrame:
    return rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", "edited")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near): all pairs, both ways, of the distinct words of ``words`` (word, n) that differ by exactly one inserted, deleted or replaced code point.
    Words must not hold ``$``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            found = [(_word(p, a), _word(p, b)) for p, a, first_a, _ in rows for _, b, first_b, _ in rows
                     if a != b and (a and b or (first_a if a else first_b))]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], names=["word", "near"])

    return _sorted_rotations(words).mapInArrow(run, "word string, near string")


def near_summary(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best): each word of ``words``, the number of its near words and the
    commonest of them as (minus_n, word), ties by code point. Groups are summed up where they are scanned, so pairs aren't sent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, int, int, str]] = []

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                              names=["word", "n_near", "minus_n", "near"])

        for rows in _groups(batches):
            whole = next((r for r in rows if not r[1]), None)
            cut = sorted((-n, _word(p, c), first) for p, c, first, n in rows if c)
            for k, (_, word, first) in enumerate(cut):
                others = [cut[1 if k == 0 else 0][:2]] if len(cut) > 1 else []
                n_near = len(cut) - 1
                if whole and first:
                    others.append((-whole[3], _word(whole[0], "")))
                    n_near += 1
                if others:
                    out.append((word, n_near, *min(others)))
            shorter = [c for c in cut if c[2]]
            if whole and shorter:
                out.append((_word(whole[0], ""), len(shorter), *shorter[0][:2]))
            if len(out) >= 10_000:
                yield passed_on()
                out.clear()
        if out:
            yield passed_on()

    found = _sorted_rotations(words).mapInArrow(run, "word string, n_near long, minus_n long, near string")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<minus_n: long, near: string>").alias("best"))
    seen = found.select("word", F.lit(None).cast("long").alias("n"), "n_near", F.struct("minus_n", "near").alias("best"))
    return alone.unionByName(seen).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``form`` from each row of ``forms`` (word, form) ends. Each round doubles the steps
    taken, so chains of d words need log2(d) rounds; a form is more frequent than its word, so there are no circles."""
    at = cut_lineage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut_lineage(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        if not step.where("moved").limit(1).count():
            return step.drop("moved")
        at = step.drop("moved")


def group_variants(words: DataFrame, times: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``words`` (word, n; words distinct).

    A word's form is its commonest near word (ties: the smallest by code points),
    if that is at least ``times`` as frequent; root: the last word that forms lead to,
    the word itself without a form. Words without near words have n_near 0.
    An empty table gives no rows; further columns are ignored.
    """
    words = cut_lineage(words.select("word", "n"), "variant-words")
    known = cut_lineage(near_summary(words), "variant-near")
    form_n = -F.col("best.minus_n")
    has = F.coalesce(form_n >= times * F.col("n"), F.lit(False))
    judged = known.select("word", "n", "n_near", F.when(has, F.col("best.near")).alias("form"), F.when(has, form_n).alias("form_n"))
    ends = roots(judged.where("form is not null"))
    return (judged.join(ends.select("word", F.col("root").alias("end")), "word", "left")
            .select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n"))
