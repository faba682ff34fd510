"""Personal data by bootstrapped contextual extraction.

Strict expressions with checks (address parts, Luhn sum, digit counts) find
seed entities. The words around them induce lexical patterns: the two words
before, the word before, the words before and after. Patterns and the
identifier-like strings they stand beside form a graph; Spark scores both
sides in turn: a pattern by its seeds and found strings against the strings it
meets that are proven to be something else, a string by the patterns it is met by. Strings that no strict expression
takes, but which patterns of high confidence stand beside, are found too.

Text is scanned once, by Arrow batches; the graph has rows only for
identifier-like strings and numbers and lives in DataFrames throughout.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import WorkerCache, id_text, text_slices

KINDS = ["email", "ip", "card", "phone"]

_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# digits are taken whole, so long runs of them cost no retries
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Identifier-like: a run of digits and separators, or something with an @.
_CANDIDATE = re.compile(r"[+(]?[0-9]++(?:[()./:\x20-]{1,3}+[0-9]++)*+|(?<![^\s\"'<>(),;|])[^\s@\"'<>(),;|]++@[^\s@\"'<>(),;|]++")
_WORD = re.compile(r"\w+")
#: Characters read on either side of a string for its context words.
CONTEXT = 80


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """An @ with the longest run of allowed characters before it and a domain after it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the strict expressions, in that order."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "") if len(m[0]) <= 40 else ""
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def form_of(s: str) -> set[int]:
    """Kinds that a string could be of at all, by its form."""
    n = sum(map(str.isdigit, s))
    out = {0} if "@" in s else set()
    if 4 <= n <= 12 and s.count(".") == 3 or s.count(":") >= 2 and n >= 4:
        out.add(1)
    if 12 <= n <= 19 and "@" not in s:
        out.add(2)
    if 7 <= n <= 15 and "@" not in s and s.count(".") != 3:
        out.add(3)
    return out


def patterns_at(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns beside a string: words in lower case, digits as 0, within its line."""
    left = text[max(0, start - CONTEXT):start].rpartition("\n")[2]
    right = text[end:end + CONTEXT].partition("\n")[0]
    lw = [re.sub("[0-9]", "0", w.lower()) for w in _WORD.findall(left)[-2:]]
    rw = [re.sub("[0-9]", "0", w.lower()) for w in _WORD.findall(right)[:1]]
    out = []
    if lw:
        out.append(f"{lw[-1]} _")
        if len(lw) == 2:
            out.append(f"{lw[0]} {lw[1]} _")
        if rw:
            out.append(f"{lw[-1]} _ {rw[0]}")
    return out


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[tuple]:
    """(start, end, kind or None, string, patterns, forms) of the seeds and the other candidates."""
    out = [(s, e, k, text[s:e].lower(), patterns_at(text, s, e), [k]) for s, k, e in base]
    if "@" in text or _DIGIT.search(text):
        taken = sorted((s, e) for s, _, e in base)
        j, upto = 0, 0
        for m in _CANDIDATE.finditer(text):
            s, e = m.span()
            while j < len(taken) and taken[j][0] < e:
                upto = max(upto, taken[j][1])
                j += 1
            if upto > s:
                continue
            if e - s <= 120:  # those of no form speak against patterns
                out.append((s, e, None, m[0].lower(), patterns_at(text, s, e), sorted(form_of(m[0]))))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, base, found): one row a
    document; found: its seeds and candidates with their patterns."""
    span = pa.struct([("start", pa.int64()), ("k", pa.int32()), ("end", pa.int64())])
    occ = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("k", pa.int32()), ("instance", pa.string()),
                     ("patterns", pa.list_(pa.string())), ("forms", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        WorkerCache.release()
        for batch in batches:
            for start, texts in text_slices(batch):
                base = [base_spans(t) for t in texts]
                found = [occurrences(t, b) for t, b in zip(texts, base)]
                count = [[sum(k == kind for _, k, _ in b) for b in base] for kind in range(len(KINDS))]
                digest = [hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in b).encode()).hexdigest() for b in base]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, len(texts)), *(pa.array(c, pa.int64()) for c in count), pa.array(digest),
                     pa.array([[dict(zip(("start", "k", "end"), x)) for x in b] for b in base], pa.list_(span)),
                     pa.array([[dict(zip(("start", "end", "k", "instance", "patterns", "forms"), x)) for x in f] for f in found], pa.list_(occ))],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "found"])

    t = id_text(docs, id_col, text_col)
    return t.mapInArrow(run, f"doc_id {t.schema['doc_id'].dataType.simpleString()}, " + "".join(f"n_{k} long, " for k in KINDS) +
                        "base_sha256 string, base array<struct<start:long,k:int,end:long>>, found array<struct<start:long,end:long,k:int,"
                        "instance:string,patterns:array<string>,forms:array<int>>>")


def score_patterns(edges: DataFrame, rounds: int, min_seeds: int, min_confidence: float) -> DataFrame:
    """(k, pattern, confidence) of the patterns that reach ``min_confidence``.

    ``edges``: distinct (pattern, instance, seed_k, forms); seed_k is null for
    candidates. A pattern needs ``min_seeds`` distinct seeds of its kind; its
    confidence is the mean score of the distinct instances it meets whose score
    is known (seeds: 1 for their own kind; 0 for seeds of other kinds and strings
    that can't be of the kind by their form; candidates count with their score
    once they have one) and one more of score 0, so that few instances can't
    prove a pattern. A candidate scores 1 - product(1 - confidence) over the good
    patterns that meet it.
    """
    spark = edges.sparkSession
    size = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("size"))
    seeds = edges.where("seed_k is not null").groupBy("pattern", F.col("seed_k").alias("k")).agg(F.countDistinct("instance").alias("seeds"))
    fit = edges.select("pattern", "instance", F.explode("forms").alias("k")).groupBy("pattern", "k").agg(F.countDistinct("instance").alias("fit"))
    # only patterns with enough seeds can ever be good
    able = cut_lineage(seeds.where(F.col("seeds") >= min_seeds).join(size, "pattern").join(fit, ["pattern", "k"])
                       .select("pattern", "k", "seeds", (F.col("size") - F.col("fit")).alias("against")), "pii-patterns")
    cand = cut_lineage(edges.where("seed_k is null").withColumn("k", F.explode("forms")).select("pattern", "instance", "k").distinct()
                       .join(able.select("pattern", "k"), ["pattern", "k"]), "pii-candidates")
    score = spark.createDataFrame([], "instance string, k int, score double")
    good = None
    for _ in range(rounds):
        gain = cand.join(score, ["instance", "k"]).groupBy("pattern", "k").agg(F.sum("score").alias("gain"))
        good = cut_lineage(able.join(gain, ["pattern", "k"], "left")
                           .withColumn("shown", F.col("seeds") + F.coalesce(F.col("gain"), F.lit(0.0)))
                           .withColumn("confidence", F.col("shown") / (F.col("shown") + F.col("against") + 1))
                           .where(F.col("confidence") >= min_confidence).select("pattern", "k", "confidence"), "pii-good")
        score = cut_lineage(cand.join(good, ["pattern", "k"]).groupBy("instance", "k")
                            .agg((1 - F.exp(F.sum(F.log(1.0 - F.least(F.col("confidence"), F.lit(0.999999)))))).alias("score")), "pii-scores")
    return good


def find_personal_data(docs: DataFrame, rounds: int = 3, min_seeds: int = 4, min_confidence: float = 0.8,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, entities), a row per row of ``docs``.

    entities: array of (start, k, end), k the number of the kind, in order; the
    strict ones and those discovered, which never overlap a strict one. Offsets
    are code points, the end exclusive. Null texts count as empty and hold
    nothing; equal confidences take the earlier kind; repeated rows are found
    alike (instances count once in every score); an empty table gives no rows;
    further columns are ignored. Strings of over 120 characters are no candidates.
    """
    rows = cut_lineage(scan(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "pii-rows")
    found = rows.where(F.size("found") > 0).select("row", F.explode("found").alias("o")).select("row", "o.*")
    edges = cut_lineage(found.select(F.explode("patterns").alias("pattern"), "instance", F.col("k").alias("seed_k"), "forms").distinct(), "pii-edges")
    good = score_patterns(edges, rounds, min_seeds, min_confidence)
    met = (found.where("k is null").select("row", "start", "end", "forms", F.explode("patterns").alias("pattern"))
           .join(good, "pattern").where(F.array_contains("forms", F.col("k"))))
    new = (met.groupBy("row", "start", "end").agg(F.max_by("k", F.struct("confidence", -F.col("k"))).alias("k"))
           .groupBy("row").agg(F.collect_list(F.struct(F.col("start"), F.col("k"), F.col("end"))).alias("more")))
    counts = [f"n_{k}" for k in KINDS]
    return (rows.drop("found").join(new, "row", "left")
            .withColumn("entities", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more"))))
            .select("doc_id", *counts, "base_sha256", "entities"))


def spans_text(entities) -> "F.Column":
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(entities, lambda e: F.concat_ws(":", F.get(names, e["k"]), e["start"].cast("string"), e["end"].cast("string"))), ",")


def mask(text, entities) -> "F.Column":
    """The text with its entities replaced by <KIND>; overlapping ones as one, named by
    the first. A null array leaves the text as it is."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    state = F.aggregate(
        entities, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda a, e: F.when(e["start"] >= a["at"], F.struct(
            e["end"].alias("at"), F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), (e["start"] - a["at"]).cast("int")), F.get(names, e["k"])).alias("out")))
        .otherwise(F.struct(F.greatest(a["at"], e["end"]).alias("at"), a["out"].alias("out"))),
        lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return F.when(entities.isNull(), text).otherwise(state)
