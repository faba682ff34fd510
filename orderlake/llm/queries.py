"""Queries of this package: each operator over its whole table with production
parameters, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chunking, flatgraph, jaccard, langid, lm, mixing, pii, ranked, sharding, toxicity, urlfilter, variants
from .common import fold, read_table

TOKENIZER = "word_bpe_49k.json"

#: Weights of the mix; what isn't named has weight 1.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2}
SOURCE_WEIGHTS: dict[str, int] = {"src0": 2}

#: Rules for the URLs of ``pages``.
URL_RULES = [urlfilter.Rule("allow", "com"), urlfilter.Rule("block", "example.com", "/en/"), urlfilter.Rule("allow", "www.example.com", "/en/"),
             urlfilter.Rule("block", "net", "/es/"), urlfilter.Rule("block", "net", "/fr/")]


def tokenizer_path() -> str:
    import public_tokenizers
    return str(public_tokenizers.path(TOKENIZER))


def domain_of_source():
    """Four domains: the number at the end of a source's name, modulo 4."""
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint)")
    return F.concat(F.lit("d"), F.pmod(number, F.lit(4)).cast("string"))


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(read_table(spark, sf_dir, "documents"))


def op2_vertical_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(read_table(spark, sf_dir, "documents"))


def op3_compression_contrast(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return (toxicity.score(docs, model)
            .select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "n_windows", "n_above"))


def op4_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), domain_of_source(), budget_num=3, budget_den=4, max_epochs=3, seed=17,
                      domain_weights=DOMAIN_WEIGHTS, lang_weights=LANG_WEIGHTS, source_weights=SOURCE_WEIGHTS)


def op5_context_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (pii.find_personal_data(read_table(spark, sf_dir, "documents"))
            .select("doc_id", *(f"n_{k}" for k in pii.KINDS), "base_sha256", pii.spans_text(F.col("entities")).alias("spans")))


def op6_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sharding.assign_shards(read_table(spark, sf_dir, "documents"), n_shards=24)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def op7_crf_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return (langid.identify(docs, langid.train(docs))
            .select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "n_words", "n_switches"))


def op8_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.compare_with_edits(read_table(spark, sf_dir, "documents"))


def op10_bpe_speculate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (bpe.encode_documents(read_table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False)
            .select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))


def op11_presence_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=20)


def op12_boosted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)


def op13_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(variants.count_words(read_table(spark, sf_dir, "documents"), drop_one_in=31))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_deleted_interpolation": op1_deleted_interpolation,
    "op2_vertical_jaccard": op2_vertical_jaccard,
    "op3_compression_contrast": op3_compression_contrast,
    "op4_hierarchical_mix": op4_hierarchical_mix,
    "op5_context_patterns": op5_context_patterns,
    "op6_bounded_ring": op6_bounded_ring,
    "op7_crf_words": op7_crf_words,
    "op8_flat_graph": op8_flat_graph,
    "op9_gear_chunks": op9_gear_chunks,
    "op10_bpe_speculate": op10_bpe_speculate,
    "op11_presence_masks": op11_presence_masks,
    "op12_boosted_urls": op12_boosted_urls,
    "op13_permuterm_variants": op13_permuterm_variants,
}


def _weights(column: str, weights: dict[str, int]) -> str:
    return "CASE " + column + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END" if weights else "1"


def _share(name: str, source: str, parent: str, child: str, keep: str) -> str:
    """The SQL of mixing.share_out."""
    return f"""
{name}_o AS (
  SELECT *, parent_budget - coalesce(sum(cap) OVER (PARTITION BY {parent} ORDER BY cap / w, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (PARTITION BY {parent} ORDER BY cap / w, {child} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest
  FROM {source}),
{name}_f AS (SELECT *, cap::DOUBLE * w_rest::DOUBLE <= rest::DOUBLE * w::DOUBLE AS is_full FROM {name}_o),
{name}_p AS (
  SELECT *, first_value(rest) OVER open_first AS o_rest, first_value(w_rest) OVER open_first AS o_w_rest FROM {name}_f
  WINDOW open_first AS (PARTITION BY {parent} ORDER BY is_full, cap / w, {child} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
{name} AS (
  SELECT {keep}, CASE WHEN is_full THEN cap ELSE least(floor(o_rest::DOUBLE * w::DOUBLE / o_w_rest::DOUBLE)::BIGINT, cap) END::BIGINT AS budget
  FROM {name}_p)"""


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce('d' || (TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 4)::VARCHAR, '(none)') AS domain,
         coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM documents),
leaf AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, (sum(n_tokens) * 3)::BIGINT AS cap, {_weights('source', SOURCE_WEIGHTS)} AS w
  FROM d GROUP BY domain, lang, source),
lang_in AS (SELECT domain, lang, sum(cap)::BIGINT AS cap, {_weights('lang', LANG_WEIGHTS)} AS w FROM leaf GROUP BY domain, lang),
dom_in AS (
  SELECT 0 AS root, domain, sum(cap)::BIGINT AS cap, {_weights('domain', DOMAIN_WEIGHTS)} AS w,
         (SELECT floor(sum(tokens) * 3 / 4)::BIGINT FROM leaf) AS parent_budget FROM lang_in GROUP BY domain),
{_share('dom', 'dom_in', 'root', 'domain', 'domain')},
lang_p_in AS (SELECT l.*, dom.budget AS parent_budget FROM lang_in l JOIN dom USING (domain)),
{_share('lang_b', 'lang_p_in', 'domain', 'lang', 'domain, lang')},
leaf_in AS (SELECT leaf.*, lang_b.budget AS parent_budget FROM leaf JOIN lang_b USING (domain, lang)),
{_share('leaf_b', 'leaf_in', 'domain, lang', 'source', 'domain, lang, source, tokens')},
e AS (SELECT domain, lang, source, tokens AS leaf_tokens, budget AS leaf_budget,
             CASE WHEN tokens > 0 THEN floor(budget / tokens)::BIGINT ELSE 0 END AS epochs FROM leaf_b),
x AS (SELECT d.*, e.leaf_tokens, e.leaf_budget, e.epochs, e.leaf_budget - e.epochs * e.leaf_tokens AS left_over,
             md5('17:' || e.epochs::VARCHAR || ':' || coalesce(d.doc_id::VARCHAR, '')) AS seeded FROM d JOIN e USING (domain, lang, source)),
y AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY seeded, doc_id, n_tokens
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM x)
SELECT doc_id, domain, lang, source, n_tokens, leaf_tokens, leaf_budget,
       CASE WHEN n_tokens = 0 THEN 0 ELSE epochs + CASE WHEN 2 * (left_over - before) >= n_tokens THEN 1 ELSE 0 END END::BIGINT AS copies
FROM y
"""

OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
stat AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
i AS (
  SELECT DISTINCT item_id, text FROM benchmark),
q AS (
  SELECT item_id, text, term, count(*)::BIGINT AS qf
  FROM (SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i)
  GROUP BY item_id, text, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, stat),
m AS (SELECT r, doc_id, 75 + (25 * len(ts)::BIGINT * n_docs) // n_terms AS m FROM d, stat WHERE len(ts) > 0),
s AS (
  SELECT q.item_id, q.text, m.r, m.doc_id, sum(q.qf * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * m.m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY q.item_id, q.text, m.r, m.doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""

OP13_SQL = r"""
WITH crc_table AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS x(i)),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, word, count(*)::BIGINT AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{7,}')) AS word FROM documents)
  GROUP BY ALL),
bytes AS (
  SELECT id, word, n, flatten(list_transform(string_split(id || ':' || word, ''),
           lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) % 64)::BIGINT] END)) AS b
  FROM runs),
hashed AS (
  SELECT word, n, xor(list_reduce([4294967295::BIGINT] || b, lambda c, x: xor(c >> 8, t[(xor(c % 256, x) + 1)::INTEGER])), 4294967295) AS h
  FROM bytes, crc_table),
edited AS (
  SELECT CASE WHEN h % 31 = 0 THEN substring(word, 1, (h % length(word))::INTEGER) || substring(word, (h % length(word))::INTEGER + 2) ELSE word END AS word, n FROM hashed),
w AS (SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, substring(word, 1, i) || '$' || substring(word, i + 2) AS without, substring(word, i + 1, 1) AS c, i = 0 OR substring(word, i + 1, 1) <> substring(word, i, 1) AS is_first
  FROM (SELECT word, n, unnest(range(length(word)))::INTEGER AS i FROM w)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.without = b.without AND a.c <> b.c
  UNION ALL SELECT a.word, w.word, w.n FROM cut a JOIN w ON replace(a.without, '$', '') = w.word WHERE a.is_first
  UNION ALL SELECT w.word, a.word, a.n FROM cut a JOIN w ON replace(a.without, '$', '') = w.word WHERE a.is_first),
best AS (SELECT word, count(*)::BIGINT AS n_near, max(near_n)::BIGINT AS top FROM near GROUP BY word),
form AS (
  SELECT w.word, w.n, coalesce(best.n_near, 0)::BIGINT AS n_near, min(near.near) AS form, CASE WHEN min(near.near) IS NOT NULL THEN best.top END AS form_n
  FROM w LEFT JOIN best USING (word) LEFT JOIN near ON near.word = w.word AND near.near_n = best.top AND best.top >= 10 * w.n
  GROUP BY w.word, w.n, best.n_near, best.top),
"steps" AS (
  WITH RECURSIVE s AS (
    SELECT word, word AS at FROM form
    UNION ALL SELECT s.word, f.form FROM s JOIN form f ON f.word = s.at WHERE f.form IS NOT NULL)
  SELECT s.word, s.at AS root FROM s JOIN form f ON f.word = s.at WHERE f.form IS NULL)
SELECT form.word, form.form, "steps".root, form.n, form.n_near, form.form_n FROM form JOIN "steps" ON "steps".word = form.word
"""

ORACLE: dict[str, str] = {"op4_hierarchical_mix": OP4_SQL, "op11_presence_masks": OP11_SQL, "op13_permuterm_variants": OP13_SQL}
