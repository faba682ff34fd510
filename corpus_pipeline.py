"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

1. toxicity: documents scored as toxic go.
2. near_duplicates: of each group of documents linked on word 5-grams at a
   Jaccard similarity of 0.8 or more, the one with the smallest id stays.
3. personal_data: entities are replaced by <EMAIL>, <IP>, <CARD>, <PHONE>.
4. mixture: each document is repeated as often as the target weights ask, or
   left out.
5. tokens: each text's token ids.

A stage works on all rows of its predecessor. Rows are told apart by doc_id;
where ids are null or repeat, by numbers given to the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import bpe, jaccard, mixing, pii, toxicity
from orderlake.llm.common import read_table
from orderlake.llm.queries import DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS, domain_of_source, tokenizer_path
from orderlake.session import cut_lineage

#: Up to so many rows (counted first) are broadcast to a join; beyond, both sides are shuffled.
BROADCAST_ROWS = 200_000

#: Texts that go to a Python worker at a time, unless the session says otherwise: workers of several stages share an executor.
BATCH_BYTES = "4m"

#: Words whose n-grams a Python worker holds at a time: less than op2 alone, as the heap has grown in the stages before.
BLOCK_WORDS = 400_000


def with_row_ids(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents and the name of a column that is different in every row: doc_id
    if it is, else a new column, written with the rows so that it stays the same."""
    repeated = docs.groupBy("doc_id").count().where("doc_id is null or `count` > 1").limit(1).count()
    if not repeated:
        return docs, "doc_id"
    name = f"row_{uuid.uuid4().hex}"
    return cut_lineage(docs.withColumn(name, F.monotonically_increasing_id()), "pipeline-rows"), name


def broadcast_if_small(rows: DataFrame, weight: str = "1") -> DataFrame:
    rows = cut_lineage(rows, "pipeline-side")
    return F.broadcast(rows) if (rows.agg(F.sum(F.expr(weight))).first()[0] or 0) <= BROADCAST_ROWS else rows


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.5, all columns as they are. Null and empty texts count as texts without
    contrast, rows that repeat fare alike, texts of any length are scored whole; without rows there are none. Labels come from ``labels``."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8, the row with the smallest id; rows without words all stay.
    Where ids are null or repeat, rows are numbered, so of equal rows one stays. Columns as they are; without rows there are none."""
    small_batches(spark)
    columns = docs.columns
    docs, row = with_row_ids(docs)
    groups = jaccard.jaccard_groups(docs, id_col=row, block_words=BLOCK_WORDS)
    gone = broadcast_if_small(groups.where("component_id <> doc_id").select(F.col("doc_id").alias(row)))
    return docs.join(gone, row, "left_anti").select(*columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, entities in ``text`` replaced by their kind and ``n_chars`` counted anew where something was; null
    texts stay null, texts of any length are read whole, repeated ids keep their own texts. Other columns as they are."""
    small_batches(spark)
    columns = docs.columns
    docs, row = with_row_ids(docs)
    side = f"entities_{uuid.uuid4().hex}"
    found = pii.find_personal_data(docs, id_col=row).where(F.size("entities") > 0).select(F.col("doc_id").alias(row), F.col("entities").alias(side))
    joined = docs.join(broadcast_if_small(found, f"size({side})"), row, "left").withColumn("text", pii.mask(F.col("text"), F.col(side)))
    if "n_chars" in columns:
        joined = joined.withColumn("n_chars", F.when(F.col(side).isNull(), F.col("n_chars")).otherwise(F.length("text")).cast("long"))
    return joined.select(*[F.col(f"`{c}`") for c in columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its leaf of the domain-language-source tree asks, or not at all; rows without words go, as they fill no budget.
    Null languages and sources are leaves of their own. Columns as they are; without rows there are none."""
    columns = docs.columns
    docs, row = with_row_ids(docs)
    side = f"copies_{uuid.uuid4().hex}"
    copies = (mixing.mix(docs, domain_of_source(), budget_num=3, budget_den=4, max_epochs=3, seed=17, domain_weights=DOMAIN_WEIGHTS,
                         lang_weights=LANG_WEIGHTS, source_weights=SOURCE_WEIGHTS, id_col=row)
              .where("copies > 0").select(F.col("doc_id").alias(row), F.col("copies").alias(side)))
    repeat = F.explode(F.sequence(F.lit(1).cast("long"), F.col(side))).alias(f"nth_{side}")
    return docs.join(broadcast_if_small(copies), row).select(*[F.col(f"`{c}`") for c in columns], repeat).select(*columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256 of each row; null texts count as empty, repeated rows stay."""
    small_batches(spark)
    return bpe.encode_documents(docs, tokenizer_path())


#: (name, function(spark, docs, sf_dir) -> DataFrame)
STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixture", mix_sources),
    ("tokens", encode),
]

#: No SQL for compression distances, patterns or BPE; tests hold run() against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256 of every row that the stages leave."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
