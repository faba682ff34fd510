"""CSV sources and sinks with explicit schemas.

Header-less files get their column names from the schema (positional);
the NULL token is a reader/writer option, never a post-pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

#: Rows of a compressed file, which one task reads as a whole.
ROWS_A_FILE = 1_000_000


def write_csv(df: DataFrame, path: str, header: bool = False, null_token: str | None = "null",
              mode: str = "overwrite", sep: str = ",", compression: str | None = None) -> None:
    w = (df.write.mode(mode).option("header", header).option("sep", sep)
           .option("timestampNTZFormat", NTZ_FORMAT))
    if null_token is not None:
        w = w.option("nullValue", null_token)
    if compression is not None:
        w = (w.option("compression", compression).option("zlib.compress.level", "BEST_SPEED")
              .option("maxRecordsPerFile", ROWS_A_FILE))
    w.csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = False,
             null_token: str | None = "null", sep: str = ",", fail: bool = False) -> DataFrame:
    """Scan CSV with a fixed schema; columns are taken by position when the
    file has no header. With ``fail`` the job ends at the first malformed line; else
    malformed values become NULL (``read_csv_checked`` keeps them apart)."""
    r = (spark.read.schema(schema).option("header", header).option("sep", sep)
              .option("mode", "FAILFAST" if fail else "PERMISSIVE").option("timestampNTZFormat", NTZ_FORMAT))
    if null_token is not None:
        r = r.option("nullValue", null_token)
    return r.csv(path)


CORRUPT = "_corrupt_line"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, header: bool = False,
                     null_token: str | None = "null", sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(rows, rejected lines). A line with too few or too many fields, or with a
    value that its column's type can't hold, is no row: it is returned as it
    stands, in the column ``line``. A record is one line."""
    names = schema.fieldNames()
    full = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in schema), f"{CORRUPT} string"])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "timestampNTZFormat": NTZ_FORMAT}
    if null_token is not None:
        options["nullValue"] = null_token
    lines = spark.read.text(path)
    if header:
        lines = lines.filter(F.col("value") != sep.join(names))
    r = lines.select("value", F.from_csv("value", full, options).alias("r"))
    return (r.filter(F.col("r")[CORRUPT].isNull()).select(*[F.col("r")[c].alias(c) for c in names]),
            r.filter(F.col("r")[CORRUPT].isNotNull()).select(F.col("value").alias("line")))
