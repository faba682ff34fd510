"""State audits and constraint checks (M1, Q1-Q6).

Every audit is a global or small grouped aggregate with partial aggregation
in each task; results are a handful of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schema import BASE_SCHEMAS, FOREIGN_KEYS, LENGTH_LIMITS, PRIMARY_KEYS

# The fifteen audited totals, in the order they are reported.
DB_STATE_METRICS = [
    "sum_w_ytd", "sum_d_ytd", "sum_d_next_o_id", "sum_c_balance", "sum_c_ytd_payment",
    "sum_c_payment_cnt", "sum_c_delivery_cnt", "max_o_id", "sum_o_ol_cnt", "sum_ol_amount",
    "sum_ol_quantity", "sum_s_quantity", "sum_s_ytd", "sum_s_order_cnt", "sum_s_remote_cnt",
]


_INT_METRICS = {"sum_d_next_o_id", "sum_c_payment_cnt", "sum_c_delivery_cnt", "max_o_id",
                "sum_o_ol_cnt", "sum_ol_quantity", "sum_s_quantity", "sum_s_order_cnt",
                "sum_s_remote_cnt"}


def _metric_rows(df: DataFrame, aggs: dict) -> DataFrame:
    """One global aggregate per table, returned as (metric, value) rows."""
    d2 = "decimal(38,2)"
    wide = df.agg(*[e.cast(d2).alias(m) for m, e in aggs.items()])
    return wide.unpivot([], list(aggs), "metric", "value")


def db_state_long(warehouses: DataFrame, districts: DataFrame, customers: DataFrame,
                  orders: DataFrame, order_lines: DataFrame, stocks: DataFrame) -> DataFrame:
    """The fifteen totals of a database state as (line, metric, value) rows
    (A1, A2, Q6, C13). Six global aggregates, each combined map-side."""
    parts = [
        _metric_rows(warehouses, {"sum_w_ytd": F.sum("w_ytd")}),
        _metric_rows(districts, {"sum_d_ytd": F.sum("d_ytd"), "sum_d_next_o_id": F.sum("d_next_o_id")}),
        _metric_rows(customers, {"sum_c_balance": F.sum("c_balance"),
                                 "sum_c_ytd_payment": F.sum("c_ytd_payment"),
                                 "sum_c_payment_cnt": F.sum("c_payment_cnt"),
                                 "sum_c_delivery_cnt": F.sum("c_delivery_cnt")}),
        _metric_rows(orders, {"max_o_id": F.max("o_id"), "sum_o_ol_cnt": F.sum("o_ol_cnt")}),
        _metric_rows(order_lines, {"sum_ol_amount": F.sum("ol_amount"),
                                   "sum_ol_quantity": F.sum("ol_quantity")}),
        _metric_rows(stocks, {"sum_s_quantity": F.sum("s_quantity"), "sum_s_ytd": F.sum("s_ytd"),
                              "sum_s_order_cnt": F.sum("s_order_cnt"),
                              "sum_s_remote_cnt": F.sum("s_remote_cnt")}),
    ]
    long = reduce(DataFrame.unionByName, parts)
    order = F.create_map(*[x for i, m in enumerate(DB_STATE_METRICS) for x in (F.lit(m), F.lit(i + 1))])
    return long.select(order[F.col("metric")].cast("int").alias("line"), "metric", "value")


def db_state(*tables: DataFrame) -> DataFrame:
    """The fifteen totals as one row: the long form pivoted on the metric."""
    long = db_state_long(*tables)
    wide = long.groupBy().pivot("metric", DB_STATE_METRICS).agg(F.first("value"))
    return wide.select(*[F.col(m).cast("long" if m in _INT_METRICS else "decimal(38,2)").alias(m)
                         for m in DB_STATE_METRICS])


def audit_primary_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and duplicated key values per table (Q1)."""
    parts = []
    for name, keys in PRIMARY_KEYS.items():
        g = tables[name].groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        parts.append(g.agg(F.lit(name).alias("table_name"),
                           F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
                           F.count(F.when(F.col("n") > 1, 1)).cast("long").alias("n_dup_keys")))
    return reduce(DataFrame.unionByName, parts)


def audit_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Child rows without a parent, per foreign key (Q2): anti joins. A key with a
    NULL in it refers to nothing and passes."""
    parts = []
    for child, ccols, parent, pcols in FOREIGN_KEYS:
        c = tables[child].select(*[F.col(a).alias(f"k{i}") for i, a in enumerate(ccols)])
        p = tables[parent].select(*[F.col(a).alias(f"k{i}") for i, a in enumerate(pcols)])
        keys = [f"k{i}" for i in range(len(ccols))]
        orphans = c.dropna("any").join(p, keys, "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).cast("long").alias("n_orphans"))
                     .select(F.lit(child).alias("child"), F.lit(",".join(ccols)).alias("child_cols"),
                             F.lit(parent).alias("parent"), "n_orphans"))
    return reduce(DataFrame.unionByName, parts)


def audit_check_carrier(orders: DataFrame) -> DataFrame:
    """CHECK (carrier between 1 and 10); NULL passes (Q3)."""
    bad = ~F.col("o_carrier_id").between(1, 10)
    return orders.agg(
        F.count(F.when(bad, 1)).cast("long").alias("n_violations"),
        F.count(F.when(F.col("o_carrier_id").isNull(), 1)).cast("long").alias("n_null_carrier"),
        F.count(F.lit(1)).cast("long").alias("n_rows"))


def audit_lengths(tables: dict[str, DataFrame]) -> DataFrame:
    """Values longer than the declared string length (Q4)."""
    parts = []
    for name, limits in LENGTH_LIMITS.items():
        aggs = [F.count(F.when(F.length(c) > n, 1)).cast("long").alias(c) for c, n in limits]
        wide = tables[name].agg(*aggs)
        stack = wide.unpivot([], [c for c, _ in limits], "column_name", "n_too_long")
        lim = F.create_map(*[x for c, n in limits for x in (F.lit(c), F.lit(n))])
        parts.append(stack.select(F.lit(name).alias("table_name"), "column_name",
                                  lim[F.col("column_name")].cast("int").alias("max_length"),
                                  "n_too_long"))
    return reduce(DataFrame.unionByName, parts)


def audit_precision(tables: dict[str, DataFrame]) -> DataFrame:
    """Decimal columns: declared precision and scale, those of the column as it is,
    and values beyond the declared range (Q4)."""
    parts = []
    for name, schema in BASE_SCHEMAS.items():
        own = {f.name: f.dataType for f in tables[name].schema}
        rules = [(f.name, f.dataType) for f in schema if f.dataType.typeName() == "decimal"]
        if not rules:
            continue
        wide = tables[name].agg(*[F.count(F.when(F.abs(F.col(c)) >= F.lit(10 ** (d.precision - d.scale)).cast("decimal(38,0)"), 1)).alias(c) for c, d in rules])
        long = wide.unpivot([], [c for c, _ in rules], "column_name", "n_out_of_range")
        says = F.create_map(*[x for c, d in rules for x in (F.lit(c), F.lit(f"{d.precision},{d.scale}"))])
        have = F.create_map(*[x for c, _ in rules for x in (F.lit(c), F.lit(f"{own[c].precision},{own[c].scale}"))])
        parts.append(long.select(F.lit(name).alias("table_name"), "column_name", says[F.col("column_name")].alias("declared"),
                                 have[F.col("column_name")].alias("actual"), F.col("n_out_of_range").cast("long").alias("n_out_of_range")))
    return reduce(DataFrame.unionByName, parts)


def row_count_reconcile(pairs: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Raw versus processed row counts."""
    parts = []
    for name, raw, processed in pairs:
        parts.append(raw.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("raw").alias("kind"), "n"))
        parts.append(processed.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("processed").alias("kind"), "n"))
    u = reduce(DataFrame.unionByName, parts)
    g = u.groupBy("table_name").agg(
        F.sum(F.when(F.col("kind") == "raw", F.col("n")).otherwise(0)).cast("long").alias("raw_rows"),
        F.sum(F.when(F.col("kind") == "processed", F.col("n")).otherwise(0)).cast("long").alias("processed_rows"))
    return g.withColumn("diff", F.col("raw_rows") - F.col("processed_rows"))
