"""Column profiles, skew and partition-key reports.

Each report is ONE aggregate pass (plus a grouped count for key-level
reports), written in place of the stored planner statistics the reference
relies on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, cols, approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """One row per column: non-null count, nulls, distinct count (exact, or
    HyperLogLog with ``approx``), min and max as DOUBLE (numeric columns)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        distinct = F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)
        aggs += [F.count(c).alias(f"_nn{i}"), distinct.alias(f"_d{i}"),
                 (F.min(c).cast("double") + F.lit(0.0)).alias(f"_mn{i}"),   # a zero without a sign
                 (F.max(c).cast("double") + F.lit(0.0)).alias(f"_mx{i}")]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', _nn{i}, _d{i}, _mn{i}, _mx{i}" for i, c in enumerate(cols))
    long = wide.select("_rows", F.expr(f"stack({len(cols)}, {pairs}) AS (column_name, non_null, n_distinct, min_value, max_value)"))
    return long.select("column_name", F.col("non_null").cast("bigint").alias("non_null"),
                       (F.col("_rows") - F.col("non_null")).cast("bigint").alias("nulls"),
                       F.col("n_distinct").cast("bigint").alias("n_distinct"), "min_value", "max_value")


def skew_report(df: DataFrame, key: str, top: int = 10) -> DataFrame:
    """The ``top`` heaviest keys with their row count, share of all rows
    and ratio to the median key's count (max / median is the skew factor
    AQE's skew split reacts to)."""
    from tidepool.operators.skew import percentile_cont
    from tidepool.session import materialize
    counts = materialize(df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")), "skew-counts")
    # exact median of the per-key counts from distributed row numbers (the
    # counts table has one row per key: not something to hold in one buffer)
    median = percentile_cont(counts, [], "cnt", 0.5, out="_median")
    totals = counts.agg(F.sum("cnt").alias("_total"), F.count(F.lit(1)).alias("n_keys"))
    stats = totals.withColumn("_one", F.lit(1)).join(median.withColumn("_one", F.lit(1)), "_one").drop("_one")
    heavy = counts.orderBy(F.col("cnt").desc(), F.col(key)).limit(top)
    # attach the one-row totals to the (at most ``top``) heavy keys
    one = F.lit(1).alias("_one")
    return heavy.select("*", one).join(F.broadcast(stats.select("*", one)), "_one").select(
        key, "cnt", (F.col("cnt") / F.col("_total")).alias("share"),
        (F.col("cnt") / F.col("_median")).alias("ratio_to_median"), "n_keys")


def partition_advice(df: DataFrame, cols, max_values: int = 10_000, min_rows_per_value: int = 1) -> DataFrame:
    """Distinct values per candidate partition column and rows per value;
    a column is advised when it has under ``max_values`` values and at
    least ``min_rows_per_value`` rows per value (the reference's rule of
    thumb: < 10,000 values, > 1 GB each)."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_distinct(c).alias(f"_d{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', _d{i}" for i, c in enumerate(cols))
    long = wide.select("_rows", F.expr(f"stack({len(cols)}, {pairs}) AS (column_name, n_values)"))
    per = F.col("_rows") / F.col("n_values")
    return long.select("column_name", F.col("n_values").cast("bigint").alias("n_values"),
                       per.alias("rows_per_value"),
                       ((F.col("n_values") < max_values) & (per >= min_rows_per_value)).alias("advised"))
