"""Aggregation, dedup and pivot operators.

All aggregates are plain ``groupBy().agg()``: Catalyst plans a partial
(map-side) aggregate before the shuffle and a final one after it, so hot
keys are combined per task before they move.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# D5 ------------------------------------------------------------------------------------
def distinct_counts(df: DataFrame, cols, keys=()) -> DataFrame:
    """Exact distinct counts of several columns in ONE aggregate.

    Spark rewrites several ``count(DISTINCT ...)`` into a single Expand +
    two-level hash aggregate, so each column's distinct values are spread
    over all tasks -- unlike ``size(collect_set(c))``, which would hold
    every distinct value of a column in one aggregation buffer."""
    aggs = [F.count_distinct(c).alias(f"n_distinct_{c}") for c in cols]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


# D6 ------------------------------------------------------------------------------------
def conditional_counts(df: DataFrame, flags: dict[str, Column], keys=()) -> DataFrame:
    """``sum(case when cond then 1 else 0 end)`` for every flag, one pass."""
    aggs = [F.sum(F.when(c, 1).otherwise(0)).cast("bigint").alias(n) for n, c in flags.items()]
    aggs.append(F.count(F.lit(1)).alias("total_rows"))
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


# D7 ------------------------------------------------------------------------------------
def top_key_counts(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Row count per key, the n largest (key breaks ties)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
              .orderBy(F.col("cnt").desc(), F.col(key).asc()).limit(n))


# D8 ------------------------------------------------------------------------------------
def dedup(df: DataFrame, keys=None) -> DataFrame:
    """Whole-row DISTINCT, or one row per key with ``keys``.  Which row of a
    key survives is undefined when the rows differ: use keep_latest then."""
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


# D9 / D10 / D11 -----------------------------------------------------------------------
def pivot(df: DataFrame, keys, pivot_col: str, aggs: list[Column], values=None) -> DataFrame:
    """Static pivot with ``values`` (case sensitive), dynamic without.

    A dynamic pivot first runs a distinct job over ``pivot_col`` and is
    capped by ``spark.sql.pivotMaxValues``; prefer static values for
    columns whose domain is known.  With several aggregates the output
    columns are named ``<value>_<alias>``."""
    g = df.groupBy(*([keys] if isinstance(keys, str) else keys))
    p = g.pivot(pivot_col, list(values)) if values is not None else g.pivot(pivot_col)
    return p.agg(*aggs)


# D12 -----------------------------------------------------------------------------------
def percentile_cont(col: str, p: float) -> Column:
    """Exact interpolated percentile (PERCENTILE_CONT(p) WITHIN GROUP) as an
    aggregate.  Its buffer holds every distinct value of a group in one
    task: use it for small groups only; ``skew.percentiles_cont`` computes
    the same values from distributed row numbers for groups of any size."""
    return F.percentile(F.col(col), F.lit(p))


# G1-G4 ---------------------------------------------------------------------------------
def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_(a: DataFrame, b: DataFrame) -> DataFrame:
    """EXCEPT (distinct).  Spark plans it as a left-anti join on all
    columns, hash partitioned, with null-safe equality."""
    return a.subtract(b)
