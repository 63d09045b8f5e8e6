"""Distinct counts, overlaps and quantiles kept as sketches by day.

A day's rows are read once and leave one row of mergeable states: HyperLogLog
(distinct counts), theta (distinct counts of unions, intersections and
differences) and KLL (quantiles).  Any span of days is then a merge of those
rows; a new day, or a day that is loaded again, replaces its own states and
reads nothing else.  The states are built-in aggregates, combined before the
shuffle; a state has a few KB whatever the day holds.

Errors (one standard error): HLL 1.04 / sqrt(2^lg_k) and theta
1 / sqrt(2^lg_k) of the count, 1.6% with the default lg_k of 12; KLL about
1.3% of the rank with its default of 200.  NULL values are not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.sources.partitions import PartitionStore

LG_K = 12


def day_sketches(df: DataFrame, day_col: str, distinct_cols, value_cols=(), lg_k: int = LG_K) -> DataFrame:
    """One row per day: ``n`` rows, ``hll_<c>`` and ``theta_<c>`` for each of
    ``distinct_cols`` (whole numbers or text), ``kll_<c>`` for each of
    ``value_cols``."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in distinct_cols:
        aggs += [F.expr(f"hll_sketch_agg(`{c}`, {lg_k})").alias(f"hll_{c}"), F.expr(f"theta_sketch_agg(`{c}`, {lg_k})").alias(f"theta_{c}")]
    aggs += [F.expr(f"kll_sketch_agg_double(CAST(`{c}` AS DOUBLE))").alias(f"kll_{c}") for c in value_cols]
    return df.groupBy(day_col).agg(*aggs)


def keep_days(store: PartitionStore, df: DataFrame, distinct_cols, value_cols=(), lg_k: int = LG_K) -> int:
    """Replace the states of the days in ``df`` (whole days), in a store
    partitioned by day."""
    return store.replace(day_sketches(df, store.partition_col, distinct_cols, value_cols, lg_k))


def _chosen(days: Column | None) -> Column:
    return F.lit(True) if days is None else days


def distinct_over(states: DataFrame, col: str, days: Column | None = None) -> DataFrame:
    """(n, n_distinct) over the days that ``days`` selects; rows exactly,
    distinct values by the merged HLL states."""
    return states.where(_chosen(days)).agg(F.sum("n").alias("n"), F.expr(f"hll_sketch_estimate(hll_union_agg(hll_{col}, true))").alias("n_distinct"))


def overlap(states: DataFrame, col: str, a: Column, b: Column) -> DataFrame:
    """(in_a, in_b, in_both, only_a): distinct values of two spans of days."""
    sides = [states.where(span).agg(F.expr(f"theta_union_agg(theta_{col})").alias(name)) for span, name in ((a, "_a"), (b, "_b"))]
    both = sides[0].withColumn("_one", F.lit(1)).join(sides[1].withColumn("_one", F.lit(1)), "_one")      # one row each
    return both.select(F.expr("theta_sketch_estimate(_a)").alias("in_a"), F.expr("theta_sketch_estimate(_b)").alias("in_b"),
                       F.expr("theta_sketch_estimate(theta_intersection(_a, _b))").alias("in_both"),
                       F.expr("theta_sketch_estimate(theta_difference(_a, _b))").alias("only_a"))


def quantiles_over(states: DataFrame, col: str, probs: dict[str, float], days: Column | None = None) -> DataFrame:
    """One column for each of ``probs``, from the merged KLL states."""
    merged = states.where(_chosen(days)).agg(F.expr(f"kll_merge_agg_double(kll_{col})").alias("_kll"))
    return merged.select(*[F.expr(f"kll_sketch_get_quantile_double(_kll, CAST({p} AS DOUBLE))").alias(name) for name, p in probs.items()])
