"""Window operators (E1-E20, B8) and ranked selections.

Plain ``Window`` specs cover most of the inventory.  The helpers below add
what a skew-aware user writes on top:

* ``keep_latest`` uses ``max_by`` over a struct -- an aggregate with a
  map-side partial step -- instead of sorting each key's rows, so a key that
  holds a third of the table is combined in every task before the shuffle.
* ``top_n_per_group`` filters ``rank() <= n`` right after the window;
  Spark plans that as a ``WindowGroupLimit`` whose partial step runs before
  the shuffle, so a hot group ships at most n rows per task (plus ties).
* ``top_k_dense`` (ties kept, no partition) avoids a global single-task
  window: it finds the k largest distinct values with a distributed top-k,
  ranks those k values, and joins them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

UNBOUNDED_PRECEDING = Window.unboundedPreceding
UNBOUNDED_FOLLOWING = Window.unboundedFollowing
CURRENT_ROW = Window.currentRow


def _cols(x):
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def spec(partition_by=None, order_by=None) -> WindowSpec:
    """One reusable spec; ``spec(p).orderBy(x)`` extends it."""
    parts = _cols(partition_by)
    w = Window.partitionBy(*parts) if parts else Window.partitionBy()
    orders = _cols(order_by)
    if orders:
        w = w.orderBy(*orders)
    return w


# E1-E4 ranking -------------------------------------------------------------------
def with_rankings(df: DataFrame, partition_by, order_by, n_tiles: int | None = None,
                  skew_safe: bool = False) -> DataFrame:
    """row_number, rank, dense_rank (and ntile).  ``skew_safe`` computes
    them in chunks (operators.skew) so one huge group spans many tasks."""
    if skew_safe:
        from tidepool.operators import skew
        return skew.ranked(df, _cols(partition_by), _cols(order_by), n_tiles=n_tiles)
    w = spec(partition_by, order_by)
    out = (df.withColumn("row_number", F.row_number().over(w))
             .withColumn("rank", F.rank().over(w))
             .withColumn("dense_rank", F.dense_rank().over(w)))
    if n_tiles:
        out = out.withColumn("ntile", F.ntile(n_tiles).over(w))
    return out


# B8 -------------------------------------------------------------------------------
def qualify(df: DataFrame, name: str, window_expr: Column, predicate: Column,
            keep: bool = False) -> DataFrame:
    """QUALIFY: add a window column, filter on it, optionally drop it."""
    out = df.withColumn(name, window_expr).filter(predicate)
    return out if keep else out.drop(name)


# E5 / E6 ------------------------------------------------------------------------------
def with_lag_lead(df: DataFrame, col: str, partition_by, order_by, offset: int = 1,
                  default=None, skew_safe: bool = False) -> DataFrame:
    def build(w):
        return {f"prev_{col}": F.lag(col, offset, default).over(w),
                f"next_{col}": F.lead(col, offset, default).over(w)}
    if skew_safe:
        from tidepool.operators import skew
        return skew.bounded_frame(df, _cols(partition_by), _cols(order_by), offset, offset, build)
    return df.withColumns(build(spec(partition_by, order_by)))


# E7 / E8 / E18 --------------------------------------------------------------------------
def with_first_last(df: DataFrame, col: str, partition_by, order_by) -> DataFrame:
    w = spec(partition_by, order_by)
    full = w.rowsBetween(UNBOUNDED_PRECEDING, UNBOUNDED_FOLLOWING)
    return (df.withColumn(f"first_{col}", F.first(col).over(full))
              .withColumn(f"last_{col}", F.last(col).over(full)))


def with_last_before(df: DataFrame, col: str, partition_by, order_by,
                     out: str | None = None, ignore_nulls: bool = True, skew_safe: bool = False) -> DataFrame:
    """Last (non-null) value strictly before the current row."""
    if skew_safe and ignore_nulls:
        from tidepool.operators import skew
        return skew.last_before(df, _cols(partition_by), _cols(order_by), col, out or f"last_before_{col}")
    w = spec(partition_by, order_by).rowsBetween(UNBOUNDED_PRECEDING, -1)
    return df.withColumn(out or f"last_before_{col}", F.last(col, ignorenulls=ignore_nulls).over(w))


# E9-E12, E14, E17 -------------------------------------------------------------------
def running(df: DataFrame, col: str, partition_by, order_by, out_prefix: str = "running") -> DataFrame:
    w = spec(partition_by, order_by).rowsBetween(UNBOUNDED_PRECEDING, CURRENT_ROW)
    return (df.withColumn(f"{out_prefix}_sum", F.sum(col).over(w))
              .withColumn(f"{out_prefix}_count", F.count(col).over(w))
              .withColumn(f"{out_prefix}_avg", F.avg(col).over(w)))


def rolling_rows(df: DataFrame, col: str, partition_by, order_by, preceding: int,
                 following: int = 0, out: str | None = None, skew_safe: bool = False) -> DataFrame:
    """Frame counted in rows (not days)."""
    name = out or f"avg_{col}_rows"
    if skew_safe:
        from tidepool.operators import skew
        return skew.bounded_frame(df, _cols(partition_by), _cols(order_by), preceding, following,
                                  lambda w: {name: F.avg(col).over(w.rowsBetween(-preceding, following))})
    w = spec(partition_by, order_by).rowsBetween(-preceding, following)
    return df.withColumn(name, F.avg(col).over(w))


def rolling_days(df: DataFrame, col: str, partition_by, date_col: str, days: int,
                 out: str | None = None, agg: str = "sum", skew_safe: bool = False) -> DataFrame:
    """RANGE frame of ``days`` calendar days ending at the current row's
    date; rows with the same date are peers and all included.  ``skew_safe``
    (sums and counts) splits a hot key over tasks."""
    day = F.datediff(F.col(date_col).cast("date"), F.lit("1970-01-01").cast("date"))
    name = out or f"{agg}_{col}_{days}d"
    if skew_safe:
        from tidepool.operators.range_frames import range_sums
        wanted = {"sum": {"sums": {name: col}}, "count": {"sums": {}, "counts": {name: col}}}[agg]
        return range_sums(df.withColumn("_day", day), partition_by, "_day", days - 1, 0, **wanted).drop("_day")
    w = spec(partition_by, day).rangeBetween(-(days - 1), 0)
    fn = {"sum": F.sum, "avg": F.avg, "count": F.count}[agg]
    return df.withColumn(name, fn(col).over(w))


def share_of_partition(df: DataFrame, col: str, partition_by, out: str = "pct_of_total") -> DataFrame:
    """Value / SUM(value) OVER (PARTITION BY ...) * 100."""
    w = spec(partition_by)
    return df.withColumn(out, F.col(col) / F.sum(col).over(w) * 100)


# E13 ----------------------------------------------------------------------------------------
def keep_latest(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep one row per key: the one with the largest ``order_cols`` tuple.

    ``max_by(struct(*all), struct(*order))`` is an aggregate, so each task
    sends one row per key and a hot key never lands whole in one task.  Its
    buffer holds the row, so Spark plans it as a sort aggregate before and
    after the shuffle.  The order must be total (add a unique tie-break column); ties beyond it
    would make the surviving row depend on the plan.
    """
    keys = _cols(keys)
    order_cols = _cols(order_cols)
    rest = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*keys)
                .agg(F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("_latest")))
    return picked.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest])


# E20 ----------------------------------------------------------------------------------------
def top_n_per_group(df: DataFrame, partition_by, order_by, n: int, fn=F.rank,
                    rank_col: str = "rnk") -> DataFrame:
    """Top n rows per group, ties kept with ``rank`` (or ``dense_rank`` /
    ``row_number``).  The filter sits directly on the window so the
    optimizer inserts a partial per-task group limit before the shuffle."""
    w = spec(partition_by, order_by)
    return df.withColumn(rank_col, fn().over(w)).filter(F.col(rank_col) <= n)


def top_k_dense(df: DataFrame, value_col: str, k: int, rank_col: str = "rank",
                descending: bool = True, stage: bool = True) -> DataFrame:
    """Rows whose ``value_col`` is among the k best distinct values, with
    their dense rank -- DENSE_RANK() OVER (ORDER BY v DESC) <= k without
    pulling every row through one task.

    The k distinct values are found with a distributed top-k (each task keeps
    its own k, then k x tasks rows are merged); they are at most k rows, so
    broadcasting them is safe at any scale.  ``df`` is used twice (values
    and rows); with ``stage`` it is written once to the shared checkpoint
    folder so an expensive input (an aggregate over a large table) is
    computed once.  NULL values are not ranked.
    """
    if stage:
        from tidepool.session import materialize
        df = materialize(df, "top-k-input")
    order = F.col(value_col).desc() if descending else F.col(value_col).asc()
    best = (df.select(value_col).where(F.col(value_col).isNotNull())
              .distinct().orderBy(order).limit(k))
    ranked = best.withColumn(rank_col, F.dense_rank().over(Window.orderBy(order)))
    return df.join(F.broadcast(ranked), value_col, "inner")


# E19 ----------------------------------------------------------------------------------------
def sessionize(df: DataFrame, user_col: str, ts_col: str, gap_seconds: int,
               session_col: str = "session_id", skew_safe: bool = False, tie_cols=()) -> DataFrame:
    """Session number per user: a new session starts when the gap to the
    previous event exceeds ``gap_seconds``; the id is the running count of
    session starts.  ``skew_safe`` spreads a heavy user over many tasks."""
    if skew_safe:
        from tidepool.operators import skew
        return skew.sessionize(df, user_col, ts_col, gap_seconds, tie_cols=tie_cols, session_col=session_col)
    w = spec(user_col, [ts_col, *[c for c in df.columns if c not in (user_col, ts_col)]])
    micros = F.unix_micros(F.col(ts_col).cast("timestamp"))
    prev = F.lag(micros).over(w)
    new = F.when(prev.isNull() | (micros - prev > F.lit(gap_seconds * 1_000_000)), 1).otherwise(0)
    return (df.withColumn("_new", new)
              .withColumn(session_col, F.sum("_new").over(w.rowsBetween(UNBOUNDED_PRECEDING, 0)))
              .drop("_new"))


# Global ranking without a single-task window ------------------------------------------------
def global_row_number(df: DataFrame, order_cols, out: str = "row_number",
                      keep_total: bool = False) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY ...) computed by all tasks.

    ``orderBy`` range-partitions the rows, so partition i holds the i-th
    slice of the order and equal keys never straddle partitions.  Each
    partition numbers its own rows; the per-partition counts (one row per
    partition, so a bounded broadcast) give each partition's offset.  The
    numbered frame is written once to the shared checkpoint folder first, so
    the counts and the rows they offset come from one materialisation even
    if tasks are retried.  The order must be total.
    """
    from tidepool.session import materialize
    order_cols = _cols(order_cols)
    part = "_tp_part"
    ranked = df.orderBy(*order_cols).withColumn(part, F.spark_partition_id())
    local = ranked.withColumn("_tp_local", F.row_number().over(Window.partitionBy(part).orderBy(*order_cols)))
    local = materialize(local, "row-number")
    counts = local.groupBy(part).agg(F.max("_tp_local").alias("_tp_n"))
    offsets = counts.select(part, (F.sum("_tp_n").over(Window.orderBy(part)) - F.col("_tp_n")).alias("_tp_off"),
                            F.sum("_tp_n").over(Window.partitionBy()).alias("_tp_total"))
    res = (local.join(F.broadcast(offsets), part)
                .withColumn(out, (F.col("_tp_off") + F.col("_tp_local")).cast("bigint"))
                .drop(part, "_tp_local", "_tp_off"))
    return res if keep_total else res.drop("_tp_total")


def global_ntile(df: DataFrame, order_cols, n: int, out: str = "ntile") -> DataFrame:
    """NTILE(n) OVER (ORDER BY ...) without a single-task window: the first
    ``N mod n`` tiles get one extra row, as in SQL."""
    numbered = global_row_number(df, order_cols, "_tp_rn", keep_total=True)
    total = F.col("_tp_total")
    q = F.floor(total / n)
    rem = total - q * n
    big_rows = rem * (q + 1)
    tile = F.when(F.col("_tp_rn") <= big_rows, F.floor((F.col("_tp_rn") - 1) / (q + 1)) + 1).otherwise(
        rem + F.floor((F.col("_tp_rn") - 1 - big_rows) / q) + 1)
    return numbered.withColumn(out, tile.cast("bigint")).drop("_tp_rn", "_tp_total")
