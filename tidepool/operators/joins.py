"""Join operators.

Broadcasts are never blind: ``is_small`` takes the planner's byte estimate
(file sizes under the plan; no job runs), and every helper falls back to a
shuffle join (which AQE may still turn into a broadcast at runtime, or split
when skewed) when the estimate is above the bound.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.windows import global_row_number
from tidepool.session import estimated_bytes, materialize

# A side with an estimate up to this many bytes is broadcast by the helpers
# below.  Parquet grows some four times in memory, so this stays well under
# what an executor can hold.
BROADCAST_BYTES = 32 * 1024 * 1024

HINTS = {"broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl"}

# A band join packs its points into blocks of at least and at most so many, cut
# at no more places of their order than the driver can hold (16 bytes each).
BLOCK_POINTS = 64, 4096
MOST_CUTS = 200_000
# Pairs of a point and a band that a salt, and so a task, of a band join looks at.
PAIRS_PER_SALT = 100_000_000
MOST_TASKS = 20_000
# Rows of bands that a task deals to blocks.
ROWS_TO_DEAL = 250_000


def is_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when the planner's estimate of ``df`` is at most ``max_bytes``.
    Estimates of joins multiply their sides, so they err towards False."""
    return estimated_bytes(df) <= max_bytes


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_bytes) else df


# C1 -------------------------------------------------------------------------------------
def equi_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """ON / USING equi join; Catalyst picks the strategy."""
    return left.join(right, on, how)


# C2 / C10 ---------------------------------------------------------------------------------
def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner",
             max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Fact-to-dimension join: broadcast hash join when the dimension is
    small, else a shuffle join."""
    return fact.join(maybe_broadcast(dim, max_bytes), on, how)


# C2-C5 -------------------------------------------------------------------------------------
def hinted_join(left: DataFrame, right: DataFrame, on, strategy: str, how: str = "inner",
                hint_side: str = "right") -> DataFrame:
    """Join with an explicit strategy hint: broadcast, merge (sort-merge),
    shuffle_hash or shuffle_replicate_nl.  For ``broadcast`` the hinted
    side must be small; callers check with ``is_small``."""
    if strategy not in HINTS:
        raise ValueError(f"unknown join strategy {strategy!r}")
    if hint_side == "right":
        right = right.hint(strategy)
    else:
        left = left.hint(strategy)
    return left.join(right, on, how)


# C6 ------------------------------------------------------------------------------------------
def cross_small(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Cartesian product with a dimension (e.g. to build a complete report
    grid): the dimension is broadcast if small, else Spark pairs partitions."""
    return df.crossJoin(maybe_broadcast(dim))


# C7 ------------------------------------------------------------------------------------------
def theta_join_small(df: DataFrame, bands: DataFrame, cond: Column, how: str = "inner") -> DataFrame:
    """Non-equi join against a table of bands or ranges: broadcast if small
    (each task then runs a nested loop over its rows), else Spark's choice."""
    return df.join(maybe_broadcast(bands), cond, how)


def band_join(points: DataFrame, bands: DataFrame, value: str, lo: str, hi: str, closed: bool = False,
              rows_per_salt: int = 1_000_000) -> DataFrame:
    """Inner join of two large sides on ``lo <= value < hi`` (``<= hi`` when
    ``closed``) as an equality join on blocks of points, without a nested loop.

    The points are numbered in the order of their values and packed into blocks
    of neighbours, one row each.  A band goes to the blocks that its bounds
    enclose or cut, found by bisection, and meets their points inside the row: a
    pair costs a step in an array, not a row of a join.  Each point is in one
    block, whatever the widths of the bands.  Blocks have an eighth of the points
    that a band meets on average, so that the ends outside of the bands stay few,
    and BLOCK_POINTS and ``rows_per_salt`` as limits.  Blocks whose bands make
    more than PAIRS_PER_SALT pairs get salts (a value that most points have, or
    that most bands hold); the tasks are as many as the pairs need, however few
    bytes make them.  The bounds are checked on doubles, and at a tie on the
    columns themselves.

    A NULL bound is open, and cut at the least or greatest value there is;
    a NULL or NaN value, or a band with ``lo`` above ``hi``, matches nothing.
    The sides' column names must differ."""
    if set(points.columns) & set(bands.columns):
        raise ValueError("the sides of a band join share column names")
    x = F.col(value).cast("double")
    points = points.where(F.col(value).isNotNull() & ~F.isnan(x))
    least, most, n = points.agg(F.min(x), F.max(x), F.count(x)).first()      # three numbers
    if not n:
        return points.join(bands, F.lit(False))
    tie = F.xxhash64(*_hashable(points))                      # a value that most points have is dealt out
    order = global_row_number(points.withColumns({"_x": x, "_tie": tie}), ["_x", "_tie"], "_no")
    fine = max(min(BLOCK_POINTS[0], rows_per_salt), math.ceil(n / MOST_CUTS))
    at = lambda size: F.floor((F.col("_no") - 1) / size).cast("int")
    cuts = order.groupBy(at(fine).alias("_cut")).agg(F.min("_x"), F.max("_x")).orderBy("_cut").collect()   # MOST_CUTS rows
    first, last = _cut_of([r[2] for r in cuts], "left"), _cut_of([r[1] for r in cuts], "right")
    start = F.greatest(F.coalesce(F.col(lo).cast("double"), F.lit(least)), F.lit(least))
    end = F.least(F.coalesce(F.col(hi).cast("double"), F.lit(most)), F.lit(most))
    spans = bands.select("*", F.col(lo).cast("double").alias("_lo"), F.col(hi).cast("double").alias("_hi"),
                         start.alias("_start"), end.alias("_end")).where("_start <= _end")
    spans = spans.withColumns({"_first": first("_start"), "_last": last("_end") - 1}).drop("_start", "_end")
    spans = materialize(spans.where("_first <= _last"), "bands")
    n_bands, met = spans.agg(F.count(F.lit(1)), F.sum(F.col("_last") - F.col("_first"))).first()
    if not n_bands:
        return points.join(bands, F.lit(False))
    cuts_a_block = max(1, min(met // (8 * n_bands), min(BLOCK_POINTS[1], rows_per_salt) // fine))
    size = fine * cuts_a_block
    blocks = order.groupBy(at(size).alias("_block")).agg(F.collect_list(F.struct(*points.columns, "_x")).alias("_points"))
    reach = F.sequence(*[F.floor(F.col(c) / cuts_a_block).cast("int") for c in ("_first", "_last")])
    spread = math.ceil((met / cuts_a_block + 2 * n_bands) / ROWS_TO_DEAL)
    if spread > 1:                                            # few tasks may have staged the bands
        spans = spans.repartition(min(spread, MOST_TASKS))
    cut = materialize(spans.withColumn("_block", F.explode(reach)).drop("_first", "_last"), "band-blocks")
    load = materialize(hot_keys(cut.select("_block"), "_block", 1), "band-pairs")
    shares = load.agg(F.sum("_n")).first()[0] * size / PAIRS_PER_SALT
    per_salt = max(1, PAIRS_PER_SALT // size)                 # bands that a block meets in a task
    joined = salted_join(cut, blocks, "_block", 1, hot=load.where(F.col("_n") > per_salt), rows_per_salt=per_salt,
                         n_tasks=_tasks(points, shares), salt_by=_hashable(bands))
    joined = joined.select(*bands.columns, "_lo", "_hi", F.inline("_points"))
    after, before = F.col(lo) <= F.col(value), F.col(value) <= F.col(hi) if closed else F.col(value) < F.col(hi)
    if dict(points.dtypes)[value] != "string":     # casts to double keep the order, so only ties need the columns
        after = (F.col("_lo") < F.col("_x")) | ((F.col("_lo") == F.col("_x")) & after)
        before = (F.col("_x") < F.col("_hi")) | ((F.col("_x") == F.col("_hi")) & before)
    exact = (F.col(lo).isNull() | after) & (F.col(hi).isNull() | before)
    return joined.where(exact).select(*points.columns, *bands.columns)


def _cut_of(bounds: list[float], side: str):
    """Function that counts the sorted ``bounds`` below a value (``left``) or not above it (``right``)."""
    sorted_ = np.array(bounds)
    return F.pandas_udf(lambda v: pd.Series(np.searchsorted(sorted_, v, side)), "int")


def _hashable(df: DataFrame) -> list[str]:
    """Columns that have a hash: maps and variants have none."""
    return [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def _tasks(df: DataFrame, shares: float) -> int | None:
    """Tasks for a join of so many full shares of work; None (Spark's choice)
    when there is less than one.  Four for each share even out the blocks
    that meet in a task."""
    if shares <= 1:
        return None
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(least, math.ceil(4 * shares)), MOST_TASKS)


# C8 ------------------------------------------------------------------------------------------
def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keys with at least ``min_rows`` rows and their row count ``_n``
    (exact counts, distributed); all of them, at most rows / min_rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)


# The sketch below tracks at most this many keys (the limit of the built-in function).
SKETCH_ITEMS = 1_000_000


def heavy_hitters(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys with at least ``share`` of all rows that have a key, and their
    exact row count ``_n``, without a shuffle of all keys.

    A frequent-items sketch (a mergeable Misra-Gries summary, built in as
    ``approx_top_k``) is aggregated in one pass: with m tracked keys its
    error is at most 3.5 / m of the rows, so with m of 8 / share no key that
    has the share is missing, and fewer than 2 / share others rank with
    them.  Those few are then counted exactly, with partial sums in each
    task.  A share too small for the sketch's limit is counted over all keys.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    rows = df.select(key).where(F.col(key).isNotNull())
    total = rows.count()
    least = math.ceil(share * total)
    first, items = math.ceil(2 / share), math.ceil(8 / share)
    counted = rows
    if items <= SKETCH_ITEMS and first <= 100_000:
        top = rows.agg(F.expr(f"approx_top_k(`{key}`, {first}, {items})").alias("top"))
        few = materialize(top.select(F.explode("top.item").alias(key)), "heavy-keys")
        counted = rows.join(F.broadcast(few), key, "left_semi")      # 2 / share keys at most
    return counted.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)


def salted_join(big: DataFrame, small: DataFrame, key: str, n_salts: int,
                hot: DataFrame | None = None, how: str = "inner",
                rows_per_salt: int | None = None, n_tasks: int | None = None,
                salt_by: list[str] | None = None) -> DataFrame:
    """Equi join that spreads hot keys over several tasks.

    Rows of ``big`` with a hot key get a salt from a hash of their contents
    (deterministic: a retried task recomputes the same salt); the matching
    rows of ``small`` are replicated once per salt.  Other keys keep salt 0.
    When ``hot`` carries the key's row count ``_n`` and ``rows_per_salt`` is
    given, a key gets ceil(_n / rows_per_salt) salts, whatever its size, so
    rows per task stay bounded; else it gets ``n_salts``.  Returns exactly the
    rows of ``big.join(small, key, how)`` for how in inner / left.  ``hot``
    defaults to all keys of ``small``.  ``n_tasks`` fixes the number of tasks
    where the work is more than the bytes of the sides tell, ``salt_by`` the
    columns that are hashed (by default all).
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    big_cols = salt_by or big.columns
    if hot is None:                       # salt every key, n_salts each
        big_s = big.withColumn("_salts", F.lit(n_salts))
        small_s = small.withColumn("_salts", F.lit(n_salts))
    else:
        if rows_per_salt and "_n" in hot.columns:
            per_key = F.greatest(F.lit(1), F.ceil(F.col("_n") / rows_per_salt))
        else:
            per_key = F.lit(n_salts)
        # staged: it is counted once, and its file size tells if it can be broadcast
        salts = maybe_broadcast(materialize(hot.select(key, per_key.cast("int").alias("_salts")).distinct(), "hot-keys"))
        big_s = big.join(salts, key, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
        small_s = small.join(salts, key, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big_cols]), F.col("_salts")).cast("int")
    big_s = big_s.withColumn("_salt", salt).drop("_salts")
    small_s = small_s.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    if n_tasks:
        big_s, small_s = big_s.repartition(n_tasks, key, "_salt"), small_s.repartition(n_tasks, key, "_salt")
    return big_s.join(small_s, [key, "_salt"], how).drop("_salt")


# C9 / C11 ----------------------------------------------------------------------------------
def anti_join(new: DataFrame, seen: DataFrame, keys) -> DataFrame:
    """Rows of ``new`` whose key is not in ``seen`` (NOT EXISTS)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return new.join(seen.select(*keys), keys, "left_anti")


def filter_in(df: DataFrame, keys_df: DataFrame, keys) -> DataFrame:
    """A large IN list as a LEFT SEMI join against a key frame (never a
    literal list collected to the driver)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(keys_df.select(*keys), keys, "left_semi")


# C12 -----------------------------------------------------------------------------------------
def above_group_average(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows whose value exceeds their group's average -- the correlated
    subquery ``WHERE v > (SELECT avg(v) ... WHERE k = outer.k)`` written as
    an aggregate joined back on the key (both sides partitioned on key)."""
    avg = df.groupBy(key).agg(F.avg(value).alias("_grp_avg"))
    return df.join(avg, key).filter(F.col(value) > F.col("_grp_avg")).drop("_grp_avg")
