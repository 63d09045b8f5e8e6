"""Window functions that stay parallel when one group is huge.

A plain ``Window.partitionBy(k)`` sends every row of a group to one task:
with a key holding a third of the table, or a partition key with a handful
of values (5 order priorities, 25 nations), a few tasks sort most of the
data.  The operators here split each group into ordered chunks instead:

1. ``chunked`` range-partitions the rows on (keys, order).  The range
   partitioner samples the full sort key, so a large group is cut into many
   partitions; equal sort keys never straddle two partitions.  The
   partition index becomes the ``_chunk`` column, and the frame is
   written once as Parquet to the shared checkpoint folder
   (``session.materialize``) so every later use sees the same chunks even
   after task retries.
2. Each (key, chunk) is computed with an ordinary window -- bounded work
   per task.
3. Totals per (key, chunk) are prefixed over the chunks of each key and
   joined back as offsets.  A table of many small keys has about a row per
   key there; the plain window is the better choice for it.

Results equal the plain window functions row for row, NULL keys and values
included (tests check it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import input_bytes, materialize

CHUNK = "_chunk"


def _cols(x):
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def _names(cols):
    return [c for c in cols if isinstance(c, str)]


def default_chunks(df: DataFrame) -> int:
    """At least as many chunks as shuffle partitions, and as the bytes that
    the frame's plan reads have splits of
    ``spark.sql.files.maxPartitionBytes``.  Read from the plan: no job runs."""
    conf = df.sparkSession.conf
    shuffle = int(conf.get("spark.sql.shuffle.partitions"))
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return max(shuffle, -(-input_bytes(df) // split))


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys match, so the rows of a NULL group keep
    their offsets.  The key columns come from ``left``."""
    keys = _cols(keys)
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = F.lit(True)
    for i, k in enumerate(keys):
        same = F.col(k).eqNullSafe(F.col(f"_right_{k}"))
        on = same if i == 0 else on & same
    return left.join(other, on, how).drop(*[f"_right_{k}" for k in keys])


def chunked(df: DataFrame, keys, order_cols, n_chunks: int | None = None) -> DataFrame:
    """Range-partition on (keys, order) and tag rows with their chunk."""
    n = n_chunks or default_chunks(df)
    ranged = df.repartitionByRange(n, *_cols(keys), *_cols(order_cols))
    return materialize(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _local(keys, order_cols) -> Window:
    return Window.partitionBy(*_cols(keys), CHUNK).orderBy(*_cols(order_cols))


def _prefix(totals: DataFrame, keys, cols: list[str]) -> DataFrame:
    """Sum of each column over the EARLIER chunks of the same key."""
    w = (Window.partitionBy(*_cols(keys)) if _cols(keys) else Window.partitionBy()).orderBy(CHUNK) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*_cols(keys), CHUNK,
                         *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_before_{c}") for c in cols])


def _join_key(keys) -> list:
    return [*_names(_cols(keys)), CHUNK]


def ranked(df: DataFrame, keys, order_cols, n_tiles: int | None = None,
           n_chunks: int | None = None) -> DataFrame:
    """row_number, rank, dense_rank (and ntile) per key, skew-safe.

    ``order_cols`` may carry directions (Column objects); ties are the rows
    equal on all of them.  row_number needs a total order to be
    deterministic, exactly as with a plain window.  All numbers are bigint.

    Tied rows are dealt by a hash of the row, so a value that most rows have
    is cut into chunks like any other stretch.  A run of ties may then go
    over chunk borders: the first and last rows of the chunks (two a chunk)
    tell which chunks go on with the value of the one before."""
    keys, order_cols = _cols(keys), _cols(order_cols)
    df, keys, tmp = _with_group(df, keys)
    df = df.withColumn("_tie", F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in df.columns]))))
    c = chunked(df, keys, [*order_cols, "_tie"], n_chunks)
    lw, total = _local(keys, [*order_cols, "_tie"]), _local(keys, order_cols)
    local = (c.withColumn("_rn", F.row_number().over(lw).cast("bigint"))
              .withColumn("_rk", F.rank().over(total).cast("bigint"))
              .withColumn("_drk", F.dense_rank().over(total).cast("bigint")))
    totals = local.groupBy(*keys, CHUNK).agg(F.max("_rn").alias("rows"), F.max("_drk").alias("vals"),
                                             F.max("_rk").alias("last_start"))
    out = null_safe_join(local, _tie_offsets(local, totals, keys, order_cols, n_tiles), _join_key(keys))
    # the chunk's first run of ties belongs to the run that an earlier chunk began
    goes_on = F.col("_goes_on") & (F.col("_drk") == 1)
    out = (out.withColumn("row_number", F.col("_rn") + F.col("_before_rows"))
              .withColumn("rank", F.when(goes_on, F.col("_run_start")).otherwise(F.col("_rk") + F.col("_before_rows")))
              .withColumn("dense_rank", F.col("_drk") + F.col("_before_vals") - F.col("_goes_on").cast("bigint")))
    if n_tiles:
        out = out.withColumn("ntile", _ntile(F.col("row_number"), F.col("_group_rows"), n_tiles))
    return out.drop("_rn", "_rk", "_drk", "_tie", "_before_rows", "_before_vals", "_group_rows", "_goes_on", "_run_start", CHUNK, *tmp)


def _tie_offsets(local: DataFrame, totals: DataFrame, keys, order_cols, n_tiles: int | None) -> DataFrame:
    """Per (key, chunk): rows and values before it, whether it goes on with
    the last value of the chunk before, and the rank of that value."""
    ends = null_safe_join(local, totals.select(*keys, CHUNK, "rows"), _join_key(keys))
    ends = ends.where((F.col("_rn") == 1) | (F.col("_rn") == F.col("rows")))
    ends = ends.withColumn("_value", F.dense_rank().over(Window.partitionBy(*keys).orderBy(*order_cols)))
    ends = ends.groupBy(*keys, CHUNK).agg(F.min("_value").alias("_first"), F.max("_value").alias("_last"))
    w = Window.partitionBy(*keys).orderBy(CHUNK)
    t = null_safe_join(totals, ends, _join_key(keys))
    t = t.withColumn("_goes_on", F.coalesce(F.col("_first") == F.lag("_last").over(w), F.lit(False)))
    t = t.withColumn("vals", F.col("vals") - F.col("_goes_on").cast("bigint"))
    pre = null_safe_join(t, _prefix(t, keys, ["rows", "vals"]), _join_key(keys))
    # where the chunk's last run began, unless the whole chunk goes on with an earlier one
    own = F.when(~(F.col("_goes_on") & (F.col("_first") == F.col("_last"))), F.col("last_start") + F.col("_before_rows"))
    pre = pre.withColumn("_own", own)
    cols = [*keys, CHUNK, "_before_rows", F.col("_before_vals"), "_goes_on",
            F.last("_own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("_run_start")]
    if n_tiles:
        cols.append(F.sum("rows").over(Window.partitionBy(*keys)).alias("_group_rows"))
    return pre.select(*cols)


def _with_group(df: DataFrame, keys):
    """Keys must be column names; no keys = one group (a global window)."""
    if keys:
        if not all(isinstance(k, str) for k in keys):
            raise TypeError("skew-safe windows take key column names")
        return df, keys, []
    return df.withColumn("_one_group", F.lit(0)), ["_one_group"], ["_one_group"]


def _ntile(rn: Column, total: Column, n: int) -> Column:
    q = F.floor(total / n)
    rem = total - q * n
    big = rem * (q + 1)
    return F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1).otherwise(
        rem + F.floor((rn - 1 - big) / q) + 1).cast("bigint")


def running_sum(df: DataFrame, keys, order_cols, value_col: str, out: str = "running_sum",
                count_out: str | None = None, n_chunks: int | None = None) -> DataFrame:
    """SUM(value) (and COUNT) OVER (PARTITION BY keys ORDER BY order ROWS
    UNBOUNDED PRECEDING), skew-safe.  Decimal sums stay exact."""
    keys, order_cols = _cols(keys), _cols(order_cols)
    df, keys, tmp = _with_group(df, keys)
    c = chunked(df, keys, order_cols, n_chunks)
    lw = _local(keys, order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = c.withColumn("_ls", F.sum(value_col).over(lw)).withColumn("_lc", F.count(F.lit(1)).over(lw))
    totals = c.groupBy(*keys, CHUNK).agg(F.sum(value_col).alias("s"), F.count(F.lit(1)).alias("n"),
                                         F.count(value_col).alias("v"))
    pre = _prefix(totals, keys, ["s", "n", "v"])
    # NULL values add nothing; the sum is NULL until the first value of the key
    total = F.when(F.col("_ls").isNotNull() | (F.col("_before_v") > 0),
                   F.coalesce("_ls", F.lit(0)) + F.col("_before_s"))
    res = null_safe_join(local, pre, _join_key(keys)).withColumn(out, total)
    if count_out:
        res = res.withColumn(count_out, F.col("_lc") + F.col("_before_n"))
    return res.drop("_ls", "_lc", "_before_s", "_before_n", "_before_v", CHUNK, *tmp)


def sessionize(df: DataFrame, user_col: str, ts_col: str, gap_seconds: int, tie_cols=(),
               session_col: str = "session_id", n_chunks: int | None = None) -> DataFrame:
    """Session numbers per user (new session after a gap > ``gap_seconds``),
    skew-safe: one user with a third of all events is spread over many
    tasks.  The previous event of a chunk's first row is the last event of
    the user's previous chunk."""
    order = [ts_col, *_cols(tie_cols)]
    c = chunked(df, [user_col], order, n_chunks)
    micros = F.unix_micros(F.col(ts_col).cast("timestamp"))
    lw = _local([user_col], order)
    local = c.withColumn("_t", micros).withColumn("_prev", F.lag("_t").over(lw)) \
             .withColumn("_pos", F.row_number().over(lw))
    ends = local.groupBy(user_col, CHUNK).agg(F.max("_t").alias("_last_t"))
    before = Window.partitionBy(user_col).orderBy(CHUNK)
    ends = ends.select(user_col, CHUNK, F.lag("_last_t").over(before).alias("_prev_chunk_t"))
    j = null_safe_join(local, ends, [user_col, CHUNK])
    prev = F.when(F.col("_pos") == 1, F.col("_prev_chunk_t")).otherwise(F.col("_prev"))
    flagged = j.withColumn("_new", F.when(prev.isNull() | (F.col("_t") - prev > F.lit(gap_seconds * 1_000_000)), 1)
                           .otherwise(0)).drop("_prev", "_prev_chunk_t", "_pos", "_t")
    # running count of session starts: local cumulative sum + starts in earlier chunks
    cw = _local([user_col], order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local2 = flagged.withColumn("_ls", F.sum("_new").over(cw))
    totals = flagged.groupBy(user_col, CHUNK).agg(F.sum("_new").alias("s"))
    pre = _prefix(totals, [user_col], ["s"])
    return (null_safe_join(local2, pre, [user_col, CHUNK])
                  .withColumn(session_col, (F.col("_ls") + F.col("_before_s")).cast("bigint"))
                  .drop("_ls", "_before_s", "_new", CHUNK))


def percentiles_cont(df: DataFrame, keys, value_col: str, probs: dict[str, float],
                     n_chunks: int | None = None) -> DataFrame:
    """Exact PERCENTILE_CONT for several probabilities per key, as weighted
    order statistics over counted values.

    Equal values are counted first (with partial sums before the shuffle), so
    a value that most rows have is one row.  The (key, value, count) rows are
    range-partitioned into chunks; sums per (key, chunk) tell which chunks
    hold the positions floor / ceil of ``p * (n - 1)``, and only those are
    read again and prefixed: two chunks at most per key and probability.
    Each result is the linear interpolation of the two values, the SQL
    definition.  NULL values are ignored; positions are bigint."""
    keys = _cols(keys)
    base = df.select(*keys, value_col).where(F.col(value_col).isNotNull())
    base, gkeys, tmp = _with_group(base, keys)
    counted = base.groupBy(*gkeys, value_col).agg(F.count(F.lit(1)).alias("_n"))
    c = chunked(counted, gkeys, [value_col], n_chunks)
    totals = c.groupBy(*gkeys, CHUNK).agg(F.sum("_n").alias("rows"))
    pre = null_safe_join(totals, _prefix(totals, gkeys, ["rows"]), _join_key(gkeys))
    pre = pre.withColumn("_group_rows", F.sum("rows").over(Window.partitionBy(*gkeys)))
    places = [(name, F.lit(float(p)) * (F.col("_group_rows") - 1)) for name, p in probs.items()]
    ends = [(name, pos, F.floor(pos), F.ceil(pos)) for name, pos in places]

    def holds(at: Column, start: Column, end: Column) -> Column:
        return (start <= at) & (at < end)

    wanted = F.lit(False)
    for _, _, lo, hi in ends:
        start, end = F.col("_before_rows"), F.col("_before_rows") + F.col("rows")
        wanted = wanted | holds(lo, start, end) | holds(hi, start, end)
    few = pre.where(wanted).select(*gkeys, CHUNK, "_before_rows", "_group_rows")
    upto = F.sum("_n").over(_local(gkeys, [value_col]).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = null_safe_join(c, few, _join_key(gkeys)).withColumn("_end", F.col("_before_rows") + upto)
    start, end = F.col("_end") - F.col("_n"), F.col("_end")
    aggs = []
    for name, pos, lo, hi in ends:
        lo_v = F.max(F.when(holds(lo, start, end), F.col(value_col)))
        hi_v = F.max(F.when(holds(hi, start, end), F.col(value_col)))
        aggs.append((lo_v + (hi_v - lo_v) * F.max(pos - lo)).cast("double").alias(name))
    return found.groupBy(*gkeys).agg(*aggs).drop(*tmp)


def percentile_cont(df: DataFrame, keys, value_col: str, p: float, out: str = "percentile",
                    n_chunks: int | None = None) -> DataFrame:
    return percentiles_cont(df, keys, value_col, {out: p}, n_chunks)


def bounded_frame(df: DataFrame, keys, order_cols, before: int, after: int, build,
                  n_chunks: int | None = None) -> DataFrame:
    """Window columns whose frames reach at most ``before`` rows back and
    ``after`` rows ahead (LAG / LEAD / ROWS n PRECEDING .. m FOLLOWING),
    skew-safe.

    ``build(w)`` returns ``{name: column}`` using the window ``w`` (add
    ``rowsBetween`` as needed).  Each chunk is evaluated together with
    "halo" copies of the last ``before`` rows of the preceding chunks and
    the first ``after`` rows of the following chunks of the same key; the
    halo rows give the chunk's edge rows their true neighbours and are
    dropped afterwards.  Halo rows number at most chunks x (before + after)^2.
    """
    keys, order_cols = _cols(keys), _cols(order_cols)
    df, keys, tmp = _with_group(df, keys)
    c = chunked(df, keys, order_cols, n_chunks)
    lw = _local(keys, order_cols)
    size = F.count(F.lit(1)).over(Window.partitionBy(*keys, CHUNK))
    pos = c.withColumn("_pos", F.row_number().over(lw)).withColumn("_size", size)
    ranks = c.select(*keys, CHUNK).distinct().withColumn(
        "_crank", F.dense_rank().over(Window.partitionBy(*keys).orderBy(CHUNK)))
    pos = null_safe_join(pos, ranks, [*keys, CHUNK])
    own = pos.withColumn("_target", F.col(CHUNK)).withColumn("_halo", F.lit(False))
    parts = [own]
    to_chunk = ranks.select(*keys, F.col("_crank").alias("_trank"), F.col(CHUNK).alias("_target"))
    if before > 0:
        tails = pos.where(F.col("_size") - F.col("_pos") < before)
        tails = (tails.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(before))))
                      .withColumn("_trank", F.col("_crank") + F.col("_step")).drop("_step"))
        parts.append(null_safe_join(tails, to_chunk, [*keys, "_trank"]).drop("_trank").withColumn("_halo", F.lit(True)))
    if after > 0:
        heads = pos.where(F.col("_pos") <= after)
        heads = (heads.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(after))))
                      .withColumn("_trank", F.col("_crank") - F.col("_step")).drop("_step"))
        parts.append(null_safe_join(heads, to_chunk, [*keys, "_trank"]).drop("_trank").withColumn("_halo", F.lit(True)))
    aug = parts[0]
    for p in parts[1:]:
        aug = aug.unionByName(p)
    w = Window.partitionBy(*keys, "_target").orderBy(*order_cols)
    cols = build(w)
    out = aug.select("*", *[v.alias(k) for k, v in cols.items()]).where(~F.col("_halo"))
    return out.drop("_pos", "_size", "_crank", "_target", "_halo", CHUNK, *tmp)


def last_before(df: DataFrame, keys, order_cols, value_col: str, out: str,
                n_chunks: int | None = None) -> DataFrame:
    """LAST_VALUE(value IGNORE NULLS) OVER (PARTITION BY keys ORDER BY order
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), skew-safe: the local
    answer inside the chunk, else the last non-null value of the key's
    earlier chunks (found over a table with one row per key and chunk)."""
    keys, order_cols = _cols(keys), _cols(order_cols)
    df, keys, tmp = _with_group(df, keys)
    c = chunked(df, keys, order_cols, n_chunks)
    lw = _local(keys, order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = c.withColumn("_local", F.last(value_col, ignorenulls=True).over(lw))
    ends = (c.withColumn("_seq", F.row_number().over(_local(keys, order_cols)))
              .where(F.col(value_col).isNotNull())
              .groupBy(*keys, CHUNK).agg(F.max_by(value_col, "_seq").alias("_chunk_last")))
    # chunks without any non-null value are absent from ``carry``: take the
    # closest earlier chunk that has one
    cw = Window.partitionBy(*keys).orderBy(CHUNK)
    chunks = c.select(*keys, CHUNK).distinct()
    both = null_safe_join(chunks, ends, [*keys, CHUNK], "left")
    carry = both.select(*keys, CHUNK, F.last("_chunk_last", ignorenulls=True).over(
        cw.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    res = null_safe_join(local, carry, [*keys, CHUNK]).withColumn(out, F.coalesce("_local", "_carry"))
    return res.drop("_local", "_carry", CHUNK, *tmp)


def first_last(df: DataFrame, keys, order_cols: list[str], value_col: str,
               first_out: str = "first_value", last_out: str = "last_value") -> DataFrame:
    """FIRST_VALUE / LAST_VALUE over the whole partition as aggregates:
    ``min_by`` / ``max_by`` on the order tuple combine map-side, then join
    back on the key (AQE splits the join if one key is hot)."""
    keys = _cols(keys)
    order = F.struct(*order_cols)
    ends = df.groupBy(*keys).agg(F.min_by(value_col, order).alias(first_out),
                                 F.max_by(value_col, order).alias(last_out))
    return null_safe_join(df, ends, keys)
