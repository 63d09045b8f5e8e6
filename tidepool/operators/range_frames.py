"""RANGE frames that stay parallel when one key is huge.

``SUM(v) OVER (PARTITION BY k ORDER BY x RANGE BETWEEN b PRECEDING AND a
FOLLOWING)`` sends a key to one task, and copies of the rows near a chunk's
edge are no way out: a frame counted in values may hold most of the key.
A sum over a frame is a difference of two running sums, however wide the
frame is:

1. Rows equal on (key, x) are peers and share their frame: they are added up
   first, with partial sums before the shuffle.
2. Each x sends three points: its own sum at x, and two questions, at ``x - b``
   (before the sum there) and at ``x + a`` (after it).  No two points of a
   key tie, so chunks (``skew.chunked``) may be cut anywhere.
3. One running sum over the points, with offsets per (key, chunk), answers
   all questions; the difference of its two answers is the frame's sum.

Work is three points per distinct (key, x), whatever the width.  Sums must be
exact for a difference to be right, so values are integers or decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, LongType, StructType

from tidepool.operators import skew as SK

ASK_FROM, OWN, ASK_TO = 0, 1, 2      # order of the points at one place


def _exact(schema: StructType, col: str) -> tuple[DecimalType, DataType]:
    """The type that running sums of a column are kept in, and the type of a
    plain SUM over it (one digit is left free for adding two of them)."""
    dtype = schema[col].dataType
    if isinstance(dtype, IntegralType):
        return DecimalType(37, 0), LongType()
    if isinstance(dtype, DecimalType):
        return DecimalType(37, dtype.scale), DecimalType(min(38, dtype.precision + 10), dtype.scale)
    raise TypeError(f"{col} is {dtype.simpleString()}: range sums take integers or decimals")


def range_sums(df: DataFrame, keys, position: str, before: int, after: int, sums: dict[str, str],
               rows_out: str | None = None, counts: dict[str, str] | None = None,
               n_chunks: int | None = None) -> DataFrame:
    """``df`` with SUM (``sums``: output name to column), COUNT(*)
    (``rows_out``) and COUNT(column) (``counts``) over the frame of rows of
    the same key whose ``position`` lies within ``[position - before,
    position + after]``.

    ``position`` is an integer column (days, microseconds).  As in SQL, a row
    without position has the other rows without position as its frame, NULL
    keys are a key, and a sum over no value is NULL."""
    if before + after < 0:
        raise ValueError(f"a frame from {-before} to {after} holds nothing")
    if not isinstance(df.schema[position].dataType, IntegralType):
        raise TypeError(f"{position} must be an integer column")
    df, keys, tmp = SK._with_group(df, SK._cols(keys))
    used = sorted({*sums.values(), *(counts or {}).values()})
    kinds = {c: _exact(df.schema, c) for c in sums.values()}
    measures = {"_rows": F.count(F.lit(1))}
    measures |= {f"_count_{c}": F.count(c) for c in used}
    measures |= {f"_sum_{c}": F.coalesce(F.sum(F.col(c).cast(kept)), F.lit(0)).cast(kept) for c, (kept, _) in kinds.items()}
    peers = df.groupBy(*keys, position).agg(*[m.alias(name) for name, m in measures.items()])

    placed, own = peers.where(F.col(position).isNotNull()), peers.where(F.col(position).isNull())
    frames = _differences(placed, keys, position, before, after, list(measures), n_chunks).unionByName(own)
    for c, (_, plain) in kinds.items():
        frames = frames.withColumn(f"_sum_{c}", F.when(F.col(f"_count_{c}") > 0, F.col(f"_sum_{c}")).cast(plain))
    out = {name: f"_sum_{c}" for name, c in sums.items()} | {name: f"_count_{c}" for name, c in (counts or {}).items()}
    if rows_out:
        out[rows_out] = "_rows"
    frames = frames.select(*keys, position, *[F.col(m).alias(name) for name, m in out.items()])
    return SK.null_safe_join(df, frames, [*keys, position]).drop(*tmp)


def _differences(peers: DataFrame, keys, position: str, before: int, after: int, measures: list[str],
                 n_chunks: int | None) -> DataFrame:
    """(keys, position) with the frame's total of each measure."""
    def point(kind: int, at: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), at.cast("bigint").alias("at"))

    x = F.col(position).cast("bigint")
    points = peers.withColumn("_point", F.explode(F.array(
        point(ASK_FROM, x - F.lit(before)), point(OWN, x), point(ASK_TO, x + F.lit(after)))))
    points = points.select(
        *keys, position, F.col("_point.at").alias("_at"), F.col("_point.kind").alias("_kind"),
        *[F.when(F.col("_point.kind") == OWN, F.col(m)).otherwise(F.lit(0).cast(peers.schema[m].dataType)).alias(m)
          for m in measures])
    c = SK.chunked(points, keys, ["_at", "_kind"], n_chunks)
    upto = SK._local(keys, ["_at", "_kind"]).rowsBetween(SK.Window.unboundedPreceding, SK.Window.currentRow)
    local = c.select("*", *[F.sum(m).over(upto).alias(f"_upto{m}") for m in measures]).where(F.col("_kind") != OWN)
    totals = c.groupBy(*keys, SK.CHUNK).agg(*[F.sum(m).alias(m) for m in measures])
    asked = SK.null_safe_join(local, SK._prefix(totals, keys, measures), SK._join_key(keys))

    def difference(m: str) -> Column:
        kept = peers.schema[m].dataType
        answer = F.col(f"_upto{m}").cast(kept) + F.col(f"_before_{m}").cast(kept)
        return F.sum(F.when(F.col("_kind") == ASK_TO, answer).otherwise(-answer)).cast(kept).alias(m)

    return asked.groupBy(*keys, position).agg(*[difference(m) for m in measures])
