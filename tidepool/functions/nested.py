"""Array, struct, map and JSON helpers (H10-H24) plus the nested order
fixture derived from lineitem."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def order_items(lineitem: DataFrame) -> DataFrame:
    """Orders as nested rows, one row per order at every size:
    ``items: array<struct<partkey, qty, price>>`` and ``flags:
    array<string>`` (return flags), built by a grouped ``collect_list``.  An
    array is one value, so an order must fit one row; for keys that may not,
    see ``item_parts``."""
    return lineitem.groupBy("l_orderkey").agg(*_collected())


def item_parts(lineitem: DataFrame, rows_per_part: int) -> DataFrame:
    """The same arrays in parts of about ``rows_per_part`` lines, with the
    part's number as a column of its own: no array and no task grows with a
    hot order."""
    from tidepool.operators.joins import hot_keys, maybe_broadcast
    from tidepool.session import materialize
    hot = hot_keys(lineitem, "l_orderkey", min_rows=rows_per_part)
    parts = materialize(hot.select("l_orderkey", F.ceil(F.col("_n") / rows_per_part).cast("int").alias("_parts")), "hot-orders")
    part = F.pmod(F.xxhash64(*[F.col(c) for c in lineitem.columns]), F.coalesce("_parts", F.lit(1)))
    return (lineitem.join(maybe_broadcast(parts), "l_orderkey", "left").withColumn("part", part.cast("int"))
            .groupBy("l_orderkey", "part").agg(*_collected()))


def _collected() -> list[Column]:
    return [F.collect_list(F.struct(F.col("l_partkey").alias("partkey"), F.col("l_quantity").alias("qty"),
                                    F.col("l_extendedprice").alias("price"))).alias("items"),
            F.collect_list("l_returnflag").alias("flags")]


# H11-H13 ---------------------------------------------------------------------------------
def scaled(arr, factor: float) -> Column:
    return F.transform(_c(arr), lambda x: x.cast("double") * F.lit(factor))


def positives(arr) -> Column:
    return F.filter(_c(arr), lambda x: x > 0)


def fold_sum(arr) -> Column:
    """Left fold with a DOUBLE accumulator (its type must match the merge)."""
    return F.aggregate(_c(arr), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))


def fold_sum_squares(arr) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x.cast("double") * x.cast("double"))


# H14 -------------------------------------------------------------------------------------
def tag_list(tags: dict[str, Column], sep: str = ", ") -> Column:
    """Names of the true conditions joined with ``sep``.  Nulls are dropped
    with ``array_compact``: ``array_remove(a, NULL)`` returns NULL."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tags.items()])), sep)


# H16-H19 ---------------------------------------------------------------------------------
def json_field(c, path: str) -> Column:
    return F.get_json_object(_c(c), path)


def parse_json(c, schema: StructType | str) -> Column:
    """FROM_JSON in PERMISSIVE mode: malformed text gives NULL fields."""
    return F.from_json(_c(c), schema, {"mode": "PERMISSIVE"})


def infer_json_schema(df: DataFrame, col: str) -> StructType:
    """Infer the schema of a JSON text column over ALL its rows, in one
    distributed pass of the JSON reader: each value is one document, line
    breaks inside it included.  Nothing is written."""
    spark = df.sparkSession
    texts = df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull())
    as_strings = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(spark._jsparkSession.read().json(as_strings), spark).schema


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x
