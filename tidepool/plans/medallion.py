"""Bronze -> Silver -> Gold order pipeline (J1-J9) as DataFrame functions.

Every step returns a DataFrame; writing is left to the caller (to a new
path per run, or ``overwrite_partitions`` for a one-day backfill), so a
rerun with the same inputs produces the same tables.  Times are passed in,
never read from the clock.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DecimalType, IntegerType, StringType, StructField, StructType,
                               TimestampType)

from tidepool.functions.scalar import exact_avg, half_up_quotient
from tidepool.operators.changes import DELETE, PRE, merge_upsert
from tidepool.operators.joins import anti_join, join_dim
from tidepool.operators.windows import keep_latest
from tidepool.session import materialize
from tidepool.sources.contracts import enforce_schema
from tidepool.sources.partitions import PartitionStore

# Columns, types, required fields and statuses of the order pipeline, and its Gold keys.
BRONZE_COLUMNS = ["event_id", "order_id", "customer_id", "product_id", "quantity", "unit_price",
                  "status", "region", "event_ts"]
BRONZE_SCHEMA = StructType([StructField(c, StringType(), True) for c in BRONZE_COLUMNS])

# Silver contract: every field required (the reference's Silver table is NOT NULL).
SILVER_CONTRACT = StructType([
    StructField("order_id", StringType(), False),
    StructField("customer_id", StringType(), False),
    StructField("product_id", StringType(), False),
    StructField("quantity", IntegerType(), False),
    StructField("unit_price", DecimalType(10, 2), False),
    StructField("status", StringType(), False),
    StructField("region", StringType(), False),
    StructField("event_ts", TimestampType(), False),
])
# Columns of the Silver table.
SILVER_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "amount",
                  "status", "region", "order_date", "ingested_at"]
# Statuses that count as revenue in Gold (reference pipeline).
GOLD_STATUSES = ("completed", "shipped")


def _ts(value) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


# J1 / J2 ---------------------------------------------------------------------------------
def to_bronze(raw: DataFrame, ingestion_ts, existing: DataFrame | None = None,
              partition_of=None) -> DataFrame:
    """Dedup the batch on event_id, drop ids already in ``existing`` (so a
    rerun appends nothing), stamp the ingestion time.  A row without an id
    is identified by all its values.

    With ``partition_of`` (a column expression giving the existing table's
    partition value of a row, e.g. its event day) only the partitions the
    batch can collide with are read: the existing table is semi-joined on
    the batch's distinct partition values before the anti join."""
    def keyed(df: DataFrame) -> DataFrame:
        values = F.sha2(F.to_json(F.struct(*[F.col(c) for c in raw.columns]), {"ignoreNullFields": "false"}), 256)
        return df.withColumn("_key", F.coalesce(F.concat(F.lit("id "), F.col("event_id")), F.concat(F.lit("row "), values)))

    batch = keyed(raw).dropDuplicates(["_key"])
    if existing is not None:
        if partition_of is not None:
            days = batch.select(partition_of.alias("_day")).distinct()
            existing = (existing.withColumn("_part", partition_of)
                        .join(days, F.col("_part").eqNullSafe(F.col("_day")), "left_semi").drop("_part"))
        batch = anti_join(batch, keyed(existing), "_key")
    return batch.drop("_key").withColumn("ingestion_ts", _ts(ingestion_ts))


def event_day() -> Column:
    """Partition value of a bronze row: the day of its event time."""
    return F.substring("event_ts", 1, 10)


# J3 / J8 ---------------------------------------------------------------------------------
def latest_events(bronze: DataFrame) -> DataFrame:
    """Latest event per order (event_ts, then numeric event_id)."""
    b = bronze.withColumn("_eid", F.col("event_id").try_cast("bigint"))
    return keep_latest(b, "order_id", ["event_ts", "_eid"]).drop("_eid")


def silver_split(bronze: DataFrame, ingested_at) -> tuple[DataFrame, DataFrame]:
    """(silver, rejects).  Keep the latest event per order first (as the
    reference does), then cast to the contract; rows with a missing or
    unparsable required field, or an amount beyond its type, go to the
    reject side with a reason."""
    latest = latest_events(bronze).select(*BRONZE_COLUMNS)
    ok, bad = enforce_schema(latest.drop("event_id"), SILVER_CONTRACT)
    priced = ok.withColumn("amount", (F.col("quantity") * F.col("unit_price")).try_cast("decimal(10,2)"))
    silver = priced.where(F.col("amount").isNotNull()).select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "amount",
        "status", "region", F.to_date("event_ts").alias("order_date"),
        _ts(ingested_at).alias("ingested_at"))
    too_large = priced.where(F.col("amount").isNull()).withColumn("reject_reason", F.lit("amount:out_of_range"))
    rejects = (bad.select("order_id", "customer_id", "unit_price", "quantity", "region", "reject_reason")
               .unionByName(too_large.select("order_id", "customer_id", F.col("unit_price").cast("string"),
                                             F.col("quantity").cast("string"), "region", "reject_reason")))
    return silver, rejects


def to_silver(bronze: DataFrame, ingested_at) -> DataFrame:
    return silver_split(bronze, ingested_at)[0]


# J4 --------------------------------------------------------------------------------------
def upsert_silver(silver: DataFrame, updates: DataFrame, update_cols=("status", "ingested_at")) -> DataFrame:
    return merge_upsert(silver, updates, "order_id", update_cols=list(update_cols) if update_cols else None)


# J5 --------------------------------------------------------------------------------------
def to_gold(silver: DataFrame) -> DataFrame:
    """Daily revenue by product and region over completed + shipped orders."""
    return (silver.where(F.col("status").isin(*GOLD_STATUSES))
            .groupBy("order_date", "product_id", "region")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.sum("amount").cast("decimal(14,2)").alias("total_revenue"),
                 exact_avg("amount", 2).cast("decimal(10,2)").alias("avg_order_value")))


GOLD_KEYS = ["order_date", "product_id", "region"]
GOLD_SCHEMA = ("order_date date, product_id string, region string, total_orders bigint, total_revenue decimal(14,2), "
               "avg_order_value decimal(10,2)")


# J6 --------------------------------------------------------------------------------------
def upsert_gold(gold: DataFrame, updates: DataFrame) -> DataFrame:
    """Replace matching (date, product, region) rows, insert new ones.  Rows
    of groups that vanished stay; ``apply_to_gold`` takes them away, from the
    change feed."""
    return merge_upsert(gold, updates, GOLD_KEYS)


def gold_delta(feed: DataFrame) -> DataFrame:
    """What a change feed of Silver adds to each Gold group: pre-images and
    deletes subtract, post-images and inserts add.  Sums combine before the
    shuffle; groups whose changes cancel are left out."""
    sign = F.when(F.col("_change_type").isin(PRE, DELETE), -1).otherwise(1)
    rows = feed.where(F.col("status").isin(*GOLD_STATUSES)).withColumn("_sign", sign)
    delta = rows.groupBy(*GOLD_KEYS).agg(F.sum("_sign").cast("bigint").alias("_orders"),
                                         F.sum(F.col("amount") * F.col("_sign")).cast("decimal(14,2)").alias("_revenue"))
    return delta.where("_orders <> 0 OR _revenue <> 0")


def apply_to_gold(gold: DataFrame, feed: DataFrame) -> DataFrame:
    """Gold after a change feed of Silver: counts and sums are retracted and
    added, the average follows from them, and a group without orders goes.
    Equal to Gold built anew from the changed Silver, whose rows it does not
    read."""
    joined = null_safe_full_join(gold, gold_delta(feed), GOLD_KEYS)
    orders = F.coalesce("total_orders", F.lit(0)) + F.coalesce("_orders", F.lit(0))
    revenue = (F.coalesce("total_revenue", F.lit(0)) + F.coalesce("_revenue", F.lit(0))).cast("decimal(14,2)")
    out = joined.select(*GOLD_KEYS, orders.cast("bigint").alias("total_orders"), revenue.alias("total_revenue")).where("total_orders <> 0")
    units, n = (F.col("total_revenue") * 100).cast("decimal(38,0)"), F.col("total_orders").cast("decimal(38,0)")
    return out.withColumn("avg_order_value", half_up_quotient(units, n, 2).cast("decimal(10,2)"))


def apply_to_gold_store(store: PartitionStore, feed: DataFrame) -> int:
    """``apply_to_gold`` on a Gold store partitioned by order date: only days
    with changes are read and published, in one step; a day whose last group
    goes is emptied.  A feed must be applied once: ``version`` of the store
    tells how many were."""
    delta = materialize(gold_delta(feed), "gold-delta")
    days = store.read_touched(delta)
    empty = feed.sparkSession.createDataFrame([], GOLD_SCHEMA)
    return store.replace(apply_to_gold(empty if days is None else days, feed), touched=delta)


def null_safe_full_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Full outer join in which NULL keys match; keys are coalesced."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.withColumn("_l", F.lit(True)).join(other, reduce(and_, on), "full_outer")
    return joined.select(*[F.when(F.col("_l"), F.col(k)).otherwise(F.col(f"_right_{k}")).alias(k) for k in keys],
                         *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys])


# J7 --------------------------------------------------------------------------------------
def layer_checks(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """One row per check: layer counts, null amounts in silver, and its rows
    of each status, as a single union of aggregates."""
    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("check"), "value")
    null_amt = silver.agg(F.sum(F.when(F.col("amount").isNull(), 1).otherwise(0)).cast("bigint").alias("value")) \
        .select(F.lit("silver_null_amount").alias("check"), F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
    status = silver.groupBy(F.concat(F.lit("silver_status_"), F.coalesce("status", F.lit("null"))).alias("check")).agg(
        F.count(F.lit(1)).alias("value"))
    return (cnt(bronze, "bronze_rows").unionByName(cnt(silver, "silver_rows"))
            .unionByName(cnt(gold, "gold_rows")).unionByName(null_amt).unionByName(status))


# Derived bronze input from the events table ---------------------------------------------------
def raw_order_events(spark: SparkSession, events: DataFrame, customer: DataFrame, nation: DataFrame,
                     region: DataFrame, duplicate_every: int = 10) -> DataFrame:
    """Bronze-shaped (all string) order events derived from ``events``.

    order = (user, day); customer = user; product and quantity from the
    ``k`` property; status from event_type; region through customer ->
    nation -> region; unit_price = value, NULL on every 20th event id and
    unparsable text 'bad' on the 10th of every 20.  Every
    ``duplicate_every``-th event is delivered twice (same event_id)."""
    k = F.get_json_object("props", "$.k").cast("int")
    c = customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    r = region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    geo = join_dim(join_dim(c, n, "c_nationkey"), r, "n_regionkey").select("user_id", "r_name")
    ev = join_dim(events, geo, "user_id", how="left")
    status = (F.when(F.col("event_type") == "purchase", "completed")
               .when(F.col("event_type") == "click", "shipped")
               .when(F.col("event_type") == "error", "cancelled").otherwise("pending"))
    price = (F.when(F.col("event_id") % 20 == 0, F.lit(None).cast("string"))
              .when(F.col("event_id") % 20 == 10, F.lit("bad"))
              .otherwise(F.col("value").cast("string")))
    raw = ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("ord-"), (F.col("user_id") * 100 + F.dayofmonth("ts")).cast("string")).alias("order_id"),
        F.concat(F.lit("cust-"), F.col("user_id").cast("string")).alias("customer_id"),
        F.concat(F.lit("prod-"), (k % 10).cast("string")).alias("product_id"),
        (k % 5 + 1).cast("string").alias("quantity"),
        price.alias("unit_price"),
        status.alias("status"),
        F.col("r_name").alias("region"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_ts"))
    if not duplicate_every:
        return raw
    dup = raw.filter(F.col("event_id").cast("bigint") % duplicate_every == 0)
    return raw.unionByName(dup)
