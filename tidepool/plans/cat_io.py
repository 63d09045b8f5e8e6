"""Registered round trips for sources, sinks and layout jobs (A2-A15, H19,
I8-I11, J9, K4, K6).

Each query writes a test table (or a frame derived from it) to a fresh
folder under the shared checkpoint folder with the operator under test,
reads it back and returns the rows; the oracle is the table itself in
SQL.  The work grows with the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool.functions import nested as N
from tidepool.operators import layout as L
from tidepool.operators import quality as Q
from tidepool.plans.cat_medallion import RAW_SQL, T2, gold_sql, silver_sql
from tidepool.plans.cat_quality import ERR_OK, FLAGGED_SQL, REASON, RUN_TS, metrics_sql
from tidepool.plans.common import t
from tidepool.plans.registry import register
from tidepool.session import scratch_path
from tidepool.sources import contracts as C
from tidepool.sources import io as IO

CUSTOMER_SQL = "SELECT * FROM customer"


def _dir(spark, name):
    return scratch_path(spark, name)


@register("A2_csv_round_trip", oracle=CUSTOMER_SQL)
def a2(spark, d):
    c = t(spark, d, "customer")
    path = _dir(spark, "a2-csv")
    IO.write_path(c, path, mode="overwrite", fmt="csv")
    return IO.read_csv(spark, path, schema=c.schema)          # explicit schema: no inference pass


@register("A2b_csv_inferred_types", oracle=CUSTOMER_SQL)
def a2b(spark, d):
    c = t(spark, d, "customer")
    path = _dir(spark, "a2b-csv")
    IO.write_path(c, path, mode="overwrite", fmt="csv")
    back = IO.read_csv(spark, path)                           # header + inferred types
    return back.select(*[F.col(f.name).cast(f.dataType) for f in c.schema.fields])


@register("A3_json_round_trip", oracle="SELECT * FROM orders")
def a3(spark, d):
    o = t(spark, d, "orders")
    path = _dir(spark, "a3-json")
    IO.write_path(o, path, mode="overwrite", fmt="json")      # A11: JSON sink
    return IO.read_json(spark, path, schema=o.schema)


@register("A4_jdbc_partitioned_read", oracle="SELECT c_custkey, c_name, c_acctbal FROM customer")
def a4(spark, d):
    """Embedded in-memory Derby inside the Spark JVM: no server, no port."""
    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    url = f"jdbc:derby:memory:tp{uuid.uuid4().hex[:12]};create=true"
    c.write.format("jdbc").option("url", url).option("dbtable", "CUST").mode("overwrite").save()
    lo, hi = c.agg(F.min("c_custkey"), F.max("c_custkey")).first()
    back = IO.read_jdbc(spark, url, "CUST", partition_column="C_CUSTKEY", lower_bound=int(lo),
                        upper_bound=int(hi) + 1, num_partitions=4)
    return back.select(F.col("C_CUSTKEY").alias("c_custkey"), F.col("C_NAME").alias("c_name"),
                       F.col("C_ACCTBAL").alias("c_acctbal"))


@register("A7_managed_table_append_overwrite", oracle="SELECT * FROM orders WHERE o_orderkey % 4 < 2")
def a7(spark, d):
    o = t(spark, d, "orders")
    name = "a7_" + uuid.uuid4().hex
    IO.write_table(o.where("o_orderkey % 4 = 3"), name, mode="overwrite")
    IO.write_table(o.where("o_orderkey % 4 = 0"), name, mode="overwrite")
    IO.write_table(o.where("o_orderkey % 4 = 1"), name, mode="append")
    return spark.table(name)


@register("A7w_managed_table_whole_round_trip", oracle="SELECT * FROM orders")
def a7w(spark, d):
    """Every order is written: the second write replaces the first, the third adds the rest."""
    o = t(spark, d, "orders")
    name = "a7w_" + uuid.uuid4().hex
    part = F.coalesce(F.col("o_orderkey") % 2 == 0, F.lit(False))
    IO.write_table(o.where(~part), name, mode="overwrite")
    IO.write_table(o.where(part), name, mode="overwrite")
    IO.write_table(o.where(~part), name, mode="append")
    return spark.table(name)


@register("A9_create_table_as_select", oracle="SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY c_nationkey")
def a9(spark, d):
    t(spark, d, "customer").createOrReplaceTempView("a9_customer")
    return IO.create_table_as(spark, "a9_" + uuid.uuid4().hex,
                              "SELECT c_nationkey, COUNT(*) AS n FROM a9_customer GROUP BY c_nationkey")


@register("A8_external_path_round_trip", oracle="SELECT * FROM lineitem")
def a8(spark, d):
    li = t(spark, d, "lineitem")
    path = _dir(spark, "a8-parquet")
    IO.write_path(li, path)
    return spark.read.parquet(path)


@register("A10_partitioned_write_pruned_read", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate) AS y FROM orders WHERE year(o_orderdate) = 1997
""")
def a10(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                     F.year("o_orderdate").cast("bigint").alias("y"))
    path = _dir(spark, "a10-part")
    IO.write_path(o, path, partition_by="y", files_per_partition=L.n_files(o))
    return spark.read.parquet(path).filter(F.col("y") == 1997).select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("y").cast("bigint").alias("y"))


A12_SQL = """
SELECT o_orderkey, o_totalprice, y FROM (
  SELECT o_orderkey, o_totalprice, year(o_orderdate) AS y FROM orders) x
WHERE y <> 1996 OR o_orderkey % 2 = 0
"""


@register("A12s_backfill_published_in_one_step", oracle=A12_SQL)
def a12s(spark, d):
    """A12 on a partition store: readers see the year before or after the
    backfill, never without it; run twice, as after a crash."""
    from tidepool.sources.partitions import PartitionStore
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").cast("bigint").alias("y"))
    store = PartitionStore(spark, _dir(spark, "a12s-backfill"), "y")
    store.replace(IO.spread_partitions(o, "y", L.n_files(o)))
    for _ in range(2):
        store.replace(IO.spread_partitions(o.filter((F.col("y") == 1996) & (F.col("o_orderkey") % 2 == 0)), "y", L.n_files(o)))
    return store.read()


@register("A12_backfill_one_partition", oracle=A12_SQL)
def a12(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").cast("bigint").alias("y"))
    path = _dir(spark, "a12-backfill")
    IO.write_path(o, path, partition_by="y", files_per_partition=L.n_files(o))
    # re-run one year with corrected input (even keys only): only y=1996 is replaced
    IO.overwrite_partitions(o.filter((F.col("y") == 1996) & (F.col("o_orderkey") % 2 == 0)), path, "y",
                            files_per_partition=L.n_files(o))
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", F.col("y").cast("bigint").alias("y"))


@register("A14_schema_contract_accepted", oracle="""
SELECT CAST(event_id AS BIGINT) AS event_id, TRY_CAST(value_text AS DECIMAL(10,2)) AS value, event_type
FROM (SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
             CASE WHEN event_id % 20 = 0 THEN NULL WHEN event_id % 20 = 10 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS value_text
      FROM events) s
WHERE TRY_CAST(value_text AS DECIMAL(10,2)) IS NOT NULL
""")
def a14(spark, d):
    from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType
    ev = t(spark, d, "events")
    raw = ev.select(F.col("event_id").cast("string").alias("event_id"),
                    F.when(F.col("event_id") % 20 == 0, F.lit(None).cast("string"))
                     .when(F.col("event_id") % 20 == 10, F.lit("bad"))
                     .otherwise(F.col("value").cast("string")).alias("value"),
                    "event_type")
    contract = StructType([StructField("event_id", LongType(), False), StructField("value", DecimalType(10, 2), False),
                           StructField("event_type", StringType(), True)])
    ok, _ = C.enforce_schema(raw, contract)
    return ok


@register("A15_append_with_schema_evolution", oracle="""
SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS c_acctbal FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 1
""")
def a15(spark, d):
    c = t(spark, d, "customer")
    path = _dir(spark, "a15-evolve")
    C.append_evolving(c.filter(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_name"), path)
    C.append_evolving(c.filter(F.col("c_custkey") % 2 == 1).select("c_custkey", "c_name", "c_acctbal"), path)
    return C.read_evolving(spark, path).select("c_custkey", "c_name", "c_acctbal")


@register("H19_json_schema_inferred_over_all_rows", oracle="""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def h19(spark, d):
    ev = t(spark, d, "events")
    schema = N.infer_json_schema(ev, "props")                 # reads every row's JSON text
    return ev.select("event_id", N.parse_json("props", schema).getField("k").cast("bigint").alias("k"))


@register("I8_compaction_keeps_rows", oracle="SELECT * FROM lineitem")
def i8(spark, d):
    li = t(spark, d, "lineitem")
    small = _dir(spark, "i8-small")
    li.repartition(64).write.parquet(small)                   # many small files
    out = _dir(spark, "i8-compacted")
    L.compact(spark, small, out)
    return spark.read.parquet(out)


@register("I8i_incremental_compaction", oracle="SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def i8i(spark, d):
    """A table by priority with one large write and three appends of many
    small files: only the small files are read and packed."""
    from tidepool.sources.partitions import PartitionStore
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    store = PartitionStore(spark, _dir(spark, "i8i-orders"), "o_orderpriority")
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(10))
    store.replace(o.where(part < 7).repartition("o_orderpriority"))
    for i in (7, 8, 9):
        store.append(o.where(part == i).repartition(8))
    large = store.files().agg(F.max("size")).first()[0]
    store.compact(target_bytes=large, small_bytes=large // 2)
    return store.read().select(*o.columns)


@register("I9_zorder_write_keeps_rows", oracle="SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def i9(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    path = _dir(spark, "i9-z")
    L.zorder_write(o, ["o_custkey", "o_orderdate"], L.n_files(o), path)
    return spark.read.parquet(path)


@register("I10_cluster_write_keeps_rows", oracle="SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def i10(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = _dir(spark, "i10-cluster")
    L.cluster_write(o, ["o_custkey"], L.n_files(o), path)
    return spark.read.parquet(path)


@register("I11_layout_report", oracle="""
SELECT COUNT(*) AS n_rows, MIN(o_custkey) AS min_o_custkey, MAX(o_custkey) AS max_o_custkey,
       MIN(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))) AS min_day,
       MAX(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))) AS max_day FROM orders
""")
def i11(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey",
                                     F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).alias("day"))
    path = _dir(spark, "i11-z")
    L.zorder_write(o, ["o_custkey", "day"], L.n_files(o), path)
    report = L.layout_report(spark, path, ["o_custkey", "day"])      # one row per file: summed up, it is the table
    return report.agg(F.sum("rows").alias("n_rows"), F.min("min_o_custkey").alias("min_o_custkey"),
                      F.max("max_o_custkey").alias("max_o_custkey"), F.min("min_day").cast("bigint").alias("min_day"),
                      F.max("max_day").cast("bigint").alias("max_day"))


@register("K4_quarantine_write", oracle=f"""
SELECT order_id, customer_id, amount, status, order_date,
       CASE WHEN {ERR_OK} THEN NULL ELSE {REASON} END AS fail_reason, {ERR_OK} AS passed
FROM {FLAGGED_SQL} f
""")
def k4(spark, d):
    from tidepool.plans.cat_quality import CHECKS, flagged
    base = scratch_path(spark, "k4")
    Q.write_results(flagged(spark, d), CHECKS, base + "/clean", base + "/quarantine", "2024-02-01 00:00:00")
    # both sides: every row is on one of them
    bad = spark.read.parquet(base + "/quarantine").drop("quarantine_ts").withColumn("passed", F.lit(False))
    good = spark.read.parquet(base + "/clean").withColumn("fail_reason", F.lit(None).cast("string")).withColumn("passed", F.lit(True))
    return bad.unionByName(good)


@register("K6_monitoring_table_append", oracle=metrics_sql(f"TIMESTAMP '{RUN_TS}'"))
def k6(spark, d):
    from tidepool.plans.cat_quality import CHECKS, TABLE, flagged
    path = _dir(spark, "k6-monitoring")
    Q.log_metrics(Q.metrics(flagged(spark, d), CHECKS, TABLE, run_ts=RUN_TS), path)
    return spark.read.parquet(path)


@register("J9_run_for_one_date", oracle=f"SELECT * FROM {gold_sql(silver_sql(RAW_SQL, T2))} g")
def j9(spark, d):
    """Gold partitioned by day; a rerun for one date replaces only that
    date's partition (twice, to show the rerun is idempotent)."""
    from tidepool.plans import medallion as M
    from tidepool.plans.cat_medallion import raw_all
    gold = M.to_gold(M.to_silver(M.to_bronze(raw_all(spark, d), T2), T2))
    path = _dir(spark, "j9-gold")
    gold.write.partitionBy("order_date").parquet(path)
    day = "2024-01-15"
    one = M.to_gold(M.to_silver(M.to_bronze(raw_all(spark, d).filter(F.substring("event_ts", 1, 10) == day), T2), T2))
    for _ in range(2):
        IO.overwrite_partitions(one, path, "order_date")
    back = spark.read.parquet(path)
    return back.select(*gold.columns)


def _j4_oracle():
    from tidepool.plans import registry
    from tidepool.plans import cat_medallion  # noqa: F401  (registers J4)
    return registry._ORACLES["J4_silver_upsert"]


@register("J4b_silver_upsert_touched_partitions", oracle=_j4_oracle())
def j4b(spark, d):
    """J4 on a Silver table partitioned by order date: the upsert reads and
    rewrites only the partitions the new Silver rows fall in, and publishes
    them in one step."""
    from tidepool.plans.cat_medallion import silver_all, silver_batch1
    from tidepool.sources.partitions import PartitionStore, upsert_store
    store = PartitionStore(spark, _dir(spark, "j4b-silver"), "order_date")
    store.replace(silver_batch1(spark, d))
    upsert_store(store, silver_all(spark, d), "order_id", update_cols=["status", "ingested_at"])
    return store.read().select(*silver_all(spark, d).columns)


@register("J4p_silver_upsert_overwritten_partitions", oracle=_j4_oracle())
def j4p(spark, d):
    """The same on a plain partitioned folder, by dynamic partition overwrite."""
    from tidepool.operators.changes import upsert_partitions
    from tidepool.plans.cat_medallion import silver_all, silver_batch1
    path = _dir(spark, "j4p-silver")
    silver_batch1(spark, d).write.partitionBy("order_date").parquet(path)
    upsert_partitions(spark, path, silver_all(spark, d), "order_id", "order_date",
                      update_cols=["status", "ingested_at"])
    return spark.read.parquet(path).select(*silver_all(spark, d).columns)
