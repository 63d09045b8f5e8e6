"""Registered queries: the Bronze / Silver / Gold pipeline (J1-J8) over
order events derived from the ``events`` table.

Batch 1 holds the events of the first half of each day (event hour < 12),
batch 2 is the whole table re-delivered; the rerun must add only new ids.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators.changes import change_feed
from tidepool.plans import medallion as M
from tidepool.plans.common import t
from tidepool.plans.registry import register
from tidepool.session import materialize, scratch_path
from tidepool.sources.partitions import PartitionStore

T1 = "2024-02-01 00:00:00"
T2 = "2024-02-02 00:00:00"


def raw_all(spark, d):
    return M.raw_order_events(spark, t(spark, d, "events"), t(spark, d, "customer"),
                              t(spark, d, "nation"), t(spark, d, "region"))


def first_half(raw):
    return raw.filter(F.substring("event_ts", 12, 2) < "12")


def bronze_all(spark, d):
    return M.to_bronze(raw_all(spark, d), T1)


def silver_all(spark, d, ts=T2):
    return M.to_silver(bronze_all(spark, d), ts)


def silver_batch1(spark, d):
    return M.to_silver(M.to_bronze(first_half(raw_all(spark, d)), T1), T1)


# ---- SQL twins -------------------------------------------------------------------------
RAW_SQL = """(
SELECT CAST(e.event_id AS VARCHAR) AS event_id,
       'ord-' || CAST(e.user_id * 100 + day(e.ts) AS VARCHAR) AS order_id,
       'cust-' || CAST(e.user_id AS VARCHAR) AS customer_id,
       'prod-' || CAST(CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 10 AS VARCHAR) AS product_id,
       CAST(CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 5 + 1 AS VARCHAR) AS quantity,
       CASE WHEN e.event_id % 20 = 0 THEN NULL WHEN e.event_id % 20 = 10 THEN 'bad'
            ELSE CAST(e.value AS VARCHAR) END AS unit_price,
       CASE e.event_type WHEN 'purchase' THEN 'completed' WHEN 'click' THEN 'shipped'
            WHEN 'error' THEN 'cancelled' ELSE 'pending' END AS status,
       g.r_name AS region,
       strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS event_ts
FROM events e LEFT JOIN (
  SELECT c.c_custkey, r.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey) g ON g.c_custkey = e.user_id)"""


def bronze_sql(raw):
    return f"(SELECT DISTINCT * FROM {raw} r)"


def latest_sql(bronze):
    return f"""(SELECT * FROM {bronze} b
  QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY event_ts DESC, CAST(event_id AS BIGINT) DESC) = 1)"""


REASON_SQL = """concat_ws(', ',
   CASE WHEN order_id IS NULL THEN 'order_id:null_or_bad' END,
   CASE WHEN customer_id IS NULL THEN 'customer_id:null_or_bad' END,
   CASE WHEN product_id IS NULL THEN 'product_id:null_or_bad' END,
   CASE WHEN TRY_CAST(quantity AS INTEGER) IS NULL THEN 'quantity:null_or_bad' END,
   CASE WHEN TRY_CAST(unit_price AS DECIMAL(10,2)) IS NULL THEN 'unit_price:null_or_bad' END,
   CASE WHEN status IS NULL THEN 'status:null_or_bad' END,
   CASE WHEN region IS NULL THEN 'region:null_or_bad' END,
   CASE WHEN TRY_CAST(event_ts AS TIMESTAMP) IS NULL THEN 'event_ts:null_or_bad' END)"""


def silver_sql(raw, ts):
    return f"""(SELECT order_id, customer_id, product_id, CAST(quantity AS INTEGER) AS quantity,
       CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(quantity AS INTEGER) * CAST(unit_price AS DECIMAL(10,2)) AS DECIMAL(10,2)) AS amount,
       status, region, CAST(CAST(event_ts AS TIMESTAMP) AS DATE) AS order_date,
       TIMESTAMP '{ts}' AS ingested_at
  FROM {latest_sql(bronze_sql(raw))} l WHERE {REASON_SQL} = '')"""


def gold_sql(silver):
    avg = ("CAST(CAST(sign(SUM(amount)) * ((2 * abs(CAST(SUM(amount) * 100 AS BIGINT)) + COUNT(amount))"
           " // (2 * COUNT(amount))) AS DECIMAL(18,0)) / 100 AS DECIMAL(10,2))")
    return f"""(SELECT order_date, product_id, region, COUNT(*) AS total_orders,
       CAST(SUM(amount) AS DECIMAL(14,2)) AS total_revenue, {avg} AS avg_order_value
  FROM {silver} s WHERE status IN ('completed', 'shipped') GROUP BY order_date, product_id, region)"""


RAW1_SQL = f"(SELECT * FROM {RAW_SQL} r WHERE substr(event_ts, 12, 2) < '12')"


@register("J1_bronze_dedup_stamp", oracle=f"""
SELECT *, TIMESTAMP '{T1}' AS ingestion_ts FROM {bronze_sql(RAW_SQL)} b
""")
def j1(spark, d):
    return bronze_all(spark, d)


@register("J2_bronze_rerun_adds_only_new", oracle=f"""
SELECT *, TIMESTAMP '{T2}' AS ingestion_ts FROM {bronze_sql(RAW_SQL)} b
WHERE event_id NOT IN (SELECT event_id FROM {RAW1_SQL} x)
""")
def j2(spark, d):
    existing = M.to_bronze(first_half(raw_all(spark, d)), T1)
    # only the existing days the batch covers take part in the anti join
    return M.to_bronze(raw_all(spark, d), T2, existing=existing, partition_of=M.event_day())


@register("J3_silver_latest_typed", oracle=f"SELECT * FROM {silver_sql(RAW_SQL, T2)} s")
def j3(spark, d):
    return silver_all(spark, d)


@register("J4_silver_upsert", oracle=f"""
SELECT COALESCE(t.order_id, s.order_id) AS order_id,
""" + ",\n".join(
    f"  CASE WHEN s.order_id IS NULL THEN t.{c} WHEN t.order_id IS NULL THEN s.{c} ELSE "
    f"{'s' if c in ('status', 'ingested_at') else 't'}.{c} END AS {c}"
    for c in M.SILVER_COLUMNS[1:]) + f"""
FROM {silver_sql(RAW1_SQL, T1)} t FULL JOIN {silver_sql(RAW_SQL, T2)} s ON t.order_id = s.order_id
""")
def j4(spark, d):
    return M.upsert_silver(silver_batch1(spark, d), silver_all(spark, d))


@register("J5_gold_daily_revenue", oracle=f"SELECT * FROM {gold_sql(silver_sql(RAW_SQL, T2))} g")
def j5(spark, d):
    return M.to_gold(silver_all(spark, d))


@register("J6_gold_upsert", oracle=f"""
SELECT * FROM {gold_sql(silver_sql(RAW1_SQL, T1))} t
WHERE (order_date, product_id, region) NOT IN (SELECT (order_date, product_id, region) FROM {gold_sql(silver_sql(RAW_SQL, T2))} x)
UNION ALL SELECT * FROM {gold_sql(silver_sql(RAW_SQL, T2))} s
""")
def j6(spark, d):
    return M.upsert_gold(M.to_gold(silver_batch1(spark, d)), M.to_gold(silver_all(spark, d)))


@register("J6f_gold_kept_from_change_feeds", oracle=f"SELECT * FROM {gold_sql(silver_sql(RAW_SQL, T2))} g")
def j6f(spark, d):
    """Gold of the first half days, then kept by the feeds of Silver to two
    later states, days with changes only; equal to Gold built anew."""
    raw, hour = raw_all(spark, d), F.substring("event_ts", 12, 2)
    states = [materialize(M.to_silver(M.to_bronze(raw.filter(hour < h), T1), T2), "silver-state") for h in ("12", "18", "24")]
    store = PartitionStore(spark, scratch_path(spark, "j6f-gold"), "order_date")
    store.replace(M.to_gold(states[0]))
    for before, after in zip(states, states[1:]):
        M.apply_to_gold_store(store, change_feed(before, after, "order_id"))
    return store.read()


@register("J7_layer_checks", oracle=f"""
SELECT 'bronze_rows' AS "check", COUNT(*) AS value FROM {bronze_sql(RAW_SQL)} b
UNION ALL SELECT 'silver_rows', COUNT(*) FROM {silver_sql(RAW_SQL, T2)} s
UNION ALL SELECT 'gold_rows', COUNT(*) FROM {gold_sql(silver_sql(RAW_SQL, T2))} g
UNION ALL SELECT 'silver_null_amount', COUNT(*) FILTER (WHERE amount IS NULL) FROM {silver_sql(RAW_SQL, T2)} s2
UNION ALL SELECT 'silver_status_' || coalesce(status, 'null'), COUNT(*) FROM {silver_sql(RAW_SQL, T2)} s3 GROUP BY 1
""")
def j7(spark, d):
    b = bronze_all(spark, d)
    s = silver_all(spark, d)
    return M.layer_checks(b, s, M.to_gold(s))


@register("J8_silver_rejects_with_reason", oracle=f"""
SELECT order_id, customer_id, unit_price, quantity, region, {REASON_SQL} AS reject_reason
FROM {latest_sql(bronze_sql(RAW_SQL))} l WHERE {REASON_SQL} <> ''
""")
def j8(spark, d):
    return M.silver_split(bronze_all(spark, d), T2)[1]
