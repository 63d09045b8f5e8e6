"""Registered queries: data-quality checks, metrics and monitoring.

Input rows come from ``orders`` with faults placed by order key: amount
NULL (key % 25 = 3) or negative (key % 60 = 13), an unknown status
(key % 40 = 7) or a NULL status (key % 97 = 5), a NULL customer
(key % 50 = 11).  Dates after the as-of date 2000-01-01 fail the WARNING
check.  Runs of the monitoring table are order days.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import quality as Q
from tidepool.plans.common import order_facts, t
from tidepool.plans.registry import register

AS_OF = "2000-01-01"
RUN_TS = "2024-02-01 00:00:00"
TABLE = "orders_dq"
CHECKS = Q.order_checks(AS_OF)


def dq_input(spark, d):
    o = order_facts(spark, d)
    k = F.col("order_id")
    return o.select(
        F.concat(F.lit("ord-"), k.cast("string")).alias("order_id"),
        F.when(k % 50 == 11, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("cust-"), F.col("customer_id").cast("string"))).alias("customer_id"),
        F.when(k % 25 == 3, F.lit(None).cast("double")).when(k % 60 == 13, -F.col("amount"))
         .otherwise(F.col("amount")).alias("amount"),
        F.when(k % 40 == 7, F.lit("INVALID_STATUS")).when(k % 97 == 5, F.lit(None).cast("string"))
         .otherwise(F.col("status")).alias("status"),
        "order_date")


def flagged(spark, d):
    return Q.flag(dq_input(spark, d), CHECKS)


def monitoring(spark, d):
    return Q.metrics(flagged(spark, d), CHECKS, TABLE, by="order_date")


# ---- SQL twins ---------------------------------------------------------------------------
DQ_SQL = """(
SELECT 'ord-' || CAST(o_orderkey AS VARCHAR) AS order_id,
       CASE WHEN o_orderkey % 50 = 11 THEN NULL ELSE 'cust-' || CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN o_orderkey % 25 = 3 THEN NULL WHEN o_orderkey % 60 = 13 THEN -o_totalprice ELSE o_totalprice END AS amount,
       CASE WHEN o_orderkey % 40 = 7 THEN 'INVALID_STATUS' WHEN o_orderkey % 97 = 5 THEN NULL
            ELSE CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'shipped' END
       END AS status,
       CAST(o_orderdate AS DATE) AS order_date
FROM orders)"""
FLAGS = ", ".join(f"COALESCE({c.predicate}, false) AS {c.name}" for c in CHECKS)
FLAGGED_SQL = f"(SELECT *, {FLAGS} FROM {DQ_SQL} x)"
ERR_OK = " AND ".join(c.name for c in CHECKS if c.severity == "ERROR")
REASON = "concat_ws(', ', " + ", ".join(f"CASE WHEN NOT {c.name} THEN '{c.name}' END" for c in CHECKS) + ")"


def pct_sql(num, den, scale=2):
    unit = 10 ** scale
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE ((2 * ({num}) * {100 * unit} + ({den})) // (2 * ({den}))) / {unit}.0 END)"


def metrics_sql(group_expr):
    sums = ", ".join(f"SUM(CASE WHEN {c.name} THEN 1 ELSE 0 END) AS p{i}" for i, c in enumerate(CHECKS))
    wide = f"(SELECT {group_expr} AS run_timestamp, COUNT(*) AS total, {sums} FROM {FLAGGED_SQL} f GROUP BY 1)"
    parts = [f"""SELECT run_timestamp, '{TABLE}' AS table_name, '{c.name}' AS check_name, '{c.severity}' AS severity,
       total AS total_rows, CAST(p{i} AS BIGINT) AS pass_count, CAST(total - p{i} AS BIGINT) AS fail_count,
       COALESCE({pct_sql(f'total - p{i}', 'total')}, 0.0) AS fail_pct FROM {wide} w{i}"""
             for i, c in enumerate(CHECKS)]
    return "(" + "\nUNION ALL\n".join(parts) + ")"


MON_SQL = metrics_sql("CAST(order_date AS TIMESTAMP)")


@register("K1_flag_checks", oracle=f"SELECT * FROM {FLAGGED_SQL} f")
def k1(spark, d):
    return flagged(spark, d)


@register("K2_pass_fail_split", oracle=f"""
SELECT order_id, CASE WHEN {ERR_OK} THEN 'pass' ELSE 'fail' END AS side FROM {FLAGGED_SQL} f
""")
def k2(spark, d):
    p, f = Q.evaluate(flagged(spark, d), CHECKS)
    return p.select("order_id", F.lit("pass").alias("side")).unionByName(
        f.select("order_id", F.lit("fail").alias("side")))


@register("K3_fail_reason", oracle=f"""
SELECT order_id, customer_id, amount, status, order_date, {REASON} AS fail_reason
FROM {FLAGGED_SQL} f WHERE NOT ({ERR_OK})
""")
def k3(spark, d):
    _, f = Q.evaluate(flagged(spark, d), CHECKS)
    return Q.drop_flags(f.withColumn("fail_reason", Q.fail_reason(CHECKS)), CHECKS)


@register("K5_check_metrics_one_run", oracle=metrics_sql(f"TIMESTAMP '{RUN_TS}'"))
def k5(spark, d):
    return Q.metrics(flagged(spark, d), CHECKS, TABLE, run_ts=RUN_TS)


@register("K5b_check_metrics_per_day", oracle=f"SELECT * FROM {MON_SQL} m")
def k5b(spark, d):
    return monitoring(spark, d)


@register("K7_quality_score", oracle=f"""
SELECT run_timestamp, table_name,
       COALESCE({pct_sql('SUM(CASE severity WHEN ' + "'ERROR'" + ' THEN 2 ELSE 1 END * pass_count)',
                         'SUM(CASE severity WHEN ' + "'ERROR'" + ' THEN 2 ELSE 1 END * total_rows)', 1)}, 0.0) AS quality_score
FROM {MON_SQL} m GROUP BY run_timestamp, table_name
""")
def k7(spark, d):
    return Q.quality_score(monitoring(spark, d))


@register("K8_failure_trend", oracle=f"""
SELECT check_name, run_timestamp, fail_pct FROM {MON_SQL} m ORDER BY check_name, run_timestamp
""")
def k8(spark, d):
    return monitoring(spark, d).select("check_name", "run_timestamp", "fail_pct").orderBy("check_name", "run_timestamp")


@register("K9_pass_rate_per_run", oracle=f"""
SELECT run_timestamp, table_name, SUM(pass_count) AS passed, SUM(total_rows) AS checked,
       {pct_sql('SUM(pass_count)', 'SUM(total_rows)')} AS pass_pct
FROM {MON_SQL} m GROUP BY run_timestamp, table_name
""")
def k9(spark, d):
    return Q.pass_rate_per_run(monitoring(spark, d)).withColumn("passed", F.col("passed").cast("bigint")) \
        .withColumn("checked", F.col("checked").cast("bigint"))


@register("K10_worst_checks", oracle=f"""
SELECT check_name, severity,
       CAST(sign(SUM(CAST(fail_pct AS DECIMAL(10,2)))) * ((2 * abs(CAST(SUM(CAST(fail_pct AS DECIMAL(10,2))) * 10000 AS BIGINT)) + COUNT(fail_pct))
            // (2 * COUNT(fail_pct))) / 10000.0 AS DOUBLE) AS avg_fail_pct,
       MAX(fail_pct) AS max_fail_pct, COUNT(*) AS runs
FROM {MON_SQL} m GROUP BY check_name, severity
""")
def k10(spark, d):
    return Q.worst_checks(monitoring(spark, d))


@register("K11_threshold_breaches", oracle=f"""
SELECT * FROM {MON_SQL} m WHERE severity = 'ERROR' AND fail_pct > 5
""")
def k11(spark, d):
    return Q.threshold_breaches(monitoring(spark, d), 5.0)


# thresholds that checks carry themselves; the others share one
OWN_THRESHOLDS = {"valid_status": 2.0, "amount_positive": 8.0}


@register("K11c_own_threshold_breaches", oracle=f"""
SELECT * FROM {MON_SQL} m WHERE severity = 'ERROR'
  AND fail_pct > CASE check_name WHEN 'valid_status' THEN 2 WHEN 'amount_positive' THEN 8 ELSE 5 END
""")
def k11c(spark, d):
    return Q.threshold_breaches(monitoring(spark, d), 5.0, per_check=OWN_THRESHOLDS)


# The landed-event contract the drift profile checks against.
EVENT_CONTRACT = {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "string",
                  "value": "double", "props": "string"}


def landed_events(spark, d):
    """Events as landed JSON text with drift: ``value`` missing on every
    25th id and the text 'oops' on every 40th; an unexpected
    ``extra_field`` on every 30th."""
    ev = t(spark, d, "events")
    i = F.col("event_id")
    value = F.when(i % 25 == 0, F.lit(None).cast("string")).when(i % 40 == 0, F.lit("oops")) \
        .otherwise(F.col("value").cast("string"))
    m = F.create_map(F.lit("event_id"), i.cast("string"),
                     F.lit("ts"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
                     F.lit("user_id"), F.col("user_id").cast("string"),
                     F.lit("event_type"), F.col("event_type"),
                     F.lit("value"), value,
                     F.lit("props"), F.col("props"),
                     F.lit("extra_field"), F.when(i % 30 == 0, F.lit("x")))
    return ev.select(F.to_date("ts").alias("batch"),
                     F.to_json(F.map_filter(m, lambda k, v: v.isNotNull())).alias("json"))


@register("K12_schema_drift_profile", oracle="""
WITH r AS (
  SELECT CAST(ts AS DATE) AS batch, COUNT(*) AS rows,
         COUNT(*) FILTER (WHERE event_id % 25 = 0) AS c25,
         COUNT(*) FILTER (WHERE event_id % 30 = 0) AS c30,
         COUNT(*) FILTER (WHERE event_id % 40 = 0 AND event_id % 25 <> 0) AS c40
  FROM events GROUP BY 1),
x AS (
  SELECT batch, v.k AS key, 'present' AS kind, rows AS n FROM r,
         (VALUES ('event_id'), ('ts'), ('user_id'), ('event_type'), ('props')) v(k)
  UNION ALL SELECT batch, 'value', 'present', rows - c25 FROM r
  UNION ALL SELECT batch, 'value', 'missing', c25 FROM r
  UNION ALL SELECT batch, 'extra_field', 'extra', c30 FROM r
  UNION ALL SELECT batch, 'value', 'cast_failure', c40 FROM r)
SELECT batch, key, kind, CAST(n AS BIGINT) AS n FROM x WHERE n > 0
""")
def k12(spark, d):
    return Q.schema_drift(landed_events(spark, d), "json", "batch", EVENT_CONTRACT)


@register("K12e_drift_as_checks", oracle=f"""
WITH r AS (
  SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS run_timestamp, COUNT(*) AS total,
         COUNT(*) FILTER (WHERE event_id % 25 = 0) AS c25,
         COUNT(*) FILTER (WHERE event_id % 30 = 0) AS c30,
         COUNT(*) FILTER (WHERE event_id % 40 = 0 AND event_id % 25 <> 0) AS c40
  FROM events GROUP BY 1),
x AS (
  SELECT run_timestamp, total, 'missing:value' AS check_name, 'ERROR' AS severity, c25 AS fails FROM r
  UNION ALL SELECT run_timestamp, total, 'extra:extra_field', 'WARNING', c30 FROM r
  UNION ALL SELECT run_timestamp, total, 'cast_failure:value', 'ERROR', c40 FROM r)
SELECT run_timestamp, 'landed_events' AS table_name, check_name, severity, total AS total_rows,
       total - fails AS pass_count, fails AS fail_count, {pct_sql('fails', 'total')} AS fail_pct,
       severity = 'ERROR' AND {pct_sql('fails', 'total')} > CASE check_name WHEN 'missing:value' THEN 4 ELSE 2 END AS breach
FROM x WHERE fails > 0
""")
def k12e(spark, d):
    # drift rows are checks like others: thresholds of their own, breaches marked
    m = Q.drift_metrics(Q.schema_drift(landed_events(spark, d), "json", "batch", EVENT_CONTRACT), "landed_events")
    over = Q.threshold_breaches(m, 2.0, per_check={"missing:value": 4.0}).select("run_timestamp", "check_name", F.lit(True).alias("_over"))
    return m.join(over, ["run_timestamp", "check_name"], "left").withColumn("breach", F.coalesce("_over", F.lit(False))).drop("_over")


SLA_SQL = f"""
WITH daily AS (SELECT check_name, CAST(run_timestamp AS DATE) AS day, SUM(fail_count) AS fails, SUM(total_rows) AS rows
               FROM {MON_SQL} m GROUP BY 1, 2),
w AS (SELECT check_name, day,
             SUM(fails) OVER (PARTITION BY check_name ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS f7,
             SUM(rows) OVER (PARTITION BY check_name ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS r7
      FROM daily)
SELECT check_name, day, CAST(f7 AS BIGINT) AS fails_7d, CAST(r7 AS BIGINT) AS rows_7d,
       {pct_sql('f7', 'r7')} AS fail_pct_7d, f7 * 100 > r7 * 5.0 AS sla_breach
FROM w
"""


@register("K13_rolling_fail_sla", oracle=SLA_SQL)
def k13(spark, d):
    return Q.rolling_fail_sla(monitoring(spark, d), 7, 5.0)


@register("K13s_rolling_fail_sla_split", oracle=SLA_SQL)
def k13s(spark, d):
    # five checks are five window tasks: running sums over chunks of days instead
    return Q.rolling_fail_sla(monitoring(spark, d), 7, 5.0, skew_safe=True)
