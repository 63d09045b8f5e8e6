"""Registered queries: row and column policies (M1, M2) and profiling
reports (N1-N3).

Entitlements are derived from the region table: user ``<region>_analyst``
sees its region; ``global_analyst`` sees AMERICA and ASIA (two rows for one
user, the case a scalar-subquery filter gets wrong).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import policy as P
from tidepool.operators import profile as PR
from tidepool.operators.joins import join_dim
from tidepool.plans.common import t
from tidepool.plans.registry import register


def entitlements(spark, d):
    r = t(spark, d, "region").select(F.col("r_name").alias("region"))
    own = r.select(F.concat(F.lower("region"), F.lit("_analyst")).alias("user"), "region")
    glob = r.filter(F.col("region").isin("AMERICA", "ASIA")).select(F.lit("global_analyst").alias("user"), "region")
    return own.unionByName(glob)


def customers_with_region(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    n = t(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    r = t(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return join_dim(join_dim(c, n, "c_nationkey"), r, "n_regionkey").drop("c_nationkey", "n_regionkey")


CUST_REGION_SQL = """(SELECT c.c_custkey, c.c_name, c.c_acctbal, r.r_name AS region FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@register("M1_row_filter_two_regions", oracle=f"""
SELECT * FROM {CUST_REGION_SQL} x WHERE region IN ('AMERICA', 'ASIA')
""")
def m1(spark, d):
    return P.apply_row_filter(customers_with_region(spark, d), entitlements(spark, d), "global_analyst")


@register("M1b_row_filter_single_region", oracle=f"""
SELECT * FROM {CUST_REGION_SQL} x WHERE region = 'EUROPE'
""")
def m1b(spark, d):
    return P.apply_row_filter(customers_with_region(spark, d), entitlements(spark, d), "europe_analyst")


@register("M1c_row_filter_bypass_group", oracle=f"SELECT * FROM {CUST_REGION_SQL} x")
def m1c(spark, d):
    return P.apply_row_filter(customers_with_region(spark, d), entitlements(spark, d), "someone",
                              groups=["admins"])


EMAIL_SQL = "lower(replace(c_name, '#', '.')) || '@example.com'"


@register("M2_column_mask", oracle=f"""
SELECT c_custkey, CONCAT(LEFT({EMAIL_SQL}, 2), '****@****.com') AS email, {EMAIL_SQL} AS email_for_admin
FROM customer
""")
def m2(spark, d):
    c = t(spark, d, "customer").select(
        "c_custkey", F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"))
    c = c.withColumn("email_for_admin", F.col("email"))
    c = P.apply_mask(c, "email", P.viewer_allowed(["analysts"], ["admins"]))
    return P.apply_mask(c, "email_for_admin", P.viewer_allowed(["admins"], ["admins"]))


PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]


@register("N1_column_profile", oracle="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS nulls, "
    f"COUNT(DISTINCT {c}) AS n_distinct, CAST(MIN({c}) AS DOUBLE) + 0.0 AS min_value, CAST(MAX({c}) AS DOUBLE) + 0.0 AS max_value "
    f"FROM lineitem" for c in PROFILE_COLS))
def n1(spark, d):
    return PR.profile(t(spark, d, "lineitem"), PROFILE_COLS)


@register("N1b_column_profile_approx", oracle="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, COUNT(*) - COUNT({c}) AS nulls, true AS distinct_within, "
    f"CAST(MIN({c}) AS DOUBLE) + 0.0 AS min_value, CAST(MAX({c}) AS DOUBLE) + 0.0 AS max_value FROM lineitem" for c in PROFILE_COLS))
def n1b(spark, d):
    # the estimate as whether it lies within four standard errors (of 5%) of the exact count
    li = t(spark, d, "lineitem")
    exact = PR.profile(li, PROFILE_COLS).select("column_name", F.col("n_distinct").alias("_exact"))
    close = F.abs(F.col("n_distinct") - F.col("_exact")) <= 4 * 0.05 * F.col("_exact")
    return PR.profile(li, PROFILE_COLS, approx=True).join(exact, "column_name").select(
        "column_name", "non_null", "nulls", close.alias("distinct_within"), "min_value", "max_value")


@register("N2_skew_report", oracle="""
WITH c AS (SELECT l_suppkey, COUNT(*) AS cnt FROM lineitem GROUP BY l_suppkey),
s AS (SELECT SUM(cnt) AS total, quantile_cont(cnt, 0.5) AS med, COUNT(*) AS n_keys FROM c)
SELECT l_suppkey, cnt, cnt / total AS share, cnt / med AS ratio_to_median, n_keys
FROM (SELECT * FROM c ORDER BY cnt DESC, l_suppkey LIMIT 10) h, s
""")
def n2(spark, d):
    return PR.skew_report(t(spark, d, "lineitem"), "l_suppkey", 10)


ADVICE_COLS = ["l_returnflag", "l_linestatus", "l_suppkey", "l_partkey", "l_orderkey"]


@register("N3_partition_advice", oracle="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_values, COUNT(*) / COUNT(DISTINCT {c}) AS rows_per_value, "
    f"COUNT(DISTINCT {c}) < 10000 AND COUNT(*) / COUNT(DISTINCT {c}) >= 1000 AS advised FROM lineitem"
    for c in ADVICE_COLS))
def n3(spark, d):
    return PR.partition_advice(t(spark, d, "lineitem"), ADVICE_COLS, 10_000, 1000)
