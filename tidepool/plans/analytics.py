"""Analytics queries (L1-L16) as functions over reference-shaped frames.

Inputs follow the reference's analytics project: ``orders(order_id,
customer_id, amount, order_date, channel, status)``, ``customers``,
``products(product_id, category)``.  Money is summed as an exact decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.operators.windows import top_k_dense
from tidepool.plans.common import MONEY, dbl


def q_top_customers(orders: DataFrame, k: int = 10) -> DataFrame:
    """L1: customers whose completed revenue is among the k largest values
    (DENSE_RANK, ties kept), with order counts."""
    per_customer = (orders.where(F.col("status") == "completed")
                    .groupBy("customer_id")
                    .agg(F.sum(F.col("amount").cast(MONEY)).alias("_rev"),
                         F.count_distinct("order_id").alias("total_orders")))
    ranked = top_k_dense(per_customer, "_rev", k, rank_col="revenue_rank")
    return ranked.select("customer_id", dbl("_rev").alias("total_revenue"), "total_orders",
                         F.col("revenue_rank").cast("bigint").alias("revenue_rank"))


def _month(c):
    return F.trunc(F.col(c), "month")


def q_mom_growth(orders: DataFrame) -> DataFrame:
    """L2: monthly revenue, previous month, growth % (NULLIF guards /0).
    The window is over one row per month, so its single task is small."""
    monthly = orders.groupBy(_month("order_date").alias("month")).agg(
        F.sum(F.col("amount").cast(MONEY)).alias("_rev"))
    w = Window.orderBy("month")
    rev = dbl("_rev")
    prev = F.lag(rev).over(w)
    return monthly.select("month", rev.alias("revenue"), prev.alias("prev_revenue"),
                          (F.round((rev - prev) / F.nullif(prev, F.lit(0.0)) * 100, 1) + F.lit(0.0))
                          .alias("growth_pct"))


def customer_cohorts(orders: DataFrame) -> DataFrame:
    """Cohort = month of each customer's first order."""
    return orders.groupBy("customer_id").agg(F.min(_month("order_date")).alias("cohort_month"))


def q_cohort_retention(orders: DataFrame, cohorts: DataFrame) -> DataFrame:
    """L3: share of each cohort ordering n months after its cohort month.
    The months filter is applied after the alias exists (outer query)."""
    co = (orders.join(cohorts, "customer_id")
          .select("customer_id", "cohort_month",
                  F.floor(F.months_between(_month("order_date"), F.col("cohort_month"))).cast("int")
                  .alias("months_since_signup"))
          .filter(F.col("months_since_signup") >= 0))
    sizes = cohorts.groupBy("cohort_month").agg(F.count_distinct("customer_id").alias("cohort_size"))
    act = co.groupBy("cohort_month", "months_since_signup").agg(
        F.count_distinct("customer_id").alias("customers_active"))
    return (act.join(sizes, "cohort_month")
            .select("cohort_month", "months_since_signup", "customers_active", "cohort_size",
                    F.round(F.col("customers_active").cast("double") * 100 / F.col("cohort_size"), 1)
                    .alias("retention_pct")))


def q_cohort_first_value(orders: DataFrame) -> DataFrame:
    """L4: active customers per (cohort, months since acquisition) and the
    retention relative to month 0 via FIRST_VALUE over the aggregate."""
    cohorts = customer_cohorts(orders)
    act = (orders.join(cohorts, "customer_id")
           .withColumn("months_since_acquisition",
                       F.floor(F.months_between(_month("order_date"), F.col("cohort_month"))).cast("int"))
           .groupBy("cohort_month", "months_since_acquisition")
           .agg(F.count_distinct("customer_id").alias("active_customers")))
    w = Window.partitionBy("cohort_month").orderBy("months_since_acquisition")
    base = F.first("active_customers").over(w)
    return act.withColumn("retention_rate_pct",
                          F.round(F.col("active_customers").cast("double") * 100 / base, 1))


def q_channel_attribution(orders: DataFrame) -> DataFrame:
    """Monthly revenue per channel, running total per channel, share of
    the month's total."""
    cm = orders.groupBy("channel", _month("order_date").alias("month")).agg(
        F.sum(F.col("amount").cast(MONEY)).alias("_rev"))
    run = Window.partitionBy("channel").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    per_month = Window.partitionBy("month")
    return cm.select("channel", "month", dbl("_rev").alias("monthly_revenue"),
                     dbl(F.sum("_rev").over(run)).alias("running_total"),
                     F.round(dbl("_rev") / dbl(F.sum("_rev").over(per_month)) * 100, 1).alias("pct_of_monthly_total"))


def q_latest_order(orders: DataFrame) -> DataFrame:
    """Latest order per customer (date, then order id), via keep_latest."""
    from tidepool.operators.windows import keep_latest
    latest = keep_latest(orders.select("customer_id", "order_id", "order_date", "amount", "channel"),
                         "customer_id", ["order_date", "order_id"])
    return latest.select("customer_id", "order_id", "order_date", F.round("amount", 2).alias("amount"), "channel")


def in_domain(col: str, values) -> Column:
    """The column itself; a value outside ``values`` fails the job, so a
    pivot over them cannot lose rows without a word."""
    known = F.coalesce(F.col(col).isin(*values), F.lit(False))
    return F.when(known, F.col(col)).otherwise(
        F.raise_error(F.concat(F.lit(f"{col} outside the pivot's values: "), F.coalesce(F.col(col).cast("string"), F.lit("NULL")))))


def q_category_pivot(lines: DataFrame, categories) -> DataFrame:
    """Monthly revenue per category as columns (the caller's, case-
    sensitive; others are an error).  ``lines``: month, category, amount."""
    return (lines.withColumn("category", in_domain("category", categories))
            .groupBy("month").pivot("category", list(categories))
            .agg(dbl(F.sum(F.col("amount").cast(MONEY)))))


def q_cohort_matrix(orders: DataFrame, n_months: int | None = None) -> DataFrame:
    """Active customers per cohort, a column m0 .. per month since the
    first order.  The number of columns is the caller's (a month beyond it is
    an error) or comes from the data."""
    act = q_cohort_first_value(orders)
    if n_months is None:
        n_months = 1 + (act.agg(F.max("months_since_acquisition")).first()[0] or 0)
    months = list(range(n_months))
    wide = (act.withColumn("k", in_domain("months_since_acquisition", months))
            .groupBy("cohort_month").pivot("k", months).agg(F.max("active_customers")))
    return wide.withColumnsRenamed({str(k): f"m{k}" for k in months})


def q_ltv_segments(orders: DataFrame, customers: DataFrame, bands) -> DataFrame:
    """Lifetime value segments per country as a CTE chain of frames."""
    from tidepool.operators.shape import segment
    ltv = (orders.where(F.col("status") == "completed").groupBy("customer_id")
           .agg(F.sum(F.col("amount").cast(MONEY)).alias("total_spent"), F.count(F.lit(1)).alias("order_count"),
                F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order")))
    seg = ltv.withColumn("ltv_segment", segment(F.col("total_spent"), bands, "platinum"))
    enriched = customers.join(seg, "customer_id")
    return enriched.groupBy("ltv_segment", "country").agg(
        F.count(F.lit(1)).alias("customers"),
        (dbl(F.sum("total_spent")) / F.count(F.lit(1))).alias("avg_ltv"))


def q_quintile_summary(orders: DataFrame, as_of: str, churn_days: int = 365) -> DataFrame:
    """Customers in spend quintiles (NTILE(5) over total spend, computed
    without a single-task window); per quintile the median order value and
    the churn rate (no order in the last ``churn_days`` before ``as_of``)."""
    from tidepool.operators.windows import global_ntile
    per_c = orders.groupBy("customer_id").agg(
        F.sum(F.col("amount").cast(MONEY)).alias("spend"), F.max("order_date").alias("last_order"))
    q = global_ntile(per_c, ["spend", "customer_id"], 5, out="quintile")
    churned = F.col("last_order") <= F.date_sub(F.lit(as_of).cast("date"), churn_days)
    cust = q.select("customer_id", "quintile", churned.alias("churned"))
    per_q = cust.groupBy("quintile").agg(F.count(F.lit(1)).alias("customers"),
                                          (F.sum(F.when(F.col("churned"), 1).otherwise(0)).cast("double")
                                           / F.count(F.lit(1))).alias("churn_rate"))
    # 5 quintiles hold a fifth of all orders each: chunked exact median
    from tidepool.operators.skew import percentile_cont
    amounts = (orders.join(cust.select("customer_id", "quintile"), "customer_id")
               .select("quintile", F.col("amount").cast(MONEY).alias("amount")))
    med = percentile_cont(amounts, ["quintile"], "amount", 0.5, out="_m").select(
        "quintile", dbl(F.col("_m").cast("decimal(18,4)")).alias("median_order"))
    return per_q.join(med, "quintile")


def q_first_last_touch(orders: DataFrame) -> DataFrame:
    """Customer revenue credited to the first-touch and to the
    last-touch channel (``min_by`` / ``max_by`` over (date, id))."""
    per_c = orders.groupBy("customer_id").agg(
        F.min_by("channel", F.struct("order_date", "order_id")).alias("first_touch"),
        F.max_by("channel", F.struct("order_date", "order_id")).alias("last_touch"),
        F.sum(F.col("amount").cast(MONEY)).alias("rev"))
    first = per_c.groupBy(F.col("first_touch").alias("channel")).agg(F.sum("rev").alias("_r")) \
        .withColumn("model", F.lit("first_touch"))
    last = per_c.groupBy(F.col("last_touch").alias("channel")).agg(F.sum("rev").alias("_r")) \
        .withColumn("model", F.lit("last_touch"))
    return first.unionByName(last).select("model", "channel", dbl("_r").alias("revenue"))


def q_day_over_day(orders: DataFrame) -> DataFrame:
    """Daily revenue with previous / next day (default 0), change and
    % change.  One row per day, so the ordered window is small."""
    daily = orders.groupBy(F.col("order_date").alias("event_date")).agg(
        F.sum(F.col("amount").cast(MONEY)).alias("_rev"))
    w = Window.orderBy("event_date")
    rev = dbl("_rev")
    return daily.select(
        "event_date", rev.alias("daily_revenue"),
        F.lag(rev, 1, 0.0).over(w).alias("prev_day_revenue"),
        F.lead(rev, 1, 0.0).over(w).alias("next_day_revenue"),
        (rev - F.lag(rev, 1, 0.0).over(w)).alias("dod_change"),
        # + 0.0 turns a rounded -0.0 into 0.0
        (F.round((rev - F.lag(rev).over(w)) / F.nullif(F.lag(rev).over(w), F.lit(0.0)) * 100, 2) + F.lit(0.0))
        .alias("dod_pct_change"))


def q_cumulative_spend(orders: DataFrame) -> DataFrame:
    """Running spend per customer in order time."""
    w = (Window.partitionBy("customer_id").orderBy("order_date", "order_id")
         .rowsBetween(Window.unboundedPreceding, 0))
    return orders.select("order_id", "customer_id", "amount", "order_date",
                         dbl(F.sum(F.col("amount").cast(MONEY)).over(w)).alias("cumulative_spend"))
