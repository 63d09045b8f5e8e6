"""Declarative data-quality checks.

Checks are SQL predicates kept as data.  ``flag`` evaluates all of them in
one projection; a NULL result counts as a failure everywhere (so a row with
a NULL status is quarantined, not lost between the pass and fail sides).
Metrics for every check -- and for every run when ``by`` is given -- come
from ONE aggregate, unpivoted with ``stack``, instead of one count job per
check.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampType)

from tidepool.operators.range_frames import range_sums
from tidepool.functions.scalar import int_div


class DataQualityError(RuntimeError):
    pass


class Check(NamedTuple):
    """A named SQL predicate; a row must pass those of severity ERROR."""
    name: str
    predicate: str
    severity: str


def order_checks(as_of: str) -> list[Check]:
    """Order checks.  The "not in the future" date is the run's ``as_of``
    date passed in, not ``current_date()``."""
    # Names, predicates, severities and the status domain.
    return [
        Check("amount_not_null", "amount IS NOT NULL", "ERROR"),
        Check("amount_positive", "amount > 0", "ERROR"),
        Check("valid_status", "status IN ('pending', 'completed', 'shipped', 'cancelled')", "ERROR"),
        Check("order_date_not_future", f"order_date <= DATE '{as_of}'", "WARNING"),
        Check("customer_id_not_null", "customer_id IS NOT NULL", "ERROR"),
    ]


# Severity weights of the reference's quality score.
SEVERITY_WEIGHTS = {"ERROR": 2, "WARNING": 1}

# Columns and types of the monitoring table.
MONITORING_SCHEMA = StructType([
    StructField("run_timestamp", TimestampType(), True),
    StructField("table_name", StringType(), True),
    StructField("check_name", StringType(), True),
    StructField("severity", StringType(), True),
    StructField("total_rows", LongType(), True),
    StructField("pass_count", LongType(), True),
    StructField("fail_count", LongType(), True),
    StructField("fail_pct", DoubleType(), True),
])


def pct_half_up(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num / den * 100, scale) with one exact HALF_UP rounding, for
    non-negative integer counts; NULL when den is 0."""
    unit = 10 ** scale
    n = num.cast("decimal(38,0)") * (100 * unit)
    d = den.cast("decimal(38,0)")
    q = int_div(n * 2 + d, d * 2)
    return F.when(den == 0, F.lit(None).cast("double")).otherwise((q / F.lit(unit)).cast("double"))


# K1 ---------------------------------------------------------------------------------------
def flag(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One boolean column per check; NULL predicate results become False."""
    return df.select("*", *[F.coalesce(F.expr(c.predicate), F.lit(False)).alias(c.name) for c in checks])


def _error_ok(checks: list[Check]) -> Column:
    errs = [F.col(c.name) for c in checks if c.severity == "ERROR"]
    ok = F.lit(True)
    for e in errs:
        ok = ok & e
    return ok


# K2 / K3 ----------------------------------------------------------------------------------
def evaluate(flagged: DataFrame, checks: list[Check]) -> tuple[DataFrame, DataFrame]:
    """(passing, failing) by the ERROR checks; together they hold every row."""
    ok = _error_ok(checks)
    return flagged.filter(ok), flagged.filter(~ok)


def fail_reason(checks: list[Check]) -> Column:
    """Names of every failed check (both severities), ', '-joined."""
    return F.array_join(F.array_compact(F.array(*[F.when(~F.col(c.name), F.lit(c.name)) for c in checks])), ", ")


def drop_flags(df: DataFrame, checks: list[Check]) -> DataFrame:
    return df.drop(*[c.name for c in checks])


# K4 ---------------------------------------------------------------------------------------
def write_results(flagged: DataFrame, checks: list[Check], target_path: str, quarantine_path: str,
                  quarantine_ts) -> dict[str, int]:
    """Append passing rows to the target and failing rows (with reason and
    time) to quarantine, from one persisted flagged frame: the source is
    scanned once for both writes.  Row counts are observed while writing
    (``Observation``), so no extra count jobs run; returns them."""
    from pyspark import StorageLevel
    from pyspark.sql import Observation
    cached = flagged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        passing, failing = evaluate(cached, checks)
        obs_pass, obs_fail = Observation("dq_passed"), Observation("dq_quarantined")
        (drop_flags(passing, checks).observe(obs_pass, F.count(F.lit(1)).alias("rows"))
         .write.mode("append").parquet(target_path))
        (drop_flags(failing.withColumn("fail_reason", fail_reason(checks)), checks)
         .withColumn("quarantine_ts", F.lit(str(quarantine_ts)).cast("timestamp"))
         .observe(obs_fail, F.count(F.lit(1)).alias("rows"))
         .write.mode("append").parquet(quarantine_path))
        return {"passed": int(obs_pass.get["rows"]), "quarantined": int(obs_fail.get["rows"])}
    finally:
        cached.unpersist()


# K5 ---------------------------------------------------------------------------------------
def metrics(flagged: DataFrame, checks: list[Check], table_name: str, run_ts=None, by=None) -> DataFrame:
    """Per-check totals as monitoring rows.  ``by`` names a column that
    splits the frame into runs (its value becomes ``run_timestamp``);
    otherwise ``run_ts`` is stamped on a single run."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.sum(F.when(F.col(c.name), 1).otherwise(0)).cast("bigint").alias(f"_p{i}") for i, c in enumerate(checks)]
    if by:
        wide = flagged.groupBy(F.col(by).cast("timestamp").alias("run_timestamp")).agg(*aggs)
    else:
        wide = flagged.agg(*aggs).withColumn("run_timestamp", F.lit(str(run_ts)).cast("timestamp"))
    pairs = ", ".join(f"'{c.name}', '{c.severity}', _p{i}" for i, c in enumerate(checks))
    long = wide.select("run_timestamp", "_total",
                       F.expr(f"stack({len(checks)}, {pairs}) AS (check_name, severity, pass_count)"))
    return long.select(
        "run_timestamp", F.lit(table_name).alias("table_name"), "check_name", "severity",
        F.col("_total").cast("bigint").alias("total_rows"), F.col("pass_count").cast("bigint").alias("pass_count"),
        (F.col("_total") - F.col("pass_count")).cast("bigint").alias("fail_count"),
        F.coalesce(pct_half_up(F.col("_total") - F.col("pass_count"), F.col("_total")), F.lit(0.0)).alias("fail_pct"))


# K6 ---------------------------------------------------------------------------------------
def log_metrics(metrics_df: DataFrame, path: str) -> None:
    """Append to the monitoring table with its explicit schema."""
    metrics_df.select(*[F.col(f.name).cast(f.dataType) for f in MONITORING_SCHEMA.fields]) \
        .write.mode("append").parquet(path)


# K7 ---------------------------------------------------------------------------------------
def quality_score(metrics_df: DataFrame, weights: dict | None = None) -> DataFrame:
    """Per run: sum(w * pass) / sum(w * total) * 100, rounded to 1 place."""
    weights = weights or SEVERITY_WEIGHTS
    w = F.lit(0)
    for sev, wt in weights.items():
        w = F.when(F.col("severity") == sev, F.lit(wt)).otherwise(w)
    g = metrics_df.groupBy("run_timestamp", "table_name").agg(
        F.sum(w * F.col("pass_count")).alias("_wp"), F.sum(w * F.col("total_rows")).alias("_wt"))
    return g.select("run_timestamp", "table_name",
                    F.coalesce(pct_half_up(F.col("_wp"), F.col("_wt"), 1), F.lit(0.0)).alias("quality_score"))


# K9 / K10 -------------------------------------------------------------------------------
def pass_rate_per_run(metrics_df: DataFrame) -> DataFrame:
    g = metrics_df.groupBy("run_timestamp", "table_name").agg(
        F.sum("pass_count").alias("passed"), F.sum("total_rows").alias("checked"))
    return g.select("run_timestamp", "table_name", "passed", "checked",
                    pct_half_up(F.col("passed"), F.col("checked")).alias("pass_pct"))


def worst_checks(metrics_df: DataFrame) -> DataFrame:
    """Average and worst fail % per check, worst first.  The average is
    exact: fail_pct values are summed as decimals."""
    from tidepool.functions.scalar import exact_avg
    g = metrics_df.groupBy("check_name", "severity").agg(
        exact_avg(F.col("fail_pct").cast("decimal(10,2)"), 4).cast("double").alias("avg_fail_pct"),
        F.max("fail_pct").alias("max_fail_pct"), F.count(F.lit(1)).alias("runs"))
    return g.orderBy(F.col("avg_fail_pct").desc(), "check_name")


# K11 --------------------------------------------------------------------------------------
def threshold_breaches(metrics_df: DataFrame, threshold_pct: float, severities=("ERROR",),
                       per_check: dict[str, float] | None = None) -> DataFrame:
    """Metric rows of the given severities that fail more than
    ``threshold_pct`` percent of rows, or more than the check's own threshold
    in ``per_check``."""
    limit = F.lit(float(threshold_pct))
    for name, own in (per_check or {}).items():
        limit = F.when(F.col("check_name") == name, F.lit(float(own))).otherwise(limit)
    return metrics_df.filter(F.col("severity").isin(*severities) & (F.col("fail_pct") > limit))


def assert_thresholds(metrics_df: DataFrame, threshold_pct: float, severities=("ERROR",),
                      per_check: dict[str, float] | None = None) -> None:
    """Raise DataQualityError when any check of the given severities fails
    more than ``threshold_pct`` percent of rows; names their number and the
    first five."""
    bad = threshold_breaches(metrics_df, threshold_pct, severities, per_check)
    n = bad.count()
    if n:
        first = bad.select("run_timestamp", "check_name", "fail_pct").limit(5).collect()
        raise DataQualityError(f"{n} checks above their threshold ({threshold_pct}% unless named), among them: {[tuple(r) for r in first]}")


# K12 --------------------------------------------------------------------------------------
def schema_drift(raw: DataFrame, text_col: str, batch_col: str, expected: dict[str, str]) -> DataFrame:
    """Profile landed JSON rows against an expected contract, per batch.

    Every row's JSON text is parsed ONCE as ``map<string,string>`` and its
    keys exploded with ``posexplode_outer`` -- which also yields exactly one
    marker row per input row (position 0, or NULL for an empty / unparsable
    object), so row counts come from the same pass.  One aggregate per
    (batch, key) follows; everything after it works on that small table.
    Output rows ``(batch, key, kind, n)`` with kind ``present`` /
    ``missing`` (expected keys), ``extra`` (unexpected keys) and
    ``cast_failure`` (text that does not cast to the expected type); only
    non-zero counts are kept."""
    kv = raw.select(F.col(batch_col).alias("batch"),
                    F.posexplode_outer(F.from_json(F.col(text_col), "map<string,string>")).alias("pos", "key", "val"))
    bad_cast = F.lit(False)
    for k, typ in expected.items():
        bad_cast = F.when(F.col("key") == k, F.col("val").isNotNull() & F.col("val").try_cast(typ).isNull()) \
            .otherwise(bad_cast)
    first_of_row = F.col("pos").isNull() | (F.col("pos") == 0)
    per_key = kv.groupBy("batch", "key").agg(
        F.count("key").alias("present"),
        F.sum(F.when(first_of_row, 1).otherwise(0)).alias("_rows_part"),
        F.sum(F.when(bad_cast, 1).otherwise(0)).cast("bigint").alias("cast_failure"))
    # small from here on: one row per (batch, key).  Written once, so the
    # three outputs below do not each re-parse the JSON.
    from tidepool.session import materialize
    per_key = materialize(per_key, "drift-per-key")
    per_key = per_key.withColumn("rows", F.sum("_rows_part").over(Window.partitionBy("batch")))
    keys_seen = per_key.filter(F.col("key").isNotNull())
    is_expected = F.col("key").isin(*expected.keys())
    present = keys_seen.select("batch", "key",
                               F.when(is_expected, F.lit("present")).otherwise(F.lit("extra")).alias("kind"),
                               F.col("present").cast("bigint").alias("n"))
    casts = keys_seen.filter(is_expected).select("batch", "key", F.lit("cast_failure").alias("kind"),
                                                 F.col("cast_failure").alias("n"))
    batches = per_key.select("batch", "rows").distinct()
    grid = batches.select("batch", "rows", F.explode(F.array(*[F.lit(k) for k in expected])).alias("key"))
    missing = (grid.join(keys_seen.select("batch", "key", "present"), ["batch", "key"], "left")
               .select("batch", "key", F.lit("missing").alias("kind"),
                       (F.col("rows") - F.coalesce("present", F.lit(0))).cast("bigint").alias("n")))
    return present.unionByName(missing).unionByName(casts).filter(F.col("n") > 0)


def drift_metrics(drift: DataFrame, table: str, errors=("missing", "cast_failure")) -> DataFrame:
    """Drift rows of ``schema_drift`` as rows of the monitoring table, one
    check ``<kind>:<key>`` per batch, so that thresholds and alerts read them
    like any other check.  Kinds in ``errors`` are ERROR, the others WARNING.
    A batch has as many rows as an expected key is present or missing in."""
    n = F.sum("n").cast("bigint")
    rows = drift.where(F.col("kind").isin("present", "missing")).groupBy("batch", "key").agg(n.alias("_n"))
    rows = rows.groupBy("batch").agg(F.max("_n").alias("total_rows"))
    found = drift.where(F.col("kind") != "present").join(rows, "batch")
    return found.select(
        F.col("batch").cast("timestamp").alias("run_timestamp"), F.lit(table).alias("table_name"),
        F.concat_ws(":", "kind", "key").alias("check_name"),
        F.when(F.col("kind").isin(*errors), "ERROR").otherwise("WARNING").alias("severity"), "total_rows",
        (F.col("total_rows") - F.col("n")).alias("pass_count"), F.col("n").alias("fail_count"),
        pct_half_up(F.col("n"), F.col("total_rows")).alias("fail_pct"))


# K13 --------------------------------------------------------------------------------------
def rolling_fail_sla(metrics_df: DataFrame, days: int = 7, sla_pct: float = 5.0,
                     skew_safe: bool = False) -> DataFrame:
    """Per check and day: failures / rows over the trailing ``days`` calendar
    days (RANGE frame) and a flag when that share exceeds ``sla_pct``.
    ``skew_safe`` splits a check with very many days over tasks."""
    daily = metrics_df.groupBy("check_name", F.to_date("run_timestamp").alias("day")).agg(
        F.sum("fail_count").alias("fails"), F.sum("total_rows").alias("rows"))
    daily = daily.withColumn("_day", F.datediff(F.col("day"), F.lit("1970-01-01").cast("date")))
    if skew_safe:
        out = range_sums(daily, "check_name", "_day", days - 1, 0, {"fails_7d": "fails", "rows_7d": "rows"})
    else:
        w = Window.partitionBy("check_name").orderBy("_day").rangeBetween(-(days - 1), 0)
        out = daily.select("check_name", "day", F.sum("fails").over(w).alias("fails_7d"),
                           F.sum("rows").over(w).alias("rows_7d"))
    return out.select("check_name", "day", F.col("fails_7d").cast("bigint").alias("fails_7d"),
                      F.col("rows_7d").cast("bigint").alias("rows_7d"),
                      pct_half_up(F.col("fails_7d"), F.col("rows_7d")).alias("fail_pct_7d"),
                      (F.col("fails_7d") * 100 > F.col("rows_7d") * F.lit(sla_pct)).alias("sla_breach"))
