"""Schema contracts and generated inputs."""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SchemaContractError(ValueError):
    """Raised when a frame carries columns the contract does not allow."""


def enforce_schema(df: DataFrame, schema: StructType, allow_extra: bool = False,
                   reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Cast every contract field with ``try_cast`` and split the rows.

    Returns ``(accepted, rejected)``.  A row is rejected when a NOT NULL
    field is null after the cast -- either it was null, or the text did not
    parse (ANSI casts would raise instead; ``try_cast`` turns that into a
    null we can route).  ``rejected`` keeps the raw columns plus
    ``reject_reason`` naming every failed field.  Columns outside the
    contract raise unless ``allow_extra``.
    """
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra and not allow_extra:
        raise SchemaContractError(f"columns not in the contract: {extra}")
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise SchemaContractError(f"contract columns missing: {missing}")

    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    problems = []
    for f in schema.fields:
        raw = F.col(f.name)
        if not f.nullable:
            problems.append(F.when(typed[f.name].isNull(), F.lit(f"{f.name}:null_or_bad")))
        else:
            # nullable field: only a value that failed to parse is a problem
            problems.append(F.when(raw.isNotNull() & typed[f.name].isNull(),
                                   F.lit(f"{f.name}:bad_value")))
    reason = F.array_join(F.array_compact(F.array(*problems)), ", ")
    flagged = df.withColumn(reason_col, reason)
    ok = F.col(reason_col) == ""
    accepted = flagged.filter(ok).select(*[typed[f.name].alias(f.name) for f in schema.fields])
    rejected = flagged.filter(~ok)
    return accepted, rejected


def append_evolving(df: DataFrame, path: str, evolve: bool = True) -> None:
    """Append to a Parquet path whose schema may grow.

    New columns are allowed only with ``evolve``; old files simply lack
    them, and readers use ``read_evolving`` (``mergeSchema``) to see the
    union with nulls for missing values.
    """
    spark = df.sparkSession
    try:
        current = spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # only a missing table is a first write
            raise
        current = None
    if current is not None:
        new_cols = [c for c in df.columns if c not in current.fieldNames()]
        if new_cols and not evolve:
            raise SchemaContractError(f"unexpected columns {new_cols}; pass evolve=True")
        for f in current.fields:
            if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
                df = df.withColumn(f.name, F.col(f.name).cast(f.dataType))
    df.write.mode("append").parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def union_evolving(*dfs: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side becomes null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


# A16 --------------------------------------------------------------------------
def _u(seed: int, tag: str) -> Column:
    """Deterministic uniform [0, 1) per row id: a hash, not ``rand``, so a
    re-run task (or a lost executor) regenerates exactly the same value."""
    h = F.xxhash64(F.col("id"), F.lit(seed), F.lit(tag))
    return F.pmod(h, F.lit(1_000_003)).cast("double") / F.lit(1_000_003.0)


def make_orders(spark: SparkSession, n: int, bad_pct: float = 0.10, seed: int = 99,
                as_of: _dt.date | str = "2024-06-30", num_partitions: int | None = None) -> DataFrame:
    """Synthetic orders with injected faults, generated on the executors.

    Fixed fault mix (from the reference data-quality project): given a bad row,
    amount is null with p 0.4, status is invalid with p 0.3, the date is 30
    days ahead with p 0.3 and the customer is null with p 0.2, independently.
    """
    statuses = F.array(*[F.lit(s) for s in ("completed", "shipped", "pending", "cancelled")])
    bad = _u(seed, "bad") < bad_pct
    amount = F.when(bad & (_u(seed, "amt_null") < 0.4), F.lit(None).cast("double")).otherwise(
        F.round(F.lit(10.0) + _u(seed, "amt") * 490.0, 2))
    status = F.when(bad & (_u(seed, "st_bad") < 0.3), F.lit("INVALID_STATUS")).otherwise(
        F.element_at(statuses, (F.floor(_u(seed, "st") * 4) + 1).cast("int")))
    base = F.lit(str(as_of)).cast("date")
    order_date = F.when(bad & (_u(seed, "dt_bad") < 0.3), F.date_add(base, 30)).otherwise(
        F.date_sub(base, F.floor(_u(seed, "dt") * 91).cast("int")))
    cust = F.when(bad & (_u(seed, "cust_null") < 0.2), F.lit(None).cast("string")).otherwise(
        F.format_string("cust-%04d", (F.floor(_u(seed, "cust") * 50) + 1).cast("int")))
    return (spark.range(0, n, numPartitions=num_partitions)
            .select(F.format_string("ord-%06d", F.col("id")).alias("order_id"),
                    cust.alias("customer_id"), amount.alias("amount"),
                    status.alias("status"), order_date.alias("order_date")))
