"""Projection, filter and query-shape operators."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# B1 ---------------------------------------------------------------------------------------
def derive(df: DataFrame, drop=(), rename: dict | None = None, **exprs: Column) -> DataFrame:
    """Add / replace columns, drop some and rename others in one projection."""
    out = df.withColumns(exprs) if exprs else df
    if drop:
        out = out.drop(*drop)
    if rename:
        out = out.withColumnsRenamed(rename)
    return out


# B6 ---------------------------------------------------------------------------------------
def segment(value: Column, bands: list[tuple[float, str]], otherwise: str) -> Column:
    """CASE WHEN value < b1 THEN l1 WHEN value < b2 THEN l2 ... ELSE otherwise.

    ``bands`` are (upper bound exclusive, label) in ascending bound order."""
    expr = None
    for bound, label in bands:
        expr = (F.when(value < bound, F.lit(label)) if expr is None
                else expr.when(value < bound, F.lit(label)))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)


# B7 ---------------------------------------------------------------------------------------
def group_having(df: DataFrame, keys, aggs: list[Column], having: Column) -> DataFrame:
    """GROUP BY keys with aggregates, then HAVING on their aliases."""
    return df.groupBy(*([keys] if isinstance(keys, str) else keys)).agg(*aggs).filter(having)


# B10 --------------------------------------------------------------------------------------
_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}$")


class TableNotAllowed(ValueError):
    pass


def run_param(spark: SparkSession, sql: str, args: dict, table: str | None = None,
              allowed_tables=()) -> DataFrame:
    """Parameterised SQL: values go in as named parameters (never pasted into
    the text) and the one table name is checked against an allowlist, then
    bound with ``IDENTIFIER(:table)``."""
    params = dict(args)
    if table is not None:
        if table not in set(allowed_tables) or not _IDENT.match(table):
            raise TableNotAllowed(f"table {table!r} is not in the allowlist")
        params["table"] = table
    return spark.sql(sql, args=params)


def execute_immediate(spark: SparkSession, statement: str, args: dict | None = None) -> DataFrame:
    """EXECUTE IMMEDIATE with the statement text and every value bound as
    parameters (``USING :v AS name``), e.g. for a statement assembled from
    a config table.  Nothing is pasted into SQL text."""
    args = dict(args or {})
    for name in args:
        if not re.match(r"^[A-Za-z_][A-Za-z0-9_]*$", name):
            raise ValueError(f"bad parameter name {name!r}")
    using = ", ".join(f":__v_{n} AS {n}" for n in args)
    bound = {"__stmt": statement, **{f"__v_{n}": v for n, v in args.items()}}
    sql = "EXECUTE IMMEDIATE :__stmt" + (f" USING {using}" if using else "")
    return spark.sql(sql, args=bound)


# B11 --------------------------------------------------------------------------------------
def date_range_filter(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Sargable date filter ``lo <= col < hi`` with literal bounds.

    Written as a range on the bare column (not ``year(col) = y``) so the
    bounds reach the Parquet reader as pushed filters and row groups
    outside the range are skipped.  Bounds are cast to the column's type.
    """
    dtype = df.schema[col].dataType.simpleString()
    lo_l = F.lit(str(lo)).cast(dtype)
    hi_l = F.lit(str(hi)).cast(dtype)
    return df.filter((F.col(col) >= lo_l) & (F.col(col) < hi_l))


def year_bounds(year: int) -> tuple[_dt.date, _dt.date]:
    return _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1)


# B12 --------------------------------------------------------------------------------------
def filter_expr(df: DataFrame, predicate_sql: str) -> DataFrame:
    """A predicate kept as data (SQL text), evaluated JVM-side via ``expr``."""
    return df.filter(F.expr(predicate_sql))


# F1 / F2 ----------------------------------------------------------------------------------
def sort_by(df: DataFrame, *order: Column) -> DataFrame:
    """Global sort.  Null placement is stated explicitly in ``order``
    (``asc_nulls_last`` ...): engines differ in their defaults."""
    return df.orderBy(*order)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """ORDER BY ... LIMIT k: planned as TakeOrderedAndProject, i.e. a
    per-task top-k followed by a merge of k rows per task -- no full sort.
    Give a unique tie-break in ``order`` so the k rows are determined."""
    return df.orderBy(*order).limit(k)
