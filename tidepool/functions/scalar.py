"""Scalar column helpers (H1-H9, M2).  All return built-in Column
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# H2 -------------------------------------------------------------------------------------
def csv_to_array(c, sep: str = ",") -> Column:
    """Split a delimited parameter column into a trimmed array."""
    return F.transform(F.split(_c(c), sep), lambda x: F.trim(x))


# H3 -------------------------------------------------------------------------------------
def month_start(c) -> Column:
    """First day of the month as a DATE (``date_trunc`` on timestamp_ntz
    would return a timestamp)."""
    return F.trunc(F.to_date(_c(c)), "month")


# H4 -------------------------------------------------------------------------------------
def whole_months_between(later, earlier) -> Column:
    """Whole calendar months from ``earlier`` to ``later`` (both taken as
    month starts), as INT."""
    return F.floor(F.months_between(month_start(later), month_start(earlier))).cast("int")


# H5 -------------------------------------------------------------------------------------
def text_to_date(c, fmt: str | None = None) -> Column:
    """String to timestamp to date; unparsable text gives NULL (not an error)."""
    ts = F.try_to_timestamp(_c(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(c))
    return F.to_date(ts)


# H6 -------------------------------------------------------------------------------------
def within_days_before(c, as_of: str, days: int) -> Column:
    """``as_of - days < c <= as_of`` on dates; ``as_of`` is passed in so a
    rerun computes the same rows (never ``current_date()``)."""
    d = F.to_date(_c(c))
    a = F.lit(as_of).cast("date")
    return (d > F.date_sub(a, days)) & (d <= a)


# H7 -------------------------------------------------------------------------------------
def safe_ratio(num, den) -> Column:
    """num / NULLIF(den, 0): NULL instead of an ANSI divide-by-zero error."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


# H8 -------------------------------------------------------------------------------------
def to_decimal(c, precision: int = 10, scale: int = 2) -> Column:
    """``try_cast`` to DECIMAL(p, s): bad text or overflow gives NULL."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


# H9 -------------------------------------------------------------------------------------
def hash_bucket(n: int, *cols) -> Column:
    """Stable bucket in [0, n): a hash of the row's columns instead of
    ``rand()``, so a retried task puts each row in the same bucket."""
    return F.pmod(F.xxhash64(*[_c(c) for c in cols]), F.lit(n)).cast("int")


# M2 -------------------------------------------------------------------------------------
# Fixed mask format (reference column-mask example): first two characters kept.
MASK_SUFFIX = "****@****.com"


def mask_email(c, allowed) -> Column:
    """Show the value when ``allowed`` (a bool or boolean Column), else the
    first two characters followed by the fixed mask."""
    allowed_c = allowed if isinstance(allowed, Column) else F.lit(bool(allowed))
    return F.when(allowed_c, _c(c)).otherwise(F.concat(F.left(_c(c), F.lit(2)), F.lit(MASK_SUFFIX)))


def exact_avg(c, scale: int = 2) -> Column:
    """AVG of a decimal column rounded HALF_UP to ``scale`` places, exactly.

    ``avg(decimal).cast(decimal(p, scale))`` rounds twice (first to the avg
    result scale, then to ``scale``); this sums whole units of 10^-scale and
    does one integer half-up division instead."""
    units = F.sum((_c(c) * (10 ** scale)).cast("decimal(38,0)"))
    return half_up_quotient(units, F.count(_c(c)).cast("decimal(38,0)"), scale)


def half_up_quotient(units: Column, n: Column, scale: int) -> Column:
    """``units`` of 10^-scale over ``n``, rounded HALF_UP to ``scale`` places
    (both DECIMAL(38,0))."""
    q = int_div(F.abs(units) * 2 + n, n * 2)
    return (F.signum(units).cast("decimal(38,0)") * q / F.lit(10 ** scale)).cast(f"decimal(38,{scale})")


def int_div(a: Column, b: Column) -> Column:
    """Exact integer division of non-negative integral decimals: the
    numerator is made a multiple of ``b`` first, so the quotient is whole."""
    return ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
