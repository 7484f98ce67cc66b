"""Cleaning, typing, keys and labels as JVM-side column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.domain import HOLIDAY, NON_HOLIDAY, REGIONS, UNKNOWN_REGION

# Money keeps nine decimals and 28 integer digits. One digit is left free: the sum of two amounts, and of
# any number of them, is a TOTAL with the same scale, where decimal(38,9) on both sides would drop a decimal.
MONEY = "decimal(37,9)"
TOTAL = "decimal(38,9)"
MEASURE = "decimal(18,9)"

# Unicode white space, so a trailing carriage return is trimmed like a blank.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def clean(name: str) -> Column:
    return F.btrim(F.col(name), F.lit(WHITESPACE))


def clean_upper(name: str) -> Column:
    return F.upper(clean(name))


def surrogate_key(*names: str) -> Column:
    """MD5 hex of the '-'-joined parts; NULL when any part is NULL."""
    parts: list[Column] = []
    for i, name in enumerate(names):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.col(name).cast("string"))
    return F.md5(F.concat(*parts) if len(parts) > 1 else parts[0])


def date_key(day: Column) -> Column:
    """Calendar date as the integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def region_of(state: Column, default: str | None = UNKNOWN_REGION) -> Column:
    """Region of a state code; ``default`` for every other value."""
    expr = None
    for region, states in REGIONS.items():
        test = state.isin(states)
        expr = F.when(test, region) if expr is None else expr.when(test, region)
    return expr.otherwise(F.lit(default))


def day_type(flag: str = "is_holiday") -> Column:
    return F.when(F.col(flag), HOLIDAY).when(~F.col(flag), NON_HOLIDAY)


def year_month(year: Column, month: Column) -> Column:
    return F.format_string("%04d-%02d", year, month)


def year_quarter(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def minus(a: Column, b: Column) -> Column:
    """Exact difference of two totals."""
    return a.cast(MONEY) - b.cast(MONEY)


def ratio(num: Column, den: Column, digits: int = 2, factor: int = 1) -> Column:
    """``factor * num / den`` rounded half up, exactly; NULL when den is 0. ``den`` is a count or a total, not negative.

    A decimal quotient would be rounded twice, so the whole part and the rest are taken apart:
    both are exact, and only the rest is rounded.
    """
    below = F.when(den != 0, den).cast("decimal(31,9)")
    size = F.abs(num.cast(TOTAL))
    rest = size % below
    whole = (minus(size, rest) / below).cast("decimal(32,0)")
    double = (rest.cast("decimal(31,9)") * F.lit(2 * factor * 10**digits) + below).cast("decimal(38,9)")
    part = F.call_function("div", double, (below * 2).cast("decimal(38,9)"))
    scaled = part.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))
    return (F.signum(num.cast(TOTAL)).cast("int") * (whole * factor + scaled)).cast(f"decimal(38,{digits})")


def in_months(year: Column, month: Column, start: tuple[int, int], end: tuple[int, int]) -> Column:
    """Whole-month window, both ends included."""
    index = year * 12 + month
    return index.between(start[0] * 12 + start[1], end[0] * 12 + end[1])


def keep_months(
    fact: DataFrame, start: tuple[int, int], end: tuple[int, int], key: str = "order_date_key"
) -> DataFrame:
    """The same window on the fact's own YYYYMMDD key, so that it reaches the scan.

    A fact read from month folders is also filtered by the folder, which skips files unopened.
    """
    low, high = start[0] * 100 + start[1], end[0] * 100 + end[1]
    kept = fact.filter(F.col(key).between(low * 100 + 1, high * 100 + 31))
    return kept.filter(F.col("month_key").between(low, high)) if "month_key" in fact.columns else kept
