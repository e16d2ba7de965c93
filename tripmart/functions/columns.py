"""Column expressions of the curated layer.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen.
Narrowing casts use ``try_cast``: out-of-range values become NULL under
both ANSI and non-ANSI settings instead of failing the job.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.schemas import FARE_CHARGES, FLAG_YES, MONEY


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount(c: str | Column) -> Column:
    """Null-safe working value of a money/distance column: a double, 0.0 for null.

    Decimal input is widened to double first, so every source type takes
    the same rounding path afterwards.
    """
    return F.coalesce(as_column(c).try_cast("double"), F.lit(0.0))


def to_money(c: Column) -> Column:
    """Round a double once to decimal(10,2), HALF_UP; NULL when out of range."""
    return c.try_cast(MONEY)


def money(c: str | Column) -> Column:
    """``amount`` rounded to decimal(10,2)."""
    return to_money(amount(c))


def flag(c: str | Column) -> Column:
    """'Y' -> true; anything else, including NULL, -> false."""
    return F.coalesce(as_column(c) == F.lit(FLAG_YES), F.lit(False))


def charges_sum(cbd_fee: Column | None = None, with_tips: bool = False) -> Column:
    """Unrounded sum of the fare charges, added left to right as doubles.

    ``cbd_fee`` stands in for the congestion-zone fee term (0.0 unless
    the caller reads it from the source).
    """
    terms = [amount(c) for c in FARE_CHARGES]
    terms.append(F.lit(0.0) if cbd_fee is None else cbd_fee)
    if with_tips:
        terms.append(amount("tips"))
    return reduce(add, terms)


def minutes(seconds: str | Column) -> Column:
    return to_money(as_column(seconds) / F.lit(60.0))


def speed_mph(miles: str | Column, seconds: str | Column) -> Column:
    """Miles per hour; NULL for NULL miles and for NULL, zero or negative time."""
    s = as_column(seconds)
    m = as_column(miles).try_cast("double")
    return to_money(F.when(s > 0, m / (s / F.lit(3600.0))))


def positive_fee(c: str | Column) -> Column:
    """True when the unrounded, null-safe fee is above zero."""
    return amount(c) > 0


# --- fixed values: English weekday names in ``dayofweek`` order (1 = Sunday) ---
WEEKDAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
UNKNOWN_WEEKDAY = "Unknown"


def weekday_name(ts: str | Column) -> Column:
    """English weekday name of a timestamp; 'Unknown' when it is NULL.

    A lookup in a literal array by ``dayofweek``: no per-row formatter.
    The NULL case is decided before the lookup (an index that is NULL must
    never reach ``element_at``, where a negative index counts from the end).
    """
    t = as_column(ts)
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.when(t.isNull(), F.lit(UNKNOWN_WEEKDAY)).otherwise(F.element_at(names, F.dayofweek(t)))


def is_weekend(ts: str | Column) -> Column:
    """Saturday or Sunday (dayofweek 7 or 1); false when NULL."""
    return F.coalesce(F.dayofweek(as_column(ts)).isin(1, 7), F.lit(False))
