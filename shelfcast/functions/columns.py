"""Built-in column expressions; nothing here needs a Python worker."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date formats in order of precedence, holiday spellings.
DATE_FORMATS = ("dd/MM/yyyy", "yyyy-MM-dd", "MM/dd/yyyy")
HOLIDAY_TEXTS = ("TRUE", "1", "Y")

MONEY = "decimal(18,2)"
FINE_MONEY = "decimal(18,6)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _may_be(text: Column, fmt: str) -> Column:
    """Whether the digits, separators and month of a text allow the format; it may still not parse."""
    shape = fmt.replace("yyyy", "[+-]?[0-9]{4,}").replace("MM", "(?:0[1-9]|1[0-2])").replace("dd", "[0-9]{2}")
    return text.rlike(f"^{shape}$")


def parse_mixed_date(text: Column | str) -> Column:
    """First format that parses wins, so ambiguous dates are day-first.

    A failed parse raises and catches an exception, which costs far more than the parse itself, so
    only formats that a text can have are tried on it.
    """
    trimmed = F.trim(_col(text))
    return F.coalesce(*[F.when(_may_be(trimmed, fmt), F.try_to_date(trimmed, fmt)) for fmt in DATE_FORMATS])


def number_or_zero(value: Column | str) -> Column:
    """Text such as ``NA`` and nulls count as 0."""
    return F.coalesce(_col(value).try_cast("double"), F.lit(0.0))


def total_of(columns: list[str]) -> Column:
    return reduce(add, [number_or_zero(c) for c in columns], F.lit(0.0))


def holiday_flag(text: Column | str, accepted: tuple[str, ...] = HOLIDAY_TEXTS) -> Column:
    """1 for an accepted spelling in any case, else 0 (also for null)."""
    matches = F.upper(_col(text).cast("string")).isin(*accepted)
    return F.when(matches, 1).otherwise(0)


def cents(value: Column | str) -> Column:
    return F.floor(_col(value) * 100 + 0.5)


def exact_sum(value: Column | str, weight: Column | int = 1) -> Column:
    """Sum of money in whole cents, so the result does not depend on partitioning.

    64 bits hold 9e16 units of money; beyond that the sum raises instead of wrapping.
    """
    return F.sum(cents(value) * weight) / 100


def fine_sum(value: Column | str) -> Column:
    """The same for values with fractions of a cent, in decimals."""
    return F.sum(_col(value).cast(FINE_MONEY)).cast("double")


def week_friday(moment: Column | str) -> Column:
    """Friday of the ISO week that holds the date, by plain day arithmetic."""
    day = _col(moment).cast("date")
    return F.date_add(day, 4 - F.weekday(day))


def is_friday(date: Column | str) -> Column:
    return F.dayofweek(_col(date)) == 6


def per_unit(amount: Column, size: Column) -> Column:
    """Amount by size where the size is positive, else null."""
    return F.when(size > 0, amount / size)


def percent_change(new: Column, old: Column) -> Column:
    """Change in percent of a positive base, else null."""
    return F.when(old > 0, (new - old) / old * 100)


def calendar(date: Column | str) -> dict[str, Column]:
    """Calendar fields; weeks are ISO, days run from 1 (Sunday) to 7 (Saturday)."""
    d = _col(date)
    return {
        "day_of_week": F.dayofweek(d),
        "week": F.weekofyear(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "is_weekend": F.when(F.dayofweek(d).isin(1, 7), 1).otherwise(0),
    }
