"""Money, percentages and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martpulse.constants import AGE_OLD_FROM, AGE_YOUNG_BELOW, BAND_COUNT, BAND_WIDTH

MONEY = "decimal(18,2)"


def money_sum(amount: Column) -> Column:
    """Sum of amounts in whole cents: the same for every order of addition and exact beyond 2**53 cents.

    Amounts that are no money (NaN, or of more digits than MONEY holds) are left out instead of failing the sum; the
    feeds set such rows aside (``sources.feeds.rejected``).
    """
    return F.sum(amount.try_cast(MONEY)).cast("double")


def percent(part: Column, total: Column) -> Column:
    """Percentage with one decimal, halves up; 0 when there is nothing."""
    return F.coalesce(F.floor(F.try_divide(part * F.lit(1000.0), total) + 0.5) / 10, F.lit(0.0))


def rest(*shares: Column) -> Column:
    """What the given percentages leave of 100."""
    left = F.lit(100.0)
    for share in shares:
        left = left - share
    return F.round(left, 1)


def is_young(age: Column) -> Column:
    return age < AGE_YOUNG_BELOW


def is_old(age: Column) -> Column:
    return age >= AGE_OLD_FROM


def colour_band(value: Column) -> Column:
    """Band 0 to 5 by hundreds; everything above stays in the last."""
    return F.least(F.floor(value / BAND_WIDTH), F.lit(BAND_COUNT - 1)).cast("int")
