"""Column expressions shared by the revenue and survey operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(9,4)"
#: Below this a double still has halves.
EXACT = 4.0e15


def half_up(x: Column, digits: int) -> Column:
    """Round a double at ``digits`` places, ties away from zero; the same arithmetic in any engine.

    Values too large to have such places, and infinities, stay as they are.
    """
    scale = float(10**digits)
    size = F.abs(x) * F.lit(scale)
    rounded = F.signum(x) * F.floor(size + F.lit(0.5)) / F.lit(scale) + F.lit(0.0)
    return F.when(size < F.lit(EXACT), rounded).otherwise(x)


def money(x: Column, digits: int = 2) -> Column:
    """Round an exact decimal sum and hand it out as a double."""
    return F.round(x, digits).cast("double")


def ratio(numerator: Column, denominator: Column, digits: int | None = None, scale: float = 1.0) -> Column:
    """``scale * numerator / denominator`` in doubles, null for a zero denominator."""
    x = F.try_divide(F.lit(scale) * numerator.cast("double"), denominator.cast("double"))
    return x if digits is None else half_up(x, digits)


def pct(part: Column, whole: Column, digits: int = 1) -> Column:
    return ratio(part, whole, digits, scale=100.0)


def mean_of(total: Column, n: Column, digits: int = 2) -> Column:
    return ratio(total, n, digits)


def net_revenue(total: str = "total", fee: str = "payment_fee") -> Column:
    """Amount kept after the fee; the fee is a rate and applies row by row."""
    return F.col(total) * (F.lit(1) - F.col(fee))


def fee_dollars(total: str = "total", fee: str = "payment_fee") -> Column:
    return F.col(total) * F.col(fee)


def month_start(date: str = "date") -> Column:
    return F.trunc(F.col(date), "month")


def month_number(date: str = "date") -> Column:
    return F.month(F.col(date))


def month_label(number: Column) -> Column:
    """Names for the three months of the published season, null for any other."""
    return F.when(number == 6, "June").when(number == 7, "July").when(number == 8, "August")


def month_name(date: str = "date") -> Column:
    return F.date_format(F.col(date), "MMMM")


def when_value(condition: Column, value: Column) -> Column:
    """``value`` where the condition holds, otherwise zero."""
    return F.when(condition, value).otherwise(F.lit(0))


def ordinal(column: str, order: Sequence[str]) -> Column:
    """Position (from 1) of a value in ``order``; null for anything else."""
    chain = F.lit(None).cast("int")
    for rank, value in reversed(list(enumerate(order, 1))):
        chain = F.when(F.col(column) == value, F.lit(rank)).otherwise(chain)
    return chain


def banded(score: Column, upper_bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first bound that is at least ``score``; the last label is open-ended."""
    if len(labels) != len(upper_bounds) + 1:
        raise ValueError("one more label than bounds is needed")
    chain = F.lit(labels[-1])
    for bound, label in reversed(list(zip(upper_bounds, labels))):
        chain = F.when(score <= bound, label).otherwise(chain)
    return F.when(score.isNotNull(), chain)
