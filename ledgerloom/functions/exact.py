"""Exact money arithmetic.

Amounts arrive as doubles holding two decimals.  Adding doubles gives a result that depends on how
the rows were partitioned; adding decimals is exact but about five times slower.  Here an amount
becomes a whole number of cents in a ``long``, and sums are kept as two longs (high and low part), so
that they are exact, independent of row order, and cannot overflow below 2**43 rows per group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_BITS = 20
LOW_MASK = (1 << LOW_BITS) - 1
TIE_NUDGE = 1e-9


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents(amount: Column | str) -> Column:
    """The amount as whole cents."""
    return F.rint(as_column(amount) * 100).cast("long")


def from_cents(value: Column | str) -> Column:
    """Cents back to a money double."""
    return as_column(value).cast("double") / 100


def _join_halves(high: Column, low: Column) -> Column:
    whole = high.cast("decimal(38,0)") * F.lit(1 << LOW_BITS) + low
    return whole.cast("double") / 100


def split_sum(value: Column | str, name: str) -> list[Column]:
    """Partial exact sum of cents as two aggregates, ``NAME_high`` and ``NAME_low``."""
    value = as_column(value)
    return [
        F.sum(F.shiftright(value, LOW_BITS)).alias(f"{name}_high"),
        F.sum(value.bitwiseAND(LOW_MASK)).alias(f"{name}_low"),
    ]


def merge_split(name: str) -> list[Column]:
    """Add up partial sums made by :func:`split_sum` at a coarser level."""
    return [F.sum(f"{name}_{half}").alias(f"{name}_{half}") for half in ("high", "low")]


def split_money(name: str) -> Column:
    """The money double held by the two columns of :func:`split_sum`."""
    return _join_halves(F.col(f"{name}_high"), F.col(f"{name}_low"))


def merged_money(name: str) -> Column:
    """Aggregate partial sums straight to a money double."""
    return _join_halves(F.sum(f"{name}_high"), F.sum(f"{name}_low"))


def cents_sum(value: Column | str) -> Column:
    """Aggregate whole cents to an exact money double."""
    value = as_column(value)
    return _join_halves(F.sum(F.shiftright(value, LOW_BITS)), F.sum(value.bitwiseAND(LOW_MASK)))


def money_sum(amount: Column | str) -> Column:
    """Aggregate a money column to its exact total in one step."""
    return cents_sum(cents(amount))


def money_mean(amount: Column | str) -> Column:
    """Unrounded mean: exact total divided by the number of non-null amounts."""
    amount = as_column(amount)
    return money_sum(amount) / F.count(amount)


def half_up(value: Column | str, digits: int) -> Column:
    """Round half away from zero, reading a double one ulp below a tie as the tie.

    Plain double arithmetic inside generated code: ``round`` on a double goes through BigDecimal for
    each row.
    """
    value = as_column(value)
    scale = float(10**digits)
    return F.signum(value) * F.floor((F.abs(value) + TIE_NUDGE) * scale + 0.5) / scale


def change_pct(current: Column | str, previous: Column | str, digits: int = 2) -> Column:
    """Percentage change; null where the previous value is null or zero."""
    current, previous = as_column(current), as_column(previous)
    return half_up(F.try_divide(current - previous, previous) * 100, digits)
