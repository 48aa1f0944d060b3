"""Set operations and comparisons against a whole set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exact
from ledgerloom.operators.joins import above_group_mean


def common_values(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found in both; duplicates are dropped before the shuffle, not after."""
    return left.distinct().intersect(right.distinct())


def only_in_first(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` absent from ``right``."""
    return left.distinct().subtract(right.distinct())


_COMPARE = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def compare_quantified(df: DataFrame, value: Column, op: str, members: DataFrame, member: str, quantifier: str) -> DataFrame:
    """Rows for which ``value op ALL|ANY (members)`` is true, with SQL's rules for empty sets and nulls.

    One bound of the set decides the comparison, so the set is reduced to a single row first.
    """
    if quantifier not in ("all", "any"):
        raise ValueError("quantifier must be 'all' or 'any'")
    compare = _COMPARE[op]
    strict_side = (op in (">", ">=")) == (quantifier == "all")
    bound = members.agg((F.max if strict_side else F.min)(member)).scalar()
    if quantifier == "any":
        return df.where(F.coalesce(compare(value, bound), F.lit(False)))
    size = members.agg(F.count(F.lit(1))).scalar()
    nulls = members.agg(F.count(F.lit(1)) - F.count(member)).scalar()
    return df.where((size == 0) | ((nulls == 0) & F.coalesce(compare(value, bound), F.lit(False))))


def ratio_to_group_mean(totals: DataFrame, by: str, measure: str, mean_name: str, ratio_name: str) -> DataFrame:
    """Rows above the rounded mean of their group, with the mean and the ratio to it."""
    above = above_group_mean(totals, by, measure, mean_name)
    return above.withColumn(ratio_name, exact.half_up(F.col(measure) / F.col(mean_name), 2))


def above_mean_multiple(totals: DataFrame, measure: str, factor: float) -> DataFrame:
    """Rows whose measure exceeds ``factor`` times the unrounded mean over all rows.

    ``totals`` is read twice.
    """
    mean = totals.agg(exact.money_mean(measure)).scalar()
    return totals.where(F.col(measure) > mean * factor)
