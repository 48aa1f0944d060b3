"""Positions and running sums within groups of any size.

A window over a whole group runs in one task.  Here the rows are cut into ranges of about equal numbers of
rows, in the order of the group's key and then of the rows, so that a large group lies in many ranges and
a range holds many small groups.  Windows run inside a range; what the earlier ranges of the same group
hold is added from a table of at most a few rows per range.  There is one plan, whatever the size of a group:
the rows are shuffled once, by group and range.

The borders of the ranges are rows of a sample drawn by a hash of the ordering columns.  They come from a
scalar subquery that depends on the rows alone, so that every use of them and every retried task sees the
same borders.  A bad sample makes ranges uneven and changes no result.  Order is that of Spark's ``ORDER
BY``: nulls first, NaN last, the two zeros equal, values as stored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.matching import null_safe_join

#: Sampled rows for each range.
SAMPLED = 16
RANGE, SHARED = "__range", "__shared"
MANTISSA = 1 << 52


def ordinal(value: Column | str) -> Column:
    """A ``long`` that maps a double one-to-one and in order; null stays null.

    A double's sign, exponent and fraction are put together as in its binary form, which ascends with
    its absolute value.  The two zeros are equal, and a number that is none comes last.  Other types
    are cast to double first, which whole numbers above 2**53 and wide decimals do not survive.
    """
    value = (F.col(value) if isinstance(value, str) else value).cast("double")
    size = F.abs(value)
    guess = F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2(size))))
    scaled = size / F.pow(F.lit(2.0), guess)
    exponent = F.when(scaled >= 2, guess + 1).when((scaled < 1) & (guess > -1022), guess - 1).otherwise(guess)
    fraction = F.when(scaled >= 2, scaled / 2).when((scaled < 1) & (guess > -1022), scaled * 2).otherwise(scaled)
    bits = (exponent + 1022) * F.lit(MANTISSA) + (fraction * F.lit(float(MANTISSA))).cast("long")
    return (
        F.when(value.isNull(), F.lit(None).cast("long"))
        .when(F.isnan(value), F.lit((1 << 63) - 1))
        .when(value == 0, F.lit(0).cast("long"))
        .when(size == float("inf"), F.signum(value).cast("long") * F.lit(2047 * MANTISSA))
        .otherwise(F.signum(value).cast("long") * bits)
    )


def _borders(rows: DataFrame, columns: Sequence[str], ranges: int) -> Column:
    """The first row of each range but the first, as a scalar subquery; fewer where there are few rows."""
    keys = rows.select(*columns)
    count = keys.agg(F.count(F.lit(1))).scalar()
    draw = F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))
    sample = keys.where(draw * count < float(SAMPLED * ranges))
    held = sample.agg(F.sort_array(F.collect_set(F.struct(*columns))).alias("held"))
    size = F.size("held")
    some = F.least(size, F.lit(ranges))
    places = F.sequence(F.lit(1), some - 1)
    picked = F.transform(places, lambda k: F.get("held", F.floor(k * size / some).cast("int")))
    return held.select(F.when(some > 1, picked).otherwise(F.slice("held", 1, 0))).scalar()


def in_ranges(df: DataFrame, by: Sequence[str], order: Sequence[str], ties: Sequence[str] = (), bits: int | None = None) -> DataFrame:
    """The rows with ``RANGE``, which ascends with ``by`` and ``order``, and ``SHARED``: whether the group
    of the row may lie in other ranges too.

    With ``ties``, the first columns of ``order``, rows that agree in ``by`` and ``ties`` with a border are in ranges
    of their own, so that any other run of such rows lies in one range.  There are ``2 ** bits`` borders
    at most, by default twice as many as shuffle partitions.
    """
    columns = [*by, *order]
    ranges = 1 << bits if bits is not None else 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row, at = F.struct(*columns), F.lit(0)
    steps = []
    for k in reversed(range(ranges.bit_length())):  # a search by halving, in generated code
        steps.append((at + F.when(F.get("__borders", at + F.lit((1 << k) - 1)) <= row, 1 << k).otherwise(0)).alias(f"__at_{k}"))
        at = F.col(f"__at_{k}")
    placed = df.withColumn("__borders", _borders(df, columns, ranges)).select(*df.columns, "__borders", *steps)

    def agrees(border: Column, names: Sequence[str]) -> Column:
        return reduce(Column.__and__, [F.col(name).eqNullSafe(border[name]) for name in names], border.isNotNull())

    first, after, number = F.get("__borders", at - 1), F.get("__borders", at), at.cast("long")
    if ties:
        names = [*by, *ties]
        number = number * 3 + F.when(agrees(first, names), 0).when(agrees(after, names), 2).otherwise(1)
    here = F.spark_partition_id() >= 0  # true; a filter on the column is not copied below the search
    return placed.select(*df.columns, number.alias(RANGE), (here & (agrees(first, by) | agrees(after, by))).alias(SHARED))


def carried(ranged: DataFrame, by: Sequence[str], sums: Mapping[str, Column], kept: Mapping[str, Column] | None = None) -> DataFrame:
    """A row per shared group and range: ``NAME_before``, ``NAME_here`` and ``NAME_all`` for each of ``sums``.

    These are totals over the group's earlier ranges, this range and all ranges.  ``kept`` adds aggregates
    of the rows.  At most six rows for each border, so it can be broadcast.
    """
    parts = ranged.where(SHARED).groupBy(*by, RANGE).agg(
        *[F.sum(column).alias(f"{name}_here") for name, column in sums.items()],
        *[column.alias(name) for name, column in (kept or {}).items()])
    group = Window.partitionBy(*by)
    earlier = group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumns({
        **{f"{name}_before": F.coalesce(F.sum(f"{name}_here").over(earlier), F.lit(0)) for name in sums},
        **{f"{name}_all": F.sum(f"{name}_here").over(group) for name in sums}})


def with_carried(rows: DataFrame, carried: DataFrame, by: Sequence[str], how: str = "left") -> DataFrame:
    return null_safe_join(rows, F.broadcast(carried), [*by, RANGE], how)


def with_positions(df: DataFrame, by: Sequence[str], order: Sequence[str], position: str, total: str | None = None,
                   bits: int | None = None) -> DataFrame:
    """The rows numbered from 0 within their group in ``order``, which must tell rows apart; ``total``
    adds the number of rows of the group."""
    ranged = in_ranges(df, by, order, bits=bits)
    inside = Window.partitionBy(*by, RANGE)
    numbers = {position: (F.row_number().over(inside.orderBy(*order)) - 1).cast("long")}
    if total:
        numbers[total] = F.count(F.lit(1)).over(inside)
    found = with_carried(ranged.withColumns(numbers), carried(ranged, by, {"__n": F.lit(1)}), by)
    result = {position: F.col(position) + F.coalesce("__n_before", F.lit(0))}
    if total:
        result[total] = F.coalesce("__n_all", F.col(total))
    return found.withColumns(result).select(*df.columns, *result)
