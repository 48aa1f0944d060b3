"""Ranks, quantiles and picks within groups.

Groups such as an order status hold an unbounded share of the rows, so a window over the rows of a group
would run in one task.  Ranks, tiles and percentiles come from positions that are worked out range by range
(``functions.positions``): one shuffle of the rows, in pieces of even size.  Values are compared as stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import exact
from ledgerloom.functions.matching import key_list, null_safe_join
from ledgerloom.functions.positions import RANGE, SHARED, carried, in_ranges, with_carried, with_positions

#: Relative rank error of approximate percentiles is one in this many rows.
ACCURACY = 10_000

_RANKS = {"row_number": F.row_number, "dense": F.dense_rank, "rank": F.rank}


def top_n_per_group(df: DataFrame, by: str | Sequence[str], order: Sequence[Column | str], n: int,
                    name: str, ties: str = "row_number") -> DataFrame:
    """Rows ranked within the group, up to rank ``n``.

    The filter on the rank lets Spark drop the losers of each map task before the shuffle, so a large
    group reaches its reducer as a few rows per task.
    """
    window = Window.partitionBy(*key_list(by)).orderBy(*order)
    ranked = df.withColumn(name, _RANKS[ties]().over(window)).where(F.col(name) <= n)
    return ranked.withColumn(name, F.col(name).cast("long"))


def value_runs(df: DataFrame, by: str | Sequence[str], ordinal: str, bits: int | None = None,
               value: str | None = None) -> DataFrame:
    """``by, ordinal, run_rows, group_rows, before``: one row per distinct ordinal of a group.

    ``before`` counts the rows of the group with a smaller ordinal.  Null ordinals form a run of no
    rows, so that a group holding nothing else is still present.  ``value`` adds that column, which has
    one value per ordinal.
    """
    by, kept = key_list(by), [value] if value else []
    runs = df.groupBy(*by, ordinal).agg(F.count(ordinal).alias("run_rows"), *[F.max(v).alias(v) for v in kept])
    ranged = in_ranges(runs, by, [ordinal], bits=bits)
    inside = Window.partitionBy(*by, RANGE)
    earlier = inside.orderBy(ordinal).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumns({
        "before": F.coalesce(F.sum("run_rows").over(earlier), F.lit(0)), "group_rows": F.sum("run_rows").over(inside)})
    found = with_carried(placed, carried(ranged, by, {"__n": F.col("run_rows")}), by)
    return found.select(
        *by, ordinal, "run_rows", F.coalesce("__n_all", "group_rows").alias("group_rows"),
        (F.col("before") + F.coalesce("__n_before", F.lit(0))).alias("before"), *kept)


def _with_tie(df: DataFrame) -> DataFrame:
    """Rows of one value are told apart by a hash, so that they can lie in several ranges."""
    return df.withColumn("__tie", F.xxhash64(*df.columns))


def percent_rank_by(df: DataFrame, by: str | Sequence[str], amount: str, digits: int = 4,
                    name: str = "pct_rank", bits: int | None = None) -> DataFrame:
    """``percent_rank`` of an orderable column within the group, on every row.

    A value that lies in several ranges has ranges of its own; all of them take the rank of the first.
    """
    by = key_list(by)
    ranged = in_ranges(_with_tie(df), by, [amount, "__tie"], ties=[amount], bits=bits)
    inside = Window.partitionBy(*by, RANGE)
    local = ranged.withColumns({
        "__rank": F.rank().over(inside.orderBy(amount)) - 1, "__count": F.count(F.lit(1)).over(inside)})
    shared = carried(ranged, by, {"__n": F.lit(1)}, {"__value": F.min(amount)})
    run = Window.partitionBy(*by, "__value", F.col(RANGE) % 3 == 1)
    first = F.when(F.col(RANGE) % 3 == 1, F.col("__n_before")).otherwise(F.min("__n_before").over(run))
    found = with_carried(local, shared.select(*by, RANGE, first.alias("__first"), "__n_all"), by)
    before, rows = F.col("__rank") + F.coalesce("__first", F.lit(0)), F.coalesce("__n_all", "__count")
    share = F.when(rows > 1, before / (rows - 1)).otherwise(F.lit(0.0))
    return found.withColumn(name, exact.half_up(share, digits)).select(*df.columns, name)


def ntile_by(df: DataFrame, by: str | Sequence[str], amount: str, key: str, n: int, name: str = "tile",
             bits: int | None = None) -> DataFrame:
    """``ntile(n)`` over (amount, key) within the group; ``key`` is unique."""
    placed = with_positions(df, key_list(by), [amount, key], "__position", "__rows", bits)
    size, extra = F.floor(F.col("__rows") / n), F.col("__rows") % n
    longer = extra * (size + 1)
    later = extra + F.floor((F.col("__position") - longer) / F.greatest(size, F.lit(1)))
    tile = F.when(F.col("__position") < longer, F.floor(F.col("__position") / (size + 1))).otherwise(later) + 1
    return placed.withColumn(name, tile.cast("long")).select(*df.columns, name)


def percentiles_by(df: DataFrame, by: str | Sequence[str], amount: Column | str, percents: dict[str, float],
                   digits: int = 2, bits: int | None = None) -> DataFrame:
    """Exact interpolated percentiles of a numeric column; ``percents`` maps output name to fraction.

    Nulls are left out, as ``percentile_cont`` does; a group of nulls only has null percentiles.  Rows are
    counted per range first; only rows of the ranges that hold a wanted position are shuffled and sorted.
    """
    by = key_list(by)
    values = _with_tie(df).select(*by, exact.as_column(amount).alias("__value"), "__tie")
    ranged = in_ranges(values, by, ["__value", "__tie"], bits=bits)
    group = Window.partitionBy(*by)
    earlier = group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*by, RANGE).agg(F.count("__value").alias("__here")).withColumns({
        "__before": F.coalesce(F.sum("__here").over(earlier), F.lit(0)), "__rows": F.sum("__here").over(group)})
    targets = {name: F.lit(fraction) * (F.col("__rows") - 1) for name, fraction in percents.items()}
    wanted = F.array_distinct(F.array(*[end(target).cast("long") for target in targets.values() for end in (F.floor, F.ceil)]))
    held = F.filter(wanted, lambda p: (p >= F.col("__before")) & (p < F.col("__before") + F.col("__here")))
    holding = counts.withColumn("__wanted", held).where((F.size("__wanted") > 0) | ((F.col("__rows") == 0)))
    near = null_safe_join(ranged.drop(SHARED), holding, [*by, RANGE])
    place = Window.partitionBy(*by, RANGE).orderBy(F.col("__value").asc_nulls_last())
    placed = near.withColumn("__position", F.col("__before") + F.row_number().over(place) - 1)
    picked = placed.where((F.col("__rows") == 0) | F.array_contains("__wanted", F.col("__position")))
    picks = []
    for name, target in targets.items():
        for end, side in ((F.floor, "low"), (F.ceil, "high")):
            value = F.when(F.col("__position") == end(target).cast("long"), F.col("__value").cast("double"))
            picks.append(F.max(value).alias(f"{name}_{side}"))
        picks.append(F.max(target - F.floor(target)).alias(f"{name}_part"))
    found = picked.groupBy(*by).agg(*picks)
    return found.select(*by, *[
        exact.half_up(
            F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * F.col(f"{name}_part"), digits
        ).alias(name)
        for name in percents
    ])


def approx_percentiles_by(df: DataFrame, by: str | Sequence[str], amount: Column | str, percents: dict[str, float],
                          accuracy: int = ACCURACY) -> DataFrame:
    """Percentiles that are stored values, from a sketch of bounded size per group, in one pass.

    The rank of the value found is off by at most ``rows / accuracy``; with at least as much accuracy as a
    group has rows it is the smallest value that so many rows do not exceed.
    """
    by, column = key_list(by), exact.as_column(amount)
    found = df.groupBy(*by).agg(F.percentile_approx(column, list(percents.values()), accuracy).alias("__found"))
    return found.select(*by, *[F.col("__found")[k].alias(name) for k, name in enumerate(percents)])


def latest_per_key(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, as one aggregate.

    The state per key is one row; a struct makes Spark sort each task's rows by key to keep it.
    """
    newest = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(key).agg(newest.alias("__row")).select(key, "__row.*")


def first_last(df: DataFrame, key: str, order: Sequence[str], column: str, first_name: str, last_name: str) -> DataFrame:
    """The column's value on the first and on the last row of the key."""
    position = F.struct(*order)
    return df.groupBy(key).agg(
        F.min_by(column, position).alias(first_name), F.max_by(column, position).alias(last_name)
    )


def arg_max(df: DataFrame, by: str, value: str, tie: str, tie_name: str, value_name: str) -> DataFrame:
    """The row with the largest value per group; of equal values the one with the larger ``tie``."""
    best = df.groupBy(by).agg(F.max(F.struct(value, tie)).alias("best"))
    return best.select(by, F.col(f"best.{tie}").alias(tie_name), F.col(f"best.{value}").alias(value_name))
