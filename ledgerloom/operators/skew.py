"""Finding hot keys, and spreading them over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exact
from ledgerloom.functions.matching import key_list, null_safe_join
from ledgerloom.operators.layout import partition_statistics

HEAVY_SHARE = 0.00001
HEAVY_MIN_ROWS = 1_000_000


def heavy_keys(df: DataFrame, keys: str | Sequence[str], share: float = HEAVY_SHARE,
               min_rows: int = HEAVY_MIN_ROWS) -> DataFrame:
    """Keys holding more than ``share`` of all rows and more than ``min_rows`` rows.

    There are fewer than ``1 / share`` of them whatever the data (100 000 by default, a few megabytes),
    so the result can be broadcast.  Only ``salted_join`` uses it, whose rows do not depend on it.  The counts combine map-side; only the key columns are read.
    """
    keys = key_list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("heavy_rows"))
    everything = counts.agg(F.sum("heavy_rows")).scalar()
    return counts.where((F.col("heavy_rows") > min_rows) & (F.col("heavy_rows") > share * everything))


def row_salt(row_key: Sequence[str], slices: int) -> Column:
    """A slice number from the row's own key: the same after a retry and in any layout."""
    return F.pmod(F.xxhash64(*row_key), F.lit(slices)).cast("int")


def hot_keys(df: DataFrame, key: str, n: int, name: str = "order_count") -> DataFrame:
    """The ``n`` most frequent keys, ties broken by the key."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(key)).limit(n)
    )


def skew_ratio(df: DataFrame, key: str) -> DataFrame:
    """Largest and mean rows per key, and their ratio (taken before rounding)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    mean = F.sum("rows") / F.count("rows")
    return per_key.agg(
        F.max("rows").alias("max_orders"),
        exact.half_up(mean, 2).alias("avg_orders"),
        exact.half_up(F.max("rows") / mean, 2).alias("skew_ratio"),
    )


def salted_aggregate(df: DataFrame, key: str, amount: Column | str, row_key: Sequence[str], slices: int,
                     name: str = "total_revenue") -> DataFrame:
    """Total per key through an intermediate total per (key, salt); equal to the plain total."""
    return (
        df.withColumn("__salt", row_salt(row_key, slices))
        .groupBy(key, "__salt")
        .agg(*exact.split_sum(exact.cents(amount), "amount"))
        .groupBy(key)
        .agg(exact.merged_money("amount").alias(name))
    )


def salted_join(big: DataFrame, small: DataFrame, on: str, row_key: Sequence[str], slices: int,
                heavy: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """Equi-join in which the rows of a key in ``big`` are spread over ``slices`` tasks.

    The matching rows of ``small`` are repeated once per slice.  With ``heavy`` (see
    :func:`heavy_keys`) only those keys are sliced and only their rows repeated; without it all are.
    ``how`` may be ``inner`` or ``left``.
    """
    salt = row_salt(row_key, slices)
    copies = F.sequence(F.lit(0), F.lit(slices - 1))
    if heavy is None:
        salted, repeated = big.withColumn("__salt", salt), small.withColumn("__salt", F.explode(copies))
    else:
        marks = F.broadcast(heavy.select(on, F.lit(True).alias("__hot")))
        salted = (
            null_safe_join(big, marks, on, "left")
            .withColumn("__salt", F.when(F.col("__hot"), salt).otherwise(F.lit(0)))
            .drop("__hot")
        )
        repeated = (
            null_safe_join(small, marks, on, "left")
            .withColumn("__salt", F.explode(F.when(F.col("__hot"), copies).otherwise(F.array(F.lit(0)))))
            .drop("__hot")
        )
    return salted.join(repeated, [on, "__salt"], how).drop("__salt")


def salted_layout(df: DataFrame, key: str, row_key: Sequence[str], partitions: int, slices: int) -> DataFrame:
    """Rows placed by key and salt, so that a hot key fills several partitions."""
    return df.withColumn("__salt", row_salt(row_key, slices)).repartition(partitions, key, "__salt").drop("__salt")


def salting_report(df: DataFrame, key: str, row_key: Sequence[str], partitions: int, slices: int) -> DataFrame:
    """Rows per partition before and after salting the partitioning key."""
    plain = df.repartition(partitions, key)
    salted = salted_layout(df, key, row_key, partitions, slices)
    return partition_statistics(plain, "unsalted").unionByName(partition_statistics(salted, "salted"))
