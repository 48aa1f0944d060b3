"""Partition layout: placing rows, and reporting where they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import exact


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even round-robin layout."""
    return df.repartition(partitions)


def hash_layout(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Rows of a key together."""
    return df.repartition(partitions, *keys)


def range_layout(df: DataFrame, partitions: int, *columns: str) -> DataFrame:
    """Ascending, non-overlapping value ranges."""
    return df.repartitionByRange(partitions, *columns)


def shrink(df: DataFrame, before: int, after: int) -> DataFrame:
    """A wide layout merged into fewer partitions without another shuffle."""
    return df.repartition(before).coalesce(after)


def partition_profile(df: DataFrame) -> DataFrame:
    """``partition_id, row_count`` of the layout as it stands; counts combine in place."""
    return (
        df.select(F.spark_partition_id().cast("long").alias("partition_id"))
        .groupBy("partition_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def range_profile(df: DataFrame, partitions: int, column: str) -> DataFrame:
    """Smallest value, largest value and rows of each range partition."""
    return (
        range_layout(df.select(column), partitions, column)
        .withColumn("partition_id", F.spark_partition_id().cast("long"))
        .groupBy("partition_id")
        .agg(
            F.min(column).alias("min_amount"),
            F.max(column).alias("max_amount"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )


def partition_statistics(df: DataFrame, label: str) -> DataFrame:
    """Largest and mean partition, and their ratio; partitions without rows do not count."""
    profile = partition_profile(df).select(F.struct("row_count", "partition_id").alias("p"))
    totals = profile.agg(F.max("p.row_count").alias("largest"), F.sum("p.row_count").alias("rows"), F.count("p").alias("parts"))
    rows_each = F.col("rows") / F.col("parts")
    return totals.select(
        F.lit(label).alias("approach"),
        F.col("largest").alias("max_partition_rows"),
        exact.half_up(rows_each, 0).cast("long").alias("avg_partition_rows"),
        exact.half_up(F.col("largest") * F.col("parts") / F.col("rows"), 2).alias("hottest_ratio"),
    )


def layout_facts(df: DataFrame, key: str | None = None, within: float | None = None) -> DataFrame:
    """One row of what holds for a layout wherever its rows are placed.

    ``row_total`` and ``partition_total`` (partitions with rows); with ``key``, ``split_keys``: keys found
    in more than one partition; with ``within``, ``is_level``: the largest partition holds at most so many
    times the mean.
    """
    placed = df.withColumn("__part", F.spark_partition_id())
    if key is None:
        cells = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
        split = []
    else:
        cells = placed.groupBy("__part", F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("n"))
        homes = cells.groupBy("__key").agg(F.count(F.lit(1)).alias("homes"))
        split = [homes.agg(F.count_if(F.col("homes") > 1)).scalar().alias("split_keys")]
        cells = cells.groupBy("__part").agg(F.sum("n").alias("n"))
    level = [] if within is None else [(F.max("n") <= within * F.sum("n") / F.count("n")).alias("is_level")]
    facts = cells.agg(F.sum("n").alias("row_total"), F.count("n").alias("partition_total"), *level)
    return facts.select("*", *split)


def range_facts(df: DataFrame, partitions: int, column: str) -> DataFrame:
    """One row: rows in total, ranges in use, and neighbouring ranges that overlap."""
    profile = range_profile(df, partitions, column)
    later = F.lead("min_amount").over(Window.orderBy("partition_id"))
    return profile.withColumn("overlaps", later < F.col("max_amount")).agg(
        F.sum("row_count").alias("row_total"), F.count(F.lit(1)).alias("partition_total"),
        F.count_if("overlaps").alias("overlapping_ranges"))


def aggregate_with_partitions(df: DataFrame, by: str, amount: Column | str, partitions: int,
                              name: str = "total_revenue") -> DataFrame:
    """Total per group, delivered in exactly ``partitions`` partitions.

    The width belongs to this query alone: no session setting is touched.  The groups are placed
    after they are totalled; placing the rows first would send a group holding most of them to one
    task.
    """
    totals = df.groupBy(by).agg(exact.money_sum(amount).alias(name))
    return totals.repartition(partitions, by)


def aggregate_adaptive(df: DataFrame, by: str, amount: Column | str, name: str = "q") -> DataFrame:
    """Total per group, leaving the shuffle width to adaptive execution."""
    return df.groupBy(by).agg(F.sum(amount).alias(name))
