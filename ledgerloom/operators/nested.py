"""Arrays, higher-order functions and the classifier in its native and Python forms."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.functions import exact
from ledgerloom.functions.matching import key_list
from ledgerloom.functions.positions import with_positions

MAX_ARRAY = 1_000_000


def collect_sorted(df: DataFrame, by: str, amount: str, name: str, max_length: int = MAX_ARRAY,
                   bits: int | None = None) -> DataFrame:
    """``by, slice, NAME``: the group's stored amounts, ascending, in arrays of at most ``max_length``.

    Slice ``k`` holds the values in positions ``k * max_length`` and up, so concatenating the slices in
    order gives the whole array.  No task holds more of a group than one slice.  Nulls are left out; a
    group of nulls only has one empty slice.
    """
    values = df.select(by, F.col(amount).alias("__value"), F.xxhash64(*df.columns).alias("__tie"))
    first = with_positions(values, [by], ["__value", "__tie"], "__position", bits=bits)  # nulls come first
    nulls = values.where("__value IS NULL").groupBy(F.col(by).alias("__of")).agg(F.count(F.lit(1)).alias("__nulls"))
    placed = first.join(nulls, F.col(by).eqNullSafe(F.col("__of")), "left")
    place = F.greatest(F.col("__position") - F.coalesce("__nulls", F.lit(0)), F.lit(0))
    sliced = placed.groupBy(by, F.floor(place / max_length).alias("slice"))
    return sliced.agg(F.sort_array(F.collect_list("__value")).alias(name))


def collect_whole(df: DataFrame, by: str, amount: str, name: str, max_length: int = MAX_ARRAY,
                  bits: int | None = None) -> DataFrame:
    """``by, NAME``: one row per group with its amounts, ascending.

    For groups of at most ``max_length`` amounts; a larger one is an error rather than a task that holds
    it whole.  :func:`collect_sorted` takes groups of any size.
    """
    slices = collect_sorted(df, by, amount, name, max_length, bits)
    too_long = F.raise_error(F.lit(f"a group of over {max_length} values; use collect_sorted"))
    return slices.select(by, F.when(F.col("slice") == 0, F.col(name)).otherwise(too_long).alias(name))


def array_stats(arrays: DataFrame, by: str | Sequence[str], array: str, threshold: float) -> DataFrame:
    """Length, number of elements over the threshold, and exact sum, by higher-order functions.

    Each array is reduced where it lies; the rows of a group held in slices are then added up.
    """
    by = key_list(by)
    total = F.aggregate(array, F.lit(0).cast("long"), lambda acc, x: acc + exact.cents(x))
    per_row = arrays.select(
        *by,
        F.size(array).cast("long").alias("length"),
        F.size(F.filter(array, lambda x: x > threshold)).cast("long").alias("large"),
        total.alias("cents"),
    )
    return per_row.groupBy(*by).agg(
        F.sum("length").alias("order_count"),
        F.sum("large").alias("large_count"),
        exact.cents_sum("cents").alias("total_amount_sum"),
    )


def array_flags(arrays: DataFrame, by: str | Sequence[str], array: str, any_above: float, all_above: float,
                any_name: str, all_name: str) -> DataFrame:
    """Whether some element exceeds one bound, and whether every element exceeds another."""
    by = key_list(by)
    per_row = arrays.select(
        *by,
        F.exists(array, lambda x: x > any_above).alias("some"),
        F.forall(array, lambda x: x > all_above).alias("every"),
    )
    return per_row.groupBy(*by).agg(F.bool_or("some").alias(any_name), F.bool_and("every").alias(all_name))


def group_stats(df: DataFrame, by: str | Sequence[str], amount: str, threshold: float) -> DataFrame:
    """The numbers of :func:`array_stats` straight from the rows, with constant state per group."""
    value = F.col(amount)
    return df.groupBy(*key_list(by)).agg(
        F.count(value).alias("order_count"),
        F.count_if(value > threshold).alias("large_count"),
        F.coalesce(exact.money_sum(value), F.lit(0.0)).alias("total_amount_sum"),
    )


def group_flags(df: DataFrame, by: str | Sequence[str], amount: str, any_above: float, all_above: float,
                any_name: str, all_name: str) -> DataFrame:
    """The flags of :func:`array_flags` straight from the rows."""
    return df.groupBy(*key_list(by)).agg(
        F.coalesce(F.max(amount) > any_above, F.lit(False)).alias(any_name),
        F.coalesce(F.min(amount) > all_above, F.lit(True)).alias(all_name),
    )


def classify(df: DataFrame, amount: str, bands: Sequence[tuple[str, float]], lowest: str, name: str,
             implementation: str = "native") -> DataFrame:
    """Label each row by the first band whose floor it reaches; a null amount has a null label.

    ``native`` stays inside generated code and is the one to use.  ``pandas`` (Arrow batches) and
    ``python`` (row by row) give the same labels and exist for comparison.
    """
    bands = list(bands)
    if implementation == "native":
        label = _native_label(F.col(amount), bands, lowest)
    elif implementation == "pandas":
        def label_batch(values: pd.Series) -> pd.Series:
            labels = pd.Series(lowest, index=values.index, dtype="object")
            for band, floor in reversed(bands):
                labels = labels.mask(values >= floor, band)
            return labels.mask(values.isna(), None)

        label = F.pandas_udf(label_batch, StringType())(F.col(amount))
    elif implementation == "python":
        def label_one(value):
            if value is None:
                return None
            return next((band for band, floor in bands if value >= floor), lowest)

        label = F.udf(label_one, StringType())(F.col(amount))
    else:
        raise ValueError(f"unknown implementation {implementation!r}")
    return df.withColumn(name, label)


def _native_label(value: Column, bands: Sequence[tuple[str, float]], lowest: str) -> Column:
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for band, floor in bands:
        label = label.when(value >= floor, band)
    return label.otherwise(lowest)
