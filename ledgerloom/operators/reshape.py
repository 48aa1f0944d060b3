"""Wide and long forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_count(df: DataFrame, row: str, column: str, values: Sequence[str], weight: str | None = None) -> DataFrame:
    """Row counts with one column per listed value; a missing combination shows zero.

    The value list is fixed by the caller, so Spark does not run a job to discover it.  ``weight``
    names a column of row counts where the input is already counted.
    """
    count = F.count(F.lit(1)) if weight is None else F.sum(weight)
    wide = df.groupBy(row).pivot(column, list(values)).agg(count)
    return wide.select(row, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("long").alias(v) for v in values])


def unpivot_counts(df: DataFrame, row: str, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per (row key, column), leaving out nulls as SQL ``UNPIVOT`` does."""
    return df.unpivot(row, list(columns), name, value).where(F.col(value).isNotNull())
