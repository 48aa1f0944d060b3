"""Small join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def null_safe_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key matches a null key, as grouping does.

    Output columns are those of ``left`` followed by the non-key columns of ``right``.
    """
    keys = key_list(keys)
    renamed = right.withColumnsRenamed({key: f"__match_{key}" for key in keys})
    condition = reduce(Column.__and__, [left[key].eqNullSafe(renamed[f"__match_{key}"]) for key in keys])
    return left.join(renamed, condition, how).drop(*[f"__match_{key}" for key in keys])


def size_estimate(table: DataFrame) -> int:
    """Spark's own estimate of a table's bytes, from its plan and file sizes; no job runs."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measured_bytes(table: DataFrame) -> int:
    """The bytes of a table's values, from one pass over it: eight each, and the length of texts and the like."""
    if not table.columns:
        return 0
    sizes = []
    for name, kind in table.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            sizes.append(F.coalesce(F.octet_length(column), F.lit(0)) + 8)
        elif kind.startswith(("array", "map", "struct", "variant")):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 8)
        else:
            sizes.append(F.lit(8))
    return int(table.agg(F.sum(reduce(Column.__add__, sizes).cast("long"))).first()[0] or 0)


def bounded_broadcast(table: DataFrame, max_bytes: int) -> DataFrame:
    """A broadcast hint, refused with an error if the table takes more than ``max_bytes``.

    Spark's estimate is enough where it is within the limit.  It is far too high for a table without
    statistics, and often after joins, so beyond the limit the table's bytes are measured, by one job.
    """
    if size_estimate(table) > max_bytes:
        size = measured_bytes(table)
        if size > max_bytes:
            raise ValueError(f"a broadcast of {size} bytes exceeds the limit of {max_bytes}")
    return F.broadcast(table)
