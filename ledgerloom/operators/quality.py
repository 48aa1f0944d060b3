"""Data-quality audits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a table whose checksums are compared.
CELLS = 1 << 14


def duplicate_groups(df: DataFrame, natural_key: Sequence[str], name: str = "dup_count") -> DataFrame:
    """Key values carried by more than one row."""
    return df.groupBy(*natural_key).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def orphans(child: DataFrame, references: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows with a non-null foreign key that has no parent, for any ``(parent, fk, pk)``.

    The missing key values are worked out first, from the distinct foreign keys; in sound data they
    are few, and the rows of the child are matched to them without being shuffled.
    """
    flags = []
    columns = child.columns
    for i, (parent, fk, pk) in enumerate(references):
        known = parent.select(F.col(pk).alias(fk)).distinct()
        used = child.select(fk).where(F.col(fk).isNotNull()).distinct()
        flag = f"__orphan_{i}"
        child = child.join(used.join(known, fk, "left_anti").withColumn(flag, F.lit(True)), fk, "left")
        flags.append(F.coalesce(F.col(flag), F.lit(False)))
    return child.where(reduce(Column.__or__, flags)).select(*columns)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and rows per column, from one pass over the table."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[(F.count(F.lit(1)) - F.count(column)).alias(column) for column in columns],
    )
    return counted.unpivot("total_rows", list(columns), "column_name", "null_count").select(
        "column_name", "null_count", "total_rows")


def schema_differences(actual: DataFrame, expected: DataFrame) -> list[str]:
    """Missing, extra and re-ordered columns, as messages; empty when the column lists are equal."""
    found, wanted = actual.columns, expected.columns
    messages = [f"missing column {c}" for c in wanted if c not in found]
    messages += [f"extra column {c}" for c in found if c not in wanted]
    if not messages and found != wanted:
        messages.append(f"columns in another order: {found}, expected {wanted}")
    return messages


def dataset_diff(actual: DataFrame, expected: DataFrame, keys: Sequence[str], tolerance: float = 0.01) -> DataFrame:
    """Rows that differ between two tables with the same columns, matched by a key.

    ``difference`` is ``missing`` (only expected), ``extra`` (only actual), ``duplicated`` (the key is
    not unique on one side, so its rows cannot be paired) or ``changed``.  Floating-point columns may
    differ by ``tolerance``; a null equals only a null.  Equal tables give no rows, and nothing is
    collected.
    """
    problems = schema_differences(actual, expected)
    if problems:
        raise ValueError("; ".join(problems))
    keys = list(keys)
    values = [c for c in expected.columns if c not in keys]
    floating = {c for c, kind in expected.dtypes if kind in ("double", "float")}

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"{mark}_rows"), *[F.min(c).alias(f"{mark}_{c}") for c in values])

    def same(column: str) -> Column:
        a, b = F.col(f"a_{column}"), F.col(f"e_{column}")
        if column in floating:
            return a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))
        return a.eqNullSafe(b)

    left = side(actual, "a")
    right = side(expected, "e").withColumnsRenamed({k: f"__match_{k}" for k in keys})
    match = reduce(Column.__and__, [left[k].eqNullSafe(right[f"__match_{k}"]) for k in keys])
    equal = reduce(Column.__and__, [same(c) for c in values], F.lit(True))
    kind = (
        F.when(F.col("a_rows").isNull(), "missing")
        .when(F.col("e_rows").isNull(), "extra")
        .when((F.col("a_rows") > 1) | (F.col("e_rows") > 1), "duplicated")
        .when(~equal, "changed")
    )
    shown = [F.when(F.col("a_rows").isNull(), F.col(f"__match_{k}")).otherwise(F.col(k)).alias(k) for k in keys]
    return (
        left.join(right, match, "full_outer")
        .withColumn("difference", kind)
        .where(F.col("difference").isNotNull())
        .select(*shown, "difference")
    )


def _cell(keys: Sequence[str], cells: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).isNull() for k in keys], *keys), F.lit(cells))


def differing_cells(rows: DataFrame, keys: Sequence[str], side: str, cells: int = CELLS) -> DataFrame:
    """The cells, by hash of the keys, in which two sides hold other rows: ``__cell``, at most ``cells`` of them.

    ``rows`` are those of both sides, told apart by ``side``, which is 1 or -1.  A cell's rows are summed as
    two 64-bit hashes of a whole row, in pieces short enough for ``2 ** 38`` rows; sums do not depend on
    order, and count equal rows.  Nulls are hashed as marks of their own, so that they cannot change places.
    """
    columns = [c for c in rows.columns if c != side]
    marks = [F.col(c).isNull() for c in columns]
    hashed = rows.select(_cell(keys, cells).alias("__cell"), F.col(side).cast("long").alias("__side"), *[
        F.xxhash64(F.lit(seed), *marks, *columns).alias(f"__hash_{seed}") for seed in (1, 2)])
    sums = [F.sum("__side").alias("__rows")]
    for seed in (1, 2):
        for shift in (0, 24, 48):
            piece = F.shiftrightunsigned(f"__hash_{seed}", shift).bitwiseAND((1 << 24) - 1)
            sums.append(F.sum(F.col("__side") * piece).alias(f"__sum_{seed}_{shift}"))
    summed = hashed.groupBy("__cell").agg(*sums)
    return summed.where(reduce(Column.__or__, [F.col(c) != 0 for c in summed.columns[1:]])).select("__cell")


def checksum_diff(actual: DataFrame, expected: DataFrame, keys: Sequence[str], tolerance: float = 0.01,
                  cells: int = CELLS) -> DataFrame:
    """``dataset_diff`` for two tables that hardly differ: checksums first, rows only where these differ.

    Both tables are summed in cells by the hash of their keys.  Rows of cells with equal sums are dropped in
    the scan, and what is left is compared.  Equal tables shuffle nothing but a row per cell and task.  Each
    table is read twice, so one that is costly to work out should be stored.  More ``cells`` leave fewer rows
    to compare; their list, eight bytes each, is broadcast.

    The rows are those of ``dataset_diff``, but for cells that hold the very same rows on both sides: these
    give none, even if a key is repeated there.  Columns whose types differ are compared in their common one.
    """
    problems = schema_differences(actual, expected)
    if problems:
        raise ValueError("; ".join(problems))
    keys, columns = list(keys), expected.columns
    both = actual.withColumn("__side", F.lit(1)).unionByName(expected.withColumn("__side", F.lit(-1)))
    differing = F.broadcast(differing_cells(both, keys, "__side", cells))
    left = both.withColumn("__cell", _cell(keys, cells)).join(differing, "__cell", "left_semi")
    return dataset_diff(
        left.where("__side = 1").select(*columns), left.where("__side = -1").select(*columns), keys, tolerance)


def diff_summary(actual: DataFrame, expected: DataFrame, keys: Sequence[str], tolerance: float = 0.01) -> DataFrame:
    """One row: ``compared_keys``, the keys of either side, and ``differing_keys``."""
    keys = list(keys)
    compared = actual.select(*keys).union(expected.select(*keys)).distinct().agg(F.count(F.lit(1)).alias("compared_keys"))
    differing = dataset_diff(actual, expected, keys, tolerance).agg(F.count(F.lit(1))).scalar()
    return compared.select("compared_keys", differing.alias("differing_keys"))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows numbered from 0 in the order they come in.

    Rows are counted per partition, one number each, and a partition starts where the ones before it
    end.  ``df`` must come in the same order each time, as a sorted frame does.
    """
    local = df.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = local.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    starts = starts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return local.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__at")).drop("__part", "__at", "__start")


def ordered_diff(actual: DataFrame, expected: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Places at which two ordered results differ: ``position, difference``, as in ``dataset_diff``."""
    position = "position"
    return dataset_diff(numbered(actual, position), numbered(expected, position), [position], tolerance)


def multiset_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows of either table without an equal counterpart in the other, duplicates counted."""
    problems = schema_differences(actual, expected)
    if problems:
        raise ValueError("; ".join(problems))
    extra = actual.exceptAll(expected).withColumn("difference", F.lit("extra"))
    missing = expected.exceptAll(actual).withColumn("difference", F.lit("missing"))
    return extra.unionByName(missing)
