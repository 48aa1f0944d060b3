"""The registered queries: an operator bound to tables, its oracle SQL and its display order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans.bindings import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None
    order: tuple[str, ...]

    per_row: bool

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        """The result; grouped and top-k ones come in display order.

        A result with a row per row or key of a table is left unsorted: a full sort is for who wants one.
        """
        return self.build(Tables(spark, folder)) if self.per_row else self.ordered(spark, folder)

    def ordered(self, spark: SparkSession, folder: str) -> DataFrame:
        """The result in its display order."""
        return self.build(Tables(spark, folder)).orderBy(*[_direction(column) for column in self.order])


QUERIES: dict[str, Query] = {}

#: Queries whose rows are as many as the rows or keys of a table, or whose layout is the point.
PER_ROW = (
    "commerce_2_5", "commerce_3_1", "commerce_3_2", "commerce_3_4", "commerce_4_4", "commerce_5_3", "commerce_5_4",
    "commerce_6_1", "commerce_6_2", "commerce_6_3", "commerce_6_5", "commerce_7_", "commerce_8_",
    "payments_2_1", "payments_2_5", "payments_3_1", "payments_3_2", "payments_3_4", "payments_3_5", "payments_4_2",
    "payments_4_3", "payments_4_5", "payments_5_3", "payments_6_1", "payments_6_2", "payments_6_3", "payments_6_5",
    "payments_7_1", "payments_7_2", "payments_7_4", "payments_8_3", "payments_8_4", "dataset_diff_completed",
    "dataset_diff_checksums",
)


def _direction(column: str) -> Column:
    return F.desc(column[1:]) if column.startswith("-") else F.asc(column)


def query(name: str, order: str, oracle: str | None = None):
    """Register a query.  ``order`` lists display columns, ``-`` marking a descending one."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = Query(name, build, oracle, tuple(order.split()), name.startswith(PER_ROW))
        return build

    return register


def sql_money(expression: str) -> str:
    """Oracle text for an exact money total."""
    return f"cast(sum(cast({expression} as decimal(18,2))) as double)"


def sql_round(expression: str, digits: int) -> str:
    """Oracle text for half-up rounding that reads a double just below a tie as the tie."""
    return f"round(({expression}) + sign({expression}) * 1e-9, {digits})"
