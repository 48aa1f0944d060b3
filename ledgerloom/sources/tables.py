"""Table sources: Parquet folders and headered CSV with a declared schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table; the schema comes from the file footers, so nothing is inferred."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def load_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Headered CSV.  The schema is declared: inference would cost a second pass over the file."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def load_tables(
    spark: SparkSession,
    folder: str,
    names: Iterable[str] = TABLES,
    register_views: bool = False,
    csv_schemas: Mapping[str, StructType | str] | None = None,
) -> dict[str, DataFrame]:
    """Every named table of a folder, optionally registered as temporary views for SQL text.

    A table listed in ``csv_schemas`` is read from ``NAME.csv`` instead of ``NAME.parquet``.
    """
    csv_schemas = csv_schemas or {}
    tables = {}
    for name in names:
        if name in csv_schemas:
            tables[name] = load_csv(spark, f"{folder.rstrip('/')}/{name}.csv", csv_schemas[name])
        else:
            tables[name] = load_table(spark, folder, name)
        if register_views:
            tables[name].createOrReplaceTempView(name)
    return tables


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table, answered from footers where the source allows."""
    counted = [
        table.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
