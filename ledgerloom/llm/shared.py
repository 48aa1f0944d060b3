"""Helpers shared by the operators: words, stored intermediate results, distributed prefix sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import ensure_checkpoint_dir

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bits of a 60-bit key that name its coarse and its fine cell.
CELL_BITS = 10


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def without(rows: DataFrame, *names: str) -> DataFrame:
    """The rows without columns of these names in any case: a result takes the place of such a column."""
    taken = {n.lower() for n in names}
    return rows.drop(*[c for c in rows.columns if c.lower() in taken])


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written as Parquet below the shared checkpoint folder, and read again.

    Cuts the lineage like ``checkpoint()``, but keeps columns apart and compressed.  The files stay
    until ``discard`` or until the checkpoint folder is cleared, because the caller's result may read
    them at any time.  Shuffle files behind the rows are no longer needed; Spark removes them when the
    driver's JVM collects its garbage, which is asked for here.
    """
    spark = rows.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(rows.schema).parquet(path)
    table._stored_at = path
    return table


def discard(table: DataFrame) -> None:
    """Deletes the files of a ``stored`` table that nothing will read any more."""
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(table._stored_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(rows: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.checkpoint()


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(*columns: Column | str) -> Column:
    """A uniform 60-bit key of the columns, the same in every SQL engine that has md5."""
    text = F.concat_ws("|", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def cells(key: Column) -> dict[str, Column]:
    """The coarse and fine cell of a 60-bit key: equal ranges, so that they ascend with the key."""
    width = 1 << CELL_BITS
    return {
        "__coarse": F.shiftrightunsigned(key, 60 - CELL_BITS),
        "__fine": F.shiftrightunsigned(key, 60 - 2 * CELL_BITS) % F.lit(width),
    }


def cell_totals(rows: DataFrame, group: str, key: str, value: Column) -> DataFrame:
    """Totals per group and cell: ``group, __coarse, __fine, __total``, summed before the shuffle."""
    return (
        rows.withColumns(cells(F.col(key)))
        .groupBy(group, "__coarse", "__fine")
        .agg(F.sum(value).alias("__total"))
    )


def prefix_sums(
    rows: DataFrame, totals: DataFrame, group: str, key: str, order: list[str], value: Column, name: str
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same group that come before a row.

    Rows are ordered by the uniform 60-bit ``key``, then ``order``.  ``totals`` is
    ``cell_totals(rows, ...)``.  A group of any size is dealt over about a million cells of equal
    key ranges.  Offsets of cells are summed over at most 1024 fine cells inside a coarse one, and
    over at most 1024 coarse ones; only rows of one cell meet in one window partition.  ``group``
    must not be null.
    """
    before = (Window.unboundedPreceding, -1)
    within = Window.partitionBy(group, "__coarse").orderBy("__fine").rowsBetween(*before)
    across = Window.partitionBy(group).orderBy("__coarse").rowsBetween(*before)
    coarse = (
        totals.groupBy(group, "__coarse").agg(F.sum("__total").alias("__sum"))
        .select(group, "__coarse", F.coalesce(F.sum("__sum").over(across), F.lit(0)).alias("__to_coarse"))
    )
    offsets = (
        totals.withColumn("__to_fine", F.coalesce(F.sum("__total").over(within), F.lit(0)))
        .join(coarse, [group, "__coarse"])
        .select(group, "__coarse", "__fine", (F.col("__to_coarse") + F.col("__to_fine")).alias("__to_cell"))
    )
    inside = Window.partitionBy(group, "__coarse", "__fine").orderBy(key, *order).rowsBetween(*before)
    return (
        rows.withColumns(cells(F.col(key)))
        .join(offsets, [group, "__coarse", "__fine"])
        .withColumn(name, F.col("__to_cell") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("__coarse", "__fine", "__to_cell")
    )
