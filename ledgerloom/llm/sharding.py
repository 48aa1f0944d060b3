"""Sharding by jump consistent hashing.

The law is ``key``: the id and the number of shards decide, without any table of shards.  A key
"jumps" from shard to shard as the count grows: standing at ``b`` it next jumps to
``floor((b + 1) / r)`` with a uniform ``r`` in (0, 1] drawn from the key and ``b``; its shard is the
last one it reaches below the count.  Draws do not depend on the count, so that one more shard takes
rows only into itself, a fair share of each other one.  Only DataFrame functions are used.

Edge cases: a null id is a key of its own; equal ids share a shard and get slots of their own; a null
text has no bytes and the checksum of the empty text; an empty table gives an empty result.  Equal
texts under different ids are placed by their ids, as the law demands.  Columns with the names of results
give way to them, others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import cell_totals, checkpointed, hash_key, prefix_sums, without

SHARDS = 24
#: Bytes a row needs besides its text.
ROW_BYTES = 8
#: Jumps that are tried first; more are rare, and are then tried up to the number of shards.
USUAL_JUMPS = 48


def jump_hash(key: Column, shards: int) -> Column:
    """The shard of a key, 0 to ``shards - 1``."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def jumped(state: Column, _: Column) -> Column:
        draw = (F.shiftrightunsigned(F.xxhash64(key, state["next"]), 11) + 1) / F.lit(float(1 << 53))
        onward = F.floor((state["next"] + 1) / draw).cast("long")
        return F.when(state["next"] >= shards, state).otherwise(F.struct(state["next"].alias("at"), onward.alias("next")))

    def after(jumps: int) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(jumps)), start, jumped, lambda s: F.when(s["next"] >= shards, s["at"]))

    return F.coalesce(after(min(shards, USUAL_JUMPS)), after(shards)).cast("int")


def shard_rows(docs: DataFrame, shards: int = SHARDS, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    ``slot`` numbers the rows of a shard without gaps.  It is a distributed prefix count over hash
    cells of the shard, so that no shard is numbered by one task.
    """
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = without(docs, "size", "text_crc32", "law", "shard", "slot", "grown_shard").withColumns({
        "size": F.octet_length(plain).cast("long") + F.lit(ROW_BYTES),
        "text_crc32": F.crc32(plain.cast("binary")),
        "law": F.lit("key"),
        "shard": jump_hash(F.col(row_id), shards),
        "grown_shard": jump_hash(F.col(row_id), shards + 1),
        "__key": hash_key(row_id),
    })
    one = F.lit(1).cast("long")
    totals = checkpointed(cell_totals(rows, "shard", "__key", one))
    return prefix_sums(rows, totals, "shard", "__key", [row_id, "size", "text_crc32"], one, "slot").drop("__key")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, row_id: str = "doc_id") -> None:
    """Writes a folder per shard.  Rows are not shuffled: each task adds one file to a shard."""
    docs.withColumn("shard", jump_hash(F.col(row_id), shards)).write.partitionBy("shard").parquet(path)
