"""Packing documents into training sequences: concatenate and cut.

Pass one tokenizes each partition and writes, per document, its ids and the number of ids that come
before it in its partition.  The totals of the partitions, one row each, are summed up to global
offsets.  Pass two places each document on the one long line of ids and cuts the line into windows of
fixed length; a document over a border gives a record on either side.  Nothing but partition totals
is shuffled, and all windows but the very last are full.

Edge cases: a null or empty text is its end token alone; repeated rows are packed each; an empty
table gives no sequence; columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ledgerloom.llm.shared import stored
from ledgerloom.llm.text_maps import bites
from ledgerloom.llm.vocabularies import release

LENGTH = 4096
END = 2
VOCABULARY = "word_bpe_49k.json"
#: Bytes of an id.
WIDTH = 4
#: Batches of bounded size whose distinct words are looked up together.
TOGETHER = 8


def _tokenizing(vocabulary: str, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ledgerloom.llm.vocabularies import text_ids

        encode, last, part, before = text_ids(vocabulary), end.to_bytes(WIDTH, "little"), TaskContext.get().partitionId(), 0
        for several in bites(batches, 1, TOGETHER):
            parts = list(bites(iter([several]), 1))
            for batch, (tokens, sizes) in zip(parts, encode.of_parts([p.column(1) for p in parts])):
                ends = np.cumsum(sizes)
                ids = [tokens[low:high].tobytes() + last for low, high in zip(ends - sizes, ends)]
                counts = (sizes + 1).tolist()
                places = []
                for count in counts:
                    places.append(before)
                    before += count
                yield pa.record_batch(
                    [batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(places, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                    names=["__id", "part", "before", "doc_tokens", "ids"],
                )

    return tokenized


def _cutting(length: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in bites(batches, 3):
            rows, starts, sizes, sums, places, pieces = [], [], [], [], [], []
            for row, (place, count, ids) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))):
                whole, start = memoryview(ids), 0
                while start < count:
                    size = min(count - start, length - (place + start) % length)
                    piece = whole[start * WIDTH:(start + size) * WIDTH]
                    rows.append(row)
                    starts.append(start)
                    sizes.append(size)
                    sums.append(zlib.crc32(piece))
                    places.append(place + start)
                    if with_ids:
                        pieces.append(bytes(piece))
                    start += size
            column = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()),
                batch.column(2).take(pa.array(rows, pa.int64())),
                pa.array([p // length for p in places], pa.int64()), pa.array([p % length for p in places], pa.int64()),
            ]
            names = ["__id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                column.append(pa.array(pieces, pa.binary()))
                names.append("ids")
            yield pa.record_batch(column, names=names)

    return cut


def pack(
    docs: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    length: int = LENGTH,
    end: int = END,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` ids, each document followed by ``end``.

    Columns: the id, ``start`` (ids of the document before the piece), ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``, and with ``with_ids`` the ids themselves as unsigned
    little-endian 32-bit integers.  The order on the line is that of the partitions of ``docs``.
    """
    key = StructField("__id", docs.schema[row_id].dataType)
    first = StructType([key, StructField("part", IntegerType()), StructField("before", LongType()), StructField("doc_tokens", LongType()), StructField("ids", BinaryType())])
    tokens = stored(docs.select(F.col(row_id).alias("__id"), F.col(text).alias("__text")).mapInArrow(_tokenizing(vocabulary, end), first), "packing")
    in_order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
        .select("part", F.coalesce(F.sum("total").over(in_order), F.lit(0)).alias("first"))
    )  # one row of two numbers for each task of pass one
    second = StructType([key, *[StructField(c, LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]] + [StructField("ids", BinaryType())] * with_ids)
    placed = tokens.join(F.broadcast(totals), "part").select("__id", (F.col("first") + F.col("before")).alias("place"), "doc_tokens", "ids")
    return placed.mapInArrow(_cutting(length, with_ids), second).withColumnRenamed("__id", row_id)


def sequences(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """A row per sequence: ``sequence_id, tokens, padding, pieces``; a last, short sequence is padded
    to ``length`` unless its length is a power of two."""
    tokens = F.sum("length")
    power = F.bit_count(F.col("tokens")) == 1
    return (
        pieces.groupBy("sequence_id").agg(tokens.alias("tokens"), F.count(F.lit(1)).alias("pieces"))
        .withColumn("padding", F.when(power, F.lit(0)).otherwise(F.lit(length) - F.col("tokens")))
    )
