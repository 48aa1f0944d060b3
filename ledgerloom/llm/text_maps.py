"""Maps over the texts of a table, Arrow batch by Arrow batch, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerloom.llm.vocabularies import release

#: Rows of a batch worked on at once.
ROWS = 1000

#: Bytes of a column worked on at once.
BYTES = 1 << 20

Compute = Callable[[list[str | None]], list[pa.Array]]


def bites(batches: Iterator[pa.RecordBatch], column: int, times: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``times * ROWS`` rows, and of at most ``times * BYTES`` bytes of the column or one row more."""
    for whole in batches:
        sizes = pc.fill_null(pc.binary_length(whole.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        low, ends = 0, np.cumsum(sizes)
        while low < whole.num_rows:
            high = int(np.searchsorted(ends, ends[low] - sizes[low] + times * BYTES)) + 1
            high = min(high, low + times * ROWS, whole.num_rows)
            yield whole.slice(low, high - low)
            low = high


def map_texts(docs: DataFrame, text: str, fields: list[StructField], make: Callable[[], Compute]) -> DataFrame:
    """The rows with ``fields`` worked out from the text, which is dropped unless it is a field.

    ``make`` is called once per task and gives a function from the texts of a batch to one array per
    field.  Other columns pass unchanged; one that has the name of a field gives way to it.
    """
    taken = {text.lower(), *(f.name.lower() for f in fields)}
    others = [c for c in docs.columns if c.lower() not in taken]
    schema = StructType([*(StructField(f"__{k}", docs.schema[c].dataType) for k, c in enumerate(others)), *fields])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        compute = make()
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS):
                batch = whole.slice(low, ROWS)
                results = compute(batch.column(0).to_pylist())
                yield pa.record_batch([*batch.columns[1:], *results], names=[*batch.schema.names[1:], *(f.name for f in fields)])

    rows = docs.select(F.col(text).alias("__text"), *[F.col(c).alias(f"__{k}") for k, c in enumerate(others)])
    return rows.mapInArrow(mapped, schema).withColumnsRenamed({f"__{k}": c for k, c in enumerate(others)})
