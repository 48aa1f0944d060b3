"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

A document is described by a few statistics of its whole text: lengths on a log scale, and shares of kinds
of characters, words and lines through the arcsine of their square root, which steadies their variance.
Each class has its mean and its covariance, shrunk towards the pooled one and then towards a multiple of
the unit matrix.  The score is the logistic function of the difference of the two log densities plus the log
ratio of the class sizes; the densities come from Mahalanobis distances by the inverse Cholesky factors,
which are worked out once.

All labelled rows are learned from.  Statistics are whole numbers (of ``UNIT``), and what is added up are
their sums and products, so the model depends on the rows alone, not on how they lie in partitions.

Edge cases: a null or empty text has the statistics of no words and is scored like others; labels that are
null or neither 0 nor 1, rows without an id, and labels of unknown ids are not learned from; repeated rows and
labels count each; without rows of both classes all scores are the smoothed share of good rows; an empty table
gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from ledgerloom.llm.shared import WORD, stored
from ledgerloom.llm.text_maps import map_texts
from ledgerloom.llm.vocabularies import release

#: How far a class covariance moves to the pooled one, and then to a multiple of the unit matrix.
TO_POOLED, TO_UNIT = 0.7, 0.1
#: The lowest score that is called good.
GOOD_FROM = 0.3
#: Parts of a statistic's unit.
UNIT = 1 << 12

SYMBOLS = "#*$%&|<>@^~\\{}[]=+_"
NAMES = (
    "log_words", "log_characters_a_word", "log_words_a_line", "log_longest_word", "upper", "digits", "punctuation", "symbols",
    "others", "same_mark_again", "words_without_letter", "capital_words", "short_words", "distinct_words", "commonest_word",
    "same_word_again", "repeated_lines",
)

_words = re.compile(WORD).findall
_marks_again = re.compile(r"([^\w\s])\1").findall
_lettered = re.compile(r"[^\W\d_]").search


def statistics(text: str) -> list[float]:
    """The statistics of a text, in the order of ``NAMES``."""
    words = _words(text)
    n = len(words)
    joined = "".join(words)
    size = len(joined)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(_KINDS[np.minimum(points, len(_KINDS) - 1)], minlength=5) if size else np.zeros(5, np.int64)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]

    def share(part: float, whole: float) -> float:
        return float(np.arcsin(np.sqrt(min(part / whole, 1.0)))) if whole else 0.0

    return [
        float(np.log1p(n)), float(np.log1p(size / max(n, 1))), float(np.log1p(n / max(len(lines), 1))),
        float(np.log1p(max(map(len, counts), default=0))),
        *(share(int(kinds[k]), size) for k in range(5)),
        share(len(_marks_again(joined)), size),
        share(sum(c for w, c in counts.items() if not _lettered(w)), n),
        share(sum(c for w, c in counts.items() if w[0].isupper()), n),
        share(sum(c for w, c in counts.items() if len(w) <= 3), n),
        share(len(counts), n),
        share(max(counts.values(), default=0) - 1, n) if n else 0.0,
        share(sum(map(str.__eq__, words, words[1:])), n),
        share(len(lines) - len(set(lines)), len(lines)),
    ]


def _kinds() -> np.ndarray:
    """The kind of each code point up to a limit: upper case, digit, punctuation, symbol, other; 5 is a letter."""
    kinds = np.full(0x3000, 4, np.uint8)
    for point in range(len(kinds)):
        c = chr(point)
        kinds[point] = 0 if c.isupper() else 5 if c.isalpha() else 1 if c.isdigit() else 3 if c in SYMBOLS else 2 if point < 0x80 else 4
    return kinds


_KINDS = _kinds()


def described(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``statistics``, as 32-bit whole numbers of parts of a unit, instead of the text."""

    def make() -> Callable[[list[str | None]], list[pa.Array]]:
        def compute(texts: list[str | None]) -> list[pa.Array]:
            found = np.rint(np.array([statistics(t or "") for t in texts]).reshape(len(texts), len(NAMES)) * UNIT).astype("<i4")
            return [pa.array([row.tobytes() for row in found], pa.binary())]

        return compute

    return map_texts(docs, text, [StructField("statistics", BinaryType(), False)], make)


def held_out(row_id: Column) -> Column:
    """Rows that are not learned from: a fifth by the checksum of the id."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), "<i4").reshape(len(values), len(NAMES)).astype(np.int64)


def class_sums(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per class, the sums of the products of all pairs of statistics and of a constant before them.

    ``rows`` has ``statistics, label``.  A few hundred numbers in all come to the driver.
    """
    width = len(NAMES) + 1

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release()
        for batch in batches:
            for label, part in batch.groupby("label"):
                x = _matrix(part["statistics"].tolist())
                x = np.hstack([np.ones((len(x), 1), np.int64), x])
                yield pd.DataFrame({"label": int(label), "place": np.arange(width * width), "total": (x.T @ x).ravel()})

    parts = rows.select("statistics", "label").mapInPandas(summed, "label int, place int, total long")
    totals = parts.groupBy("label", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums: dict[int, np.ndarray] = {}
    for label, place, total in totals:
        sums.setdefault(label, np.zeros(width * width))[place] = float(total)
    return {label: total.reshape(width, width) for label, total in sums.items()}


def labelled(rows: DataFrame, labels: DataFrame, row_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """``statistics, label`` of the rows that may be learned from and have a label."""
    kind = rows.schema[row_id].dataType
    known = labels.where(F.col(quality).isin(0, 1)).select(F.col(row_id).cast(kind).alias("__id"), F.col(quality).cast("int").alias("label"))
    learned = rows.where(~held_out(F.col(row_id))).select(F.col(row_id).alias("__id"), "statistics")
    return learned.join(known, "__id").select("statistics", "label")


class QualityModel:
    """Means, inverse Cholesky factors and constants of the two classes."""

    def __init__(self, sums: dict[int, np.ndarray], to_pooled: float = TO_POOLED, to_unit: float = TO_UNIT):
        sizes = [sums[k][0, 0] if k in sums else 0.0 for k in (0, 1)]
        self.prior = float(np.log((sizes[1] + 1) / (sizes[0] + 1)))
        self.parts = []
        if min(sizes) == 0:
            return
        means = [sums[k][0, 1:] / sizes[k] / UNIT for k in (0, 1)]
        spreads = [sums[k][1:, 1:] / UNIT / UNIT - sizes[k] * np.outer(means[k], means[k]) for k in (0, 1)]
        pooled = (spreads[0] + spreads[1]) / sum(sizes)
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 0)) + 1 / UNIT
        unit = np.outer(self.scale, self.scale)
        for k in (0, 1):
            mixed = ((1 - to_pooled) * spreads[k] + to_pooled * sizes[k] * pooled) / sizes[k] / unit
            shrunk = (1 - to_unit) * mixed + to_unit * max(np.trace(mixed) / len(mixed), 1 / UNIT) * np.eye(len(mixed))
            factor = np.linalg.cholesky(shrunk)
            self.parts.append((means[k] / self.scale, np.linalg.inv(factor).T, float(np.log(np.diag(factor)).sum())))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of statistics in parts of a unit."""
        odds = np.full(len(x), self.prior)
        for sign, (mean, whiten, log_size) in zip((-1, 1), self.parts):
            z = (x / UNIT / self.scale - mean) @ whiten
            odds -= sign * (0.5 * np.einsum("ij,ij->i", z, z) + log_size)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def score_quality(rows: DataFrame, model: QualityModel, good_from: float = GOOD_FROM) -> DataFrame:
    """The rows with ``score`` and ``predicted`` instead of ``statistics``."""
    others = [c for c in rows.columns if c not in ("statistics", "score", "predicted")]
    schema = StructType([*rows.select(*others).schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model(_matrix(batch.column(0).to_pylist()))
            yield pa.record_batch([*batch.columns[1:], pa.array(scores), pa.array((scores >= good_from).astype(np.int32))],
                                  names=[*batch.schema.names[1:], "score", "predicted"])

    return rows.select("statistics", *others).mapInArrow(scored, schema)


def classify_quality(docs: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, ``held_out``, ``score`` and ``predicted`` of each row; texts are read once."""
    rows = stored(described(docs.select(row_id, text), text), "statistics")
    model = QualityModel(class_sums(labelled(rows, labels, row_id)))
    return score_quality(rows.withColumn("held_out", held_out(F.col(row_id))), model)
