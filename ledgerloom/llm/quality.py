"""Quality rules: hashed n-gram likelihood ratio of trusted text against the whole corpus.

Character trigrams are hashed into a fixed number of buckets.  Two multinomials over the buckets are
counted: one over the whole corpus, one over trusted documents, which labels call good and not toxic.
Both count every document of theirs.  Which documents are trusted is told to the map tasks by two bit
fields of fixed size; only texts that these leave open are shuffled.  A document's score is the mean, over its trigrams, of the logarithm of the
ratio of the two (smoothed) probabilities, so that it does not depend on the length.  Every document
is held against one fixed threshold.  Base rules on word counts and repetition come first.

Edge cases: a null or empty text has no words and fails the base rules; a text of under three
characters scores 0; without any trusted document all scores are 0; rows pass one by one, so ties and
repeated rows get equal verdicts; an empty table gives an empty result; columns with the names of results
give way to them, others stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from ledgerloom.llm import ngram_join
from ledgerloom.llm.shared import WORD, checkpointed
from ledgerloom.llm.text_maps import ROWS, map_texts
from ledgerloom.llm.vocabularies import release

BUCKETS = 1 << 16
#: Added to the count of each bucket.
SMOOTHING = 1.0
#: The lowest mean log ratio that is kept.
THRESHOLD = -0.75
FEWEST_WORDS = 10
MOST_REPEATED = 20  # percent of the words
WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Characters worked on at once.
LINE = 250_000

_words = re.compile(WORD).findall


def trigram_buckets(joined: str) -> np.ndarray:
    """The bucket of the trigram at each place of a line but the last two."""
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    mixed = (points[:-2] * np.uint32(0x9E3779B1)) ^ (points[1:-1] * np.uint32(0x85EBCA6B) + np.uint32(0x27D4EB2F)) ^ (points[2:] * np.uint32(0xC2B2AE35))
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(16)).astype(np.int32)


def lines(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of bounded total length (a longer text is alone), each with its first row."""
    first, size, run = 0, 0, []
    for row, text in enumerate(texts):
        run.append(text or "")
        size += len(run[-1])
        if size > LINE:
            yield first, run
            first, size, run = row + 1, 0, []
    if run:
        yield first, run


def _borders(run: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """First place, and number of trigrams, of each text of a joined line."""
    sizes = np.fromiter(map(len, run), np.int64, len(run))
    return np.cumsum(sizes) - sizes, np.maximum(sizes - 2, 0)


def bucket_counts(docs: DataFrame, text: str) -> DataFrame:
    """``bucket, n`` over all texts: each task sums up its own, then the tasks are added up."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, run in (line for low in range(0, batch.num_rows, ROWS) for line in lines(batch.column(0).slice(low, ROWS).to_pylist())):
                joined = "".join(run)
                if len(joined) < 3:
                    continue
                found = trigram_buckets(joined)
                inside = np.ones(len(found) + 2, bool)
                ends = np.cumsum([len(t) for t in run])[:-1]
                inside[ends[ends >= 1] - 1] = False
                inside[ends[ends >= 2] - 2] = False
                total += np.bincount(found[inside[:len(found)]], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return docs.select(text).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted_documents(docs: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and text of all documents that labels call good and not toxic.

    A bit field of the good ids lets documents pass where they are, in DataFrame functions: a task that
    counts what passes holds one Python worker, not two.  The ids that pass by chance are
    found by a join of ids alone and make a second field: what passes the first and is not in the
    second is trusted, and what is in both is looked up.
    """
    kind = docs.schema[row_id].dataType
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select(F.col("doc_id").cast(kind).alias("id")).where("id is not null")
    first = checkpointed(ngram_join._field_words(good))
    rows = docs.select(F.col(row_id).alias("id"), F.col(text).alias("text"))

    def marked(rows: DataFrame, field: DataFrame, name: str) -> DataFrame:
        """The rows with ``name``: whether they are in the field, whose words (of fixed number at most) go to all tasks."""
        place = ngram_join.field_place("id")
        words = F.broadcast(field.select(F.col("word").alias("__word"), F.col("bits").alias("__bits")))
        inside = F.coalesce(F.expr("shiftright(__bits, cast(__place % 64 as int)) & 1"), F.lit(0)) == 1
        return rows.withColumn("__place", place).join(words, F.floor(F.col("__place") / 64) == F.col("__word"), "left").withColumn(name, inside).drop("__place", "__word", "__bits")

    by_chance = marked(rows.select("id"), first, "__first").where("__first").select("id").distinct().join(good, "id", "leftanti")
    second = checkpointed(ngram_join._field_words(by_chance))
    passing = marked(rows, first, "__first").where("__first")
    if second.isEmpty():
        found = passing
    else:
        both = marked(passing, second, "__second")
        found = both.where("not __second").select("id", "text").union(both.where("__second").select("id", "text").join(good, "id", "leftsemi"))
    return found.select(F.col("id").alias(row_id), F.col("text").alias(text))


def log_ratios(trusted: DataFrame, corpus: DataFrame, text: str = "text") -> np.ndarray:
    """The log ratio of each bucket: a table of fixed size, whatever the corpus."""
    counts = np.zeros((2, BUCKETS))
    for row, docs in enumerate((trusted, corpus)):
        for bucket, n in bucket_counts(docs, text).collect():
            counts[row, bucket] = n
    if not counts[0].any():
        return np.zeros(BUCKETS)
    shares = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.log(shares[0] / shares[1])


def scores(texts: list[str | None], ratios: np.ndarray) -> np.ndarray:
    """The mean log ratio of each text."""
    result = np.zeros(len(texts))
    for first, run in lines(texts):
        joined = "".join(run)
        starts, sizes = _borders(run)
        if len(joined) < 3:
            continue
        sums = np.concatenate([[0.0], np.cumsum(ratios[trigram_buckets(joined)])])
        starts = np.minimum(starts, len(sums) - 1)
        result[first:first + len(run)] = (sums[starts + sizes * (sizes > 0)] - sums[starts]) / np.maximum(sizes, 1)
    return result


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of ``WINDOW`` words found twice or more."""
    if len(words) <= WINDOW:
        return 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    n = len(ids) - WINDOW + 1
    if len(known) ** WINDOW < 1 << 62:
        windows = np.zeros(n, np.int64)
        for k in range(WINDOW):
            windows = windows * len(known) + ids[k:k + n]
    else:  # number the windows step by step
        windows = ids[:n]
        for k in range(1, WINDOW):
            _, windows = np.unique(windows * len(known) + ids[k:k + n], return_inverse=True)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += twice
    edges[WINDOW:WINDOW + n] -= twice
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    words = _words(text)
    seen = [line for line in text.split("\n") if line and _words(line)] if "\n" in text else []
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(seen) - len(set(seen)), repeated_words(words)


FIELDS = [
    *(StructField(c, LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    StructField("base_failed", BooleanType()), StructField("llr", DoubleType()), StructField("kept", BooleanType()),
]


def _judging(ratios: np.ndarray, threshold: float) -> Callable[[], Callable[[list[str | None]], list[pa.Array]]]:
    def judge(texts: list[str | None]) -> list[pa.Array]:
        counts = np.array([base_counts(t or "") for t in texts], np.int64).reshape(len(texts), 5)
        failed = (counts[:, 0] < FEWEST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
        found = scores(texts, ratios)
        return [*map(pa.array, counts.T.copy()), pa.array(failed), pa.array(found), pa.array(~failed & (found >= threshold))]

    return lambda: judge


def judge_quality(docs: DataFrame, ratios: np.ndarray, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows with the base counts, ``base_failed``, ``llr`` and ``kept`` instead of the text."""
    return map_texts(docs, text, FIELDS, _judging(ratios, threshold))


def kept_documents(docs: DataFrame, ratios: np.ndarray, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the rules keep, unchanged."""
    place = [c.lower() for c in docs.columns].index(text.lower())
    judging = _judging(ratios, threshold)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        judge = judging()
        for whole in batches:
            for batch in (whole.slice(low, ROWS) for low in range(0, whole.num_rows, ROWS)):
                yield batch.filter(judge(batch.column(place).to_pylist())[-1])

    return docs.mapInArrow(kept, docs.schema)
