"""Language identification: the family first, then one-versus-one inside it.

Features are hashed letter trigrams of the lower-cased text, as shares of all its trigrams.  Linear
support vector machines, one for each pair of families and one for each pair of languages of a
family, are fitted on a sample of labelled rows: every language is in it, with fewer rows each where
there are many.  A text first takes the family that wins
most of its pairs, then the language that wins most inside that family.  Prediction is a map over
whole texts that sees nothing but the text.

Every machine is fitted in a task of its own, from at most about ``2 * ROWS_PER_SIDE`` sparse rows.  The
number of pairs would grow as the square of a family's languages, so a family of more than ``MOST_PAIRED``
is first split into groups of like languages, by halving along the widest axis of their mean sketches,
and a text takes the group before the language.  The driver holds a name, a count, a sketch of 64 numbers
and about four vectors of weights (16 KB each) for each language of such a family.

Edge cases: a null text, one without a letter, and any text when nothing could be learned is ``und``
with score 0; ties in votes go to the larger sum of margins, then to the first name; repeated rows
are predicted alike; a row without an id is predicted, but neither held out nor learned from; an empty
table gives an empty result; columns named ``lang_pred`` or ``score`` give way to the results, others stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerloom.llm.shared import discard, stored
from ledgerloom.llm.text_maps import map_texts
from ledgerloom.llm.vocabularies import release

BUCKETS = 1 << 12
#: The bound of the training sample: about so many rows of each language, and so many rows in all; where
#: there are many languages, each has an equal part of these, but not under the least number.
ROWS_PER_LANGUAGE = 500
ROWS_IN_ALL = 50_000
LEAST_ROWS = 50
#: About so many rows at most on either side of a machine.
ROWS_PER_SIDE = 2000
#: A family with more languages is split into groups of at most ``IN_GROUP``, and so are the groups.
MOST_PAIRED, IN_GROUP = 16, 8
#: Numbers of a sketch, sums of neighbouring buckets.
SKETCH = 64
UNKNOWN = "und"
#: Texts counted at once, and characters after which a part is folded into the counts.
ROWS = 256
LINE = 2_000_000
#: Scale of the shares, penalty and passes of the fit.
SCALE, PENALTY, PASSES = 50.0, 1.0, 30

# Families of ISO 639-1 codes; any other language is in the family "other".
FAMILIES = {
    "germanic": "af da de en is lb nl no nb nn sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "semitic": "am ar he mt",
    "sinitic": "zh yue",
}


def family_of(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((family for family, codes in FAMILIES.items() if code in codes.split()), "other")


@lru_cache(maxsize=1)
def _folds() -> np.ndarray:
    """The lower-case letter of every code point; 0 for what is no letter."""
    folds = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            lower = letter.lower()
            folds[point] = ord(lower) if len(lower) == 1 else point
    return folds


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed trigrams, a row per text, and whether the text has a letter.

    A text is laid between two gaps.  Trigrams without a letter in the middle are left out.
    """
    counts, lettered = np.zeros((len(texts), BUCKETS), np.float32), np.zeros(len(texts), bool)

    def add(first: int, run: list[str]) -> None:
        line = _folds()[np.frombuffer((" " + "  ".join(run) + " ").encode("utf-32-le"), np.uint32)]
        owner = np.repeat(np.arange(len(run)), [len(t) + 2 for t in run])[1:-1]
        some = np.flatnonzero(line[1:-1])
        mixed = (line[:-2] * np.uint32(0x9E3779B1)) ^ (line[1:-1] * np.uint32(0x85EBCA6B) + np.uint32(0x27D4EB2F)) ^ (line[2:] * np.uint32(0xC2B2AE35))
        mixed = mixed[some]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        places = owner[some] * BUCKETS + (mixed >> np.uint32(20)).astype(np.int64)
        counts[first:first + len(run)] += np.bincount(places, minlength=len(run) * BUCKETS).reshape(len(run), BUCKETS)
        lettered[first + owner[some]] = True

    first, size, run = 0, 0, []
    for row, text in enumerate(texts):
        run.append(text)
        size += len(text)
        if size > LINE or row == len(texts) - 1:
            add(first, run)
            first, size, run = row + 1, 0, []
    return counts, lettered


def shares(counts: np.ndarray) -> np.ndarray:
    """Scaled shares with a constant for the intercept."""
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return np.hstack([counts * (SCALE / total), np.ones((len(counts), 1), np.float32)]).astype(np.float32)


def fit_svm(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Weights of a linear support vector machine (squared hinge), by dual coordinate descent."""
    y = np.where(positive, 1.0, -1.0)
    duals, weights = np.zeros(len(x)), np.zeros(x.shape[1])
    curvature = np.einsum("ij,ij->i", x, x) + 0.5 / PENALTY
    order = np.random.RandomState(7)
    for _ in range(PASSES):
        for i in order.permutation(len(x)):
            slope = y[i] * (x[i] @ weights) - 1 + duals[i] * 0.5 / PENALTY
            dual = max(duals[i] - slope / curvature[i], 0.0)
            if dual != duals[i]:
                weights += (dual - duals[i]) * y[i] * x[i]
                duals[i] = dual
    return weights


class Discriminator:
    """Pairwise machines between names; the name with most won pairs is chosen.

    ``members`` holds, for every name that stands for several languages, the discriminator inside it.
    """

    def __init__(self, names: list[str], members: list[Discriminator | None] | None = None):
        self.names = sorted(names)
        self.members = members or [None] * len(self.names)
        self.pairs = list(combinations(range(len(self.names)), 2))
        self.weights = np.zeros((BUCKETS + 1, len(self.pairs)), np.float32)

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen number per row and its confidence: the surest loss it escaped, from 0 to 1."""
        margins = x @ self.weights
        votes, sums, least = (np.zeros((len(x), len(self.names))) for _ in range(3))
        least += np.inf
        for k, (a, b) in enumerate(self.pairs):
            for name, margin in ((a, margins[:, k]), (b, -margins[:, k])):
                votes[:, name] += margin > 0
                sums[:, name] += margin
                least[:, name] = np.minimum(least[:, name], margin)
        best = np.lexsort((-np.arange(len(self.names)) + np.zeros_like(votes), sums, votes), axis=1)[:, -1]
        margin = np.clip(least[np.arange(len(x)), best], -30, 30)
        return best, 1 / (1 + np.exp(-2 * margin))

    def languages(self, k: int) -> list[str]:
        """The languages that the k-th name stands for."""
        inside = self.members[k]
        return [self.names[k]] if inside is None else [n for j in range(len(inside.names)) for n in inside.languages(j)]

    def decide(self, x: np.ndarray, rows: np.ndarray, names: np.ndarray, sure: np.ndarray) -> None:
        """Writes the language and the least confidence on the way to it, for the given rows."""
        best, inside = self(x[rows])
        sure[rows] = np.minimum(sure[rows], inside)
        for k, member in enumerate(self.members):
            chosen = rows[best == k]
            if member is None:
                names[chosen] = self.names[k]
            elif len(chosen):
                member.decide(x, chosen, names, sure)


def _halves(names: list[str], sketches: dict[str, np.ndarray], times: int) -> list[list[str]]:
    """The names halved up to so often, along the widest axis of their sketches, until they are few."""
    if times == 0 or len(names) <= IN_GROUP:
        return [names]
    around = np.array([sketches[n] for n in names])
    around = around - around.mean(axis=0)
    axis = np.linalg.svd(around, full_matrices=False)[2][0]
    along = [names[i] for i in np.lexsort((np.arange(len(names)), np.round(around @ axis, 9)))]
    middle = len(names) // 2
    return _halves(sorted(along[:middle]), sketches, times - 1) + _halves(sorted(along[middle:]), sketches, times - 1)


def family_tree(name: str, languages: list[str], sketches: dict[str, np.ndarray]) -> Discriminator:
    """The discriminator of a family: flat where it has few languages, else over groups of like ones."""
    if len(languages) <= MOST_PAIRED:
        return Discriminator(languages)
    groups = _halves(sorted(languages), sketches, 4)
    names = [f"{name}/{k:02d}" for k in range(len(groups))]
    return Discriminator(names, [family_tree(n, group, sketches) for n, group in zip(names, groups)])


class LanguageModel:
    def __init__(self, languages: list[str], sketches: dict[str, np.ndarray] | None = None):
        families: dict[str, list[str]] = {}
        for name in languages:
            families.setdefault(family_of(name), []).append(name)
        self.families = Discriminator(list(families), [family_tree(f, families[f], sketches or {}) for f in sorted(families)])

    def nodes(self) -> list[Discriminator]:
        """All discriminators, each before those inside it."""
        found = [self.families]
        for node in found:
            found += [member for member in node.members if member is not None]
        return found

    @property
    def members(self) -> list[Discriminator]:
        """The discriminators between languages."""
        return [node for node in self.nodes()[1:] if all(member is None for member in node.members)]

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = []
        for low in range(0, len(texts), ROWS):
            part = [t or "" for t in texts[low:low + ROWS]]
            counts, lettered = trigram_counts(part)
            names, sure = np.full(len(part), UNKNOWN, object), np.zeros(len(part))
            if self.families.names:
                sure += 1
                self.families.decide(shares(counts), np.arange(len(part)), names, sure)
            found += [(n, float(s)) if has else (UNKNOWN, 0.0) for n, s, has in zip(names, sure, lettered)]
        return found


def held_out(row_id: Column) -> Column:
    """Rows that are not learned from: a quarter by the checksum of the id."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def rows_of_each(languages: int) -> int:
    """How many rows of each language are learned from."""
    return max(min(ROWS_PER_LANGUAGE, ROWS_IN_ALL // max(languages, 1)), LEAST_ROWS)


def training_sample(docs: DataFrame, row_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, text`` of about ``rows_of_each`` labelled rows of every language, chosen by a hash of the id."""
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(row_id).isNotNull() & ~held_out(F.col(row_id)))
    counts = labelled.groupBy(F.col(lang).alias("__lang")).agg(F.count(F.lit(1)).alias("__count")).collect()
    wanted = rows_of_each(len(counts))
    schema = StructType([StructField("__lang", docs.schema[lang].dataType), StructField("__share", DoubleType())])
    drawn = docs.sparkSession.createDataFrame([(name, wanted / count) for name, count in counts], schema)
    draw = F.shiftrightunsigned(F.xxhash64(row_id, F.lit("language sample")), 11) / F.lit(float(1 << 53))
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
    chosen = rows.join(F.broadcast(drawn), F.col("lang") == F.col("__lang")).where(F.col("draw") < F.col("__share"))
    return chosen.select("lang", "text")


def _sparse_counts(sample: DataFrame) -> DataFrame:
    """``lang, places, counts, sketch`` of every row, worked out where the rows are."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                counts, _ = trigram_counts(part.column(1).to_pylist())
                places = [np.flatnonzero(row).astype(np.uint16) for row in counts]
                sketches = shares(counts)[:, :BUCKETS].reshape(len(counts), SKETCH, -1).sum(axis=2).astype(np.float64)
                yield pa.record_batch([
                    part.column(0), pa.array([p.tobytes() for p in places], pa.binary()),
                    pa.array([row[p].tobytes() for row, p in zip(counts, places)], pa.binary()),
                    pa.array(list(sketches), pa.list_(pa.float64()))], names=["lang", "places", "counts", "sketch"])

    return sample.mapInArrow(counted, "lang string, places binary, counts binary, sketch array<double>")


def _fit_one(group: pd.DataFrame) -> pd.DataFrame:
    """The weights of one machine from the rows of both its sides, whatever order they come in."""
    release()
    counts = np.zeros((len(group), BUCKETS), np.float32)
    for row, places, values in zip(counts, group["places"], group["counts"]):
        row[np.frombuffer(places, np.uint16)] = np.frombuffer(values, np.float32)
    order = sorted(range(len(group)), key=lambda i: (group["lang"].iat[i], counts[i].tobytes()))
    weights = fit_svm(shares(counts[order]), group["first"].to_numpy(bool)[order]).astype(np.float32)
    return pd.DataFrame({"machine": [group["machine"].iat[0]], "weights": [weights.tobytes()]})


def fit(sample: DataFrame) -> LanguageModel:
    """A model of the sample.  Each machine is fitted in a task; only weights come to the driver."""
    rows = stored(_sparse_counts(sample), "language-sample")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    sketches = {}
    if len(sizes) > MOST_PAIRED:
        means = F.array(*[F.round(F.avg(F.col("sketch")[i]), 9) for i in range(SKETCH)])
        sketches = {r["lang"]: np.array(r["mean"]) for r in rows.groupBy("lang").agg(means.alias("mean")).collect()}
    model = LanguageModel(sorted(sizes), sketches)
    places, seats = [], []
    for node in model.nodes():
        inside = [node.languages(k) for k in range(len(node.names))]
        share = [ROWS_PER_SIDE / max(sum(sizes[n] for n in names), 1) for names in inside]
        for column, pair in enumerate(node.pairs):
            seats += [(name, len(places), k == pair[0], share[k]) for k in pair for name in inside[k]]
            places.append((node, column))
    if places:
        spark = rows.sparkSession
        held = spark.createDataFrame(seats, "lang string, machine int, first boolean, share double")
        draw = F.shiftrightunsigned(F.xxhash64("lang", "places", "counts"), 11) / F.lit(float(1 << 53))
        dealt = rows.drop("sketch").withColumn("draw", draw).join(F.broadcast(held), "lang").where("draw < share")
        fitted = stored(dealt.drop("draw", "share").groupBy("machine").applyInPandas(_fit_one, "machine int, weights binary"), "language-machines")
        for r in fitted.toLocalIterator():  # the machines are fitted by now; a file of them at a time is read
            node, column = places[r["machine"]]
            node.weights[:, column] = np.frombuffer(r["weights"], np.float32)
        discard(fitted)
    discard(rows)
    return model


def predict_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score`` instead of the text."""

    def make() -> Callable[[list[str | None]], list[pa.Array]]:
        def predict(texts: list[str | None]) -> list[pa.Array]:
            found = model(texts)
            return [pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())]

        return predict

    return map_texts(docs, text, [StructField("lang_pred", StringType()), StructField("score", DoubleType())], make)
