"""Periodic runs of words, found as branching tandem repeats in an enhanced suffix array.

Texts are numbered word by word and laid end to end, some at a time; words of different texts are different
symbols.  The suffix array comes from prefix doubling, which sorts again only what is not yet told apart,
and the LCP table from Kasai's walk.  A boundary of the array with its nearest smaller neighbours to the left
and right is an LCP interval cut in two.  The suffixes of the smaller half are asked whether the
suffix ``depth`` words before or after lies in the other half, by its place in the inverse array alone: if so,
a square of that depth ends where no further word continues it.  Such squares are rotated to the left as far
as they go; squares with one end and one start are one run, which keeps the smallest period.
No tree is built.

A run of exponent ``e`` shows in an interval of ``e`` suffixes or more, so smaller intervals are passed over.

Edge cases: a null, empty or wordless text has no run and an empty collapsed text; repeated rows get equal
results; rows without an id are handled like others; an empty table gives an empty result; other columns pass
unchanged, but those named ``runs`` or ``collapsed`` give way to the results.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ledgerloom.llm.shared import WORD
from ledgerloom.llm.text_maps import map_texts

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_EXPONENT = 6, 4
#: Words laid end to end at once (a longer text is alone), and suffixes asked at once.
WORDS, SUFFIXES = 200_000, 2_000_000

_words = re.compile(WORD).findall

Run = tuple[int, int, int]  # start, length, period


def suffix_array(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the suffixes in order, and the inverse; ``ends`` has the end of each place's text.

    Symbols of different texts differ.  A suffix comes before those that continue it.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    keys = symbols[order]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    depth = 1
    while True:
        opens = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank[order] = np.maximum.accumulate(np.where(opens, slots, 0))
        alone = opens & np.concatenate([opens[1:], [True]])
        order, slots = order[~alone], slots[~alone]
        if not len(order):
            break
        after = order + depth
        inside = after < ends[order]
        keys = rank[order] * (n + 1) + np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        again = np.argsort(keys, kind="stable")
        order, keys = order[again], keys[again]
        depth *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    return array, rank


def common_prefixes(symbols: np.ndarray, array: np.ndarray, rank: np.ndarray) -> list[int]:
    """Of each suffix in order, the number of symbols it shares with the one before."""
    before = np.where(rank > 0, array[rank - 1], len(symbols)).tolist()
    text = [*symbols.tolist(), -1]
    shared, prefixes = 0, []
    for place, other in enumerate(before):
        while text[place + shared] == text[other + shared] if other + shared < len(text) else False:
            shared += 1
        prefixes.append(shared)
        if shared:
            shared -= 1
    return np.asarray(prefixes, np.int64)[array].tolist()


def halved_intervals(prefixes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Of each boundary, where the half before it starts and where the half after it ends."""
    n = len(prefixes)
    starts, stops, open_ = [0] * n, [n] * n, []
    for k, depth in enumerate(prefixes):
        while open_ and prefixes[open_[-1]] > depth:
            stops[open_.pop()] = k
        starts[k] = open_[-1] if open_ else 0
        open_.append(k)
    return np.asarray(starts, np.int64), np.asarray(stops, np.int64)


def branching_squares(
    array: np.ndarray, rank: np.ndarray, depths: np.ndarray, starts: np.ndarray, stops: np.ndarray, nodes: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First places and depths of the squares that the halved intervals ``nodes`` show."""
    n = len(array)
    left, right = nodes - starts[nodes], stops[nodes] - nodes
    small = np.minimum(left, right)
    upto = np.cumsum(small)
    low = 0
    while low < len(nodes):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + SUFFIXES, "right")))
        part, sizes, first = nodes[low:high], small[low:high], left[low:high] <= right[low:high]
        begin = np.where(first, starts[part], part)
        other_low, other_high = np.where(first, part, starts[part]), np.where(first, stops[part], part)
        owner = np.repeat(np.arange(len(part)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        suffix, depth = array[begin[owner] + at], depths[part][owner]
        for step, place in ((depth, suffix), (-depth, suffix - depth)):
            partner = suffix + step
            there = (partner >= 0) & (partner < n)
            slot = rank[np.where(there, partner, 0)]
            hit = there & (slot >= other_low[owner]) & (slot < other_high[owner])
            yield place[hit], depth[hit]
        low = high


def _rotated(symbols: np.ndarray, start: int, period: int, least: int) -> int:
    """How far to the left a square goes on keeping its period."""
    width = 16
    while start > least:
        some = min(width, start - least)
        differ = np.flatnonzero(symbols[start - some:start] != symbols[start - some + period:start + period])
        if len(differ):
            return start - some + int(differ[-1]) + 1
        start, width = start - some, width * 2
    return start


def find_runs(texts: list[list[str]], least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> list[list[Run]]:
    """The runs of each text by start, then period."""
    found: list[list[Run]] = [[] for _ in texts]
    lengths = np.array([len(t) for t in texts], np.int64)
    total = int(lengths.sum())
    if not total:
        return found
    known: dict[str, int] = {}
    words = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, total)
    owner = np.repeat(np.arange(len(texts)), lengths)
    borders = np.concatenate([[0], np.cumsum(lengths)])
    symbols = owner * len(known) + words
    array, rank = suffix_array(symbols, borders[owner + 1])
    prefixes = common_prefixes(symbols, array, rank)
    starts, stops = halved_intervals(prefixes)
    depths = np.asarray(prefixes, np.int64)
    wide = (depths > 0) & (stops - starts >= least_exponent) & (least_exponent * depths <= lengths[owner[array]])
    turns = least_exponent - 2
    squares = set()
    for place, depth in branching_squares(array, rank, depths, starts, stops, np.flatnonzero(wide)):
        farthest = place - turns * depth
        able = farthest >= borders[owner[place]]
        place, depth, farthest = place[able], depth[able], farthest[able]
        if turns:
            going = (symbols[place - 1] == symbols[place - 1 + depth]) & (symbols[farthest] == symbols[farthest + depth])
            place, depth = place[going], depth[going]
        squares.update(zip((place + 2 * depth).tolist(), depth.tolist()))
    reached: dict[int, int] = {}
    for end, period in sorted(squares):
        if reached.get(end, end) <= end - 2 * period:
            continue  # a run of a part of this period reaches as far
        text = int(owner[end - 1])
        start = _rotated(symbols, end - 2 * period, period, int(borders[text]))
        reached[end] = min(start, reached.get(end, end))
        if end - start >= max(least_words, least_exponent * period):
            found[text].append((start - int(borders[text]), end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[str], runs: list[Run]) -> str:
    """The words but those that a run holds after its first period, joined by spaces."""
    if not runs:
        return " ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return " ".join(w for w, inside in zip(words, np.cumsum(edges).tolist()) if not inside)


def _batches(texts: list[str | None]) -> Iterator[list[list[str]]]:
    part, size = [], 0
    for text in texts:
        part.append(_words(text or ""))
        size += len(part[-1])
        if size > WORDS:
            yield part
            part, size = [], 0
    if part:
        yield part


RUNS = ArrayType(StructType([StructField(c, LongType(), False) for c in ("start", "length", "period")]), False)
_ARROW_RUNS = pa.list_(pa.field("element", pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")]), False))


def periodic_runs(docs: DataFrame, text: str = "text", least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """The rows with ``runs`` and ``collapsed`` instead of the text.

    A run is a stretch of words of smallest period ``period`` that no neighbour extends, of at least
    ``least_words`` words and ``least_exponent`` (2 or more) periods.
    """
    if least_exponent < 2:
        raise ValueError("a run has at least two periods")

    def make() -> Callable[[list[str | None]], list[pa.Array]]:
        def compute(texts: list[str | None]) -> list[pa.Array]:
            runs, collapsed = [], []
            for part in _batches(texts):
                some = find_runs(part, least_words, least_exponent)
                runs += [[dict(zip(("start", "length", "period"), r)) for r in held] for held in some]
                collapsed += [collapse(words, held) for words, held in zip(part, some)]
            return [pa.array(runs, _ARROW_RUNS), pa.array(collapsed, pa.string())]

        return compute

    return map_texts(docs, text, [StructField("runs", RUNS, False), StructField("collapsed", StringType(), False)], make)


def planted(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows; one text in ten, by its id, goes on in a period from some word on."""
    h = F.crc32(F.col(row_id).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    turns = F.ceil((n - a) / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), turns)), F.lit(1), n - a)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")
    return docs.withColumn(text, F.when((h % 10 == 0) & (n > 0), changed).otherwise(F.col(text)))


def digests(found: DataFrame) -> dict[str, Column]:
    """The columns that sum up ``runs`` and ``collapsed``."""
    runs = F.col("runs")
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return {
        "n_runs": F.size(runs).cast("long"), "start": -best["start"], "length": best["length"], "period": -best["period"],
        "exponent_milli": F.floor(1000 * best["length"] / -best["period"]),
        "runs_sha256": F.sha2(F.array_join(lines, ""), 256), "collapsed_sha256": F.sha2(F.col("collapsed"), 256),
    }
