"""Groups of spelling variants: words one edit apart, found in a trie of letter-group counts.

The letters are dealt into groups, and a word is described by how many of its letters each group has.  One
inserted, deleted or replaced letter changes these counts by a surplus of one in at most one group and a
deficit of one in at most one other.  The counts, group after group (those that differ most come first), are
the levels of a trie.  Its upper levels deal the vocabulary over tasks: a word lives in the subtree of its
first counts and asks there and in the subtrees that its budget of one surplus and one deficit can still
reach.  How many levels that takes follows from the counted sizes of the subtrees.  Inside a subtree a depth-first search spends what is left
of the budget.  Words at a leaf are looked up by their first and last half, one of which an edit leaves as
it is, and then compared letter by letter.  A subtree too large at the lowest level is cut by a hash of its
words, and every word that asks there asks each part: no word is left out.

A pair of subtrees meets once, so each near pair is found once and counted for both words.  The chain of a
word's forms at least multiplies its count at each step, so that pointer doubling needs a handful of rounds.

Edge cases: null and empty texts have no words; repeated rows count each; rows without an id count and are
not changed by ``with_slips``; words of equal count are told apart by code points; a word that is near to
none has itself as root; an empty table gives an empty result; very long words are words like others.
"""

from __future__ import annotations

import math
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import discard, stored

LETTERS = r"A-Za-z\x{C0}-\x{FF}"
LEAST_LETTERS, LEAST_COUNT = 7, 2
#: A word's form is so many times as frequent, at least.
RATIO = 10
#: Letter groups, the levels of the trie; a letter's group is its code point's remainder.
GROUPS = 12
#: Words of a subtree.
SUBTREE = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALPHABET = [*map(ord, _LOWER), *range(0xC0, 0x100)]


def letter_runs(docs: DataFrame, row_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS) -> DataFrame:
    """``id, run``: the runs of at least so many letters, with A to Z in lower case, as often as they occur."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    found = docs.select(F.col(row_id).alias("id"), F.explode(runs).alias("run"))
    return found.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))


def with_slips(runs: DataFrame) -> DataFrame:
    """The runs; one in 31, by its document and letters, lacks a letter."""
    h = F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run") + 1).cast("int")
    return runs.select("id", F.when(h % 31 == 0, F.overlay("run", F.lit(""), at, F.lit(1))).otherwise(F.col("run")).alias("run"))


def word_counts(runs: DataFrame, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    words = runs.where(F.length("run") >= least).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return words.where(F.col("n") >= least_count)


def group_counts(word: Column) -> Column:
    """How many letters of the word are in each group."""
    counts = []
    for group in range(GROUPS):
        members = "".join(chr(point) for point in _ALPHABET if point % GROUPS == group)
        counts.append(F.length(word) - F.length(F.translate(word, members, "")))
    return F.array(*counts)


def level_order(described: DataFrame) -> list[int]:
    """The groups, those whose counts differ most first: they part the words best."""
    spread = described.agg(*[F.var_pop(F.col("counts")[g]).alias(str(g)) for g in range(GROUPS)]).first()
    return sorted(range(GROUPS), key=lambda g: (-(spread[g] or 0.0), g))


def upper_counts(order: list[int], levels: int) -> Column:
    return F.array(*[F.col("counts")[g] for g in order[:levels]]).cast("array<int>")


def subtree_levels(described: DataFrame, order: list[int], most: int) -> int:
    """The upper levels that leave no subtree more than ``most`` words; all levels if none do."""
    for levels in range(GROUPS):
        sizes = described.groupBy(upper_counts(order, levels).alias("upper")).agg(F.count(F.lit(1)).alias("n"))
        if (sizes.agg(F.max("n")).first()[0] or 0) <= most:
            return levels
    return GROUPS


class Subtree:
    """The words of a subtree below its upper levels, and the search in it."""

    def __init__(self, order: list[int], levels: int, words: list[str]):
        self.levels, self.root = levels, {}
        self.level_of = [order.index(group) for group in range(GROUPS)]
        for word in words:
            node = self.root
            for count in self.counts(word):
                node = node.setdefault(count, {})
            half = len(word) // 2
            node.setdefault(("first", word[:half]), []).append(word)
            node.setdefault(("last", word[len(word) - half:]), []).append(word)
            node["half"] = half

    def counts(self, word: str) -> list[int]:
        counts = [0] * GROUPS
        for letter in word:
            counts[self.level_of[ord(letter) % GROUPS]] += 1
        return counts[self.levels:]

    def near(self, word: str, surplus: bool, deficit: bool) -> set[str]:
        """The words one edit away that the budget reaches."""
        counts, found = self.counts(word), set()
        depth, open_ = len(counts), [(self.root, 0, surplus, deficit)] if self.root else []
        while open_:
            node, level, up, down = open_.pop()
            if level == depth:
                half = node["half"]
                found.update(node.get(("first", word[:half]), ()))
                found.update(node.get(("last", word[len(word) - half:]), ()))
                continue
            count = counts[level]
            if count in node:
                open_.append((node[count], level + 1, up, down))
            if up and count + 1 in node:
                open_.append((node[count + 1], level + 1, False, down))
            if down and count - 1 in node:
                open_.append((node[count - 1], level + 1, up, False))
        return {other for other in found if one_edit(word, other)}


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter turns one word into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)  # the length of the common start, by halving
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return a[low + (len(a) == len(b)):] == b[low + 1:]


def near_pairs(described: DataFrame, most: int = SUBTREE) -> DataFrame:
    """``word, n, other, other_n``: each pair of words one edit apart, once.

    ``described`` has distinct words in ``word``, with ``n`` and their ``counts``.
    """
    order = level_order(described)
    levels = subtree_levels(described, order, most)
    living = described.select("word", "n", upper_counts(order, levels).alias("home"))
    too_large = living.groupBy(F.array_join("home", ",").alias("of")).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts")).where("parts > 1")
    too_large = F.broadcast(too_large)  # fewer rows than words / most
    moves = F.array(*[F.struct(F.lit(up).alias("up"), F.lit(down).alias("down"))
                      for up, down in product(range(-1, levels), repeat=2) if up == -1 or up != down])
    moved = F.transform("home", lambda count, level: count + (level == F.col("move.up")).cast("int") - (level == F.col("move.down")).cast("int"))
    asking = (
        living.withColumn("move", F.explode(moves)).withColumn("target", moved).where(F.col("target") >= F.col("home"))
        .select("word", "n", F.array_join("target", ",").alias("to"), (F.col("target") == F.col("home")).alias("at_home"),
                (F.col("move.up") < 0).alias("surplus"), (F.col("move.down") < 0).alias("deficit"))
        .join(too_large, F.col("to") == F.col("of"), "left")
        .select("to", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"), "word", "n", "at_home", "surplus", "deficit")
    )
    lived = living.select(F.array_join("home", ",").alias("subtree"), F.col("word").alias("living"), F.col("n").alias("living_n"))
    lived = lived.join(too_large, F.col("subtree") == F.col("of"), "left").select(
        "subtree", F.pmod(F.xxhash64("living"), F.coalesce("parts", F.lit(1))).cast("int").alias("share"), "living", "living_n")

    def met(key: tuple, lived: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        tree = Subtree(order, levels, lived["living"].tolist())
        counts = dict(zip(lived["living"].tolist(), lived["living_n"].tolist()))
        pairs = []
        if counts:
            for word, n, at_home, surplus, deficit in zip(*(asking[c].tolist() for c in ("word", "n", "at_home", "surplus", "deficit"))):
                pairs += [(word, n, other, counts[other]) for other in tree.near(word, surplus, deficit) if not at_home or other > word]
        words, ns, others, other_ns = zip(*pairs) if pairs else ((), (), (), ())
        return pd.DataFrame({"word": pd.Series(words, dtype="object"), "n": pd.Series(ns, dtype="int64"),
                             "other": pd.Series(others, dtype="object"), "other_n": pd.Series(other_ns, dtype="int64")})

    return lived.groupBy("subtree", "share").cogroup(asking.groupBy("to", "part")).applyInPandas(
        met, "word string, n long, other string, other_n long")


def roots(links: DataFrame, steps: int) -> DataFrame:
    """``word, root``: where the chain that starts at each word ends; no chain has more than ``steps`` links.

    ``links`` has ``word, form``, one row a word.
    """
    at = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        onward = at.select(F.col("word").alias("__at"), F.col("root").alias("__to"))
        at = stored(at.join(onward, F.col("root") == F.col("__at"), "left").select("word", F.coalesce("__to", "root").alias("root")), "roots")
    return at


def chain_steps(highest: int, least_count: int, ratio: int) -> int:
    """The most links of a chain whose counts grow ``ratio`` times at each one."""
    steps, count = 0, max(least_count, 1) * ratio
    while count <= highest:
        steps, count = steps + 1, count * ratio
    return steps


def spelling_variants(words: DataFrame, ratio: int = RATIO, most: int = SUBTREE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary ``word, n`` of distinct words.

    A word's form is its most frequent near word (of equals the first by code points) if that is at least
    ``ratio`` (over 1) times as frequent; its root is the end of the chain of forms.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words")
    described = stored(words.select("word", "n", group_counts(F.col("word")).alias("counts")), "words")
    lowest, highest = described.agg(F.min("n"), F.max("n")).first()
    pairs = stored(near_pairs(described, most), "near")
    both = pairs.select("word", "other", "other_n").union(pairs.select("other", "word", "n"))
    best = F.min(F.struct((-F.col("other_n")).alias("n"), "other"))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    follows = -F.col("best.n") >= ratio * F.col("n")
    formed = stored(described.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(follows, F.col("best.other")).alias("form"), F.when(follows, -F.col("best.n")).alias("form_n")), "formed")
    discard(pairs)
    discard(described)
    links = formed.where("form is not null").select("word", "form")
    ends = roots(links, chain_steps(highest or 0, lowest or 1, ratio))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
