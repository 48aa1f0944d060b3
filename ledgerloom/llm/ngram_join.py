"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds the hashes of its distinct word shingles.  All sets follow one global order:
rare shingles first, by hash, then frequent ones, by hash.  Sets of similarity ``t`` share ``l``
members among the first ``n - ceil(t n) + l`` of each.  With ``l = 1`` that is the usual prefix.  A
document whose prefix promises many candidates takes a larger ``l``: a longer prefix, but a candidate
must then share that many of its members.  For a pair the smaller ``l`` of the two counts.

The steps:

1. Each text is reduced to the fingerprint of its set and to the least hashes of it, somewhat more
   than the prefix needs.  Equal sets are one node from here on.
2. Shingles are counted over all nodes.  A node that has too many frequent ones among its least
   hashes is shingled again in full; so its prefix is exact, too.
3. Prefix members become postings.  In each list the member with most estimated candidates is the
   leader; every node is verified against the leader it meets most often, its home.  Links found are
   joined to components.  Pairs inside a component need no check.
4. Two nodes of one home are compared by their differences from it, which are small: if they are not
   in one component yet, they can be linked only by sharing part of the differences.  A prefix join
   over these, rare ones first, finds the pairs.  So a large group of near copies, whose members
   share most of what they hold, is not turned into all its pairs.
5. In lists that hold several components and homes, the pairs of different components and homes that
   match often enough are verified.

Verification shingles the texts in question again and compares whole sets.  Which texts these are is
told to the map tasks by a bit field of fixed size; what passes by chance is removed by the join.

Edge cases: null and empty texts have the empty set and are linked with nothing; a text of fewer than
``SHINGLE`` words is one shingle; equal texts and repeated rows are one node; a document's length is
not bounded; rows without an id belong to the component of their set, which is null if no row has one.
Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ledgerloom.llm.components import components
from ledgerloom.llm.shared import checkpointed, discard, stored
from ledgerloom.llm.text_maps import ROWS
from ledgerloom.llm.vocabularies import hold, release

SHINGLE = 4
SIMILARITY = 85  # percent
#: The largest number of shared prefix members that is asked for.
MOST_MATCHES = 16
#: Estimated candidates of a prefix above which more matches are asked for: three more for each doubling.
COSTLY = 8
#: Nodes with a shingle above which it counts as frequent, in all or in one lot of a task.
FREQUENT, FREQUENT_IN_LOT = 64, 12
#: Shingles in a lot, and bits of the field that names texts.
LOT, FIELD_BITS = 2_000_000, 1 << 23
#: A leader is a home if a node differs from it by at most so many times what a link allows.
HOME = 3


def prefix_size(n: int | Column, percent: int = SIMILARITY):
    """``n - ceil(t n) + 1``."""
    needed = F.floor((percent * n + 99) / 100) if isinstance(n, Column) else (percent * n + 99) // 100
    return n - needed + 1


def least_size(n: int, percent: int = SIMILARITY) -> int:
    """How many of the least hashes are kept at first: room for a few frequent ones."""
    prefix = prefix_size(n, percent)
    return min(n, max(prefix + prefix // 4 + MOST_MATCHES, 96))


class Shingler:
    """The sorted hashes of the distinct word shingles of a text; A-Z count as a-z."""

    def __init__(self, size: int = SHINGLE):
        import xxhash

        self.size, self.digest = size, xxhash.xxh64_intdigest

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.int64)
        if len(words) < self.size:
            return np.array([self.digest(b" ".join(words), seed=len(words))], np.uint64).view(np.int64)
        hashes = np.fromiter(map(self.digest, words), np.uint64, len(words))
        n = len(words) - self.size + 1
        mixed = hashes[:n].copy()
        for k in range(1, self.size):
            mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed.view(np.int64))

    def fingerprint(self, hashes: np.ndarray) -> int:
        return int(np.array([self.digest(hashes.tobytes(), seed=len(hashes))], np.uint64).view(np.int64)[0])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]).astype(np.int64)))


def repeated(lot: list[np.ndarray], times: int) -> np.ndarray:
    """The hashes that the arrays hold at least so many times.  The list is emptied: a lot is held once, and sorted in place."""
    hashes = np.concatenate(lot)
    lot.clear()
    hashes.sort()
    later = hashes[times - 1:]
    return np.unique(later[later == hashes[:len(later)]])


def _reduced(docs: DataFrame, percent: int, size: int) -> DataFrame:
    """``id, node, n, least`` per row, and rows with ``n = -1`` that list shingles frequent in a lot."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, lot, held, seen = hold(("shingler", size), lambda: Shingler(size)), [], 0, set()
        names = ["id", "node", "n", "least"]
        for batch in (whole.slice(low, ROWS) for whole in batches for low in range(0, whole.num_rows, ROWS)):
            nodes, counts, least = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingler(text)
                nodes.append(shingler.fingerprint(hashes))
                counts.append(len(hashes))
                least.append(hashes[:least_size(len(hashes), percent)])
                if nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    lot.append(hashes)
                    held += len(hashes)
            yield pa.record_batch([batch.column(0), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), _lists(least)], names=names)
            if held > LOT:
                yield frequent(lot, batch.schema.field(0).type)
                lot, held, seen = [], 0, set()
        if lot:
            yield frequent(lot, batch.schema.field(0).type)

    def frequent(lot: list[np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
        found = repeated(lot, FREQUENT_IN_LOT)
        return pa.record_batch([pa.nulls(1, id_type), pa.array([0], pa.int64()), pa.array([-1], pa.int64()), _lists([found])], names=["id", "node", "n", "least"])

    id_type = docs.schema["__id"].dataType.simpleString()
    return docs.select("__id", "__text").mapInArrow(reduce, f"id {id_type}, node long, n long, least array<long>")


def _field_words(ids: DataFrame, hashed: bool = True) -> DataFrame:
    """``word, bits``: the words other than zero of a bit field, of fixed size, of hashes of ``id``, or of ``id`` itself if that is a hash."""
    place = field_place("id") if hashed else F.pmod(F.col("id"), F.lit(FIELD_BITS))
    words = ids.select(F.floor(place / 64).alias("word"), (place % 64).cast("int").alias("bit")).distinct()
    return words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def field_place(row_id: str) -> Column:
    """The place of an id in a bit field."""
    return F.pmod(F.xxhash64(row_id), F.lit(FIELD_BITS))


def _field_of(ids: DataFrame, hashed: bool = True) -> bytes:
    """The bit field of ``_field_words`` as bytes."""
    field = np.zeros(FIELD_BITS // 64, np.int64)
    for word, bits in _field_words(ids, hashed).collect():
        field[word] = bits
    return field.tobytes()


def _in_field(field: bytes, places: pa.Array | np.ndarray) -> np.ndarray:
    places = np.asarray(places).astype(np.int64)
    return (np.frombuffer(field, np.uint64)[places // 64] >> (places % 64).astype(np.uint64) & np.uint64(1)).astype(bool)


def _full_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``key, n, all`` of the wanted ``key, node, id``: only texts whose id is in the bit field are shingled."""
    field = _field_of(wanted.select("id"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = hold(("shingler", size), lambda: Shingler(size))
        for batch in batches:
            hit = np.flatnonzero(_in_field(field, batch.column(1)))
            for low in range(0, len(hit), 256):
                sets = [shingler(t) for t in batch.column(0).take(pa.array(hit[low:low + 256])).to_pylist()]
                yield pa.record_batch([pa.array([shingler.fingerprint(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), _lists(sets)], names=["node", "n", "all"])

    rows = docs.select("__text", field_place("__id").alias("place"))
    sets = rows.mapInArrow(shingle, "node long, n long, all array<long>")
    return sets.join(wanted.select("key", "node"), "node").dropDuplicates(["node"]).drop("node")


def _compared(pairs: DataFrame, docs: DataFrame, names: DataFrame, percent: int, size: int, keep_differences: bool) -> DataFrame:
    """``a, b, n_a, n_b, linked`` of the pairs, with the ``delta`` of close ones: what only one of the two holds."""
    pairs = checkpointed(pairs.select("a", "b").distinct())
    wanted = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct().join(names.select("key", "node", "id"), "key")
    sets = stored(_full_sets(docs, wanted, size), "sets")
    both = (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("all").alias("all_a")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("all").alias("all_b")), "b")
        .withColumn("shared", F.size(F.array_intersect("all_a", "all_b")))
    )
    differ = F.col("n_a") + F.col("n_b") - 2 * F.col("shared")
    close = (100 + percent) * differ <= HOME * (100 - percent) * (F.col("n_a") + F.col("n_b"))
    delta = F.when(close, F.concat(F.array_except("all_a", "all_b"), F.array_except("all_b", "all_a")))
    result = both.select("a", "b", "n_a", "n_b", _similar(differ, F.col("n_a") + F.col("n_b"), percent).alias("linked"), *[delta.alias("delta")] * keep_differences)
    result = stored(result if keep_differences else result.where("linked"), "compared")
    discard(sets)
    return result


def _similar(differ: Column, sizes: Column, percent: int) -> Column:
    """A similarity of at least ``percent``, by the number of members that only one of two sets holds."""
    return (100 + percent) * differ <= (100 - percent) * sizes


def _delta_links(homes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between nodes of one home and different components.

    With differences ``D`` from the home, two sets differ by ``|Da| + |Db| - 2 |Da and Db|``.  One of the
    two at least is not linked with the home, which bounds what they must share from below: more than
    half of a node's own difference (up to the sizes of the sets), and of a node that is not linked
    itself at least what exceeds the difference that a link allows.
    """
    rate = (100 - percent) / (100 + percent)
    size = F.size("delta")
    half = F.floor(F.greatest(F.lit(0.0), size - rate * (F.col("n") - F.col("n_home"))) / 2 - 1e-6) + 1
    excess = F.ceil(size - rate * F.col("n") * (1 + 100 / percent) - 1e-6)
    least = F.greatest(F.lit(1), F.when(F.col("linked"), half).otherwise(F.least(half, excess)))
    nodes = (
        homes.join(roots.withColumnRenamed("root", "known_root"), F.col("key") == F.col("node"), "left")
        .select("home", "key", "n", "delta", F.coalesce("known_root", "key").alias("root"), size.alias("size"), (size - least + 1).alias("prefix"))
    )
    members = nodes.select("home", "key", "n", "root", "size", "prefix", F.explode("delta").alias("shingle"))
    counts = members.groupBy("home", "shingle").agg(F.count(F.lit(1)).alias("count"), F.min("root").alias("low"), F.max("root").alias("high")).where("count > 1")
    node = Window.partitionBy("key")
    place = F.row_number().over(node.orderBy("count", "shingle")) - 1
    alone = F.col("size") - F.count(F.lit(1)).over(node)
    chosen = (
        members.join(counts, ["home", "shingle"]).withColumn("place", place).withColumn("alone", alone)
        .where((F.col("place") + F.col("alone") < F.col("prefix")) & (F.col("low") < F.col("high")))
    )
    sides = [chosen.select("home", "shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("key", "n", "root")]) for side in "ab"]
    pairs = (
        sides[0].join(sides[1], ["home", "shingle"])
        .where((F.col("key_a") < F.col("key_b")) & (F.col("root_a") != F.col("root_b")) & _sized(F.col("n_a"), F.col("n_b"), percent))
        .select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()
    )
    both = (
        pairs.join(homes.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("delta").alias("delta_a")), "a")
        .join(homes.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("delta").alias("delta_b")), "b")
    )
    differ = F.size("delta_a") + F.size("delta_b") - 2 * F.size(F.array_intersect("delta_a", "delta_b"))
    return checkpointed(both.where(_similar(differ, F.col("n_a") + F.col("n_b"), percent)).select("a", "b"))


def _late(nodes: DataFrame, frequent: DataFrame) -> DataFrame:
    """``key, late``: how many of a node's least hashes are frequent.

    A bit field lets only hashes that may be frequent leave the map tasks.
    """
    field = _field_of(frequent.select(F.col("shingle").alias("id")), hashed=False)

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            lists = batch.column(1)
            hashes = np.asarray(lists.flatten(), np.int64)
            hit = np.flatnonzero(_in_field(field, hashes % FIELD_BITS))
            keys = np.repeat(np.asarray(batch.column(0), np.int64), np.asarray(lists.value_lengths()))
            yield pa.record_batch([pa.array(keys[hit]), pa.array(hashes[hit])], names=["key", "shingle"])

    found = nodes.select("key", "least").mapInArrow(suspect, "key long, shingle long")
    return found.join(frequent, "shingle", "leftsemi").groupBy("key").agg(F.count(F.lit(1)).alias("late"))


def _postings(docs: DataFrame, nodes: DataFrame, in_lots: DataFrame, percent: int, size: int) -> DataFrame:
    """``shingle, key, n, rank, level, matches, cost``: the prefix members that another node may hold.

    A node's members are its least hashes, or its whole set where too many of these are frequent.
    ``rank`` is the place in the global order, ``level`` the smallest ``l`` whose prefix holds the
    member, ``matches`` the node's own ``l``.
    """
    least = nodes.select("key", F.posexplode("least").alias("place", "shingle"))
    counts = stored(least.groupBy("shingle").count().where("count > 1"), "counts")
    frequent = stored(counts.where(F.col("count") > FREQUENT).select("shingle").union(in_lots).distinct(), "frequent")
    rare = F.size("least") - F.col("late")
    short = stored(
        nodes.join(_late(nodes, frequent), "key")
        .where((F.size("least") < F.col("n")) & (rare < prefix_size(F.col("n"), percent) + MOST_MATCHES - 1))
        .select("key", "node", "id"),
        "short",
    )
    full = stored(_full_sets(docs, short, size), "full")
    whole = full.select("key", F.posexplode("all").alias("place", "shingle"))
    known = (
        nodes.join(short.select("key"), "key", "leftanti").select("key", F.col("n").cast("int").alias("n"), F.size("least").alias("known"))
        .union(full.select("key", F.col("n").cast("int"), F.size("all")))
    )
    members = nodes.join(short.select("key"), "key", "leftanti").select("key", F.posexplode("least").alias("place", "shingle")).union(whole)
    shared = (
        counts.select("shingle", "count", F.lit(0).alias("late"))
        .union(whole.groupBy("shingle").count().select("shingle", "count", F.lit(0)))
        .union(frequent.select("shingle", F.lit(1), F.lit(1)))
        .groupBy("shingle").agg(F.max("count").cast("int").alias("count"), F.max("late").alias("late"))
    )
    node = Window.partitionBy("key")
    before = node.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rank = F.when(F.col("late") == 1, F.col("known") - F.col("late_all") + F.coalesce("late_before", F.lit(0))).otherwise(F.col("place") - F.coalesce("late_before", F.lit(0)))
    level = F.greatest(F.lit(1), F.col("rank") - prefix_size(F.col("n"), percent) + 2)
    more = F.ceil(3 * F.log2(F.greatest(F.col("cost"), F.lit(1)) / COSTLY))
    needed = F.floor((percent * F.col("n") + 99) / 100)
    matches = F.when(F.col("cost") <= COSTLY, 1).otherwise(F.least(F.lit(MOST_MATCHES), 1 + more, needed)).cast("int")
    postings = stored(
        members.join(shared, "shingle").join(known, "key")
        .withColumn("late_before", F.sum("late").over(before)).withColumn("late_all", F.sum("late").over(node))
        .withColumn("rank", rank.cast("int")).withColumn("level", level.cast("int")).where(F.col("level") <= MOST_MATCHES)
        .withColumn("cost", F.coalesce(F.sum(F.when(F.col("level") == 1, F.col("count") - 1)).over(node), F.lit(0)))
        .withColumn("matches", matches).where(F.col("level") <= F.col("matches"))
        .select("shingle", "key", "n", "rank", "level", "matches", "cost"),
        "postings",
    )
    for table in (counts, frequent, short, full):
        discard(table)
    return postings


def _sized(a: Column | str, b: Column | str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _open_lists(postings: DataFrame, roots: DataFrame, homes: DataFrame) -> DataFrame:
    """The postings with ``root`` and ``home``, without the lists of one component or one home."""
    rows = (
        postings.drop("root")
        .join(roots.select(F.col("node").alias("known_key"), F.col("root").alias("known_root")), F.col("key") == F.col("known_key"), "left")
        .join(homes.select(F.col("key").alias("home_key"), "home"), F.col("key") == F.col("home_key"), "left")
        .withColumn("root", F.coalesce("known_root", "key")).drop("known_root", "known_key", "home_key")
    )
    several = (F.min("root") < F.max("root")) & ((F.count("home") < F.count(F.lit(1))) | (F.min("home") < F.max("home")))
    lists = rows.groupBy("shingle").agg(several.alias("several")).where("several")
    return stored(rows.join(lists.select("shingle"), "shingle", "leftsemi"), "open")


def _leader_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """Each node with the leader that it meets most often, if they match often enough."""
    leader = F.max(F.struct("cost", "key", "n", "matches"))
    leaders = postings.groupBy("shingle").agg(leader.alias("lead"))
    met = (
        postings.join(leaders, "shingle")
        .where((F.col("key") != F.col("lead.key")) & _sized(F.col("n"), F.col("lead.n"), percent))
        .groupBy("key", F.col("lead.key").alias("leader"))
        .agg(F.count(F.lit(1)).alias("met"), F.min(F.least("matches", "lead.matches")).alias("needed"))
        .where("met >= needed")
    )
    best = met.groupBy("key").agg(F.max(F.struct("met", "leader")).alias("best"))
    return best.select(F.col("key").alias("a"), F.col("best.leader").alias("b"))


def _remaining_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components and homes that share enough prefix members.

    Members after the last shared one can add no more than the shorter rest (positional filter).
    """
    sides = [postings.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("key", "n", "root", "home", "rank", "level", "matches")]) for side in "ab"]
    apart = F.coalesce(F.col("home_a") != F.col("home_b"), F.lit(True))
    needed = F.least("matches_a", "matches_b")
    rest = F.least(F.col("n_a") - F.col("last_a"), F.col("n_b") - F.col("last_b")) - 1
    return (
        sides[0].join(sides[1], "shingle")
        .where((F.col("key_a") < F.col("key_b")) & (F.col("root_a") != F.col("root_b")) & apart)
        .where(_sized(F.col("n_a"), F.col("n_b"), percent) & (F.greatest("level_a", "level_b") <= needed))
        .groupBy(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("met"), F.min(needed).alias("needed"), F.min("n_a").alias("n_a"), F.min("n_b").alias("n_b"), F.max("rank_a").alias("last_a"), F.max("rank_b").alias("last_b"))
        .where((F.col("met") >= F.col("needed")) & ((100 + percent) * (F.col("met") + rest) >= percent * (F.col("n_a") + F.col("n_b"))))
    )


def _placed(docs: DataFrame, row_id: str, text: str, percent: int, size: int) -> DataFrame:
    """``id, node, n, root`` of each document: its set's fingerprint and size, and the component of it."""
    docs = docs.select(F.col(row_id).alias("__id"), F.col(text).alias("__text"))
    reduced = stored(_reduced(docs, percent, size), "reduced")
    rows = stored(reduced.where("n >= 0").select("id", "node", "n"), "rows")
    in_lots = stored(reduced.where("n = -1").select(F.explode("least").alias("shingle")).distinct(), "lots")
    sets = reduced.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("least").alias("least"))
    nodes = stored(sets.withColumn("key", F.monotonically_increasing_id()), "nodes")
    discard(reduced)
    names = stored(nodes.select("key", "node", "id"), "names")
    postings = _postings(docs, nodes, in_lots, percent, size)
    discard(nodes)
    led = _compared(_leader_pairs(postings, percent), docs, names, percent, size, keep_differences=True)
    links = led.where("linked").select("a", "b")
    homes = led.where("delta is not null").select(F.col("a").alias("key"), F.col("b").alias("home"), F.col("n_a").alias("n"), F.col("n_b").alias("n_home"), "linked", "delta")
    roots = checkpointed(components(links))
    links = links.union(_delta_links(homes, roots, percent))
    roots = checkpointed(components(links))
    lists = _open_lists(postings, roots, homes)
    discard(postings)
    rest = _compared(_remaining_pairs(lists, percent), docs, names, percent, size, keep_differences=False)
    roots = checkpointed(components(links.union(rest.select("a", "b"))))
    for table in (lists, led, rest):
        discard(table)
    known = names.select("key", "node").join(roots.withColumnRenamed("node", "linked"), F.col("key") == F.col("linked"), "left")
    known = known.select(F.col("node").alias("named"), F.coalesce("root", "key").alias("root"))
    return rows.join(known, F.col("node") == F.col("named"), "left").select("id", "node", "n", "root")


def join_documents(
    docs: DataFrame, row_id: str = "doc_id", text: str = "text", percent: int = SIMILARITY, size: int = SHINGLE
) -> DataFrame:
    """A row per document: its id, ``n_shingles`` and ``component_id``.

    Two documents are linked when their sets of ``size``-word shingles have a Jaccard similarity of
    at least ``percent`` hundredths; the component is named by the least id that links reach.
    """
    placed = _placed(docs, row_id, text, percent, size)
    least = placed.where("n > 0").groupBy("root").agg(F.min("id").alias("least_id")).withColumnRenamed("root", "named_root")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least_id"))
    return (
        placed.join(least, F.col("root") == F.col("named_root"), "left")
        .select(F.col("id").alias(row_id), F.col("n").alias("n_shingles"), component.alias("component_id"))
    )


def one_of_each_group(
    docs: DataFrame, row_id: str = "doc_id", text: str = "text", percent: int = SIMILARITY, size: int = SHINGLE
) -> DataFrame:
    """Of the documents that are linked, in one or more steps, the one of lowest id; unlinked ones stay.

    Ids need not be unique: rows are told apart by the id and the fingerprint of their set, the lower
    one first; of rows with equal id and set, or without words and with equal id and text, one stays.
    Rows without an id stay.  A bit field of the ids in question lets all other rows pass where they
    are; only those that it names are shuffled to be looked up.
    """
    placed = stored(_placed(docs, row_id, text, percent, size), "placed")
    linked = placed.where("n > 0 and id is not null")
    first = linked.groupBy("root").agg(F.min(F.struct("id", "node")).alias("first")).withColumnRenamed("root", "named_root")
    gone = (
        linked.join(first, F.col("root") == F.col("named_root"))
        .where((F.col("id") != F.col("first.id")) | (F.col("node") != F.col("first.node")))
        .select("id", F.col("node").alias("gone")).distinct()
    )
    repeated = placed.groupBy("id").count().where("count > 1").select("id")
    field = _field_of(gone.select("id").union(repeated))
    names = [f"__c{k}" for k in range(len(docs.columns))]
    key, content = (names[docs.columns.index(c)] for c in (row_id, text))
    at = 1 + docs.columns.index(text)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = hold(("shingler", size), lambda: Shingler(size))

        def node(content: str | None) -> int | None:
            hashes = shingler(content)
            return shingler.fingerprint(hashes) if len(hashes) else None

        for batch in (whole.slice(low, ROWS) for whole in batches for low in range(0, whole.num_rows, ROWS)):
            hit = _in_field(field, batch.column(0))
            nodes = [node(batch.column(at)[k].as_py()) if there else None for k, there in enumerate(hit)]
            yield pa.record_batch([*batch.columns[1:], pa.array(hit), pa.array(nodes, pa.int64())], names=[*batch.schema.names[1:], "__named", "__node"])

    place = F.pmod(F.xxhash64(docs[row_id]), F.lit(FIELD_BITS))
    schema = StructType([StructField(n, docs.schema[c].dataType) for n, c in zip(names, docs.columns)] + [StructField("__named", BooleanType()), StructField("__node", LongType())])
    rows = docs.select(place.alias("place"), *[docs[c].alias(n) for n, c in zip(names, docs.columns)]).mapInArrow(named, schema)
    # Rows without words or an id are told apart by their text.
    whole = F.when(F.col("__node").isNull() | F.col(key).isNull(), F.col(content))
    looked_up = (
        rows.where("__named").join(gone, (F.col(key) == F.col("id")) & (F.col("__node") == F.col("gone")), "leftanti")
        .groupBy(F.col(key).alias("__key"), "__node", whole.alias("__whole"))
        .agg(F.min_by(F.struct(*names), F.coalesce(F.col(content), F.lit(""))).alias("__row")).select("__row.*")
    )
    return rows.where(~F.col("__named")).select(*names).union(looked_up).withColumnsRenamed(dict(zip(names, docs.columns)))
