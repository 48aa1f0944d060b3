"""Exact top-k search by inner product in a paged metric tree.

The tree grows downwards by distance alone.  A node with more than ``GROUP`` vectors is split: some of
its members, more of them the larger it is, become the centres of its children, and every member goes
to the nearest.  What is small enough, or cannot be told apart by distance, is a leaf, whose members
lie in pages of at most ``PAGE``.  Every node and page stores its covering radius and the distance of
its centre to its parent's centre; a member stores its distance to the page's centre.  With
``|x - c| <= r`` the inner product of ``q`` and ``x`` is at most ``q.c + |q| r``, and ``q.c`` itself is
at most ``q.p + |q| d(c, p)`` by the triangle inequality, so that most nodes which cannot reach a
query's k-th best score are left out before any product with their centre is worked out.

Every query is first searched in a few leaves of the nearest centres.  The k-th score found there
prunes its way down the tree, level by level as joins of queries and children.  A leaf then answers a
block of queries at once: pages are opened best bound first, a few at a time, and one matrix product
serves all queries of the block.  So where the bounds rule out nothing, the cost is that of blocked
products.  Bounds are widened by more than rounding error.  Scores are integers, hence exact.

Edge cases: vectors that are null or hold nulls or non-finite numbers take no part, nor do queries
or candidates without an id; an empty vector scores 0; a vector meets only those of its own length;
repeated rows are candidates of their own, except that no row with the query's id is a candidate;
repeated queries are one query; ties go to the smaller id; an empty table gives no rows; columns other
than the id and the vector are not read, so their names may clash with those of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import discard, stored

#: Most children of a node, and most levels of splits; a node beyond these is dealt over several groups.
PIVOTS, LEVELS = 64, 12
#: Vectors of a group, members of a leaf page, and queries of a block: bounds of what a task holds.
GROUP, PAGE, BLOCK = 4096, 64, 4096
#: Members that meet a block in one product, and leaves that a query is first searched in.
CHUNK, SEEDS = 512, 3
SCALE = 256
#: Widening of bounds, relative to the sizes of the numbers compared.
SLACK = 1e-9
#: Products below this are exact as doubles.
EXACT = float(1 << 53)

_PAGES = "path string, part int, vec_ids binary, vectors binary, distances binary, centre binary, radius double, to_parent double"


def integer_vectors(table: DataFrame, row_id: str, vector: str) -> DataFrame:
    """``vec_id, ints``: components as ``floor(256 x)``; rows that cannot take part are left out."""
    x = F.col(vector)
    sound = x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    ints = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    known = table.where(F.coalesce(sound, F.lit(False)) & F.col(row_id).isNotNull())
    return known.select(F.col(row_id).cast("long").alias("vec_id"), ints.alias("ints"))


def _packed(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector, path, distance``: the components as bytes, at the root of the vector's length."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = batch.column(1)
            lengths = np.asarray(ints.value_lengths())
            for length in np.unique(lengths):
                places = pa.array(np.flatnonzero(lengths == length))
                matrix = np.asarray(ints.take(places).flatten(), np.int64).reshape(len(places), length)
                norms = np.sqrt((matrix.astype(float) ** 2).sum(axis=1))
                yield pa.record_batch(
                    [batch.column(0).take(places), pa.array([row.tobytes() for row in matrix], pa.binary()), pa.array([str(length)] * len(places)), pa.array(norms)],
                    names=["vec_id", "vector", "path", "distance"],
                )

    return vectors.mapInArrow(pack, "vec_id long, vector binary, path string, distance double")


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.int64).reshape(len(vectors), -1 if vectors and vectors[0] else 0)


def _distances(matrix: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((matrix - centre).astype(float) ** 2).sum(axis=1))


def _nearest(matrix: np.ndarray, centres: np.ndarray) -> np.ndarray:
    v, c = matrix.astype(float), centres.astype(float)
    return ((c * c).sum(axis=1)[None] - 2 * v @ c.T).argmin(axis=1)


def _groups(count: str) -> Column:
    return F.ceil(F.col(count) / GROUP).cast("int")


def _split(rows: DataFrame, inner: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """The rows of the inner nodes at their children, and ``path, parent, centre, to_parent, of`` of the children.

    A node's rows meet its centres in slices of about ``GROUP``, so a node of any size is no single task.
    """
    fan = F.least(F.lit(PIVOTS), F.greatest(F.lit(2), F.ceil(2 * F.col("n") / GROUP)))
    held = rows.join(inner.select("path", "n", fan.alias("fan"), _groups("n").alias("slices")), "path")
    drawn = Window.partitionBy("path").orderBy(F.xxhash64("draw", F.lit(level)), "draw")
    chosen = held.withColumn("rank", F.row_number().over(drawn)).where((F.col("rank") <= PIVOTS) & (F.col("rank") <= F.col("fan")))
    centres = stored(
        chosen.select(
            F.concat_ws(".", "path", "rank").alias("path"), F.col("path").alias("parent"), F.col("vector").alias("centre"),
            F.col("distance").alias("to_parent"), F.col("n").alias("of"), "slices",
        ),
        "centres",
    )

    def place(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        matrix, centres = _matrix(list(members["vector"])), _matrix(list(pivots["centre"]))
        near = _nearest(matrix, centres) if len(members) else np.zeros(0, int)
        return pd.DataFrame({
            "vec_id": members["vec_id"], "vector": members["vector"], "path": pivots["path"].to_numpy()[near],
            "distance": _distances(matrix, centres[near]) if len(members) else np.zeros(0), "draw": members["draw"],
        })

    dealt = centres.select("path", "centre", F.col("parent").alias("at"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    sliced = held.select("vec_id", "vector", "draw", F.col("path").alias("at"), F.expr("cast(pmod(draw, slices) as int)").alias("slice"))
    moved = sliced.groupBy("at", "slice").cogroup(dealt.groupBy("at", "slice")).applyInPandas(
        place, "vec_id long, vector binary, path string, distance double, draw long"
    )
    return stored(moved, "vectors"), centres.drop("slices")


def _leaf_pages(key: tuple, rows: pd.DataFrame, most: int) -> pd.DataFrame:
    """The pages of a group: members near the same seed, at most ``most`` of them, around the seed."""
    matrix, ids = _matrix(list(rows["vector"])), rows["vec_id"].to_numpy(np.int64)
    to_leaf = rows["distance"].to_numpy()
    order = np.lexsort((ids, to_leaf))
    seeds = order[:: max(1, most // 2)]
    near = _nearest(matrix[order], matrix[seeds])
    made = []
    for seed in np.unique(near):
        whole, centre = order[near == seed], matrix[seeds[seed]]
        for members in np.array_split(whole, -(-len(whole) // most)):
            distances = _distances(matrix[members], centre)
            made.append((*key, ids[members].tobytes(), matrix[members].tobytes(), distances.tobytes(), centre.tobytes(), float(distances.max()), float(to_leaf[seeds[seed]])))
    return pd.DataFrame(made, columns=[c.split(" ")[0] for c in _PAGES.split(", ")])


@dataclass
class Tree:
    """Nodes by level, and the pages of the leaves.

    A level has ``parent, path, centre, to_parent, radius, n, parts``; an inner node has no parts.  A
    leaf is repeated on every deeper level as its own child, without a centre.
    """

    levels: list[DataFrame]
    pages: DataFrame


def build_tree(vectors: DataFrame) -> Tree:
    """The tree over ``vec_id, ints``: a shuffle of the vectors per level, and one for the pages."""
    rows = stored(_packed(vectors).withColumn("draw", F.xxhash64("vec_id", F.monotonically_increasing_id())), "vectors")
    children = rows.select("path").distinct().select(
        "path", F.col("path").alias("parent"), F.lit(None).cast("binary").alias("centre"), F.lit(0.0).alias("to_parent"), F.lit(None).cast("long").alias("of")
    )
    levels: list[DataFrame] = []
    finished: list[DataFrame] = []
    used = [rows]
    while True:
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"))
        splits = (F.col("n") > GROUP) & (F.col("radius") > 0) & (F.col("n") < F.coalesce("of", F.col("n") + 1)) & F.lit(len(levels) < LEVELS)
        parts = F.when(splits, F.lit(0)).otherwise(_groups("n")).alias("parts")
        nodes = stored(sizes.join(children, "path").select("parent", "path", "centre", "to_parent", "radius", "n", parts), "nodes")
        finished.append(rows.join(nodes.where("parts > 0").select("path", "parts"), "path"))
        inner = nodes.where("parts = 0")
        if levels:
            again = levels[-1].where("parts > 0").select(F.col("path").alias("parent"), "path", F.lit(None).cast("binary").alias("centre"), F.lit(0.0).alias("to_parent"), "radius", "n", "parts")
            nodes = nodes.unionByName(again)
        levels.append(nodes)
        if inner.isEmpty():
            break
        rows, children = _split(rows, inner, len(levels))
        used.append(rows)
    leaves = finished[0]
    for more in finished[1:]:
        leaves = leaves.unionByName(more)
    grouped = leaves.select("path", F.expr("cast(pmod(draw, parts) as int)").alias("part"), "vec_id", "vector", "distance")
    most = PAGE

    def pages_of(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return _leaf_pages(key, rows, most)

    pages = stored(grouped.groupBy("path", "part").applyInPandas(pages_of, _PAGES), "pages")
    for table in used:
        discard(table)
    return Tree(levels, pages)


def _products(rows: DataFrame) -> DataFrame:
    """``product`` replaced by the product of query and centre, where there is a centre."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            products = batch.column("product").to_numpy(zero_copy_only=False).copy()
            queries, centres = batch.column("query").to_pylist(), batch.column("centre").to_pylist()
            by_length: dict[int, list[int]] = {}
            for place, centre in enumerate(centres):
                if centre is not None:
                    by_length.setdefault(len(centre), []).append(place)
            for places in by_length.values():
                q, c = (_matrix([side[place] for place in places]).astype(float) for side in (queries, centres))
                products[places] = (q * c).sum(axis=1)
            at = batch.schema.get_field_index("product")
            yield batch.set_column(at, "product", pa.array(products))

    return rows.mapInArrow(multiply, rows.schema)


def descend(asked: DataFrame, tree: Tree, beam: int | None = None) -> DataFrame:
    """``query_id, query, least, norm, product, path, parts``: the leaves that each query has to visit.

    These are all that its bounds do not rule out or, with ``beam``, those reached by keeping that many
    nodes of the highest products on every level.  ``product`` is that of the query and the leaf's centre.
    """
    at = asked.withColumn("product", F.lit(0.0))
    for depth, level in enumerate(tree.levels):
        met = at.drop("parts").withColumnRenamed("path", "at").join(level.drop("n"), F.col("at") == F.col("parent"))
        reach = F.col("norm") * (F.col("to_parent") + F.col("radius"))
        sizes = 1 + F.abs("product") + F.col("norm") * (F.col("largest") + F.col("to_parent") + F.col("radius"))
        met = met.where(F.col("product") + reach + SLACK * sizes >= F.col("least"))
        if depth:
            met = _products(met.select("query_id", "query", "norm", "least", "largest", "product", "path", "centre", "radius", "to_parent", "parts"))
            met = met.where(F.col("product") + F.col("norm") * F.col("radius") + SLACK * sizes >= F.col("least"))
        if beam:
            best = Window.partitionBy("query_id").orderBy(F.desc("product"), "path")
            met = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= beam)
        at = met.select("query_id", "query", "norm", "least", "largest", "product", "path", "parts")
    return at


def search_group(
    queries: np.ndarray, query_ids: np.ndarray, least: np.ndarray, products: np.ndarray, ids: list[np.ndarray], vectors: list[np.ndarray],
    distances: list[np.ndarray], centres: np.ndarray, radii: np.ndarray, to_parent: np.ndarray, k: int, step: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the query, id and score of the ``k`` best of a group for each of a block of queries.

    ``products`` are those with the group's centre: with them the bound by the parent needs no product.
    Of the pages that it lets through the own bounds are worked out; ``step`` pages at a time are opened
    in the order of the bounds, and members too near to the page's centre for any of the queries are passed over.
    """
    q = queries.astype(float)
    norms = np.sqrt((q * q).sum(axis=1))
    lengths = np.sqrt((centres.astype(float) ** 2).sum(axis=1))
    wide = SLACK * (1 + np.abs(products)[:, None] + norms[:, None] * (lengths + to_parent + radii)[None])
    least = least - SLACK * np.abs(np.where(np.isfinite(least), least, 0))
    open_ = products[:, None] + norms[:, None] * (to_parent + radii)[None] + wide >= least[:, None]
    pages = np.flatnonzero(open_.any(axis=0))
    own = q @ centres[pages].astype(float).T
    bounds = np.where(open_[:, pages], own + norms[:, None] * radii[pages][None] + wide[:, pages], -np.inf)
    exact = norms.max(initial=0) * (lengths + radii).max(initial=0) * 2 < EXACT
    rows, found, scores = (np.zeros(0, np.int64) for _ in range(3))
    waiting = np.argsort(-bounds.max(axis=0, initial=-np.inf), kind="stable")
    while len(waiting):
        waiting = waiting[(bounds[:, waiting] >= least[:, None]).any(axis=0)]
        taken, waiting = waiting[:step], waiting[step:]
        asking = np.flatnonzero((bounds[:, taken] >= least[:, None]).any(axis=1)) if len(taken) else taken
        if not len(asking):
            break
        kept_ids, kept = [], []
        for place in taken:
            page = pages[place]
            short = least[asking] - own[asking, place] - wide[asking, page]
            with np.errstate(divide="ignore", invalid="ignore"):
                nearest = np.where(norms[asking] > 0, short / norms[asking], -np.inf)
            members = distances[page] >= np.where(bounds[asking, place] >= least[asking], nearest, np.inf).min()
            kept_ids.append(ids[page][members])
            kept.append(vectors[page][members])
        member_ids, members = np.concatenate(kept_ids), np.concatenate(kept)
        if not len(members):
            continue
        table = q[asking] @ members.astype(float).T if exact else queries[asking] @ members.T
        good = (table >= least[asking][:, None]) & (member_ids[None] != query_ids[asking][:, None])
        if table.shape[1] > k and good.sum() > 8 * k * len(asking):
            last = np.partition(np.where(good, table, table.min()), table.shape[1] - k, axis=1)[:, table.shape[1] - k]
            good &= table >= last[:, None]
        row, column = np.nonzero(good)
        rows, found = np.concatenate([rows, asking[row]]), np.concatenate([found, member_ids[column]])
        scores = np.concatenate([scores, table[row, column].astype(np.int64)])
        order = np.lexsort((found, -scores, rows))
        rows, found, scores = rows[order], found[order], scores[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        full = rank == k - 1
        least[rows[full]] = np.maximum(least[rows[full]], scores[full] * (1 - SLACK * np.sign(scores[full])))
        rows, found, scores = rows[rank < k], found[rank < k], scores[rank < k]
    return rows, found, scores


def _search(pages: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the best of each visited group that reach the query's ``least``.

    ``visits`` has ``path, part, block, query_id, query, least, product``.  A group is copied to each
    block of queries of which one visits it.
    """

    step = max(1, CHUNK // PAGE)

    def search(groups: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(groups) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        centres, query_ids = _matrix(list(groups["centre"])), queries["query_id"].to_numpy(np.int64)
        ids = [np.frombuffer(x, np.int64) for x in groups["vec_ids"]]
        vectors = [np.frombuffer(x, np.int64).reshape(len(i), centres.shape[1]) for x, i in zip(groups["vectors"], ids)]
        distances = [np.frombuffer(x, np.float64) for x in groups["distances"]]
        numbers = (queries[c].to_numpy(float) for c in ("least", "product"))
        bounds = (groups[c].to_numpy(float) for c in ("radius", "to_parent"))
        rows, found, scores = search_group(_matrix(list(queries["query"])), query_ids, *numbers, ids, vectors, distances, centres, *bounds, k, step)
        return pd.DataFrame({"query_id": query_ids[rows], "vec_id": found, "score": scores})

    blocks = visits.select(F.col("path").alias("to_path"), F.col("part").alias("to_part"), F.col("block").alias("to_block")).distinct()
    copied = pages.join(blocks, (F.col("path") == F.col("to_path")) & (F.col("part") == F.col("to_part")))
    return (
        copied.groupBy("to_path", "to_part", "to_block")
        .cogroup(visits.groupBy("path", "part", "block")).applyInPandas(search, "query_id long, vec_id long, score long")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` candidates of highest inner product with each query."""
    tree = build_tree(integer_vectors(candidates, row_id, vector))
    largest = F.broadcast(tree.levels[0].groupBy("path").agg(F.max("radius").alias("largest")))  # a row per length
    asked = integer_vectors(queries, row_id, vector).groupBy("vec_id").agg(F.min("ints").alias("ints"))
    asked = _packed(asked).withColumnsRenamed({"vec_id": "query_id", "vector": "query", "distance": "norm"})
    asked = stored(asked.join(largest, "path"), "queries")
    blocks = max(1, -(-asked.count() // BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block")
    columns = [block, "query_id", "query", "least", "product", "path"]
    nothing = F.lit(float("-inf"))
    first = stored(descend(asked.withColumn("least", nothing), tree, SEEDS).select(*columns, F.lit(0).alias("part")), "visits")
    reached = _best(_search(tree.pages, first, k), k).where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("least"))
    bounded = stored(asked.join(reached, "query_id", "left").withColumn("least", F.coalesce("least", nothing)), "bounded")
    discard(first)
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    visits = stored(descend(bounded, tree).select(*columns, parts), "visits")
    return _best(_search(tree.pages, visits, k), k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
with v as (
  select vec_id, [cast(floor(x::double * 256) as bigint) for x in embedding] as ints from embeddings
  where embedding is not null and len([1 for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum([p[1] * p[2] for p in list_zip(q.ints, c.ints)]) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
) where rank <= 5
"""
