"""Joins: enrichment, semi and anti joins, strategies, pair counting, point-in-time lookup.

Row-level joins leave the choice between broadcast and shuffle to Spark's own size check, and a hot
key to adaptive execution, which splits an oversized join partition.  No operator here repartitions
or aggregates by the join key afterwards, which would prevent that split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import exact, positions
from ledgerloom.functions.matching import bounded_broadcast, key_list

MAX_BROADCAST = 256 << 20
STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")


def enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, dict[str, str]]]) -> DataFrame:
    """Inner-join the fact to each ``(dimension, key, {column: new name})`` in turn."""
    for dim, on, renames in dims:
        fact = fact.join(dim.withColumnsRenamed(renames), on)
    return fact


def without_match(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no match.  The right keys are made distinct before they are shuffled."""
    on = key_list(on)
    return left.join(right.select(*on).distinct(), on, "left_anti")


def with_match(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with at least one match, each once."""
    on = key_list(on)
    return left.join(right.select(*on).distinct(), on, "left_semi")


def in_all_sets(df: DataFrame, key: str, attr: str, values: Sequence[str]) -> DataFrame:
    """Keys seen with every one of the values, found in one pass with one flag per value."""
    flags = [F.max(F.col(attr) == value).alias(f"__has_{i}") for i, value in enumerate(values)]
    found = df.where(F.col(attr).isin(*values)).groupBy(key).agg(*flags)
    for i in range(len(values)):
        found = found.where(F.col(f"__has_{i}"))
    return found.select(key)


def share_of_total(groups: DataFrame, everything: DataFrame, amount: Column | str, measure: str, name: str) -> DataFrame:
    """Share of each group's (rounded) measure in the total over ``everything``, in percent.

    The total is a scalar subquery: one value, never brought to the driver.
    """
    total = everything.agg(exact.money_sum(amount)).scalar()
    return groups.withColumn(name, exact.half_up(F.try_divide(F.col(measure), total) * 100, 2))


def above_group_mean(totals: DataFrame, by: str, measure: str, mean_name: str) -> DataFrame:
    """Rows whose measure exceeds the rounded mean of their group, with that mean.

    ``totals`` is read twice.
    """
    means = totals.groupBy(by).agg(exact.half_up(exact.money_mean(measure), 2).alias(mean_name))
    return totals.join(means, by).where(F.col(measure) > F.col(mean_name))


def lookup_join(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Inner join to a dimension, broadcast when Spark finds it within its byte threshold."""
    return fact.join(dim, on)


def join_with_strategy(left: DataFrame, right: DataFrame, on: str, strategy: str,
                       max_bytes: int = MAX_BROADCAST) -> DataFrame:
    """Inner join by a named strategy; the rows are the same whichever is used.

    ``broadcast`` is an error beyond ``max_bytes``, by Spark's estimate of the right side or, where that is
    higher or missing, by its measured bytes.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, not {strategy!r}")
    if strategy == "broadcast":
        right = bounded_broadcast(right, max_bytes)
    elif strategy != "auto":
        right = right.hint(strategy)
    return left.join(right, on)


def as_of_lookup(probe: DataFrame, dim: DataFrame, key: str, at: str, attr: str, start: str, end: str, name: str) -> DataFrame:
    """The attribute value in force on each probe's date; both ends inclusive, null end open.

    Versions of a key do not overlap, so each probe finds at most one.  The interval test is part of
    the join condition: no row pair outside it leaves the join.
    """
    versions = dim.select(F.col(key).alias("__key"), attr, start, end)
    in_force = (probe[at] >= versions[start]) & (versions[end].isNull() | (probe[at] <= versions[end]))
    return probe.join(versions, (probe[key] == versions["__key"]) & in_force).select(
        probe[key], probe[at], F.col(attr).alias(name))


def as_of_merge(probe: DataFrame, dim: DataFrame, key: str, at: str, attrs: Sequence[str], start: str, end: str,
                ties: Sequence[str] = (), bits: int | None = None) -> DataFrame:
    """The probes with the attributes in force on their dates, merged by time; the answer of ``as_of_lookup``.

    For keys with many versions: a join forms every pair of a probe and a version of its key, this forms none.
    Probes and versions lie in one order of key and time, cut into even ranges.  A probe takes the latest
    version that began by then: in its range or, from a table of one row per range, in an earlier one.  A
    key's rows may fill any number of ranges.  ``ties`` are columns that tell a key's probes of one moment
    apart; without them such probes share a range.

    Every probe column is kept.  A probe outside all intervals, or with a null key or date, is left out, as
    are versions with a null key or start and those that end before they start.  Intervals of a key must
    not overlap.
    """
    begins = dim.where(F.col(key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start))))
    versions = begins.select(
        F.col(key).alias("__key"), F.col(start).alias("__time"), F.lit(0).alias("__kind"),
        F.struct(F.col(end).alias("__end"), *attrs).alias("__version"))
    probes = probe.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.col(key).alias("__key"), F.col(at).alias("__time"), F.lit(1).alias("__kind"),
        *[F.col(c).alias(f"__tie_{i}") for i, c in enumerate(ties)], F.struct(*probe.columns).alias("__probe"))
    order = ["__time", "__kind", *[f"__tie_{i}" for i in range(len(ties))]]
    ranged = positions.in_ranges(probes.unionByName(versions, allowMissingColumns=True), ["__key"], order, bits=bits)
    inside = Window.partitionBy("__key", positions.RANGE).orderBy("__time", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = ranged.withColumn("__here", F.last("__version", ignorenulls=True).over(inside))
    latest = F.max_by("__version", F.when(F.col("__version").isNotNull(), F.col("__time")))
    ends = positions.carried(ranged, ["__key"], {}, {"__latest": latest})
    earlier = Window.partitionBy("__key").orderBy(positions.RANGE).rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select("__key", positions.RANGE, F.last("__latest", ignorenulls=True).over(earlier).alias("__handed"))
    found = positions.with_carried(begun.where("__kind = 1"), handed, ["__key"])
    found = found.withColumn("__version", F.coalesce("__here", "__handed")).where(F.col("__version").isNotNull())
    in_force = F.col("__version.__end").isNull() | (F.col("__time") <= F.col("__version.__end"))
    return found.where(in_force).select("__probe.*", *[F.col("__version")[a].alias(a) for a in attrs])


def _pairs(copies: DataFrame, basket: str, item: str, names: Sequence[str], *extra: str) -> DataFrame:
    """Pairs of items, a row for each of their baskets, from lines reduced to (basket, item, copies, weight)."""
    first, second, score = names
    heads = copies.select(basket, F.col(item).alias(first), *[F.col(c).alias(f"{c}_1") for c in ("copies", *extra)])
    tails = copies.select(basket, F.col(item).alias(second), *[F.col(c).alias(f"{c}_2") for c in ("copies", *extra)])
    pairs = heads.join(tails, basket).where(F.col(first) < F.col(second))
    return pairs.withColumn(score, F.col("copies_1") * F.col("copies_2"))


def co_occurrence(df: DataFrame, basket: str, item: str, n: int,
                  names: Sequence[str] = ("product_id_1", "product_id_2", "times_bought_together")) -> DataFrame:
    """The ``n`` item pairs found together most often, ties broken by the pair.

    An item's weight is the sum of its squared multiplicities over the baskets; a pair's count is at
    most the geometric mean of its two weights (Cauchy-Schwarz).  The best pairs among the items of
    most weight give a last place, which every pair of the answer must match or beat.  Only pairs whose
    weights allow that are formed, in wide and narrow baskets alike.

    Lines and pairs are mostly distinct, so a sum ahead of a shuffle would hold nearly all rows of its
    task.  Both are dealt first, over as many partitions as ``spark.sql.shuffle.partitions`` says, which
    are not merged afterwards, and summed where they land.  Pairs among the items of most weight, which
    may be very frequent, are summed ahead of the shuffle; there are few of them.
    """
    first, second, score = names
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = df.select(basket, item).where(F.col(basket).isNotNull() & F.col(item).isNotNull())
    copies = lines.repartition(parts, basket, item).groupBy(basket, item).agg(F.count(F.lit(1)).alias("copies"))
    weights = copies.groupBy(item).agg(F.sum(F.col("copies").cast("double") * F.col("copies")).alias("weight"))
    places = [F.desc(score), F.asc(first), F.asc(second)]
    heaviest = F.broadcast(weights.orderBy(F.desc("weight"), F.asc(item)).limit(2 * n + 50).select(item, F.lit(True).alias("heavy")))
    total = F.sum(score).alias(score)
    known = _pairs(copies.join(heaviest, item), basket, item, names).groupBy(first, second).agg(total).orderBy(*places).limit(n)
    floor = known.agg(F.when(F.count(F.lit(1)) == n, F.min(score)).otherwise(F.lit(1))).scalar()
    most = weights.agg(F.max("weight")).scalar()
    slack = 1 + 1e-9
    able = weights.where(F.sqrt("weight") * F.sqrt(most) * slack >= floor).join(heaviest, item, "left").hint("shuffle_hash")
    reaches = F.sqrt("weight_1") * F.sqrt("weight_2") * slack >= floor
    is_new = F.col("heavy_1").isNull() | F.col("heavy_2").isNull()
    others = _pairs(copies.join(able, item).repartition(parts, basket), basket, item, names, "weight", "heavy").where(reaches & is_new)
    counted = others.select(first, second, score).repartition(parts, first, second).groupBy(first, second).agg(total).unionByName(known)
    return counted.orderBy(*places).limit(n)
