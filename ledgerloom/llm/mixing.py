"""Mixing sources to target weights.

Rows get hash-random keys and are ordered by them inside each source.  Distributed prefix sums of
the word counts then say where in its source a row lies, and each source is cut at its exact budget,
after as many whole passes (epochs) as the budget holds.

Edge cases: a null source is a source of its own; a null or empty text has size 0 and gives nothing;
repeated rows are rows of their own; an empty table gives an empty mix; columns of the caller keep
their names (working names start with two underscores).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import WORD, cell_totals, checkpointed, hash_key, prefix_sums, without, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_EPOCHS = 2.0


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS
) -> DataFrame:
    """``__source, source_size, target`` from ``__source, source_size``, one row per source.

    All targets together are ``share`` times all sizes.  They follow the weights, which are given to
    the sources by ascending name and repeat, but stop at ``most`` times the size; what is left over
    goes to the others by weight, until none is above its stop.

    With the sources in ascending order of stop / weight, the stopped ones are a prefix.  ``level`` is
    what a unit of weight gets if just the sources before a row are stopped; the first row whose
    level does not pass its own stop / weight gives the level that holds.
    """
    named = Window.orderBy(F.col("__source") == "n", "__source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"))
    by_stop = Window.orderBy(F.col("__stop") / F.col("__weight"), "__source")
    everything = Window.partitionBy()
    placed = (
        sizes.withColumn("__weight", weight)
        .withColumn("__stop", F.lit(float(most)) * F.col("source_size"))
        .withColumn("__all", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("__stopped", F.coalesce(F.sum("__stop").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("__open", F.sum("__weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("__level", (F.col("__all") - F.col("__stopped")) / F.col("__open"))
    )
    holds = F.when(F.col("__level") <= F.col("__stop") / F.col("__weight"), F.col("__level"))
    return (
        placed.withColumn("__level", F.max(holds).over(everything))
        .select("__source", "source_size", F.least("__stop", F.coalesce(F.col("__weight") * F.col("__level"), F.col("__stop"))).alias("target"))
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    row_id: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
) -> DataFrame:
    """The documents with what the mix takes of each.

    Adds ``size`` (words), ``source_size``, ``target``, ``epochs`` (whole passes), ``rest`` (words
    taken in the last, partial pass) and ``taken = epochs * size + rest``.  The taken words of a
    source add up to the whole part of its target.  The order inside a source depends on ids only,
    so that a second run takes the same.
    """
    rows = without(docs, "size", "source_size", "target", "epochs", "rest", "taken").withColumns({
        "size": word_count(F.col(text)),
        "__source": F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")),
        "__key": hash_key(row_id),
    })
    totals = checkpointed(cell_totals(rows, "__source", "__key", F.col("size")))
    targets = source_targets(totals.groupBy("__source").agg(F.sum("__total").alias("source_size")), weights, share, most)
    placed = prefix_sums(rows, totals, "__source", "__key", [row_id, "size"], F.col("size"), "__before").join(targets, "__source")
    budget = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    return (
        placed.withColumn("epochs", passes)
        .withColumn("__left", budget - F.col("epochs") * F.col("source_size") - F.col("__before"))
        .withColumn("rest", F.greatest(F.lit(0).cast("long"), F.least("size", "__left")))
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("rest"))
        .drop("__source", "__key", "__before", "__left")
    )


def mixed_documents(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: a row per whole pass over a document, and one cut after ``rest`` words.

    Keeps the columns of ``docs``; a column ``n_chars`` follows the cut.  The cut is lossless up to
    its place: the text is split before white space that follows a word.
    """
    space = r"\x20\x09-\x0D"
    words = F.split(F.col(text), f"(?<=[^{space}])(?=[{space}])")
    start = F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("rest"), F.lit(1)).cast("int")), "")
    cut = F.when((F.col("__pass") > F.col("epochs")) & (F.col("rest") < F.col("size")), start).otherwise(F.col(text))
    passes = F.col("epochs") + (F.col("rest") > 0).cast("int")
    mixed = (
        mix(docs.withColumnsRenamed({c: f"__in_{c}" for c in docs.columns}), text=f"__in_{text}", **{
            "source": f"__in_{options.pop('source', 'source')}", "row_id": f"__in_{options.pop('row_id', 'doc_id')}"}, **options)
        .where(passes > 0)
        .withColumnRenamed(f"__in_{text}", text)
        .withColumn("__pass", F.explode(F.sequence(F.lit(1).cast("long"), passes)))
        .withColumn(f"__in_{text}", cut)
    )
    kept = mixed.select(*[F.col(f"__in_{c}").alias(c) for c in docs.columns])
    return kept.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


ORACLE = rf"""
with sized as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) as bigint) as size from documents
), sources as (
  select source, sum(size) as n, row_number() over (order by source nulls last) as r from sized group by source
), stops as (
  select source, n, 2.0::double * n as cap, [3.0::double, 1.0, 2.0][1 + (r - 1) % 3] as w from sources
), levels as (
  select a.source, a.n, a.cap, a.w, (select 1.5::double * sum(n) from stops) as total,
    (select coalesce(sum(b.cap), 0) from stops b where b.cap / b.w < a.cap / a.w) as stopped,
    (select sum(b.w) from stops b where b.cap / b.w >= a.cap / a.w) as open_weight
  from stops a
), level as (
  select max((total - stopped) / open_weight) as unit from levels where (total - stopped) / open_weight <= cap / w
), targets as (
  select source, cast(n as bigint) as source_size, least(cap, w * unit) as target from levels, level
), placed as (
  select s.doc_id, s.size, t.source_size, t.target,
    coalesce(sum(s.size) over (partition by s.source order by substr(md5(coalesce(s.doc_id::varchar, '')), 1, 15), s.doc_id
      rows between unbounded preceding and 1 preceding), 0) as before
  from sized s join targets t on s.source is not distinct from t.source
), budgets as (
  select *, cast(floor(target) as bigint) as budget,
    case when source_size > 0 then cast(floor(target) as bigint) // source_size else 0 end as epochs from placed
)
select doc_id, size, source_size, round(target, 3) as target,
  cast(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) as bigint) as taken from budgets
"""
