"""Sessions, change detection and type-2 dimension history."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import exact
from ledgerloom.functions.matching import null_safe_join

DAY_MICROS = 24 * 60 * 60 * 1_000_000


def day_number(day: Column | str) -> Column:
    """A date as days since 1970, for a gap given in days."""
    return F.unix_date(exact.as_column(day)).cast("long")


def micro_number(instant: str) -> Column:
    """A time-zone-free timestamp as microseconds since 1970, for a gap given in microseconds."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {instant})")


def _session_stretches(rows: DataFrame, key: str, gap: int, aggregates: list[Column]) -> DataFrame:
    """One row per (key, stretch) with its session number.

    A stretch is a span of the time line ``gap`` units long.  Two rows inside one can never be more
    than ``gap`` apart, so sessions break only between stretches, and the window that numbers them sees
    (time line / gap) rows per key, however many rows a key has.
    """
    stretches = rows.groupBy(key, "__stretch").agg(
        F.min("__at").alias("__first"), F.max("__at").alias("__last"), *aggregates)
    in_order = Window.partitionBy(key).orderBy("__stretch")
    previous = F.lag("__last").over(in_order)
    opens = F.when(previous.isNull() | (F.col("__first") - previous > gap), 1).otherwise(0).cast("long")
    return stretches.withColumn("__opens", opens).withColumn("session_id", F.sum("__opens").over(in_order))


def _on_time_line(df: DataFrame, at: Column, gap: int) -> DataFrame:
    return df.withColumn("__at", at).withColumn("__stretch", F.floor(F.col("__at") / max(gap, 1)))


def sessionize(df: DataFrame, key: str, at: Column, gap: int) -> DataFrame:
    """Number the sessions of each key: a new one starts after a gap of more than ``gap``, the first is 1.

    ``at`` is a whole number of time units and ``gap`` is in the same unit.
    """
    rows = _on_time_line(df, at, gap)
    sessions = _session_stretches(rows.select(key, "__at", "__stretch"), key, gap, []).select(
        key, "__stretch", "session_id")
    return null_safe_join(rows, sessions, [key, "__stretch"]).drop("__at", "__stretch")


def session_summary(df: DataFrame, key: str, at: Column, gap: int, day: str, amount: str) -> DataFrame:
    """Start, end, rows and revenue per session, added up from stretches; no row is numbered."""
    rows = _on_time_line(df, at, gap)
    stretches = _session_stretches(rows, key, gap, [
        F.min(day).alias("start"), F.max(day).alias("end"), F.count(F.lit(1)).alias("rows"),
        *exact.split_sum(exact.cents(amount), "amount"),
    ])
    return stretches.groupBy(key, "session_id").agg(
        F.min("start").alias("session_start"),
        F.max("end").alias("session_end"),
        F.sum("rows").alias("order_count"),
        exact.merged_money("amount").alias("session_revenue"),
    )


def _differs(old: Column, new: Column, null_safe: bool) -> Column:
    return ~old.eqNullSafe(new) if null_safe else F.coalesce(old != new, F.lit(False))


def changed_rows(feed: DataFrame, base: DataFrame, key: str, attr: str, new_attr: str, change: str,
                 null_safe: bool = False) -> DataFrame:
    """Keys of the feed whose attribute differs from the base, with both values.

    A null on either side counts as unchanged unless ``null_safe``.
    """
    return (
        feed.select(key, new_attr, change)
        .join(base.select(key, attr), key)
        .where(_differs(F.col(attr), F.col(new_attr), null_safe))
        .select(key, F.col(attr).alias(f"old_{attr}"), new_attr, change)
    )


def scd2_apply(base: DataFrame, feed: DataFrame, key: str, attrs: Mapping[str, str], start: str, change: str,
               null_safe: bool = False) -> DataFrame:
    """Type-2 history of ``base`` after applying one change feed.

    ``attrs`` maps each tracked attribute to its column in the feed, which holds one row per key;
    feed keys missing from the base are ignored.  A changed key yields its closed version and the new
    current one, any other key its open version: one left join, and no second pass over the base.
    """
    news = feed.select(key, F.col(change).alias("__change"), *[F.col(n).alias(f"__{a}") for a, n in attrs.items()])
    differs = reduce(Column.__or__, [_differs(F.col(a), F.col(f"__{a}"), null_safe) for a in attrs])
    is_changed = F.col("__change").isNotNull() & differs
    open_end = F.lit(None).cast("date")

    def version(values: list[Column], since: Column, until: Column, current: bool) -> Column:
        return F.struct(*values, since.alias("effective_start"), until.alias("effective_end"),
                        F.lit(current).alias("is_current"))

    old = [F.col(a).alias(a) for a in attrs]
    new = [F.col(f"__{a}").alias(a) for a in attrs]
    since = F.col(start)
    versions = F.when(
        is_changed,
        F.array(version(old, since, F.date_sub("__change", 1), False),
                version(new, F.col("__change"), open_end, True)),
    ).otherwise(F.array(version(old, since, open_end, True)))
    return base.join(news, key, "left").select(key, F.inline(versions))
