"""Running, moving and calendar computations.

Windows here run over rows already reduced to calendar periods, whose number does not grow with the
data.  The two that must work row by row (running balance, moving mean) work range by range
(``functions.positions``), so that a key of any size is spread over many tasks: one takes over the sums of the
earlier ranges of a key, the other its last rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import exact
from ledgerloom.functions.matching import key_list
from ledgerloom.functions.positions import RANGE, SHARED, carried, in_ranges, with_carried


def period_totals(df: DataFrame, period: Column, amount: Column | str, period_name: str, name: str,
                  count_name: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Total (and row count) per calendar period, optionally within groups."""
    counted = [F.count(F.lit(1)).alias(count_name)] if count_name else []
    return df.groupBy(*by, period.alias(period_name)).agg(*counted, exact.money_sum(amount).alias(name))


def running_total(periods: DataFrame, period: str, measure: str, name: str = "running_total") -> DataFrame:
    """Cumulative total over periods.  The input has one row per calendar period."""
    window = Window.orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return periods.withColumn(name, exact.from_cents(F.sum(exact.cents(measure)).over(window)))


def period_change(periods: DataFrame, period: str, measure: str, previous_name: str, change_name: str,
                  by: str | Sequence[str] = ()) -> DataFrame:
    """Previous period's measure and percentage change; the input has one row per (group, period)."""
    window = Window.partitionBy(*key_list(by)).orderBy(period)
    return periods.withColumn(previous_name, F.lag(measure, 1).over(window)).withColumn(
        change_name, exact.change_pct(measure, previous_name))


def rolling_mean(periods: DataFrame, period: str, measure: str, rows: int, name: str) -> DataFrame:
    """Mean over the last ``rows`` periods present (rows, not calendar distance)."""
    window = Window.orderBy(period).rowsBetween(-(rows - 1), Window.currentRow)
    total = exact.from_cents(F.sum(exact.cents(measure)).over(window))
    return periods.withColumn(name, exact.half_up(total / F.count(measure).over(window), 2))


def calendar_fill(df: DataFrame, day: str, kept: Column, amount: Column | str, period_name: str = "month",
                  count_name: str = "txn_count", name: str = "total_amount") -> DataFrame:
    """Monthly count and total of the kept rows, with zeros for empty months.

    The calendar spans all rows, kept or not.  Each month found is followed by the empty months up to
    the next one, so the data is read once and nothing is joined.
    """
    month = F.trunc(day, "MM")
    months = df.where(F.col(day).isNotNull()).groupBy(month.alias("__month")).agg(
        F.count(F.when(kept, 1)).alias("__count"), exact.money_sum(F.when(kept, exact.as_column(amount))).alias("__sum")
    )
    following = F.lead("__month").over(Window.orderBy("__month"))
    until = F.coalesce(F.add_months(following, -1), F.col("__month"))
    filled = months.withColumn("__until", until).withColumn(
        period_name, F.explode(F.sequence("__month", "__until", F.expr("INTERVAL 1 MONTH"))))
    here = F.col(period_name) == F.col("__month")
    return filled.select(
        period_name,
        F.when(here, F.col("__count")).otherwise(0).alias(count_name),
        F.coalesce(F.when(here, F.col("__sum")), F.lit(0.0)).alias(name),
    )


def first_seen_cohorts(first_days: DataFrame, key: str, day: str, period_name: str = "cohort_month",
                       name: str = "new_active_users") -> DataFrame:
    """Keys per month of their first day.  The input may hold several days per key."""
    first = first_days.groupBy(key).agg(F.min(day).alias("first_day"))
    return first.groupBy(F.trunc("first_day", "MM").alias(period_name)).agg(F.count(F.lit(1)).alias(name))


def gaps(df: DataFrame, key: str, day: str, min_days: int) -> DataFrame:
    """Stretches of more than ``min_days`` (zero or more) days without a row, per key.

    Rows of the same day have no gap between them, so each key is first reduced to its distinct days.
    """
    days = df.select(key, day).where(F.col(day).isNotNull()).distinct()
    previous = F.lag(day).over(Window.partitionBy(key).orderBy(day))
    return (
        days.withColumn("gap_start", previous)
        .select(key, "gap_start", F.col(day).alias("gap_end"),
                F.datediff(day, "gap_start").cast("long").alias("gap_days"))
        .where(F.col("gap_days") > min_days)
    )


def streaks(df: DataFrame, key: str, day: str, min_length: int) -> DataFrame:
    """Runs of consecutive days with activity, at least ``min_length`` long."""
    days = df.select(key, day).where(F.col(day).isNotNull()).distinct()
    position = F.row_number().over(Window.partitionBy(key).orderBy(day))
    return (
        days.withColumn("__island", F.date_sub(day, position))
        .groupBy(key, "__island")
        .agg(
            F.min(day).alias("streak_start"),
            F.max(day).alias("streak_end"),
            F.count(F.lit(1)).alias("streak_length"),
        )
        .where(F.col("streak_length") >= min_length)
        .drop("__island")
    )


def anomalies(periods: DataFrame, count_name: str, k: float) -> DataFrame:
    """Periods whose count exceeds the rounded mean plus ``k`` rounded sample deviations.

    The input has one row per calendar period, so the statistics come from a window over all of them
    and the data behind the periods is read once.
    """
    every = Window.partitionBy()
    mean = F.sum(count_name).over(every) / F.count(count_name).over(every)
    return (
        periods.withColumn(f"mean_{count_name}", exact.half_up(mean, 2))
        .withColumn(f"std_{count_name}", exact.half_up(F.stddev_samp(count_name).over(every), 2))
        .where(F.col(count_name) > F.col(f"mean_{count_name}") + k * F.col(f"std_{count_name}"))
    )


def running_balance(df: DataFrame, key: str, day: str, row_id: str, amount: Column, name: str = "running_balance",
                    bits: int | None = None) -> DataFrame:
    """Cumulative signed amount per key in (day, row id) order; ``row_id`` is unique.

    Null keys are one key and null days come first.  The balance is null until the first amount.
    """
    ranged = in_ranges(df.withColumn("__cents", exact.cents(amount)), [key], [day, row_id], bits=bits)
    window = Window.partitionBy(key, RANGE).orderBy(day, row_id).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumns({"__sum": F.sum("__cents").over(window), "__count": F.count("__cents").over(window)})
    before = carried(ranged, [key], {"__c": F.coalesce("__cents", F.lit(0)), "__k": F.col("__cents").isNotNull().cast("long")})
    found = with_carried(summed, before.select(key, RANGE, "__c_before", "__k_before"), [key])
    seen = F.col("__count") + F.coalesce("__k_before", F.lit(0))
    balance = F.when(seen > 0, F.coalesce("__sum", F.lit(0)) + F.coalesce("__c_before", F.lit(0)))
    return found.withColumn(name, exact.from_cents(balance)).select(*df.columns, name)


def moving_mean(df: DataFrame, key: str, day: str, row_id: str, amount: str, rows: int, name: str,
                segment_rows: int | None = None, bits: int | None = None) -> DataFrame:
    """Mean of the last ``rows`` rows of the key, in (day, row id) order; ``row_id`` is unique.

    Each range takes part in the frames with the last ``rows - 1`` rows of the key that lie before it, be they in
    one earlier range or in several.  ``segment_rows`` is how many rows a range holds, about; by
    default ``bits`` says how many ranges there are.
    """
    if segment_rows is not None:
        if segment_rows < rows:
            raise ValueError("a segment must hold a frame")
        bits = max(df.count() // segment_rows, 1).bit_length() if bits is None else bits
    ranged = in_ranges(df, [key], [day, row_id], bits=bits)
    everything = ranged.select(*df.columns, RANGE, F.lit(False).alias("__copy"))
    if rows > 1:
        following = Window.partitionBy(key).orderBy(RANGE).rowsBetween(1, rows - 1)
        shared = carried(ranged, [key], {"__n": F.lit(1)}).withColumn(
            "__later", F.collect_list(F.struct(F.col(RANGE).alias("range"), F.col("__n_before").alias("before"))).over(following))
        from_end = Window.partitionBy(key, RANGE).orderBy(F.desc(day), F.desc(row_id))
        last = ranged.where(SHARED).withColumn("__back", F.row_number().over(from_end)).where(F.col("__back") < rows)
        place = F.col("__n_before") + F.col("__n_here") - F.col("__back")
        reached = F.filter("__later", lambda later: later["before"] - place < rows)
        copies = with_carried(last, shared, [key], "inner").withColumn("__to", F.explode(reached))
        everything = everything.union(copies.select(*df.columns, "__to.range", F.lit(True)))
    frame = Window.partitionBy(key, RANGE).orderBy(day, row_id).rowsBetween(-(rows - 1), Window.currentRow)
    total = exact.from_cents(F.sum(exact.cents(amount)).over(frame))
    mean = exact.half_up(F.try_divide(total, F.count(amount).over(frame)), 2)
    return everything.withColumn(name, mean).where("NOT __copy").select(*df.columns, name)
