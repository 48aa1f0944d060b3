"""Grouped totals over a fact table and its dimensions.

Every operator that sums a fact by a dimension attribute first sums it by the join key.  The map-side
combine collapses a hot key before anything is shuffled, the join then sees each key once, and the
same plan serves small dimensions (few keys leave each task) and large ones (one shuffle of the
pruned fact, as a plain join would need anyway).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exact
from ledgerloom.functions.matching import key_list


def totals_by_key(fact: DataFrame, keys: str | Sequence[str], amount: Column | str,
                  when: Column | None = None) -> DataFrame:
    """Totals per key: ``row_total``, ``value_total`` (rows with an amount) and the exact amount.

    ``when`` restricts the amount, not the row count.
    """
    value = exact.cents(amount)
    if when is not None:
        value = F.when(when, value).otherwise(F.lit(0).cast("long"))
    return fact.groupBy(*key_list(keys)).agg(
        F.count(F.lit(1)).alias("row_total"), F.count(value).alias("value_total"), *exact.split_sum(value, "amount")
    )


def roll_up(totals: DataFrame, dim: DataFrame, on: str, to: str | Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Carry totals from the key ``on`` to columns ``to`` of its dimension (and ``keep`` of their own)."""
    to = key_list(to)
    return (
        totals.join(dim.select(*dict.fromkeys([on, *to])), on)
        .groupBy(*keep, *to)
        .agg(F.sum("row_total").alias("row_total"), F.sum("value_total").alias("value_total"),
             *exact.merge_split("amount"))
    )


def finish(totals: DataFrame, keys: str | Sequence[str], name: str, count_name: str | None = None) -> DataFrame:
    """Keys, the row count if named, and the amount as a money double."""
    counts = [F.col("row_total").alias(count_name)] if count_name else []
    return totals.select(*key_list(keys), *counts, exact.split_money("amount").alias(name))


def money_by_key(fact: DataFrame, keys: str | Sequence[str], amount: Column | str, name: str) -> DataFrame:
    """Total amount per key of the fact itself."""
    return fact.groupBy(*key_list(keys)).agg(exact.money_sum(amount).alias(name))


def revenue_by(fact: DataFrame, dim: DataFrame, on: str, by: str | Sequence[str], amount: Column | str,
               name: str = "total_revenue", count_name: str | None = None) -> DataFrame:
    """Total amount (and row count) by attributes of a dimension."""
    return finish(roll_up(totals_by_key(fact, on, amount), dim, on, by), by, name, count_name)


def top_n_total(fact: DataFrame, dim: DataFrame, on: str, by: Sequence[str], amount: Column | str, n: int,
                rank_by: str = "amount", count_name: str | None = None,
                name: str = "total_spend") -> DataFrame:
    """The ``n`` keys with the largest total amount (or row count), ties broken by the key.

    A key without a match in ``dim`` does not qualify, so the join comes before the limit.
    """
    matched = totals_by_key(fact, on, amount).join(dim.select(on, *by), on)
    first = F.desc(name) if rank_by == "amount" else F.desc(count_name)
    return finish(matched, [on, *by], name, count_name).orderBy(first, F.asc(on)).limit(n)


def period_trend(df: DataFrame, period: Column, amount: Column | str, period_name: str = "month",
                 count_name: str = "order_count", name: str = "monthly_revenue") -> DataFrame:
    """Row count and total amount per calendar period."""
    return df.groupBy(period.alias(period_name)).agg(
        F.count(F.lit(1)).alias(count_name), exact.money_sum(amount).alias(name)
    )


def mean_above(totals: DataFrame, keys: str | Sequence[str], threshold: float, rounded: bool, name: str,
               count_name: str | None = None) -> DataFrame:
    """Groups whose mean amount exceeds ``threshold``.

    ``rounded`` says whether the mean is compared as shown (two decimals) or unrounded.
    """
    counts = [F.col("row_total").alias(count_name)] if count_name else []
    mean = F.try_divide(exact.split_money("amount"), F.col("value_total"))
    shown = totals.withColumn("__mean", mean).withColumn(name, exact.half_up("__mean", 2))
    return shown.where(F.col(name if rounded else "__mean") > threshold).select(*key_list(keys), name, *counts)


def segment_summary(fact: DataFrame, dim: DataFrame, on: str, by: str, amount: Column | str) -> DataFrame:
    """Distinct keys, rows, revenue and revenue per key, by segment.

    After the pre-aggregation each key is one row, so distinct keys are counted by counting rows:
    no second distinct pass and no row expansion.
    """
    return (
        totals_by_key(fact, on, amount)
        .join(dim.select(on, by), on)
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("row_total").alias("total_orders"),
            exact.merged_money("amount").alias("total_revenue"),
        )
        .withColumn("revenue_per_customer",
                    exact.half_up(F.col("total_revenue") / F.col("unique_customers"), 2))
    )


def nested_summary(users: DataFrame, accounts: DataFrame, txns: DataFrame, by: str, completed: Column,
                   amount: Column | str) -> DataFrame:
    """Users, accounts, transactions and completed amount per group, keeping users without any.

    Equals three distinct counts over ``users LEFT JOIN accounts LEFT JOIN txns``, computed by rolling
    up one level at a time (transactions to accounts, accounts to users, users to groups).
    """
    per_account = totals_by_key(txns, "account_id", amount, when=completed)
    per_user = (
        accounts.select("account_id", "user_id")
        .join(per_account, "account_id", "left")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("account_total"),
            F.sum("row_total").alias("row_total"),
            *exact.merge_split("amount"),
        )
    )
    zero = F.lit(0).cast("long")
    return (
        users.select("user_id", by)
        .join(per_user, "user_id", "left")
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.coalesce(F.sum("account_total"), zero).alias("account_count"),
            F.coalesce(F.sum("row_total"), zero).alias("txn_count"),
            F.coalesce(exact.merged_money("amount"), F.lit(0.0)).alias("total_completed_amount"),
        )
    )


def star_aggregate(lines: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame,
                   amount: Column | str) -> DataFrame:
    """Revenue and line count by product category and customer tier.

    Lines are totalled per (order, category) before they meet the orders, so that a hot order crosses
    the shuffle as a few rows per task.  Which side of a join is broadcast is left to Spark's byte
    threshold.
    """
    categories = products.select("product_id", "category")
    per_order = totals_by_key(lines.join(categories, "product_id"), ["order_id", "category"], amount)
    tiers = orders.select("order_id", "customer_id").join(customers.select("customer_id", "tier"), "customer_id")
    return (
        per_order.join(tiers.select("order_id", "tier"), "order_id")
        .groupBy("category", "tier")
        .agg(exact.merged_money("amount").alias("total_revenue"), F.sum("row_total").alias("item_count"))
    )
