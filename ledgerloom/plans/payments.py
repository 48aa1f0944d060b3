"""Payments queries: users, accounts, merchants and transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, joins, quality, ranking, reshape, sets, skew, timeseries
from ledgerloom.operators.layout import hash_layout, layout_facts, partition_statistics
from ledgerloom.plans.bindings import ACCOUNT_ACTIVE, TXN_COMPLETED, TXN_CREDIT, TXN_DEBIT, Tables
from ledgerloom.plans.registry import query, sql_money, sql_round
from ledgerloom.sources import load_tables, row_counts

STATUSES = ("F", "O", "P")

AMOUNT = "l_extendedprice"
SQL_DATE = "cast(l_shipdate AS date)"
SQL_MONTH = f"cast(date_trunc('month', {SQL_DATE}) AS date)"
SQL_YEAR = f"cast(year({SQL_DATE}) AS bigint)"
SQL_EMAIL = "lower(replace(c_name, '#', '.')) || '@example.com'"
SQL_MERCHANTS = "supplier JOIN nation ON s_nationkey = n_nationkey"
SQL_USERS = "customer JOIN nation ON c_nationkey = n_nationkey"


def _month() -> Column:
    return F.trunc("txn_date", "MM")


def _year() -> Column:
    return F.year("txn_date").cast("long")


def _is_completed() -> Column:
    return F.col("status") == TXN_COMPLETED


def _is_debit() -> Column:
    return F.col("txn_type") == TXN_DEBIT


def _per_user(t: Tables, txns: DataFrame, **options) -> DataFrame:
    """Totals per user: transactions to accounts, accounts to users."""
    return aggregates.roll_up(
        aggregates.totals_by_key(txns, "account_id", "amount", **options), t.accounts, "account_id", "user_id")


def _per_merchant(t: Tables, txns: DataFrame) -> DataFrame:
    return aggregates.totals_by_key(txns, "merchant_id", "amount").join(t.merchants, "merchant_id")


# Aggregations

@query("payments_1_1_debits_by_category", "-total_spent", f"""
    SELECT n_name AS mcc_category, {sql_money(AMOUNT)} AS total_spent
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    WHERE l_linestatus = 'F' AND l_returnflag = 'N' GROUP BY n_name""")
def debits_by_category(t: Tables) -> DataFrame:
    return aggregates.revenue_by(
        t.completed_debits, t.merchants, "merchant_id", "mcc_category", "amount", "total_spent")


@query("payments_1_2_busiest_merchants", "-txn_count merchant_id", f"""
    SELECT l_suppkey AS merchant_id, s_name AS name, n_name AS mcc_category, count(*) AS txn_count,
           {sql_money(AMOUNT)} AS total_amount
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY ALL ORDER BY txn_count DESC, merchant_id LIMIT 10""")
def busiest_merchants(t: Tables) -> DataFrame:
    return aggregates.top_n_total(
        t.txns, t.merchants, "merchant_id", ["name", "mcc_category"], "amount", 10,
        rank_by="count", count_name="txn_count", name="total_amount")


@query("payments_1_3_monthly_by_account_type", "month account_type", f"""
    SELECT {SQL_MONTH} AS month, o_orderpriority AS account_type, count(*) AS txn_count,
           {sql_money(AMOUNT)} AS total_amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'N' GROUP BY ALL""")
def monthly_by_account_type(t: Tables) -> DataFrame:
    dated = t.completed.withColumn("month", _month())
    totals = aggregates.totals_by_key(dated, ["account_id", "month"], "amount")
    rolled = aggregates.roll_up(totals, t.accounts, "account_id", "account_type", keep=["month"])
    return aggregates.finish(rolled, ["month", "account_type"], "total_amount", "txn_count")


@query("payments_1_4_users_by_mean_debit", "-avg_txn_amount user_id", f"""
    WITH means AS (
      SELECT o_custkey, {sql_money(AMOUNT)} / count(*) AS mean, count(*) AS txn_count
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_linestatus = 'F' AND l_returnflag = 'N' GROUP BY o_custkey)
    SELECT c_custkey AS user_id, c_name AS name, n_name AS country, c_mktsegment AS tier,
           {sql_round("mean", 2)} AS avg_txn_amount, txn_count
    FROM means JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE mean > 40000""")
def users_by_mean_debit(t: Tables) -> DataFrame:
    means = aggregates.mean_above(_per_user(t, t.completed_debits), "user_id", 40000, rounded=False,
                                  name="avg_txn_amount", count_name="txn_count")
    return means.join(t.users, "user_id").select("user_id", "name", "country", "tier", "avg_txn_amount", "txn_count")


@query("payments_1_5_country_summary", "-user_count country", f"""
    SELECT n_name AS country, count(DISTINCT c_custkey) AS user_count, count(DISTINCT o_orderkey) AS account_count,
           count(l_orderkey) AS txn_count,
           {sql_money("CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END")} AS total_completed_amount
    FROM {SQL_USERS} LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY n_name""")
def country_summary(t: Tables) -> DataFrame:
    return aggregates.nested_summary(t.users, t.accounts, t.txns, "country", _is_completed(), "amount")


# Windows

@query("payments_2_1_running_balance", "account_id txn_date txn_id", """
    SELECT event_id AS txn_id, user_id AS account_id, cast(ts AS date) AS txn_date, value AS amount,
           event_type AS txn_type,
           cast(sum(cast(CASE WHEN event_type = 'purchase' THEN value ELSE -value END AS decimal(18,2)))
                OVER (PARTITION BY user_id ORDER BY cast(ts AS date), event_id ROWS UNBOUNDED PRECEDING) AS double)
             AS running_balance
    FROM events WHERE event_type <> 'error'""")
def running_balance(t: Tables) -> DataFrame:
    rows = t.activity.where(F.col("txn_type") != "error").select(
        "txn_id", "account_id", "txn_date", "amount", "txn_type")
    signed = F.when(F.col("txn_type") == "purchase", F.col("amount")).otherwise(-F.col("amount"))
    return timeseries.running_balance(rows, "account_id", "txn_date", "txn_id", signed)


@query("payments_2_2_top_merchants_per_category", "mcc_category revenue_rank merchant_id", f"""
    WITH sold AS (SELECT l_suppkey, {sql_money(AMOUNT)} AS revenue FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
    podium AS (
      SELECT s_nationkey AS nation, list(DISTINCT revenue ORDER BY revenue DESC)[1:3] AS best
      FROM sold JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1)
    SELECT s_suppkey AS merchant_id, s_name AS name, n_name AS mcc_category, revenue AS total_revenue,
           cast(list_position(best, revenue) AS bigint) AS revenue_rank
    FROM podium JOIN nation ON n_nationkey = nation JOIN supplier ON s_nationkey = nation
    JOIN sold ON l_suppkey = s_suppkey WHERE list_contains(best, revenue)""")
def top_merchants_per_category(t: Tables) -> DataFrame:
    totals = aggregates.finish(
        _per_merchant(t, t.completed), ["merchant_id", "name", "mcc_category"], "total_revenue")
    return ranking.top_n_per_group(totals, "mcc_category", [F.desc("total_revenue")], 3, "revenue_rank", ties="dense")


@query("payments_2_3_monthly_change_per_country", "country month", f"""
    WITH monthly AS (
      SELECT n_name AS country, {SQL_MONTH} AS month, {sql_money(AMOUNT)} AS monthly_spend
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey
      WHERE l_linestatus = 'F' AND l_returnflag = 'N' GROUP BY ALL),
    paired AS (SELECT *, lag(monthly_spend) OVER (PARTITION BY country ORDER BY month) AS prev_month_spend FROM monthly)
    SELECT *, {sql_round("(monthly_spend - prev_month_spend) / prev_month_spend * 100", 2)} AS mom_pct_change
    FROM paired""")
def monthly_change_per_country(t: Tables) -> DataFrame:
    dated = t.completed_debits.withColumn("month", _month())
    per_account = aggregates.totals_by_key(dated, ["account_id", "month"], "amount")
    per_user = aggregates.roll_up(per_account, t.accounts, "account_id", "user_id", keep=["month"])
    per_country = aggregates.roll_up(per_user, t.users, "user_id", "country", keep=["month"])
    monthly = aggregates.finish(per_country, ["country", "month"], "monthly_spend")
    return timeseries.period_change(
        monthly, "month", "monthly_spend", "prev_month_spend", "mom_pct_change", by="country")


def _user_spend(t: Tables) -> DataFrame:
    return aggregates.finish(
        _per_user(t, t.completed_debits).join(t.users, "user_id"),
        ["user_id", "name", "country", "tier"], "total_spend")


SQL_SPEND = f"""
    spend AS (
      SELECT o_custkey AS buyer, {sql_money(AMOUNT)} AS spent FROM orders
      JOIN (FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'N') ON l_orderkey = o_orderkey GROUP BY 1)"""


@query("payments_2_4_top_users_per_country", "country spend_rank", f"""
    WITH {SQL_SPEND},
    leaders AS (
      SELECT c_nationkey AS nation, list(buyer ORDER BY spent DESC, buyer)[1:2] AS best
      FROM spend JOIN customer ON c_custkey = buyer GROUP BY 1)
    SELECT buyer AS user_id, c_name AS name, n_name AS country, c_mktsegment AS tier, spent AS total_spend,
           cast(list_position(best, buyer) AS bigint) AS spend_rank
    FROM leaders JOIN nation ON n_nationkey = nation JOIN customer ON c_nationkey = nation
    JOIN spend ON buyer = c_custkey WHERE list_contains(best, buyer)""")
def top_users_per_country(t: Tables) -> DataFrame:
    return ranking.top_n_per_group(
        _user_spend(t), "country", [F.desc("total_spend"), "user_id"], 2, "spend_rank")


@query("payments_2_5_amount_percent_rank", "mcc_category amount account_id part_id merchant_id", f"""
    SELECT account_id, part_id, merchant_id, mcc_category, amount, {sql_round("share", 4)} AS pct_rank FROM (
      SELECT l_orderkey AS account_id, l_partkey AS part_id, l_suppkey AS merchant_id, n_name AS mcc_category,
             l_extendedprice AS amount, percent_rank() OVER (PARTITION BY n_name ORDER BY l_extendedprice) AS share
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      WHERE l_returnflag = 'N')""")
def amount_percent_rank(t: Tables) -> DataFrame:
    rows = t.completed.join(t.merchants, "merchant_id").select(
        "account_id", "part_id", "merchant_id", "mcc_category", "amount")
    return ranking.percent_rank_by(rows, "mcc_category", "amount")


# Joins

@query("payments_3_1_full_detail", "account_id part_id merchant_id", """
    SELECT l_orderkey AS account_id, l_partkey AS part_id, l_suppkey AS merchant_id, cast(l_shipdate AS date) AS txn_date,
           l_extendedprice AS amount, l_linestatus AS txn_type, l_returnflag AS status, c_name AS user_name,
           un.n_name AS country, c_mktsegment AS tier, o_orderpriority AS account_type, s_name AS merchant_name,
           mn.n_name AS mcc_category
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation un ON c_nationkey = un.n_nationkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation mn ON s_nationkey = mn.n_nationkey""")
def full_detail(t: Tables) -> DataFrame:
    owners = joins.enrich(t.accounts.select("account_id", "user_id", "account_type"), [
        (t.users.select("user_id", "name", "country", "tier"), "user_id", {"name": "user_name"})])
    detailed = joins.enrich(t.txns, [
        (owners, "account_id", {}),
        (t.merchants, "merchant_id", {"name": "merchant_name"}),
    ])
    return detailed.select("account_id", "part_id", "merchant_id", "txn_date", "amount", "txn_type", "status",
                           "user_name", "country", "tier", "account_type", "merchant_name", "mcc_category")


@query("payments_3_2_users_without_large_txn", "user_id", f"""
    SELECT c_custkey AS user_id, c_name AS name, {SQL_EMAIL} AS email, n_name AS country, c_mktsegment AS tier
    FROM {SQL_USERS} WHERE c_custkey NOT IN (
      SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_extendedprice > 90000)""")
def users_without_large_txn(t: Tables) -> DataFrame:
    busy = joins.with_match(t.accounts.select("account_id", "user_id"), t.txns.where("amount > 90000"), "account_id")
    return joins.without_match(t.users, busy, "user_id").select("user_id", "name", "email", "country", "tier")


@query("payments_3_3_revenue_for_two_tiers", "mcc_category tier", f"""
    SELECT mn.n_name AS mcc_category, c_mktsegment AS tier, count(*) AS txn_count, {sql_money(AMOUNT)} AS total_revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation mn ON s_nationkey = mn.n_nationkey
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND l_returnflag = 'N' GROUP BY ALL""")
def revenue_for_two_tiers(t: Tables) -> DataFrame:
    chosen = t.users.where(F.col("tier").isin("BUILDING", "MACHINERY")).select("user_id", "tier")
    owners = t.accounts.select("account_id", "user_id").join(chosen, "user_id").select("account_id", "tier")
    per_account = aggregates.totals_by_key(t.completed, ["account_id", "merchant_id"], "amount")
    totals = aggregates.roll_up(per_account, owners, "account_id", "tier", keep=["merchant_id"])
    rolled = aggregates.roll_up(totals, t.merchants, "merchant_id", "mcc_category", keep=["tier"])
    return aggregates.finish(rolled, ["mcc_category", "tier"], "total_revenue", "txn_count")


@query("payments_3_4_accounts_with_both_types", "account_id", """
    SELECT o_orderkey AS account_id, o_orderpriority AS account_type, o_custkey AS user_id FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'N')
      AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O' AND l_returnflag = 'N')""")
def accounts_with_both_types(t: Tables) -> DataFrame:
    both = joins.in_all_sets(t.completed, "account_id", "txn_type", [TXN_DEBIT, TXN_CREDIT])
    return t.accounts.select("account_id", "account_type", "user_id").join(both, "account_id", "left_semi")


@query("payments_3_5_above_country_mean", "country -total_spend user_id", f"""
    WITH {SQL_SPEND}
    SELECT buyer AS user_id, c_name AS name, n_name AS country, spent AS total_spend,
           {sql_round("cast(sum(cast(spent AS decimal(18,2))) OVER here AS double) / count(*) OVER here", 2)} AS country_avg_spend
    FROM spend JOIN customer ON c_custkey = buyer JOIN nation ON n_nationkey = c_nationkey
    WINDOW here AS (PARTITION BY n_nationkey) QUALIFY total_spend > country_avg_spend""")
def above_country_mean(t: Tables) -> DataFrame:
    return joins.above_group_mean(_user_spend(t), "country", "total_spend", "country_avg_spend").select(
        "user_id", "name", "country", "total_spend", "country_avg_spend")


# Named steps

@query("payments_4_1_merchants_above_category_mean", "mcc_category -total_revenue", f"""
    WITH sold AS (
      SELECT l_suppkey, count(*) AS n, {sql_money(AMOUNT)} AS revenue FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
    placed AS (
      SELECT s_suppkey, s_name, n_name, n, revenue, {sql_round(
          "cast(sum(cast(revenue AS decimal(18,2))) OVER (PARTITION BY n_nationkey) AS double)"
          " / count(*) OVER (PARTITION BY n_nationkey)", 2)} AS usual
      FROM sold JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
    SELECT s_suppkey AS merchant_id, s_name AS merchant_name, n_name AS mcc_category, revenue AS total_revenue,
           n AS txn_count, usual AS avg_category_revenue, {sql_round("revenue / usual", 2)} AS revenue_vs_avg
    FROM placed WHERE revenue > usual""")
def merchants_above_category_mean(t: Tables) -> DataFrame:
    stats = aggregates.finish(
        _per_merchant(t, t.completed).withColumnRenamed("name", "merchant_name"),
        ["merchant_id", "merchant_name", "mcc_category"], "total_revenue", "txn_count")
    return sets.ratio_to_group_mean(
        stats, "mcc_category", "total_revenue", "avg_category_revenue", "revenue_vs_avg"
    ).select("merchant_id", "merchant_name", "mcc_category", "total_revenue", "txn_count", "avg_category_revenue",
             "revenue_vs_avg")


@query("payments_4_2_latest_txn_per_account", "account_id", """
    SELECT user_id AS account_id, event_id AS txn_id, cast(ts AS date) AS txn_date, value AS amount, event_type AS txn_type
    FROM events WHERE event_type = 'purchase'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY cast(ts AS date) DESC, event_id DESC) = 1""")
def latest_txn_per_account(t: Tables) -> DataFrame:
    purchases = t.activity.where(F.col("txn_type") == "purchase")
    return ranking.latest_per_key(
        purchases, "account_id", ["txn_date", "txn_id"], ["txn_id", "txn_date", "amount", "txn_type"])


@query("payments_4_3_high_value_users", "-total_debit user_id", """
    SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS tier, n_name AS country, txn_count,
           cast(debit AS double) AS total_debit
    FROM (SELECT o_custkey, count(l_orderkey) AS txn_count, cast(coalesce(sum(cast(l_extendedprice AS decimal(18,2)))
                 FILTER (l_linestatus = 'F' AND l_returnflag = 'N'), 0) AS decimal(24,2)) AS debit
          FROM lineitem JOIN (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey
          GROUP BY o_custkey
          QUALIFY debit * cast(count(*) OVER () AS decimal(10,0)) > 2 * sum(debit) OVER ()) AS spenders
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def high_value_users(t: Tables) -> DataFrame:
    active = t.accounts.where(F.col("status") == ACCOUNT_ACTIVE)
    per_account = aggregates.totals_by_key(t.txns, "account_id", "amount", when=_is_debit() & _is_completed())
    totals = aggregates.finish(
        aggregates.roll_up(per_account, active, "account_id", "user_id"), "user_id", "total_debit", "txn_count")
    high = sets.above_mean_multiple(totals, "total_debit", 2)
    return high.join(t.users, "user_id").select("user_id", "name", "tier", "country", "txn_count", "total_debit")


@query("payments_4_4_monthly_calendar", "month", f"""
    WITH bounds AS (
      SELECT min({SQL_MONTH}) AS low, max({SQL_MONTH}) AS high FROM lineitem),
    calendar AS (
      SELECT cast(unnest(generate_series(low, high, INTERVAL 1 MONTH)) AS date) AS month FROM bounds),
    totals AS (
      SELECT {SQL_MONTH} AS month, count(*) AS txn_count, {sql_money(AMOUNT)} AS total_amount
      FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'F' AND l_extendedprice > 103000 GROUP BY 1)
    SELECT month, coalesce(txn_count, 0) AS txn_count, coalesce(total_amount, 0.0) AS total_amount
    FROM calendar LEFT JOIN totals USING (month)""")
def monthly_calendar(t: Tables) -> DataFrame:
    kept = _is_completed() & _is_debit() & (F.col("amount") > 103000)
    return timeseries.calendar_fill(t.txns, "txn_date", kept, "amount")


@query("payments_4_5_newest_active_account", "user_id", """
    SELECT o_orderkey AS account_id, o_custkey AS user_id, o_orderpriority AS account_type,
           cast(o_orderdate AS date) AS opened_date, o_totalprice AS balance
    FROM orders WHERE o_orderstatus = 'F'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def newest_active_account(t: Tables) -> DataFrame:
    active = t.accounts.where(F.col("status") == ACCOUNT_ACTIVE)
    return ranking.latest_per_key(
        active, "user_id", ["opened_date", "account_id"], ["account_id", "account_type", "opened_date", "balance"]
    ).select("account_id", "user_id", "account_type", "opened_date", "balance")


# Time series

@query("payments_5_1_rolling_daily_mean", "txn_date", f"""
    WITH daily AS (
      SELECT {SQL_DATE} AS txn_date, count(*) AS daily_count, sum(cast(l_extendedprice AS decimal(18,2))) AS total
      FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
    rolled AS (
      SELECT *, cast(sum(total) OVER w AS double) / count(*) OVER w AS mean FROM daily
      WINDOW w AS (ORDER BY txn_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
    SELECT txn_date, daily_count, cast(total AS double) AS daily_amount, {sql_round("mean", 2)} AS rolling_7d_avg
    FROM rolled""")
def rolling_daily_mean(t: Tables) -> DataFrame:
    daily = timeseries.period_totals(
        t.completed, F.col("txn_date"), "amount", "txn_date", "daily_amount", count_name="daily_count")
    return timeseries.rolling_mean(daily, "txn_date", "daily_amount", 7, "rolling_7d_avg")


@query("payments_5_2_first_txn_cohorts", "cohort_month", f"""
    WITH firsts AS (
      SELECT o_custkey, min({SQL_DATE}) AS first_day FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_returnflag = 'N' GROUP BY 1)
    SELECT cast(date_trunc('month', first_day) AS date) AS cohort_month, count(*) AS new_active_users
    FROM firsts GROUP BY 1""")
def first_txn_cohorts(t: Tables) -> DataFrame:
    per_account = t.completed.groupBy("account_id").agg(F.min("txn_date").alias("txn_date"))
    owned = per_account.join(t.accounts.select("account_id", "user_id"), "account_id")
    return timeseries.first_seen_cohorts(owned, "user_id", "txn_date")


@query("payments_5_3_activity_gaps", "-gap_days account_id gap_start", """
    WITH active AS (SELECT DISTINCT o_custkey AS who, cast(o_orderdate AS date) AS day FROM orders)
    SELECT here.who AS account_id, here.day AS gap_start, min(later.day) AS gap_end, min(later.day) - here.day AS gap_days
    FROM active AS here JOIN active AS later ON later.who = here.who AND later.day > here.day
    GROUP BY here.who, here.day HAVING min(later.day) - here.day > 30""")
def activity_gaps(t: Tables) -> DataFrame:
    opened = t.accounts.select(F.col("user_id").alias("account_id"), "opened_date")
    return timeseries.gaps(opened, "account_id", "opened_date", 30)


@query("payments_5_4_yearly_change_per_category", "mcc_category year", f"""
    WITH yearly AS (
      SELECT n_name AS mcc_category, {SQL_YEAR} AS year, {sql_money(AMOUNT)} AS total_revenue
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      WHERE l_linestatus = 'F' AND l_returnflag = 'N' GROUP BY ALL),
    paired AS (
      SELECT *, lag(total_revenue) OVER (PARTITION BY mcc_category ORDER BY year) AS prev_year_revenue FROM yearly)
    SELECT *, {sql_round("(total_revenue - prev_year_revenue) / prev_year_revenue * 100", 2)} AS yoy_pct_change
    FROM paired""")
def yearly_change_per_category(t: Tables) -> DataFrame:
    dated = t.completed_debits.withColumn("year", _year())
    totals = aggregates.totals_by_key(dated, ["merchant_id", "year"], "amount")
    rolled = aggregates.roll_up(totals, t.merchants, "merchant_id", "mcc_category", keep=["year"])
    yearly = aggregates.finish(rolled, ["mcc_category", "year"], "total_revenue")
    return timeseries.period_change(
        yearly, "year", "total_revenue", "prev_year_revenue", "yoy_pct_change", by="mcc_category")


@query("payments_5_5_busy_days", "-daily_count txn_date", f"""
    WITH moments AS (
      SELECT {sql_round("sum(c) / count(*)", 2)} AS mean_daily_count,
             {sql_round("sqrt((sum(c * c) - sum(c) * sum(c) / count(*)) / (count(*) - 1))", 2)} AS std_daily_count
      FROM (SELECT count(*) AS c FROM orders GROUP BY cast(o_orderdate AS date)))
    SELECT cast(o_orderdate AS date) AS txn_date, count(*) AS daily_count, {sql_money("o_totalprice")} AS daily_amount,
           any_value(mean_daily_count) AS mean_daily_count, any_value(std_daily_count) AS std_daily_count
    FROM orders, moments GROUP BY 1
    HAVING count(*) > any_value(mean_daily_count) + 2 * any_value(std_daily_count)""")
def busy_days(t: Tables) -> DataFrame:
    daily = timeseries.period_totals(
        t.orders, F.col("order_date"), "total_amount", "txn_date", "daily_amount", count_name="daily_count")
    return timeseries.anomalies(daily, "daily_count", 2)


# Advanced windows

@query("payments_6_1_activity_streaks", "-streak_length account_id streak_start", """
    WITH days AS (SELECT DISTINCT user_id AS who, cast(ts AS date) AS day FROM events),
    opening AS (SELECT who, day FROM days ANTI JOIN (SELECT who, day + 1 AS day FROM days) AS eve USING (who, day)),
    closing AS (SELECT who, day FROM days ANTI JOIN (SELECT who, day - 1 AS day FROM days) AS next USING (who, day))
    SELECT o.who AS account_id, o.day AS streak_start, min(c.day) AS streak_end, min(c.day) - o.day + 1 AS streak_length
    FROM opening o JOIN closing c ON c.who = o.who AND c.day >= o.day
    GROUP BY o.who, o.day HAVING min(c.day) - o.day >= 2""")
def activity_streaks(t: Tables) -> DataFrame:
    return timeseries.streaks(t.activity, "account_id", "txn_date", 3)


@query("payments_6_2_moving_mean", "account_id txn_date txn_id", f"""
    WITH framed AS (
      SELECT event_id AS txn_id, user_id AS account_id, cast(ts AS date) AS txn_date, value AS amount,
             cast(sum(cast(value AS decimal(18,2))) OVER w AS double) / count(*) OVER w AS mean
      FROM events WHERE event_type <> 'error'
      WINDOW w AS (PARTITION BY user_id ORDER BY cast(ts AS date), event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
    SELECT txn_id, account_id, txn_date, amount, {sql_round("mean", 2)} AS moving_avg_3 FROM framed""")
def moving_mean(t: Tables) -> DataFrame:
    rows = t.activity.where("txn_type <> 'error'").select("txn_id", "account_id", "txn_date", "amount")
    return timeseries.moving_mean(rows, "account_id", "txn_date", "txn_id", "amount", 3, "moving_avg_3")


@query("payments_6_3_balance_quartiles", "account_type balance_quartile account_id", """
    SELECT o_orderkey AS account_id, o_orderpriority AS account_type, o_totalprice AS balance,
           ntile(4) OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice, o_orderkey) AS balance_quartile
    FROM orders""")
def balance_quartiles(t: Tables) -> DataFrame:
    rows = t.accounts.select("account_id", "account_type", "balance")
    return ranking.ntile_by(rows, "account_type", "balance", "account_id", 4, "balance_quartile")


@query("payments_6_4_category_percentiles", "mcc_category", f"""
    WITH found AS (
      SELECT n_name AS mcc_category, percentile_cont(0.5) WITHIN GROUP (ORDER BY l_extendedprice) AS median,
             percentile_cont(0.9) WITHIN GROUP (ORDER BY l_extendedprice) AS p90
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
      WHERE l_returnflag = 'N' GROUP BY n_name)
    SELECT mcc_category, {sql_round("median", 2)} AS median_amount, {sql_round("p90", 2)} AS p90_amount FROM found""")
def category_percentiles(t: Tables) -> DataFrame:
    rows = t.completed.join(t.merchants.select("merchant_id", "mcc_category"), "merchant_id")
    return ranking.percentiles_by(rows, "mcc_category", "amount", {"median_amount": 0.5, "p90_amount": 0.9})


@query("payments_6_4_category_percentiles_approx", "mcc_category", """
    SELECT n_name AS mcc_category, quantile_disc(l_extendedprice, 0.5) AS median_amount,
           quantile_disc(l_extendedprice, 0.9) AS p90_amount
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    WHERE l_returnflag = 'N' GROUP BY n_name""")
def category_percentiles_approx(t: Tables) -> DataFrame:
    """Exact where a category has no more rows than the accuracy, as in the test tables."""
    rows = t.completed.join(t.merchants.select("merchant_id", "mcc_category"), "merchant_id")
    wanted = {"median_amount": 0.5, "p90_amount": 0.9}
    return ranking.approx_percentiles_by(rows, "mcc_category", "amount", wanted, accuracy=1_000_000)


@query("payments_6_5_first_and_last_amount", "account_id", """
    SELECT user_id AS account_id, arg_min(value, {'day': cast(ts AS date), 'id': event_id}) AS first_amount,
           arg_max(value, {'day': cast(ts AS date), 'id': event_id}) AS last_amount
    FROM events WHERE event_type <> 'error' GROUP BY 1""")
def first_and_last_amount(t: Tables) -> DataFrame:
    return ranking.first_last(
        t.activity.where("txn_type <> 'error'"), "account_id", ["txn_date", "txn_id"], "amount", "first_amount", "last_amount")


# Set operations and subqueries

@query("payments_7_1_customers_without_big_order", "customer_id", """
    SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS tier FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""")
def customers_without_big_order(t: Tables) -> DataFrame:
    big = t.orders.where("total_amount > 400000")
    return joins.without_match(t.customers, big, "customer_id").select("customer_id", "name", "tier")


@query("payments_7_2_users_with_large_txn", "user_id", f"""
    SELECT c_custkey AS user_id, c_name AS name, n_name AS country, c_mktsegment AS tier FROM {SQL_USERS}
    WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                  WHERE o_custkey = c_custkey AND l_extendedprice > 90000 AND l_returnflag = 'N')""")
def users_with_large_txn(t: Tables) -> DataFrame:
    large = joins.with_match(
        t.accounts.select("account_id", "user_id"), t.completed.where("amount > 90000"), "account_id")
    return joins.with_match(t.users, large, "user_id").select("user_id", "name", "country", "tier")


@query("payments_7_3_categories_of_both_tiers", "mcc_category", """
    SELECT n_name AS mcc_category FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING' AND l_returnflag = 'N'
    INTERSECT
    SELECT n_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey WHERE c_mktsegment = 'MACHINERY' AND l_returnflag = 'N'""")
def categories_of_both_tiers(t: Tables) -> DataFrame:
    tiers = ["BUILDING", "MACHINERY"]
    chosen = t.users.where(F.col("tier").isin(*tiers)).select("user_id", "tier")
    owners = t.accounts.select("account_id", "user_id").join(chosen, "user_id").select("account_id", "tier")
    met = t.completed.select("account_id", "merchant_id").distinct()
    used = met.join(owners, "account_id").select("merchant_id", "tier").distinct()
    return joins.in_all_sets(used.join(t.merchants, "merchant_id"), "mcc_category", "tier", tiers)


@query("payments_7_3_brands_of_both_types", "brand", """
    SELECT p_brand AS brand FROM part WHERE p_type = 'SMALL'
    INTERSECT SELECT p_brand FROM part WHERE p_type = 'ECONOMY'""")
def brands_of_both_types(t: Tables) -> DataFrame:
    def brands(category: str) -> DataFrame:
        return t.products.where(F.col("category") == category).select("brand")

    return sets.common_values(brands("SMALL"), brands("ECONOMY"))


@query("payments_7_4_only_completed_customers", "customer_id", """
    SELECT o_custkey AS customer_id FROM orders WHERE o_orderstatus = 'F'
    EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def only_completed_customers(t: Tables) -> DataFrame:
    def owners(status: str) -> DataFrame:
        return t.orders.where(F.col("status") == status).select("customer_id")

    return sets.only_in_first(owners("F"), owners("O"))


@query("payments_7_5_merchants_above_a_whole_category", "-total_revenue", f"""
    WITH sold AS (SELECT l_suppkey, {sql_money(AMOUNT)} AS revenue FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
    named AS (SELECT * FROM sold JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
    SELECT s_suppkey AS merchant_id, s_name AS name, n_name AS mcc_category, revenue AS total_revenue
    FROM named, (SELECT coalesce(max(revenue) FILTER (n_name = 'NATION_3'), '-infinity'::double) AS bar FROM named)
    WHERE n_name <> 'NATION_3' AND revenue > bar""")
def merchants_above_a_whole_category(t: Tables) -> DataFrame:
    totals = aggregates.finish(
        _per_merchant(t, t.completed), ["merchant_id", "name", "mcc_category"], "total_revenue")
    rivals = totals.where(F.col("mcc_category") == "NATION_3")
    others = totals.where(F.col("mcc_category") != "NATION_3")
    return sets.compare_quantified(others, F.col("total_revenue"), ">", rivals, "total_revenue", "all")


# Reshape and data quality

def _yearly_by_status(t: Tables) -> DataFrame:
    counted = t.completed.groupBy("account_id", _year().alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    owned = counted.join(t.accounts.select("account_id", F.col("status").alias("account_status")), "account_id")
    return reshape.pivot_count(owned, "yr", "account_status", STATUSES, weight="n")


SQL_PIVOT = f"""
    SELECT {SQL_YEAR} AS yr, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
           count(*) FILTER (o_orderstatus = 'P') AS P
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'N' GROUP BY 1"""


@query("payments_8_1_yearly_pivot", "yr", SQL_PIVOT)
def yearly_pivot(t: Tables) -> DataFrame:
    return _yearly_by_status(t)


@query("payments_8_2_yearly_unpivot", "yr account_status", f"""
    UNPIVOT ({SQL_PIVOT}) ON F, O, P INTO NAME account_status VALUE txn_count""")
def yearly_unpivot(t: Tables) -> DataFrame:
    return reshape.unpivot_counts(_yearly_by_status(t), "yr", STATUSES, "account_status", "txn_count")


@query("payments_8_3_duplicate_activity", "-dup_count account_id txn_type txn_date", """
    SELECT user_id AS account_id, event_type AS txn_type, cast(ts AS date) AS txn_date, count(*) AS dup_count
    FROM events GROUP BY ALL HAVING count(*) > 1""")
def duplicate_activity(t: Tables) -> DataFrame:
    return quality.duplicate_groups(t.activity, ["account_id", "txn_type", "txn_date"])


@query("payments_8_4_orphan_documents", "doc_id", """
    SELECT doc_id, source, lang FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def orphan_documents(t: Tables) -> DataFrame:
    child = t.raw("documents").select("doc_id", "source", "lang")
    return quality.orphans(child, [
        (t.raw("labels"), "doc_id", "doc_id"),
        (t.raw("embeddings"), "doc_id", "vec_id"),
    ])


SQL_NULLED = """
    WITH nulled AS (
      SELECT l_orderkey AS account_id, nullif(l_suppkey, 0) AS merchant_id, nullif(l_tax, 0.0) AS amount,
             cast(l_shipdate AS date) AS txn_date, nullif(l_returnflag, 'A') AS status FROM lineitem)"""


@query("payments_8_5_null_profile", "column_name", SQL_NULLED + " UNION ALL ".join(
    f"\n    SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS total_rows FROM nulled"
    for c in ("account_id", "merchant_id", "amount", "txn_date", "status")))
def null_profile(t: Tables) -> DataFrame:
    nulled = t.raw("lineitem").select(
        F.col("l_orderkey").alias("account_id"), F.nullif("l_suppkey", F.lit(0)).alias("merchant_id"),
        F.nullif("l_tax", F.lit(0.0)).alias("amount"), F.col("l_shipdate").cast("date").alias("txn_date"),
        F.nullif("l_returnflag", F.lit("A")).alias("status"))
    return quality.null_profile(nulled, nulled.columns)


# Whole-library operators

@query("tables_row_counts", "table_name", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                 "embeddings", "pages", "benchmark", "labels", "conversations")))
def table_row_counts(t: Tables) -> DataFrame:
    return row_counts(load_tables(t.spark, t.folder))


@query("dataset_diff_completed_against_all", "customer_id", f"""
    WITH actual AS (
      SELECT o_custkey AS customer_id, {sql_money("o_totalprice")} AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
    expected AS (SELECT o_custkey AS customer_id, {sql_money("o_totalprice")} AS total FROM orders GROUP BY 1)
    SELECT customer_id, CASE WHEN a.total IS NULL THEN 'missing' WHEN e.total IS NULL THEN 'extra' ELSE 'changed' END
             AS difference
    FROM actual a FULL JOIN expected e USING (customer_id)
    WHERE a.total IS NULL OR e.total IS NULL OR abs(a.total - e.total) > 0.01""")
def completed_against_all(t: Tables) -> DataFrame:
    everything = aggregates.money_by_key(t.orders, "customer_id", "total_amount", "total")
    only_completed = aggregates.money_by_key(t.orders.where("status = 'F'"), "customer_id", "total_amount", "total")
    return quality.dataset_diff(only_completed, everything, ["customer_id"])


@query("dataset_diff_salted_against_plain", "compared_keys", f"""
    WITH owned AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE o_custkey END AS customer_id, * FROM orders),
    parts AS (SELECT customer_id, o_orderpriority, {sql_money("o_totalprice")} AS part FROM owned GROUP BY ALL),
    salted AS (SELECT customer_id, {sql_money("part")} AS total FROM parts GROUP BY 1),
    plain AS (SELECT customer_id, {sql_money("o_totalprice")} AS total FROM owned GROUP BY 1)
    SELECT count(*) AS compared_keys, count(*) FILTER ((abs(salted.total - plain.total) <= 0.01) IS NOT TRUE) AS differing_keys
    FROM salted FULL JOIN plain USING (customer_id)""")
def salted_against_plain(t: Tables) -> DataFrame:
    salted = skew.salted_aggregate(t.skewed_orders, "customer_id", "total_amount", ["order_id"], 10)
    plain = aggregates.money_by_key(t.skewed_orders, "customer_id", "total_amount", "total_revenue")
    return quality.diff_summary(salted, plain, ["customer_id"])


@query("dataset_diff_checksums_of_closed_orders", "order_id", """
    SELECT o_orderkey AS order_id, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
                                        THEN 'missing' ELSE 'changed' END AS difference
    FROM orders
    WHERE o_orderstatus = 'P' OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def closed_orders_by_checksums(t: Tables) -> DataFrame:
    """The orders once the pending ones are closed and those of indebted customers are gone, against all orders."""
    indebted = t.customers.where("c_acctbal < 0")
    closed = joins.without_match(t.orders, indebted, "customer_id").select(t.orders.columns)
    closed = closed.withColumn("status", F.when(F.col("status") == "P", "F").otherwise(F.col("status")))
    return quality.checksum_diff(closed, t.orders, ["order_id"])


@query("partition_statistics_of_accounts", "approach")
def account_partition_statistics(t: Tables) -> DataFrame:
    return partition_statistics(hash_layout(t.accounts, 10, "user_id"), "by_user")


@query("partition_statistics_of_accounts_facts", "row_total", """
    SELECT count(*) AS row_total, cast(10 AS bigint) AS partition_total, true AS is_level, cast(0 AS bigint) AS split_keys
    FROM orders""")
def account_partition_facts(t: Tables) -> DataFrame:
    return layout_facts(hash_layout(t.accounts, 10, "user_id"), "user_id", within=2.0)
