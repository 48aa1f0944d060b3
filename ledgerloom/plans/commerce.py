"""Commerce queries: customers, products, orders and order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, history, joins, layout, nested, ranking, skew, timeseries
from ledgerloom.plans.bindings import HISTORY_CHANGE_DATE, ORDER_COMPLETED, SEGMENT_SUCCESSION, Tables
from ledgerloom.plans.registry import query, sql_money, sql_round

PARTITIONS, SLICES = 10, 10
LOYALTY_BANDS = (("gold", 450000.0), ("silver", 50000.0))
SESSION_GAP_DAYS = 30

PRICE, TOTAL = "l_extendedprice", "o_totalprice"
SQL_MONTH = "strftime(o_orderdate, '%Y-%m')"
SQL_EMAIL = "lower(replace(c_name, '#', '.')) || '@example.com'"
SQL_UNIT_PRICE = sql_round("l_extendedprice / l_quantity", 2)
SQL_SKEWED = "case when o_orderstatus = 'F' then 1 else o_custkey end"


def _month() -> Column:
    return F.date_format("order_date", "yyyy-MM")


def _completed_orders(t: Tables) -> DataFrame:
    return t.orders.where(F.col("status") == ORDER_COMPLETED)


# Aggregations

@query("commerce_1_1_revenue_by_category", "-total_revenue", f"""
    SELECT p_type AS category, {sql_money(PRICE)} AS total_revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def revenue_by_category(t: Tables) -> DataFrame:
    return aggregates.revenue_by(t.lines, t.products, "product_id", "category", "line_total")


@query("commerce_1_2_top_customers", "-total_spend customer_id", f"""
    SELECT o_custkey AS customer_id, c_name AS name, {sql_money(TOTAL)} AS total_spend
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
    GROUP BY o_custkey, c_name ORDER BY total_spend DESC, customer_id LIMIT 5""")
def top_customers(t: Tables) -> DataFrame:
    return aggregates.top_n_total(_completed_orders(t), t.customers, "customer_id", ["name"], "total_amount", 5)


@query("commerce_1_3_monthly_revenue", "month", f"""
    SELECT {SQL_MONTH} AS month, count(*) AS order_count, {sql_money(TOTAL)} AS monthly_revenue
    FROM orders GROUP BY 1""")
def monthly_revenue(t: Tables) -> DataFrame:
    return aggregates.period_trend(t.orders, _month(), "total_amount")


@query("commerce_1_4_categories_by_mean_price", "-avg_item_price", f"""
    WITH priced AS (
      SELECT p_type AS category, {sql_money(SQL_UNIT_PRICE)} / count(*) AS mean_price
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type)
    SELECT category, {sql_round("mean_price", 2)} AS avg_item_price
    FROM priced WHERE {sql_round("mean_price", 2)} > 4700""")
def categories_by_mean_price(t: Tables) -> DataFrame:
    per_product = aggregates.totals_by_key(t.lines, "product_id", "unit_price")
    per_category = aggregates.roll_up(per_product, t.products, "product_id", "category")
    return aggregates.mean_above(per_category, "category", 4700, rounded=True, name="avg_item_price")


@query("commerce_1_5_tier_summary", "tier", f"""
    SELECT *, {sql_round("total_revenue / unique_customers", 2)} AS revenue_per_customer FROM (
      SELECT c_mktsegment AS tier, count(DISTINCT o_custkey) AS unique_customers, count(*) AS total_orders,
             {sql_money(TOTAL)} AS total_revenue
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment)""")
def tier_summary(t: Tables) -> DataFrame:
    return aggregates.segment_summary(t.orders, t.customers, "customer_id", "tier", "total_amount")


# Windows

@query("commerce_2_1_top_products_per_category", "category rank name", f"""
    WITH totals AS (
      SELECT p_partkey, p_name AS name, p_type AS category, {sql_money(PRICE)} AS revenue
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    SELECT category, name, revenue, rank FROM (
      SELECT *, dense_rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS rank FROM totals)
    WHERE rank <= 3""")
def top_products_per_category(t: Tables) -> DataFrame:
    sold = aggregates.totals_by_key(t.lines, "product_id", "line_total").join(t.products, "product_id")
    totals = aggregates.finish(sold, ["category", "name"], "revenue")
    return ranking.top_n_per_group(totals, "category", [F.desc("revenue")], 3, "rank", ties="dense")


@query("commerce_2_2_running_daily_revenue", "order_date", f"""
    WITH daily AS (
      SELECT cast(o_orderdate AS date) AS order_date, sum(cast(o_totalprice AS decimal(18,2))) AS revenue
      FROM orders GROUP BY 1)
    SELECT order_date, cast(revenue AS double) AS daily_revenue,
           cast(sum(revenue) OVER (ORDER BY order_date ROWS UNBOUNDED PRECEDING) AS double) AS running_total
    FROM daily""")
def running_daily_revenue(t: Tables) -> DataFrame:
    daily = timeseries.period_totals(t.orders, F.col("order_date"), "total_amount", "order_date", "daily_revenue")
    return timeseries.running_total(daily, "order_date", "daily_revenue")


@query("commerce_2_3_month_over_month", "month", f"""
    WITH monthly AS (SELECT {SQL_MONTH} AS month, {sql_money(TOTAL)} AS monthly_revenue FROM orders GROUP BY 1),
    paired AS (SELECT *, lag(monthly_revenue) OVER (ORDER BY month) AS prev_revenue FROM monthly)
    SELECT *, {sql_round("(monthly_revenue - prev_revenue) / prev_revenue * 100", 2)} AS mom_change_pct
    FROM paired""")
def month_over_month(t: Tables) -> DataFrame:
    monthly = timeseries.period_totals(t.orders, _month(), "total_amount", "month", "monthly_revenue")
    return timeseries.period_change(monthly, "month", "monthly_revenue", "prev_revenue", "mom_change_pct")


@query("commerce_2_4_top_customers_per_tier", "tier rank_in_tier", f"""
    WITH spend AS (
      SELECT c_mktsegment AS tier, o_custkey AS customer_id, c_name AS name, {sql_money(TOTAL)} AS total_spend
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY ALL)
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY tier ORDER BY total_spend DESC, customer_id) AS rank_in_tier
      FROM spend) WHERE rank_in_tier <= 2""")
def top_customers_per_tier(t: Tables) -> DataFrame:
    spent = aggregates.totals_by_key(_completed_orders(t), "customer_id", "total_amount")
    totals = aggregates.finish(
        spent.join(t.customers, "customer_id"), ["tier", "customer_id", "name"], "total_spend")
    return ranking.top_n_per_group(totals, "tier", [F.desc("total_spend"), "customer_id"], 2, "rank_in_tier")


@query("commerce_2_5_amount_percent_rank", "status total_amount order_id", f"""
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total_amount,
           {sql_round("share", 4)} AS pct_rank
    FROM (SELECT *, percent_rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS share FROM orders)""")
def amount_percent_rank(t: Tables) -> DataFrame:
    rows = t.orders.select("order_id", "status", "total_amount")
    return ranking.percent_rank_by(rows, "status", "total_amount")


# Joins

@query("commerce_3_1_enriched_lines", "order_id product_name line_total", f"""
    SELECT o_orderkey AS order_id, cast(o_orderdate AS date) AS order_date, c_name AS customer_name,
           c_mktsegment AS tier, p_name AS product_name, p_type AS category, l_quantity AS quantity,
           {SQL_UNIT_PRICE} AS unit_price, l_extendedprice AS line_total
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'""")
def enriched_lines(t: Tables) -> DataFrame:
    buyers = t.customers.select("customer_id", "name", "tier")
    sales = joins.enrich(_completed_orders(t), [(buyers, "customer_id", {"name": "customer_name"})])
    goods = t.products.select("product_id", "name", "category")
    detailed = joins.enrich(t.lines, [
        (sales.select("order_id", "order_date", "customer_name", "tier"), "order_id", {}),
        (goods, "product_id", {"name": "product_name"}),
    ])
    return detailed.select("order_id", "order_date", "customer_name", "tier", "product_name", "category",
                           "quantity", "unit_price", "line_total")


@query("commerce_3_2_customers_without_activity", "customer_id", f"""
    SELECT c_custkey AS customer_id, c_name AS name, {SQL_EMAIL} AS email, c_mktsegment AS tier
    FROM customer WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""")
def customers_without_activity(t: Tables) -> DataFrame:
    active = t.activity.select(F.col("account_id").alias("customer_id"))
    return joins.without_match(t.customers.drop("c_acctbal"), active, "customer_id")


@query("commerce_3_3_bought_together", "-times_bought_together product_id_1 product_id_2", """
    SELECT a.l_partkey AS product_id_1, b.l_partkey AS product_id_2, count(*) AS times_bought_together
    FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey
    GROUP BY ALL ORDER BY times_bought_together DESC, product_id_1, product_id_2 LIMIT 10""")
def bought_together(t: Tables) -> DataFrame:
    return joins.co_occurrence(t.lines, "order_id", "product_id", 10)


@query("commerce_3_4_bought_from_both", "customer_id", """
    SELECT c_custkey AS customer_id, c_name AS name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                        JOIN part ON p_partkey = l_partkey WHERE p_type = 'SMALL')
      AND c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                        JOIN part ON p_partkey = l_partkey WHERE p_type = 'ECONOMY')""")
def bought_from_both(t: Tables) -> DataFrame:
    wanted = ["SMALL", "ECONOMY"]
    goods = t.products.where(F.col("category").isin(*wanted)).select("product_id", "category")
    bought = t.lines.select("order_id", "product_id").join(goods, "product_id").select("order_id", "category").distinct()
    owners = bought.join(t.orders.select("order_id", "customer_id"), "order_id")
    both = joins.in_all_sets(owners, "customer_id", "category", wanted)
    return both.join(t.customers.select("customer_id", "name"), "customer_id")


@query("commerce_3_5_tier_revenue_share", "tier", f"""
    WITH tiers AS (SELECT c_mktsegment AS tier, {sql_money(TOTAL)} AS tier_revenue
                   FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
    everything AS (SELECT {sql_money(TOTAL)} AS total FROM orders)
    SELECT tier, tier_revenue, {sql_round("tier_revenue / total * 100", 2)} AS revenue_share_pct
    FROM tiers, everything""")
def tier_revenue_share(t: Tables) -> DataFrame:
    tiers = aggregates.revenue_by(t.orders, t.customers, "customer_id", "tier", "total_amount", "tier_revenue")
    return joins.share_of_total(tiers, t.orders, "total_amount", "tier_revenue", "revenue_share_pct")


# Partition layout: a placement has no oracle; beside each stand the facts that hold for any placement.

@query("commerce_4_1_even_layout", "partition_id")
def even_layout(t: Tables) -> DataFrame:
    return layout.partition_profile(layout.spread(t.orders, 4))


@query("commerce_4_1_even_layout_facts", "row_total", """
    SELECT count(*) AS row_total, cast(4 AS bigint) AS partition_total, true AS is_level FROM orders""")
def even_layout_facts(t: Tables) -> DataFrame:
    return layout.layout_facts(layout.spread(t.orders, 4), within=1.25)


@query("commerce_4_2_key_layout_facts", "row_total", f"""
    SELECT count(*) AS row_total, cast({PARTITIONS} AS bigint) AS partition_total, cast(0 AS bigint) AS split_keys
    FROM orders""")
def key_layout_facts(t: Tables) -> DataFrame:
    return layout.layout_facts(layout.hash_layout(t.orders, PARTITIONS, "customer_id"), "customer_id")


@query("commerce_4_3_shrunk_layout_facts", "row_total", """
    SELECT count(*) AS row_total, cast(5 AS bigint) AS partition_total, true AS is_level FROM orders""")
def shrunk_layout_facts(t: Tables) -> DataFrame:
    return layout.layout_facts(layout.shrink(t.orders, 20, 5), within=1.25)


@query("commerce_4_5_range_layout_facts", "row_total", """
    SELECT count(*) AS row_total, cast(5 AS bigint) AS partition_total, cast(0 AS bigint) AS overlapping_ranges FROM orders""")
def range_layout_facts(t: Tables) -> DataFrame:
    return layout.range_facts(t.orders, 5, "total_amount")


@query("commerce_4_2_key_layout", "-row_count partition_id")
def key_layout(t: Tables) -> DataFrame:
    return layout.partition_profile(layout.hash_layout(t.orders, PARTITIONS, "customer_id"))


@query("commerce_4_3_shrunk_layout", "partition_id")
def shrunk_layout(t: Tables) -> DataFrame:
    return layout.partition_profile(layout.shrink(t.orders, 20, 5))


@query("commerce_4_4_status_revenue_in_4_partitions", "-total_revenue", f"""
    SELECT o_orderstatus AS status, {sql_money(TOTAL)} AS total_revenue FROM orders GROUP BY 1""")
def status_revenue_in_4_partitions(t: Tables) -> DataFrame:
    return layout.aggregate_with_partitions(t.orders, "status", "total_amount", 4)


@query("commerce_4_5_range_layout", "partition_id")
def range_layout(t: Tables) -> DataFrame:
    return layout.range_profile(t.orders, 5, "total_amount")


# Skew, on orders of which a third belong to one customer

@query("commerce_5_1_hot_customers", "-order_count customer_id", f"""
    SELECT {SQL_SKEWED} AS customer_id, count(*) AS order_count FROM orders GROUP BY 1
    ORDER BY order_count DESC, customer_id LIMIT 5""")
def hot_customers(t: Tables) -> DataFrame:
    return skew.hot_keys(t.skewed_orders, "customer_id", 5)


@query("commerce_5_2_skew_ratio", "max_orders", f"""
    SELECT max(n) AS max_orders, {sql_round("avg(n)", 2)} AS avg_orders, {sql_round("max(n) / avg(n)", 2)} AS skew_ratio
    FROM (SELECT {SQL_SKEWED} AS customer_id, count(*) AS n FROM orders GROUP BY 1)""")
def skew_ratio(t: Tables) -> DataFrame:
    return skew.skew_ratio(t.skewed_orders, "customer_id")


@query("commerce_5_3_salted_revenue", "customer_id", f"""
    SELECT {SQL_SKEWED} AS customer_id, {sql_money(TOTAL)} AS total_revenue FROM orders GROUP BY 1""")
def salted_revenue(t: Tables) -> DataFrame:
    return skew.salted_aggregate(t.skewed_orders, "customer_id", "total_amount", ["order_id"], SLICES)


SQL_TIER_ORDERS = f"""
    SELECT o_orderkey AS order_id, {SQL_SKEWED} AS customer_id, c_name AS name, o_totalprice AS total_amount
    FROM orders JOIN customer ON c_custkey = {SQL_SKEWED} WHERE c_mktsegment = 'MACHINERY'"""


@query("commerce_5_4_salted_join", "order_id", SQL_TIER_ORDERS)
def salted_join(t: Tables) -> DataFrame:
    lookup = t.customers.where(F.col("tier") == "MACHINERY").select("customer_id", "name")
    rows = t.skewed_orders.select("order_id", "customer_id", "total_amount")
    return skew.salted_join(rows, lookup, "customer_id", ["order_id"], 5).select(
        "order_id", "customer_id", "name", "total_amount")


@query("commerce_5_4_selective_salted_join", "order_id", SQL_TIER_ORDERS)
def selective_salted_join(t: Tables) -> DataFrame:
    lookup = t.customers.where(F.col("tier") == "MACHINERY").select("customer_id", "name")
    rows = t.skewed_orders.select("order_id", "customer_id", "total_amount")
    heavy = skew.heavy_keys(rows, "customer_id", share=0.05, min_rows=0)
    return skew.salted_join(rows, lookup, "customer_id", ["order_id"], 5, heavy).select(
        "order_id", "customer_id", "name", "total_amount")


@query("commerce_5_5_salting_report", "approach")
def salting_report(t: Tables) -> DataFrame:
    return skew.salting_report(t.skewed_orders, "customer_id", ["order_id"], PARTITIONS, 64)


@query("commerce_5_5_salting_facts", "row_total", f"""
    SELECT count(*) AS row_total, cast({PARTITIONS} AS bigint) AS partition_total, true AS is_level FROM orders""")
def salting_facts(t: Tables) -> DataFrame:
    return layout.layout_facts(skew.salted_layout(t.skewed_orders, "customer_id", ["order_id"], PARTITIONS, 64), within=2.0)


# Join strategies and adaptive execution

SQL_ORDER_TIERS = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_mktsegment AS tier, o_totalprice AS total_amount
    FROM orders JOIN customer ON o_custkey = c_custkey"""


def _order_tiers(t: Tables, strategy: str) -> DataFrame:
    tiers = t.customers.select("customer_id", "tier")
    return joins.join_with_strategy(t.orders, tiers, "customer_id", strategy).select(
        "order_id", "customer_id", "tier", "total_amount")


@query("commerce_6_1_lookup_join", "order_id", SQL_ORDER_TIERS)
def lookup_join(t: Tables) -> DataFrame:
    return joins.lookup_join(t.orders, t.customers.select("customer_id", "tier"), "customer_id").select(
        "order_id", "customer_id", "tier", "total_amount")


@query("commerce_6_2_broadcast_strategy", "order_id", SQL_ORDER_TIERS)
def broadcast_strategy(t: Tables) -> DataFrame:
    return _order_tiers(t, "broadcast")


@query("commerce_6_2_automatic_strategy", "order_id", SQL_ORDER_TIERS)
def automatic_strategy(t: Tables) -> DataFrame:
    return _order_tiers(t, "auto")


@query("commerce_6_3_merge_strategy", "order_id", SQL_ORDER_TIERS)
def merge_strategy(t: Tables) -> DataFrame:
    return _order_tiers(t, "merge")


@query("commerce_6_3_shuffle_hash_strategy", "order_id", SQL_ORDER_TIERS)
def shuffle_hash_strategy(t: Tables) -> DataFrame:
    return _order_tiers(t, "shuffle_hash")


@query("commerce_6_4_category_tier_revenue", "category tier", f"""
    SELECT p_type AS category, c_mktsegment AS tier, {sql_money(PRICE)} AS total_revenue, count(*) AS item_count
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def category_tier_revenue(t: Tables) -> DataFrame:
    return aggregates.star_aggregate(t.lines, t.orders, t.products, t.customers, "line_total")


@query("commerce_6_5_adaptive_quantity", "product_id", """
    SELECT l_partkey AS product_id, sum(l_quantity) AS q FROM lineitem GROUP BY 1""")
def adaptive_quantity(t: Tables) -> DataFrame:
    return layout.aggregate_adaptive(t.lines, "product_id", "quantity")


# Arrays and user functions

def _amounts(t: Tables) -> DataFrame:
    return nested.collect_sorted(t.orders, "customer_id", "total_amount", "amounts")


SQL_STATS = f"""
    SELECT o_custkey AS customer_id, count(*) AS order_count, count(*) FILTER (o_totalprice > 250000) AS large_count,
           {sql_money(TOTAL)} AS total_amount_sum
    FROM orders GROUP BY 1"""
SQL_FLAGS = """
    SELECT o_custkey AS customer_id, max(o_totalprice) > 400000 AS has_large_order,
           min(o_totalprice) > 50000 AS all_above_500
    FROM orders GROUP BY 1"""


@query("commerce_7_1_amount_arrays", "customer_id", """
    SELECT o_custkey AS customer_id, cast(0 AS bigint) AS slice, list(o_totalprice ORDER BY o_totalprice) AS amounts
    FROM orders GROUP BY 1""")
def amount_arrays(t: Tables) -> DataFrame:
    return _amounts(t)


@query("commerce_7_1_amount_arrays_whole", "customer_id", """
    SELECT o_custkey AS customer_id, list(o_totalprice ORDER BY o_totalprice) AS amounts FROM orders GROUP BY 1""")
def amount_arrays_whole(t: Tables) -> DataFrame:
    return nested.collect_whole(t.orders, "customer_id", "total_amount", "amounts")


@query("commerce_7_2_array_stats", "customer_id", SQL_STATS)
def array_stats(t: Tables) -> DataFrame:
    return nested.array_stats(_amounts(t), "customer_id", "amounts", 250000.0)


@query("commerce_7_2_group_stats", "customer_id", SQL_STATS)
def group_stats(t: Tables) -> DataFrame:
    return nested.group_stats(t.orders, "customer_id", "total_amount", 250000.0)


@query("commerce_7_3_array_flags", "customer_id", SQL_FLAGS)
def array_flags(t: Tables) -> DataFrame:
    return nested.array_flags(
        _amounts(t), "customer_id", "amounts", 400000.0, 50000.0, "has_large_order", "all_above_500")


@query("commerce_7_3_group_flags", "customer_id", SQL_FLAGS)
def group_flags(t: Tables) -> DataFrame:
    return nested.group_flags(
        t.orders, "customer_id", "total_amount", 400000.0, 50000.0, "has_large_order", "all_above_500")


@query("commerce_7_4_biggest_order", "customer_id", """
    SELECT o_custkey AS customer_id, o_orderkey AS biggest_order_id, o_totalprice AS biggest_amount
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) AS place
          FROM orders) WHERE place = 1""")
def biggest_order(t: Tables) -> DataFrame:
    return ranking.arg_max(
        t.orders, "customer_id", "total_amount", "order_id", "biggest_order_id", "biggest_amount")


SQL_LOYALTY = """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total_amount,
           CASE WHEN o_totalprice >= 450000 THEN 'gold' WHEN o_totalprice >= 50000 THEN 'silver'
                ELSE 'bronze' END AS loyalty_tier
    FROM orders"""


def _loyalty(t: Tables, implementation: str) -> DataFrame:
    rows = t.orders.select("order_id", "customer_id", "total_amount")
    return nested.classify(rows, "total_amount", LOYALTY_BANDS, "bronze", "loyalty_tier", implementation)


@query("commerce_7_5_loyalty_native", "order_id", SQL_LOYALTY)
def loyalty_native(t: Tables) -> DataFrame:
    return _loyalty(t, "native")


@query("commerce_7_5_loyalty_pandas", "order_id", SQL_LOYALTY)
def loyalty_pandas(t: Tables) -> DataFrame:
    return _loyalty(t, "pandas")


@query("commerce_7_5_loyalty_python", "order_id", SQL_LOYALTY)
def loyalty_python(t: Tables) -> DataFrame:
    return _loyalty(t, "python")


# Sessions and history

SQL_SESSIONS = f"""
    WITH marked AS (
      SELECT o_custkey AS customer_id, o_orderkey AS order_id, cast(o_orderdate AS date) AS order_date, o_totalprice,
             lag(cast(o_orderdate AS date)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous
      FROM orders),
    sessions AS (
      SELECT *, cast(sum(CASE WHEN previous IS NULL OR order_date - previous > {SESSION_GAP_DAYS} THEN 1 ELSE 0 END)
                     OVER (PARTITION BY customer_id ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING)
                     AS bigint) AS session_id
      FROM marked)"""


@query("commerce_8_1_sessions", "customer_id order_date order_id", f"""
    {SQL_SESSIONS} SELECT customer_id, order_id, order_date, session_id FROM sessions""")
def sessions(t: Tables) -> DataFrame:
    rows = t.orders.select("customer_id", "order_id", "order_date")
    return history.sessionize(rows, "customer_id", history.day_number("order_date"), SESSION_GAP_DAYS)


@query("commerce_8_1_event_sessions", "account_id session_id txn_id", """
    WITH marked AS (
      SELECT user_id AS account_id, event_id AS txn_id, ts,
             lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
    SELECT account_id, txn_id,
           cast(sum(CASE WHEN previous IS NULL OR ts - previous > INTERVAL 24 HOUR THEN 1 ELSE 0 END)
                OVER (PARTITION BY account_id ORDER BY ts, txn_id ROWS UNBOUNDED PRECEDING) AS bigint) AS session_id
    FROM marked""")
def event_sessions(t: Tables) -> DataFrame:
    rows = t.activity.select("account_id", "txn_id", "ts")
    return history.sessionize(rows, "account_id", history.micro_number("ts"), history.DAY_MICROS).drop("ts")


@query("commerce_8_2_session_summary", "customer_id session_id", f"""
    {SQL_SESSIONS} SELECT customer_id, session_id, min(order_date) AS session_start, max(order_date) AS session_end,
           count(*) AS order_count, {sql_money(TOTAL)} AS session_revenue
    FROM sessions GROUP BY customer_id, session_id""")
def session_summary(t: Tables) -> DataFrame:
    return history.session_summary(
        t.orders, "customer_id", history.day_number("order_date"), SESSION_GAP_DAYS, "order_date", "total_amount")


SQL_NEXT_TIER = "CASE c_mktsegment " + " ".join(
    f"WHEN '{old}' THEN '{new}'" for old, new in SEGMENT_SUCCESSION.items()) + " END"
SQL_HISTORY = f"""
    WITH base AS (
      SELECT c_custkey AS customer_id, c_mktsegment AS tier, c_acctbal < 0 AS moved, {SQL_NEXT_TIER} AS new_tier,
             min(cast(o_orderdate AS date)) AS signup_date
      FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
    dimension AS (
      SELECT customer_id, tier, signup_date AS effective_start,
             CASE WHEN moved THEN DATE '{HISTORY_CHANGE_DATE}' - 1 END AS effective_end, NOT moved AS is_current
      FROM base
      UNION ALL
      SELECT customer_id, new_tier, DATE '{HISTORY_CHANGE_DATE}', NULL, true FROM base WHERE moved)"""


@query("commerce_8_3_changed_tiers", "customer_id", f"""
    SELECT c_custkey AS customer_id, c_mktsegment AS old_tier, {SQL_NEXT_TIER} AS new_tier,
           DATE '{HISTORY_CHANGE_DATE}' AS change_date
    FROM customer WHERE c_acctbal < 0""")
def changed_tiers(t: Tables) -> DataFrame:
    # A tier changes without an order too, so the base is every customer and not only those with a first order.
    return history.changed_rows(t.change_feed, t.customers, "customer_id", "tier", "new_tier", "change_date")


def _dimension(t: Tables) -> DataFrame:
    return history.scd2_apply(
        t.dimension_base, t.change_feed, "customer_id", {"tier": "new_tier"}, "signup_date", "change_date")


@query("commerce_8_4_tier_history", "customer_id effective_start", f"{SQL_HISTORY} SELECT * FROM dimension")
def tier_history(t: Tables) -> DataFrame:
    return _dimension(t)


@query("commerce_8_5_tier_as_of_order", "customer_id as_of_date tier_as_of", f"""
    {SQL_HISTORY} SELECT customer_id, cast(o_orderdate AS date) AS as_of_date, tier AS tier_as_of
    FROM orders JOIN dimension ON customer_id = o_custkey
    WHERE cast(o_orderdate AS date) >= effective_start
      AND (effective_end IS NULL OR cast(o_orderdate AS date) <= effective_end)""")
def tier_as_of_order(t: Tables) -> DataFrame:
    probes = t.orders.select("customer_id", F.col("order_date").alias("as_of_date"))
    return joins.as_of_lookup(
        probes, _dimension(t), "customer_id", "as_of_date", "tier", "effective_start", "effective_end", "tier_as_of")


@query("commerce_8_5_tier_as_of_order_merged", "order_id", f"""
    {SQL_HISTORY} SELECT o_orderkey AS order_id, customer_id, cast(o_orderdate AS date) AS as_of_date, tier
    FROM orders, dimension
    WHERE customer_id = o_custkey
      AND cast(o_orderdate AS date) BETWEEN effective_start AND coalesce(effective_end, DATE '9999-12-31')""")
def tier_as_of_order_merged(t: Tables) -> DataFrame:
    probes = t.orders.select("order_id", "customer_id", F.col("order_date").alias("as_of_date"))
    return joins.as_of_merge(
        probes, _dimension(t), "customer_id", "as_of_date", ["tier"], "effective_start", "effective_end", ["order_id"])

