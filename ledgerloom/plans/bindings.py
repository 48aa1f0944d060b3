"""The two business views of the given tables, under the column names the queries speak.

Status and type columns keep their stored values, so that filters on them reach the Parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import exact
from ledgerloom.sources import load_table

# Stored codes and what they stand for.
ORDER_COMPLETED = "F"
ACCOUNT_ACTIVE = "F"
TXN_COMPLETED = "N"
TXN_DEBIT = "F"
TXN_CREDIT = "O"
HISTORY_CHANGE_DATE = "1998-06-01"
SEGMENT_SUCCESSION = {
    "AUTOMOBILE": "BUILDING",
    "BUILDING": "FURNITURE",
    "FURNITURE": "HOUSEHOLD",
    "HOUSEHOLD": "MACHINERY",
    "MACHINERY": "AUTOMOBILE",
}


def _email(name: str) -> Column:
    return F.concat(F.lower(F.replace(F.col(name), F.lit("#"), F.lit("."))), F.lit("@example.com"))


class Tables:
    """Views over one folder of tables; each is built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return load_table(self.spark, self.folder, name)

    def register_views(self, prefix: str = "") -> None:
        """Temporary views of the business tables, for queries written as SQL text."""
        named = {
            "customers": self.customers, "products": self.products, "orders": self.orders, "order_items": self.lines,
            "users": self.users, "merchants": self.merchants, "accounts": self.accounts, "transactions": self.txns,
        }
        for name, table in named.items():
            table.createOrReplaceTempView(prefix + name)

    # Commerce: customers, products, orders, order lines.

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
            _email("c_name").alias("email"), F.col("c_mktsegment").alias("tier"), "c_acctbal",
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"), F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total_amount"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            exact.half_up(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("unit_price"),
            F.col("l_extendedprice").alias("line_total"),
        )

    @cached_property
    def skewed_orders(self) -> DataFrame:
        """Orders with every completed one, about a third, given to customer 1."""
        owner = F.when(F.col("status") == ORDER_COMPLETED, F.lit(1).cast("long")).otherwise(F.col("customer_id"))
        return self.orders.withColumn("customer_id", owner)

    @cached_property
    def dimension_base(self) -> DataFrame:
        """Every customer with a tier, in force since the first order."""
        signup = self.orders.groupBy("customer_id").agg(F.min("order_date").alias("signup_date"))
        return self.customers.select("customer_id", "tier").join(signup, "customer_id")

    @cached_property
    def change_feed(self) -> DataFrame:
        """A tier for every customer: the next one for those with a negative balance, else as it was."""
        following = F.create_map(*[F.lit(word) for pair in SEGMENT_SUCCESSION.items() for word in pair])
        moved = F.when(F.col("c_acctbal") < 0, following[F.col("tier")]).otherwise(F.col("tier"))
        return self.customers.select(
            "customer_id", moved.alias("new_tier"), F.lit(HISTORY_CHANGE_DATE).cast("date").alias("change_date"))

    # Payments: users, accounts, merchants, transactions.

    @cached_property
    def nations(self) -> DataFrame:
        return self.raw("nation").select("n_nationkey", F.col("n_name").alias("country"))

    @cached_property
    def users(self) -> DataFrame:
        people = self.raw("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), _email("c_name").alias("email"),
            F.col("c_mktsegment").alias("tier"), F.col("c_nationkey").alias("n_nationkey"),
        )
        return people.join(self.nations, "n_nationkey").drop("n_nationkey")

    @cached_property
    def merchants(self) -> DataFrame:
        sellers = self.raw("supplier").select(
            F.col("s_suppkey").alias("merchant_id"), F.col("s_name").alias("name"),
            F.col("s_nationkey").alias("n_nationkey"),
        )
        categories = self.nations.withColumnRenamed("country", "mcc_category")
        return sellers.join(categories, "n_nationkey").drop("n_nationkey")

    @cached_property
    def accounts(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("account_id"), F.col("o_custkey").alias("user_id"),
            F.col("o_orderpriority").alias("account_type"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderdate").cast("date").alias("opened_date"), F.col("o_totalprice").alias("balance"),
        )

    @cached_property
    def txns(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("account_id"), F.col("l_suppkey").alias("merchant_id"),
            F.col("l_partkey").alias("part_id"), F.col("l_extendedprice").alias("amount"),
            F.col("l_linestatus").alias("txn_type"), F.col("l_returnflag").alias("status"),
            F.col("l_shipdate").cast("date").alias("txn_date"),
        )

    @cached_property
    def completed(self) -> DataFrame:
        return self.txns.where(F.col("status") == TXN_COMPLETED)

    @cached_property
    def completed_debits(self) -> DataFrame:
        return self.completed.where(F.col("txn_type") == TXN_DEBIT)

    # Transactions with a unique id.

    @cached_property
    def activity(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("txn_id"), F.col("user_id").alias("account_id"), "ts",
            F.col("ts").cast("date").alias("txn_date"), F.col("event_type").alias("txn_type"),
            F.col("value").alias("amount"),
        )
