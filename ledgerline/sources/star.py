"""Canonical sales, customer, product and location tables from a star schema."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.params import LadderParams, SnapshotParams

# Columns of the star schema tables.
COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}
ANONYMOUS = "household"
# Lines that one task joins. Spark sizes tasks by compressed bytes, and these few
# narrow columns compress so well that sorts and maps of a task take gigabytes.
TASK_LINES = 1_000_000
LATEST = date(2001, 7, 31)


def snapshot_params(months: int = 12) -> SnapshotParams:
    """Tier gates at which every tier is populated in these tables."""
    return SnapshotParams(
        latest=LATEST,
        months=months,
        anonymous_group=ANONYMOUS,
        t_high=400.0,
        t_mid_high=250.0,
        t_mid=120.0,
        a_high=1200.0,
        f_high=3,
        f_mid=2,
    )


def ladder_params() -> LadderParams:
    return LadderParams(
        as_of=LATEST,
        minima=(400000, 300000, 200000, 150000, 100000, 60000, 30000, 0),
    )


def read(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A table by its declared columns, which saves a job to infer them."""
    return spark.read.schema(COLUMNS[name]).parquet(f"{directory}/{name}.parquet")


def by_order(lineitem: DataFrame, task_lines: int = TASK_LINES) -> DataFrame:
    """Lines dealt out by order to as many tasks as their number needs.

    The count reads file footers alone. A table of fewer parts than cores is left
    as it is: Spark gives it a task a core, or broadcasts the orders.
    """
    parts = -(-lineitem.count() // task_lines)
    if parts <= lineitem.sparkSession.sparkContext.defaultParallelism:
        return lineitem
    return lineitem.repartition(parts, "l_orderkey")


def sales(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    is_return = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    net = F.col("l_extendedprice").cast("decimal(15,2)") * (
        1 - F.col("l_discount").cast("decimal(4,2)")
    )

    def signed(amount: Column) -> Column:
        amount = amount.cast("decimal(18,4)")
        return F.when(is_return, -amount).otherwise(amount)

    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("invoice_date"),
        F.col("l_partkey").alias("product_id"),
        signed(F.col("l_quantity")).alias("quantity"),
        signed(net).alias("revenue"),
        F.col("l_suppkey").alias("store_id"),
    )


def products(part: DataFrame) -> DataFrame:
    kind = F.col("p_type")
    category = (
        F.when(kind == "ECONOMY", "device")
        .when(kind == "PROMO", "accessories")
        .when(kind == "LARGE", "spare_parts")
        .otherwise("consumable")
    )
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        category.alias("category"),
        F.when(category == "consumable", F.col("p_size").cast("decimal(18,4)")).alias(
            "unit_size"
        ),
    )


def raw_opt_flag(shift: int) -> Column:
    return ((F.col("c_custkey") + shift) % 3).cast("int")


def customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    flags = {"opt_email": 0, "opt_sms": 1, "opt_phone": 2}
    return customer.join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_group"),
        F.col("n_name").alias("city"),
        F.lit(None).cast("date").alias("created_date"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("mobile_number"),
        *[
            F.when(raw_opt_flag(shift) != 2, raw_opt_flag(shift)).alias(name)
            for name, shift in flags.items()
        ],
    )


def locations(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(
        nation, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("location"),
        F.col("n_name").alias("city"),
    )


class Tables:
    """The canonical tables of a directory, opened when first used."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark, self.directory = spark, directory

    def read(self, name: str) -> DataFrame:
        return read(self.spark, self.directory, name)

    @cached_property
    def sales(self) -> DataFrame:
        return sales(by_order(self.read("lineitem")), self.read("orders"))

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self.read("customer"), self.read("nation"))

    @cached_property
    def products(self) -> DataFrame:
        return products(self.read("part"))

    @cached_property
    def locations(self) -> DataFrame:
        return locations(self.read("supplier"), self.read("nation"))


def load(spark: SparkSession, directory: str) -> Tables:
    return Tables(spark, directory)
