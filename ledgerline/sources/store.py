"""Stored snapshot, stored report sets, and the shared scratch folder."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.plans import monthly
from ledgerline.schemas import SNAPSHOT

MONTH = "report_mth_eom"
REPORT_SETS = (
    "report_months",
    "latest_month",
    "monthly",
    "customers",
    "brand_units",
    "category_lines",
)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared checkpoint directory, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """Replace the months present in the relation, leave the others.

    Rebalancing gives each month as many tasks as its size needs, so that files
    are neither tiny nor written by one task; rows are sorted within a file.
    """
    (
        snapshot.hint("rebalance", MONTH)
        .sortWithinPartitions(MONTH, "customer_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_snapshot(spark: SparkSession, path: str, month: date | None = None) -> DataFrame:
    rows = spark.read.schema(SNAPSHOT).parquet(path).select(*SNAPSHOT.names)
    return rows if month is None else monthly.month_slice(rows, month)


def report_sets(
    snapshot: DataFrame, sales: DataFrame, products: DataFrame, customers: DataFrame, latest: date
) -> dict[str, DataFrame]:
    """The six result sets of the dashboard, figures rounded as published."""
    months = monthly.report_month_list(snapshot)
    listed = monthly.customer_list(snapshot, customers, latest)
    return {
        "report_months": months.select(MONTH),
        "latest_month": months.where("is_latest").select(MONTH),
        "monthly": monthly.nested_report(monthly.monthly_report(snapshot)),
        "customers": listed.withColumns({c: F.round(c, 1) for c in ("amc", "aos")}),
        "brand_units": monthly.brand_units(sales, products),
        "category_lines": monthly.category_lines(sales, products),
    }


def write_report_json(sets: dict[str, DataFrame], path: str) -> None:
    """One JSON-lines dataset per result set, written by the executors."""
    for name, rows in sets.items():
        rows.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}")


def read_report_json(
    spark: SparkSession, path: str, name: str, schema: T.StructType
) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/{name}")
