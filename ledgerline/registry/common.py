"""Shared pieces of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans import ladder
from ledgerline.plans.snapshot import customer_snapshot
from ledgerline.sources import star

Query = Callable[[SparkSession, str], DataFrame]
LATEST = date(2001, 7, 31)
PARAMS = star.snapshot_params()
LADDER = star.ladder_params()


class Entry(NamedTuple):
    """A registered query, and the SQL that must give the same rows."""

    run: Query
    sql: str | None = None


def tables(spark: SparkSession, directory: str) -> star.Tables:
    return star.load(spark, directory)


def snapshot(spark: SparkSession, directory: str, months: int = 12) -> DataFrame:
    t = tables(spark, directory)
    return customer_snapshot(t.sales, t.products, t.customers, star.snapshot_params(months))


def stats(spark: SparkSession, directory: str) -> DataFrame:
    t = tables(spark, directory)
    return ladder.client_stats(t.sales, t.customers, LADDER)


def on_snapshot(plan: Callable[[DataFrame], DataFrame], months: int = 12) -> Query:
    return lambda spark, directory: plan(snapshot(spark, directory, months))


def on_stats(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, directory: plan(stats(spark, directory))


def on_tables(plan: Callable[[star.Tables], DataFrame]) -> Query:
    return lambda spark, directory: plan(tables(spark, directory))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals, where the order of summing may change the last bits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
