"""Filters that a report user sets: facets, searches, extracts."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_of(column: str, chosen: Collection) -> Column:
    """True for chosen values; an empty choice accepts all, NULL matches none."""
    if not chosen:
        return F.lit(True)
    return F.coalesce(F.col(column).isin(*chosen), F.lit(False))


def contains_text(text: str, *columns: str) -> Column:
    """Case-insensitive search in the columns joined without a separator."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.lower(F.concat(*parts)).contains(text.lower())


def facet_filter(
    df: DataFrame,
    activity: Collection[str] = (),
    tier: Collection[str] = (),
    event: Collection[str] = (),
    group: Collection[str] = (),
) -> DataFrame:
    return df.where(
        one_of("activity_status", activity)
        & one_of("value_tier", tier)
        & one_of("lifecycle_event", event)
        & one_of("customer_group", group)
    )


def extract(
    df: DataFrame,
    sales: DataFrame | None = None,
    stores: Collection[int] = (),
    cities: Collection[str] = (),
    opt_in: Collection[str] = (),
    **facets: Collection[str],
) -> DataFrame:
    """Facets plus city, opt-in flags that must be 1, and stores bought at."""
    chosen = facet_filter(df, **facets).where(one_of("city", cities))
    for flag in opt_in:
        chosen = chosen.where(F.col(flag) == 1)
    if stores:
        visitors = (
            sales.where(F.col("store_id").isin(*stores) & (F.col("quantity") > 0))
            .select("customer_id")
            .distinct()
        )
        chosen = chosen.join(visitors, "customer_id", "left_semi")
    return chosen


def client_filter(
    clients: DataFrame,
    tier: str | None = None,
    active: bool | None = None,
    kind: str | None = None,
    location: int | None = None,
    search: str = "",
    active_days: int = 180,
) -> DataFrame:
    """Spend-model client list; the search looks at name and id separately."""
    if tier is not None:
        clients = clients.where(F.col("tier") == tier)
    if active is not None:
        recent = F.col("last_days") <= active_days
        clients = clients.where(recent if active else ~recent)
    if kind is not None:
        clients = clients.where(F.col("client_type") == kind)
    if location is not None:
        clients = clients.where(F.col("home_store") == location)
    if search:
        clients = clients.where(
            contains_text(search, "customer_name") | contains_text(search, "customer_id")
        )
    return clients


def audit_filter(log: DataFrame, user: int | str | None = None, search: str = "") -> DataFrame:
    if user is not None:
        log = log.where(F.col("user_id") == user)
    if search:
        log = log.where(contains_text(search, "action", "target", "detail"))
    return log


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, as offered for choice."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
