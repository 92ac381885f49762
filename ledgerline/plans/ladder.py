"""Spend ladder: client figures, tiers, series, locations and movements.

An order is a distinct (customer, invoice) pair, since invoice ids alone are
not unique. Distinct counts are taken by grouping down one column at a time:
every step combines before it shuffles and none gathers a busy customer, store
or month in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.functions.calendar import month_no, month_start
from ledgerline.operators.shape import (
    dense_counts,
    most_common,
    newest,
    share_of_total,
    spine,
)
from ledgerline.params import SPEND_TIERS, LadderParams

# Window lengths, the recency of clients without purchases,
# recency and frequency buckets, and the top of the ladder.
YEAR = 365
NEVER = 9999
MONTH_DAYS = 30.44
CHURN_MONTHS = 3
RECENCY = (0, 1, 2, 3)
TOP_TIERS = SPEND_TIERS[:3]


def known_sales(sales: DataFrame, p: LadderParams) -> DataFrame:
    return sales.where(F.col("invoice_date") <= F.lit(p.as_of))


def within(newest_age: int, oldest_age: int, as_of: date) -> Column:
    """Dates in the half-open day window (as_of - oldest, as_of - newest]."""
    day = F.col("invoice_date")
    return (day > F.lit(as_of - timedelta(days=oldest_age))) & (
        day <= F.lit(as_of - timedelta(days=newest_age))
    )


def this_year(p: LadderParams) -> Column:
    return within(0, YEAR, p.as_of)


def prior_year(p: LadderParams) -> Column:
    return within(YEAR, 2 * YEAR, p.as_of)


def or_zero(column: str | Column) -> Column:
    return F.coalesce(column, F.lit(0))


# -- client figures -----------------------------------------------------------


def client_stats(sales: DataFrame, customers: DataFrame, p: LadderParams) -> DataFrame:
    """Trailing-year figures and tiers for every client in the master."""
    revenue = F.col("revenue")
    in_last_month = month_no(F.col("invoice_date")) == p.last_full_month
    per_order = (
        known_sales(sales, p)
        .groupBy("customer_id", "invoice_id")
        .agg(
            F.sum(F.when(this_year(p), revenue)).alias("spend"),
            F.sum(F.when(prior_year(p), revenue)).alias("spend_prev"),
            F.sum(F.when(in_last_month, revenue)).alias("spend_month"),
            F.bool_or(this_year(p)).alias("this_year"),
            F.min("invoice_date").alias("first_date"),
            F.max("invoice_date").alias("last_date"),
        )
    )
    per_client = per_order.groupBy("customer_id").agg(
        F.sum("spend").alias("spend"),
        F.sum("spend_prev").alias("spend_prev"),
        F.sum("spend_month").alias("spend_month"),
        F.count_if("this_year").alias("orders12m"),
        F.count(F.lit(1)).alias("orders_all"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )
    c = F.col
    joined = (
        customers.select("customer_id")
        .join(per_client, "customer_id", "left")
        .select(
            "customer_id",
            or_zero("spend").alias("spend"),
            or_zero("spend_month").alias("spend_last_month"),
            rules.round_half_up(or_zero("spend")).alias("spend12m"),
            rules.round_half_up(or_zero("spend_prev")).alias("spend_prev12m"),
            or_zero("orders12m").alias("orders12m"),
            or_zero("orders_all").alias("orders_all"),
            F.coalesce(F.datediff(F.lit(p.as_of), "last_date"), F.lit(NEVER)).alias("last_days"),
            "first_date",
            "last_date",
            F.year("first_date").alias("since_year"),
        )
    )
    return joined.withColumns(
        {
            "avg_order": F.when(
                c("orders12m") > 0,
                rules.round_double(c("spend").cast("double") / c("orders12m")),
            ).otherwise(F.lit(0).cast("long")),
            "points": rules.loyalty_points(c("spend12m")),
            "tier": rules.spend_tier(c("spend12m"), p.tiers),
            "prev_tier": rules.spend_tier(c("spend_prev12m"), p.tiers),
        }
    ).drop("spend")


def monthly_vector(sales: DataFrame, customers: DataFrame, p: LadderParams) -> DataFrame:
    """Twelve rounded amounts per client, oldest first, as an array column."""
    age = F.datediff(F.lit(p.as_of), F.col("invoice_date"))
    slot = 11 - F.floor(age / MONTH_DAYS)
    sums = (
        known_sales(sales, p)
        .where(this_year(p))
        .groupBy("customer_id")
        .agg(*[F.sum(F.when(slot == i, F.col("revenue"))).alias(f"b{i}") for i in range(12)])
    )
    cells = [rules.round_half_up(or_zero(f"b{i}")) for i in range(12)]
    return (
        customers.select("customer_id")
        .join(sums, "customer_id", "left")
        .select("customer_id", F.array(*cells).alias("monthly"))
    )


def spend_at(sales: DataFrame, customers: DataFrame, days: Sequence[date], p: LadderParams) -> DataFrame:
    """Rounded spend, tier and last purchase on several days, in one pass."""
    day, revenue = F.col("invoice_date"), F.col("revenue")
    aggregates = []
    for i, as_of in enumerate(days):
        aggregates += [
            F.sum(F.when(within(0, YEAR, as_of), revenue)).alias(f"s{i}"),
            F.max(F.when(day <= F.lit(as_of), day)).alias(f"last_{i}"),
        ]
    sums = sales.where(day <= F.lit(max(days))).groupBy("customer_id").agg(*aggregates)
    columns = ["customer_id"]
    for i, as_of in enumerate(days):
        rounded = rules.round_half_up(or_zero(f"s{i}"))
        columns += [
            rounded.alias(f"spend_{i}"),
            rules.spend_tier(rounded, p.tiers).alias(f"tier_{i}"),
            F.coalesce(F.datediff(F.lit(as_of), f"last_{i}"), F.lit(NEVER)).alias(f"last_days_{i}"),
        ]
    return customers.select("customer_id").join(sums, "customer_id", "left").select(*columns)


def recency_labels(stats: DataFrame) -> DataFrame:
    days = F.col("last_days")
    return stats.select(
        "customer_id",
        "last_days",
        rules.recency_label(days).alias("label"),
        rules.recency_severity(days).alias("severity"),
    )


def inactive_clients(stats: DataFrame, days: int) -> DataFrame:
    return stats.where(F.col("last_days") > days)


def status_counts(stats: DataFrame, days: int) -> DataFrame:
    recent = rules.is_recent(F.col("last_days"), days)
    return stats.agg(
        F.count_if(recent).alias("active"), F.count_if(~recent).alias("inactive")
    )


def home_location(sales: DataFrame, p: LadderParams) -> DataFrame:
    """The store with most of a client's orders."""
    return most_common(
        known_sales(sales, p), "customer_id", "store_id", "invoice_id"
    ).select("customer_id", F.col("store_id").alias("home_store"), F.col("n").alias("orders"))


def favourite_product(sales: DataFrame, p: LadderParams) -> DataFrame:
    """The product in most of a client's orders; returns do not count."""
    bought = known_sales(sales, p).where(F.col("quantity") > 0)
    return most_common(bought, "customer_id", "product_id", "invoice_id").select(
        "customer_id", "product_id", F.col("n").alias("orders")
    )


def client_directory(
    sales: DataFrame, customers: DataFrame, p: LadderParams
) -> DataFrame:
    """Client figures with name, type and home location, for list screens."""
    names = customers.select(
        "customer_id", "customer_name", F.col("customer_group").alias("client_type")
    )
    return (
        client_stats(sales, customers, p)
        .join(names, "customer_id")
        .join(home_location(sales, p).drop("orders"), "customer_id", "left")
    )


def top_clients(stats: DataFrame, count: int = 6) -> DataFrame:
    return stats.orderBy(F.desc("spend12m"), "customer_id").limit(count)


def recent_moves(stats: DataFrame, count: int = 6) -> DataFrame:
    return top_clients(stats.where(F.col("tier") != F.col("prev_tier")), count)


def recent_orders(
    sales: DataFrame, products: DataFrame, locations: DataFrame, p: LadderParams, count: int = 8
) -> DataFrame:
    """Each client's newest orders, with store and product of the largest line."""
    largest = F.struct("revenue", "store_id", "product_id")
    orders = (
        known_sales(sales, p)
        .groupBy("customer_id", "invoice_id")
        .agg(
            F.max("invoice_date").alias("order_date"),
            F.sum("revenue").alias("amount"),
            F.max(largest).alias("largest"),
        )
    )
    order = [F.desc("order_date"), F.desc("invoice_id")]
    return (
        newest(orders, "customer_id", order, count)
        .select(
            "customer_id",
            "place",
            "invoice_id",
            "order_date",
            F.datediff(F.lit(p.as_of), "order_date").alias("days_ago"),
            rules.round_half_up(F.col("amount")).alias("amount"),
            "largest.store_id",
            "largest.product_id",
        )
        .join(locations.select("store_id", "location"), "store_id", "left")
        .join(products.select("product_id", "product_name"), "product_id", "left")
    )


# -- monthly series -----------------------------------------------------------


def series_spine(df: DataFrame, p: LadderParams) -> DataFrame:
    last = p.last_full_month
    return spine(df, {"month": range(last - p.series_months + 1, last + 1)})


def monthly_series(sales: DataFrame, p: LadderParams) -> DataFrame:
    """Revenue, orders and buying clients of the complete months."""
    last = p.last_full_month
    month = month_no(F.col("invoice_date"))
    per_order = (
        known_sales(sales, p)
        .where(month.between(last - p.series_months + 1, last))
        .groupBy(month.alias("month"), "customer_id", "invoice_id")
        .agg(F.sum("revenue").alias("revenue"))
    )
    per_client = per_order.groupBy("month", "customer_id").agg(
        F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
    per_month = per_client.groupBy("month").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("orders").alias("orders"),
        F.count(F.lit(1)).alias("active"),
    )
    revenue = or_zero("revenue")
    return (
        series_spine(sales, p)
        .join(per_month, "month", "left")
        .select(
            month_start(F.col("month")).alias("month"),
            revenue.cast("double").alias("revenue"),
            rules.round_half_up(revenue / 1000).alias("revenue_k"),
            or_zero("orders").alias("orders"),
            or_zero("active").alias("active"),
            F.when(F.col("orders") > 0, revenue.cast("double") / F.col("orders")).alias("basket"),
        )
    )


def base_flow(stats: DataFrame, p: LadderParams) -> DataFrame:
    """New and churned clients per complete month, from first and last purchase."""

    def event(day: str, shift: int, new: int) -> Column:
        return F.struct(
            (month_no(F.col(day)) + shift).alias("month"),
            F.lit(new).alias("new"),
            F.lit(1 - new).alias("churned"),
        )

    events = F.array(event("first_date", 0, 1), event("last_date", CHURN_MONTHS, 0))
    flow = (
        stats.select(F.inline(events))
        .groupBy("month")
        .agg(F.sum("new").alias("new"), F.sum("churned").alias("churned"))
    )
    return (
        series_spine(stats, p)
        .join(flow, "month", "left")
        .select(
            month_start(F.col("month")).alias("month"),
            or_zero("new").alias("new_clients"),
            or_zero("churned").alias("churned_clients"),
            (or_zero("new") - or_zero("churned")).alias("net_growth"),
        )
    )


def mom_delta(series: DataFrame, flow: DataFrame) -> DataFrame:
    """Percent change on the month before; one row per month of the series."""
    by_month = Window.partitionBy().orderBy("month")
    measures = ["revenue", "active", "new_clients", "basket"]
    return series.join(flow, "month").select(
        "month",
        *[
            rules.pct_change(F.col(m), F.lag(m).over(by_month)).alias(f"{m}_pct")
            for m in measures
        ],
    )


# -- locations ----------------------------------------------------------------


def location_stats(sales: DataFrame, locations: DataFrame, p: LadderParams) -> DataFrame:
    """Trailing-year figures per location, growth and retention on the year before."""
    now, before = this_year(p), prior_year(p)
    revenue = F.col("revenue")
    per_order = (
        sales.where(now | before)
        .groupBy("store_id", "customer_id", "invoice_id")
        .agg(
            F.sum(F.when(now, revenue)).alias("now"),
            F.sum(F.when(before, revenue)).alias("before"),
            F.bool_or(now).alias("in_now"),
            F.bool_or(before).alias("in_before"),
        )
    )
    per_client = per_order.groupBy("store_id", "customer_id").agg(
        F.sum("now").alias("now"),
        F.sum("before").alias("before"),
        F.count_if("in_now").alias("orders"),
        F.bool_or("in_now").alias("in_now"),
        F.bool_or("in_before").alias("in_before"),
    )
    returned = F.col("in_now") & F.col("in_before")
    per_store = per_client.groupBy("store_id").agg(
        F.sum("now").alias("now"),
        F.sum("before").alias("before"),
        F.sum("orders").alias("orders"),
        F.count_if("in_now").alias("clients"),
        F.count_if("in_before").alias("clients_before"),
        F.count_if(returned).alias("returned"),
    )
    c = F.col
    return (
        locations.join(per_store, "store_id", "left")
        .select(
            "store_id",
            "location",
            "city",
            or_zero("now").alias("now"),
            or_zero("before").alias("before"),
            or_zero("orders").alias("orders"),
            or_zero("clients").alias("clients"),
            "clients_before",
            "returned",
        )
        .select(
            "store_id",
            "location",
            "city",
            c("now").cast("double").alias("revenue"),
            rules.round_half_up(c("now") / 1000).alias("revenue_k"),
            c("before").cast("double").alias("revenue_before"),
            "orders",
            "clients",
            F.when(c("orders") > 0, rules.round_double(c("now").cast("double") / c("orders")))
            .otherwise(F.lit(0).cast("long"))
            .alias("avg_basket"),
            rules.pct_change(c("now"), c("before")).alias("growth_pct"),
            F.when(c("clients_before") > 0, c("returned") / c("clients_before") * 100).alias(
                "retention_pct"
            ),
        )
    )


def city_rollup(location_figures: DataFrame) -> DataFrame:
    return location_figures.groupBy("city").agg(
        F.count(F.lit(1)).alias("n_locations"), F.sum("revenue_k").alias("revenue_k")
    )


def city_location_rollup(location_figures: DataFrame) -> DataFrame:
    """City totals and their locations in one relation; NULL location = total."""
    return (
        location_figures.withColumnRenamed("location", "place")
        .rollup("city", "place")
        .agg(F.sum("revenue_k").alias("revenue_k"), F.grouping_id().alias("level"))
        .select("city", F.col("place").alias("location"), "revenue_k", "level")
    )


# -- movements and shares -----------------------------------------------------


def matrix(pairs: DataFrame, before: str, after: str) -> DataFrame:
    """Clients by tier then and now, over the full grid of tiers."""
    moved = pairs.select(F.col(before).alias("from_tier"), F.col(after).alias("to_tier"))
    return dense_counts(moved, {"from_tier": SPEND_TIERS, "to_tier": SPEND_TIERS})


def transition_matrix(stats: DataFrame) -> DataFrame:
    return matrix(stats, "prev_tier", "tier")


def direction(before: str, after: str) -> Column:
    then = rules.rank_of(F.col(before), SPEND_TIERS)
    now = rules.rank_of(F.col(after), SPEND_TIERS)
    return F.when(now < then, "up").when(now > then, "down")


def movement_totals(pairs: DataFrame, before: str = "prev_tier", after: str = "tier") -> DataFrame:
    moved = direction(before, after)
    return pairs.agg(
        F.count(F.lit(1)).alias("clients"),
        F.count_if(moved == "up").alias("moved_up"),
        F.count_if(moved == "down").alias("moved_down"),
    ).select(
        "clients",
        (F.col("moved_up") + F.col("moved_down")).alias("retiered"),
        "moved_up",
        "moved_down",
        (F.col("moved_up") - F.col("moved_down")).alias("net"),
    )


def top_moves(grid: DataFrame, count: int = 5) -> DataFrame:
    """The most frequent upgrades and downgrades of a transition matrix."""
    moves = grid.withColumn("direction", direction("from_tier", "to_tier")).where(
        F.col("direction").isNotNull() & (F.col("n") > 0)
    )
    return newest(
        moves, "direction", [F.desc("n"), F.asc("from_tier"), F.asc("to_tier")], count
    )


def headline_kpis(stats: DataFrame, p: LadderParams) -> DataFrame:
    c = F.col
    return stats.agg(
        F.count(F.lit(1)).alias("clients"),
        F.sum("orders_all").alias("transactions"),
        F.sum("spend12m").alias("revenue12m"),
        F.sum("orders12m").alias("orders12m"),
        F.count_if(rules.is_recent(c("last_days"), p.active_days)).alias("active_now"),
        F.sum("spend_last_month").cast("double").alias("revenue_last_month"),
    ).withColumn(
        "avg_basket",
        F.when(c("orders12m") > 0, rules.round_double(c("revenue12m") / c("orders12m"))).otherwise(
            F.lit(0).cast("long")
        ),
    )


def segment_share(stats: DataFrame) -> DataFrame:
    counted = stats.groupBy("tier").agg(
        F.count(F.lit(1)).alias("clients"), F.sum("spend12m").alias("spend12m")
    )
    full = (
        spine(stats, {"tier": SPEND_TIERS})
        .join(counted, "tier", "left")
        .select("tier", or_zero("clients").alias("clients"), or_zero("spend12m").alias("spend12m"))
    )
    return share_of_total(full, "spend12m", "pct_of_revenue")


def top_tier_concentration(stats: DataFrame) -> DataFrame:
    top = F.col("tier").isin(*TOP_TIERS)
    spend = F.sum("spend12m")
    return stats.agg(
        F.count_if(top).alias("top_clients"),
        F.sum(F.when(top, F.col("spend12m")).otherwise(0)).alias("top_spend"),
        spend.alias("spend"),
    ).select(
        "top_clients",
        F.when(F.col("spend") != 0, F.col("top_spend") / F.col("spend") * 100).alias(
            "top_pct_of_revenue"
        ),
    )


def rfm_grid(stats: DataFrame) -> DataFrame:
    buckets = stats.select(
        rules.frequency_bucket(F.col("orders12m")).alias("frequency_bucket"),
        rules.recency_bucket(F.col("last_days")).alias("recency_bucket"),
    )
    return dense_counts(buckets, {"frequency_bucket": RECENCY, "recency_bucket": RECENCY})


def going_cold(stats: DataFrame) -> DataFrame:
    return stats.where(rules.going_cold(F.col("last_days"), F.col("orders12m")))
