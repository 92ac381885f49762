"""Report surface over the snapshot: one grouped pass for all months."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.calendar import month_end, month_no
from ledgerline.functions.rules import rank_of
from ledgerline.operators.facets import one_of
from ledgerline.operators.shape import label_counts, share_of_total
from ledgerline.params import EVENTS, NO_LABEL, STATUSES, VALUE_TIERS

MONTH = "report_mth_eom"
TIER_MEANS = {
    "amc": "avg_monthly_consumption",
    "aos": "avg_order_size",
    "o6": "o6",
    "tenure": "tenure_months",
}


def month_slice(snapshot: DataFrame, month: date) -> DataFrame:
    """One report month; on the stored snapshot this prunes partitions."""
    return snapshot.where(F.col(MONTH) == F.lit(month))


def is_tiered() -> Column:
    return (F.col("activity_status") == "Active") & F.col("value_tier").isNotNull()


def active_tiered(snapshot: DataFrame) -> DataFrame:
    return snapshot.where(is_tiered())


def report_month_list(snapshot: DataFrame) -> DataFrame:
    """Months present, oldest first, the newest marked as the default view."""
    months = snapshot.select(MONTH).distinct()
    newest = F.max(MONTH).over(Window.partitionBy())
    return months.withColumn("is_latest", F.col(MONTH) == newest).orderBy(MONTH)


def tier_mix(snapshot: DataFrame) -> DataFrame:
    tier = F.when(is_tiered(), F.col("value_tier"))
    return label_counts(
        snapshot.withColumn("value_tier", tier), [MONTH], "value_tier", VALUE_TIERS
    )


def event_counts(snapshot: DataFrame) -> DataFrame:
    return label_counts(snapshot, [MONTH], "lifecycle_event", EVENTS)


def activity_counts(snapshot: DataFrame) -> DataFrame:
    return label_counts(snapshot, [MONTH], "activity_status", STATUSES)


def kpi_by_tier(snapshot: DataFrame) -> DataFrame:
    return (
        active_tiered(snapshot)
        .groupBy(MONTH, "value_tier")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(source).alias(f"avg_{name}") for name, source in TIER_MEANS.items()],
        )
    )


def avg_tenure(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy(MONTH).agg(F.avg("tenure_months").alias("avg_tenure_months"))


def column_name(label: str) -> str:
    return label.lower().replace(" ", "_")


def monthly_report(snapshot: DataFrame) -> DataFrame:
    """All monthly figures as one flat row per month, from a single scan."""
    tiered, status = is_tiered(), F.col("activity_status")
    tier, event = F.col("value_tier"), F.col("lifecycle_event")
    means = [
        F.avg(F.when(tiered & (tier == t), F.col(source))).alias(f"{name}_{column_name(t)}")
        for t in VALUE_TIERS
        for name, source in TIER_MEANS.items()
    ]
    return snapshot.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("total_customers"),
        *[F.count_if(status == s).alias(column_name(s)) for s in STATUSES],
        *[F.count_if(event == e).alias(column_name(e)) for e in EVENTS],
        *[F.count_if(tiered & (tier == t)).alias(f"n_{column_name(t)}") for t in VALUE_TIERS],
        *means,
        F.avg("tenure_months").alias("avg_tenure_months"),
    )


def published(mean: str) -> Column:
    """One decimal. The last bits of a mean hang on the order of its sum, so they go
    first, lest a value halfway falls to either side."""
    return F.round(F.round(mean, 6), 1)


def nested_report(flat: DataFrame) -> DataFrame:
    """The flat monthly report as count maps and a map of tier figures.

    Means are rounded to one decimal, as published. A tier nobody holds that
    month has a zero count and no entry among the tier figures.
    """

    def counts(labels: tuple[str, ...], prefix: str = "") -> Column:
        return F.create_map(
            *[x for name in labels for x in (F.lit(name), F.col(prefix + column_name(name)))]
        )

    def figures(tier: str) -> Column:
        name = column_name(tier)
        return F.struct(
            F.col(f"n_{name}").alias("n"),
            *[published(f"{mean}_{name}").alias(mean) for mean in TIER_MEANS],
        )

    entries = F.array(
        *[F.struct(F.lit(t).alias("key"), figures(t).alias("value")) for t in VALUE_TIERS]
    )
    held = F.filter(entries, lambda e: e["value"]["n"] > 0)
    return flat.select(
        F.col(MONTH).alias("month"),
        "total_customers",
        counts(VALUE_TIERS, "n_").alias("tier_mix"),
        counts(EVENTS).alias("events"),
        counts(STATUSES).alias("activity"),
        F.map_from_entries(held).alias("kpi_by_tier"),
        published("avg_tenure_months").alias("avg_tenure_months"),
    )


def overview_kpis(flat: DataFrame) -> DataFrame:
    total = F.col("total_customers")
    return flat.select(
        MONTH,
        "total_customers",
        F.col("active").alias("active_customers"),
        F.when(total > 0, F.col("active") / total * 100).alias("active_pct"),
        sum((F.col(column_name(e)) for e in EVENTS), F.lit(0)).cast("long").alias("events"),
        "avg_tenure_months",
    )


def tier_distribution(snapshot: DataFrame) -> DataFrame:
    """Active customers by tier in rank order, with their share."""
    counted = (
        snapshot.where(F.col("activity_status") == "Active")
        .groupBy(F.coalesce("value_tier", F.lit(NO_LABEL)).alias("value_tier"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return share_of_total(counted, "n", "pct_of_active").orderBy(
        rank_of(F.col("value_tier"), VALUE_TIERS)
    )


def event_distribution(snapshot: DataFrame) -> DataFrame:
    return (
        snapshot.groupBy(F.coalesce("lifecycle_event", F.lit(NO_LABEL)).alias("lifecycle_event"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "lifecycle_event")
    )


def verify_kpis(snapshot: DataFrame) -> DataFrame:
    """Mean figures per tier in rank order, whatever the status column says."""
    return (
        snapshot.where(F.col("value_tier").isNotNull())
        .groupBy("value_tier")
        .agg(
            *[F.avg(source).alias(f"avg_{name}") for name, source in TIER_MEANS.items()],
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy(rank_of(F.col("value_tier"), VALUE_TIERS))
    )


def customer_rows(snapshot: DataFrame, customers: DataFrame) -> DataFrame:
    return snapshot.join(customers, "customer_id")


def list_columns() -> list[Column]:
    c = F.col
    return [
        c("customer_id"),
        c("customer_name").alias("name"),
        c("customer_group").alias("group"),
        c("city"),
        c("activity_status").alias("activity"),
        c("value_tier").alias("tier"),
        c("lifecycle_event").alias("event"),
        c("tenure_months"),
        c("avg_monthly_consumption").alias("amc"),
        c("avg_order_size").alias("aos"),
        c("o6"),
        c("first_consumable_purchase_date").alias("first_purchase"),
        c("last_consumable_purchase_date").alias("last_purchase"),
    ]


def list_order() -> list[Column]:
    return [F.desc_nulls_last("amc"), F.asc("customer_id")]


def customer_list(snapshot: DataFrame, customers: DataFrame, month: date) -> DataFrame:
    """The month's customers by consumption, highest first."""
    return (
        customer_rows(month_slice(snapshot, month), customers)
        .select(*list_columns())
        .orderBy(*list_order())
    )


def product_lines(sales: DataFrame, products: DataFrame) -> DataFrame:
    return sales.where(F.col("quantity") > 0).join(products, "product_id")


def of_month(lines: DataFrame, month: date | None) -> DataFrame:
    if month is None:
        return lines
    return lines.where(
        (F.col("invoice_date") <= F.lit(month))
        & (F.col("invoice_date") >= F.trunc(F.lit(month), "MM"))
    )


def brand_units(
    sales: DataFrame, products: DataFrame, month: date | None = None
) -> DataFrame:
    """Consumable volume per brand, over all time and all customers."""
    volume = F.col("quantity") * F.coalesce(F.col("unit_size"), F.lit(1))
    return (
        product_lines(of_month(sales, month), products.where(one_of("category", ["consumable"])))
        .groupBy("brand")
        .agg(F.round(F.sum(volume), 0).cast("long").alias("units"))
        .orderBy(F.desc("units"), "brand")
    )


def category_lines(
    sales: DataFrame, products: DataFrame, month: date | None = None
) -> DataFrame:
    return (
        product_lines(of_month(sales, month), products)
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )


def tier_change(snapshot: DataFrame) -> DataFrame:
    """Customers whose tier differs from the report month before.

    The frame per customer holds one row per report month. A customer's first
    month in the relation has nothing to compare with and is left out.
    """
    by_month = Window.partitionBy("customer_id").orderBy(MONTH)
    before = snapshot.select(
        MONTH,
        "customer_id",
        "value_tier",
        F.lag("value_tier").over(by_month).alias("prev_tier"),
        F.lag(MONTH).over(by_month).alias("prev_month"),
        F.col("activity_status"),
        F.lag("activity_status").over(by_month).alias("prev_status"),
    )
    follows = month_end(month_no(F.col("prev_month")) + 1) == F.col(MONTH)
    return before.where(follows & ~F.col("value_tier").eqNullSafe(F.col("prev_tier"))).select(
        MONTH, "customer_id", "prev_tier", "value_tier", "prev_status", "activity_status"
    )
