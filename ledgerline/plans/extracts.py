"""Named report extracts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.functions.calendar import month_no, month_start
from ledgerline.operators.shape import spine
from ledgerline.params import LadderParams
from ledgerline.plans import ladder
from ledgerline.plans.monthly import customer_rows, month_slice

# Opt-in channels and the lower bounds of the tenure bands.
CHANNELS = ("opt_email", "opt_sms", "opt_phone")
TENURE_BANDS = ((37, "37+"), (25, "25-36"), (13, "13-24"), (7, "07-12"), (1, "01-06"))


def full_client_base(snapshot: DataFrame, customers: DataFrame, month: date) -> DataFrame:
    """All clients of a month with category, status, contact and consent."""
    return customer_rows(month_slice(snapshot, month), customers).select(
        "report_mth_eom",
        "customer_id",
        "customer_name",
        "customer_group",
        "city",
        "created_date",
        "activity_status",
        "value_tier",
        "lifecycle_event",
        "tenure_months",
        "first_consumable_purchase_date",
        "last_consumable_purchase_date",
        "email",
        "mobile_number",
        *CHANNELS,
    )


def inactive_top_tiers(stats: DataFrame, days: int) -> DataFrame:
    top = F.col("tier").isin(*ladder.TOP_TIERS)
    return ladder.inactive_clients(stats, days).where(top)


def consent_register(customers: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """One row per client and channel; an unset flag is reported as unknown.

    ``log`` holds customer_id, channel, opted, changed_at and source. Its
    newest entry per client and channel wins over the master's flag.
    """
    flags = customers.unpivot(["customer_id"], [*CHANNELS], "channel", "opted")
    if log is None:
        changed = flags.withColumns(
            {"changed_at": F.lit(None).cast("timestamp"), "source": F.lit(None).cast("string")}
        )
    else:
        entry = F.struct("opted", "changed_at", "source")
        latest = log.groupBy("customer_id", "channel").agg(
            F.max_by(entry, F.struct("changed_at", "source", "opted")).alias("entry")
        )
        changed = flags.join(latest, ["customer_id", "channel"], "left").select(
            "customer_id",
            "channel",
            F.when(F.col("entry").isNotNull(), F.col("entry.opted"))
            .otherwise(F.col("opted"))
            .alias("opted"),
            F.col("entry.changed_at").alias("changed_at"),
            F.col("entry.source").alias("source"),
        )
    state = F.when(F.col("opted") == 1, "in").when(F.col("opted") == 0, "out")
    return changed.select(
        "customer_id",
        "channel",
        F.coalesce(state, F.lit("unknown")).alias("consent"),
        "changed_at",
        "source",
    )


def new_client_cohort(sales: DataFrame, p: LadderParams) -> DataFrame:
    """First-purchase months, and how many of each buy again months later.

    Customer months are made distinct first, so the frame that finds a
    customer's first month holds at most one row per calendar month.
    """
    bought = ladder.known_sales(sales, p).where(F.col("quantity") > 0)
    months = bought.select("customer_id", month_no(F.col("invoice_date")).alias("month")).distinct()
    first = F.min("month").over(Window.partitionBy("customer_id"))
    curve = (
        months.withColumn("cohort", first)
        .groupBy("cohort", (F.col("month") - F.col("cohort")).alias("months_since"))
        .agg(F.count(F.lit(1)).alias("buyers"))
    )
    size = F.max("buyers").over(Window.partitionBy("cohort"))
    return curve.select(
        month_start(F.col("cohort")).alias("cohort_month"),
        "months_since",
        "buyers",
        size.alias("cohort_size"),
        (F.col("buyers") / size * 100).alias("pct_of_cohort"),
    )


def cohort_repeat(sales: DataFrame, p: LadderParams) -> DataFrame:
    """Per cohort: clients, those with a second order, and their share."""
    orders = (
        ladder.known_sales(sales, p)
        .where(F.col("quantity") > 0)
        .groupBy("customer_id", "invoice_id")
        .agg(F.min("invoice_date").alias("order_date"))
    )
    clients = orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_date"), F.count(F.lit(1)).alias("orders")
    )
    return (
        clients.groupBy(F.trunc("first_date", "MM").alias("cohort_month"))
        .agg(
            F.count(F.lit(1)).alias("clients"),
            F.count_if(F.col("orders") > 1).alias("repeat_clients"),
            F.sum("orders").alias("orders"),
        )
        .withColumn("repeat_pct", F.col("repeat_clients") / F.col("clients") * 100)
    )


def movement_summary(
    sales: DataFrame, customers: DataFrame, start: date, end: date, p: LadderParams
) -> DataFrame:
    """Transition matrix between two as-of days; both tiers from one pass."""
    return ladder.matrix(
        ladder.spend_at(sales, customers, [start, end], p), "tier_0", "tier_1"
    )


def movement_top_moves(
    sales: DataFrame, customers: DataFrame, start: date, end: date, p: LadderParams
) -> DataFrame:
    """The biggest moves either way between the two days, for the same report."""
    return ladder.top_moves(movement_summary(sales, customers, start, end, p))


def retier_summary(
    sales: DataFrame, customers: DataFrame, start: date, end: date, p: LadderParams
) -> DataFrame:
    pairs = ladder.spend_at(sales, customers, [start, end], p)
    return ladder.movement_totals(pairs, "tier_0", "tier_1")


def inactivity_sweep(
    sales: DataFrame, customers: DataFrame, start: date, end: date, p: LadderParams
) -> DataFrame:
    """Clients who were recent on ``start`` and no longer are on ``end``."""
    pairs = ladder.spend_at(sales, customers, [start, end], p)
    crossed = rules.is_recent(F.col("last_days_0"), p.active_days) & ~rules.is_recent(
        F.col("last_days_1"), p.active_days
    )
    return pairs.where(crossed).select(
        "customer_id", F.col("tier_1").alias("tier"), F.col("last_days_1").alias("last_days")
    )


def turning_inactive(stats: DataFrame, p: LadderParams, days: int) -> DataFrame:
    """Clients by the day they passed the inactivity line, for recent days."""
    turned = F.date_add("last_date", p.active_days + 1)
    return stats.select("customer_id", "tier", turned.alias("turned_on")).where(
        (F.col("turned_on") <= F.lit(p.as_of))
        & (F.col("turned_on") > F.lit(p.as_of - timedelta(days=days)))
    )


def tenure_band(tenure: Column) -> Column:
    rule = F
    for minimum, name in TENURE_BANDS:
        rule = rule.when(tenure >= minimum, name)
    return rule.otherwise("never")


def tenure_cohort(snapshot: DataFrame, month: date) -> DataFrame:
    return (
        month_slice(snapshot, month)
        .groupBy(
            tenure_band(F.col("tenure_months")).alias("tenure_band"),
            F.coalesce("value_tier", F.lit("<none>")).alias("value_tier"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weekly_digest(
    sales: DataFrame, stats: DataFrame, p: LadderParams, weeks: int = 13
) -> DataFrame:
    """Figures of the last complete weeks (Monday to Sunday) and their change."""
    monday = p.as_of - timedelta(days=(p.as_of.weekday() + 1) % 7 + 6)
    starts = [monday - timedelta(weeks=i) for i in range(weeks)]
    week = F.date_trunc("week", F.col("invoice_date")).cast("date")
    per_client = (
        ladder.known_sales(sales, p)
        .where(week.between(F.lit(starts[-1]), F.lit(monday)))
        .groupBy(week.alias("week"), "customer_id", "invoice_id")
        .agg(F.sum("revenue").alias("revenue"))
        .groupBy("week", "customer_id")
        .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )
    per_week = per_client.groupBy("week").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("orders").alias("orders"),
        F.count(F.lit(1)).alias("active"),
    )
    first_week = F.date_trunc("week", F.col("first_date")).cast("date")
    joined = stats.groupBy(first_week.alias("week")).agg(F.count(F.lit(1)).alias("new"))
    zero = ladder.or_zero
    by_week = Window.partitionBy().orderBy("week")
    full = (
        spine(sales, {"week": starts})
        .join(per_week, "week", "left")
        .join(joined, "week", "left")
        .select(
            "week",
            zero("revenue").cast("double").alias("revenue"),
            zero("orders").alias("orders"),
            zero("active").alias("active"),
            zero("new").alias("new_clients"),
        )
    )
    return full.select(
        "*",
        *[
            rules.pct_change(F.col(m), F.lag(m).over(by_week)).alias(f"{m}_pct")
            for m in ("revenue", "active", "new_clients")
        ],
    )
