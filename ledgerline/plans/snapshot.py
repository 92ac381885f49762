"""Customer x report month snapshot, all report months in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.functions.calendar import month_end
from ledgerline.operators.lines import (
    consumable_bought,
    invoice_months,
    month_aggregates,
    orders_in_windows,
    positive_lines,
    rolled_up,
    window_orders,
)
from ledgerline.params import WINDOW_MONTHS, SnapshotParams
from ledgerline.schemas import SNAPSHOT

VOLUMES = ("m_total", *[f"m{k}" for k in WINDOW_MONTHS])


def eligible_customers(customers: DataFrame, anonymous_group: str) -> DataFrame:
    """Everyone outside the anonymous group; customers without a group stay."""
    group = F.lower(F.coalesce(F.col("customer_group"), F.lit("")))
    return customers.where(group != anonymous_group.lower()).select("customer_id")


def snapshot_lines(
    sales: DataFrame, products: DataFrame, params: SnapshotParams
) -> DataFrame:
    """Consumable and device lines known by the end of the latest month."""
    known = sales.where(F.col("invoice_date") <= params.latest_eom)
    return positive_lines(known, products, "consumable", "device")


def framed_aggregates(
    rollup: DataFrame, orders: DataFrame, ids: DataFrame, first: int, last: int
) -> DataFrame:
    """Trailing-window aggregates for every id and report month.

    Grid rows, roll-up rows and order counts go through one exchange by
    customer. A window over them holds at most one row per month and input,
    however many sales a customer has. A k-month sum is the running total
    less the running total k months back; with decimals both are exact, and
    each needs one pass over the sorted rows.
    """
    grid = ids.select(
        "customer_id",
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("month"),
        F.lit(True).alias("wanted"),
    )
    rows = grid.unionByName(rollup, allowMissingColumns=True).unionByName(
        orders, allowMissingColumns=True
    )
    by_month = Window.partitionBy("customer_id").orderBy("month")
    to_date = by_month.rangeBetween(Window.unboundedPreceding, 0)
    this_month = by_month.rangeBetween(0, 0)

    def volume_before(k: int) -> Column:
        return F.sum("units").over(by_month.rangeBetween(Window.unboundedPreceding, -k))

    zero = F.lit(0).cast("decimal(38,8)")
    running = rows.select(
        "customer_id",
        "month",
        "wanted",
        F.min("device_date").over(to_date).alias("first_device_purchase_date"),
        F.min("first_date").over(to_date).alias("first_consumable_purchase_date"),
        F.max("last_date").over(to_date).alias("last_consumable_purchase_date"),
        F.coalesce(F.sum("units").over(to_date), zero).alias("m_total"),
        *[
            F.coalesce(volume_before(k), zero).alias(f"before{k}")
            for k in WINDOW_MONTHS
        ],
        F.coalesce(F.sum("o6").over(this_month), F.lit(0)).alias("o6"),
    )
    return running.where("wanted").select(
        month_end(F.col("month")).alias("report_mth_eom"),
        "customer_id",
        "first_device_purchase_date",
        "first_consumable_purchase_date",
        "last_consumable_purchase_date",
        "m_total",
        *[
            (F.col("m_total") - F.col(f"before{k}")).cast("decimal(38,8)").alias(f"m{k}")
            for k in WINDOW_MONTHS
        ],
        "o6",
    )


def classified(aggregates: DataFrame, params: SnapshotParams) -> DataFrame:
    """Ratios, status, tier and event; volumes leave as doubles."""
    c = F.col
    derived = aggregates.withColumns(
        {
            "tenure_months": rules.tenure_months(
                c("report_mth_eom"), c("first_consumable_purchase_date")
            ),
            "avg_monthly_consumption": rules.average_month(c("m6")),
            "avg_order_size": rules.average_order(c("m6"), c("o6")),
            "activity_status": rules.activity_status(c("m12")),
            "value_tier": rules.value_tier(c("m6"), c("m12"), c("o6"), params),
            "lifecycle_event": rules.lifecycle_event(
                c("m1"), c("m12"), c("m13"), c("m_total")
            ),
        }
    )
    return derived.select(*[c(f.name).cast(f.dataType) for f in SNAPSHOT])


def window_aggregates(
    sales: DataFrame, products: DataFrame, ids: DataFrame, params: SnapshotParams
) -> DataFrame:
    first, last = params.first_month, params.last_month
    invoices = invoice_months(snapshot_lines(sales, products, params))
    return framed_aggregates(
        rolled_up(invoices, oldest=first - max(WINDOW_MONTHS)),
        orders_in_windows(invoices, first, last, consumable_bought()),
        ids,
        first,
        last,
    )


def customer_snapshot(
    sales: DataFrame, products: DataFrame, customers: DataFrame, params: SnapshotParams
) -> DataFrame:
    ids = eligible_customers(customers, params.anonymous_group)
    return classified(window_aggregates(sales, products, ids, params), params)


def snapshot_from_rollup(
    rollup: DataFrame, lines: DataFrame, customers: DataFrame, params: SnapshotParams
) -> DataFrame:
    """The same snapshot from a stored roll-up; lines serve the order count."""
    first, last = params.first_month, params.last_month
    ids = eligible_customers(customers, params.anonymous_group)
    known = rollup.where(F.col("month") <= last)
    orders = window_orders(
        lines.where(F.col("invoice_date") <= params.latest_eom), first, last
    )
    return classified(framed_aggregates(known, orders, ids, first, last), params)


def single_month_snapshot(
    sales: DataFrame, products: DataFrame, customers: DataFrame, params: SnapshotParams
) -> DataFrame:
    """The latest month alone, by joins instead of frames."""
    lines = snapshot_lines(sales, products, params)
    consumable = F.col("category") == "consumable"
    device = (
        lines.where(~consumable)
        .groupBy("customer_id")
        .agg(F.min("invoice_date").alias("first_device_purchase_date"))
    )
    zero = F.lit(0).cast("decimal(38,8)")
    aggregates = (
        eligible_customers(customers, params.anonymous_group)
        .join(month_aggregates(lines.where(consumable), params), "customer_id", "left")
        .join(device, "customer_id", "left")
        .withColumns(
            {
                "report_mth_eom": F.lit(params.latest_eom),
                **{v: F.coalesce(F.col(v), zero) for v in VOLUMES},
                "o6": F.coalesce(F.col("o6"), F.lit(0)),
            }
        )
    )
    return classified(aggregates, params)
