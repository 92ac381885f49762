"""Registered queries: rules, snapshot, and the reports built on it."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calendar import last_full_month, report_months, report_windows
from ledgerline.operators import facets, lines, shape
from ledgerline.plans import monthly, snapshot
from ledgerline.registry.common import (
    LATEST,
    PARAMS,
    Entry,
    doubles,
    on_snapshot,
    on_tables,
    rounded,
    tables,
)
from ledgerline.registry.common import snapshot as build_snapshot
from ledgerline.registry.sql import canonical
from ledgerline.registry.sql import on_snapshot as snap_sql
from ledgerline.schemas import SNAPSHOT as SNAPSHOT_SCHEMA
from ledgerline.sources import star
from ledgerline.sources.store import shared_folder

SNAPSHOT_LIST = ", ".join(f.name for f in SNAPSHOT_SCHEMA)
VOLUMES = ("m_total", "m1", "m6", "m12", "m13", "m24", "m25")
MEANS = ("avg_amc", "avg_aos", "avg_o6", "avg_tenure")
AFTER_AMC, AFTER_ID = 200.0, 700


def months_of_data(t: star.Tables) -> DataFrame:
    """Report months up to the last complete month in the sales."""
    newest = t.sales.agg(last_full_month(F.max("invoice_date")).alias("latest"))
    return report_months(newest, 12)


def known(t: star.Tables) -> DataFrame:
    return t.sales.where(F.col("invoice_date") <= F.lit(LATEST))


def base_aggregates(t: star.Tables) -> DataFrame:
    consumed = snapshot.snapshot_lines(t.sales, t.products, PARAMS).where(
        F.col("category") == "consumable"
    )
    return doubles(lines.month_aggregates(consumed, PARAMS), *VOLUMES)


def m_windows(t: star.Tables) -> DataFrame:
    ids = snapshot.eligible_customers(t.customers, PARAMS.anonymous_group)
    framed = snapshot.window_aggregates(t.sales, t.products, ids, PARAMS)
    return doubles(framed.select("report_mth_eom", "customer_id", *VOLUMES), *VOLUMES)


def o6(t: star.Tables) -> DataFrame:
    counted = lines.window_orders(
        snapshot.snapshot_lines(t.sales, t.products, PARAMS),
        PARAMS.first_month,
        PARAMS.last_month,
    )
    return counted.select(
        "customer_id", snapshot.month_end(F.col("month")).alias("report_mth_eom"), "o6"
    )


def late_month_union(spark: SparkSession, directory: str) -> DataFrame:
    """Eleven stored months with the newest month added later."""
    t = tables(spark, directory)
    stored = replace(PARAMS, latest=date(2001, 6, 30), months=11)
    late = replace(PARAMS, months=1)
    parts = [
        snapshot.customer_snapshot(t.sales, t.products, t.customers, p) for p in (stored, late)
    ]
    return parts[0].unionByName(parts[1])


def with_customers(spark: SparkSession, directory: str) -> DataFrame:
    snap = monthly.month_slice(build_snapshot(spark, directory, 1), LATEST)
    return monthly.customer_rows(snap, tables(spark, directory).customers)


def customer_list(spark: SparkSession, directory: str) -> DataFrame:
    t = tables(spark, directory)
    return monthly.customer_list(build_snapshot(spark, directory, 1), t.customers, LATEST)


def facet_filter(spark: SparkSession, directory: str) -> DataFrame:
    chosen = facets.facet_filter(
        with_customers(spark, directory),
        activity=["Active"],
        tier=["Gold", "Silver", "Passive"],
        group=["BUILDING", "MACHINERY"],
    )
    return chosen.select("customer_id", "activity_status", "value_tier", "customer_group")


def extract(spark: SparkSession, directory: str) -> DataFrame:
    t = tables(spark, directory)
    chosen = facets.extract(
        with_customers(spark, directory),
        sales=known(t),
        stores=range(40),
        cities=[f"NATION_{i}" for i in range(15)],
        opt_in=["opt_email"],
        activity=["Active"],
    )
    return chosen.select("customer_id", "city", "opt_email", "value_tier", "lifecycle_event")


MONTHLY_SQL = ", ".join(
    [
        "count(*) AS total_customers",
        "count(*) FILTER (activity_status = 'Active') AS active",
        "count(*) FILTER (activity_status = 'Not Active') AS not_active",
        *[
            f"count(*) FILTER (lifecycle_event = '{e}') AS {e.lower()}"
            for e in ("New", "Lost", "Reactivated")
        ],
        *[
            f"count(*) FILTER (value_tier = '{t}') AS n_{t.lower()}"
            for t in monthly.VALUE_TIERS
        ],
        *[
            f"round(avg({source}) FILTER (value_tier = '{t}'), 6) AS {name}_{t.lower()}"
            for t in monthly.VALUE_TIERS
            for name, source in monthly.TIER_MEANS.items()
        ],
        "round(avg(tenure_months), 6) AS avg_tenure_months",
    ]
)
MEANS_SQL = ", ".join(
    f"round(avg({source}), 6) AS avg_{name}" for name, source in monthly.TIER_MEANS.items()
)


def monthly_report(snap: DataFrame) -> DataFrame:
    flat = monthly.monthly_report(snap)
    means = [f"{m}_{t.lower()}" for t in monthly.VALUE_TIERS for m in monthly.TIER_MEANS]
    return rounded(flat, *means, "avg_tenure_months")


def dense_sql(label: str, labels: tuple[str, ...]) -> str:
    values = ", ".join(f"('{x}')" for x in labels)
    return snap_sql(
        f"SELECT eom AS report_mth_eom, name AS {label}, count(s.customer_id) AS n "
        f"FROM months CROSS JOIN (VALUES {values}) v(name) "
        f"LEFT JOIN snap s ON s.report_mth_eom = eom AND s.{label} = name GROUP BY 1, 2"
    )


LIST_SQL = (
    "SELECT customer_id, customer_name AS name, customer_group AS \"group\", city, "
    "activity_status AS activity, value_tier AS tier, lifecycle_event AS event, tenure_months, "
    "avg_monthly_consumption AS amc, avg_order_size AS aos, o6, "
    "first_consumable_purchase_date AS first_purchase, "
    "last_consumable_purchase_date AS last_purchase FROM latest JOIN customers USING (customer_id) "
)

ENTRIES: dict[str, Entry] = {
    "canonical_sales": Entry(
        on_tables(lambda t: doubles(t.sales, "quantity", "revenue")),
        canonical(
            "SELECT invoice_id, customer_id, invoice_date, product_id, "
            "CAST(quantity AS DOUBLE) AS quantity, CAST(revenue AS DOUBLE) AS revenue, "
            "store_id FROM sales"
        ),
    ),
    "consumable_lines": Entry(
        on_tables(lambda t: doubles(lines.consumable_lines(t.sales, t.products), "units")),
        canonical(
            "SELECT customer_id, CAST(date_trunc('month', invoice_date) AS DATE) AS purchase_mth_bom, "
            "invoice_date, invoice_id, CAST(quantity * unit_size AS DOUBLE) AS units "
            "FROM sales JOIN products USING (product_id) "
            "WHERE category = 'consumable' AND quantity > 0"
        ),
    ),
    "device_lines": Entry(
        on_tables(
            lambda t: lines.positive_lines(t.sales, t.products, "device").select(
                "customer_id", "invoice_id", "invoice_date", "product_id"
            )
        ),
        canonical(
            "SELECT customer_id, invoice_id, invoice_date, product_id FROM sales "
            "JOIN products USING (product_id) WHERE category = 'device' AND quantity > 0"
        ),
    ),
    "report_months": Entry(
        on_tables(months_of_data),
        canonical(
            "SELECT last_day(CAST(newest - to_months(CAST(i AS INTEGER)) AS DATE)) AS report_mth_eom "
            "FROM (SELECT date_trunc('month', CASE WHEN last_day(max(invoice_date)) = max(invoice_date) "
            "THEN max(invoice_date) ELSE max(invoice_date) - INTERVAL 1 MONTH END) AS newest FROM sales), "
            "range(12) t(i)"
        ),
    ),
    "report_windows": Entry(
        on_tables(lambda t: report_windows(months_of_data(t))),
        snap_sql(
            "SELECT eom AS report_mth_eom, CAST(date_trunc('month', eom) AS DATE) AS report_mth_bom, "
            + ", ".join(
                f"CAST(date_trunc('month', eom) - INTERVAL {k - 1} MONTH AS DATE) AS m{k:02d}_bom"
                for k in (1, 6, 12, 13, 24, 25)
            )
            + " FROM months"
        ),
    ),
    "eligible_customers": Entry(
        on_tables(lambda t: snapshot.eligible_customers(t.customers, star.ANONYMOUS)),
        snap_sql("SELECT customer_id FROM eligible"),
    ),
    "first_device_date": Entry(
        on_tables(lambda t: lines.first_device_date(known(t), t.products)),
        snap_sql(
            "SELECT customer_id, first_device_purchase_date FROM device "
            "WHERE report_mth_eom = DATE '2001-07-31'"
        ),
    ),
    "first_last_consumable": Entry(
        on_tables(
            lambda t: base_aggregates(t).select(
                "customer_id", "first_consumable_purchase_date", "last_consumable_purchase_date"
            )
        ),
        snap_sql(
            "SELECT customer_id, first_consumable_purchase_date, last_consumable_purchase_date "
            "FROM base WHERE report_mth_eom = DATE '2001-07-31'"
        ),
    ),
    "m_total": Entry(
        on_tables(lambda t: base_aggregates(t).select("customer_id", "m_total")),
        snap_sql(
            "SELECT customer_id, CAST(m_total AS DOUBLE) AS m_total FROM base "
            "WHERE report_mth_eom = DATE '2001-07-31'"
        ),
    ),
    "m_windows": Entry(
        on_tables(m_windows),
        snap_sql("SELECT report_mth_eom, customer_id, " + ", ".join(VOLUMES) + " FROM snap"),
    ),
    "o6": Entry(
        on_tables(o6), snap_sql("SELECT customer_id, report_mth_eom, o6 FROM base WHERE o6 > 0")
    ),
    "base_aggregates": Entry(
        on_tables(base_aggregates),
        snap_sql(
            "SELECT customer_id, first_consumable_purchase_date, last_consumable_purchase_date, "
            + ", ".join(f"CAST(coalesce({v}, 0) AS DOUBLE) AS {v}" for v in VOLUMES)
            + ", o6 FROM base WHERE report_mth_eom = DATE '2001-07-31'"
        ),
    ),
    "tenure_months": Entry(
        on_snapshot(lambda s: s.select("report_mth_eom", "customer_id", "tenure_months")),
        snap_sql("SELECT report_mth_eom, customer_id, tenure_months FROM snap"),
    ),
    "activity_status": Entry(
        on_snapshot(lambda s: s.select("report_mth_eom", "customer_id", "m12", "activity_status")),
        snap_sql("SELECT report_mth_eom, customer_id, m12, activity_status FROM snap"),
    ),
    "value_tier": Entry(
        on_snapshot(
            lambda s: s.select(
                "report_mth_eom",
                "customer_id",
                "avg_monthly_consumption",
                "avg_order_size",
                "o6",
                "value_tier",
            )
        ),
        snap_sql(
            "SELECT report_mth_eom, customer_id, avg_monthly_consumption, avg_order_size, o6, "
            "value_tier FROM snap"
        ),
    ),
    "lifecycle_event": Entry(
        on_snapshot(lambda s: s.select("report_mth_eom", "customer_id", "lifecycle_event")),
        snap_sql("SELECT report_mth_eom, customer_id, lifecycle_event FROM snap"),
    ),
    "customer_snapshot": Entry(
        on_snapshot(lambda s: s, months=1), snap_sql(f"SELECT {SNAPSHOT_LIST} FROM latest")
    ),
    "customer_snapshot_12m": Entry(
        on_snapshot(lambda s: s), snap_sql(f"SELECT {SNAPSHOT_LIST} FROM snap")
    ),
    "single_month_snapshot": Entry(
        on_tables(
            lambda t: snapshot.single_month_snapshot(t.sales, t.products, t.customers, PARAMS)
        ),
        snap_sql(f"SELECT {SNAPSHOT_LIST} FROM latest"),
    ),
    "late_month_union": Entry(late_month_union, snap_sql(f"SELECT {SNAPSHOT_LIST} FROM snap")),
    "month_slice": Entry(
        on_snapshot(
            lambda s: monthly.month_slice(s, date(2001, 3, 31)).select(
                "report_mth_eom", "customer_id", "value_tier"
            )
        ),
        snap_sql(
            "SELECT report_mth_eom, customer_id, value_tier FROM snap "
            "WHERE report_mth_eom = DATE '2001-03-31'"
        ),
    ),
    "active_tiered": Entry(
        on_snapshot(
            lambda s: monthly.active_tiered(s).select("report_mth_eom", "customer_id", "value_tier")
        ),
        snap_sql(
            "SELECT report_mth_eom, customer_id, value_tier FROM snap "
            "WHERE activity_status = 'Active' AND value_tier IS NOT NULL"
        ),
    ),
    "report_month_list": Entry(
        on_snapshot(monthly.report_month_list),
        snap_sql(
            "SELECT eom AS report_mth_eom, eom = DATE '2001-07-31' AS is_latest FROM months"
        ),
    ),
    "tier_mix": Entry(on_snapshot(monthly.tier_mix), dense_sql("value_tier", monthly.VALUE_TIERS)),
    "event_counts": Entry(
        on_snapshot(monthly.event_counts), dense_sql("lifecycle_event", monthly.EVENTS)
    ),
    "activity_counts": Entry(
        on_snapshot(monthly.activity_counts), dense_sql("activity_status", monthly.STATUSES)
    ),
    "kpi_by_tier": Entry(
        on_snapshot(lambda s: rounded(monthly.kpi_by_tier(s), *MEANS)),
        snap_sql(
            f"SELECT report_mth_eom, value_tier, count(*) AS n, {MEANS_SQL} FROM snap "
            "WHERE activity_status = 'Active' AND value_tier IS NOT NULL GROUP BY 1, 2"
        ),
    ),
    "avg_tenure": Entry(
        on_snapshot(lambda s: rounded(monthly.avg_tenure(s), "avg_tenure_months")),
        snap_sql(
            "SELECT report_mth_eom, round(avg(tenure_months), 6) AS avg_tenure_months "
            "FROM snap GROUP BY 1"
        ),
    ),
    "monthly_report": Entry(
        on_snapshot(monthly_report),
        snap_sql(f"SELECT report_mth_eom, {MONTHLY_SQL} FROM snap GROUP BY 1"),
    ),
    "overview_kpis": Entry(
        on_snapshot(
            lambda s: rounded(
                monthly.overview_kpis(monthly.monthly_report(s)), "active_pct", "avg_tenure_months"
            )
        ),
        snap_sql(
            "SELECT report_mth_eom, count(*) AS total_customers, "
            "count(*) FILTER (m12 > 0) AS active_customers, "
            "round(CAST(count(*) FILTER (m12 > 0) AS DOUBLE) / count(*) * 100, 6) AS active_pct, "
            "count(lifecycle_event) AS events, round(avg(tenure_months), 6) AS avg_tenure_months "
            "FROM snap GROUP BY 1"
        ),
    ),
    "brand_units": Entry(
        on_tables(lambda t: monthly.brand_units(t.sales, t.products)),
        canonical(
            "SELECT brand, CAST(round(sum(quantity * coalesce(unit_size, 1)), 0) AS BIGINT) AS units "
            "FROM sales JOIN products USING (product_id) "
            "WHERE quantity > 0 AND category = 'consumable' GROUP BY 1"
        ),
    ),
    "category_lines": Entry(
        on_tables(lambda t: monthly.category_lines(t.sales, t.products)),
        canonical(
            "SELECT category, count(*) AS n_lines FROM sales JOIN products USING (product_id) "
            "WHERE quantity > 0 GROUP BY 1"
        ),
    ),
    "tier_distribution": Entry(
        on_snapshot(lambda s: rounded(monthly.tier_distribution(s), "pct_of_active"), months=1),
        snap_sql(
            "SELECT coalesce(value_tier, '<none>') AS value_tier, count(*) AS n, "
            "round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 100, 6) AS pct_of_active "
            "FROM latest WHERE activity_status = 'Active' GROUP BY 1"
        ),
    ),
    "event_distribution": Entry(
        on_snapshot(monthly.event_distribution, months=1),
        snap_sql(
            "SELECT coalesce(lifecycle_event, '<none>') AS lifecycle_event, count(*) AS n "
            "FROM latest GROUP BY 1"
        ),
    ),
    "verify_kpis": Entry(
        on_snapshot(lambda s: rounded(monthly.verify_kpis(s), *MEANS), months=1),
        snap_sql(
            f"SELECT value_tier, {MEANS_SQL}, count(*) AS n FROM latest "
            "WHERE value_tier IS NOT NULL GROUP BY 1"
        ),
    ),
    "facet_filter": Entry(
        facet_filter,
        snap_sql(
            "SELECT customer_id, activity_status, value_tier, customer_group "
            "FROM latest JOIN customers USING (customer_id) WHERE activity_status = 'Active' "
            "AND value_tier IN ('Gold', 'Silver', 'Passive') "
            "AND customer_group IN ('BUILDING', 'MACHINERY')"
        ),
    ),
    "facet_values": Entry(
        on_tables(lambda t: facets.facet_values(t.customers, "customer_group")),
        canonical("SELECT DISTINCT customer_group FROM customers"),
    ),
    "customer_list": Entry(customer_list, snap_sql(LIST_SQL)),
    "page": Entry(
        lambda spark, d: shape.page(
            customer_list(spark, d), monthly.list_order(), 3, folder=shared_folder(spark, "pages")
        ),
        snap_sql(
            LIST_SQL + "ORDER BY amc DESC NULLS LAST, customer_id LIMIT 50 OFFSET "
            "(SELECT least(150, greatest(0, (count(*) - 1) // 50 * 50)) FROM latest)"
        ),
    ),
    "page_after": Entry(
        lambda spark, d: shape.page_after(
            customer_list(spark, d), "amc", "customer_id", AFTER_AMC, AFTER_ID
        ),
        snap_sql(
            f"SELECT * FROM ({LIST_SQL}) WHERE amc < {AFTER_AMC} OR (amc = {AFTER_AMC} "
            f"AND customer_id > {AFTER_ID}) ORDER BY amc DESC NULLS LAST, customer_id LIMIT 50"
        ),
    ),
    "extract": Entry(
        extract,
        snap_sql(
            "SELECT customer_id, city, opt_email, value_tier, lifecycle_event "
            "FROM latest JOIN customers USING (customer_id) WHERE activity_status = 'Active' "
            "AND city IN (SELECT 'NATION_' || i FROM range(15) t(i)) AND opt_email = 1 "
            "AND customer_id IN (SELECT customer_id FROM sales WHERE store_id < 40 "
            "AND quantity > 0 AND invoice_date <= DATE '2001-07-31')"
        ),
    ),
    "tier_change": Entry(
        on_snapshot(monthly.tier_change),
        snap_sql(
            "SELECT n.report_mth_eom, n.customer_id, p.value_tier AS prev_tier, n.value_tier, "
            "p.activity_status AS prev_status, n.activity_status FROM snap n JOIN snap p "
            "ON p.customer_id = n.customer_id "
            "AND p.report_mth_eom = last_day(CAST(date_trunc('month', n.report_mth_eom) - INTERVAL 1 MONTH AS DATE)) "
            "WHERE n.value_tier IS DISTINCT FROM p.value_tier"
        ),
    ),
}
