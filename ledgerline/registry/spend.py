"""Registered queries: spend ladder, series, locations, movements, extracts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import facets, shape
from ledgerline.params import SPEND_TIERS
from ledgerline.plans import extracts, ladder
from ledgerline.registry.common import (
    LADDER,
    LATEST,
    Entry,
    doubles,
    on_snapshot,
    on_stats,
    on_tables,
    rounded,
    snapshot,
    stats,
    tables,
)
from ledgerline.registry.sql import (
    CLIENTS,
    SNAPSHOT,
    canonical,
    on_clients,
    on_series,
    on_stores,
    spend_on,
    tier_case,
    with_tables,
)
from ledgerline.sources import star

START = date(2001, 4, 30)
GRID = "SELECT f.name AS from_tier, t.name AS to_tier FROM ranks f CROSS JOIN ranks t"
STATS_LIST = (
    "customer_id, CAST(spend_last_month AS DOUBLE) AS spend_last_month, spend12m, spend_prev12m, "
    "orders12m, orders_all, last_days, first_date, last_date, since_year, avg_order, points, "
    "tier, prev_tier"
)
DIRECTION = (
    "CASE WHEN t.pos < f.pos THEN 'up' WHEN t.pos > f.pos THEN 'down' END AS direction"
)
MOVES = (
    f"moves AS (SELECT prev_tier AS from_tier, tier AS to_tier, count(*) AS n, {DIRECTION} "
    "FROM clients JOIN ranks f ON f.name = prev_tier JOIN ranks t ON t.name = tier "
    "GROUP BY prev_tier, tier, f.pos, t.pos)"
)
AT_DAYS = f"""
at_days AS (
  SELECT customer_id, {spend_on('2001-04-30')} AS s0, {spend_on('2001-07-31')} AS s1,
         CAST(coalesce(DATE '2001-04-30' - max(invoice_date) FILTER (invoice_date <= DATE '2001-04-30'), 9999) AS INTEGER) AS d0,
         CAST(coalesce(DATE '2001-07-31' - max(invoice_date) FILTER (invoice_date <= DATE '2001-07-31'), 9999) AS INTEGER) AS d1
  FROM customers LEFT JOIN sales USING (customer_id) GROUP BY customer_id),
tiers_at AS (SELECT *, {tier_case('s0')} AS tier_0, {tier_case('s1')} AS tier_1 FROM at_days)"""


def at_days(query: str) -> str:
    return with_tables(CLIENTS, RANKS_BLOCK, AT_DAYS, query=query)


RANKS_BLOCK = "ranks AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', {i})" for i, name in enumerate(SPEND_TIERS)
) + ") v(name, pos))"


def figures(s: DataFrame) -> DataFrame:
    return doubles(s, "spend_last_month")


def series(t: star.Tables) -> DataFrame:
    return ladder.monthly_series(t.sales, LADDER)


def flow(spark: SparkSession, directory: str) -> DataFrame:
    return ladder.base_flow(stats(spark, directory), LADDER)


def mom_delta(spark: SparkSession, directory: str) -> DataFrame:
    delta = ladder.mom_delta(series(tables(spark, directory)), flow(spark, directory))
    return rounded(delta, "revenue_pct", "active_pct", "new_clients_pct", "basket_pct")


def flat_vector(t: star.Tables) -> DataFrame:
    vectors = ladder.monthly_vector(t.sales, t.customers, LADDER)
    return vectors.select("customer_id", F.posexplode("monthly").alias("bucket", "amount"))


def location_figures(t: star.Tables) -> DataFrame:
    return ladder.location_stats(t.sales, t.locations, LADDER)


def client_filter(t: star.Tables) -> DataFrame:
    clients = ladder.client_directory(t.sales, t.customers, LADDER)
    found = facets.client_filter(
        clients, tier="L", active=True, kind="BUILDING", search="r#0"
    )
    return found.select("customer_id", "customer_name", "tier", "client_type", "home_store")


def user_sort(t: star.Tables) -> DataFrame:
    clients = ladder.client_directory(t.sales, t.customers, LADDER)
    ordered = shape.sorted_by(clients, "avg_order", "customer_id", descending=True)
    return ordered.select("customer_id", "customer_name", "avg_order", "home_store")


def audit_log(spark: SparkSession, directory: str) -> DataFrame:
    """The event table in the form of an audit trail."""
    return star.read(spark, directory, "events").select(
        "event_id",
        "user_id",
        F.col("event_type").alias("action"),
        F.col("value").cast("string").alias("target"),
        F.col("props").alias("detail"),
        "ts",
    )


def audit_filter(spark: SparkSession, directory: str) -> DataFrame:
    found = facets.audit_filter(audit_log(spark, directory), user=8, search="CHASE")
    return found.select("event_id", "user_id", "action", "detail")


def recent_activity(spark: SparkSession, directory: str) -> DataFrame:
    newest = shape.newest(
        audit_log(spark, directory), "user_id", [F.desc("ts"), F.desc("event_id")], 5
    )
    return newest.select("user_id", "place", "event_id", "action")


def consent_log(spark: SparkSession, directory: str) -> DataFrame:
    """Orders read as consent changes: status P withdraws the channel."""
    channel = (
        F.when(F.col("o_orderpriority") == "5-LOW", "opt_email")
        .when(F.col("o_orderpriority") == "1-URGENT", "opt_sms")
        .otherwise("opt_phone")
    )
    return star.read(spark, directory, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        channel.alias("channel"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(1).alias("opted"),
        F.col("o_orderdate").alias("changed_at"),
        F.col("o_orderpriority").alias("source"),
    )


def consent_register(spark: SparkSession, directory: str) -> DataFrame:
    t = tables(spark, directory)
    return extracts.consent_register(t.customers, consent_log(spark, directory))


def weekly_digest(t: star.Tables) -> DataFrame:
    figures = ladder.client_stats(t.sales, t.customers, LADDER)
    weekly = extracts.weekly_digest(t.sales, figures, LADDER)
    return rounded(weekly, "revenue_pct", "active_pct", "new_clients_pct")


def transitions(t: star.Tables, plan) -> DataFrame:
    return plan(t.sales, t.customers, START, LATEST, LADDER)


ENTRIES: dict[str, Entry] = {
    "client_stats": Entry(
        on_stats(figures), on_clients(f"SELECT {STATS_LIST} FROM clients")
    ),
    "spend_tier": Entry(
        on_stats(lambda s: s.select("customer_id", "spend12m", "tier", "spend_prev12m", "prev_tier")),
        on_clients("SELECT customer_id, spend12m, tier, spend_prev12m, prev_tier FROM clients"),
    ),
    "loyalty_points": Entry(
        on_stats(lambda s: s.select("customer_id", "points")),
        on_clients(
            "SELECT customer_id, CAST(floor(spend12m / 10.0::DOUBLE + 0.5) AS BIGINT) AS points "
            "FROM clients"
        ),
    ),
    "recency_label": Entry(
        on_stats(ladder.recency_labels),
        on_clients(
            "SELECT customer_id, last_days, CASE WHEN last_days <= 1 THEN 'Today' "
            "WHEN last_days < 30 THEN last_days || 'd ago' "
            "ELSE CAST(floor(last_days / 30.0::DOUBLE + 0.5) AS BIGINT) || 'mo ago' END AS label, "
            "CASE WHEN last_days <= 30 THEN 'ok' WHEN last_days <= 90 THEN 'plain' "
            "WHEN last_days <= 180 THEN 'warn' ELSE 'bad' END AS severity FROM clients"
        ),
    ),
    "inactive_by_days": Entry(
        on_stats(lambda s: ladder.inactive_clients(s, 90).select("customer_id", "last_days")),
        on_clients("SELECT customer_id, last_days FROM clients WHERE last_days > 90"),
    ),
    "active_flag": Entry(
        on_stats(
            lambda s: s.select(
                "customer_id", (F.col("last_days") <= LADDER.active_days).alias("is_active")
            )
        ),
        on_clients("SELECT customer_id, last_days <= 180 AS is_active FROM clients"),
    ),
    "status_counts": Entry(
        on_stats(lambda s: ladder.status_counts(s, LADDER.active_days)),
        on_clients(
            "SELECT count(*) FILTER (last_days <= 180) AS active, "
            "count(*) FILTER (last_days > 180) AS inactive FROM clients"
        ),
    ),
    "monthly_vector": Entry(
        on_tables(flat_vector),
        canonical(
            "SELECT customer_id, CAST(11 - b AS INTEGER) AS bucket, "
            "CAST(floor(coalesce(sum(revenue), 0) + 0.5) AS BIGINT) AS amount "
            "FROM customers CROSS JOIN range(12) r(b) LEFT JOIN "
            "(SELECT customer_id, revenue, floor((DATE '2001-07-31' - invoice_date) / 30.44::DOUBLE) AS b "
            "FROM sales WHERE invoice_date <= DATE '2001-07-31' AND invoice_date > DATE '2001-07-31' - 365) s "
            "USING (customer_id, b) GROUP BY 1, 2"
        ),
    ),
    "monthly_series": Entry(on_tables(series), on_series("SELECT * FROM series")),
    "month_basket": Entry(
        on_tables(lambda t: series(t).select("month", "basket")),
        on_series("SELECT month, basket FROM series"),
    ),
    "new_series": Entry(
        lambda spark, d: flow(spark, d).select("month", "new_clients"),
        on_series("SELECT month, new_clients FROM flow"),
    ),
    "churn_series": Entry(
        lambda spark, d: flow(spark, d).select("month", "churned_clients"),
        on_series("SELECT month, churned_clients FROM flow"),
    ),
    "net_growth": Entry(flow, on_series("SELECT * FROM flow")),
    "mom_delta": Entry(
        mom_delta,
        on_series(
            "SELECT month, "
            + ", ".join(
                f"round((CAST({m} AS DOUBLE) - lag({m}) OVER w) / nullif(lag({m}) OVER w, 0) * 100, 6) "
                f"AS {m}_pct"
                for m in ("revenue", "active", "new_clients", "basket")
            )
            + " FROM series JOIN flow USING (month) WINDOW w AS (ORDER BY month)"
        ),
    ),
    "location_stats": Entry(
        on_tables(lambda t: rounded(location_figures(t), "growth_pct", "retention_pct")),
        on_stores(
            "SELECT * REPLACE (round(growth_pct, 6) AS growth_pct, "
            "round(retention_pct, 6) AS retention_pct) FROM stores"
        ),
    ),
    "location_growth": Entry(
        on_tables(
            lambda t: rounded(
                location_figures(t).select("store_id", "revenue", "revenue_before", "growth_pct"),
                "growth_pct",
            )
        ),
        on_stores(
            "SELECT store_id, revenue, revenue_before, round(growth_pct, 6) AS growth_pct FROM stores"
        ),
    ),
    "location_retention": Entry(
        on_tables(
            lambda t: rounded(
                location_figures(t).select("store_id", "clients", "retention_pct"), "retention_pct"
            )
        ),
        on_stores("SELECT store_id, clients, round(retention_pct, 6) AS retention_pct FROM stores"),
    ),
    "city_rollup": Entry(
        on_tables(lambda t: ladder.city_rollup(location_figures(t))),
        on_stores(
            "SELECT city, count(*) AS n_locations, CAST(sum(revenue_k) AS BIGINT) AS revenue_k "
            "FROM stores GROUP BY 1"
        ),
    ),
    "city_location_rollup": Entry(
        on_tables(lambda t: ladder.city_location_rollup(location_figures(t))),
        on_stores(
            "SELECT city, location, CAST(sum(revenue_k) AS BIGINT) AS revenue_k, "
            "CAST(grouping(city, location) AS BIGINT) AS level FROM stores GROUP BY ROLLUP (city, location)"
        ),
    ),
    "location_performance": Entry(
        on_tables(
            lambda t: rounded(
                location_figures(t).select(
                    "location", "city", "revenue", "clients", "avg_basket", "retention_pct"
                ),
                "retention_pct",
            )
        ),
        on_stores(
            "SELECT location, city, revenue, clients, avg_basket, "
            "round(retention_pct, 6) AS retention_pct FROM stores"
        ),
    ),
    "home_location": Entry(
        on_tables(lambda t: ladder.home_location(t.sales, LADDER)),
        canonical(
            "SELECT customer_id, store_id AS home_store, n AS orders FROM ("
            "SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, store_id) AS place "
            "FROM (SELECT customer_id, store_id, count(DISTINCT invoice_id) AS n FROM sales "
            "WHERE invoice_date <= DATE '2001-07-31' GROUP BY 1, 2)) WHERE place = 1"
        ),
    ),
    "favourite_product": Entry(
        on_tables(lambda t: ladder.favourite_product(t.sales, LADDER)),
        canonical(
            "SELECT customer_id, product_id, n AS orders FROM ("
            "SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY n DESC, product_id) AS place "
            "FROM (SELECT customer_id, product_id, count(DISTINCT invoice_id) AS n FROM sales "
            "WHERE invoice_date <= DATE '2001-07-31' AND quantity > 0 GROUP BY 1, 2)) WHERE place = 1"
        ),
    ),
    "top_clients": Entry(
        on_stats(lambda s: ladder.top_clients(s).select("customer_id", "spend12m", "tier")),
        on_clients(
            "SELECT customer_id, spend12m, tier FROM clients ORDER BY spend12m DESC, customer_id LIMIT 6"
        ),
    ),
    "recent_moves": Entry(
        on_stats(
            lambda s: ladder.recent_moves(s).select("customer_id", "spend12m", "prev_tier", "tier")
        ),
        on_clients(
            "SELECT customer_id, spend12m, prev_tier, tier FROM clients WHERE tier <> prev_tier "
            "ORDER BY spend12m DESC, customer_id LIMIT 6"
        ),
    ),
    "recent_orders": Entry(
        on_tables(lambda t: ladder.recent_orders(t.sales, t.products, t.locations, LADDER)),
        canonical(
            "SELECT o.customer_id, CAST(place AS INTEGER) AS place, o.invoice_id, order_date, "
            "CAST(DATE '2001-07-31' - order_date AS INTEGER) AS days_ago, "
            "CAST(floor(amount + 0.5) AS BIGINT) AS amount, store_id, product_id, location, product_name "
            "FROM (SELECT *, row_number() OVER (PARTITION BY customer_id "
            "ORDER BY order_date DESC, invoice_id DESC) AS place FROM ("
            "SELECT customer_id, invoice_id, max(invoice_date) AS order_date, sum(revenue) AS amount "
            "FROM sales WHERE invoice_date <= DATE '2001-07-31' GROUP BY 1, 2)) o "
            "JOIN (SELECT customer_id, invoice_id, store_id, product_id, row_number() OVER ("
            "PARTITION BY customer_id, invoice_id ORDER BY revenue DESC, store_id DESC, product_id DESC) AS r "
            "FROM sales WHERE invoice_date <= DATE '2001-07-31') l "
            "ON l.customer_id = o.customer_id AND l.invoice_id = o.invoice_id AND r = 1 "
            "LEFT JOIN locations USING (store_id) LEFT JOIN products USING (product_id) WHERE place <= 8"
        ),
    ),
    "client_filter": Entry(
        on_tables(client_filter),
        on_clients(
            "SELECT customer_id, customer_name, tier, customer_group AS client_type, home_store "
            "FROM clients JOIN customers USING (customer_id) LEFT JOIN ("
            "SELECT customer_id, store_id AS home_store, row_number() OVER ("
            "PARTITION BY customer_id ORDER BY n DESC, store_id) AS place "
            "FROM (SELECT customer_id, store_id, count(DISTINCT invoice_id) AS n FROM sales "
            "WHERE invoice_date <= DATE '2001-07-31' GROUP BY 1, 2) QUALIFY place = 1) USING (customer_id) "
            "WHERE tier = 'L' AND last_days <= 180 AND customer_group = 'BUILDING' "
            "AND (contains(lower(customer_name), 'r#0') OR contains(CAST(customer_id AS VARCHAR), 'r#0'))"
        ),
    ),
    "user_sort": Entry(
        on_tables(user_sort),
        on_clients(
            "SELECT customer_id, customer_name, avg_order, home_store "
            "FROM clients JOIN customers USING (customer_id) LEFT JOIN ("
            "SELECT customer_id, store_id AS home_store, row_number() OVER ("
            "PARTITION BY customer_id ORDER BY n DESC, store_id) AS place "
            "FROM (SELECT customer_id, store_id, count(DISTINCT invoice_id) AS n FROM sales "
            "WHERE invoice_date <= DATE '2001-07-31' GROUP BY 1, 2) QUALIFY place = 1) USING (customer_id) "
            "ORDER BY avg_order DESC, customer_id"
        ),
    ),
    "transition_matrix": Entry(
        on_stats(ladder.transition_matrix),
        on_clients(
            f"SELECT g.from_tier, g.to_tier, count(customer_id) AS n FROM ({GRID}) g "
            "LEFT JOIN clients ON prev_tier = g.from_tier AND tier = g.to_tier GROUP BY 1, 2"
        ),
    ),
    "movement_totals": Entry(
        on_stats(ladder.movement_totals),
        on_clients(
            "SELECT count(*) AS clients, count(*) FILTER (t.pos <> f.pos) AS retiered, "
            "count(*) FILTER (t.pos < f.pos) AS moved_up, count(*) FILTER (t.pos > f.pos) AS moved_down, "
            "count(*) FILTER (t.pos < f.pos) - count(*) FILTER (t.pos > f.pos) AS net "
            "FROM clients JOIN ranks f ON f.name = prev_tier JOIN ranks t ON t.name = tier"
        ),
    ),
    "top_moves": Entry(
        on_stats(lambda s: ladder.top_moves(ladder.transition_matrix(s))),
        with_tables(
            CLIENTS,
            RANKS_BLOCK,
            MOVES,
            query="SELECT from_tier, to_tier, n, direction, CAST(place AS INTEGER) AS place FROM ("
            "SELECT *, row_number() OVER (PARTITION BY direction "
            "ORDER BY n DESC, from_tier, to_tier) AS place FROM moves WHERE direction IS NOT NULL) "
            "WHERE place <= 5",
        ),
    ),
    "headline_kpis": Entry(
        on_stats(lambda s: ladder.headline_kpis(s, LADDER)),
        on_clients(
            "SELECT count(*) AS clients, CAST(sum(orders_all) AS BIGINT) AS transactions, "
            "CAST(sum(spend12m) AS BIGINT) AS revenue12m, CAST(sum(orders12m) AS BIGINT) AS orders12m, "
            "count(*) FILTER (last_days <= 180) AS active_now, "
            "CAST(sum(spend_last_month) AS DOUBLE) AS revenue_last_month, "
            "CAST(floor(CAST(sum(spend12m) AS DOUBLE) / CAST(sum(orders12m) AS DOUBLE) + 0.5) AS BIGINT) AS avg_basket FROM clients"
        ),
    ),
    "segment_share": Entry(
        on_stats(lambda s: rounded(ladder.segment_share(s), "pct_of_revenue")),
        on_clients(
            "SELECT name AS tier, count(customer_id) AS clients, "
            "CAST(coalesce(sum(spend12m), 0) AS BIGINT) AS spend12m, "
            "round(CAST(coalesce(sum(spend12m), 0) AS DOUBLE) / CAST(sum(sum(spend12m)) OVER () AS DOUBLE) * 100, 6) "
            "AS pct_of_revenue FROM ranks LEFT JOIN clients ON tier = name GROUP BY name"
        ),
    ),
    "top_tier_concentration": Entry(
        on_stats(lambda s: rounded(ladder.top_tier_concentration(s), "top_pct_of_revenue")),
        on_clients(
            "SELECT count(*) FILTER (tier IN ('VIP', 'XXL', 'XL')) AS top_clients, "
            "round(CAST(coalesce(sum(spend12m) FILTER (tier IN ('VIP', 'XXL', 'XL')), 0) AS DOUBLE) "
            "/ CAST(sum(spend12m) AS DOUBLE) * 100, 6) AS top_pct_of_revenue FROM clients"
        ),
    ),
    "rfm_grid": Entry(
        on_stats(ladder.rfm_grid),
        on_clients(
            "SELECT CAST(f AS INTEGER) AS frequency_bucket, CAST(r AS INTEGER) AS recency_bucket, "
            "count(customer_id) AS n FROM range(4) a(f) CROSS JOIN range(4) b(r) LEFT JOIN ("
            "SELECT customer_id, CASE WHEN orders12m >= 10 THEN 0 WHEN orders12m >= 6 THEN 1 "
            "WHEN orders12m >= 3 THEN 2 ELSE 3 END AS f, CASE WHEN last_days <= 30 THEN 0 "
            "WHEN last_days <= 90 THEN 1 WHEN last_days <= 180 THEN 2 ELSE 3 END AS r FROM clients) "
            "USING (f, r) GROUP BY 1, 2"
        ),
    ),
    "going_cold": Entry(
        on_stats(lambda s: ladder.going_cold(s).select("customer_id", "orders12m", "last_days")),
        on_clients(
            "SELECT customer_id, orders12m, last_days FROM clients "
            "WHERE orders12m >= 6 AND last_days > 90"
        ),
    ),
    "full_client_base": Entry(
        lambda spark, d: extracts.full_client_base(
            snapshot(spark, d, 1), tables(spark, d).customers, LATEST
        ),
        with_tables(
            SNAPSHOT,
            query="SELECT report_mth_eom, customer_id, customer_name, customer_group, city, created_date, "
            "activity_status, value_tier, lifecycle_event, tenure_months, first_consumable_purchase_date, "
            "last_consumable_purchase_date, email, mobile_number, opt_email, opt_sms, opt_phone "
            "FROM latest JOIN customers USING (customer_id)",
        ),
    ),
    "inactive_top_tiers": Entry(
        on_stats(
            lambda s: extracts.inactive_top_tiers(s, 60).select("customer_id", "tier", "last_days")
        ),
        on_clients(
            "SELECT customer_id, tier, last_days FROM clients "
            "WHERE tier IN ('VIP', 'XXL', 'XL') AND last_days > 60"
        ),
    ),
    "movement_summary": Entry(
        on_tables(lambda t: transitions(t, extracts.movement_summary)),
        at_days(
            f"SELECT g.from_tier, g.to_tier, count(customer_id) AS n FROM ({GRID}) g "
            "LEFT JOIN tiers_at ON tier_0 = g.from_tier AND tier_1 = g.to_tier GROUP BY 1, 2"
        ),
    ),
    "movement_top_moves": Entry(
        on_tables(lambda t: transitions(t, extracts.movement_top_moves)),
        at_days(
            "SELECT from_tier, to_tier, n, direction, CAST(place AS INTEGER) AS place FROM ("
            "SELECT *, row_number() OVER (PARTITION BY direction ORDER BY n DESC, from_tier, to_tier) AS place "
            f"FROM (SELECT tier_0 AS from_tier, tier_1 AS to_tier, count(*) AS n, {DIRECTION} "
            "FROM tiers_at JOIN ranks f ON f.name = tier_0 JOIN ranks t ON t.name = tier_1 "
            "GROUP BY tier_0, tier_1, f.pos, t.pos) WHERE direction IS NOT NULL) WHERE place <= 5"
        ),
    ),
    "consent_register": Entry(
        consent_register,
        canonical(
            "SELECT customer_id, channel, CASE opted WHEN 1 THEN 'in' WHEN 0 THEN 'out' "
            "ELSE 'unknown' END AS consent, changed_at, source FROM ("
            "SELECT f.customer_id, f.channel, CASE WHEN l.customer_id IS NULL THEN f.opted ELSE l.opted END AS opted, "
            "changed_at, source FROM (SELECT customer_id, 'opt_email' AS channel, opt_email AS opted FROM customers "
            "UNION ALL SELECT customer_id, 'opt_sms', opt_sms FROM customers "
            "UNION ALL SELECT customer_id, 'opt_phone', opt_phone FROM customers) f LEFT JOIN ("
            "SELECT *, row_number() OVER (PARTITION BY customer_id, channel "
            "ORDER BY changed_at DESC, source DESC, opted DESC) AS place FROM ("
            "SELECT o_custkey AS customer_id, CASE o_orderpriority WHEN '5-LOW' THEN 'opt_email' "
            "WHEN '1-URGENT' THEN 'opt_sms' ELSE 'opt_phone' END AS channel, "
            "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS opted, o_orderdate AS changed_at, "
            "o_orderpriority AS source FROM orders)) l "
            "ON l.customer_id = f.customer_id AND l.channel = f.channel AND place = 1)"
        ),
    ),
    "new_client_cohort": Entry(
        on_tables(
            lambda t: rounded(extracts.new_client_cohort(t.sales, LADDER), "pct_of_cohort")
        ),
        canonical(
            "SELECT CAST(cohort AS DATE) AS cohort_month, CAST(since AS INTEGER) AS months_since, "
            "count(*) AS buyers, max(count(*)) OVER (PARTITION BY cohort) AS cohort_size, "
            "round(CAST(count(*) AS DOUBLE) / max(count(*)) OVER (PARTITION BY cohort) * 100, 6) AS pct_of_cohort "
            "FROM (SELECT *, date_diff('month', cohort, month) AS since FROM ("
            "SELECT *, min(month) OVER (PARTITION BY customer_id) AS cohort FROM ("
            "SELECT DISTINCT customer_id, date_trunc('month', invoice_date) AS month FROM sales "
            "WHERE quantity > 0 AND invoice_date <= DATE '2001-07-31'))) GROUP BY cohort, since"
        ),
    ),
    "cohort_repeat": Entry(
        on_tables(lambda t: rounded(extracts.cohort_repeat(t.sales, LADDER), "repeat_pct")),
        canonical(
            "SELECT CAST(date_trunc('month', first_date) AS DATE) AS cohort_month, count(*) AS clients, "
            "count(*) FILTER (orders > 1) AS repeat_clients, CAST(sum(orders) AS BIGINT) AS orders, "
            "round(CAST(count(*) FILTER (orders > 1) AS DOUBLE) / count(*) * 100, 6) AS repeat_pct FROM ("
            "SELECT customer_id, min(invoice_date) AS first_date, count(DISTINCT invoice_id) AS orders "
            "FROM sales WHERE quantity > 0 AND invoice_date <= DATE '2001-07-31' GROUP BY 1) GROUP BY 1"
        ),
    ),
    "retier_summary": Entry(
        on_tables(lambda t: transitions(t, extracts.retier_summary)),
        at_days(
            "SELECT count(*) AS clients, count(*) FILTER (t.pos <> f.pos) AS retiered, "
            "count(*) FILTER (t.pos < f.pos) AS moved_up, count(*) FILTER (t.pos > f.pos) AS moved_down, "
            "count(*) FILTER (t.pos < f.pos) - count(*) FILTER (t.pos > f.pos) AS net "
            "FROM tiers_at JOIN ranks f ON f.name = tier_0 JOIN ranks t ON t.name = tier_1"
        ),
    ),
    "inactivity_sweep": Entry(
        on_tables(lambda t: transitions(t, extracts.inactivity_sweep)),
        at_days(
            "SELECT customer_id, tier_1 AS tier, d1 AS last_days FROM tiers_at "
            "WHERE d0 <= 180 AND d1 > 180"
        ),
    ),
    "turning_inactive": Entry(
        on_stats(lambda s: extracts.turning_inactive(s, LADDER, 30)),
        on_clients(
            "SELECT customer_id, tier, CAST(last_date + 181 AS DATE) AS turned_on FROM clients "
            "WHERE last_date + 181 <= DATE '2001-07-31' AND last_date + 181 > DATE '2001-07-31' - 30"
        ),
    ),
    "tenure_cohort": Entry(
        on_snapshot(lambda s: extracts.tenure_cohort(s, LATEST), months=1),
        with_tables(
            SNAPSHOT,
            query="SELECT CASE WHEN tenure_months >= 37 THEN '37+' WHEN tenure_months >= 25 THEN '25-36' "
            "WHEN tenure_months >= 13 THEN '13-24' WHEN tenure_months >= 7 THEN '07-12' "
            "WHEN tenure_months >= 1 THEN '01-06' ELSE 'never' END AS tenure_band, "
            "coalesce(value_tier, '<none>') AS value_tier, count(*) AS n FROM latest GROUP BY 1, 2",
        ),
    ),
    "weekly_digest": Entry(
        on_tables(weekly_digest),
        on_clients(
            "SELECT *, round((revenue - lag(revenue) OVER w) / nullif(lag(revenue) OVER w, 0) * 100, 6) AS revenue_pct, "
            "round((CAST(active AS DOUBLE) - lag(active) OVER w) / nullif(lag(active) OVER w, 0) * 100, 6) AS active_pct, "
            "round((CAST(new_clients AS DOUBLE) - lag(new_clients) OVER w) / nullif(lag(new_clients) OVER w, 0) * 100, 6) "
            "AS new_clients_pct FROM (SELECT CAST(DATE '2001-07-23' - CAST(7 * i AS INTEGER) AS DATE) AS week, "
            "CAST(coalesce(rev, 0) AS DOUBLE) AS revenue, coalesce(orders, 0) AS orders, "
            "coalesce(active, 0) AS active, coalesce(joined, 0) AS new_clients FROM range(13) t(i) LEFT JOIN ("
            "SELECT CAST(date_trunc('week', invoice_date) AS DATE) AS wk, sum(revenue) AS rev, "
            "count(DISTINCT (customer_id, invoice_id)) AS orders, count(DISTINCT customer_id) AS active "
            "FROM sales WHERE invoice_date <= DATE '2001-07-31' GROUP BY 1) s ON wk = DATE '2001-07-23' - CAST(7 * i AS INTEGER) "
            "LEFT JOIN (SELECT CAST(date_trunc('week', first_date) AS DATE) AS fw, count(*) AS joined "
            "FROM clients GROUP BY 1) c ON fw = DATE '2001-07-23' - CAST(7 * i AS INTEGER)) WINDOW w AS (ORDER BY week)"
        ),
    ),
    "audit_filter": Entry(
        audit_filter,
        "SELECT event_id, user_id, event_type AS action, props AS detail FROM events "
        "WHERE user_id = 8 AND contains(lower(event_type || CAST(value AS VARCHAR) || props), 'chase')",
    ),
    "recent_activity": Entry(
        recent_activity,
        "SELECT user_id, CAST(place AS INTEGER) AS place, event_id, event_type AS action FROM ("
        "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place "
        "FROM events) WHERE place <= 5",
    ),
    "audit_users": Entry(
        lambda spark, d: facets.facet_values(audit_log(spark, d), "user_id"),
        "SELECT DISTINCT user_id FROM events",
    ),
}
