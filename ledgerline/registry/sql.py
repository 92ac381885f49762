"""SQL building blocks for the expected results, written for DuckDB."""

from __future__ import annotations

SALES = """
sales AS (
  SELECT o_orderkey AS invoice_id, o_custkey AS customer_id,
         CAST(o_orderdate AS DATE) AS invoice_date, l_partkey AS product_id,
         CAST((CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -1 ELSE 1 END)
              * CAST(l_quantity AS DECIMAL(16,4)) AS DECIMAL(18,4)) AS quantity,
         CAST((CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -1 ELSE 1 END)
              * (CAST(l_extendedprice AS DECIMAL(15,2))
                 * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(18,4)) AS revenue,
         l_suppkey AS store_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

PRODUCTS = """
products AS (
  SELECT product_id, product_name, brand, category,
         CASE WHEN category = 'consumable' THEN CAST(p_size AS DECIMAL(18,4)) END AS unit_size
  FROM (SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_size,
               CASE p_type WHEN 'ECONOMY' THEN 'device' WHEN 'PROMO' THEN 'accessories'
                           WHEN 'LARGE' THEN 'spare_parts' ELSE 'consumable' END AS category
        FROM part))"""

CUSTOMERS = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_group,
         n_name AS city, CAST(NULL AS DATE) AS created_date, CAST(NULL AS VARCHAR) AS email,
         CAST(NULL AS VARCHAR) AS mobile_number,
         CAST(NULLIF(c_custkey % 3, 2) AS INTEGER) AS opt_email,
         CAST(NULLIF((c_custkey + 1) % 3, 2) AS INTEGER) AS opt_sms,
         CAST(NULLIF((c_custkey + 2) % 3, 2) AS INTEGER) AS opt_phone
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

LOCATIONS = """
locations AS (
  SELECT s_suppkey AS store_id, s_name AS location, n_name AS city
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""

# Volume model, twelve report months to 2001-07-31; nothing after a report
# month's end counts towards it.
SNAPSHOT = """
months AS (
  SELECT last_day(CAST(DATE '2001-07-01' - to_months(CAST(i AS INTEGER)) AS DATE)) AS eom
  FROM range(12) t(i)),
lines AS (
  SELECT customer_id, invoice_date, invoice_id, quantity * unit_size AS units,
         year(invoice_date) * 12 + month(invoice_date) AS mi
  FROM sales JOIN products USING (product_id)
  WHERE category = 'consumable' AND quantity > 0),
base AS (
  SELECT customer_id, eom AS report_mth_eom,
         min(invoice_date) AS first_consumable_purchase_date,
         max(invoice_date) AS last_consumable_purchase_date,
         sum(units) AS m_total,
         sum(units) FILTER (mi > year(eom) * 12 + month(eom) - 1) AS m1,
         sum(units) FILTER (mi > year(eom) * 12 + month(eom) - 6) AS m6,
         sum(units) FILTER (mi > year(eom) * 12 + month(eom) - 12) AS m12,
         sum(units) FILTER (mi > year(eom) * 12 + month(eom) - 13) AS m13,
         sum(units) FILTER (mi > year(eom) * 12 + month(eom) - 24) AS m24,
         sum(units) FILTER (mi > year(eom) * 12 + month(eom) - 25) AS m25,
         count(DISTINCT CASE WHEN mi > year(eom) * 12 + month(eom) - 6 THEN invoice_id END) AS o6
  FROM lines JOIN months ON invoice_date <= eom
  GROUP BY customer_id, eom),
device AS (
  SELECT customer_id, eom AS report_mth_eom, min(invoice_date) AS first_device_purchase_date
  FROM sales JOIN products USING (product_id) JOIN months ON invoice_date <= eom
  WHERE category = 'device' AND quantity > 0
  GROUP BY customer_id, eom),
eligible AS (
  SELECT customer_id FROM customers WHERE lower(coalesce(customer_group, '')) <> 'household'),
measures AS (
  SELECT eom AS report_mth_eom, e.customer_id, first_device_purchase_date,
         first_consumable_purchase_date, last_consumable_purchase_date,
         CAST((year(eom) * 12 + month(eom)) - (year(first_consumable_purchase_date) * 12
           + month(first_consumable_purchase_date)) + 1 AS INTEGER) AS tenure_months,
         CAST(coalesce(m_total, 0) AS DOUBLE) AS m_total, CAST(coalesce(m1, 0) AS DOUBLE) AS m1,
         CAST(coalesce(m6, 0) AS DOUBLE) AS m6, CAST(coalesce(m12, 0) AS DOUBLE) AS m12,
         CAST(coalesce(m13, 0) AS DOUBLE) AS m13, CAST(coalesce(m24, 0) AS DOUBLE) AS m24,
         CAST(coalesce(m25, 0) AS DOUBLE) AS m25, coalesce(o6, 0) AS o6
  FROM eligible e CROSS JOIN months
  LEFT JOIN device d ON d.customer_id = e.customer_id AND d.report_mth_eom = eom
  LEFT JOIN base b ON b.customer_id = e.customer_id AND b.report_mth_eom = eom),
snap AS (
  SELECT *, m6 / 6.0::DOUBLE AS avg_monthly_consumption,
         CASE WHEN o6 > 0 THEN m6 / o6 END AS avg_order_size,
         CASE WHEN m12 > 0 THEN 'Active' ELSE 'Not Active' END AS activity_status,
         CASE WHEN m12 = 0 THEN NULL WHEN m6 = 0 THEN 'Passive'
              WHEN m6 / 6.0::DOUBLE >= 400 AND o6 >= 3 AND m6 / o6 >= 1200 THEN 'Diamond'
              WHEN m6 / 6.0::DOUBLE >= 400 AND o6 >= 2 THEN 'Platinum'
              WHEN m6 / 6.0::DOUBLE >= 250 THEN 'Gold' WHEN m6 / 6.0::DOUBLE >= 120 THEN 'Silver'
              WHEN m6 > 0 THEN 'Bronze' END AS value_tier,
         CASE WHEN m1 > 0 AND m1 = m_total THEN 'New' WHEN m12 = 0 AND m13 > 0 THEN 'Lost'
              WHEN m1 > 0 AND m1 = m13 AND m_total > m13 THEN 'Reactivated' END AS lifecycle_event
  FROM measures),
latest AS (SELECT * FROM snap WHERE report_mth_eom = DATE '2001-07-31')"""

TIER_MINIMA = (
    ("VIP", 400000),
    ("XXL", 300000),
    ("XL", 200000),
    ("L", 150000),
    ("M", 100000),
    ("S", 60000),
    ("XS", 30000),
)


def tier_case(spend: str) -> str:
    whens = " ".join(f"WHEN {spend} >= {low} THEN '{name}'" for name, low in TIER_MINIMA)
    return f"CASE {whens} ELSE 'XXS' END"


def rounded(amount: str) -> str:
    return f"CAST(floor({amount} + 0.5) AS BIGINT)"


def spend_on(day: str) -> str:
    window = f"invoice_date > DATE '{day}' - 365 AND invoice_date <= DATE '{day}'"
    return rounded(f"coalesce(sum(revenue) FILTER ({window}), 0)")


# Spend model as of 2001-07-31.
CLIENTS = f"""
figures AS (
  SELECT customer_id,
         sum(revenue) FILTER (invoice_date > DATE '2001-07-31' - 365) AS spend,
         sum(revenue) FILTER (invoice_date <= DATE '2001-07-31' - 365
                              AND invoice_date > DATE '2001-07-31' - 730) AS spend_prev,
         sum(revenue) FILTER (invoice_date >= DATE '2001-07-01') AS spend_month,
         count(DISTINCT invoice_id) FILTER (invoice_date > DATE '2001-07-31' - 365) AS orders12m,
         count(DISTINCT invoice_id) AS orders_all,
         min(invoice_date) AS first_date, max(invoice_date) AS last_date
  FROM sales WHERE invoice_date <= DATE '2001-07-31' GROUP BY customer_id),
spends AS (
  SELECT customer_id, {rounded('coalesce(spend, 0)')} AS spend12m,
         {rounded('coalesce(spend_prev, 0)')} AS spend_prev12m,
         coalesce(spend_month, 0) AS spend_last_month,
         coalesce(orders12m, 0) AS orders12m, coalesce(orders_all, 0) AS orders_all,
         CASE WHEN coalesce(orders12m, 0) > 0
              THEN {rounded('CAST(coalesce(spend, 0) AS DOUBLE) / orders12m')} ELSE 0 END AS avg_order,
         CAST(coalesce(DATE '2001-07-31' - last_date, 9999) AS INTEGER) AS last_days,
         first_date, last_date, CAST(year(first_date) AS INTEGER) AS since_year
  FROM customers LEFT JOIN figures USING (customer_id)),
clients AS (
  SELECT *, {rounded('spend12m / 10.0::DOUBLE')} AS points,
         {tier_case('spend12m')} AS tier, {tier_case('spend_prev12m')} AS prev_tier
  FROM spends)"""

RANKS = """
ranks AS (
  SELECT * FROM (VALUES ('VIP', 0), ('XXL', 1), ('XL', 2), ('L', 3), ('M', 4), ('S', 5),
                        ('XS', 6), ('XXS', 7)) v(name, pos))"""

SERIES = """
spine AS (
  SELECT CAST(DATE '2001-07-01' - to_months(CAST(i AS INTEGER)) AS DATE) AS month
  FROM range(18) t(i)),
sold AS (
  SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month, sum(revenue) AS rev,
         count(DISTINCT (customer_id, invoice_id)) AS orders,
         count(DISTINCT customer_id) AS active
  FROM sales WHERE invoice_date <= DATE '2001-07-31' GROUP BY 1),
series AS (
  SELECT month, CAST(coalesce(rev, 0) AS DOUBLE) AS revenue,
         CAST(floor(coalesce(rev, 0) / 1000 + 0.5) AS BIGINT) AS revenue_k,
         coalesce(orders, 0) AS orders, coalesce(active, 0) AS active,
         CASE WHEN orders > 0 THEN CAST(rev AS DOUBLE) / orders END AS basket
  FROM spine LEFT JOIN sold USING (month)),
joins AS (
  SELECT CAST(date_trunc('month', first_date) AS DATE) AS month, count(*) AS n
  FROM clients WHERE first_date IS NOT NULL GROUP BY 1),
leaves AS (
  SELECT CAST(date_trunc('month', last_date) + INTERVAL 3 MONTH AS DATE) AS month, count(*) AS n
  FROM clients WHERE last_date IS NOT NULL GROUP BY 1),
flow AS (
  SELECT month, coalesce(j.n, 0) AS new_clients, coalesce(l.n, 0) AS churned_clients,
         coalesce(j.n, 0) - coalesce(l.n, 0) AS net_growth
  FROM spine LEFT JOIN joins j USING (month) LEFT JOIN leaves l USING (month))"""

STORES = """
store_figures AS (
  SELECT store_id, sum(revenue) FILTER (now) AS rev, sum(revenue) FILTER (NOT now) AS rev_before,
         count(DISTINCT (customer_id, invoice_id)) FILTER (now) AS orders,
         count(DISTINCT customer_id) FILTER (now) AS clients,
         count(DISTINCT customer_id) FILTER (NOT now) AS clients_before
  FROM (SELECT *, invoice_date > DATE '2001-07-31' - 365 AS now FROM sales
        WHERE invoice_date <= DATE '2001-07-31' AND invoice_date > DATE '2001-07-31' - 730)
  GROUP BY store_id),
store_returned AS (
  SELECT store_id, count(*) AS returned
  FROM (SELECT store_id, customer_id FROM sales
        WHERE invoice_date <= DATE '2001-07-31' AND invoice_date > DATE '2001-07-31' - 365
        INTERSECT
        SELECT store_id, customer_id FROM sales
        WHERE invoice_date <= DATE '2001-07-31' - 365 AND invoice_date > DATE '2001-07-31' - 730)
  GROUP BY store_id),
stores AS (
  SELECT store_id, location, city, CAST(coalesce(rev, 0) AS DOUBLE) AS revenue,
         CAST(floor(coalesce(rev, 0) / 1000 + 0.5) AS BIGINT) AS revenue_k,
         CAST(coalesce(rev_before, 0) AS DOUBLE) AS revenue_before,
         coalesce(orders, 0) AS orders, coalesce(clients, 0) AS clients,
         CASE WHEN orders > 0 THEN CAST(floor(CAST(coalesce(rev, 0) AS DOUBLE) / orders + 0.5) AS BIGINT)
              ELSE 0 END AS avg_basket,
         CASE WHEN coalesce(rev_before, 0) <> 0
              THEN (CAST(coalesce(rev, 0) AS DOUBLE) - CAST(rev_before AS DOUBLE))
                   / CAST(rev_before AS DOUBLE) * 100 END AS growth_pct,
         CASE WHEN clients_before > 0
              THEN CAST(coalesce(returned, 0) AS DOUBLE) / clients_before * 100 END AS retention_pct
  FROM locations LEFT JOIN store_figures USING (store_id) LEFT JOIN store_returned USING (store_id))"""


def with_tables(*blocks: str, query: str) -> str:
    """A query over the canonical tables and the given further blocks."""
    base = [SALES, PRODUCTS, CUSTOMERS, LOCATIONS]
    return "WITH " + ",".join([*base, *blocks]) + "\n" + query


def canonical(query: str) -> str:
    return with_tables(query=query)


def on_snapshot(query: str) -> str:
    return with_tables(SNAPSHOT, query=query)


def on_clients(query: str) -> str:
    return with_tables(CLIENTS, RANKS, query=query)


def on_series(query: str) -> str:
    return with_tables(CLIENTS, SERIES, query=query)


def on_stores(query: str) -> str:
    return with_tables(STORES, query=query)
