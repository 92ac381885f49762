"""Registered queries: load rules, masters, files, stores and streams.

The tables are clean, so faults are derived from their own values here: some
lines get an unreadable date or quantity, some products a wrong category.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import quality
from ledgerline.params import EVENTS, STATUSES, VALUE_TIERS
from ledgerline.plans import monthly
from ledgerline.registry.common import (
    LATEST,
    PARAMS,
    Entry,
    doubles,
    on_snapshot,
    on_tables,
    rounded,
    snapshot,
    tables,
)
from ledgerline.registry.sql import canonical, with_tables
from ledgerline.registry.sql import on_snapshot as snap_sql
from ledgerline.registry.volume import LIST_SQL, SNAPSHOT_LIST
from ledgerline.schemas import CUSTOMERS, PRODUCTS, SALES
from ledgerline.sources import files, star, store
from ledgerline.streaming import arrival, daily

# -- tables with faults -------------------------------------------------------


def raw_sales(spark: SparkSession, directory: str) -> DataFrame:
    c = F.col
    lines = star.read(spark, directory, "lineitem")
    orders = star.read(spark, directory, "orders")
    day = c("o_orderdate").cast("date").cast("string")
    accepted = c("l_returnflag") == "A"
    return lines.join(orders, c("l_orderkey") == c("o_orderkey")).select(
        c("o_orderkey").cast("string").alias("invoice_id"),
        F.when(~((c("o_orderstatus") == "P") & (c("l_linenumber") == 4)), c("o_custkey"))
        .cast("string")
        .alias("customer_id"),
        F.when(accepted & (c("l_linenumber") == 7), "2024-13-01")
        .when(accepted & (c("l_linenumber") == 6), "abcd-ef-gh")
        .otherwise(day)
        .alias("invoice_date"),
        c("l_partkey").cast("string").alias("product_id"),
        F.when((c("l_returnflag") == "N") & (c("l_linenumber") == 5), "abc")
        .otherwise(c("l_quantity").cast("decimal(18,4)").cast("string"))
        .alias("quantity"),
        c("l_extendedprice").cast("decimal(18,4)").cast("string").alias("revenue"),
        c("l_suppkey").cast("string").alias("store_id"),
        F.year("o_orderdate").alias("year"),
    )


RAW_SALES = """
raw_sales AS (
  SELECT o_orderkey AS invoice_id, l_partkey AS product_id, l_suppkey AS store_id,
         CASE WHEN NOT (o_orderstatus = 'P' AND l_linenumber = 4) THEN o_custkey END AS customer_id,
         CAST(o_orderdate AS DATE) AS day, l_quantity AS quantity, l_extendedprice AS revenue,
         l_returnflag = 'A' AND l_linenumber IN (6, 7) AS bad_date,
         l_returnflag = 'N' AND l_linenumber = 5 AS bad_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
good_sales AS (
  SELECT * FROM raw_sales WHERE customer_id IS NOT NULL AND NOT bad_date AND NOT bad_quantity)"""


def raw_products(spark: SparkSession, directory: str) -> DataFrame:
    size = F.col("unit_size")
    wrong = (F.col("category") == "spare_parts") & (F.col("p_size") > 45)
    clean = star.products(star.read(spark, directory, "part"))
    sizes = star.read(spark, directory, "part").select("p_partkey", "p_size")
    return clean.join(sizes, F.col("p_partkey") == F.col("product_id")).select(
        F.col("product_id").cast("string").alias("product_id"),
        "product_name",
        "brand",
        F.when(wrong, "gift").otherwise(F.col("category")).alias("category"),
        F.when(size != 1, size).cast("string").alias("unit_size"),
    )


def raw_customers(spark: SparkSession, directory: str) -> DataFrame:
    """Customers with the opt-in flags as they come, 2 included."""
    raw = star.read(spark, directory, "customer")
    flags = {"opt_email": 0, "opt_sms": 1, "opt_phone": 2}
    return raw.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_group"),
        *[
            F.lit(None).cast("string").alias(n)
            for n in ("city", "created_date", "email", "mobile_number")
        ],
        *[star.raw_opt_flag(k).cast("string").alias(n) for n, k in flags.items()],
    )


def bad_rows(spark: SparkSession, directory: str) -> DataFrame:
    parts = [
        quality.reason_counts(raw_sales(spark, directory), quality.sales_rules(), "sales"),
        quality.reason_counts(raw_products(spark, directory), quality.product_rules(), "products"),
        quality.reason_counts(
            raw_customers(spark, directory), quality.customer_rules(), "customers"
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


RULES = {
    "sales": "missing_invoice_id missing_customer_id bad_customer_id missing_invoice_date bad_date "
    "missing_product_id bad_product_id missing_quantity bad_quantity missing_revenue bad_revenue "
    "bad_store_id",
    "products": "missing_product_id bad_product_id missing_product_name missing_brand "
    "missing_category bad_unit_size bad_category missing_unit_size",
    "customers": "missing_customer_id bad_customer_id bad_date bad_opt_flag",
}
RULE_ROWS = ", ".join(f"('{t}', '{rule}')" for t, names in RULES.items() for rule in names.split())

BAD_ROWS_SQL = with_tables(
    RAW_SALES,
    """
counted AS (
  SELECT 'sales' AS t, 'bad_date' AS r, count(*) AS n FROM raw_sales WHERE bad_date
  UNION ALL SELECT 'sales', 'bad_quantity', count(*) FROM raw_sales WHERE bad_quantity
  UNION ALL SELECT 'sales', 'missing_customer_id', count(*) FROM raw_sales WHERE customer_id IS NULL
  UNION ALL SELECT 'products', 'bad_category', count(*) FROM part WHERE p_type = 'LARGE' AND p_size > 45
  UNION ALL SELECT 'products', 'missing_unit_size', count(*) FROM part
            WHERE p_type IN ('STANDARD', 'SMALL', 'MEDIUM') AND p_size = 1
  UNION ALL SELECT 'customers', 'bad_opt_flag', count(*) FROM customer)""",
    query="SELECT table_name, rule, coalesce(n, 0) AS n FROM (VALUES " + RULE_ROWS + ") v(table_name, rule) "
    "LEFT JOIN counted ON t = table_name AND r = rule",
)


def quarantined(spark: SparkSession, directory: str) -> DataFrame:
    bad = quality.split(raw_sales(spark, directory), SALES, quality.sales_rules()).quarantine
    return bad.select(
        "invoice_id", "product_id", F.array_join(quality.REASONS, "; ").alias("reasons")
    )


def clean_products(spark: SparkSession, directory: str) -> DataFrame:
    clean = quality.split(raw_products(spark, directory), PRODUCTS, quality.product_rules()).clean
    return doubles(clean, "unit_size")


def clean_customers(spark: SparkSession, directory: str) -> DataFrame:
    """Flags that cannot be read are cleared first, so that rows pass."""
    flags = {f: F.when(F.col(f).isin("0", "1"), F.col(f)) for f in quality.OPT_FLAGS}
    rows = raw_customers(spark, directory).withColumns(flags)
    clean = quality.split(rows, CUSTOMERS, quality.customer_rules()).clean
    return clean.select("customer_id", "customer_name", "customer_group", *quality.OPT_FLAGS)


def repeated_master(t: star.Tables) -> DataFrame:
    """The master with one group delivered twice and some names in capitals."""
    base = t.customers.select("customer_id", "customer_name", "customer_group", "city")
    again = base.where(F.col("customer_group") == "BUILDING")
    changed = base.where(F.col("city").isin("NATION_3", "NATION_7")).withColumn(
        "customer_name", F.upper("customer_name")
    )
    return base.unionByName(again).unionByName(changed)


REPEATED = """
delivered AS (
  SELECT customer_id, customer_name, customer_group, city FROM customers
  UNION ALL SELECT customer_id, customer_name, customer_group, city FROM customers
            WHERE customer_group = 'BUILDING'
  UNION ALL SELECT customer_id, upper(customer_name), customer_group, city FROM customers
            WHERE city IN ('NATION_3', 'NATION_7')),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_name) AS place
  FROM delivered)"""


def orphan_keys(t: star.Tables) -> DataFrame:
    """Orphans against masters that lack a group and a category."""
    return quality.orphan_keys(
        t.sales,
        t.customers.where(F.col("customer_group") != "MACHINERY"),
        t.products.where(F.col("category") != "spare_parts"),
    )


def without_orphans(t: star.Tables) -> DataFrame:
    bad = quality.without_orphans(
        t.sales,
        t.customers.where(F.col("customer_group") != "MACHINERY"),
        t.products.where(F.col("category") != "spare_parts"),
    ).quarantine
    return bad.select(
        "invoice_id", "customer_id", "product_id", F.array_join(quality.REASONS, "; ").alias("reasons")
    )


# -- client masters -----------------------------------------------------------


def clients_with_phone(spark: SparkSession, directory: str) -> DataFrame:
    """Customers with a number that some of them share."""
    return star.read(spark, directory, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("city"),
        F.floor(F.col("c_acctbal") / 10).cast("long").cast("string").alias("mobile_number"),
    )


PHONES = """
phoned AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS city,
         CAST(CAST(floor(c_acctbal / 10) AS BIGINT) AS VARCHAR) AS mobile_number FROM customer),
firsts AS (SELECT customer_id, min(invoice_date) AS first_purchase FROM sales GROUP BY 1),
merged AS (
  SELECT customer_id, mobile_number,
         first(customer_id) OVER w AS survivor_id, first(first_purchase) OVER w AS first_purchase,
         count(*) OVER (PARTITION BY mobile_number) AS n
  FROM phoned LEFT JOIN firsts USING (customer_id)
  WINDOW w AS (PARTITION BY mobile_number ORDER BY first_purchase NULLS LAST, customer_id))"""


def merged(spark: SparkSession, directory: str) -> DataFrame:
    firsts = tables(spark, directory).sales.groupBy("customer_id").agg(
        F.min("invoice_date").alias("first_purchase")
    )
    return quality.merge_map(clients_with_phone(spark, directory), firsts)


def merge_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    sales = tables(spark, directory).sales
    rows = quality.merge_duplicates(sales, merged(spark, directory))
    return rows.withColumns({c: F.col(c).cast("double") for c in ("quantity", "revenue")})


def upsert_clients(spark: SparkSession, directory: str) -> DataFrame:
    """Orders read as client updates: by id, by phone alone, or for new ids."""
    c = F.col
    updates = star.read(spark, directory, "orders").select(
        F.when(c("o_orderstatus") == "F", c("o_custkey"))
        .when(c("o_orderstatus") == "O", c("o_custkey") + 1000000000)
        .alias("customer_id"),
        F.lit(None).cast("string").alias("customer_name"),
        c("o_orderpriority").alias("city"),
        F.floor(c("o_totalprice") / 100).cast("long").cast("string").alias("mobile_number"),
        c("o_orderdate").alias("updated_at"),
    )
    return quality.upsert_clients(clients_with_phone(spark, directory), updates)


UPSERT_SQL = with_tables(
    PHONES,
    """
owners AS (SELECT mobile_number, min(customer_id) AS owner_id FROM phoned GROUP BY 1),
updates AS (
  SELECT CASE o_orderstatus WHEN 'F' THEN o_custkey WHEN 'O' THEN o_custkey + 1000000000 END AS given_id,
         o_orderpriority AS city, CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR) AS mobile_number,
         o_orderdate AS updated_at FROM orders),
addressed AS (
  SELECT u.*, coalesce(given_id, owner_id) AS id,
         CASE WHEN coalesce(given_id, owner_id) IS NULL THEN u.mobile_number END AS new_phone
  FROM updates u LEFT JOIN owners o ON o.mobile_number = u.mobile_number),
newest AS (
  SELECT * FROM addressed QUALIFY row_number() OVER (
    PARTITION BY id, new_phone ORDER BY updated_at DESC, city DESC, mobile_number DESC) = 1)""",
    query="SELECT coalesce(p.customer_id, n.id) AS customer_id, p.customer_name, "
    "coalesce(n.city, p.city) AS city, coalesce(n.mobile_number, p.mobile_number) AS mobile_number, "
    "CASE WHEN n.city IS NULL THEN 'kept' WHEN p.customer_id IS NULL THEN 'created' ELSE 'updated' END AS action "
    "FROM phoned p FULL JOIN newest n ON n.id = p.customer_id",
)


# -- files and stores ---------------------------------------------------------


def landed_sales(spark: SparkSession, directory: str) -> str:
    """The sales with faults, written as one CSV folder per year."""
    folder = store.shared_folder(spark, "landing")
    raw_sales(spark, directory).write.partitionBy("year").option("header", True).csv(folder)
    return folder


def read_sales_years(spark: SparkSession, directory: str) -> DataFrame:
    clean = files.read_sales_years(spark, landed_sales(spark, directory), "year=*", "folder").clean
    return doubles(clean, "quantity", "revenue")


def landed_masters(spark: SparkSession, directory: str, folder: str) -> str:
    """Both masters as CSV folders: some ids again under another name, some flags
    unreadable, and some clients lacking."""
    c = F.col
    clients = tables(spark, directory).customers.select(*[c(n).cast("string") for n in CUSTOMERS.names])
    number = c("customer_id").cast("long")
    flag = F.when(number % 7 == 0, "2").otherwise(c("opt_sms"))
    clients = clients.where(number % 11 != 0).withColumn("opt_sms", flag)
    again = clients.where(number % 10 == 0).withColumn("customer_name", F.concat(F.lit("~"), "customer_name"))
    files.export_csv(clients.unionByName(again), f"{folder}/{files.CUSTOMER_FILE}")
    items = raw_products(spark, directory)
    named = F.concat(F.lit("~"), "product_name")
    twice = items.where(c("product_id").cast("long") % 10 == 0).withColumn("product_name", named)
    files.export_csv(items.unionByName(twice), f"{folder}/{files.PRODUCT_FILE}")
    return folder


def read_products(spark: SparkSession, directory: str) -> DataFrame:
    folder = landed_masters(spark, directory, store.shared_folder(spark, "masters"))
    return doubles(files.read_products(spark, folder, "folder").clean.drop("file"), "unit_size")


def read_customers(spark: SparkSession, directory: str) -> DataFrame:
    folder = landed_masters(spark, directory, store.shared_folder(spark, "masters"))
    clean = files.read_customers(spark, folder, "folder").clean
    return clean.select("customer_id", "customer_name", "customer_group", "city", *quality.OPT_FLAGS)


def load_summary_all(spark: SparkSession, directory: str) -> DataFrame:
    """Sales by year and both masters, repeated and unknown ids noted."""
    folder = landed_masters(spark, directory, landed_sales(spark, directory))
    kinds = [files.SALES_KIND._replace(pattern="year=*"), *files.KINDS[1:]]
    return files.full_load_summary(spark, folder, kinds, "folder")


LOADED_SQL = with_tables(
    RAW_SALES,
    """
clients AS (
  SELECT c_custkey AS id, c_custkey % 7 = 0 AS bad, 1 + CAST(c_custkey % 10 = 0 AS INTEGER) AS times
  FROM customer WHERE c_custkey % 11 <> 0),
items AS (
  SELECT p_partkey AS id, p_type = 'LARGE' AND p_size > 45 AS gift,
         p_type NOT IN ('ECONOMY', 'PROMO', 'LARGE') AND p_size = 1 AS unsized,
         1 + CAST(p_partkey % 10 = 0 AS INTEGER) AS times
  FROM part)""",
    query="""
SELECT 'year=' || year(day) AS file, 'Transactions' AS kind, count(*) AS rows,
       count(*) FILTER (customer_id IS NOT NULL AND NOT bad_date AND NOT bad_quantity) AS imported,
       'Processed' AS status, concat_ws('; ',
         nullif(count(*) FILTER (bad_date), 0) || ' bad_date',
         nullif(count(*) FILTER (bad_quantity), 0) || ' bad_quantity',
         nullif(count(*) FILTER (customer_id IS NULL), 0) || ' missing_customer_id',
         nullif(count(*) FILTER (good AND lost_client), 0) || ' unknown_customer_id',
         nullif(count(*) FILTER (good AND lost_item), 0) || ' unknown_product_id') AS note
FROM (SELECT r.*, customer_id IS NOT NULL AND NOT bad_date AND NOT bad_quantity AS good,
             c.id IS NULL AS lost_client, i.id IS NULL AS lost_item
      FROM raw_sales r LEFT JOIN clients c ON c.id = customer_id AND NOT c.bad
      LEFT JOIN items i ON i.id = product_id AND NOT gift AND NOT unsized)
GROUP BY year(day)
UNION ALL
SELECT 'customers_master.csv', 'Clients', CAST(sum(times) AS BIGINT), count(*) FILTER (NOT bad), 'Processed',
       concat_ws('; ', nullif(CAST(sum(times) FILTER (bad) AS BIGINT), 0) || ' bad_opt_flag',
         nullif(count(*) FILTER (NOT bad AND times = 2), 0) || ' duplicate_id')
FROM clients
UNION ALL
SELECT 'products_master.csv', 'Products', CAST(sum(times) AS BIGINT), count(*) FILTER (NOT gift AND NOT unsized), 'Processed',
       concat_ws('; ', nullif(CAST(sum(times) FILTER (gift) AS BIGINT), 0) || ' bad_category',
         nullif(CAST(sum(times) FILTER (unsized) AS BIGINT), 0) || ' missing_unit_size',
         nullif(count(*) FILTER (NOT gift AND NOT unsized AND times = 2), 0) || ' duplicate_id')
FROM items""",
)


def load_summary(spark: SparkSession, directory: str) -> DataFrame:
    return files.sales_load_summary(spark, landed_sales(spark, directory), "year=*", "folder")


def upload_failures(spark: SparkSession, directory: str) -> DataFrame:
    """The load results of refused files: one year came again without quantities."""
    folder = landed_sales(spark, directory)
    lacking = raw_sales(spark, directory).where(F.col("year") == 2000).drop("quantity", "year")
    lacking.write.option("header", True).csv(f"{folder}/year=2000-again")
    return files.upload_failures(files.sales_load_summary(spark, folder, "year=*", "folder"))


def export_csv(spark: SparkSession, directory: str) -> DataFrame:
    """The customer list after a round trip through its CSV export."""
    listed = monthly.customer_list(
        snapshot(spark, directory, 1), tables(spark, directory).customers, LATEST
    )
    folder = store.shared_folder(spark, "export")
    files.export_csv(listed, folder)
    return spark.read.schema(listed.schema).option("header", True).option("escape", '"').csv(folder)


def stored_snapshot(spark: SparkSession, directory: str) -> DataFrame:
    """Twelve months written, the newest one written again, and read back."""
    folder = store.shared_folder(spark, "snapshot")
    store.write_snapshot(snapshot(spark, directory, 12), folder)
    store.write_snapshot(snapshot(spark, directory, 1), folder)
    return store.read_snapshot(spark, folder)


def published(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One report set, made from the stored snapshot and read back from its JSON."""
    t = tables(spark, directory)
    folder = store.shared_folder(spark, "report")
    store.write_snapshot(snapshot(spark, directory), f"{folder}/snapshot")
    stored = store.read_snapshot(spark, f"{folder}/snapshot")
    rows = store.report_sets(stored, t.sales, t.products, t.customers, LATEST)[name]
    store.write_report_json({name: rows}, folder)
    return store.read_report_json(spark, folder, name, rows.schema)


def report_set(name: str):
    return lambda spark, directory: published(spark, directory, name)


def report_json(spark: SparkSession, directory: str) -> DataFrame:
    """The nested monthly set, one column per figure."""
    figures = F.col("kpi_by_tier")
    return published(spark, directory, "monthly").select(
        "month",
        "total_customers",
        "avg_tenure_months",
        *[F.col("tier_mix")[t].alias(f"n_{t.lower()}") for t in VALUE_TIERS],
        *[F.col("events")[e].alias(e.lower()) for e in EVENTS],
        *[F.col("activity")[s].alias(monthly.column_name(s)) for s in STATUSES],
        *[
            figures[t][mean].alias(f"{t.lower()}_{mean}")
            for t in VALUE_TIERS
            for mean in ("n", *monthly.TIER_MEANS)
        ],
    )


def published_sql(mean: str) -> str:
    return f"CAST(round(CAST(round({mean}, 6) AS DECIMAL(18,6)), 1) AS DOUBLE)"


# -- streams ------------------------------------------------------------------


FIRST_LATEST = date(2001, 6, 30)


def refreshed(
    spark: SparkSession, directory: str, process=arrival.refresh_on_arrival
) -> arrival.Refresh:
    """Sales landed in four drops, from eleven stored months to the full twelve.

    The second has its columns in another order and late lines of all years, the
    third brings a new month and a file without quantities, and the fourth the rest
    with lines dated far ahead.
    """
    t = tables(spark, directory)
    folder = store.shared_folder(spark, "arrival")
    # Lines and orders are joined once; every drop is then a scan of the result.
    t.sales.select(*SALES.names).write.parquet(f"{folder}/delivered")
    delivered = spark.read.schema(t.sales.select(*SALES.names).schema).parquet(f"{folder}/delivered")
    rows = delivered.select(*[F.col(n).cast("string") for n in SALES.names])
    late, new = F.col("quantity").cast("double") > 40, F.col("invoice_date") >= "2001-07-01"
    last = F.col("invoice_date") >= "2001-07-20"
    start = replace(PARAMS, latest=FIRST_LATEST, months=PARAMS.months - 1)
    refresh = arrival.Refresh(spark, folder, t.products, t.customers, start, "folder")
    misdated = rows.where("invoice_date = '2001-07-20'").withColumn("invoice_date", F.lit("2099-07-20"))
    drops = [
        {"first": rows.where(~late & ~new)},
        {"late": rows.where(late & ~new).select(*reversed(SALES.names))},
        {"july": rows.where(new & ~last), "lacking": rows.where(new & last).drop("quantity")},
        {"rest": rows.where(new & last).unionByName(misdated)},
    ]
    for drop in drops:
        for name, part in drop.items():
            files.export_csv(part, f"{folder}/landing/{name}")
        arriving = files.arrivals(spark, f"{folder}/landing/*")
        process(arriving, refresh).awaitTermination()
    return refresh


def refresh_on_arrival(spark: SparkSession, directory: str) -> DataFrame:
    return refreshed(spark, directory).snapshot()


def refused_files(spark: SparkSession, directory: str) -> DataFrame:
    """Files that were refused while the others loaded."""
    return refreshed(spark, directory, arrival.load_on_arrival).refused().drop("batch_id")


def misdated_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Lines that were kept apart for a date too far ahead."""
    refresh = refreshed(spark, directory, arrival.load_on_arrival)
    kept = spark.read.parquet(refresh.path("quarantine")).where(F.col("reasons") == "date_ahead")
    numbers = [F.col(n).cast("bigint") for n in ("invoice_id", "customer_id", "product_id")]
    return kept.select(*numbers, "invoice_date", "batch_id")


def change_feed_stream(spark: SparkSession, directory: str) -> DataFrame:
    """The events that stand after all four drops, retracted ones left out."""
    return arrival.standing_events(refreshed(spark, directory).feed())


def daily_totals(spark: SparkSession, directory: str) -> DataFrame:
    schema = star.read(spark, directory, "events").schema
    arriving = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(directory)
    )
    folder = store.shared_folder(spark, "daily")
    query = daily.store_daily(daily.daily_totals(daily.purchases(arriving)), folder)
    query.awaitTermination()
    return daily.current_daily(spark, folder)


FEED_SQL = (
    "FROM snap n JOIN snap p ON p.customer_id = n.customer_id AND p.report_mth_eom = "
    "last_day(CAST(date_trunc('month', n.report_mth_eom) - INTERVAL 1 MONTH AS DATE))"
)
CHANGE_SQL = snap_sql(
    "SELECT n.report_mth_eom, n.customer_id, 'client.category_changed' AS event, "
    f"p.value_tier AS before, n.value_tier AS after {FEED_SQL} "
    "WHERE n.value_tier IS DISTINCT FROM p.value_tier UNION ALL "
    "SELECT n.report_mth_eom, n.customer_id, 'client.became_inactive', p.activity_status, "
    f"n.activity_status {FEED_SQL} WHERE p.activity_status = 'Active' "
    "AND n.activity_status = 'Not Active'"
)

ENTRIES: dict[str, Entry] = {
    "bad_rows": Entry(bad_rows, BAD_ROWS_SQL),
    "quarantine": Entry(
        quarantined,
        with_tables(
            RAW_SALES,
            query="SELECT CAST(invoice_id AS VARCHAR) AS invoice_id, CAST(product_id AS VARCHAR) AS product_id, "
            "concat_ws('; ', CASE WHEN customer_id IS NULL THEN 'missing_customer_id' END, "
            "CASE WHEN bad_date THEN 'bad_date' END, CASE WHEN bad_quantity THEN 'bad_quantity' END) AS reasons "
            "FROM raw_sales WHERE customer_id IS NULL OR bad_date OR bad_quantity",
        ),
    ),
    "clean_products": Entry(
        clean_products,
        canonical(
            "SELECT product_id, product_name, brand, category, CAST(unit_size AS DOUBLE) AS unit_size "
            "FROM products JOIN part ON p_partkey = product_id "
            "WHERE NOT (category = 'spare_parts' AND p_size > 45) "
            "AND NOT (category = 'consumable' AND unit_size = 1)"
        ),
    ),
    "clean_customers": Entry(
        clean_customers,
        canonical(
            "SELECT customer_id, customer_name, customer_group, opt_email, opt_sms, opt_phone FROM customers"
        ),
    ),
    "duplicate_key": Entry(
        on_tables(lambda t: quality.one_per_key(repeated_master(t), "customer_id").clean),
        with_tables(
            REPEATED,
            query="SELECT customer_id, customer_name, customer_group, city FROM placed WHERE place = 1",
        ),
    ),
    "duplicate_key_rest": Entry(
        on_tables(lambda t: quality.one_per_key(repeated_master(t), "customer_id").quarantine),
        with_tables(
            REPEATED,
            query="SELECT customer_id, customer_name, customer_group, city, count(*) AS copies "
            "FROM placed WHERE place > 1 GROUP BY 1, 2, 3, 4",
        ),
    ),
    "duplicate_key_counts": Entry(
        on_tables(lambda t: quality.duplicate_keys(repeated_master(t), "customer_id")),
        with_tables(
            REPEATED,
            query="SELECT customer_id, count(*) AS n_rows FROM delivered GROUP BY 1 HAVING count(*) > 1",
        ),
    ),
    "orphan_keys": Entry(
        on_tables(orphan_keys),
        canonical(
            "SELECT 'customer_id' AS key_name, customer_id AS key, count(*) AS n_lines "
            "FROM sales JOIN customers USING (customer_id) WHERE customer_group = 'MACHINERY' GROUP BY 2 "
            "UNION ALL SELECT 'product_id', product_id, count(*) FROM sales JOIN products USING (product_id) "
            "WHERE category = 'spare_parts' GROUP BY 2"
        ),
    ),
    "orphan_lines": Entry(
        on_tables(without_orphans),
        canonical(
            "SELECT invoice_id, customer_id, product_id, concat_ws('; ', "
            "CASE WHEN customer_group = 'MACHINERY' THEN 'orphan_customer_id' END, "
            "CASE WHEN category = 'spare_parts' THEN 'orphan_product_id' END) AS reasons "
            "FROM sales JOIN customers USING (customer_id) JOIN products USING (product_id) "
            "WHERE customer_group = 'MACHINERY' OR category = 'spare_parts'"
        ),
    ),
    "grain_check": Entry(
        on_tables(lambda t: quality.grain_check(t.sales)),
        canonical(
            "SELECT invoice_id, product_id, count(*) AS n_lines FROM sales "
            "GROUP BY 1, 2 HAVING count(*) > 1"
        ),
    ),
    "returns_rate": Entry(
        on_tables(lambda t: rounded(quality.returns_rate(t.sales), "return_pct")),
        canonical(
            "SELECT count(*) FILTER (quantity > 0) AS positive_lines, "
            "count(*) FILTER (quantity < 0) AS return_lines, "
            "round(CAST(count(*) FILTER (quantity < 0) AS DOUBLE) / count(*) FILTER (quantity > 0) * 100, 6) "
            "AS return_pct FROM sales"
        ),
    ),
    "anonymous_leak": Entry(
        lambda spark, d: quality.anonymous_leak(
            snapshot(spark, d), tables(spark, d).customers, star.ANONYMOUS
        ),
        snap_sql(
            "SELECT count(*) AS in_master, count(s.customer_id) AS in_snapshot FROM customers "
            "LEFT JOIN (SELECT DISTINCT customer_id FROM snap) s USING (customer_id) "
            "WHERE lower(customer_group) = 'household'"
        ),
    ),
    "merge_map": Entry(
        merged,
        with_tables(
            PHONES,
            query="SELECT customer_id, survivor_id, mobile_number, first_purchase FROM merged WHERE n > 1",
        ),
    ),
    "merge_duplicates": Entry(
        merge_duplicates,
        with_tables(
            PHONES,
            query="SELECT survivor_id AS customer_id, invoice_id, product_id, invoice_date, store_id, "
            "CAST(quantity AS DOUBLE) AS quantity, CAST(revenue AS DOUBLE) AS revenue "
            "FROM sales JOIN merged USING (customer_id)",
        ),
    ),
    "upsert_clients": Entry(upsert_clients, UPSERT_SQL),
    "read_sales_years": Entry(
        read_sales_years,
        with_tables(
            RAW_SALES,
            query="SELECT CAST(invoice_id AS VARCHAR) AS invoice_id, customer_id, day AS invoice_date, product_id, "
            "quantity, revenue, store_id, 'year=' || year(day) AS file FROM good_sales",
        ),
    ),
    "load_summary": Entry(
        load_summary,
        with_tables(
            RAW_SALES,
            query="SELECT 'year=' || year(day) AS file, 'Transactions' AS kind, count(*) AS rows, "
            "count(*) FILTER (customer_id IS NOT NULL AND NOT bad_date AND NOT bad_quantity) AS imported, "
            "'Processed' AS status, concat_ws('; ', "
            "nullif(count(*) FILTER (bad_date), 0) || ' bad_date', "
            "nullif(count(*) FILTER (bad_quantity), 0) || ' bad_quantity', "
            "nullif(count(*) FILTER (customer_id IS NULL), 0) || ' missing_customer_id') AS note "
            "FROM raw_sales GROUP BY year(day)",
        ),
    ),
    "upload_failures": Entry(
        upload_failures,
        "SELECT 'year=2000-again' AS file, 'Transactions' AS kind, count(*) AS rows, "
        "CAST(0 AS BIGINT) AS imported, 'Failed' AS status, 'missing columns: quantity' AS note "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = 2000",
    ),
    "export_csv": Entry(export_csv, snap_sql(LIST_SQL)),
    "stored_snapshot": Entry(stored_snapshot, snap_sql(f"SELECT {SNAPSHOT_LIST} FROM snap")),
    "report_json": Entry(
        report_json,
        snap_sql(
            "SELECT report_mth_eom AS month, count(*) AS total_customers, "
            f"{published_sql('avg(tenure_months)')} AS avg_tenure_months, "
            + ", ".join(
                f"count(*) FILTER (value_tier = '{t}') AS n_{t.lower()}, "
                f"nullif(count(*) FILTER (value_tier = '{t}'), 0) AS {t.lower()}_n, "
                + ", ".join(
                    published_sql(f"avg({source}) FILTER (value_tier = '{t}')")
                    + f" AS {t.lower()}_{mean}"
                    for mean, source in monthly.TIER_MEANS.items()
                )
                for t in VALUE_TIERS
            )
            + ", "
            + ", ".join(
                f"count(*) FILTER (lifecycle_event = '{e}') AS {e.lower()}" for e in EVENTS
            )
            + ", count(*) FILTER (activity_status = 'Active') AS active, "
            "count(*) FILTER (activity_status = 'Not Active') AS not_active "
            "FROM snap GROUP BY 1"
        ),
    ),
    "report_json_customers": Entry(
        report_set("customers"),
        snap_sql(
            f"SELECT * REPLACE ({published_sql('amc')} AS amc, {published_sql('aos')} AS aos) FROM ({LIST_SQL})"
        ),
    ),
    "report_json_months": Entry(
        report_set("report_months"), snap_sql("SELECT DISTINCT report_mth_eom FROM snap")
    ),
    "report_json_latest": Entry(
        report_set("latest_month"), snap_sql("SELECT max(report_mth_eom) AS report_mth_eom FROM snap")
    ),
    "report_json_brands": Entry(
        report_set("brand_units"),
        canonical(
            "SELECT brand, CAST(round(sum(quantity * coalesce(unit_size, 1)), 0) AS BIGINT) AS units "
            "FROM sales JOIN products USING (product_id) "
            "WHERE quantity > 0 AND category = 'consumable' GROUP BY 1"
        ),
    ),
    "report_json_categories": Entry(
        report_set("category_lines"),
        canonical(
            "SELECT category, count(*) AS n_lines FROM sales JOIN products USING (product_id) "
            "WHERE quantity > 0 GROUP BY 1"
        ),
    ),
    "read_products": Entry(
        read_products,
        canonical(
            "SELECT product_id, product_name, brand, category, CAST(unit_size AS DOUBLE) AS unit_size "
            "FROM products JOIN part ON p_partkey = product_id "
            "WHERE NOT (category = 'spare_parts' AND p_size > 45) "
            "AND NOT (category = 'consumable' AND unit_size = 1)"
        ),
    ),
    "read_customers": Entry(
        read_customers,
        canonical(
            "SELECT customer_id, customer_name, customer_group, city, opt_email, opt_sms, opt_phone "
            "FROM customers WHERE customer_id % 11 <> 0 AND customer_id % 7 <> 0"
        ),
    ),
    "load_summary_all": Entry(load_summary_all, LOADED_SQL),
    "change_feed": Entry(on_snapshot(arrival.change_feed), CHANGE_SQL),
    "refresh_on_arrival": Entry(refresh_on_arrival, snap_sql(f"SELECT {SNAPSHOT_LIST} FROM snap")),
    "change_feed_stream": Entry(change_feed_stream, CHANGE_SQL),
    "refused_files": Entry(
        refused_files, "SELECT 'lacking' AS file, 'quantity' AS missing"
    ),
    "misdated_lines": Entry(
        misdated_lines,
        canonical(
            "SELECT invoice_id, customer_id, product_id, '2099-07-20' AS invoice_date, "
            "CAST(3 AS INTEGER) AS batch_id FROM sales WHERE invoice_date = DATE '2001-07-20'"
        ),
    ),
    "daily_rollup_stream": Entry(
        lambda spark, d: doubles(daily_totals(spark, d), "amount"),
        "SELECT CAST(ts AS DATE) AS day, user_id AS customer_id, "
        "CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS amount, "
        "count(*) AS purchases FROM events WHERE event_type = 'purchase' GROUP BY 1, 2",
    ),
    "monthly_from_daily": Entry(
        lambda spark, d: doubles(daily.monthly_from_daily(daily_totals(spark, d)), "amount"),
        "SELECT user_id AS customer_id, CAST(date_trunc('month', ts) AS DATE) AS month, "
        "CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS amount, count(*) AS purchases FROM events "
        "WHERE event_type = 'purchase' GROUP BY 1, 2",
    ),
}
