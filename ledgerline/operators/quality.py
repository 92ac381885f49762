"""Load-time rules: good rows typed, bad rows kept apart with their reasons.

Input columns are text, as files land. ``checked`` adds the reasons that apply
to a row; ``split`` gives the typed clean rows and the quarantine.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.shape import busy_buckets, spread_join
from ledgerline.params import CATEGORIES
from ledgerline.schemas import CUSTOMERS, PRODUCTS, SALES

REASONS = "reasons"
COPIES = "copies"
OPT_FLAGS = ("opt_email", "opt_sms", "opt_phone")
# Fixed value: the date format of all input files, up to the very end of the text.
DAY = r"^\d{4}-\d{2}-\d{2}\z"


class Checked(NamedTuple):
    clean: DataFrame
    quarantine: DataFrame


def typed(field: T.StructField) -> Column:
    """The column in its declared type; NULL where the text does not fit.

    A cast reads a well-formed day many times faster than a date pattern, and
    rules read it several times a row.
    """
    value = F.col(field.name).try_cast(field.dataType)
    if isinstance(field.dataType, T.DateType):
        return F.when(F.col(field.name).rlike(DAY), value)
    return value


def unreadable(field: T.StructField) -> Column:
    return F.col(field.name).isNotNull() & typed(field).isNull()


def type_rules(schema: T.StructType) -> dict[str, Column]:
    """Required columns present, and every given value of its declared type."""
    rules = {}
    for f in schema:
        if not f.nullable:
            rules[f"missing_{f.name}"] = F.col(f.name).isNull()
        if isinstance(f.dataType, T.DateType):
            rules["bad_date"] = rules.get("bad_date", F.lit(False)) | unreadable(f)
        elif not isinstance(f.dataType, T.StringType) and f.name not in OPT_FLAGS:
            rules[f"bad_{f.name}"] = unreadable(f)
    return rules


def sales_rules() -> dict[str, Column]:
    return type_rules(SALES)


def product_rules() -> dict[str, Column]:
    """``zero_unit_size`` is a warning: such buyers count as not active."""
    category, size = F.col("category"), F.col("unit_size")
    return {
        **type_rules(PRODUCTS),
        "bad_category": category.isNotNull() & ~category.isin(*CATEGORIES),
        "missing_unit_size": (category == "consumable") & size.isNull(),
    }


def zero_unit_size(products: DataFrame) -> DataFrame:
    return products.where((F.col("category") == "consumable") & (F.col("unit_size") == 0))


def customer_rules() -> dict[str, Column]:
    bad_flag = F.lit(False)
    for flag in OPT_FLAGS:
        value = F.col(flag).try_cast("int")
        bad_flag = bad_flag | (
            F.col(flag).isNotNull() & ~F.coalesce(value.isin(0, 1), F.lit(False))
        )
    return {**type_rules(CUSTOMERS), "bad_opt_flag": bad_flag}


def checked(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    reasons = F.array_compact(
        F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    )
    return rows.withColumn(REASONS, reasons)


def split(rows: DataFrame, schema: T.StructType, rules: dict[str, Column]) -> Checked:
    marked = checked(rows, rules)
    extra = [c for c in rows.columns if c not in schema.names]
    good = marked.where(F.size(REASONS) == 0)
    clean = good.select(*[typed(f).alias(f.name) for f in schema], *extra)
    return Checked(clean, marked.where(F.size(REASONS) > 0))


def reason_counts(rows: DataFrame, rules: dict[str, Column], table: str) -> DataFrame:
    """One row per rule with the number of rows that break it, zeros included."""
    wide = rows.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return wide.withColumn("table_name", F.lit(table)).unpivot(
        ["table_name"], [*rules], "rule", "n"
    )


def one_per_key(rows: DataFrame, key: str) -> Checked:
    """Keep the smallest row of each key; the others go to quarantine.

    Equal rows are first counted, so the quarantine has a ``copies`` column
    instead of repeated rows. Ranking by window would send all rows of one
    repeated key to one task; both groupings here combine before shuffling.
    """
    fields = [c for c in rows.columns if c != key]
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(COPIES))
    row = F.struct(*fields)
    winners = counted.groupBy(key).agg(
        F.min(row).alias("winner"), F.sum(COPIES).alias("n_rows")
    )
    clean = winners.select(key, *[F.col(f"winner.{c}").alias(c) for c in fields]).select(
        *rows.columns
    )
    repeated = winners.where(F.col("n_rows") > 1).drop("n_rows")
    won = F.col("winner").eqNullSafe(row)
    rest = (
        spread_join(counted, repeated, key, busy=busy_buckets(rows, key))
        .withColumn(COPIES, F.col(COPIES) - won.cast("long"))
        .where(F.col(COPIES) > 0)
        .drop("winner")
    )
    return Checked(clean, rest)


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    return (
        rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def orphan_keys(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Sales keys absent from a master, with their number of lines.

    Lines are counted per key before the anti join, so it sees each key once.
    """

    def missing(key: str, master: DataFrame) -> DataFrame:
        return (
            sales.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n_lines"))
            .join(master.select(key), key, "left_anti")
            .select(F.lit(key).alias("key_name"), F.col(key).alias("key"), "n_lines")
        )

    return missing("customer_id", customers).unionByName(missing("product_id", products))


def without_orphans(sales: DataFrame, customers: DataFrame, products: DataFrame) -> Checked:
    """Lines whose keys both exist, and the others with the missing key named.

    A key that a master repeats counts once.
    """
    known_customers = customers.select("customer_id").distinct()
    known_products = products.select("product_id").distinct()
    marked = sales.join(
        known_customers.withColumn("known_customer", F.lit(True)), "customer_id", "left"
    ).join(known_products.withColumn("known_product", F.lit(True)), "product_id", "left")
    reasons = F.array_compact(
        F.array(
            F.when(F.col("known_customer").isNull(), F.lit("orphan_customer_id")),
            F.when(F.col("known_product").isNull(), F.lit("orphan_product_id")),
        )
    )
    marked = marked.withColumn(REASONS, reasons).drop("known_customer", "known_product")
    return Checked(
        marked.where(F.size(REASONS) == 0).drop(REASONS), marked.where(F.size(REASONS) > 0)
    )


def grain_check(sales: DataFrame) -> DataFrame:
    """Invoice and product pairs that occur on several lines; reported, kept."""
    return (
        sales.groupBy("invoice_id", "product_id")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .where(F.col("n_lines") > 1)
    )


def returns_rate(sales: DataFrame) -> DataFrame:
    quantity = F.col("quantity")
    return sales.agg(
        F.count_if(quantity > 0).alias("positive_lines"),
        F.count_if(quantity < 0).alias("return_lines"),
    ).withColumn(
        "return_pct",
        F.when(
            F.col("positive_lines") > 0, F.col("return_lines") / F.col("positive_lines") * 100
        ),
    )


def anonymous_leak(snapshot: DataFrame, customers: DataFrame, marker: str) -> DataFrame:
    """Anonymous customers in the master, and those in the snapshot (must be 0)."""
    anonymous = customers.where(F.lower("customer_group") == marker.lower()).select("customer_id")
    present = snapshot.select("customer_id", F.lit(True).alias("present")).distinct()
    return anonymous.join(present, "customer_id", "left").agg(
        F.count(F.lit(1)).alias("in_master"), F.count("present").alias("in_snapshot")
    )


def load_summary(marked: DataFrame, kind: str) -> DataFrame:
    """Per file: rows, imported rows, status and a note naming the faults.

    ``marked`` has columns ``file`` and ``reasons``. Faults are counted per
    file and reason before they are put together, one entry per reason.
    """
    faults = (
        marked.select("file", F.explode(REASONS).alias("reason"))
        .groupBy("file", "reason")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("file")
        .agg(F.array_sort(F.collect_list(F.struct("reason", "n"))).alias("faults"))
    )
    totals = marked.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size(REASONS) == 0).alias("imported"),
    )
    words = F.transform("faults", lambda x: F.concat_ws(" ", x["n"].cast("string"), x["reason"]))
    return totals.join(faults, "file", "left").select(
        "file",
        F.lit(kind).alias("kind"),
        "rows",
        "imported",
        F.when(F.col("imported") > 0, "Processed").otherwise("Failed").alias("status"),
        F.coalesce(F.array_join(words, "; "), F.lit("")).alias("note"),
    )


# -- client masters -----------------------------------------------------------


def merge_map(clients: DataFrame, first_purchases: DataFrame) -> DataFrame:
    """Clients sharing a phone, mapped to the one that bought first.

    Ties and clients without purchases are settled by the smaller id. The
    survivor of a phone is found by aggregation, not in a window, since one
    placeholder number may be shared by very many clients.
    """
    dated = clients.where(F.col("mobile_number").isNotNull()).join(
        first_purchases.select("customer_id", "first_purchase"), "customer_id", "left"
    )
    known = F.col("first_purchase").isNull().cast("int")
    survivors = dated.groupBy("mobile_number").agg(
        F.min(F.struct(known.alias("late"), "first_purchase", "customer_id")).alias("best"),
        F.count(F.lit(1)).alias("n"),
    )
    shared = spread_join(
        dated.select("customer_id", "mobile_number"),
        survivors.where(F.col("n") > 1),
        "mobile_number",
        busy=busy_buckets(clients, "mobile_number"),
    )
    return shared.select(
        "customer_id",
        F.col("best.customer_id").alias("survivor_id"),
        "mobile_number",
        F.col("best.first_purchase").alias("first_purchase"),
    )


def merge_duplicates(sales: DataFrame, merged: DataFrame) -> DataFrame:
    """Sales with merged clients rewritten to their survivor."""
    moved = merged.where(F.col("customer_id") != F.col("survivor_id"))
    return sales.join(moved.select("customer_id", "survivor_id"), "customer_id", "left").select(
        F.coalesce("survivor_id", "customer_id").alias("customer_id"),
        *[c for c in sales.columns if c != "customer_id"],
    )


def unaddressed_updates(updates: DataFrame) -> DataFrame:
    """Updates that ``upsert_clients`` cannot apply: without id and without phone."""
    lost = F.col("customer_id").isNull() & F.col("mobile_number").isNull()
    return updates.where(lost).withColumn(REASONS, F.array(F.lit("no_id_or_phone")))


def upsert_clients(clients: DataFrame, updates: DataFrame) -> DataFrame:
    """Create or update clients; the newest update of a client wins.

    ``updates`` has the client columns and ``updated_at``. An update belongs
    to the client with its customer_id; without an id, to the smallest id
    that has its phone; and failing that it creates a client under its phone.
    ``unaddressed_updates`` returns those that have neither.
    Non-NULL values of the update replace the client's, others stay.
    """
    fields = [c for c in clients.columns if c != "customer_id"]
    owners = (
        clients.where(F.col("mobile_number").isNotNull())
        .groupBy("mobile_number")
        .agg(F.min("customer_id").alias("owner_id"))
    )
    unnamed = updates.where(F.col("customer_id").isNull())
    by_phone = spread_join(
        unnamed.distinct(),
        owners,
        "mobile_number",
        "left",
        busy=busy_buckets(unnamed, "mobile_number"),
    ).withColumn("customer_id", F.col("owner_id"))
    addressed = updates.where(F.col("customer_id").isNotNull()).unionByName(
        by_phone.drop("owner_id")
    )
    key = F.when(F.col("customer_id").isNull(), F.col("mobile_number"))
    entry = F.struct("updated_at", *fields)
    newest = (
        addressed.withColumn("new_phone", key)
        .where(F.col("customer_id").isNotNull() | F.col("new_phone").isNotNull())
        .groupBy("customer_id", "new_phone")
        .agg(F.max(entry).alias("u"))
    )
    current = clients.select("customer_id", F.struct(*fields).alias("c"))
    merged = current.join(
        newest.where(F.col("customer_id").isNotNull()), "customer_id", "full"
    ).unionByName(
        newest.where(F.col("customer_id").isNull()), allowMissingColumns=True
    )
    action = (
        F.when(F.col("u").isNull(), "kept")
        .when(F.col("c").isNull(), "created")
        .otherwise("updated")
    )
    return merged.select(
        "customer_id",
        *[F.coalesce(F.col(f"u.{f}"), F.col(f"c.{f}")).alias(f) for f in fields],
        action.alias("action"),
    )
