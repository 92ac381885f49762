"""Sales lines joined to products, and their monthly roll-ups.

Joins to the product master carry no broadcast hint: Spark broadcasts the
master when its measured size is below ``spark.sql.autoBroadcastJoinThreshold``
and otherwise sorts and merges, splitting hot products at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calendar import month_no
from ledgerline.params import ORDER_WINDOW, WINDOW_MONTHS, SnapshotParams, month_last_day

# A bigint mask has 63 usable bits: this many report months plus the months
# that their order windows reach back.
MASK_MONTHS = 63 - (ORDER_WINDOW - 1)


def positive_lines(sales: DataFrame, products: DataFrame, *categories: str) -> DataFrame:
    """Lines of the given categories without returns, with their volume."""
    return (
        sales.where(F.col("quantity") > 0)
        .join(products.where(F.col("category").isin(*categories)), "product_id")
        .withColumn("units", F.col("quantity") * F.col("unit_size"))
    )


def consumable_lines(sales: DataFrame, products: DataFrame) -> DataFrame:
    return positive_lines(sales, products, "consumable").select(
        "customer_id",
        F.trunc("invoice_date", "MM").alias("purchase_mth_bom"),
        "invoice_date",
        "invoice_id",
        "units",
    )


def first_device_date(sales: DataFrame, products: DataFrame) -> DataFrame:
    return (
        positive_lines(sales, products, "device")
        .groupBy("customer_id")
        .agg(F.min("invoice_date").alias("first_device_purchase_date"))
    )


def rollup_columns() -> list[Column]:
    consumable = F.col("category") == "consumable"
    return [
        F.sum(F.when(consumable, F.col("units"))).alias("units"),
        F.min(F.when(consumable, F.col("invoice_date"))).alias("first_date"),
        F.max(F.when(consumable, F.col("invoice_date"))).alias("last_date"),
        F.min(F.when(~consumable, F.col("invoice_date"))).alias("device_date"),
    ]


def month_rollup(lines: DataFrame, oldest: int | None = None) -> DataFrame:
    """Customer x month volumes and dates from consumable and device lines.

    Months up to ``oldest`` are folded into it: when no window reaches back
    that far only their total matters, and a long history stays small.
    """
    month = month_no(F.col("invoice_date"))
    if oldest is not None:
        month = F.greatest(month, F.lit(oldest))
    return lines.groupBy("customer_id", month.alias("month")).agg(*rollup_columns())


def invoice_months(lines: DataFrame) -> DataFrame:
    """Customer x invoice x month volumes and dates of consumable and device lines.

    Roll-up and order masks both stand on this one grouping, so the lines are read,
    joined and shuffled once.
    """
    month = month_no(F.col("invoice_date"))
    totals = lines.groupBy("customer_id", "invoice_id", month.alias("month")).agg(*rollup_columns())
    return totals.withColumn("units", F.coalesce("units", F.lit(0).cast("decimal(38,8)")))


def rolled_up(invoices: DataFrame, oldest: int | None = None) -> DataFrame:
    """``month_rollup`` from invoice months."""
    month = F.col("month") if oldest is None else F.greatest("month", F.lit(oldest))
    return invoices.groupBy("customer_id", month.alias("month")).agg(
        F.sum("units").alias("units"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.min("device_date").alias("device_date"),
    )


def consumable_bought() -> Column:
    """Whether an invoice month has consumable lines.

    The first date alone would tell. All columns are named, so that Spark prunes
    none of them here and the exchange of the roll-up serves the masks as well.
    """
    dated = F.col("first_date") <= F.col("last_date")
    return dated & (F.col("units") >= 0) & F.coalesce("device_date", "last_date").isNotNull()


def mask_blocks(first: int, last: int) -> list[tuple[int, int]]:
    """Split report months into runs whose windows fit one bit mask."""
    return [
        (start, min(start + MASK_MONTHS - 1, last))
        for start in range(first, last + 1, MASK_MONTHS)
    ]


def window_orders(lines: DataFrame, first: int, last: int) -> DataFrame:
    """Distinct invoices per customer in the six months to each report month."""
    reached = lines.where(
        (F.col("category") == "consumable")
        & (F.col("invoice_date") > F.lit(month_last_day(first - ORDER_WINDOW)))
    )
    month = month_no(F.col("invoice_date")).alias("month")
    bought = reached.select("customer_id", "invoice_id", month, F.lit(True).alias("bought"))
    return orders_in_windows(bought, first, last, F.col("bought"))


def orders_in_windows(
    invoices: DataFrame, first: int, last: int, bought: Column
) -> DataFrame:
    """The same from rows of customer, invoice and month.

    An invoice id may recur in several months, so monthly counts do not add
    up. Each (customer, invoice) pair becomes one row holding a bit per month
    it occurs in; a report month then counts the pairs with a bit set in its
    window. Both groupings combine before they shuffle, the first one spreads
    a single busy customer over all tasks, and no row is repeated per month.
    """
    blocks = mask_blocks(first, last)
    month = F.col("month")
    reach = ORDER_WINDOW - 1

    def bits(start: int, end: int) -> Column:
        base = start - reach
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), month - base)
        return F.bit_or(F.when(bought & month.between(base, end), bit))

    masks = invoices.groupBy("customer_id", "invoice_id").agg(
        *[bits(*block).alias(f"mask{i}") for i, block in enumerate(blocks)]
    )
    window = (1 << ORDER_WINDOW) - 1
    counts = {
        report: F.count_if(
            F.col(f"mask{i}").bitwiseAND(F.lit(window << (report - start)).cast("bigint"))
            != 0
        )
        for i, (start, end) in enumerate(blocks)
        for report in range(start, end + 1)
    }
    per_customer = masks.groupBy("customer_id").agg(
        *[count.alias(f"r{report}") for report, count in counts.items()]
    )
    cells = F.array(
        *[
            F.struct(F.lit(r).alias("month"), F.col(f"r{r}").alias("o6"))
            for r in counts
        ]
    )
    return per_customer.select(
        "customer_id", F.inline(F.filter(cells, lambda cell: cell["o6"] > 0))
    )


def month_aggregates(lines: DataFrame, params: SnapshotParams) -> DataFrame:
    """One report month's aggregates per customer, by conditional sums.

    Summing per invoice first turns the distinct invoice count into a plain
    count and keeps a busy customer from becoming one heavy group.
    """
    report = params.last_month
    month = month_no(F.col("invoice_date"))
    units = F.col("units")

    def since(k: int) -> Column:
        return month > report - k

    per_invoice = (
        lines.where(F.col("invoice_date") <= params.latest_eom)
        .groupBy("customer_id", "invoice_id")
        .agg(
            F.min("invoice_date").alias("first_date"),
            F.max("invoice_date").alias("last_date"),
            F.sum(units).alias("m_total"),
            *[
                F.sum(F.when(since(k), units)).alias(f"m{k}")
                for k in WINDOW_MONTHS
            ],
            F.bool_or(since(ORDER_WINDOW)).alias("in_window"),
        )
    )
    sums = ["m_total", *[f"m{k}" for k in WINDOW_MONTHS]]
    zero = F.lit(0).cast("decimal(38,8)")
    return per_invoice.groupBy("customer_id").agg(
        F.min("first_date").alias("first_consumable_purchase_date"),
        F.max("last_date").alias("last_consumable_purchase_date"),
        *[F.coalesce(F.sum(s), zero).alias(s) for s in sums],
        F.count_if("in_window").alias("o6"),
    )
