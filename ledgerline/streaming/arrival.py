"""Refresh of stored lines, roll-ups and snapshot as sales files arrive.

The stream only tells which files are new. They are read by their own headers,
so columns may come in any order; a file that lacks a required column is refused
and the others load.

Lines are kept in folders by batch and month, and a manifest names the live ones.
Where months have gathered several folders, they are merged into one before the
next batch, and the manifest switches to it in one rename.

The monthly roll-up is also kept by year: years older than every window only
count with their totals, so a long history is read as one row per customer and
year. No step reads what it overwrites, and all start from the tables as the
batches before left them, so a batch that is run again after a failure leaves the
same tables behind.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ledgerline.functions.calendar import month_no
from ledgerline.operators.lines import month_rollup, positive_lines
from ledgerline.operators.quality import REASONS, sales_rules, split, typed
from ledgerline.operators.shape import any_of
from ledgerline.params import ORDER_WINDOW, WINDOW_MONTHS, SnapshotParams, month_last_day
from ledgerline.plans.monthly import tier_change
from ledgerline.plans.snapshot import snapshot_from_rollup
from ledgerline.schemas import SALES
from ledgerline.sources.files import ARRIVED, MALFORMED, read_text_table, with_shape
from ledgerline.sources.manifest import Manifest, Version
from ledgerline.sources.store import read_snapshot, write_snapshot

# Days that a line may lie ahead of the newest complete month, and of the arrival
# of its file, before it counts as misdated.
AHEAD_DAYS = 366
CLOCK_DAYS = 1
# Folders of one month before they are merged.
MOST_FOLDERS = 8
REFUSED = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("missing", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
EVENT = ["report_mth_eom", "customer_id", "event", "before", "after"]
FEED = T.StructType(
    [
        T.StructField("report_mth_eom", T.DateType()),
        T.StructField("customer_id", T.LongType()),
        *[T.StructField(n, T.StringType()) for n in ("event", "before", "after", "action")],
        T.StructField("batch_id", T.LongType()),
    ]
)
TOTALS = [
    T.StructField("customer_id", T.LongType()),
    T.StructField("units", T.DecimalType(38, 8)),
    T.StructField("first_date", T.DateType()),
    T.StructField("last_date", T.DateType()),
    T.StructField("device_date", T.DateType()),
]
ROLLUP = T.StructType([*TOTALS, T.StructField("month", T.IntegerType())])
YEARLY = T.StructType([*TOTALS, T.StructField("year", T.IntegerType())])


def change_feed(snapshot: DataFrame) -> DataFrame:
    """Category changes and clients turning inactive, month on month."""
    changes = tier_change(snapshot)
    moved = F.struct(
        F.lit("client.category_changed").alias("event"),
        F.col("prev_tier").alias("before"),
        F.col("value_tier").alias("after"),
    )
    stopped = F.struct(
        F.lit("client.became_inactive").alias("event"),
        F.col("prev_status").alias("before"),
        F.col("activity_status").alias("after"),
    )
    went = (F.col("prev_status") == "Active") & (F.col("activity_status") == "Not Active")
    events = F.array_compact(F.array(moved, F.when(went, stopped)))
    return changes.select("report_mth_eom", "customer_id", F.inline(events))


def standing_events(feed: DataFrame) -> DataFrame:
    """The events that hold after all batches of a feed: added and not retracted."""
    weight = F.when(F.col("action") == "added", 1).otherwise(-1)
    return feed.groupBy(*EVENT).agg(F.sum(weight).alias("n")).where(F.col("n") > 0).drop("n")


def feed_difference(before: DataFrame, now: DataFrame) -> DataFrame:
    """Events added and retracted between two versions, nulls equal to nulls.

    Both anti joins are one grouping: an event of both versions adds up to 0.
    """
    weighed = now.withColumn("n", F.lit(1)).unionByName(before.withColumn("n", F.lit(-1)))
    changed = weighed.groupBy(*EVENT).agg(F.sum("n").alias("n")).where(F.col("n") != 0)
    action = F.when(F.col("n") > 0, "added").otherwise("retracted")
    return changed.withColumn("action", action).drop("n")


@dataclass(frozen=True)
class Refresh:
    """Where the tables are kept and what they are computed with."""

    spark: SparkSession
    folder: str
    products: DataFrame
    customers: DataFrame
    params: SnapshotParams
    unit: str = "file"
    ahead_days: int = AHEAD_DAYS
    most_folders: int = MOST_FOLDERS

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    @cached_property
    def manifest(self) -> Manifest:
        return Manifest(self.spark, self.path("manifest"))

    def lines(self, months: list[int] | None = None) -> DataFrame:
        """Live lines; only the folders of the given months are opened."""
        return self.lines_of(self.manifest.read(), months)

    def lines_of(self, version: Version, months: list[int] | None = None) -> DataFrame:
        paths = version.paths(months)
        if not paths:
            return self.spark.createDataFrame([], SALES)
        return self.spark.read.schema(SALES).parquet(*paths)

    def rollup(self) -> DataFrame:
        return self.spark.read.schema(ROLLUP).parquet(self.path("rollup"))

    def yearly(self) -> DataFrame:
        return self.spark.read.schema(YEARLY).parquet(self.path("yearly"))

    def history(self, first: int) -> DataFrame:
        """The roll-up as the months from ``first`` on need it.

        A year that ends before every window of these months is read from the
        yearly roll-up and stands in its last month.
        """
        closed = (first - max(WINDOW_MONTHS) + 1) // 12
        old = self.yearly().where(F.col("year") < closed)
        old = old.withColumn("month", F.col("year") * 12 + 11).drop("year")
        return old.unionByName(self.rollup().where(F.col("month") >= closed * 12))

    def snapshot(self) -> DataFrame:
        return read_snapshot(self.spark, self.path("snapshot"))

    def replace_partitions(self, rows: DataFrame, name: str, *columns: str) -> None:
        (
            rows.hint("rebalance", *columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*columns)
            .parquet(self.path(name))
        )

    def merged(self, version: Version) -> Version:
        """Months of too many folders in one folder each.

        The merged folders are new, so that readers of the old version are not
        disturbed; ``vacuum`` removes what no version needs.
        """
        crowded = sorted(m for m, paths in version.folders.items() if len(paths) > self.most_folders)
        if not crowded:
            return version
        folder = self.path(f"lines/merged-{uuid.uuid4().hex}")
        rows = self.lines_of(version, crowded).withColumn("month", line_month())
        rows.hint("rebalance", "month").write.partitionBy("month").parquet(folder)
        folders = version.folders | {m: [f"{folder}/month={m}"] for m in crowded}
        switched = replace(version, folders=folders)
        self.manifest.commit(switched)
        return switched

    def vacuum(self, replayable: bool = True) -> None:
        """Remove folders of lines that no version in use names.

        Not while a batch or a reader of an older version is at work. Folders that
        the last batch would need to run again stay unless it surely won't.
        """
        live = {path.rsplit("/lines/", 1)[1] for path in self.manifest.live(replayable)}
        stored = self.manifest.subfolders(self.path("lines"), 2)
        self.manifest.remove([p for p in stored if p.rsplit("/lines/", 1)[1] not in live])

    def date_ahead(self, version: Version, arrived: bool) -> Column:
        """A date too far ahead of what is known, or later than its file arrived.

        As a watermark does for late lines, this bounds what one misdated line
        can do: without it, every month up to its date would get a snapshot.
        """
        newest = self.params.last_month if version.newest is None else version.newest
        known = month_last_day(max(newest, self.params.last_month))
        day = typed(SALES["invoice_date"])
        ahead = day > F.date_add(F.lit(known), self.ahead_days)
        if arrived:
            ahead = ahead | (day > F.date_add(F.to_date(ARRIVED), CLOCK_DAYS))
        return F.coalesce(ahead, F.lit(False))

    def store_lines(self, batch: DataFrame, batch_id: int, base: Version) -> list[int]:
        """Write a batch's lines and make them live; the months that it touches."""
        rules = with_shape(sales_rules()) if MALFORMED in batch.columns else sales_rules()
        rules["date_ahead"] = self.date_ahead(base, ARRIVED in batch.columns)
        clean, bad = split(batch, SALES, rules)
        folder = self.path(f"lines/batch_id={batch_id}")
        rows = clean.select(*SALES.names).withColumn("month", line_month())
        rows.hint("rebalance", "month").write.mode("overwrite").partitionBy("month").parquet(folder)
        reasons = F.array_join(REASONS, "; ")
        refused = bad.select(*SALES.names, reasons.alias(REASONS))
        refused.write.mode("overwrite").parquet(self.path(f"quarantine/batch_id={batch_id}"))
        months = sorted(int(p.rsplit("=", 1)[1]) for p in self.manifest.subfolders(folder, 1))
        folders = dict(base.folders)
        for month in months:
            folders[month] = [*folders.get(month, []), f"{folder}/month={month}"]
        version = Version(batch_id, base.newest, folders)
        if months:
            complete = self.complete_month(version, months[-1])
            version = replace(version, newest=max(complete, base.newest or complete))
        self.manifest.commit(version)
        return months

    def store_rollup(self, months: list[int]) -> None:
        bought = positive_lines(self.lines(months), self.products, "consumable", "device")
        rows = month_rollup(bought).withColumn("month", F.col("month").cast("int"))
        self.replace_partitions(rows.select(*ROLLUP.names), "rollup", "month")

    def store_yearly(self, months: list[int]) -> None:
        years = sorted({month // 12 for month in months})
        spans = [F.col("month").between(y * 12, y * 12 + 11) for y in years]
        year = F.floor(F.col("month") / 12).cast("int")
        rows = (
            self.rollup()
            .where(any_of(spans))
            .groupBy("customer_id", year.alias("year"))
            .agg(
                F.sum("units").cast("decimal(38,8)").alias("units"),
                F.min("first_date").alias("first_date"),
                F.max("last_date").alias("last_date"),
                F.min("device_date").alias("device_date"),
            )
        )
        self.replace_partitions(rows.select(*YEARLY.names), "yearly", "year")

    def snapshot_months(self) -> list[int]:
        """Months stored: partition values, so a short list; none before the first."""
        try:
            stored = self.snapshot()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        months = stored.select(month_no(F.col("report_mth_eom")).alias("month")).distinct()
        return sorted(int(r.month) for r in months.collect())

    def complete_month(self, version: Version, newest: int) -> int:
        """The newest month that is over by the live lines: a month ends with
        lines of its last day or of a later month."""
        last = self.lines_of(version, [newest]).agg(F.max("invoice_date").alias("day")).first().day
        return newest if last == month_last_day(newest) else newest - 1

    def store_snapshot(self, months: list[int]) -> int | None:
        """Recompute from the oldest changed month on: totals never expire.

        All stored months are renewed as far as they can change, and months
        follow up to the newest complete one.
        """
        stored = self.snapshot_months() or [self.params.first_month, self.params.last_month]
        version = self.manifest.read()
        last = max(version.newest or 0, stored[-1], self.params.last_month)
        first = max(min(months[0], stored[-1] + 1), min(stored[0], self.params.first_month))
        if first > last:
            return None
        span = replace(self.params, latest=month_last_day(last), months=last - first + 1)
        reach = [m for m in version.folders if first - ORDER_WINDOW < m <= last]
        bought = positive_lines(self.lines_of(version, sorted(reach)), self.products, "consumable")
        write_snapshot(
            snapshot_from_rollup(self.history(first), bought, self.customers, span),
            self.path("snapshot"),
        )
        return first

    def feed(self) -> DataFrame:
        """All events as they were told, with the batch and action that told them."""
        return self.spark.read.schema(FEED).parquet(self.path("feed"))

    def store_feed(self, first: int, batch_id: int) -> None:
        """Tell what changed against the events told by the batches before.

        Kept by month and batch, so that only recomputed months are compared.
        """
        since = F.lit(month_last_day(first - 1))
        later = F.col("report_mth_eom") > since
        now = change_feed(self.snapshot().where(F.col("report_mth_eom") >= since)).where(later)
        try:
            told = self.feed().where(later & (F.col("batch_id") < batch_id))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            told = self.spark.createDataFrame([], FEED)
        changed = feed_difference(standing_events(told), now.select(*EVENT))
        self.replace_partitions(
            changed.withColumn("batch_id", F.lit(batch_id).cast("long")).select(*FEED.names),
            "feed",
            "report_mth_eom",
            "batch_id",
        )

    def load(self, batch: DataFrame, batch_id: int) -> list[int]:
        """Take in rows, columns of sales as text; the months that they touch."""
        base = self.merged(self.manifest.read(before=batch_id))
        return self.store_lines(batch, batch_id, base)

    def load_files(self, arrived: DataFrame, batch_id: int) -> list[int]:
        """Take in files, each by its own header; the months that they touch.

        Only their paths come to the driver. Refused files are listed with the
        columns they lack.
        """
        paths = sorted(row.path for row in arrived.collect())
        if not paths:
            return []
        rows, refused = read_text_table(self.spark, paths, SALES, unit=self.unit)
        listed = [(path, ", ".join(lacking), batch_id) for path, lacking in sorted(refused.items())]
        self.spark.createDataFrame(listed, REFUSED).drop("batch_id").write.mode("overwrite").parquet(
            self.path(f"refused/batch_id={batch_id}")
        )
        return self.load(rows, batch_id)

    def renew(self, months: list[int], batch_id: int) -> None:
        """Bring roll-ups, snapshot and feed up to date with changed months."""
        if not months:
            return
        self.store_rollup(months)
        self.store_yearly(months)
        first = self.store_snapshot(months)
        if first is not None:
            self.store_feed(first, batch_id)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.renew(self.load(batch, batch_id), batch_id)

    def take_files(self, arrived: DataFrame, batch_id: int) -> None:
        self.renew(self.load_files(arrived, batch_id), batch_id)

    def refused(self) -> DataFrame:
        return self.spark.read.schema(REFUSED).parquet(self.path("refused"))


def line_month() -> Column:
    return month_no(F.col("invoice_date")).cast("int")


def on_arrival(arriving: DataFrame, refresh: Refresh, step) -> StreamingQuery:
    return (
        arriving.writeStream.foreachBatch(step)
        .option("checkpointLocation", refresh.path("checkpoint"))
        .trigger(availableNow=True)
        .start()
    )


def refresh_on_arrival(arriving: DataFrame, refresh: Refresh) -> StreamingQuery:
    """Process the files that have landed, then stop."""
    return on_arrival(arriving, refresh, refresh.take_files)


def load_on_arrival(arriving: DataFrame, refresh: Refresh) -> StreamingQuery:
    """Take in the files that have landed without renewing what stands on them."""
    return on_arrival(arriving, refresh, refresh.load_files)
