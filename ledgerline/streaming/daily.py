"""Daily spend per customer from a stream of purchases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ledgerline.sources.manifest import Manifest, Version

DELAY = "40 days"
# Sums of doubles depend on their order; these don't.
AMOUNT = "decimal(18,6)"
DAYS = "day date, customer_id bigint, amount decimal(28,6), purchases bigint"


def purchases(events: DataFrame) -> DataFrame:
    """Purchases with their wall-clock time as an instant in UTC.

    Spark aligns day windows to UTC and watermarks need instants, while the
    days wanted are those on the clock, whatever the session's time zone.
    """
    instant = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    return events.where(F.col("event_type") == "purchase").select(
        "event_id",
        instant.alias("ts"),
        F.col("user_id").alias("customer_id"),
        F.col("value").cast(AMOUNT).alias("amount"),
    )


def daily_totals(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """Amount and count per customer and day; re-sent rows count once.

    Rows later than the delay are dropped, which bounds the state kept.
    """
    day = F.to_utc_timestamp("span.start", F.current_timezone()).cast("date")
    return (
        stream.withWatermark("ts", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
        .groupBy(F.window("ts", "1 day").alias("span"), "customer_id")
        .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("purchases"))
        .select(day.alias("day"), "customer_id", "amount", "purchases")
    )


def manifest(spark: SparkSession, folder: str) -> Manifest:
    return Manifest(spark, f"{folder}/manifest")


def upsert(batch: DataFrame, batch_id: int, folder: str) -> None:
    """Put a batch's totals in place of those of the same day and customer.

    A total is written whole whenever it changes. The days touched are written
    again to folders of their own, and the manifest switches to them in one
    rename, so a batch that is killed changes nothing and one that is run again
    starts from the days as the batches before left them.
    """
    spark = batch.sparkSession
    versions = manifest(spark, folder)
    base = versions.read(before=batch_id)
    number = F.unix_date("day").alias("number")
    changed = batch.select("day", "customer_id", "amount", "purchases")
    days = sorted(row.number for row in changed.select(number).distinct().collect())
    if not days:
        return
    paths = base.paths(days)
    kept = spark.read.schema(DAYS).parquet(*paths) if paths else spark.createDataFrame([], DAYS)
    kept = kept.join(changed, ["day", "customer_id"], "left_anti")
    target = f"{folder}/daily/batch_id={batch_id}"
    rows = kept.unionByName(changed).select("*", number)
    rows.hint("rebalance", "number").write.mode("overwrite").partitionBy("number").parquet(target)
    folders = base.folders | {day: [f"{target}/number={day}"] for day in days}
    versions.commit(Version(batch_id, None, folders))


def vacuum(spark: SparkSession, folder: str, replayable: bool = True) -> None:
    """Remove folders of days that no version in use names, with no batch at work.

    Those that the last batch would need to run again stay unless it surely won't.
    """
    versions = manifest(spark, folder)
    live = {path.rsplit("/daily/", 1)[1] for path in versions.live(replayable)}
    stored = versions.subfolders(f"{folder}/daily", 2)
    versions.remove([p for p in stored if p.rsplit("/daily/", 1)[1] not in live])


def store_daily(totals: DataFrame, folder: str) -> StreamingQuery:
    """Keep one row per day and customer, renewed batch by batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            upsert(kept, batch_id, folder)
        finally:
            kept.unpersist()

    return (
        totals.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def current_daily(spark: SparkSession, folder: str, first: int = -(2**31), last: int = 2**31) -> DataFrame:
    """The stored totals, of days (since 1970) in a span if one is given."""
    version = manifest(spark, folder).read()
    paths = version.paths([day for day in sorted(version.folders) if first <= day <= last])
    return spark.read.schema(DAYS).parquet(*paths) if paths else spark.createDataFrame([], DAYS)


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    return daily.groupBy("customer_id", F.trunc("day", "MM").alias("month")).agg(
        F.sum("amount").alias("amount"), F.sum("purchases").alias("purchases")
    )
