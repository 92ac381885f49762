"""Month arithmetic as column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.params import WINDOW_MONTHS


def month_no(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def month_start(number: Column) -> Column:
    return F.make_date(
        F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int"), F.lit(1)
    )


def month_end(number: Column) -> Column:
    return F.last_day(month_start(number))


def whole_months_between(later: Column, earlier: Column) -> Column:
    """Calendar months from one date's month to another's, always a whole number."""
    return month_no(later) - month_no(earlier)


def last_full_month(day: Column) -> Column:
    """End of the last month that is over by ``day``."""
    return F.when(F.last_day(day) == day, day).otherwise(
        F.last_day(F.add_months(day, -1))
    )


def report_months(latest: DataFrame, count: int) -> DataFrame:
    """``count`` month ends up to the month of ``latest.latest``, oldest first.

    ``latest`` is a one-row relation; any day of the month may be given.
    """
    newest = F.trunc(F.col("latest"), "MM")
    return latest.select(
        F.explode(
            F.sequence(
                F.add_months(newest, 1 - count), newest, F.expr("interval 1 month")
            )
        ).alias("bom")
    ).select(F.last_day("bom").alias("report_mth_eom"))


def report_months_from(spark: SparkSession, latest: date, count: int) -> DataFrame:
    return report_months(spark.range(1).select(F.lit(latest).alias("latest")), count)


def report_windows(months: DataFrame) -> DataFrame:
    """First day of each trailing calendar window of a report month."""
    bom = F.trunc("report_mth_eom", "MM")
    return months.select(
        "report_mth_eom",
        bom.alias("report_mth_bom"),
        *[F.add_months(bom, 1 - k).alias(f"m{k:02d}_bom") for k in WINDOW_MONTHS],
    )
