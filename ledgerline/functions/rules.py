"""Classification rules as pure column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.calendar import whole_months_between
from ledgerline.params import SnapshotParams


def round_half_up(value: Column) -> Column:
    """Round to a whole number with halves going up, also below zero."""
    return F.floor(value + F.lit("0.5").cast("decimal(2,1)")).cast("long")


def round_double(value: Column) -> Column:
    return F.floor(value + F.lit(0.5)).cast("long")


# -- volume model -------------------------------------------------------------


def average_month(m6: Column) -> Column:
    return m6.cast("double") / 6.0


def average_order(m6: Column, o6: Column) -> Column:
    return F.when(o6 > 0, m6.cast("double") / o6)


def tenure_months(report_eom: Column, first_purchase: Column) -> Column:
    """Months on book counting the first one; NULL without a purchase."""
    return whole_months_between(report_eom, first_purchase) + 1


def activity_status(m12: Column) -> Column:
    return F.when(m12 > 0, "Active").otherwise("Not Active")


def value_tier(m6: Column, m12: Column, o6: Column, p: SnapshotParams) -> Column:
    amc, aos = average_month(m6), average_order(m6, o6)
    return (
        F.when(m12 == 0, F.lit(None).cast("string"))
        .when(m6 == 0, "Passive")
        .when((amc >= p.t_high) & (aos >= p.a_high) & (o6 >= p.f_high), "Diamond")
        .when((amc >= p.t_high) & (o6 >= p.f_mid), "Platinum")
        .when(amc >= p.t_mid_high, "Gold")
        .when(amc >= p.t_mid, "Silver")
        .when(amc > 0, "Bronze")
    )


def lifecycle_event(m1: Column, m12: Column, m13: Column, m_total: Column) -> Column:
    """Compares sums for equality, so the inputs must be exact decimals."""
    bought_now = m1 > 0
    return (
        F.when(bought_now & (m1 == m_total), "New")
        .when((m12 == 0) & (m13 > 0), "Lost")
        .when(bought_now & (m1 == m13) & (m_total > m13), "Reactivated")
    )


# -- spend model --------------------------------------------------------------


def spend_tier(rounded: Column, tiers: Sequence[tuple[str, int]]) -> Column:
    """First tier from the top whose minimum is reached; else the lowest."""
    rule = F
    for name, minimum in tiers:
        rule = rule.when(rounded >= minimum, name)
    return rule.otherwise(tiers[-1][0])


# The bucket limits below, in days and in orders a year.


def recency_bucket(days: Column) -> Column:
    return F.when(days <= 30, 0).when(days <= 90, 1).when(days <= 180, 2).otherwise(3)


def frequency_bucket(orders: Column) -> Column:
    return F.when(orders >= 10, 0).when(orders >= 6, 1).when(orders >= 3, 2).otherwise(3)


def going_cold(days: Column, orders: Column) -> Column:
    """Frequent buyers whose last purchase is over 90 days ago: a risk flag."""
    return (frequency_bucket(orders) <= 1) & (recency_bucket(days) >= 2)


def recency_label(days: Column) -> Column:
    months = F.floor(days / 30 + 0.5).cast("string")
    return (
        F.when(days <= 1, "Today")
        .when(days < 30, F.concat(days.cast("string"), F.lit("d ago")))
        .otherwise(F.concat(months, F.lit("mo ago")))
    )


def recency_severity(days: Column) -> Column:
    return (
        F.when(days <= 30, "ok")
        .when(days <= 90, "plain")
        .when(days <= 180, "warn")
        .otherwise("bad")
    )


def loyalty_points(spend: Column) -> Column:
    return round_double(spend / 10)


def pct_change(now: Column, before: Column) -> Column:
    now, before = now.cast("double"), before.cast("double")
    return F.when(before != 0, (now - before) / before * 100)


def is_recent(days: Column, limit: int) -> Column:
    return days <= limit


def rank_of(label: Column, order: Sequence[str]) -> Column:
    """Position of a label in a fixed order; unknown and NULL come last."""
    rule = F
    for position, name in enumerate(order):
        rule = rule.when(label == name, position)
    return rule.otherwise(len(order))
