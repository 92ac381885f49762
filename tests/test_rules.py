"""Truth tables of the classification rules, boundaries included."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import rules
from ledgerline.functions.calendar import report_months_from, report_windows
from ledgerline.operators.facets import contains_text, one_of
from ledgerline.params import LadderParams, SnapshotParams

PARAMS = SnapshotParams(latest=date(2024, 12, 31))
LADDER = LadderParams(as_of=date(2024, 12, 31))


def results(spark, schema, rows, column):
    numbered = [(i, *r) for i, r in enumerate(rows)]
    frame = spark.createDataFrame(numbered, f"i int, {schema}", verifySchema=False)
    return [r.x for r in frame.select("i", column.alias("x")).orderBy("i").collect()]


def test_value_tier(spark):
    cases = [
        ((0, 0, 0), None),
        ((0, 10, 0), "Passive"),
        ((9600, 9600, 6), "Diamond"),
        ((9000, 9000, 6), "Diamond"),  # order size exactly 1500
        ((8999, 8999, 6), "Platinum"),
        ((9600, 9600, 5), "Platinum"),
        ((6000, 6000, 3), "Platinum"),  # month mean exactly 1000
        ((6000, 6000, 2), "Gold"),
        ((1200, 1200, 1), "Gold"),  # exactly 200
        ((1199, 1199, 1), "Silver"),
        ((300, 300, 1), "Silver"),  # exactly 50
        ((299, 299, 1), "Bronze"),
        ((8000, 8000, 0), "Gold"),
    ]
    tier = rules.value_tier(F.col("m6"), F.col("m12"), F.col("o6"), PARAMS)
    got = results(
        spark, "m6 bigint, m12 bigint, o6 bigint", [c[0] for c in cases], tier
    )
    assert got == [c[1] for c in cases]


def test_lifecycle_event(spark):
    cases = [
        ((40, 40, 40, 40), "New"),
        ((0, 0, 0, 0), None),
        ((0, 0, 50, 50), "Lost"),
        ((0, 0, 0, 50), None),
        ((40, 40, 40, 90), "Reactivated"),
        ((40, 40, 90, 90), None),
        ((40, 90, 90, 90), None),
    ]
    event = rules.lifecycle_event(*[F.col(c) for c in ("m1", "m12", "m13", "m_total")])
    schema = ", ".join(f"{c} bigint" for c in ("m1", "m12", "m13", "m_total"))
    assert results(spark, schema, [c[0] for c in cases], event) == [c[1] for c in cases]


def test_fractional_volumes_compare_exactly(spark):
    event = rules.lifecycle_event(F.col("a"), F.col("a"), F.col("a"), F.col("b"))
    frame = spark.sql("select 0.1bd + 0.2bd as a, 0.3bd as b")
    assert frame.select(event).first()[0] == "New"


def test_status_and_order_size(spark):
    status = rules.activity_status(F.col("m"))
    assert results(spark, "m bigint", [(0,), (1,)], status) == ["Not Active", "Active"]
    size = rules.average_order(F.col("m"), F.col("o"))
    assert results(spark, "m bigint, o bigint", [(10, 0), (10, 4)], size) == [None, 2.5]


@pytest.mark.parametrize(
    "bought, months",
    [
        (date(2026, 4, 1), 1),
        (date(2026, 3, 31), 2),
        (date(2025, 4, 30), 13),
        (date(2024, 1, 15), 28),
        (None, None),
    ],
)
def test_tenure_golden(spark, bought, months):
    tenure = rules.tenure_months(F.lit(date(2026, 4, 30)), F.col("d"))
    assert results(spark, "d date", [(bought,)], tenure) == [months]


def test_spend_tier_after_rounding(spark):
    cases = [
        ("59999.5", 60000, "VIP"),
        ("59999.49", 59999, "XXL"),
        ("0.5", 1, "XXS"),
        ("-0.5", 0, "XXS"),
        ("-500.0", -500, "XXS"),
        ("1000", 1000, "XS"),
        ("7999.49", 7999, "M"),
        ("8000", 8000, "L"),
    ]
    amounts = [(c[0],) for c in cases]
    rounded = rules.round_half_up(F.col("s").cast("decimal(28,4)"))
    assert results(spark, "s string", amounts, rounded) == [c[1] for c in cases]
    tier = rules.spend_tier(rounded, LADDER.tiers)
    assert results(spark, "s string", amounts, tier) == [c[2] for c in cases]


def test_buckets_and_labels(spark):
    days = [(d,) for d in (0, 1, 2, 29, 30, 31, 45, 90, 91, 180, 181, 9999)]
    col = F.col("d")
    assert results(spark, "d int", days, rules.recency_bucket(col)) == [
        0, 0, 0, 0, 0, 1, 1, 1, 2, 2, 3, 3,
    ]
    assert results(spark, "d int", days, rules.recency_label(col))[:8] == [
        "Today", "Today", "2d ago", "29d ago", "1mo ago", "1mo ago", "2mo ago", "3mo ago",
    ]
    severity = results(spark, "d int", days, rules.recency_severity(col))
    assert severity[4:6] + severity[7:11] == ["ok", "plain", "plain", "warn", "warn", "bad"]
    orders = [(n,) for n in (10, 9, 6, 5, 3, 2, 0)]
    assert results(spark, "d int", orders, rules.frequency_bucket(col)) == [0, 1, 1, 2, 2, 3, 3]
    cold = rules.going_cold(F.col("d"), F.col("o"))
    cases = [(91, 6), (90, 6), (91, 5), (200, 12)]
    assert results(spark, "d int, o int", cases, cold) == [True, False, False, True]


def test_pct_change_and_points(spark):
    change = rules.pct_change(F.col("a"), F.col("b"))
    rows = [(110, 100), (5, 0), (90, 100)]
    assert results(spark, "a int, b int", rows, change) == [10.0, None, -10.0]
    points = rules.loyalty_points(F.col("a"))
    assert results(spark, "a bigint", [(1234,), (1235,), (4,)], points) == [123, 124, 0]


def test_report_months_from_any_day(spark):
    months = report_months_from(spark, date(2024, 3, 5), 3)
    assert [r[0] for r in months.collect()] == [
        date(2024, 1, 31), date(2024, 2, 29), date(2024, 3, 31),
    ]
    windows = report_windows(months).orderBy("report_mth_eom").collect()[-1]
    assert windows.m01_bom == date(2024, 3, 1)
    assert windows.m06_bom == date(2023, 10, 1)
    assert windows.m25_bom == date(2022, 3, 1)


def test_facet_predicates(spark):
    rows = [("Gold",), (None,), ("Silver",)]
    assert results(spark, "t string", rows, one_of("t", [])) == [True, True, True]
    assert results(spark, "t string", rows, one_of("t", ["Gold"])) == [True, False, False]
    found = contains_text("LdS", "t", "u")
    rows = [("Gold", "Silver"), ("Gold", None), (None, "xlds")]
    assert results(spark, "t string, u string", rows, found) == [True, False, True]
