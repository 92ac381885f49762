"""Spend ladder by hand: day windows, netting, empty clients, movements."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import shape
from ledgerline.params import LadderParams
from ledgerline.plans import extracts, ladder
from ledgerline.schemas import CUSTOMERS, SALES

T = date(2024, 7, 31)
P = LadderParams(as_of=T)


def ago(days):
    return T - timedelta(days=days)


# customer: (day, revenue, invoice, store)
LINES = {
    1: [(ago(364), 500, "a", 1)],
    2: [(ago(365), 500, "a", 1)],
    3: [(ago(730), 500, "a", 1)],
    4: [(ago(10), 60000, "a", 1), (ago(5), Decimal("-0.5"), "b", 2)],
    5: [(ago(10), Decimal("59999.49"), "a", 1)],
    6: [(ago(3), -20, "a", 1)],
    7: [],
    8: [(ago(31), 100, "a", 1), (ago(31), 300, "a", 2), (ago(40), 200, "b", 2)],
    9: [(ago(-1), 900, "a", 1), (ago(400), 70000, "b", 1)],
}


def table(spark, by_customer):
    rows = [
        (invoice, customer, day, 1, Decimal(1 if amount > 0 else -1), Decimal(amount), store)
        for customer, lines in by_customer.items()
        for day, amount, invoice, store in lines
    ]
    return spark.createDataFrame(rows, SALES)


def master(spark, ids):
    rows = [(i, f"Client {i}", "Shop", "x", None, None, None, 1, 0, None) for i in ids]
    return spark.createDataFrame(rows, CUSTOMERS)


@pytest.fixture(scope="module")
def sales(spark):
    return table(spark, LINES)


@pytest.fixture(scope="module")
def stats(spark, sales):
    frame = ladder.client_stats(sales, master(spark, LINES), P)
    return {r.customer_id: r for r in frame.collect()}


def test_day_windows_are_half_open(stats):
    assert (stats[1].spend12m, stats[1].spend_prev12m) == (500, 0)
    assert (stats[2].spend12m, stats[2].spend_prev12m) == (0, 500)
    assert (stats[3].spend12m, stats[3].spend_prev12m) == (0, 0)
    assert stats[3].orders_all == 1


def test_refunds_count_and_round_before_tiering(stats):
    assert (stats[4].spend12m, stats[4].tier) == (60000, "VIP")  # 59,999.5
    assert (stats[5].spend12m, stats[5].tier) == (59999, "XXL")
    assert (stats[6].spend12m, stats[6].tier) == (-20, "XXS")


def test_client_without_purchases(stats):
    never = stats[7]
    assert (never.last_days, never.avg_order, never.orders12m, never.tier) == (9999, 0, 0, "XXS")
    assert never.first_date is None


def test_orders_are_invoices(stats):
    assert (stats[8].orders12m, stats[8].avg_order, stats[8].last_days) == (2, 300, 31)


def test_nothing_after_the_day_counts(stats):
    assert (stats[9].spend12m, stats[9].last_days, stats[9].prev_tier) == (0, 400, "VIP")


def test_monthly_vector(spark, sales):
    rows = ladder.monthly_vector(sales, master(spark, LINES), P).collect()
    vectors = {r.customer_id: r.monthly for r in rows}
    assert vectors[7] == [0] * 12
    assert vectors[1] == [500] + [0] * 11
    assert vectors[8][10] == 600  # 31 and 40 days ago: one slot before the newest


def test_locations(spark, sales):
    places = spark.createDataFrame(
        [(1, "One", "A"), (2, "Two", "A"), (3, "Three", "B")], "store_id long, location string, city string"
    )
    rows = {r.store_id: r for r in ladder.location_stats(sales, places, P).collect()}
    assert (rows[2].clients, rows[2].orders) == (2, 3)
    assert rows[3].clients == 0 and rows[3].growth_pct is None and rows[3].retention_pct is None
    assert rows[1].retention_pct == 0.0
    cities = ladder.city_rollup(ladder.location_stats(sales, places, P)).collect()
    assert {(r.city, r.n_locations) for r in cities} == {("A", 2), ("B", 1)}


def test_churn_and_new_count_all_history(spark):
    lines = {1: [(date(2020, 1, 5), 1, "a", 1), (date(2024, 4, 20), 1, "b", 1)],
             2: [(date(2024, 6, 1), 1, "a", 1)]}
    clients = ladder.client_stats(table(spark, lines), master(spark, lines), P)
    flow = {r.month: r for r in ladder.base_flow(clients, P).collect()}
    assert len(flow) == 18
    assert flow[date(2024, 6, 1)].new_clients == 1
    assert sum(r.new_clients for r in flow.values()) == 1
    assert flow[date(2024, 7, 1)].churned_clients == 1


def test_series_ends_with_a_complete_month():
    assert LadderParams(as_of=date(2026, 6, 10)).last_full_month == 2026 * 12 + 4
    assert LadderParams(as_of=date(2026, 5, 31)).last_full_month == 2026 * 12 + 4


def test_movements_between_days(spark, sales):
    people = master(spark, LINES)
    grid = extracts.movement_summary(sales, people, ago(30), T, P)
    moved = {(r.from_tier, r.to_tier): r.n for r in grid.where("n > 0").collect()}
    assert moved[("XXS", "VIP")] == 1 and moved[("XXS", "XXL")] == 1
    # Client 9 spent 70,000 over a year ago, so it is in the lowest tier on both days.
    totals = extracts.retier_summary(sales, people, ago(30), T, P).first()
    assert (totals.clients, totals.moved_up, totals.moved_down) == (9, 2, 0)


def test_sweep_and_turning(spark):
    lines = {1: [(ago(181), 1, "a", 1)], 2: [(ago(180), 1, "a", 1)], 3: [(ago(300), 1, "a", 1)]}
    swept = extracts.inactivity_sweep(table(spark, lines), master(spark, lines), ago(1), T, P)
    assert [r.customer_id for r in swept.collect()] == [1]
    clients = ladder.client_stats(table(spark, lines), master(spark, lines), P)
    turned = extracts.turning_inactive(clients, P, 1).collect()
    assert [(r.customer_id, r.turned_on) for r in turned] == [(1, T)]


def test_consent_log_newest_wins(spark):
    log = spark.sql(
        "select 1L customer_id, 'opt_sms' channel, 1 opted, timestamp'2024-01-02' changed_at, 'web' source "
        "union all select 1L, 'opt_sms', 0, timestamp'2024-01-01', 'store'"
    )
    rows = extracts.consent_register(master(spark, [1]), log).collect()
    assert {(r.channel, r.consent, r.source) for r in rows} == {
        ("opt_email", "in", None), ("opt_sms", "in", "web"), ("opt_phone", "unknown", None),
    }


def test_pages_clamp_and_follow(spark, tmp_path):
    rows = spark.range(120).select("id", (F.col("id") % 7).cast("double").alias("v"))
    order = [F.desc_nulls_last("v"), F.asc("id")]
    ids = [r.id for r in rows.orderBy(*order).collect()]
    assert [r.id for r in shape.page(rows, order, 99, folder=f"{tmp_path}/a").collect()] == ids[100:]
    first = shape.page(rows, order, 0, folder=f"{tmp_path}/b").collect()
    after = shape.page_after(rows, "v", "id", first[-1].v, first[-1].id).collect()
    assert [r.id for r in after] == ids[50:100]
    assert shape.page(rows.where("id < 0"), order, 3, folder=f"{tmp_path}/c").count() == 0


def test_a_deep_page_reads_one_part(spark, tmp_path):
    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 5000).alias("v"))
    pages = shape.paged(rows, [F.desc("v"), F.asc("id")], f"{tmp_path}/pages", parts=10)
    assert pages.total == 5000 and len(pages.counts) == 10
    whole = [r.v for r in rows.orderBy(F.desc("v")).collect()]
    for number in (0, 1, 37, 99, 10_000):
        got = [r.v for r in pages.page(number).collect()]
        assert got == whole[min(number, 99) * 50 :][:50]
    deep = pages.page(90)
    deep.collect()
    plan = deep._jdf.queryExecution().executedPlan().toString()
    read = [part for part, _ in pages.counts if f"page_part#" in plan and f" {part})" in plan or f"({part}" in plan]
    assert "PartitionFilters: [isnotnull(page_part" in plan or "PartitionFilters: [page_part" in plan, plan
    assert len(read) <= 2
