"""Snapshot by hand: one customer per branch, and brute force on odd data."""

import random
from collections import defaultdict
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.params import SnapshotParams, month_last_day, month_number
from ledgerline.plans.snapshot import customer_snapshot, single_month_snapshot
from ledgerline.schemas import CUSTOMERS, PRODUCTS, SALES

PRODUCT_ROWS = [
    (1, "device", None),
    (2, "consumable", 10),
    (3, "consumable", 40),
    (4, "accessories", None),
    (5, "consumable", 0),
]
D = date
SALES_BY_CUSTOMER = {
    1: [(D(2024, m, 5), 3, 40) for m in range(7, 13)],
    2: [(D(2024, m, 1), 3, 60) for m in (10, 11, 12)],
    3: [(D(2024, 11, 1), 3, 200)],
    4: [(D(2024, 9, 10), 2, 120)],
    5: [(D(2024, 9, 10), 2, 30)],
    6: [(D(2024, 7, 1), 2, 1)],
    7: [(D(2024, 6, 30), 2, 5)],
    8: [(D(2023, 12, 31), 2, 5)],
    9: [(D(2023, 11, 30), 2, 5)],
    10: [(D(2022, 3, 3), 2, 5), (D(2024, 12, 2), 2, 4)],
    11: [(D(2023, 12, 15), 2, 5), (D(2024, 12, 2), 2, 4)],
    12: [(D(2024, 12, 2), 2, 4)],
    13: [],
    14: [(D(2024, 12, 2), 2, 4)],
    15: [(D(2024, 12, 2), 1, 1)],
    16: [(D(2024, 12, 2), 2, 4), (D(2024, 12, 9), 2, -4)],
    17: [(D(2024, 12, 2), 2, 1, "A"), (D(2024, 12, 2), 3, 1, "A")],
    18: [(D(2024, 12, 2), 2, 4), (D(2025, 1, 5), 2, 9)],
    19: [(D(2024, 12, 2), 5, 3)],
    20: [(D(2024, 12, 2), 4, 3)],
}
# m1, m6, m12, m13, m_total, o6, tenure, status, tier, event
EXPECTED = {
    1: (1600, 9600, 9600, 9600, 9600, 6, 6, "Active", "Diamond", None),
    2: (2400, 7200, 7200, 7200, 7200, 3, 3, "Active", "Platinum", None),
    3: (0, 8000, 8000, 8000, 8000, 1, 2, "Active", "Gold", None),
    4: (0, 1200, 1200, 1200, 1200, 1, 4, "Active", "Gold", None),
    5: (0, 300, 300, 300, 300, 1, 4, "Active", "Silver", None),
    6: (0, 10, 10, 10, 10, 1, 6, "Active", "Bronze", None),
    7: (0, 0, 50, 50, 50, 0, 7, "Active", "Passive", None),
    8: (0, 0, 0, 50, 50, 0, 13, "Not Active", None, "Lost"),
    9: (0, 0, 0, 0, 50, 0, 14, "Not Active", None, None),
    10: (40, 40, 40, 40, 90, 1, 34, "Active", "Bronze", "Reactivated"),
    11: (40, 40, 40, 90, 90, 1, 13, "Active", "Bronze", None),
    12: (40, 40, 40, 40, 40, 1, 1, "Active", "Bronze", "New"),
    13: (0, 0, 0, 0, 0, 0, None, "Not Active", None, None),
    15: (0, 0, 0, 0, 0, 0, None, "Not Active", None, None),
    16: (40, 40, 40, 40, 40, 1, 1, "Active", "Bronze", "New"),
    17: (50, 50, 50, 50, 50, 1, 1, "Active", "Bronze", "New"),
    18: (40, 40, 40, 40, 40, 1, 1, "Active", "Bronze", "New"),
    19: (0, 0, 0, 0, 0, 1, 1, "Not Active", None, None),
    20: (0, 0, 0, 0, 0, 0, None, "Not Active", None, None),
}


def products(spark):
    rows = [
        (i, f"p{i}", "b", category, None if size is None else Decimal(size))
        for i, category, size in PRODUCT_ROWS
    ]
    return spark.createDataFrame(rows, PRODUCTS)


def customers(spark, groups):
    rows = [(i, f"c{i}", g, "x", None, None, None, None, None, None) for i, g in groups.items()]
    return spark.createDataFrame(rows, CUSTOMERS)


def sales(spark, by_customer):
    rows, number = [], 0
    for customer, lines in by_customer.items():
        for day, product, quantity, *invoice in lines:
            number += 1
            name = invoice[0] if invoice else f"i{number}"
            rows.append((name, customer, day, product, Decimal(quantity), Decimal(0), 1))
    return spark.createDataFrame(rows, SALES)


@pytest.fixture(scope="module")
def hand(spark):
    groups = dict.fromkeys(range(1, 21), "Standard") | {14: "GENERAL", 15: None, 1: "Loyalty"}
    return sales(spark, SALES_BY_CUSTOMER), products(spark), customers(spark, groups)


@pytest.mark.parametrize("plan", [customer_snapshot, single_month_snapshot])
def test_one_customer_per_branch(hand, plan):
    rows = plan(*hand, SnapshotParams(latest=D(2024, 12, 31), months=1)).collect()
    got = {
        r.customer_id: (
            r.m1, r.m6, r.m12, r.m13, r.m_total, r.o6, r.tenure_months,
            r.activity_status, r.value_tier, r.lifecycle_event,
        )
        for r in rows
    }
    assert got == EXPECTED
    by_id = {r.customer_id: r for r in rows}
    assert by_id[15].first_device_purchase_date == D(2024, 12, 2)
    assert by_id[18].last_consumable_purchase_date == D(2024, 12, 2)
    assert by_id[19].first_consumable_purchase_date == D(2024, 12, 2)
    assert by_id[20].first_consumable_purchase_date is None
    assert by_id[7].avg_order_size is None
    assert by_id[1].avg_monthly_consumption == 1600


def brute_force(by_customer, first, last):
    """Every window of every report month, straight from the definition."""
    sizes = {i: s for i, category, s in PRODUCT_ROWS if category == "consumable"}
    out = {}
    for customer, lines in by_customer.items():
        used = [
            (month_number(day), day, sizes[p] * q, inv)
            for day, p, q, inv in lines
            if p in sizes and q > 0
        ]
        for report in range(first, last + 1):
            seen = [u for u in used if u[0] <= report]

            def total(k, seen=seen, report=report):
                return sum(u[2] for u in seen if u[0] > report - k)

            out[customer, month_last_day(report)] = (
                sum(u[2] for u in seen),
                *[total(k) for k in (1, 6, 12, 13, 24, 25)],
                len({u[3] for u in seen if u[0] > report - 6}),
                min((u[1] for u in seen), default=None),
                max((u[1] for u in seen), default=None),
            )
    return out


@pytest.mark.parametrize("months", [1, 12, 70, 130])
def test_many_months_against_brute_force(spark, months):
    """Repeated invoice ids, a customer with most lines, long month ranges."""
    rng = random.Random(5)
    by_customer = defaultdict(list)
    for _ in range(900):
        customer = 1 if rng.random() < 0.4 else rng.randint(2, 12)
        day = date(rng.randint(2012, 2024), rng.randint(1, 12), rng.randint(1, 28))
        by_customer[customer].append(
            (day, rng.randint(1, 5), rng.randint(-2, 6), f"inv{rng.randint(1, 60)}")
        )
    params = SnapshotParams(latest=date(2024, 9, 30), months=months)
    masters = products(spark), customers(spark, dict.fromkeys(by_customer, "a"))
    rows = customer_snapshot(sales(spark, by_customer), *masters, params).collect()
    got = {
        (r.customer_id, r.report_mth_eom): (
            r.m_total, r.m1, r.m6, r.m12, r.m13, r.m24, r.m25, r.o6,
            r.first_consumable_purchase_date, r.last_consumable_purchase_date,
        )
        for r in rows
    }
    assert got == brute_force(by_customer, params.first_month, params.last_month)


def test_many_anonymous_ids_have_the_plan_of_one(spark, hand):
    sales, products, customers = hand
    params = SnapshotParams(latest=D(2024, 12, 31), months=2)
    ids = spark.range(10_000, 10_700).select(F.col("id").alias("customer_id"))
    more = ids.withColumn("customer_group", F.lit("General"))
    with_many = customers.unionByName(more, allowMissingColumns=True)
    walk_in = sales.limit(1).drop("customer_id").crossJoin(ids)
    left = customer_snapshot(sales, products, customers, params)
    right = customer_snapshot(sales.unionByName(walk_in), products, with_many, params)
    assert left.exceptAll(right).count() == 0 and left.count() == right.count()
