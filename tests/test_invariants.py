"""Properties that hold on any data, checked on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import ladder, monthly
from ledgerline.registry.common import LADDER, PARAMS, snapshot, stats, tables
from ledgerline.sources import star


@pytest.fixture(scope="module")
def snap(spark, small):
    return snapshot(spark, small).persist()


@pytest.fixture(scope="module")
def clients(spark, small):
    return stats(spark, small).persist()


def none_of(df, condition):
    assert df.where(condition).count() == 0


def test_dense_grid(spark, small, snap):
    eligible = tables(spark, small).customers.where("lower(customer_group) != 'household'").count()
    assert snap.count() == eligible * PARAMS.months
    assert snap.select("report_mth_eom", "customer_id").distinct().count() == snap.count()


def test_windows_are_nested(snap):
    order = ["m1", "m6", "m12", "m13", "m24", "m25", "m_total"]
    for shorter, longer in zip(order, order[1:], strict=False):
        none_of(snap, F.col(shorter) > F.col(longer))


def test_labels_agree(snap):
    none_of(snap, "(value_tier is null) != (activity_status = 'Not Active')")
    none_of(snap, "lifecycle_event = 'Lost' and activity_status = 'Active'")
    none_of(snap, "lifecycle_event in ('New', 'Reactivated') and activity_status != 'Active'")
    none_of(snap, "(o6 = 0) != (m6 = 0)")
    none_of(snap, "last_consumable_purchase_date > report_mth_eom")
    none_of(snap, "first_device_purchase_date > report_mth_eom")


def test_new_at_most_once(snap):
    new = snap.where("lifecycle_event = 'New'").groupBy("customer_id").count()
    none_of(new, "count > 1")


def test_report_sums(snap):
    mix = monthly.tier_mix(snap).groupBy("report_mth_eom").agg(F.sum("n").alias("tiered"))
    flat = monthly.monthly_report(snap)
    none_of(flat.join(mix, "report_mth_eom"), "tiered != active")
    none_of(flat, "active + not_active != total_customers")


def test_client_grids_cover_everyone(clients):
    n = clients.count()
    for grid in (ladder.transition_matrix(clients), ladder.rfm_grid(clients)):
        assert grid.agg(F.sum("n")).first()[0] == n
    assert ladder.transition_matrix(clients).count() == 64
    share = ladder.segment_share(clients).agg(F.sum("clients"), F.sum("pct_of_revenue")).first()
    assert share[0] == n
    assert abs(share[1] - 100) < 1e-9


def test_vector_adds_up_to_spend(spark, small, clients):
    t = tables(spark, small)
    vectors = ladder.monthly_vector(t.sales, t.customers, LADDER)
    total = F.aggregate("monthly", F.lit(0).cast("long"), lambda a, x: a + x)
    both = vectors.select("customer_id", total.alias("t")).join(clients, "customer_id")
    none_of(both, "abs(t - spend12m) > 7 or t is null")


def test_join_tasks_are_sized_by_lines(spark):
    """Many lines are dealt out by order, a few stay as they lie; none is lost."""
    schema = "l_orderkey bigint, l_partkey bigint"
    rows = [(i // 3 if i % 7 else None, i) for i in range(300)] * 2
    lines = spark.createDataFrame(rows, schema)
    cores = spark.sparkContext.defaultParallelism
    dealt = star.by_order(lines, task_lines=600 // (cores + 4))
    assert dealt.rdd.getNumPartitions() >= cores + 4
    assert sorted(dealt.collect(), key=str) == sorted(lines.collect(), key=str)
    assert star.by_order(lines) is lines
    assert star.by_order(lines.limit(0)).count() == 0
