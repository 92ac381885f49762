"""Every registered query against its SQL, and the shape of its plan."""

import oracle
import pytest

from ledgerline.registry import ENTRIES

# Queries that write files or run a stream before they return a relation.
EAGER = {
    "read_sales_years",
    "load_summary",
    "upload_failures",
    "export_csv",
    "stored_snapshot",
    "report_json",
    "report_json_customers",
    "report_json_months",
    "report_json_latest",
    "report_json_brands",
    "report_json_categories",
    "read_products",
    "read_customers",
    "load_summary_all",
    "page",
    "refused_files",
    "misdated_lines",
    "refresh_on_arrival",
    "change_feed_stream",
    "daily_rollup_stream",
    "monthly_from_daily",
}


@pytest.fixture(scope="module")
def con(small):
    return oracle.connection(small)


@pytest.mark.parametrize("name", ENTRIES)
def test_rows_equal_sql(spark, con, small, name):
    entry = ENTRIES[name]
    ok, note = oracle.compare(spark, con, small, entry.run, entry.sql)
    assert ok, note
    assert "types differ" not in note


@pytest.fixture
def no_broadcast(spark):
    spark.catalog.clearCache()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(ENTRIES) - EAGER))
def test_plan_scales(spark, small, no_broadcast, name):
    """No Python in the plan, and no join that needs one side in memory."""
    plan = ENTRIES[name].run(spark, small)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Broadcast", "ObjectHash"):
        assert operator not in plan, operator


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_snapshot_reads_the_lines_once(spark, small, threshold):
    """Roll-up and order masks share one exchange of invoice months."""
    from ledgerline.registry.common import snapshot

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = snapshot(spark, small, 12)
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan
    assert sum("FileScan" in line and "l_quantity" in line for line in plan.splitlines()) == 1


def test_every_query_has_sql():
    assert [name for name, e in ENTRIES.items() if e.sql is None] == []


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
