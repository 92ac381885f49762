"""Arrival refresh and the daily stream: replays, late lines, re-sent rows."""

from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.plans.snapshot import customer_snapshot
from ledgerline.registry.common import tables
from ledgerline.schemas import SALES
from ledgerline.sources import files, star
from ledgerline.streaming import arrival, daily

PARAMS = star.snapshot_params(4)


@pytest.fixture(scope="module")
def canonical(spark, small):
    t = tables(spark, small)
    return t, t.sales.select(*SALES.names).persist()


def same(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def arrive(spark, refresh, folder):
    arriving = files.arrivals(spark, f"{folder}/landing/*")
    arrival.refresh_on_arrival(arriving, refresh).awaitTermination()


def test_two_drops_with_late_and_bad_lines_equal_one_batch(spark, canonical, tmp_path):
    t, sales = canonical
    refresh = arrival.Refresh(spark, str(tmp_path), t.products, t.customers, PARAMS)
    late = (F.col("quantity") > 45) | (F.col("invoice_date") > "2001-06-15")
    files.export_csv(sales.where(~late), f"{tmp_path}/landing/1")
    arrive(spark, refresh, tmp_path)
    bad = sales.where("quantity > 49").withColumn("invoice_date", F.lit("2001-99-01"))
    text = sales.where(late).withColumn("invoice_date", F.col("invoice_date").cast("string"))
    files.export_csv(text.unionByName(bad), f"{tmp_path}/landing/2")
    arrive(spark, refresh, tmp_path)
    whole = customer_snapshot(sales, t.products, t.customers, PARAMS)
    assert same(refresh.snapshot(), whole)
    quarantine = spark.read.parquet(refresh.path("quarantine"))
    assert quarantine.count() == bad.count()
    assert {r.reasons for r in quarantine.select("reasons").distinct().collect()} == {"bad_date"}
    # Old years were read from the yearly totals.
    old = refresh.history(PARAMS.first_month).where("month < 1998 * 12")
    assert old.count() == refresh.yearly().where("year < 1998").count() > 0
    assert old.where("month % 12 != 11").count() == 0
    feed = refresh.feed()
    assert same(arrival.standing_events(feed), arrival.change_feed(whole))
    # An event is told once, and again only after it was retracted.
    told = feed.groupBy(*arrival.EVENT).agg(
        F.count_if(F.col("action") == "added").alias("added"),
        F.count_if(F.col("action") == "retracted").alias("retracted"),
    )
    assert told.where("added - retracted not in (0, 1) or added > 2").count() == 0
    assert feed.where("action = 'retracted'").count() > 0


def test_running_a_batch_again_changes_nothing(spark, canonical, tmp_path):
    t, sales = canonical
    refresh = arrival.Refresh(spark, str(tmp_path), t.products, t.customers, PARAMS)
    text = sales.select([F.col(n).cast("string") for n in SALES.names])
    old, new = text.where("invoice_date < '2001-03-01'"), text.where("invoice_date >= '2001-03-01'")
    refresh(old, 0)
    refresh(new, 1)
    first = refresh.snapshot().collect()
    refresh(new, 1)
    assert sorted(refresh.snapshot().collect(), key=str) == sorted(first, key=str)
    assert refresh.lines().count() == sales.count()


def test_old_late_lines_and_new_months(spark, canonical, tmp_path):
    t, sales = canonical
    start = replace(PARAMS, latest=date(2001, 1, 31), months=2)
    refresh = arrival.Refresh(spark, str(tmp_path), t.products, t.customers, start)
    text = [F.col(n).cast("string") for n in SALES.names]
    late, new = F.col("quantity") > 45, F.col("invoice_date") >= "2001-04-01"
    refresh(sales.where(~late & ~new).select(text), 0)
    # A month without lines lies between, and then lines of all old months come.
    refresh(sales.where(~late & (F.col("invoice_date") >= "2001-05-01")).select(text), 1)
    rest = late | (new & (F.col("invoice_date") < "2001-05-01"))
    refresh(sales.where(rest).select(text), 2)
    newest = sales.agg(F.max("invoice_date")).first()[0] + timedelta(days=1)
    latest = newest.replace(day=1) - timedelta(days=1)
    assert latest > date(2001, 5, 1)
    months = (latest.year - 2000) * 12 + latest.month - 12 + 1
    whole = customer_snapshot(
        sales, t.products, t.customers, replace(start, latest=latest, months=months)
    )
    assert same(refresh.snapshot(), whole)


def test_batch_of_bad_rows_only(spark, canonical, tmp_path):
    t, sales = canonical
    refresh = arrival.Refresh(spark, str(tmp_path), t.products, t.customers, PARAMS)
    text = sales.select([F.col(n).cast("string") for n in SALES.names])
    refresh(text.where("invoice_date >= '2001-07-01'"), 0)
    before = refresh.snapshot().count()
    refresh(text.withColumn("quantity", F.lit("many")), 1)
    assert refresh.snapshot().count() == before
    assert spark.read.parquet(refresh.path("quarantine")).count() == sales.count()


def as_text(rows):
    return rows.select([F.col(n).cast("string") for n in SALES.names])


def test_one_misdated_line_adds_no_months(spark, canonical, tmp_path):
    t, sales = canonical
    start = replace(PARAMS, latest=date(2001, 1, 31), months=2)
    refresh = arrival.Refresh(spark, str(tmp_path), t.products, t.customers, start)
    early = as_text(sales.where("invoice_date < '2001-02-01'"))
    refresh(early, 0)
    before = refresh.snapshot().collect()
    for number, day in ((1, "2012-01-15"), (2, "9999-12-31")):
        refresh(early.limit(1).withColumn("invoice_date", F.lit(day)), number)
    assert sorted(refresh.snapshot().collect(), key=str) == sorted(before, key=str)
    assert refresh.snapshot().select("report_mth_eom").distinct().count() == 2
    quarantine = spark.read.parquet(refresh.path("quarantine"))
    assert [r.reasons for r in quarantine.collect()] == ["date_ahead"] * 2


def write_lines(path, header, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n")


def test_files_load_by_their_own_headers(spark, canonical, tmp_path):
    t, _ = canonical
    refresh = arrival.Refresh(spark, str(tmp_path), t.products, t.customers, PARAMS)
    landing = tmp_path / "landing" / "a day"
    usual = "invoice_id,customer_id,invoice_date,product_id,quantity,revenue,store_id"
    write_lines(landing / "part-1.csv", usual, "a,1,2001-05-02,1,2.0,9.0,4")
    write_lines(landing / "part-2.csv", "revenue,quantity,product_id,invoice_date,customer_id,invoice_id", "7.5,3.0,2,2001-05-03,2,b")
    write_lines(landing / "c.csv", "invoice_id,customer_id,invoice_date,product_id,revenue", "c,1,2001-05-02,1,9.0")
    write_lines(landing / "d.csv", usual, "d,1,2090-05-02,1,2.0,9.0,4", "e,1,2001-05-02,1", "f,x,2001-05-02,1,1,1,1")
    arrive(spark, refresh, tmp_path)
    rows = {r.invoice_id: (float(r.quantity), float(r.revenue), r.store_id) for r in refresh.lines().collect()}
    assert rows == {"a": (2.0, 9.0, 4), "b": (3.0, 7.5, None)}
    assert [(r.file, r.missing, r.batch_id) for r in refresh.refused().collect()] == [("c.csv", "quantity", 0)]
    reasons = {r.invoice_id: r.reasons for r in spark.read.parquet(refresh.path("quarantine")).collect()}
    assert reasons["d"] == "date_ahead" and "malformed_row" in reasons["e"] and reasons["f"] == "bad_customer_id"


def test_many_drops_become_one_folder_a_month(spark, canonical, tmp_path):
    t, sales = canonical
    refresh = arrival.Refresh(spark, str(tmp_path), t.products, t.customers, PARAMS, most_folders=4)
    span = sales.where("invoice_date between '2001-05-01' and '2001-06-30'")
    part = F.pmod(F.xxhash64("invoice_id", "product_id", "quantity"), F.lit(20))
    text = as_text(span.withColumn("part", part).sort("invoice_id")).withColumn("part", part).persist()
    for drop in range(20):
        refresh.load(as_text(text.where(F.col("part") == drop)), drop)
    expected = as_text(span).exceptAll(as_text(refresh.lines()))
    assert expected.count() == 0 and refresh.lines().count() == span.count()
    version = refresh.manifest.read()
    assert all(len(paths) <= 5 for paths in version.folders.values())
    # Killed after the merged folder is written and before the switch: nothing has changed.
    class Killed(Exception):
        pass

    def killed(*_):
        raise Killed

    eager = replace(refresh, most_folders=1)
    eager.manifest.commit, kept = killed, eager.manifest.commit
    with pytest.raises(Killed):
        eager.merged(version)
    assert refresh.manifest.read() == version and refresh.lines().count() == span.count()
    eager.manifest.commit = kept
    reading = refresh.lines()
    merged = eager.merged(version)
    # Readers of the old version go on; the new one has a folder a month.
    assert reading.count() == refresh.lines().count() == span.count()
    assert {m: len(paths) for m, paths in merged.folders.items()} == dict.fromkeys(version.folders, 1)
    refresh.vacuum(replayable=False)
    left = refresh.manifest.subfolders(refresh.path("lines"), 2)
    assert sorted(p.rsplit("=", 1)[1] for p in left) == sorted(str(m) for m in version.folders)
    assert as_text(span).exceptAll(as_text(refresh.lines())).count() == 0


def test_a_replayed_batch_starts_from_the_batches_before(spark, canonical, tmp_path):
    t, sales = canonical
    refresh = arrival.Refresh(spark, str(tmp_path), t.products, t.customers, PARAMS, most_folders=1)
    old, new = F.col("invoice_date") < "2001-06-01", F.col("quantity") > 25
    drops = [as_text(sales.where(c)) for c in (old & ~new, old & new, ~old)]
    for number, drop in enumerate(drops[:2]):
        refresh(drop, number)
    refresh(drops[2], 2)
    lines, feed = refresh.lines().count(), sorted(refresh.feed().collect(), key=str)
    snapshot = sorted(refresh.snapshot().collect(), key=str)
    refresh(drops[2], 2)
    assert refresh.lines().count() == lines == sales.count()
    assert sorted(refresh.feed().collect(), key=str) == feed
    assert sorted(refresh.snapshot().collect(), key=str) == snapshot


def write_events(spark, folder, name, rows):
    schema = star.COLUMNS["events"]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in/{name}")


def run_daily(spark, folder):
    arriving = spark.readStream.schema(star.COLUMNS["events"]).parquet(f"{folder}/in/*")
    totals = daily.daily_totals(daily.purchases(arriving), "5 days")
    daily.store_daily(totals, str(folder)).awaitTermination()
    rows = daily.current_daily(spark, str(folder)).collect()
    return {(r.day.day, r.customer_id): (float(r.amount), r.purchases) for r in rows}


def event(number, day, user, value, kind="purchase", hour=12):
    at = datetime(2024, 1, day, hour) + timedelta(seconds=number)
    return (number, at, user, kind, float(value), "{}")


def test_daily_stream_updates_drops_repeats_and_late_rows(spark, tmp_path):
    write_events(
        spark, tmp_path, "a", [event(1, 10, 5, 2), event(2, 10, 5, 3, hour=23), event(3, 10, 6, 1, "view")]
    )
    assert run_daily(spark, tmp_path) == {(10, 5): (5.0, 2)}
    # Row 1 again, a purchase two days late, and a new day.
    write_events(
        spark, tmp_path, "b", [event(1, 10, 5, 2), event(4, 8, 5, 7), event(5, 10, 5, 1), event(6, 28, 6, 9)]
    )
    assert run_daily(spark, tmp_path) == {(10, 5): (6.0, 3), (8, 5): (7.0, 1), (28, 6): (9.0, 1)}
    # By now the watermark stands at the 23rd: the 9th is too late.
    write_events(spark, tmp_path, "c", [event(7, 9, 5, 100), event(8, 27, 6, 4)])
    got = run_daily(spark, tmp_path)
    assert (9, 5) not in got and got[(27, 6)] == (4.0, 1)


def test_ten_batches_leave_one_row_a_key(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "day date, customer_id long, amount decimal(28,6), purchases long")
    a, b = date(2024, 1, 1), date(2024, 1, 2)
    for number in range(10):
        daily.upsert(rows((a, 1, Decimal(number), number), (b, number, Decimal("0.1"), 1)), number, str(tmp_path))
    daily.upsert(rows((a, 1, Decimal(9), 9), (b, 9, Decimal("0.1"), 1)), 9, str(tmp_path))
    stored = daily.current_daily(spark, str(tmp_path))
    assert stored.count() == stored.select("day", "customer_id").distinct().count() == 11
    assert [(r.amount, r.purchases) for r in stored.where("customer_id = 1").orderBy("day").collect()] == [(9, 9), (Decimal("0.1"), 1)]
    daily.vacuum(spark, str(tmp_path))
    assert daily.current_daily(spark, str(tmp_path)).count() == 11
    daily.vacuum(spark, str(tmp_path), replayable=False)
    assert daily.current_daily(spark, str(tmp_path)).count() == 11
    assert len(daily.manifest(spark, str(tmp_path)).subfolders(f"{tmp_path}/daily", 2)) == 2
    assert daily.current_daily(spark, str(tmp_path), first=19724).count() == 10


def test_change_feed_of_consecutive_months_only(spark):
    rows = [
        (date(2024, 1, 31), 1, "Gold", "Active"),
        (date(2024, 2, 29), 1, "Gold", "Active"),
        (date(2024, 3, 31), 1, None, "Not Active"),
        (date(2024, 1, 31), 2, "Gold", "Active"),
        (date(2024, 3, 31), 2, "Silver", "Active"),
    ]
    schema = "report_mth_eom date, customer_id long, value_tier string, activity_status string"
    feed = arrival.change_feed(spark.createDataFrame(rows, schema)).collect()
    assert {(r.customer_id, r.event, r.before, r.after) for r in feed} == {
        (1, "client.category_changed", "Gold", None),
        (1, "client.became_inactive", "Active", "Not Active"),
    }


def test_drops_join_the_lines_once(spark, small, monkeypatch):
    """Landing in several files reads the joined sales once, not once a file."""
    from ledgerline.registry import checks

    seen = spark.sparkContext.accumulator(0)
    joined = star.sales

    def counted(lineitem, orders):
        rows = joined(lineitem, orders)

        def run(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return rows.mapInArrow(run, rows.schema)

    total = star.load(spark, small).sales.count()
    monkeypatch.setattr(star, "sales", counted)
    refresh = checks.refreshed(spark, small, arrival.load_on_arrival)
    assert seen.value == total
    assert refresh.refused().count() == 1
