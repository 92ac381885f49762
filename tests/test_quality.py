"""Load rules, file readers and client masters on rows made for each fault."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ledgerline.operators import quality
from ledgerline.schemas import CUSTOMERS, PRODUCTS, SALES, as_text
from ledgerline.sources import files, store

HEADER = "invoice_id,customer_id,invoice_date,product_id,quantity,revenue,store_id"
GOOD = ("i1", "7", "2024-01-31", "3", "2", "10.50", None)


def reasons(spark, schema, rules, *rows):
    frame = spark.createDataFrame(list(rows), as_text(schema))
    return [list(r.reasons) for r in quality.checked(frame, rules).collect()]


def changed(row, **values):
    named = dict(zip(SALES.names, row, strict=True)) | values
    return tuple(named[n] for n in SALES.names)


def test_sales_faults(spark):
    got = reasons(
        spark,
        SALES,
        quality.sales_rules(),
        GOOD,
        changed(GOOD, invoice_date="abcd-ef-gh"),
        changed(GOOD, invoice_date="2024-13-01"),
        changed(GOOD, invoice_date="2024-1-5"),
        changed(GOOD, invoice_date=None),
        changed(GOOD, customer_id=None),
        changed(GOOD, quantity="abc"),
        changed(GOOD, quantity="-2"),
        changed(GOOD, customer_id="x", revenue=None),
    )
    assert got == [
        [], ["bad_date"], ["bad_date"], ["bad_date"], ["missing_invoice_date"],
        ["missing_customer_id"], ["bad_quantity"], [], ["bad_customer_id", "missing_revenue"],
    ]


def test_product_and_customer_faults(spark):
    got = reasons(
        spark,
        PRODUCTS,
        quality.product_rules(),
        ("1", "a", "b", "gift", "1"),
        ("1", "a", "b", "consumable", None),
        ("1", "a", "b", "device", None),
        (None, "a", "b", "consumable", "0"),
    )
    assert got == [["bad_category"], ["missing_unit_size"], [], ["missing_product_id"]]
    base = ("1", "n", None, None, None, None, "0050")
    got = reasons(
        spark,
        CUSTOMERS,
        quality.customer_rules(),
        (*base, None, "2", "1"),
        (*base, "0", None, "1"),
        (*base, "0", "yes", None),
    )
    assert got == [["bad_opt_flag"], [], ["bad_opt_flag"]]


def test_split_types_clean_rows(spark):
    frame = spark.createDataFrame([GOOD, changed(GOOD, quantity="x")], as_text(SALES))
    clean, bad = quality.split(frame, SALES, quality.sales_rules())
    row = clean.first()
    assert row.invoice_date == date(2024, 1, 31) and row.quantity == Decimal("2.0000")
    assert row.customer_id == 7 and row.store_id is None
    assert bad.count() == 1
    assert [f.dataType for f in clean.schema] == [f.dataType for f in SALES]


def test_one_per_key_keeps_every_row_somewhere(spark):
    rows = [(7, "b"), (7, "a"), (7, "a"), (8, None), (8, "z"), (9, "q")] + [(7, "c")] * 40
    frame = spark.createDataFrame(rows, "customer_id long, name string")
    clean, rest = quality.one_per_key(frame, "customer_id")
    assert {tuple(r) for r in clean.collect()} == {(7, "a"), (8, None), (9, "q")}
    copies = {(r.customer_id, r.name): r.copies for r in rest.collect()}
    assert copies == {(7, "a"): 1, (7, "b"): 1, (7, "c"): 40, (8, "z"): 1}


def test_orphans(spark):
    sales = spark.createDataFrame(
        [("i", 1, 1), ("i", 9999, 1), ("j", 9999, 9999)],
        "invoice_id string, customer_id long, product_id long",
    )
    one = spark.range(1, 2)
    masters = one.withColumnRenamed("id", "customer_id"), one.withColumnRenamed("id", "product_id")
    rows = {tuple(r) for r in quality.orphan_keys(sales, *masters).collect()}
    assert rows == {("customer_id", 9999, 2), ("product_id", 9999, 1)}
    clean, bad = quality.without_orphans(sales, *masters)
    assert clean.count() == 1
    assert sorted(len(r.reasons) for r in bad.collect()) == [1, 2]


def test_merge_keeps_the_earlier_buyer(spark):
    clients = spark.createDataFrame(
        [(1, "555"), (2, "555"), (3, None), (4, "777"), (5, "888"), (6, "888")],
        "customer_id long, mobile_number string",
    )
    firsts = spark.createDataFrame(
        [(1, date(2024, 1, 1)), (2, date(2023, 1, 1)), (6, date(2024, 2, 2))],
        "customer_id long, first_purchase date",
    )
    merged = quality.merge_map(clients, firsts)
    assert {(r.customer_id, r.survivor_id, r.first_purchase) for r in merged.collect()} == {
        (1, 2, date(2023, 1, 1)), (2, 2, date(2023, 1, 1)),
        (5, 6, date(2024, 2, 2)), (6, 6, date(2024, 2, 2)),
    }
    sales = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "customer_id long, invoice_id string")
    rows = quality.merge_duplicates(sales, merged).collect()
    assert {tuple(r) for r in rows} == {(2, "a"), (2, "b"), (3, "c")}


def test_upsert(spark):
    clients = spark.createDataFrame(
        [(1, "Ann", "111"), (2, "Bob", "222"), (3, "Cy", "222")],
        "customer_id long, name string, mobile_number string",
    )
    updates = spark.createDataFrame(
        [(1, "Anne", None, 1), (1, "Anna", None, 2), (None, "Rob", "222", 1), (None, "Dee", "444", 1),
         (None, "Di", "444", 3), (9, "Eve", "999", 1), (None, "lost", None, 1)],
        "customer_id long, name string, mobile_number string, updated_at int",
    )
    rows = quality.upsert_clients(clients, updates).collect()
    got = {(r.customer_id, r.name, r.mobile_number, r.action) for r in rows}
    assert got == {
        (1, "Anna", "111", "updated"), (2, "Rob", "222", "updated"), (3, "Cy", "222", "kept"),
        (None, "Di", "444", "created"), (9, "Eve", "999", "created"),
    }


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "sales_transactions_2023.csv").write_text(
        HEADER + "\ni1,1,2023-05-05,3,2,9.5,\ni2,,2023-05-06,3,2,9.5,4\n"
    )
    # Other column order, no store, one more column.
    (tmp_path / "sales_transactions_2024.csv").write_text(
        "customer_id,invoice_id,invoice_date,product_id,revenue,quantity,note\n"
        '2,"i""3",2024-01-01,3,1,5,"a, b"\n'
    )
    (tmp_path / "sales_transactions_2025.csv").write_text(
        HEADER.replace("quantity,", "") + "\ni9,1,2025-01-01,3,5,1\n"
    )
    return tmp_path


def test_sales_files_by_header(spark, landing):
    paths = files.list_files(spark, f"{landing}/{files.SALES_FILES}")
    rows, refused = files.read_text_table(spark, paths, SALES)
    assert [list(v) for v in refused.values()] == [["quantity"]]
    got = {(r.invoice_id, r.customer_id, r.quantity, r.store_id, r.file) for r in rows.collect()}
    assert got == {
        ("i1", "1", "2", None, "sales_transactions_2023.csv"),
        ("i2", None, "2", "4", "sales_transactions_2023.csv"),
        ('i"3', "2", "5", None, "sales_transactions_2024.csv"),
    }
    loaded = files.read_sales_years(spark, str(landing))
    assert loaded.refused == {"sales_transactions_2025.csv": ["quantity"]}
    assert (loaded.clean.count(), loaded.quarantine.count()) == (2, 1)
    with pytest.raises(ValueError, match="quantity"):
        files.read_sales_years(spark, str(landing), "sales_transactions_2025.csv")


def test_names_of_parts_mean_nothing(spark, tmp_path):
    """Two delivered files with the names of parts and other column orders."""
    for name, columns, row in (
        ("part-1.csv", "a,b,c", "1,2,3"), ("part-2.csv", "c,a,b", "6,4,5"), ("part-3.csv", '"a","b"', '"7","x ""y"", z"'),
    ):
        (tmp_path / name).write_text(f"\ufeff{columns}\r\n{row}\r\n" if "2" in name else f"{columns}\n{row}\n")
    schema = T.StructType([T.StructField(n, T.StringType(), n == "c") for n in "abc"])
    paths = files.list_files(spark, f"{tmp_path}/*.csv")
    rows, refused = files.read_text_table(spark, paths, schema)
    got = sorted((r.a, r.b, r.c, r.file) for r in rows.collect())
    assert got == [("1", "2", "3", "part-1.csv"), ("4", "5", "6", "part-2.csv"), ("7", 'x "y", z', None, "part-3.csv")]
    assert refused == {}


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_many_files_take_few_jobs(spark, tmp_path):
    for i in range(60):
        columns = HEADER if i % 2 else HEADER.replace("quantity,", "")
        (tmp_path / f"sales_transactions_{i:04}.csv").write_text(f"{columns}\n" + "x,1,2024-01-01,1,1,1,1\n" * 3)
    (tmp_path / "sales_transactions_none.csv").write_text("")
    paths = files.list_files(spark, f"{tmp_path}/*.csv")
    found = {}
    # Spark lists many paths in a job of its own.
    assert jobs_of(spark, "headers", lambda: found.update(files.headers(spark, paths))) <= 2
    assert [len(found[p]) for p in paths] == [6, 7] * 30 + [0]
    refused = files.read_text_table(spark, paths, SALES)[1]
    assert len(refused) == 31 and refused["sales_transactions_0000.csv"] == ["quantity"]


def test_large_files_are_left_after_their_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n" + "1,2\n" * 300_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        path = f"{tmp_path}/a.csv"
        assert files.headers(spark, [path]) == {path: ("x", "y")}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_summary_notes_repeated_and_unknown_ids(spark, landing):
    (landing / files.CUSTOMER_FILE).write_text(
        ",".join(CUSTOMERS.names) + "\n" + "1,Ann,,,,,,1,,0\n1,Ann,,,,,,1,,0\n1,Al,,,,,,1,,0\n5,Bo,,,,,,3,,0\n"
    )
    (landing / files.PRODUCT_FILE).write_text("product_id,product_name,brand,category,unit_size\n9,a,b,device,\n")
    rows = {r.file: r for r in files.full_load_summary(spark, str(landing)).collect()}
    clients = rows[files.CUSTOMER_FILE]
    assert (clients.kind, clients.rows, clients.imported) == ("Clients", 4, 1)
    assert clients.note == "1 bad_opt_flag; 2 duplicate_id"
    assert rows["sales_transactions_2023.csv"].note == "1 missing_customer_id; 1 unknown_product_id"
    assert rows["sales_transactions_2024.csv"].note == "1 unknown_customer_id; 1 unknown_product_id"
    assert rows["sales_transactions_2025.csv"].status == "Failed"


def test_load_summary(spark, landing):
    rows = {r.file[-8:-4]: r for r in files.sales_load_summary(spark, str(landing)).collect()}
    assert (rows["2023"].rows, rows["2023"].imported, rows["2023"].note) == (
        2, 1, "1 missing_customer_id",
    )
    assert (rows["2024"].status, rows["2024"].note) == ("Processed", "")
    assert (rows["2025"].status, rows["2025"].imported) == ("Failed", 0)
    assert rows["2025"].note == "missing columns: quantity"


def test_masters_keep_text_and_line_breaks(spark, tmp_path):
    (tmp_path / files.CUSTOMER_FILE).write_text(
        ",".join(CUSTOMERS.names) + '\n7,"Ann\nLee",Loyalty,,2024-02-30,,0050,1,,0\n'
        "8,Bo,,,2024-02-28,,0051,1,,0\n"
    )
    clean, bad, _ = files.read_customers(spark, str(tmp_path))
    row = clean.first()
    assert (row.customer_id, row.mobile_number, row.opt_sms) == (8, "0051", None)
    assert row.created_date == date(2024, 2, 28)
    assert bad.first().customer_name == "Ann\nLee"


def test_repeated_master_keys_and_malformed_rows(spark, tmp_path):
    head = ",".join(CUSTOMERS.names) + "\n"
    row = "8,Bo,,,2024-02-28,,0051,1,,0"
    (tmp_path / files.CUSTOMER_FILE).write_text(
        head + f"{row}\n{row}\n{row}\n8,Cy,,,2024-02-28,,0052,1,,0\n9,Di,,\n10,Ed,,,2024-02-28,,0053,1,,0,7\n"
    )
    clean, bad, _ = files.read_customers(spark, str(tmp_path))
    assert [(r.customer_id, r.customer_name) for r in clean.collect()] == [(8, "Bo")]
    got = {(r.customer_id, r.customer_name): (r.copies, r.reasons) for r in bad.collect()}
    assert got[("8", "Bo")] == (2, ["duplicate_id"])
    assert got[("8", "Cy")] == (1, ["duplicate_id"])
    assert "malformed_row" in got[("9", "Di")][1] and "malformed_row" in got[("10", "Ed")][1]


def test_updates_without_address(spark):
    rows = [(1, None), (None, "5"), (None, None)]
    updates = spark.createDataFrame(rows, "customer_id long, mobile_number string")
    lost = quality.unaddressed_updates(updates).collect()
    assert [tuple(r)[:2] for r in lost] == [(None, None)] and lost[0].reasons == ["no_id_or_phone"]


def test_export_quotes(spark, tmp_path):
    frame = spark.createDataFrame([(1, 'say "a", b', None), (2, "", "x")], "id int, t string, u string")
    files.export_csv(frame.coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("part-*.csv")).read_text()
    assert text == 'id,t,u\n1,"say ""a"", b",\n2,,x\n'


def test_snapshot_months_are_replaced_one_by_one(spark, tmp_path, small):
    from ledgerline.registry.common import snapshot

    path = str(tmp_path / "snap")
    store.write_snapshot(snapshot(spark, small, 3), path)
    store.write_snapshot(snapshot(spark, small, 1), path)
    back = store.read_snapshot(spark, path)
    assert back.exceptAll(snapshot(spark, small, 3)).count() == 0
    assert back.count() == snapshot(spark, small, 3).count()
    plan = store.read_snapshot(spark, path, date(2001, 7, 31))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(report_mth_eom" in plan


def test_only_busy_keys_are_spread(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators.shape import _bucket, busy_buckets, spread_join

    left = spark.range(1200).select(
        F.when(F.col("id") < 600, 7).when(F.col("id") < 1190, F.col("id")).alias("k"), "id"
    )
    right = spark.range(1200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    none = busy_buckets(left, "k")
    some = busy_buckets(left, "k", least=100, share=10)
    assert not any(none.first().busy)
    bucket = left.where("k = 7").select(_bucket("k").alias("b")).first().b
    bits = [(i, j) for i, word in enumerate(some.first().busy) for j in range(64) if word >> j & 1]
    assert bits == [divmod(bucket, 64)]
    assert not any(busy_buckets(left.limit(0), "k").first().busy)
    for how in ("inner", "left"):
        expected = sorted(left.join(right, "k", how).collect(), key=str)
        for busy in (none, some):
            got = spread_join(left, right, "k", how, busy=busy)
            assert sorted(got.collect(), key=str) == expected
    # Only the right rows of the busy bucket are repeated: one key here, 16 parts.
    few = right.where("k in (7, 600, 601)")
    unmatched = left.where("k is null")
    repeated = [spread_join(unmatched, few, "k", "right", busy=b).count() for b in (none, some)]
    assert repeated == [3, 18]
    plan = spread_join(left, right, "k", busy=some)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "ObjectHash" not in plan


def test_days_are_read_by_cast(spark):
    """Only whole, existing days in ten characters count, and no date pattern is run."""
    days = {
        "2024-02-29": "2024-02-29",
        "0001-01-01": "0001-01-01",
        **dict.fromkeys(
            ["2023-02-29", "2024-13-01", "2024-1-1", "abcd-ef-gh", "", "2024-01-01\n", " 2024-01-01"]
        ),
        **dict.fromkeys(["2024-01-01T00", "12024-01-01", "2024-04-31", None]),
    }
    field = quality.SALES["invoice_date"]
    rows = spark.createDataFrame([(d,) for d in days], "invoice_date string")
    read = rows.select("invoice_date", quality.typed(field).cast("string").alias("day"))
    assert {r.invoice_date: r.day for r in read.collect()} == days
    assert "gettimestamp" not in read._jdf.queryExecution().optimizedPlan().toString()
