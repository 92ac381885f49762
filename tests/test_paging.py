"""Paging past nulls, and exported blanks."""

from ledgerline.operators import shape
from ledgerline.sources import files


def test_page_after_a_null(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, None), (3, None), (4, 7.0)], "k int, v double")
    ids = lambda *last: [r.k for r in shape.page_after(rows, "v", "k", *last).collect()]
    assert ids(7.0, 4) == [1, 2, 3]
    assert ids(None, 2) == [3]
    assert ids(None, 3) == []


def test_export_keeps_blanks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "  a b ")], "id int, name string")
    files.export_csv(rows, f"{tmp_path}/out")
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert "1,  a b " in text
