"""Run registered queries against their SQL and compare the rows.

``python tests/oracle.py SF_DIR [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


SAME = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "date": "DATE",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connection(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def type_notes(frame, result) -> str:
    """Columns whose Spark and DuckDB types differ, for information."""
    other = {c[0]: str(c[1]) for c in result.description}
    notes = []
    for name, kind in frame.dtypes:
        want = SAME.get(kind, kind)
        if other[name] != want:
            notes.append(f"{name}: {kind} / {other[name]}")
    return f"; types differ: {', '.join(notes)}" if notes else ""


def compare(spark, con, directory: str, run, sql: str | None) -> tuple[bool, str]:
    frame = run(spark, directory)
    got = rows_of(frame.columns, frame.collect())
    if sql is None:
        return bool(got), f"{len(got)} rows, no SQL"
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(frame.columns)} != {sorted(names)}"
    if got == want:
        return True, f"{len(got)} rows{type_notes(frame, result)}"
    extra = [r for r in got if r not in want][:2] if len(got) < 5000 else got[:1]
    missing = [r for r in want if r not in got][:2] if len(got) < 5000 else want[:1]
    return False, f"{len(got)} vs {len(want)} rows; extra {extra}; missing {missing}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from ledgerline.session import local_session

    directory, *chosen = sys.argv[1:]
    spark, con = local_session(), connection(directory)
    expected, failures = oracle_sql(), []
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, directory, run, expected.get(name))
        except Exception as error:  # one broken query must not hide the others
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
        if not ok:
            failures.append(name)
    print("failures:", failures)
    sys.exit(bool(failures))


if __name__ == "__main__":
    main()
