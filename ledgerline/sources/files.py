"""CSV landing files: readers by header, and the CSV export."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Callable, Sequence
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.quality import (
    COPIES,
    REASONS,
    checked,
    customer_rules,
    load_summary,
    one_per_key,
    product_rules,
    sales_rules,
    split,
)
from ledgerline.schemas import CUSTOMERS, PRODUCTS, SALES, as_text

# File names of the three input families.
SALES_FILES = "sales_transactions_*.csv"
CUSTOMER_FILE = "customers_master.csv"
PRODUCT_FILE = "products_master.csv"
MALFORMED = "malformed"
ARRIVED = "arrived"
# Fixed value: the columns of Spark's source of whole files.
WHOLE_FILES = "path string, modificationTime timestamp, length bigint, content binary"


class Loaded(NamedTuple):
    """Good rows, bad rows, and whole files refused with the columns they lack."""

    clean: DataFrame
    quarantine: DataFrame
    refused: dict[str, list[str]]


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a glob, in name order."""
    return sorted(spark.read.text(pattern).inputFiles())


def delivered(path: Column, unit: str) -> Column:
    """Name of what was delivered: a file, or a folder of parts with one name.

    Nothing is read into names: whoever delivers folders says so by ``unit``.
    """
    return F.element_at(F.split(path, "/"), -2 if unit == "folder" else -1)


def delivered_name(path: str, unit: str) -> str:
    return path.rsplit("/", 2)[-2 if unit == "folder" else -1]


def plain_path(path: str) -> str:
    """One spelling of a path, however it was listed: decoded, local ones without scheme."""
    return re.sub(r"^file:/+", "/", re.sub(r"^(\w+):/+", r"\1:/", unquote(path)))


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The column names of each file, from one job over all of them.

    A task leaves a split that fills it after its first line, so large files
    aren't read; small ones, several a task, are. A file without lines has no
    columns.
    """
    whole = spark.conf.get("spark.sql.files.maxPartitionBytes")
    full = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(whole)

    def first_lines(batches):
        last = None
        for batch in batches:
            places = batch.select(["path", "start", "length"]).to_pylist()
            for at, row in enumerate(places):
                if row["path"] != last and row["start"] == 0:
                    line = batch.column("value").slice(at, 1)
                    yield pa.RecordBatch.from_arrays([pa.array([row["path"]]), line], ["path", "line"])
                last = row["path"]
                if row["length"] >= full:
                    return

    where = F.col("_metadata")
    lines = spark.read.text(list(paths)).select(
        "value",
        where["file_path"].alias("path"),
        where["file_block_start"].alias("start"),
        where["file_block_length"].alias("length"),
    )
    found = lines.mapInArrow(first_lines, "path string, line string").collect()
    known = {plain_path(r.path): next(csv.reader([r.line.removeprefix("\ufeff")])) for r in found}
    return {path: tuple(known.get(plain_path(path), ())) for path in paths}


def missing_columns(names: Sequence[str], schema: T.StructType) -> list[str]:
    """Required columns that a file lacks."""
    return [f.name for f in schema if not f.nullable and f.name not in names]


def read_text_table(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType,
    line_breaks: bool = False,
    unit: str = "file",
) -> tuple[DataFrame, dict[str, list[str]]]:
    """The listed columns as text with their file name, and the files refused.

    ``malformed`` holds the line of a row with too few or too many fields, which
    ``with_shape`` turns into a rule; ``arrived`` is the time its file landed.

    Columns are found by header name, in any order; an absent optional column
    is NULL, as are empty fields. Spark maps a CSV schema by position, so
    files are grouped by header and each group is read in one scan. A delivered
    folder is refused if one of its files lacks a required column. Fields with
    line breaks need ``line_breaks``, which gives up splitting a file.
    """
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    refused: dict[str, list[str]] = {}
    names_of = headers(spark, paths) if paths else {}
    for path, names in names_of.items():
        # A part without a line, not even a header, has nothing to refuse.
        lacking = missing_columns(names, schema) if names or unit == "file" else []
        if lacking:
            refused.setdefault(delivered_name(path, unit), lacking)
    for path, names in names_of.items():
        if names and delivered_name(path, unit) not in refused:
            groups[names].append(path)
    frames = []
    for names, members in groups.items():
        layout = T.StructType([T.StructField(n, T.StringType()) for n in (*names, MALFORMED)])
        rows = (
            spark.read.schema(layout)
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("multiLine", line_breaks)
            .option("columnNameOfCorruptRecord", MALFORMED)
            .option("columnPruning", False)  # else fields are not counted
            .csv(members)
        )
        columns = [
            F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast("string").alias(f.name)
            for f in schema
        ]
        file = delivered(F.col("_metadata.file_path"), unit).alias("file")
        landed = F.col("_metadata.file_modification_time").alias(ARRIVED)
        frames.append(rows.select(*columns, file, MALFORMED, landed))
    if not frames:
        more = [T.StructField(n, T.StringType()) for n in ("file", MALFORMED)]
        more.append(T.StructField(ARRIVED, T.TimestampType()))
        empty = T.StructType([*as_text(schema), *more])
        return spark.createDataFrame([], empty), refused
    table = frames[0]
    for frame in frames[1:]:
        table = table.unionByName(frame)
    return table, refused


def with_shape(rules: dict[str, Column]) -> dict[str, Column]:
    return {**rules, "malformed_row": F.col(MALFORMED).isNotNull()}


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rules: dict,
    line_breaks: bool = False,
    unit: str = "file",
) -> Loaded:
    """Typed rows, quarantine, and refused files with the columns that they lack.

    A refused file doesn't keep others from loading; it is an error only where
    nothing else was delivered.
    """
    rows, refused = read_text_table(spark, list_files(spark, path), schema, line_breaks, unit)
    if refused and rows.isEmpty():
        raise ValueError(f"required columns missing: {refused}")
    clean, bad = split(rows, schema, with_shape(rules))
    return Loaded(clean.drop(MALFORMED, ARRIVED), bad.drop(MALFORMED, ARRIVED), refused)


def read_master(
    spark: SparkSession, path: str, schema: T.StructType, rules: dict, key: str, unit: str = "file"
) -> Loaded:
    """One row per key. The smallest row stays, others go to quarantine as text,
    equal ones as one row with their number in ``copies``."""
    rows, bad, refused = read_csv_table(spark, path, schema, rules, True, unit)
    clean, repeated = one_per_key(rows, key)
    again = repeated.select(
        *[F.col(c).cast("string").alias(c) for c in rows.columns],
        F.array(F.lit("duplicate_id")).alias(REASONS),
        COPIES,
    )
    both = bad.withColumn(COPIES, F.lit(1).cast("long")).unionByName(again)
    return Loaded(clean, both, refused)


def read_sales_years(
    spark: SparkSession, directory: str, pattern: str = SALES_FILES, unit: str = "file"
) -> Loaded:
    return read_csv_table(spark, f"{directory}/{pattern}", SALES, sales_rules(), unit=unit)


def read_customers(spark: SparkSession, directory: str, unit: str = "file") -> Loaded:
    path = f"{directory}/{CUSTOMER_FILE}"
    return read_master(spark, path, CUSTOMERS, customer_rules(), "customer_id", unit)


def read_products(spark: SparkSession, directory: str, unit: str = "file") -> Loaded:
    path = f"{directory}/{PRODUCT_FILE}"
    return read_master(spark, path, PRODUCTS, product_rules(), "product_id", unit)


class Kind(NamedTuple):
    """A kind of delivery: its name in the summary, files, columns and rules."""

    name: str
    pattern: str
    schema: T.StructType
    rules: Callable[[], dict[str, Column]]
    key: str | None = None


SALES_KIND = Kind("Transactions", SALES_FILES, SALES, sales_rules)
# Names of the kinds in the load summary.
KINDS = (
    SALES_KIND,
    Kind("Clients", CUSTOMER_FILE, CUSTOMERS, customer_rules, "customer_id"),
    Kind("Products", PRODUCT_FILE, PRODUCTS, product_rules, "product_id"),
)


def kind_summary(spark: SparkSession, directory: str, kind: Kind, unit: str = "file") -> DataFrame:
    """Load result per file of one kind, refused files included.

    Of a master's rows with one id, one is imported; the others are counted as
    duplicate ids, in the file of their row. Ids are counted, not gathered.
    """
    paths = list_files(spark, f"{directory}/{kind.pattern}")
    rows, refused = read_text_table(spark, paths, kind.schema, kind.key is not None, unit)
    marked = checked(rows, with_shape(kind.rules())).select(*[c for c in (kind.key,) if c], "file", REASONS)
    summary = load_summary(marked, kind.name)
    if kind.key is not None:
        good = marked.where(F.size(REASONS) == 0)
        per_id = good.groupBy(kind.key, "file").agg(F.count(F.lit(1)).alias("n"))
        # The first file of an id keeps one row of it.
        firsts = per_id.groupBy(kind.key).agg(F.min("file").alias("file"), F.lit(1).alias("kept"))
        repeated = (
            per_id.join(firsts, [kind.key, "file"], "left")
            .groupBy("file")
            .agg(F.sum(F.col("n") - F.coalesce("kept", F.lit(0))).alias("repeated"))
            .where(F.col("repeated") > 0)
        )
        summary = with_fault(summary, repeated, "repeated", "duplicate_id")
    for name, lacking in refused.items():
        refused_paths = [p for p in paths if delivered_name(p, unit) == name]
        lines = spark.read.option("header", True).option("escape", '"').csv(refused_paths)
        failed = lines.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("file"),
            F.lit(kind.name).alias("kind"),
            "rows",
            F.lit(0).cast("long").alias("imported"),
            F.lit("Failed").alias("status"),
            F.lit("missing columns: " + ", ".join(lacking)).alias("note"),
        )
        summary = summary.unionByName(failed)
    return summary


def with_fault(summary: DataFrame, counts: DataFrame, column: str, reason: str) -> DataFrame:
    """A summary less the rows counted by file, which its note then names."""
    n = F.coalesce(column, F.lit(0).cast("long"))
    words = F.when(n > 0, F.concat_ws(" ", n.cast("string"), F.lit(reason)))
    imported = F.col("imported") - n
    return summary.join(counts, "file", "left").select(
        "file",
        "kind",
        "rows",
        imported.alias("imported"),
        F.when(imported > 0, "Processed").otherwise("Failed").alias("status"),
        F.concat_ws("; ", F.nullif("note", F.lit("")), words).alias("note"),
    )


def sales_load_summary(
    spark: SparkSession, directory: str, pattern: str = SALES_FILES, unit: str = "file"
) -> DataFrame:
    return kind_summary(spark, directory, SALES_KIND._replace(pattern=pattern), unit)


def full_load_summary(
    spark: SparkSession,
    directory: str,
    kinds: Sequence[Kind] = KINDS,
    unit: str = "file",
) -> DataFrame:
    """Load results of sales and masters; lines of unknown clients and products
    are imported, and the note of their file counts them."""
    found = [kind_summary(spark, directory, kind, unit) for kind in kinds]
    sales = next(kind for kind in kinds if kind.schema is SALES)
    lines, _ = read_text_table(spark, list_files(spark, f"{directory}/{sales.pattern}"), SALES, unit=unit)
    good = checked(lines, with_shape(sales_rules())).where(F.size(REASONS) == 0)
    summary = found[kinds.index(sales)]
    for kind in kinds:
        if kind.key is None:
            continue
        # Few distinct ids a file stand for many lines on the way to the master.
        per_id = good.groupBy("file", kind.key).agg(F.count(F.lit(1)).alias("n"))
        path = f"{directory}/{kind.pattern}"
        known, _ = read_text_table(spark, list_files(spark, path), kind.schema, True, unit)
        known = checked(known, with_shape(kind.rules())).where(F.size(REASONS) == 0)
        number = F.col(kind.key).cast("long").alias(kind.key)
        lost = per_id.select("file", number, "n").join(known.select(number).distinct(), kind.key, "left_anti")
        counts = lost.groupBy("file").agg(F.sum("n").alias("unknown"))
        words = F.concat_ws(" ", F.col("unknown").cast("string"), F.lit(f"unknown_{kind.key}"))
        note = F.concat_ws("; ", F.nullif("note", F.lit("")), F.when(F.col("unknown") > 0, words))
        summary = summary.join(counts, "file", "left").withColumn("note", note).drop("unknown")
    found[kinds.index(sales)] = summary
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def upload_failures(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("status") == "Failed")


def arrivals(spark: SparkSession, directory: str) -> DataFrame:
    """New files as a stream of their paths; their contents stay unread."""
    files = spark.readStream.format("binaryFile").schema(WHOLE_FILES)
    return files.load(directory).select("path")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV parts with a header; NULL is empty, quotes are doubled, blanks stay."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option(
        "escape", '"'
    ).option("emptyValue", "").option("nullValue", "").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
