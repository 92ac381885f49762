"""Zero-filled counts, shares, ranking and paging."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# Column of the part that a sorted row lies in.
PART = "page_part"


def label_counts(
    df: DataFrame, keys: Sequence[str], label: str, labels: Sequence[str]
) -> DataFrame:
    """Rows per key and label with a zero for labels that do not occur."""
    wide = df.groupBy(*keys).agg(
        *[F.count_if(F.col(label) == name).alias(name) for name in labels]
    )
    return wide.unpivot([*keys], [*labels], label, "n")


def spine(df: DataFrame, axes: Mapping[str, Sequence]) -> DataFrame:
    """Every combination of the given axis values, one row each."""
    base = df.sparkSession.range(1).drop("id")
    for name, values in axes.items():
        cells = F.array(*[F.lit(v) for v in values])
        base = base.select("*", F.explode(cells).alias(name))
    return base


def dense_counts(df: DataFrame, axes: Mapping[str, Sequence]) -> DataFrame:
    """Row counts over a fixed grid of axis values, zero where empty."""
    counted = df.groupBy(*axes).agg(F.count(F.lit(1)).alias("n"))
    return (
        spine(df, axes)
        .join(counted, [*axes], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
    )


def share_of_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percent of the column total; for aggregated relations of a few rows."""
    total = F.sum(value).over(Window.partitionBy())
    share = F.col(value).cast("double") / total.cast("double") * 100
    return df.withColumn(name, F.when(total != 0, share))


def most_common(df: DataFrame, key: str, item: str, member: str) -> DataFrame:
    """Per key the item with most distinct members; the smaller item on ties.

    Members are made distinct over (key, item, member), so a heavy key or item
    is spread out, and only per-item counts meet in the ranking.
    """
    counted = (
        df.select(key, item, member)
        .where(F.col(item).isNotNull())
        .distinct()
        .groupBy(key, item)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = Window.partitionBy(key).orderBy(F.desc("n"), F.asc(item))
    return (
        counted.withColumn("place", F.row_number().over(best))
        .where(F.col("place") == 1)
        .drop("place")
    )


def newest(
    df: DataFrame, key: str, order: Sequence[Column], count: int
) -> DataFrame:
    """The first ``count`` rows per key; Spark trims before and after shuffling."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= count)


def sorted_by(df: DataFrame, column: str, key: str, descending: bool) -> DataFrame:
    first = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
    return df.orderBy(first, F.asc(key))


@dataclass(frozen=True)
class Pages:
    """A sorted copy of a relation that knows how many rows each part holds.

    Ranges of the order are parts of their own, so a page is looked up by the
    counts and read from the one or two parts that hold it, however deep it lies.
    """

    rows: DataFrame
    order: tuple[Column, ...]
    counts: tuple[tuple[int, int], ...]

    @property
    def total(self) -> int:
        return sum(n for _, n in self.counts)

    def page(self, number: int, size: int = 50) -> DataFrame:
        """Page ``number`` from 0; a number past the end gives the last page."""
        number = min(number, max(0, -(-self.total // size) - 1))
        start, parts, skipped, before = number * size, [], 0, 0
        for part, n in self.counts:
            if before + n > start and before < start + size:
                skipped = skipped if parts else start - before
                parts.append(part)
            before += n
        chosen = self.rows.where(F.col(PART).isin(parts)).drop(PART)
        return chosen.orderBy(*self.order).offset(skipped).limit(size)


def paged(df: DataFrame, order: Sequence[Column], folder: str, parts: int | None = None) -> Pages:
    """Sort a relation once into parts below ``folder``, for any number of pages.

    ``parts`` defaults to the session's shuffle partitions; the driver sees one
    count a part.
    """
    ranged = df.repartitionByRange(*([parts] if parts else []), *order)
    numbered = ranged.withColumn(PART, F.spark_partition_id())
    numbered.sortWithinPartitions(*order).write.partitionBy(PART).parquet(folder)
    layout = StructType([*df.schema, StructField(PART, IntegerType())])
    rows = df.sparkSession.read.schema(layout).parquet(folder)
    counts = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()
    return Pages(rows, tuple(order), tuple(sorted((r[PART], r.n) for r in counts)))


def page(df: DataFrame, order: Sequence[Column], number: int, size: int = 50, *, folder: str) -> DataFrame:
    """One page from 0; for several, keep what ``paged`` gives."""
    if number == 0:
        return df.orderBy(*order).limit(size)
    return paged(df, order, folder).page(number, size)


def page_after(
    df: DataFrame, value: str, key: str, last_value: float | None, last_key: int, size: int = 50
) -> DataFrame:
    """The page that follows a given last row in (value desc, key asc) order.

    Needs no count and skips no rows, so deep pages cost as much as the first.
    Nulls come last; a null ``last_value`` is a row among them.
    """
    v, k = F.col(value), F.col(key)
    if last_value is None:
        following = v.isNull() & (k > last_key)
    else:
        following = (v < last_value) | ((v == last_value) & (k > last_key)) | v.isNull()
    return df.where(following).orderBy(F.desc_nulls_last(value), F.asc(key)).limit(size)


KEY_WORDS = 64
KEY_BUCKETS = 64 * KEY_WORDS


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))


def busy_buckets(rows: DataFrame, key: str, least: int = 100_000, share: int = 1024) -> DataFrame:
    """One row with a bit per hash bucket of keys, set where many rows meet.

    A bucket is busy from ``least`` rows on if it has more than one in ``share``
    of all, so fewer than ``share`` bits are set at any size. Only the key is
    read, and only counts by bucket are shuffled.
    """
    counts = rows.groupBy(_bucket(key).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    bit = F.expr(f"shiftleft(1L, int(bucket % {KEY_WORDS}))")
    busy = counts.withColumn("total", total).select(
        F.floor(F.col("bucket") / KEY_WORDS).alias("word"),
        F.when((F.col("n") >= least) & (F.col("n") * share > F.col("total")), bit)
        .otherwise(0)
        .alias("bit"),
    )
    words = [
        F.coalesce(F.bit_or(F.when(F.col("word") == i, F.col("bit"))), F.lit(0))
        for i in range(KEY_BUCKETS // KEY_WORDS)
    ]
    return busy.agg(F.array(*words).alias("busy"))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    *,
    busy: DataFrame,
    parts: int = 16,
) -> DataFrame:
    """Join to a side with one row per key, spreading busy keys over tasks.

    The right side is usually an aggregate, whose skew Spark cannot split at
    run time. ``busy`` is what ``busy_buckets`` found in the rows behind the left
    side. A left row of a busy bucket draws a part from its content, and the
    right rows of these buckets are repeated once per part; all others keep
    their one row.
    """
    word = F.element_at(busy.scalar(), (_bucket(key) / KEY_WORDS).cast("int") + 1)
    crowded = F.getbit(word, F.pmod(_bucket(key), F.lit(KEY_WORDS)).cast("int")) == 1
    drawn = F.pmod(F.xxhash64(*left.columns), F.lit(parts)).cast("int")
    last = F.when(crowded, parts - 1).otherwise(0)
    copies = right.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    return (
        left.withColumn("part", F.when(crowded, drawn).otherwise(0))
        .join(copies, [key, "part"], how)
        .drop("part")
    )


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(operator.or_, conditions)
