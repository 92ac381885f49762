"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1, linear between
knots. Its integral is the source's share of the mix; targets above the cap of
their source are cut and the excess goes to the others by weight. A source's
cumulative demand at time t is its target times the schedule's integral up to t.
Its documents lie one after another in an order by hash, round after round, and
the inverse of the demand gives each its training position; documents are then
range-sorted by position.

Cumulative sizes come from two levels of hash buckets, so no window holds more
than the buckets of one source or the documents of one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, partitions, staged

# Knots (time, weight) of the schedules, by rank of the source, repeating. They
# integrate to 3, 1 and 2: one that fades, a level one and one that grows.
Schedule = Sequence[tuple[float, float]]
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 4.0), (1.0, 2.0)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)),
)
SHARE = 1.5
CAP = 2
COARSE = 2  # hex digits of the order's first level of buckets, and of its second
FINE = 4


def integral(schedule: Schedule) -> float:
    return sum(
        (t1 - t0) * (w0 + w1) / 2
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False)
    )


def time_of(schedule: Schedule, part: Column) -> Column:
    """The time by which a schedule has used up ``part`` (0..1) of its integral."""
    total, before, out = integral(schedule), 0.0, None
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        area, span = (t1 - t0) * (w0 + w1) / 2, t1 - t0
        rest = part * total - before
        if w0 == w1:
            when = F.lit(t0) + rest / w0
        else:
            slope = (w1 - w0) / span
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + rest * (2 * slope), F.lit(0.0)))
            when = F.lit(t0) + (root - w0) / slope
        before += area
        out = F.when(part * total <= before, when) if out is None else out.when(
            part * total <= before, when
        )
    return out.otherwise(F.lit(schedule[-1][0]))


def sized(df: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """Id, source, word count and place in the order of every row.

    The order is by a hash of the id; rows that share an id follow by text.
    """
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    return df.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        words.alias("size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("place"),
        F.xxhash64(text).alias("tie"),
    )


def targets(
    totals: DataFrame, schedules: Sequence[Schedule], share: float, cap: int
) -> DataFrame:
    """Targets of the sources, from a row per source with its total ``source_size``.

    Water-filling in closed form: by cap per weight, the sources below the
    level are capped, and the level is what is left per weight of the others.
    """
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    ranked = totals.withColumn(
        "rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    ).withColumn("kind", F.pmod("rank", F.lit(len(schedules))).cast("int"))
    ratio = W.orderBy(F.col("full") / F.col("weight"), "rank")
    before = ratio.rowsBetween(W.unboundedPreceding, -1)
    rest = ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (
        F.lit(share) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    filled = (
        ranked.withColumn("weight", F.element_at(weights, F.col("kind") + 1))
        .withColumn("full", (F.col("source_size") * cap).cast("double"))
        .withColumn("level", level)
        .withColumn("open", F.col("full") / F.col("weight") >= F.col("level"))
        .withColumn("line", F.max(F.when(F.col("open"), F.col("level"))).over(everything))
    )
    return filled.select(
        "source",
        "source_size",
        "kind",
        F.least("full", F.coalesce(F.col("line"), F.lit(float("inf"))) * F.col("weight")).alias(
            "target"
        ),
    )


def mixed(
    df: DataFrame,
    schedules: Sequence[Schedule] = SCHEDULES,
    share: float = SHARE,
    cap: int = CAP,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per input row with what the mix takes of it and when.

    ``taken`` is the words taken over all rounds; the document at a target's
    edge is cut there, so taken words meet the rounded target exactly.
    ``position`` is when training reaches the document first, above 1 if it never does.
    A null source is a source of its own, ranked last. Null, empty and blank
    texts have size 0 and take nothing. Repeated rows count each. An empty
    table gives no rows; other columns are not read. Rows come range-sorted
    by position.
    """
    docs = staged(sized(df, doc_id, text, source), "mix-sizes").withColumns(
        {
            "coarse": F.substring("place", 1, COARSE),
            "fine": F.substring("place", COARSE + 1, FINE - COARSE),
        }
    )
    key = F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")
    docs = docs.select("*", *key)
    by_source, by_coarse = ["none", "name"], ["none", "name", "coarse"]
    by_fine = [*by_coarse, "fine"]
    fine = docs.groupBy(*by_fine).agg(F.sum("size").alias("part"))
    coarse = fine.groupBy(*by_coarse).agg(F.sum("part").alias("part"))
    totals = coarse.groupBy(*by_source).agg(F.sum("part").alias("source_size"))
    aims = targets(
        totals.withColumn("source", F.when(~F.col("none"), F.col("name"))),
        schedules,
        share,
        cap,
    ).select("*", *key)

    def start(keys: list[str], order: str) -> Column:
        w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum("part").over(w), F.lit(0))

    starts = (
        coarse.select(*by_coarse, start(by_source, "coarse").alias("before"))
        .join(aims.drop("source"), by_source)
        .join(fine.select(*by_fine, start(by_coarse, "fine").alias("within")), by_coarse)
    )
    inner = W.partitionBy(*by_fine).orderBy("place", "doc_id", "size", "tie")
    inner = inner.rowsBetween(W.unboundedPreceding, -1)
    placed = docs.join(starts, by_fine).withColumn(
        "start",
        F.col("before") + F.col("within") + F.coalesce(F.sum("size").over(inner), F.lit(0)),
    )
    goal = F.round("target").cast("long")
    taken = F.lit(0).cast("long")
    for turn in range(cap):
        left = goal - F.col("start") - F.col("source_size") * turn
        taken = taken + F.least(F.greatest(left, F.lit(0).cast("long")), F.col("size"))
    part = F.when(F.col("target") > 0, F.col("start") / F.col("target")).otherwise(2.0)
    when = F.lit(None).cast("double")
    for kind, schedule in enumerate(schedules):
        when = F.when(F.col("kind") == kind, time_of(schedule, part)).otherwise(when)
    out = placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        F.when(part <= 1, when).otherwise(part).alias("position"),
        "tie",
    )
    return out.repartitionByRange(partitions(df), "position", "doc_id").sortWithinPartitions(
        "position", "doc_id"
    )


def repeated(df: DataFrame, **options) -> DataFrame:
    """The rows of the mix, all columns kept: each as often as it is taken.

    Of a document that a target cuts, the round counts if the mix takes half of
    its words or more. Null, empty and wordless texts are never taken. A null id
    or source is one of its own; an empty table stays empty.
    """
    names = {k: options.get(k, k) for k in ("doc_id", "text", "source")}
    turns = mixed(df, **options).where("size > 0").select(
        "doc_id",
        "tie",
        "source",
        F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("turns"),
    )
    # Repeated rows take part together, each with the mean of their turns' sum.
    turns = turns.groupBy("doc_id", "tie", "source").agg(
        F.sum("turns").alias("turns"), F.count("*").alias("n")
    )
    # The row travels as one struct, whatever its columns are called.
    marked = df.select(
        F.struct("*").alias("row"),
        F.col(names["doc_id"]).alias("id"),
        F.xxhash64(names["text"]).alias("key"),
        F.col(names["source"]).alias("origin"),
    )
    same = (
        F.col("id").eqNullSafe(F.col("doc_id"))
        & (F.col("key") == F.col("tie"))
        & F.col("origin").eqNullSafe(F.col("source"))
    )
    times = F.array_repeat(F.lit(0), F.ceil(F.col("turns") / F.col("n")).cast("int"))
    return (
        marked.join(turns.where("turns > 0"), same)
        .select("row", F.explode(times))
        .select("row.*")
    )
