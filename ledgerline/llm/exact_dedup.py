"""Exact deduplication by a tree-merge of sorted digest runs.

Every row goes to one of ``RUNS`` runs by a hash of its id. A run is the list of
its distinct digests, each with the row to keep and a count. In binomial
rounds, ``FAN_IN`` neighbouring runs at a time exchange and merge, until one run
is left; as each round sees a digest at most ``FAN_IN`` times per target run, a
text that makes up a third of all rows is no larger a group than any other. The
way back down joins on (run, digest), so that group is spread over all runs too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, staged

FAN_IN_BITS = 4
ROUNDS = 2
RUNS = 1 << (FAN_IN_BITS * ROUNDS)

# What identifies a text: its SHA-256, and a second hash and the length that
# verify it at each merge.
DIGEST = ["digest", "check", "length"]


def digests(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    normal = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    return df.select(F.col(doc_id).alias("doc_id"), normal.alias("normal")).select(
        "doc_id",
        F.sha2("normal", 256).alias("digest"),
        F.xxhash64("normal").alias("check"),
        F.octet_length("normal").alias("length"),
    )


def _merge(rows: DataFrame, run: Column) -> DataFrame:
    return rows.groupBy(run.alias("run"), *DIGEST).agg(
        F.max("keep").alias("keep"), F.sum("copies").alias("copies")
    )


def exact_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row with the row that stays of its equal texts.

    Texts are equal when identical after lower-casing A-Z only; a null text is
    the empty one. The largest ``doc_id`` stays, a null one only if all are null.
    Where a row is repeated, ``kept`` is true for exactly one of the repeats.
    Columns: doc_id, keep_id, group_size, kept, text_sha256. An empty table
    gives no rows; other input columns are not read.
    """
    # The row number is written once and only read after that.
    rows = staged(
        digests(df, doc_id, text)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("run", F.pmod(F.xxhash64("doc_id", "row"), F.lit(RUNS))),
        "digests",
    )
    runs = _merge(
        rows.withColumn("keep", F.struct("doc_id", "row")).withColumn("copies", F.lit(1)),
        F.col("run"),
    )
    merged = runs
    for _ in range(ROUNDS):
        merged = _merge(merged, F.shiftright("run", FAN_IN_BITS))
    kept = merged.select(*DIGEST, F.col("keep").alias("final"), F.col("copies").alias("total"))
    by_run = runs.select("run", *DIGEST).join(kept, DIGEST)
    return rows.join(by_run, ["run", *DIGEST]).select(
        "doc_id",
        F.col("final.doc_id").alias("keep_id"),
        F.col("total").alias("group_size"),
        (F.col("row") == F.col("final.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def without_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, whatever they are called.

    Of the rows without text one stays; an empty table stays empty.
    """
    kept = exact_groups(df, doc_id, text).where("kept").select("doc_id", "text_sha256")
    marked = df.select(
        F.struct("*").alias("row"),
        F.col(doc_id).alias("id"),
        F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256).alias("digest"),
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("digest") == F.col("text_sha256"))
    # A repeated row has both the same, so one of its repeats is left over here.
    return (
        marked.join(kept, same, "left_semi").dropDuplicates(["id", "digest"]).select("row.*")
    )
