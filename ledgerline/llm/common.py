"""Pieces shared by the text operators."""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.store import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A word is a run of bytes other than blank, tab, newline, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts lineage.

    A lost executor then costs a reread, and what is computed from the table
    twice is computed once.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null stays null.

    On pure ASCII text the built-in lower() is the same and much faster.
    """
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def packed_texts(df: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    """Ids with their texts compressed, for steps that must move whole texts.

    Columns: doc_id, packed and those named in ``more``; a null text is packed as
    the empty one.
    """

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed = [squeeze(x.as_buffer() if x.is_valid else b"") for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(packed, pa.binary()), *[batch.column(c) for c in more]],
                ["doc_id", "packed", *more],
            )

    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"), *more)
    kinds = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in more)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(pack, f"doc_id {kind}, packed binary{kinds}")


def unpacked(packed) -> list[bytes]:
    """The texts of an Arrow column of packed ones."""
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(x.as_buffer()) for x in packed]
