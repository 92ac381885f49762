"""Removal of byte strings that occurred before.

Every batch of documents is a shard with a sorted list of its sparse suffixes
and what precedes them. Shards merge by anchor content, and the interleave of
suffixes that agree so far is refined symbol by symbol from what each refinement
left together: the round in which two part is their common prefix, and those
together after ``LENGTH`` rounds are repeated intervals (see ``repeats``).
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame

from ledgerline.llm.repeats import Rule, byte_symbols, removed, runs_of

LENGTH = 100
INNER = 32


def _kept(raw: bytes, gone: np.ndarray) -> tuple[int, int, int, str]:
    data = np.frombuffer(raw, np.uint8)
    spans = list(runs_of(gone))
    return len(raw), int(gone.sum()), len(spans), sha256(data[~gone].tobytes()).hexdigest()


def without_repeats(
    df: DataFrame, length: int = LENGTH, inner: int = INNER, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row.

    A byte of the UTF-8 text goes if a string of ``length`` bytes over it also
    starts earlier: in a text with a smaller id, or further ahead in the same one.
    A null text is the empty one, a null id is smaller than any. Rows that
    share an id are ordered by a hash of their text; a row that is repeated with
    id and text takes nothing from its repeat. Other columns are not read, an
    empty table gives no rows.
    """
    rule = Rule(byte_symbols, length, inner, earlier=True)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return removed(df, rule, _kept, schema, doc_id, text)
