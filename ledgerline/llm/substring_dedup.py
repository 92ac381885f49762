"""Removal of word passages that occur more than once.

Suffixes are dealt to groups by a prefix of variable length: from their start to
the end of the smallest run of ``INNER`` words in their first ``WINDOW`` words.
In a group, suffixes go down a tree word by word, and those that still share a
node at depth ``WINDOW`` are repeats. Suffixes that follow each other into the same
group travel as one row. A group whose prefix is frequent is divided by longer
prefixes, up to whole windows, before anything is gathered (see ``repeats``).
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame

from ledgerline.llm.repeats import Rule, removed, word_symbols

WINDOW = 35
INNER = 8


def _kept(raw: bytes, gone: np.ndarray) -> tuple[int, int, str]:
    words = raw.split()
    kept = b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x)
    return len(words), int(gone.sum()), sha256(kept).hexdigest()


def without_passages(
    df: DataFrame, window: int = WINDOW, inner: int = INNER, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row.

    Words are runs of other bytes than ASCII white space. A word goes if a
    window of ``window`` words over it also starts anywhere else, in the same
    text or another. A null text has no words; texts shorter than a window
    lose nothing. A row that is repeated with id and text counts as another
    start, so that both lose all windows. Ids are whole numbers or null. Other
    columns are not read, an empty table gives no rows.
    """
    rule = Rule(word_symbols, window, inner, earlier=False)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return removed(df, rule, _kept, schema, doc_id, text)
