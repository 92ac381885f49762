"""Packing of tokenized documents into sequences of one width.

A document's ids are cut into pieces of the full width and a rest. Only the
histogram of piece lengths, at most ``width`` numbers, reaches the driver. There
shortest-pack-first works on counts: lengths are placed longest first, each into
the pack pattern with the most space left, and a pattern's count splits where
fewer pieces are left than packs. Pieces then find their pattern by their rank
among the pieces of their length, so no task ever holds a length or a pattern
whole.

Ranks need no sort. Each task numbers its own pieces of each length while it
tokenizes; the pieces are written, which makes tasks and numbers final, and a
running total over tasks gives the rank at which each task begins.
"""

from __future__ import annotations

import heapq
import re
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.common import staged

WIDTH = 4096
END = 2
TOKENIZER = "word_bpe_49k.json"
# Letters whose normal form is themselves and which lower-case one by one, then
# marks that never join a letter. An apostrophe may, as in 's.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
# Runs of text remembered by a task, and the longest of them in bytes.
REMEMBERED, LONGEST = 3 << 18, 64
RANK_BITS = 44


def unsigned(ids: Iterable[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Coder(dict):
    """Ids of texts as little-endian unsigned 32-bit bytes, run by run.

    The tokenizer drops white space and never joins what it parts, so each run
    between ASCII white space has ids of its own; they are remembered. Words of
    plain letters go to the merge model alone, all else through the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.full = Tokenizer.from_file(path)
        self.full.encode_special_tokens = True
        self.model = self.full.model
        visible = ByteLevel(add_prefix_space=False, use_regex=False)
        self.visible = {c: visible.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xC0, 0x100))}
        self.visible = str.maketrans(self.visible)

    def __missing__(self, run: bytes) -> bytes:
        text = run.decode("utf-8", "replace")
        plain = PLAIN.fullmatch(text)
        if plain is not None:
            word, marks = plain.groups()
            lower = word.lower()
            if marks or lower != word:
                # Most words come with several marks and cases, and are merged once.
                ids = self[lower.encode()] + (self[marks.encode()] if marks else b"")
            else:
                ids = unsigned(t.id for t in self.model.tokenize(word.translate(self.visible)))
        elif len(run) > 1 and run.isdigit():
            ids = b"".join(self[bytes((digit,))] for digit in run)
        else:
            ids = unsigned(self.full.encode(text, add_special_tokens=False).ids)
        if len(run) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[run] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


def pieces(
    docs: DataFrame, tokenizer: str, width: int = WIDTH, end: int = END, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``width`` ids of whole texts, each text followed by ``end``.

    doc_id, start, length, ids_crc32, doc_tokens, and task and nth, which number
    the pieces of one length a task makes; with ids as little-endian 32-bit bytes if
    wanted. Every row is a document of its own, repeated and null doc_ids too; a
    null text is empty and gives ``end`` alone. Other columns are dropped.
    """
    id_type = docs.schema["doc_id"].dataType

    def run(batches):
        kinds = [to_arrow_type(id_type), *[pa.int64()] * 4, pa.int32(), pa.int64(), pa.binary()]
        coder, seen = Coder(tokenizer), defaultdict(int)
        task = TaskContext.get().partitionId()
        last = unsigned([end])

        def made(rows):
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)][: len(names)], names
            )

        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = coder.ids(text.as_py() or b"") + last
                total = len(ids) // 4
                for start in range(0, total, width):
                    part = ids[4 * start : 4 * (start + width)]
                    length = len(part) // 4
                    rows.append(
                        (doc_id.as_py(), start, length, zlib.crc32(part), total, task, seen[length], part if with_ids else None)
                    )
                    seen[length] += 1
                    held += len(part) if with_ids else 64
                if held >= 1 << 24:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"]
    schema = f"doc_id {id_type.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, task int, nth long"
    if with_ids:
        names.append("ids")
        schema += ", ids binary"
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


class Pattern(NamedTuple):
    """``count`` packs, each of these (length, pieces of that length)."""

    count: int
    content: tuple[tuple[int, int], ...]


def patterns(histogram: dict[int, int], width: int) -> list[Pattern]:
    """Shortest-pack-first over the lengths, longest first.

    Work and memory depend on the number of different lengths, not on the counts:
    a length opens one group of equal packs and one odd pack at most, and splits a
    group once, so there are at most three patterns a length, each of fewer than
    sqrt(2 width) different lengths.
    """
    packs: list[tuple[int, int, int, tuple]] = []  # space left (negative), age, count, content
    age = 0

    def put(space: int, count: int, content: tuple) -> None:
        nonlocal age
        age += 1
        if count:
            heapq.heappush(packs, (-space, age, count, content))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if packs and -packs[0][0] >= length:
                space, _, count, content = heapq.heappop(packs)
                used = min(left, count)
                put(-space, count - used, content)
                if content[-1][0] == length:
                    content = (*content[:-1], (length, content[-1][1] + 1))
                else:
                    content = (*content, (length, 1))
                put(-space - length, used, content)
                left -= used
            else:
                # One after another, pieces would go to the pack just opened until it is full.
                whole, odd = divmod(left, width // length)
                put(width % length, whole, ((length, width // length),))
                put(width - odd * length, 1 if odd else 0, ((length, odd),))
                left = 0
    return [Pattern(count, content) for _, _, count, content in sorted(packs)]


class Slots:
    """Where the piece of a length and rank goes: arrays over (length, first rank)."""

    def __init__(self, found: list[Pattern]):
        taken: dict[int, int] = defaultdict(int)
        rows, sequence = [], 0
        for count, content in found:
            offset = 0
            for length, times in content:
                rows.append((length, taken[length], times, sequence, offset))
                taken[length] += count * times
                offset += length * times
            sequence += count
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5).T
        self.length, self.first, self.times, self.sequence, self.offset = table
        self.keys = (self.length << RANK_BITS) + self.first

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequences and offsets. A pattern's packs take its ranks in turn, pack by pack."""
        slot = np.searchsorted(self.keys, (length << RANK_BITS) + rank, "right") - 1
        pack, within = np.divmod(rank - self.first[slot], self.times[slot])
        return self.sequence[slot] + pack, self.offset[slot] + within * length


def placed(parts: DataFrame, width: int = WIDTH) -> DataFrame:
    """Pieces with sequence_id and offset. ``parts`` must be a written table."""
    counts = parts.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = Slots(patterns(histogram, width))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            sequence, offset = slots.places(length, batch.column("rank").to_numpy())
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    ranked = parts.join(begins, ["task", "length"]).withColumn("rank", F.col("begin") + F.col("nth"))
    columns = [c for c in parts.columns if c not in ("task", "nth")]
    schema = ", ".join(f"{c} {parts.schema[c].dataType.simpleString()}" for c in columns)
    return ranked.select(*columns, "rank").mapInArrow(run, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, width: int = WIDTH, end: int = END) -> DataFrame:
    """Where each piece of each document goes.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset. Sequences
    are numbered from 0 without gaps, and so are the ids in each; an empty table
    gives none. How much padding is left depends on the lengths: with many short
    rests it is well under one percent; where all are alike and over half the
    width, none fit together.
    """
    return placed(staged(pieces(docs, tokenizer, width, end), "packing-pieces"), width)


def sequences(docs: DataFrame, tokenizer: str, width: int = WIDTH, end: int = END, pad: int = 0) -> DataFrame:
    """The packed sequences: sequence_id, n_ids and ids, padded to the width.

    A sequence whose number of ids is a power of two isn't padded.
    """
    parts = staged(pieces(docs, tokenizer, width, end, with_ids=True), "packing-pieces")

    def run(batches):
        for batch in batches:
            joined = [np.frombuffer(b"".join(parts), "<u4") for parts in batch.column("parts").to_pylist()]
            sizes = [len(ids) for ids in joined]
            full = [
                ids if len(ids) & (len(ids) - 1) == 0 else np.pad(ids, (0, width - len(ids)), constant_values=pad)
                for ids in joined
            ]
            arrays = [batch.column("sequence_id"), pa.array(sizes, pa.int64()), pa.array([x.astype(np.int32) for x in full], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["sequence_id", "n_ids", "ids"])

    by_place = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = placed(parts, width).groupBy("sequence_id").agg(by_place.alias("parts"))
    listed = grouped.select("sequence_id", F.col("parts.ids").alias("parts"))
    return listed.mapInArrow(run, "sequence_id long, n_ids long, ids array<int>")
