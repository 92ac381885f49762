"""SentencePiece encoding and decoding as relations.

A text is cut into tokens, blanks with what follows up to the next ones, and these
into words wherever no piece has the two characters side by side. No piece spans two
words, so each distinct word is encoded once: its
substrings of bounded length are exploded, equi-joined to the piece table, and
the matching pieces (the edges of its lattice) grouped by word. A higher-order
aggregate then folds the word over its edges, and encoded words are joined back
to the texts.

What the fold computes depends on the kind of model. For a unigram model it is
the best path by the sum of scores (Viterbi). The public piece file is a
byte-pair model, whose scores are merge ranks and not log-probabilities; for it
the fold merges the best-ranked neighbours first, which gives the library's own
ids, where the best path would not.

Texts are cut as arrays of code points, and a word is known by a 64-bit hash of its
own. Words frequent in the corpus reach every task as arrays of at most ``KNOWN``
entries; each text's other words come back through a join to the packed text, which is
smaller than its ids.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import arrays
from ledgerline.llm.common import packed_texts, partitions, staged, unpacked

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
KNOWN = 1 << 19
LONG = 48  # longer words don't count as frequent
BITS = 61  # longer words are merged by a queue
SHARE = 16384  # words whose edges one task groups
SLICE = 1 << 17  # bytes of texts that are cut at once
MERGED = 256  # slices whose words leave a task as one


class Pieces:
    """The piece table of a model file: pieces, ids and scores."""

    def __init__(self, path: str = MODEL, merges: bool = True) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.merges = merges
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.rows = [
            (p, i, float(model.get_score(i)))
            for i, p in enumerate(self.pieces)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        self.unknown = model.unk_id()
        self.bytes = {p: i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.most = max(len(p) for p, _, _ in self.rows)
        self.pairs = {p[k : k + 2] for p, _, _ in self.rows for k in range(len(p) - 1)}

    def late(self) -> set[str]:
        """Pieces that two parts make of which one, by its score, comes no sooner."""
        score = {p: s for p, _, s in self.rows}
        return {
            p
            for p, _, s in self.rows
            for parts in ((p[:k], p[k:]) for k in range(1, len(p)))
            if all(len(x) == 1 or x in score for x in parts)
            and any(len(x) > 1 and score[x] <= s for x in parts)
        }

    def table(self, spark: SparkSession) -> DataFrame:
        late = self.late()
        rows = [(*r, r[0] in late) for r in self.rows]
        return spark.createDataFrame(rows, "piece string, id int, score double, late boolean")


def code_points(t: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a slice, and how many come before each row."""
    chars = np.frombuffer(t.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    return chars, np.r_[0, np.cumsum((t.data & 0xC0) != 0x80)][t.offsets]


class Cutter:
    """Which characters stand side by side in a piece, as a table of their classes."""

    def __init__(self, pairs: set[str]) -> None:
        chars = sorted({c for p in pairs for c in p})
        of = {c: k for k, c in enumerate(chars, 1)}
        self.kind = np.zeros(0x110000, np.uint16)
        self.kind[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in pairs:
            self.joined[of[p[0]], of[p[1]]] = True

    def cut(self, t: arrays.Texts) -> tuple[np.ndarray, arrays.Words]:
        """The code points of a slice, with a blank before each text, and its words.

        A word begins where blanks do, and wherever no piece has the two characters.
        """
        chars, before = code_points(t)
        filled = before[1:] > before[:-1]
        chars = np.insert(chars, before[:-1][filled], ord(BLANK))
        rows = before + np.r_[0, np.cumsum(filled)]
        chars[chars == ord(" ")] = ord(BLANK)
        blank, kind = chars == ord(BLANK), self.kind[chars]
        begins = np.ones(len(chars), bool)
        pair = kind[:-1].astype(np.int32) * np.int32(len(self.joined)) + kind[1:]
        begins[1:] = ~self.joined.ravel().take(pair) | (blank[1:] & ~blank[:-1])
        begins[rows[:-1][filled]] = True
        start = np.flatnonzero(begins)
        return chars, arrays.Words(start, np.r_[start[1:], len(chars)][: len(start)], np.searchsorted(start, rows))


def hashes(chars: np.ndarray, w: arrays.Words) -> np.ndarray:
    """``arrays.word_hashes`` of words that follow one another without a gap."""
    if not len(w.start):
        return np.empty(0, arrays.U64)
    lengths = w.end - w.start
    place = np.arange(len(chars), dtype=np.int32) - np.repeat(w.start.astype(np.int32), lengths)
    sums = chars.astype(arrays.U64)
    sums += arrays.U64(1)
    sums *= arrays.multipliers(int(lengths.max())).take(place)
    return arrays.mix(
        np.add.reduceat(sums, w.start) + arrays.U64(0x9E3779B97F4A7C15) * lengths.astype(arrays.U64)
    )


def spelled(chars: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Runs of code points as strings."""
    flat = chars[np.repeat(start, length) + arrays.within(length)]
    size = 1 + (flat >= 0x80).astype(np.int32) + (flat >= 0x800) + (flat >= 0x10000)
    ends = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(length)]].astype(np.int32)
    data = flat.astype("<u4").tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(length), pa.py_buffer(ends), pa.py_buffer(data))


def distinct_words(df: DataFrame, pairs: set[str], text: str) -> DataFrame:
    """key, word, n: all distinct words of all texts with their hashes, counted."""

    def merged(parts):
        h, n = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        order = np.argsort(h)
        start, _ = arrays.group_bounds(h[order])
        words = pa.concat_arrays([p[2] for p in parts]).take(pa.array(order[start]))
        n = np.add.reduceat(n[order], start) if len(h) else n
        return pa.RecordBatch.from_arrays([words, pa.array(n)], ["word", "n"])

    def run(batches):
        cutter = Cutter(pairs)
        for batch in batches:
            parts = []
            for t in arrays.slices(batch.column("text"), SLICE):
                chars, w = cutter.cut(t)
                h = hashes(chars, w)
                order = np.argsort(h)
                start, n = arrays.group_bounds(h[order])
                first = order[start]
                parts.append((h[first], n, spelled(chars, w.start[first], (w.end - w.start)[first])))
                if len(parts) == MERGED:
                    yield merged(parts)
                    parts = []
            if parts:
                yield merged(parts)

    def keyed(batches):
        # Hashes are made again behind the shuffle, which they would fill.
        for batch in batches:
            keys = [np.empty(0, arrays.U64)]
            for t in arrays.slices(batch.column("word"), SLICE):
                chars, ends = code_points(t)
                keys.append(hashes(chars, arrays.Words(ends[:-1], ends[1:], ends)))
            key = pa.array(np.concatenate(keys).view(np.int64))
            yield pa.RecordBatch.from_arrays([key, *batch.columns], ["key", "word", "n"])

    rows = df.select(F.col(text).cast("string").alias("text"))
    return (
        rows.mapInArrow(run, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .mapInArrow(keyed, "key long, word string, n long")
    )


def lattice(words: DataFrame, table: DataFrame, most: int) -> DataFrame:
    """Each word with its edges, the best first: rank, first (from 1), chars, id, the bits
    of the boundaries before and behind (``ends``) and within (``inner``), ``late``.

    A character that is no piece has an edge too, without rank and id. Words are grouped
    by ``key``, a number, which sorts faster than they do.
    """
    spans = words.select("key", "word", "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("first"))
    spans = spans.select(
        "*",
        F.explode(
            F.sequence(F.lit(1), F.least(F.lit(most), F.length("word") - F.col("first") + 1))
        ).alias("chars"),
    ).withColumn("piece", F.substr("word", "first", "chars"))
    # The table is as large as the model's vocabulary, whatever the corpus.
    found = spans.join(F.broadcast(table), "piece", "left").where("id is not null or chars = 1")
    first = _bit(F.col("first") - 1)
    last = _bit(F.col("first") - 1 + F.col("chars"))
    edge = F.struct(
        (-F.col("score")).alias("rank"),
        "first",
        "chars",
        "id",
        first.bitwiseOR(last).alias("ends"),
        (last - _bit(F.col("first"))).alias("inner"),
        "late",
    )
    return found.groupBy("key", "word", "n").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def _ids(word: Column, e: Column, pieces: Pieces) -> Column:
    """The ids of an edge. A character that is no piece becomes its bytes, or unknown."""
    first = pieces.bytes.get("<0x00>")
    if first is None:
        return F.array(F.coalesce(e["id"], F.lit(pieces.unknown)))
    code = F.hex(F.encode(F.substr(word, e["first"], F.lit(1)), "UTF-8"))
    codes = F.transform(
        F.sequence(F.lit(1), F.length(code), F.lit(2)),
        lambda k: F.conv(F.substr(code, k, F.lit(2)), 16, 10).cast("int") + first,
    )
    return F.when(e["id"].isNotNull(), F.array(e["id"])).otherwise(codes)


def _merged(word: Column, edges: Column, pieces: Pieces) -> Column:
    """Merge the best neighbours, the first of equals, until no piece is left to make.

    The state is the set of boundaries between parts, as the bits of a number; an
    edge can be made if both its ends and just one boundary within are left. Only
    the merge of one of its two parts makes that so. All edges are therefore settled
    in turn, unless such a part comes after the edge (``late``) and does make it
    possible. Then the number is negative, and the best edge is looked for anew
    after each merge, until the number is negative since there is none.
    """

    def made(mask: Column, e: Column) -> Column:
        within = mask.bitwiseAND(e["inner"])
        return (
            (within != 0)
            & (within.bitwiseAND(within - 1) == 0)
            & (mask.bitwiseAND(e["ends"]) == e["ends"])
        )

    def merge(mask: Column, inner: Column) -> Column:
        return mask - mask.bitwiseAND(inner)

    def settled(lates: Column) -> Column:
        def step(mask: Column, e: Column) -> Column:
            def checked(new: Column) -> Column:
                passed = F.exists(lates, lambda x: (x["rank"] < e["rank"]) & made(new, x))
                return F.when(passed, F.lit(-1).cast("long")).otherwise(new)

            return F.when((mask > 0) & made(mask, e), bound(merge(mask, e["inner"]), checked)).otherwise(mask)

        return F.aggregate(edges, start, step)

    def again(steps: Column) -> Column:
        def step(mask: Column, _: Column) -> Column:
            best = F.get(F.filter(steps, lambda e: made(mask, e)), F.lit(0))["inner"]
            return F.when(mask < 0, mask).otherwise(
                bound(
                    best, lambda inner: F.when(inner.isNull(), -mask).otherwise(merge(mask, inner))
                )
            )

        return F.abs(F.aggregate(F.sequence(F.lit(1), F.length(word)), start, step))

    start = _bit(F.length(word) + 1) - 1
    steps = F.filter(edges, lambda e: e["chars"] > 1)
    mask = bound(
        bound(F.filter(edges, lambda e: e["late"]), settled),
        lambda once: F.when(once < 0, bound(steps, again)).otherwise(once),
    )

    def path(mask: Column) -> Column:
        kept = F.filter(
            edges,
            lambda e: (mask.bitwiseAND(e["inner"]) == 0) & (mask.bitwiseAND(e["ends"]) == e["ends"]),
        )
        parts = F.sort_array(
            F.transform(kept, lambda e: F.struct(e["first"].alias("first"), e["id"].alias("id")))
        )
        return F.flatten(F.transform(parts, lambda e: _ids(word, e, pieces)))

    return bound(mask, path)


def _best_path(word: Column, edges: Column, pieces: Pieces) -> Column:
    """The best path by the sum of scores; a character that is no piece is far below any."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))

    def step(ends: Column, i: Column) -> Column:
        options = F.transform(
            F.filter(edges, lambda e: e["first"] + e["chars"] - 1 == i),
            lambda e: F.struct(
                (
                    F.element_at(ends, e["first"])["score"] - F.coalesce(e["rank"], F.lit(1e6))
                ).alias("score"),
                (-e["chars"]).alias("back"),
                e.alias("edge"),
            ),
        )

        def longer(b: Column) -> Column:
            before = F.element_at(ends, b["edge"]["first"])["ids"]
            return F.array(
                F.struct(
                    b["score"].alias("score"),
                    F.concat(before, _ids(word, b["edge"], pieces)).alias("ids"),
                )
            )

        return F.concat(ends, bound(F.array_max(options), longer))

    return F.element_at(F.aggregate(F.sequence(F.lit(1), F.length(word)), start, step), -1)["ids"]


def merged_run(word: str, table: dict[str, tuple[int, float]]) -> list[str]:
    """The parts of one long word, merged by a queue of its pairs."""
    n = len(word)
    parts: list[str | None] = list(word)
    after, before, queue = list(range(1, n + 1)), list(range(-1, n - 1)), []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            both = parts[i] + parts[after[i]]
            if both in table:
                heapq.heappush(queue, (-table[both][1], i, both))

    for i in range(n):
        offer(i)
    while queue:
        _, i, both = heapq.heappop(queue)
        if parts[i] is None or after[i] >= n or parts[i] + parts[after[i]] != both:
            continue
        gone = after[i]
        parts[i], parts[gone], after[i] = both, None, after[gone]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [p for p in parts if p is not None]


def _long_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """key, word, n, ids of words with more characters than a number has bits."""
    table = {p: (i, score) for p, i, score in pieces.rows}
    codes, unknown = pieces.bytes, pieces.unknown

    def run(batches):
        for batch in batches:
            ids = []
            for word in batch.column("word").to_pylist():
                own = []
                for part in merged_run(word, table):
                    if part in table:
                        own.append(table[part][0])
                    elif codes:
                        own += [codes[f"<0x{x:02X}>"] for x in part.encode()]
                    else:
                        own.append(unknown)
                ids.append(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int32()))], ["key", "word", "n", "ids"]
            )

    return words.mapInArrow(run, "key long, word string, n long, ids array<int>")


def encoded_words(words: DataFrame, pieces: Pieces, table: DataFrame) -> DataFrame:
    """key, word, n, ids of distinct words. A character that is no piece becomes its
    bytes, or unknown."""
    words = words.select("key" if "key" in words.columns else F.xxhash64("word").alias("key"), "word", "n")
    fits = F.length("word") <= BITS if pieces.merges else F.lit(True)
    fold = _merged if pieces.merges else _best_path
    # More tasks than the bytes of the words ask for, as each word has many edges.
    tasks = max(partitions(words), words.count() // SHARE + 1)
    spread = words.where(fits).repartition(tasks, "key")
    rows = lattice(spread, table, pieces.most).select(
        "key", "word", "n", bound(F.col("edges"), lambda e: fold(F.col("word"), e, pieces)).alias("ids")
    )
    return rows.unionByName(_long_words(words.where(~fits), pieces)) if pieces.merges else rows


def frequent(coded: DataFrame, known: int) -> Column:
    """Whether a word is among the most frequent, ``known`` at most, by a level of frequency."""
    short, level = F.length("word") <= LONG, F.floor(F.log2("n") * 8).cast("int")
    # A row for each eighth of a doubling.
    levels = coded.where(short).groupBy(level.alias("level")).count().collect()
    total, least = 0, None
    for found, count in sorted(levels, reverse=True):
        total += count
        if total > known:
            break
        least = found
    return F.lit(False) if least is None else short & (level >= least)


def encoded(
    df: DataFrame,
    pieces: Pieces,
    doc_id: str = "doc_id",
    text: str = "text",
    known: int = KNOWN,
) -> DataFrame:
    """doc_id and the piece ids of each row's text, and ``round_trip``: whether
    decoding them gives the text.

    A null or empty text has no ids. Repeated rows are each returned. Ids are
    whole numbers; rows with a null id are encoded too. Other columns are not
    read, an empty table gives no rows. A text that contains the blank sign
    itself decodes with blanks in its place.
    """
    spark = df.sparkSession
    pairs = pieces.pairs
    words = staged(distinct_words(df, pairs, text), "words")
    coded = staged(encoded_words(words, pieces, pieces.table(spark)), "coded-words")
    wide = np.uint16 if len(pieces.pieces) < 65536 else np.uint32
    width = np.dtype(wide).itemsize
    often = frequent(coded, known)
    sent = spark.sparkContext.broadcast(
        KnownWords.of(coded.where(often).select("key", "ids").toArrow(), wide)
    )
    value = F.col(text).cast("string")
    # Rows that share a key only share the words looked up for them.
    keyed = df.select(
        F.xxhash64(F.col(doc_id), value).alias("key"),
        F.col(doc_id).cast("long").alias("doc_id"),
        value.alias("text"),
    )

    def rare(batches):
        cutter, table = Cutter(pairs), sent.value
        for batch in batches:
            for t in arrays.slices(batch.column("text"), SLICE):
                h, offsets, at = table.cut(cutter, t)
                open_ = np.flatnonzero(at < 0)
                row = np.searchsorted(offsets, open_, "right") - 1
                # Each word of a row once.
                order = np.lexsort((h[open_], row))
                row, h = row[order], h[open_][order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
                key = batch.column("key").to_numpy()[t.first : t.first + t.rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[row[new]]), pa.array(h[new].view(np.int64))], ["row", "key"]
                )

    def narrowed(batches):
        for batch in batches:
            ids = batch.column("ids")
            ends, own = ids.offsets.to_numpy(), ids.values.to_numpy().astype(wide)
            ends = pa.py_buffer((ends * width).astype(np.int32))
            packed = pa.Array.from_buffers(pa.binary(), len(ids), [None, ends, pa.py_buffer(own)])
            yield pa.RecordBatch.from_arrays([batch.column("key"), packed], ["key", "ids"])

    found = (
        keyed.select("key", "text")
        .mapInArrow(rare, "row long, key long")
        .join(coded.where(~often).select("key", "ids").mapInArrow(narrowed, "key long, ids binary"), "key")
        # As they are: lists of one or two would be larger than what they hold.
        .repartition("row")
        .groupBy("row")
        .agg(F.collect_list(F.struct("key", "ids")).alias("others"))
    )
    raw = np.array(_bytes_of(pieces), object)

    def run(batches):
        cutter, table = Cutter(pairs), sent.value
        lengths = np.array([len(x) for x in raw])
        for whole in batches:
            for batch in arrays.in_parts(whole, "packed", 1 << 20):
                texts = pa.array(unpacked(batch.column("packed")), pa.binary())
                others = batch.column("others")
                for t in arrays.slices(texts, SLICE):
                    h, offsets, at = table.cut(cutter, t)
                    rest = h[at < 0]
                    more, more_sizes = _looked_up(others.slice(t.first, t.rows), rest, wide)
                    ids, sizes = table.ids_of(at)
                    sizes[at < 0] = more_sizes
                    out = np.empty(int(sizes.sum()), np.int32)
                    open_ = np.repeat(at < 0, sizes)
                    out[open_], out[~open_] = more, ids
                    ends = np.r_[0, np.cumsum(sizes)][offsets]
                    back = b"".join(raw.take(out).tolist())
                    begin = np.r_[0, np.cumsum(lengths[out])][ends].tolist()
                    text, place, same = t.data.tobytes(), t.offsets.tolist(), []
                    for k in range(t.rows):
                        # The blank that encoding puts before the text.
                        a = begin[k] + back.startswith(b" ", begin[k], begin[k + 1])
                        same.append(back[a : begin[k + 1]] == text[place[k] : place[k + 1]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(t.first, t.rows),
                            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out)),
                            pa.array(same, pa.bool_()),
                        ],
                        ["doc_id", "ids", "round_trip"],
                    )

    texts = packed_texts(keyed.withColumnRenamed("key", "row"), "doc_id", "text", "row")
    return texts.join(found, "row", "left").mapInArrow(
        run, "doc_id long, ids array<int>, round_trip boolean"
    )


def _looked_up(others: pa.Array, words: np.ndarray, wide) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words by their hashes, one after another, and how many each has.

    ``others`` holds, by row, words with their ids.
    """
    if not len(words):
        return np.empty(0, wide), np.empty(0, np.int64)
    own = others.flatten()
    ends, flat = own.field("ids").buffers()[1:]
    first = own.field("ids").offset
    ends = np.frombuffer(ends, np.int32)[first : first + len(own) + 1] // np.dtype(wide).itemsize
    flat = np.frombuffer(flat, wide, int(ends[-1]))
    keys, place = np.unique(own.field("key").to_numpy().view(np.uint64), return_index=True)
    at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
    if not len(keys) or (keys[at] != words).any():
        raise LookupError("a word of a text has not been encoded")
    start = ends[place[at]].astype(np.int64)
    sizes = ends[place[at] + 1] - start
    return flat[np.repeat(start, sizes) + arrays.within(sizes)], sizes


class KnownWords(NamedTuple):
    """Hashes of words, sorted, and their ids, one word after another.

    ``first`` is the place of the first hash with given leading bits, of which there
    are about four times as many as words, so that few share them.
    """

    keys: np.ndarray
    start: np.ndarray
    ids: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, wide) -> KnownWords:
        column = table.column("ids").combine_chunks()
        sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
        start = column.offsets.to_numpy()[:-1].astype(np.int64)
        keys = table.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        sizes = sizes[order]
        at = np.repeat(start[order], sizes) + arrays.within(sizes)
        ids = column.values.to_numpy()[at] if len(at) else np.empty(0)
        keys, bits = keys[order], max(1, len(order).bit_length() + 1)
        leading = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        first = np.r_[np.searchsorted(keys, leading), len(keys)].astype(np.int32)
        return cls(keys, np.r_[0, np.cumsum(sizes)], ids.astype(wide), first)

    def places(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes here, or -1."""
        bits = (len(self.first) - 1).bit_length() - 1
        leading = (h >> np.uint64(64 - bits)).astype(np.int64)
        at, last = self.first[leading].astype(np.int64), self.first[leading + 1]
        out, open_ = np.full(len(h), -1), np.flatnonzero(at < last)
        while len(open_):
            hit = self.keys[at[open_]] == h[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < last[open_]]
        return out

    def cut(self, cutter: Cutter, t: arrays.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of a slice's words, words before each row, and places here, or -1."""
        chars, w = cutter.cut(t)
        h = hashes(chars, w)
        return h, w.offsets, self.places(h)

    def ids_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words at these places, and how many each has; none at -1."""
        start = np.where(at < 0, 0, self.start[at])
        sizes = np.where(at < 0, 0, self.start[np.minimum(at + 1, len(self.start) - 1)] - start)
        return self.ids[np.repeat(start, sizes) + arrays.within(sizes)], sizes


def _bytes_of(pieces: Pieces) -> list[bytes]:
    names = pieces.pieces
    byte_of = {i: bytes([int(p[3:5], 16)]) for p, i in pieces.bytes.items()}
    return [byte_of.get(i, names[i].replace(BLANK, " ").encode()) for i in range(len(names))]


def decoder(pieces: Pieces):
    """A function from ids to the text."""
    raw = _bytes_of(pieces)

    def decode(ids: list[int]) -> str:
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        # The blank that encoding puts before the text.
        return text[1:] if text.startswith(" ") else text

    return decode


def decoded(df: DataFrame, pieces: Pieces, ids: str = "ids") -> DataFrame:
    """The rows with their ids decoded to ``text``; null ids give a null text."""
    decode = decoder(pieces)

    def run(batches):
        for batch in batches:
            texts = [None if x is None else decode(x) for x in batch.column(ids).to_pylist()]
            yield batch.append_column("text", pa.array(texts, pa.string()))

    rest = df.drop("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(run, f"{schema}, text string")
