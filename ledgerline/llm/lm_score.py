"""Language-model scores by masked pseudo-likelihood.

A small network predicts every word from the two before and the two after it:
embeddings by position add up to a hidden layer, and the word follows as a class
and a member of it. The log-probabilities of all words of a text, each given
its true neighbours, add up to its score.

The network knows the ``TOP`` most frequent words of the whole corpus, hash
buckets for its other words, and ``UNSEEN`` for words that the corpus lacks. All
words are counted: a word of a bucket scores as the bucket times the word's share of
the bucket's occurrences. The counts of ``KNOWN`` words reach every task; the others
stay in Spark and are joined to the distinct words of blocks of texts. Training is data-parallel over every word of every text: in each round,
tasks train from the same weights on their share of the examples, and the weights
are averaged, by number of examples. Round r of n takes the words at places r,
r + n, r + 2n, ... of each text, so that all rounds together take each word once. Only
weights, whose number is fixed, reach the driver.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import arrays
from ledgerline.llm.common import partitions, staged

CLASSES, MEMBERS = 32, 32
SIZE = CLASSES * MEMBERS
TOP = SIZE - 64
EDGE = SIZE - 1  # stands for what lies outside the text
UNSEEN = SIZE - 2  # stands for words that the corpus lacks
HALF = 0.5  # occurrences that such a word counts as
AROUND = (-2, -1, 1, 2)
HIDDEN = 16
ROUNDS = 8
STEP = 1024
CHUNK = 32  # words of a class that are multiplied together
BLOCK = 1 << 20  # bytes of texts whose distinct words are looked up together
MERGED = 128  # slices whose counts leave a task as one
KNOWN = 1 << 20  # words whose counts go to every task
RATE = 0.15
SHAPES = {
    "embed": (len(AROUND), SIZE, HIDDEN),
    "bias": (HIDDEN,),
    "wc": (HIDDEN, CLASSES),
    "bc": (CLASSES,),
    "wm": (CLASSES, HIDDEN, MEMBERS),
    "bm": (CLASSES, MEMBERS),
}
TOTAL = sum(int(np.prod(s)) for s in SHAPES.values())
CELLS = np.arange(SIZE * HIDDEN).reshape(SIZE, HIDDEN)
SHARDS = 64  # parts of the weights that are averaged side by side
TASK = 1 << 18  # words below which a task's share isn't worth a task


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def initial() -> np.ndarray:
    flat = np.zeros(TOTAL, np.float32)
    w, rng = views(flat), np.random.default_rng(3)
    for name in ("embed", "wc", "wm"):
        w[name][:] = rng.normal(0, 0.1, w[name].shape)
    return flat


def exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In place, each row's exponentials after a shift; their sums and the shifts."""
    shift = x.max()
    if shift - x.min() > 60:
        shift = x.max(-1, keepdims=True)
    x -= shift
    np.exp(x, out=x)
    return x, x @ np.ones(x.shape[1], x.dtype), np.ravel(shift)


def softmax(x: np.ndarray) -> np.ndarray:
    """In place."""
    x, total, _ = exponentials(x)
    x /= total[:, None]
    return x


def chosen(x: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The log-probability of one column of each row; ``x`` is used up."""
    at = x[np.arange(len(x)), which]
    _, total, shift = exponentials(x)
    return at - shift - np.log(total)


def hidden(w: dict, around: np.ndarray) -> np.ndarray:
    total = np.take(w["embed"][0], around[0], 0)
    for k in range(1, len(AROUND)):
        total += np.take(w["embed"][k], around[k], 0)
    total += w["bias"]
    return np.tanh(total, out=total)


class Chunks:
    """Words in order of class, each class dealt to chunks of ``CHUNK`` places."""

    def __init__(self, word: np.ndarray) -> None:
        self.order = np.argsort(word.astype(np.int16), kind="stable")
        self.kind, self.member = np.divmod(word[self.order], MEMBERS)
        size = np.bincount(self.kind, minlength=CLASSES)
        chunks = -(-size // CHUNK)
        gap = np.cumsum(chunks * CHUNK - size) - (chunks * CHUNK - size)
        self.of_chunk = np.repeat(np.arange(CLASSES), chunks)
        self.place = np.arange(len(word)) + np.repeat(gap, size)

    def spread(self, rows: np.ndarray) -> np.ndarray:
        """Rows in that order, by chunk; zeros in free places."""
        out = np.zeros((len(self.of_chunk) * CHUNK, rows.shape[1]), rows.dtype)
        out[self.place] = rows
        return out.reshape(len(self.of_chunk), CHUNK, -1)

    def rows(self, spread: np.ndarray) -> np.ndarray:
        return np.take(spread.reshape(-1, spread.shape[-1]), self.place, 0)

    def by_class(self, x: np.ndarray) -> np.ndarray:
        """Sums over each class's chunks; zeros for a class without any."""
        own = (self.of_chunk == np.arange(CLASSES)[:, None]).astype(x.dtype)
        return (own @ x.reshape(len(x), -1)).reshape(CLASSES, *x.shape[1:])


def members(w: dict) -> np.ndarray:
    """The weights of the members of each class, the bias last."""
    return np.concatenate([w["wm"], w["bm"][:, None]], 1)


def biased(h: np.ndarray) -> np.ndarray:
    return np.concatenate([h, np.ones((len(h), 1), h.dtype)], 1)


def log_probabilities(w: dict, around: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Of each word given its neighbours (a row of ``around`` per position)."""
    out, weights = np.empty(len(word)), members(w)
    for a in range(0, len(word), 8192):
        part = Chunks(word[a : a + 8192])
        h = hidden(w, around[:, a : a + 8192][:, part.order])
        p = chosen(h @ w["wc"] + w["bc"], part.kind)
        q = part.rows(part.spread(biased(h)) @ weights[part.of_chunk])
        out[a + part.order] = p + chosen(q, part.member)
    return out


def train(flat: np.ndarray, squares: np.ndarray, around: np.ndarray, words: np.ndarray) -> None:
    """One pass of AdaGrad over examples: their neighbours and the words.

    Changes the weights and their summed squares of gradients in place. Weights that
    no example of a step meets have no gradient and stay.
    """
    w, grad, change = views(flat), np.empty(TOTAL, np.float32), np.empty(TOTAL, np.float32)
    g = views(grad)
    for a in range(0, len(words), STEP):
        part = Chunks(words[a : a + STEP])
        near = around[:, a : a + STEP][:, part.order]
        n = len(part.order)
        row = np.arange(n)
        h = hidden(w, near)
        e = softmax(h @ w["wc"] + w["bc"])
        e[row, part.kind] -= 1
        back = e @ w["wc"].T
        np.matmul(h.T, e, out=g["wc"])
        e.sum(0, out=g["bc"])
        own, weights = part.spread(biased(h)), members(w)[part.of_chunk]
        e = softmax(part.rows(own @ weights))
        e[row, part.member] -= 1
        e = part.spread(e)
        back += part.rows(e @ weights[:, :-1].transpose(0, 2, 1))
        sums = part.by_class(own.transpose(0, 2, 1) @ e)
        g["wm"][:], g["bm"][:] = sums[:, :-1], sums[:, -1]
        back *= 1 - h * h
        back.sum(0, out=g["bias"])
        sums = back.astype(float).ravel()
        for k in range(len(AROUND)):
            at = np.take(CELLS, near[k], 0).ravel()
            g["embed"][k] = np.bincount(at, sums, SIZE * HIDDEN).reshape(SIZE, HIDDEN)
        grad /= n
        squares += np.multiply(grad, grad, out=change)
        np.divide(grad, np.sqrt(squares, out=change), out=change)
        change *= RATE
        flat -= change


class Vocabulary(NamedTuple):
    """The words of a corpus: ids of the frequent ones, all words' counts, sums of buckets.

    The counts of at most ``KNOWN`` words are an array, those of the others a table.
    """

    names: np.ndarray  # hashes, sorted
    ids: np.ndarray
    known: tuple[np.ndarray, np.ndarray]  # hashes, sorted, and counts
    counts: DataFrame  # word, n
    totals: np.ndarray
    words: int  # occurrences of all words


def buckets(h: np.ndarray) -> np.ndarray:
    return TOP + (h % np.uint64(UNSEEN - TOP)).astype(np.int64)


def hashed(t: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a slice's words, lowered, and where each row's begin."""
    w = arrays.words(t)
    return arrays.word_hashes(arrays.lowered(t.data), w), w.offsets


def frequent(h: np.ndarray, names) -> np.ndarray:
    """Ids of hashed words; those that aren't frequent have ``UNSEEN``."""
    if not len(names[0]):
        return np.full(len(h), UNSEEN)
    at = np.minimum(np.searchsorted(names[0], h), len(names[0]) - 1)
    return np.where(names[0][at] == h, names[1][at], UNSEEN)


def word_ids(t: arrays.Texts, names, corpus: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a slice's words, and where each row's begin.

    ``names`` are the hashes of the frequent words, sorted, with their ids. With
    ``corpus``, the others are words of the corpus and have their buckets.
    """
    h, offsets = hashed(t)
    ids = frequent(h, names)
    return np.where(ids == UNSEEN, buckets(h), ids) if corpus else ids, offsets


def neighbours(ids: np.ndarray, offsets: np.ndarray, some: np.ndarray | None = None) -> np.ndarray:
    """The ids around each word, or around those at the places ``some``."""
    some = np.arange(len(ids)) if some is None else some
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[some]
    first, end = offsets[row], offsets[row + 1]
    out = np.empty((len(AROUND), len(some)), ids.dtype)
    for k, step in enumerate(AROUND):
        at = some + step
        inside = (at >= first) & (at < end)
        out[k] = np.where(inside, ids[np.where(inside, at, 0)], EDGE)
    return out


def targets(sizes: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Words that a round learns, of texts of these numbers of words."""
    return np.flatnonzero(arrays.within(sizes) % rounds == turn)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Distinct hashes with their counts, from those of several slices."""
    h, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(h)
    start, _ = arrays.group_bounds(h[order])
    n = np.add.reduceat(n[order], start) if len(h) else n
    return pa.RecordBatch.from_arrays(
        [pa.array(h[order][start].view(np.int64)), pa.array(n)], ["word", "n"]
    )


def known_words(counts: DataFrame, known: int) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame]:
    """The counts of the most frequent words, ``known`` at most, and the table of the others.

    They are cut at a level of frequency, an eighth of a doubling.
    """
    level = F.floor(F.log2("n") * 8).cast("int")
    total, least = 0, None
    for at, count in sorted(counts.groupBy(level).count().collect(), reverse=True):
        total += count
        if total > known:
            break
        least = at
    some = F.lit(False) if least is None else level >= least
    got = counts.where(some).toArrow()
    h = got.column("word").to_numpy().view(np.uint64)
    order = np.argsort(h)
    return (h[order], got.column("n").to_numpy()[order]), counts.where(~some)


def vocabulary(df: DataFrame, text: str, known: int = KNOWN) -> Vocabulary:
    """All words of all texts with their counts; the most frequent ones by rank."""

    def run(batches):
        for batch in batches:
            parts = []
            for t in arrays.slices(batch.column("text"), BLOCK // 8):
                parts.append(np.unique(hashed(t)[0], return_counts=True))
                if len(parts) == MERGED:
                    yield merged(parts)
                    parts = []
            if parts:
                yield merged(parts)

    def add(batches):
        sums = np.zeros(SIZE, np.int64)
        for batch in batches:
            h = batch.column("word").to_numpy().view(np.uint64)
            np.add.at(sums, buckets(h), batch.column("n").to_numpy())
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(sums[own])], ["bucket", "n"])

    rows = df.select(F.col(text).cast("string").alias("text"))
    counts = staged(
        rows.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    got = counts.orderBy(F.desc("n"), "word").limit(TOP).collect()
    names = np.array([r["word"] for r in got], np.int64).view(np.uint64)
    totals = np.zeros(SIZE)
    sums = counts.mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in sums.collect():
        totals[r["bucket"]] = r["n"]
    words = int(totals.sum())
    np.subtract.at(totals, buckets(names), [r["n"] for r in got])
    order = np.argsort(names)
    return Vocabulary(names[order], order, *known_words(counts, known), totals, words)


def with_unseen(flat: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Weights by which ``UNSEEN``, never met in training, counts as half a word.

    Among the members of its class its share is ``HALF`` to the class's count; as a
    neighbour it is the mean of the buckets.
    """
    flat = flat.copy()
    w = views(flat)
    kind, member = divmod(UNSEEN, MEMBERS)
    others = np.arange(MEMBERS) != member
    count = max(1.0, totals[kind * MEMBERS : (kind + 1) * MEMBERS].sum())
    weight = totals[TOP:UNSEEN] + 1e-9
    w["embed"][:, UNSEEN] = np.average(w["embed"][:, TOP:UNSEEN], axis=1, weights=weight)
    # The same direction as the buckets', so that the share holds in any place.
    share = np.where(others, totals[kind * MEMBERS : (kind + 1) * MEMBERS], 0) + 1e-9 * others
    w["wm"][kind][:, member] = w["wm"][kind] @ (share / share.sum())
    bias = w["bm"][kind][others]
    w["bm"][kind][member] = np.log(HALF / count) + bias.max() + np.log(np.exp(bias - bias.max()).sum())
    return flat


def packed(x: np.ndarray) -> pa.Array:
    """An array as one compressed value of a batch."""
    return pa.array([zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x))], pa.binary())


def unpacked(value: pa.Scalar, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value.as_buffer()), kind)


def fit(df: DataFrame, text: str = "text", rounds: int = ROUNDS, known: int = KNOWN):
    """The vocabulary and the trained weights."""
    vocab = vocabulary(df, text, known)
    names = vocab[:2]

    def pick(batches):
        for batch in batches:
            for t in arrays.slices(batch.column("text"), BLOCK // 8):
                ids, offsets = word_ids(t, names, corpus=True)
                sizes = np.diff(offsets).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [packed(ids.astype(np.int16)), packed(sizes)],
                    ["ids", "sizes"],
                )

    rows = df.select(F.col(text).cast("string").alias("text"))
    tasks = int(min(partitions(df), max(1, vocab.words // TASK)))
    coded = staged(
        rows.mapInArrow(pick, "ids binary, sizes binary").repartition(tasks), "words-coded"
    )
    flat = initial()
    for turn in range(rounds):
        start = flat

        def learn(batches, start=start, turn=turn):
            own, squares, n = start.copy(), np.full(TOTAL, 1e-2, np.float32), 0
            for batch in batches:
                for x, y in zip(batch.column("ids"), batch.column("sizes"), strict=True):
                    ids = unpacked(x, np.int16).astype(np.int64)
                    sizes = unpacked(y, np.int32).astype(np.int64)
                    some = targets(sizes, turn, rounds)
                    train(own, squares, neighbours(ids, np.r_[0, np.cumsum(sizes)], some), ids[some])
                    n += len(some)
            if n:
                parts = np.array_split(own.astype(float) * n, SHARDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(SHARDS)), pa.array([p.tobytes() for p in parts]),
                     pa.array(np.full(SHARDS, n))],
                    ["shard", "weighted", "n"],
                )

        def add(batches):
            sums, n = {}, {}
            for batch in batches:
                for shard, x, size in zip(
                    batch.column("shard").to_pylist(), batch.column("weighted"),
                    batch.column("n").to_pylist(), strict=True,
                ):
                    sums[shard] = sums.get(shard, 0) + np.frombuffer(x.as_buffer(), np.float64)
                    n[shard] = n.get(shard, 0) + size
            if sums:
                means = [(sums[s] / n[s]).astype(np.float32).tobytes() for s in sums]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sums), pa.int64()), pa.array(means)], ["shard", "weights"]
                )

        got = (
            coded.mapInArrow(learn, "shard long, weighted binary, n long")
            .repartition(min(SHARDS, partitions(df)), "shard")
            .mapInArrow(add, "shard long, weights binary")
            .collect()
        )
        if got:
            got.sort(key=lambda r: r["shard"])
            flat = np.concatenate([np.frombuffer(r["weights"], np.float32) for r in got])
    return vocab, with_unseen(flat, vocab.totals)


def counted(h: np.ndarray, names: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts of hashed words; 0 for those that the arrays lack."""
    if not len(names):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(names, h), len(names) - 1)
    return np.where(names[at] == h, counts[at], 0)


def share(count: np.ndarray, kind: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Words' shares of their buckets, 1 where there is no count."""
    return np.where(count > 0, count / np.maximum(totals[kind], 1), 1.0)


def by_text(p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0.0, np.cumsum(p)][offsets])


def scores(df: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, log_likelihood (the sum over words) and per_word, its mean.

    Null, empty and blank texts have no words, sum 0 and a null mean. Repeated
    rows are each returned; a null id stays null. Other columns are not read, an
    empty table gives no rows.
    """
    vocab, flat = model
    names, totals = vocab[:2], vocab.totals
    known = df.sparkSession.sparkContext.broadcast(vocab.known)
    key = df.select(F.col(doc_id).alias("doc_id")).schema["doc_id"].dataType.simpleString()

    def code(batches):
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for t in arrays.slices(batch.column("text"), BLOCK):
                h, offsets = hashed(t)
                ids = frequent(h, names)
                rare = np.flatnonzero(ids == UNSEEN)
                words, inverse = np.unique(h[rare], return_inverse=True)
                inverse = inverse.ravel()
                count, kind = counted(words, *known.value), buckets(words)
                ids[rare] = kind[inverse]
                more = np.zeros(len(h))
                more[rare] = np.log(share(count, kind, totals))[inverse]
                # What the table of counts has yet to tell.
                rest, number = count == 0, np.cumsum(count == 0) - 1
                some = rest[inverse]
                own = batch.column("doc_id").slice(t.first, t.rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at]), pa.ListArray.from_arrays(pa.array([0, t.rows], pa.int32()), own),
                     packed(np.diff(offsets).astype(np.int32)), packed(ids.astype(np.int16)),
                     packed(by_text(more, offsets)), packed(rare[some].astype(np.int32)),
                     packed(number[inverse][some].astype(np.int32)),
                     pa.ListArray.from_arrays(
                         pa.array([0, rest.sum()], pa.int32()), pa.array(words[rest].view(np.int64)))],
                    ["block", "doc_ids", "sizes", "ids", "more", "places", "numbers", "rest"],
                )
                at += 1

    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    coded = staged(
        rows.mapInArrow(
            code,
            f"block long, doc_ids array<{key}>, sizes binary, ids binary, more binary, "
            "places binary, numbers binary, rest array<long>",
        ),
        "blocks",
    )
    found = (
        coded.select("block", F.explode("rest").alias("word"))
        .join(vocab.counts, "word")
        .groupBy("block")
        .agg(F.collect_list(F.struct("word", "n")).alias("found"))
    )

    def run(batches):
        w = views(flat)
        for batch in batches:
            for k in range(batch.num_rows):
                # In unsigned order.
                rest = batch.column("rest")[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                count = np.zeros(len(rest), np.int64)
                got = batch.column("found")[k].values
                if got is not None and len(got):
                    word = got.field("word").to_numpy().view(np.uint64)
                    count[np.searchsorted(rest, word)] = got.field("n").to_numpy()
                sizes = unpacked(batch.column("sizes")[k], np.int32).astype(np.int64)
                offsets = np.r_[0, np.cumsum(sizes)]
                ids = unpacked(batch.column("ids")[k], np.int16).astype(np.int64)
                places = unpacked(batch.column("places")[k], np.int32)
                numbers = unpacked(batch.column("numbers")[k], np.int32)
                ids[places[count[numbers] == 0]] = UNSEEN
                p = log_probabilities(w, neighbours(ids, offsets), ids)
                p[places] += np.log(share(count, buckets(rest), totals))[numbers]
                total = by_text(p, offsets) + unpacked(batch.column("more")[k], np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[k].values, pa.array(sizes), pa.array(total)],
                    ["doc_id", "n_words", "log_likelihood"],
                )

    return (
        coded.join(found, "block", "left")
        .drop("block")
        .mapInArrow(run, f"doc_id {key}, n_words long, log_likelihood double")
        .withColumn("per_word", F.try_divide("log_likelihood", "n_words"))
    )
