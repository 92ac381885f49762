"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel of two words counts the letter triples they share in order, gaps
allowed, each weighted by a decay to the power of its span; other characters
only widen gaps. So an insult with letters pulled apart or characters put in
stays close to the plain one. Texts are lower-cased and decomposed first, and
letters of every script count. Landmarks are words that set toxic training texts
apart. A sentence's features are, by landmark, the kernel of its closest word and
the sum of a power of all its words' kernels (again a kernel), which counts only
near equal words; each made orthogonal by the inverse root of the landmarks'
kernel matrix. The SVM is trained on the worst sentences of labelled texts, first
those closest to landmarks, then those that the SVM so far calls worst; of a toxic
text all but the first must hold a landmark itself. A text's score is the higher
of two logistic fits: of its worst sentence's margin, so that one sure insult is
enough, and of its three worst, as several doubtful words prove more than one.
Both know its number of sentences, among which one is doubtful sooner.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import arrays

SAMPLE = 6000  # labelled texts of each class that the fit reads at most
LANDMARKS = 256  # rank of the Nyström features at most
RESIDUAL = 0.75  # part of a landmark's kernel that those before it must leave unexplained
POWER = 6
NEAR = 0.9  # kernel of a word that is taken for the landmark itself
ROUNDS = 2  # trainings of the SVM
WORST = 3  # sentences that make up a text's score
DECAY = 0.7
GAPS = (1, 2, 3)
PIECE = 24  # letters of a word are compared in pieces of this many bytes, half overlapping
LEAST = 0.45  # a kernel below this counts as none
THRESHOLD = 0.7
BLOCK = 2048  # sentences that the driver weighs at a time
WORDS = 8192  # words whose kernels or features a task holds at a time

LETTERS = 63  # codes of letters; this one is no letter
CODES = np.full(256, LETTERS, np.int32)
CODES[ord("a") : ord("z") + 1] = np.arange(26)
CODES[ord("A") : ord("Z") + 1] = np.arange(26)


@dataclass
class Model:
    """Landmark words, SVM weights over the features, and the score's logistic weights."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slopes: np.ndarray  # by fit, of the worst margins and the logarithm of the number of sentences
    shift: np.ndarray


def plain(column: pa.Array) -> pa.Array:
    """Texts in lower case and compatibility decomposition."""
    return pc.utf8_normalize(pc.utf8_lower(column), "NFKD")


def plain_slices(column: pa.Array):
    """Slices of a text column, each made plain by itself: no second copy of the column is held."""
    for raw in arrays.slices(column):
        for t in arrays.slices(plain(column.slice(raw.first, raw.rows)), 1 << 30):
            yield t._replace(first=raw.first + t.first)


def letters(t: arrays.Texts, w: arrays.Words) -> tuple[np.ndarray, arrays.Words]:
    """Codes of a slice's letters and other characters, and the words among them.

    A letter beyond ASCII is its bytes after the first, each hashed with the byte
    before it. Lead bytes and combining marks are left out, so that letters of
    other scripts stand as close together as ASCII ones.
    """
    data = t.data
    codes = CODES[data]
    if not len(data) or data.max() < 0x80:
        return codes, w
    before = np.r_[np.uint8(0), data[:-1]]
    twice = np.r_[np.uint8(0), before[:-1]]
    inner = (data & 0xC0) == 0x80
    pair = arrays.mix(before.astype(np.uint64) * np.uint64(256) + data)
    codes = np.where(inner, 26 + (pair % np.uint64(LETTERS - 26)).astype(np.int32), codes)
    # Punctuation, symbols and emoji.
    sign = inner & (np.isin(before, (0xC2, 0xE2, 0xEF, 0xF0)) | np.isin(twice, (0xE2, 0xEF, 0xF0)))
    codes[sign] = LETTERS
    keep = (data < 0xC0) & ~(inner & np.isin(before, (0xCC, 0xCD)))
    place = np.r_[0, np.cumsum(keep)]
    return codes[keep], arrays.Words(place[w.start], place[w.end], w.offsets)


def spelled(t: arrays.Texts) -> arrays.Words:
    """Words, where letters that stand alone in a row make up one word."""
    blank = arrays.SPACES[t.data]
    n = len(blank)
    edge = np.zeros(n + 1, bool)
    edge[t.offsets] = True
    before = np.r_[True, blank[:-1]] | edge[:n] if n else blank
    after = np.r_[blank[1:], True] | edge[1:] if n else blank
    single = ~blank & before & after
    if n > 2:
        joint = np.zeros(n, bool)
        joint[1:-1] = blank[1:-1] & single[:-2] & single[2:] & ~edge[1 : n - 1] & ~edge[2:n]
        data = t.data.copy()
        data[joint] = ord("-")
        t = arrays.Texts(t.first, data, t.offsets)
    return arrays.words(t)


def pieces(letter: np.ndarray, w: arrays.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all pieces in a row, their piece, and the word of each piece.

    After a piece come as many non-letters as a triple is wide, so none spans two.
    """
    lengths = w.end - w.start
    count = np.maximum(1, -(-(lengths - PIECE) // (PIECE // 2)) + 1)
    word = np.repeat(np.arange(len(lengths)), count)
    start = w.start[word] + arrays.within(count) * (PIECE // 2)
    size = np.minimum(w.end[word] - start, PIECE)
    piece = np.repeat(np.arange(len(word)), size + 2 * max(GAPS))
    place = arrays.within(size + 2 * max(GAPS))
    at = np.minimum(start[piece] + place, max(0, len(letter) - 1))
    return np.where(place < size[piece], letter[at], LETTERS), piece, word


def triples(codes: np.ndarray, piece: np.ndarray) -> list:
    """For each pair of gaps: pieces, triples and the weight they have."""
    n, out = max(0, len(codes) - 2 * max(GAPS)), []
    known = codes < LETTERS
    for g in GAPS:
        first = known[:n] & known[g : n + g]
        for h in GAPS:
            at = np.flatnonzero(first & known[g + h : n + g + h])
            triple = (codes[at] * LETTERS + codes[at + g]) * LETTERS + codes[at + g + h]
            out.append((piece[at], triple, DECAY ** (g + h - 2)))
    return out


def norms(found: list, size: int) -> np.ndarray:
    total = np.zeros(size)
    for piece, _, weight in found:
        total += weight * weight * np.bincount(piece, minlength=size)
    return np.sqrt(np.maximum(total, 1e-9))


def coded(words: list[str]):
    """By slice: the triples of the words, and the word of each piece."""
    for t in arrays.slices(plain(pa.array(words, pa.string()))):
        codes, piece, word = pieces(*letters(t, arrays.words(t)))
        yield triples(codes, piece), t.first + word


class Kernel:
    """Kernels of words with the landmarks, through an index of their triples."""

    def __init__(self, landmarks: list[str]) -> None:
        self.landmarks, self.size = landmarks, len(landmarks)
        key, value = [np.empty(0, np.int64)], [np.empty(0)]
        for found, word in coded(landmarks):
            norm = norms(found, len(word))
            for piece, triple, weight in found:
                key.append(triple.astype(np.int64) * max(1, self.size) + word[piece])
                value.append(weight / norm[piece])
        key, inverse = np.unique(np.concatenate(key), return_inverse=True)
        self.values = np.bincount(inverse, np.concatenate(value), len(key)).astype(np.float32)
        rows, self.marks = key // max(1, self.size), key % max(1, self.size)
        used, begin = np.unique(rows, return_index=True)
        self.slot = np.full(LETTERS**3, -1, np.int32)
        self.slot[used] = np.arange(len(used))
        self.begin = np.r_[begin, len(rows)]

    def hits(self, found: list, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces, landmarks and kernels that are at least ``LEAST``."""
        norm = norms(found, size)
        key, value = [np.empty(0, np.int64)], [np.empty(0)]
        for row, triple, weight in found:
            slot = self.slot[triple]
            known = slot >= 0
            row, slot = row[known], slot[known]
            count = self.begin[slot + 1] - self.begin[slot]
            entry = np.repeat(self.begin[slot], count) + arrays.within(count)
            key.append(np.repeat(row, count) * self.size + self.marks[entry])
            value.append(self.values[entry] * weight)
        key, inverse = np.unique(np.concatenate(key), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(value), len(key))
        row, mark = key // max(1, self.size), key % max(1, self.size)
        total = np.minimum(1.0, total / norm[row])
        keep = total >= LEAST
        return row[keep], mark[keep], total[keep]


def kernels_of(words: list[str], kernel: Kernel) -> np.ndarray:
    """Kernels of the words with the landmarks."""
    out = np.zeros((len(words), kernel.size))
    for found, word in coded(words):
        piece, mark, value = kernel.hits(found, len(word))
        np.maximum.at(out, (word[piece], mark), value)
    return out


class Space:
    """Landmarks with their kernel matrix; ``pivots`` span it up to ``RESIDUAL``."""

    def __init__(self, landmarks: list[str]) -> None:
        self.kernel = Kernel(landmarks)
        grams = kernels_of(landmarks, self.kernel)
        self.grams = (grams + grams.T) / 2
        left, self.pivots = self.grams.copy(), []
        for i in range(len(landmarks)):  # incomplete Cholesky, the surest word first
            if left[i, i] >= RESIDUAL * self.grams[i, i] > 0:
                left -= np.outer(left[:, i], left[i]) / left[i, i]
                self.pivots.append(i)
        self.size = len(self.pivots) + len(landmarks)

    def gapped(self) -> np.ndarray:
        """What is left of the features when words have a character between all letters."""
        marks = self.kernel.landmarks
        left = np.diag(kernels_of(["-".join(m) for m in marks], self.kernel))
        left = left[self.pivots].mean() if self.pivots else 1.0
        return np.r_[np.full(len(self.pivots), left), np.full(len(marks), left**POWER)]

    def root(self) -> np.ndarray:
        """Inverse roots of the kernel matrices of both parts of the features."""
        k = len(self.pivots)
        out = np.zeros((self.size, self.size))
        for part, grams in (
            (slice(0, k), self.grams[np.ix_(self.pivots, self.pivots)]),
            (slice(k, None), self.grams**POWER),
        ):
            values, vectors = np.linalg.eigh(grams + 0.05 * np.eye(len(grams)))
            out[part, part] = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0.05))) @ vectors.T
        return out


def sentences(t: arrays.Texts, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts (rows of the slice) and features of the sentences that have a hit.

    Third come the sentences of every row, hits or not.
    """
    w = spelled(t)
    ends = np.isin(t.data[w.end - 1], np.frombuffer(b".!?", np.uint8))
    number = np.r_[0, np.cumsum(ends)][w.offsets]
    lengths = np.diff(number) + 1
    if not len(w.start) or not space.size:
        return np.empty(0, np.int64), np.empty((0, space.size), np.float32), lengths
    inverse, names = pd.factorize(arrays.word_hashes(t.data, w))
    first = np.empty(len(names), np.int64)
    first[inverse[::-1]] = np.arange(len(inverse))[::-1]
    letter, within = letters(t, w)
    hits = []
    for a in range(0, len(first), WORDS):
        own = first[a : a + WORDS]
        some = arrays.Words(within.start[own], within.end[own], within.offsets)
        codes, piece, word = pieces(letter, some)
        row, mark, value = space.kernel.hits(triples(codes, piece), len(word))
        hits.append((a + word[row], mark, value))
    word, mark, value = (np.concatenate(x) for x in zip(*hits, strict=True))
    hit = np.zeros(len(first), bool)
    hit[word] = True
    place = np.cumsum(hit) - 1
    best = np.zeros((int(hit.sum()), space.kernel.size), np.float32)
    np.maximum.at(best, (place[word], mark), value)
    found = np.flatnonzero(hit[inverse])
    text = np.searchsorted(w.offsets, found, "right") - 1
    # Words come in order, so each sentence's hits are one run of them.
    sentence = (np.cumsum(ends) - ends)[found]
    begin = np.flatnonzero(np.r_[True, (np.diff(text) > 0) | (np.diff(sentence) > 0)][: len(found)])
    if not len(begin):
        return np.empty(0, np.int64), np.empty((0, space.size), np.float32), lengths
    at, ends = place[inverse[found]], np.r_[begin[1:], len(found)]
    closest, sums, k = best[:, space.pivots], best**POWER, len(space.pivots)
    features, a = np.empty((len(begin), space.size), np.float32), 0
    while a < len(begin):
        b = max(a + 1, int(np.searchsorted(ends, begin[a] + WORDS, "right")))
        own, cut = at[begin[a] : ends[b - 1]], begin[a:b] - begin[a]
        features[a:b, :k] = np.maximum.reduceat(closest[own], cut)
        features[a:b, k:] = np.add.reduceat(sums[own], cut)
        a = b
    return text[begin], features, lengths


def evidence(column: pa.Array, space: Space, weights: np.ndarray, bias: float) -> np.ndarray:
    """By text: the margins of its worst sentences, and the logarithm of how many it has."""
    out = np.full((len(column), WORST + 1), bias)
    out[:, WORST] = 0.0
    for t in plain_slices(column):
        rows, features, lengths = sentences(t, space)
        out[t.first : t.first + t.rows, WORST] = np.log(lengths)
        margin = np.maximum(features @ weights + bias, bias)
        order = np.lexsort((-margin, rows))
        rows, margin = rows[order], margin[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        top = rank < WORST
        out[t.first + rows[top], rank[top]] = margin[top]
    return out


def logit(found: np.ndarray, model: Model) -> np.ndarray:
    return np.clip((found @ model.slopes.T + model.shift).max(1), -30, 30)


def in_fold(doc_id):
    """Whether a row is held out of all learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    df: DataFrame, labels: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS
) -> Model:
    """Learn from at most ``sample`` texts of each class outside the held-out fold.

    They are the first by a hash of id and text, repeated rows counted once. What
    reaches the driver is at most ``landmarks`` words, and for each text one
    sentence's features and its evidence.
    """
    texts = df.select("doc_id", F.col("text").cast("string").alias("text")).withColumn(
        "place", F.xxhash64("doc_id", "text")
    )
    # Only ids and hashes are shuffled; texts meet the few chosen rows where they lie.
    ids = (
        texts.select("doc_id", "place")
        .join(
            labels.where("toxic is not null and doc_id is not null")
            .groupBy("doc_id")
            .agg(F.max("toxic").alias("toxic")),
            "doc_id",
        )
        .where(~in_fold(F.col("doc_id")))
        .distinct()
    )
    chosen = None
    for toxic in (0, 1):
        some = ids.where(F.col("toxic") == toxic).orderBy("place", "doc_id").limit(sample)
        chosen = some if chosen is None else chosen.union(some)
    known = (
        texts.join(F.broadcast(chosen), ["doc_id", "place"])
        .dropDuplicates(["doc_id", "place"])
        .persist()
    )
    words = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{M}]+", " ")
    around = F.transform(
        "words",
        lambda word, i: F.struct(
            word.alias("word"),
            F.get("words", i - 1).alias("left"),
            F.get("words", i + 1).alias("right"),
        ),
    )
    # Copies of a text repeat its words between the same neighbours, and count once.
    counts = (
        known.select("toxic", F.split(words, " ").alias("words"))
        .select("toxic", F.explode(around).alias("at"))
        .where("length(at.word) >= 3")
        .groupBy("at")
        .agg(F.max("toxic").alias("bad"), F.max(1 - F.col("toxic")).alias("good"))
        .groupBy(F.col("at.word").alias("word"))
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    )
    # A word of one odd text stands between many neighbours, so texts count as well.
    texts = (
        known.select("toxic", F.explode(F.array_distinct(F.split(words, " "))).alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad_texts"), F.sum(1 - F.col("toxic")).alias("good_texts"))
    )
    counts = counts.join(texts, "word").persist()
    size = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = max(1, size.get(1, 0)), max(1, size.get(0, 0))
    # How much likelier a word's texts are with their labels than by chance; of
    # all words, chance alone lifts about one above the logarithm of their number.
    share = bad / (bad + good)

    def lead(bad_n, good_n):
        n = bad_n + good_n
        return F.when(bad_n > 0, bad_n * F.log(bad_n / n / share)).otherwise(0.0) + F.when(
            good_n > 0, good_n * F.log(good_n / n / (1 - share))
        ).otherwise(0.0)

    least = float(np.log(max(1, counts.count()))) + 1
    marks = counts.withColumn(
        "lead",
        F.least(
            lead(F.col("bad"), F.col("good")), lead(F.col("bad_texts"), F.col("good_texts"))
        ),
    ).where((F.col("lead") >= least) & (F.col("bad") / bad > 6 * F.col("good") / good))
    # Words beyond chance are landmarks, the surest first; the SVM weighs weak ones.
    found = [r["word"] for r in marks.orderBy(F.desc("lead"), "word").limit(landmarks).collect()]
    counts.unpersist()
    space = Space(found)

    def shown(weights: np.ndarray) -> pa.Table:
        """The sentences that these weights call the worst, with class and share of their text."""

        def run(batches):
            for batch in batches:
                toxic = batch.column("toxic").to_numpy().astype(np.int64)
                rows, found = [], []
                for t in plain_slices(batch.column("text")):
                    text, features, _ = sentences(t, space)
                    order = np.lexsort((*features.T, -(features @ weights), text))
                    text, features = t.first + text[order], features[order]
                    rank = np.arange(len(text)) - np.searchsorted(text, text)
                    sure = features[:, : len(space.pivots)].max(1, initial=0) >= NEAR
                    keep = (rank < WORST) & ((rank == 0) | sure | (toxic[text] == 0))
                    rows.append(text[keep])
                    found.append(features[keep])
                text = np.concatenate([np.empty(0, np.int64), *rows])
                count = np.bincount(text, minlength=batch.num_rows)
                none = np.flatnonzero(count == 0)
                text = np.r_[text, none]
                out = np.vstack([*found, np.zeros((len(none), space.size), np.float32)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(toxic[text]),
                        pa.array(1 / np.maximum(1, count[text])),
                        pa.array(list(out), pa.list_(pa.float32())),
                    ],
                    ["toxic", "share", "features"],
                )

        return (
            known.select("toxic", "text")
            .mapInArrow(run, "toxic long, share double, features array<float>")
            .toArrow()
        )

    weights, bias = np.r_[np.ones(len(space.pivots)), np.zeros(len(found))], 0.0
    for _ in range(ROUNDS):
        got = shown(weights)
        y = np.where(got["toxic"].to_numpy() > 0, 1.0, -1.0)
        if not found or abs(y.sum()) == len(y):
            # Nothing to tell the classes apart: every text scores the share of toxic ones.
            known.unpersist()
            odds = np.clip((y > 0).mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
            flat = np.full(1, np.log(odds / (1 - odds)))
            return Model(found, np.zeros(space.size), 0.0, np.zeros((1, WORST + 1)), flat)
        x = got["features"].combine_chunks().flatten().to_numpy().reshape(len(y), space.size)
        weights, bias = train(space, x, y, got["share"].to_numpy())

    def weigh(batches):
        for batch in batches:
            seen = evidence(batch.column("text"), space, weights, bias)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic").cast(pa.int64()), pa.array(list(seen), pa.list_(pa.float64()))],
                ["toxic", "evidence"],
            )

    seen = (
        known.select("toxic", "text")
        .mapInArrow(weigh, "toxic long, evidence array<double>")
        .toPandas()
    )
    known.unpersist()
    x = np.stack(seen["evidence"].to_numpy())
    slopes, shift = np.zeros((2, WORST + 1)), np.zeros(2)
    for fit_no, columns in enumerate(([0, WORST], list(range(WORST + 1)))):
        slopes[fit_no, columns], shift[fit_no] = calibrated(
            x[:, columns], (seen["toxic"].to_numpy() > 0).astype(float)
        )
    return Model(found, weights, bias, slopes, shift)


def train(
    space: Space, x: np.ndarray, y: np.ndarray, share: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights over features and the bias, by Newton steps of the squared hinge.

    Each sentence counts twice, once as if its words were spelled with a character
    between all letters, so that the weights also hold for such spelling. Sums go
    over a block of sentences at a time and the root is applied to them, so that no
    second copy of the features is held.
    """
    root = np.eye(space.size + 1)
    root[:-1, :-1] = space.root()
    gapped = space.gapped()
    cost = share / np.where(y > 0, share[y > 0].sum(), share[y < 0].sum()) / 4
    w = np.zeros(len(root))
    ridge = 1e-3 * np.eye(len(w))
    for _ in range(60):
        grams, sums, weights = np.zeros(root.shape), np.zeros(len(w)), root @ w
        for at in range(0, len(x), BLOCK):
            plain_part = x[at : at + BLOCK].astype(float)
            for part in (plain_part, plain_part * gapped):
                z, side = np.c_[part, np.ones(len(part))], y[at : at + BLOCK]
                inside = side * (z @ weights) < 1
                z, weighed = z[inside], z[inside] * cost[at : at + BLOCK][inside, None]
                grams += weighed.T @ z
                sums += weighed.T @ side[inside]
        step = np.linalg.solve(root.T @ grams @ root + ridge, root.T @ sums)
        if np.allclose(step, w, atol=1e-9):
            break
        w = step
    return (root @ w)[:-1], float(w[-1])


def calibrated(x: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes and shift of a logistic fit, by damped Newton steps with a small ridge."""
    z = np.c_[x, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    ridge = np.r_[np.full(x.shape[1], 0.1), 1e-3]

    def loss(v):
        m = z @ v
        return (np.logaddexp(0, m) - toxic * m).sum() + (ridge * v * v).sum() / 2

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - toxic) + ridge * w
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
        step, scale = np.linalg.solve(h + 1e-9 * np.eye(len(w)), g), 1.0
        while scale > 1e-4 and loss(w - scale * step) > loss(w):
            scale /= 2
        w = w - scale * step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def scores(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from ``THRESHOLD`` on).

    Every sentence of the whole text counts. A null, empty or wordless text
    scores as one without any hit. A null id is not held out. Repeated rows are
    each returned; other columns are not read, an empty table gives no rows.
    """
    space = Space(model.landmarks)

    def run(batches):
        for batch in batches:
            seen = evidence(batch.column("text"), space, model.weights, model.bias)
            p = 1 / (1 + np.exp(-logit(seen, model)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p)], ["doc_id", "score"]
            )

    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id",
        in_fold(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(df: DataFrame, model: Model) -> DataFrame:
    """The rows whose text isn't predicted toxic, all columns kept.

    Null, empty and wordless texts stay, unless the model calls a text without any
    hit toxic. Repeated rows share one decision; an empty table stays empty.
    Columns keep their names, whatever they are.
    """
    space = Space(model.landmarks)
    limit = np.log(THRESHOLD / (1 - THRESHOLD))

    # Only texts go to Python, and only decisions come back.
    @F.arrow_udf("boolean")
    def stays(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            seen = evidence(column, space, model.weights, model.bias)
            yield pa.array(logit(seen, model) < limit)

    place = df.columns.index("text")
    rows = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return rows.where(stays(F.col(f"c{place}").cast("string"))).toDF(*df.columns)
