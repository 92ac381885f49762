"""Secret scans: fixed patterns, and spans added by a conditional random field.

The linear-chain CRF tags the tokens of a text as outside, begin or inside of a
secret. It sees a token's shape, the words before it, the signs on either side
and how code-like the text is. Trained on texts tagged by the patterns, it adds
values of like shape in like places that the patterns miss.
"""

from __future__ import annotations

import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import arrays

# The patterns of the base kinds, with the group and length that count.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
# All hex runs that are long enough, found faster: a maximal run either is or isn't.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")

O, B, I = 0, 1, 2  # noqa: E741
BINS = 1 << 15
SAMPLE = 1500  # texts with, and without, a base match that the fit reads at most
EPOCHS = 12
TOKEN = np.zeros(256, bool)
TOKEN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_/+-"]] = True
TOKEN[128:] = True


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, rank of the kind, end, start of the value), by start, then kind."""
    out = []
    low = text.lower() if any(s in text for s in ":=") else ""
    for rank, (_, pattern, group, least) in enumerate(KINDS):
        if rank == 0 and not any(k in low for k in ("passw", "secret", "token", "api")):
            continue
        if rank == 1 and "AKIA" not in text:
            continue
        for m in (LONG_HEX if rank == 2 else pattern).finditer(text):
            if len(m.group(group)) >= least:
                out.append((m.start(), rank, m.end(), m.start(group)))
    return sorted(out)


def tokens(t: arrays.Texts) -> arrays.Words:
    inside = TOKEN[t.data]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    before[t.offsets[:-1][t.offsets[:-1] < len(inside)]] = False
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    ends = t.offsets[1:]
    after[ends[ends > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return arrays.Words(
        start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(start, t.offsets).astype(np.int64)
    )


def features(t: arrays.Texts, w: arrays.Words) -> np.ndarray:
    """Bins of each token's features, a column each."""
    data, n = t.data, len(w.start)
    kinds = np.zeros((5, len(data)), np.int32)
    kinds[0] = (data >= 97) & (data <= 122)
    kinds[1] = (data >= 65) & (data <= 90)
    kinds[2] = (data >= 48) & (data <= 57)
    kinds[3] = kinds[2] | ((data >= 97) & (data <= 102))
    kinds[4] = data >= 128
    sums = np.zeros((5, len(data) + 1), np.int32)
    np.cumsum(kinds, axis=1, out=sums[:, 1:])
    lower, upper, digit, hexed, other = sums[:, w.end] - sums[:, w.start]
    size = w.end - w.start
    length = np.searchsorted([3, 6, 10, 16, 20, 24, 32, 40, 64], size, "right")
    mixed = (lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (other > 0)
    shape = (length * 16 + mixed) * 4 + 2 * (hexed == size) + (digit * 3 >= size)
    names = arrays.word_hashes(arrays.lowered(data), w)
    short = np.where(size <= 12, names, np.uint64(1))
    # Signs between tokens: which of : = quote newline blank there are.
    signs = np.zeros((5, len(data) + 1), np.int32)
    for k, sign in enumerate((b":", b"=", b"\"'", b"\n", b" ")):
        np.cumsum(np.isin(data, np.frombuffer(sign, np.uint8)), out=signs[k, 1:])
    row = np.searchsorted(w.offsets, np.arange(n), "right") - 1
    begin = np.maximum(np.r_[0, w.end[:-1]], t.offsets[row])
    finish = np.minimum(np.r_[w.start[1:], len(data)], t.offsets[row + 1])
    powers = 1 << np.arange(5)
    left = powers @ ((signs[:, w.start] - signs[:, begin]) > 0)
    right = powers @ ((signs[:, finish] - signs[:, w.end]) > 0)

    def ahead(values, step):
        out = np.full(n, 7, np.uint64)
        if n > step:
            same = row[step:] == row[:-step]
            out[step:][same] = values[:-step][same]
        return out

    coded = signs[0] + signs[1] + signs[2]
    per = (coded[t.offsets[1:]] - coded[t.offsets[:-1]]) / np.maximum(1, np.diff(t.offsets))
    code = np.searchsorted([0.002, 0.01, 0.03], per)[row]
    columns = (
        shape,
        short,
        ahead(short, 1) * np.uint64(32) + left.astype(np.uint64),
        ahead(short, 2),
        left * 32 + right,
        shape * 32 + left,
        shape * 8 + code,
    )
    bins = [
        arrays.mix(np.asarray(c).astype(np.uint64) + np.uint64((k + 1) << 58)) % np.uint64(BINS)
        for k, c in enumerate(columns)
    ]
    return np.stack(bins).astype(np.int32)


def uncovered(starts, ends, base: list) -> list[tuple[int, int]]:
    """Parts of a span of tokens outside the base spans, from token to token."""
    at, out = int(starts[0]), []
    for a, b in [*sorted((x[0], x[2]) for x in base), (int(ends[-1]), int(ends[-1]))]:
        a = min(a, int(ends[-1]))
        own = np.flatnonzero((ends > at) & (starts < a))
        if len(own):
            out.append((max(at, int(starts[own[0]])), min(a, int(ends[own[-1]]))))
        at = max(at, b)
    return out


def char_positions(t: arrays.Texts) -> np.ndarray:
    """Characters before each byte of the slice."""
    out = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum((t.data & 0xC0) != 0x80, out=out[1:])
    return out


def gold(t: arrays.Texts, w: arrays.Words) -> np.ndarray:
    """Tags by the patterns."""
    tags = np.zeros(len(w.start), np.int8)
    chars = char_positions(t)
    for k in range(t.rows):
        a, b = t.offsets[k], t.offsets[k + 1]
        at = chars[w.start[w.offsets[k] : w.offsets[k + 1]]] - chars[a]
        for _, _, end, value in base_spans(t.data[a:b].tobytes().decode()):
            own = np.flatnonzero((at >= value) & (at < end)) + w.offsets[k]
            tags[own] = I
            tags[own[:1]] = B
    return tags


def windows(f: np.ndarray, y: np.ndarray):
    """Windows of one text to train on: its tokens' bins and tags, filled up if short."""
    if not len(y):
        return
    if len(y) < WIDE:
        short = WIDE - len(y)
        f = np.vstack([f, np.full((short, f.shape[1]), BINS, np.int32)])
        y = np.r_[y, np.full(short, O, np.int8)].astype(np.int8)
    last = len(y) - WIDE
    starts = [*range(0, last, WIDE), last]
    tagged = [y[a : a + WIDE].any() for a in starts]
    for k, a in enumerate(starts):
        if any(tagged[max(0, k - 1) : k + 2]) or k % 16 == 0:
            yield f[a : a + WIDE], y[a : a + WIDE]


def fit(df: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE):
    """Weights (BINS + 1, 3), the last row of filled places, and transitions (3, 3), from at most ``sample`` texts of each sort.

    They are the first by a hash of id and text, repeated rows counted once. Of
    each text, windows of 12 tokens that hold tagged ones, the one before and the
    one after these, and every 16th other reach the driver as bins and tags. The
    last window ends with its text; shorter texts are filled up with places that
    can only be outside.
    """
    rows = df.select(
        F.col(text).cast("string").alias("text"), F.xxhash64(doc_id, text).alias("place")
    ).where("text is not null")
    likely = F.col("text").rlike(
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
    )
    marked = rows.select("place", "text", likely.alias("likely"))
    places = marked.select("place", "likely").distinct()
    chosen = None
    for flag in (True, False):
        some = places.where(F.col("likely") == flag).orderBy("place").limit(sample)
        chosen = some if chosen is None else chosen.union(some)
    picked = (
        marked.join(chosen.select("place"), "place", "left_semi")
        .dropDuplicates(["place"])
        .select("text")
    )

    def run(batches):
        for batch in batches:
            bins, tags = [], []
            for t in arrays.slices(batch.column("text")):
                w = tokens(t)
                if not len(w.start):
                    continue
                f, y = features(t, w), gold(t, w)
                for k in range(t.rows):
                    own = slice(w.offsets[k], w.offsets[k + 1])
                    for x, z in windows(f[:, own].T.astype(np.int32), y[own]):
                        bins.append(x.tobytes())
                        tags.append(z.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins, pa.binary()), pa.array(tags, pa.binary())], ["bins", "tags"]
            )

    got = picked.mapInArrow(run, "bins binary, tags binary").toPandas()
    if not len(got):
        return np.zeros((BINS + 1, 3)), np.zeros((3, 3))
    got = got.sort_values(["bins", "tags"])
    bins = np.stack([np.frombuffer(x, np.int32).reshape(WIDE, -1) for x in got["bins"]])
    tags = np.stack([np.frombuffer(x, np.int8) for x in got["tags"]]).astype(np.int64)
    return train(bins, tags)


WIDE = 12


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(bins: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS):
    """Maximise the likelihood of the tags by AdaGrad with forward-backward sums."""
    w, move = np.zeros((BINS + 1, 3)), np.zeros((3, 3))
    seen_w, seen_m = np.full_like(w, 1e-3), np.full_like(move, 1e-3)
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for own in np.array_split(rng.permutation(len(bins)), max(1, len(bins) // 256)):
            x, y = bins[own], tags[own]
            score = w[x].sum(2)
            score[x[:, :, 0] == BINS, 1:] = -1e9
            n, length = y.shape
            fore, back = np.empty_like(score), np.zeros_like(score)
            fore[:, 0] = score[:, 0]
            for k in range(1, length):
                fore[:, k] = score[:, k] + log_sum(fore[:, k - 1, :, None] + move, 1)
            for k in range(length - 2, -1, -1):
                back[:, k] = log_sum(move + (score[:, k + 1] + back[:, k + 1])[:, None, :], 2)
            total = log_sum(fore[:, -1], 1)
            grad = -np.exp(fore + back - total[:, None, None])
            grad[np.arange(n)[:, None], np.arange(length), y] += 1
            pair = np.zeros((3, 3))
            for k in range(1, length):
                both = fore[:, k - 1, :, None] + move + (score[:, k] + back[:, k])[:, None, :]
                pair -= np.exp(both - total[:, None, None]).sum(0)
                np.add.at(pair, (y[:, k - 1], y[:, k]), 1)
            g = np.zeros_like(w)
            for f in range(x.shape[2]):
                np.add.at(g, x[:, :, f].ravel(), grad.reshape(-1, 3))
            g = g / n - 1e-5 * w
            seen_w += g * g
            w += 0.2 * g / np.sqrt(seen_w)
            seen_m += (pair / n) ** 2
            move += 0.2 * (pair / n) / np.sqrt(seen_m)
    return w, move


def viterbi(score: np.ndarray, move: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The best tags of each row's chain.

    A token whose lead for "outside" is beyond anything that transitions can
    change is outside on every best path, so chains part there, and the short
    rest is decoded side by side.
    """
    n = len(score)
    tags = np.zeros(n, np.int8)
    reach = 2 * (move.max() - move.min())
    open_ = score[:, O] - score[:, 1:].max(1) <= reach if n else np.empty(0, bool)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    head = np.flatnonzero(open_ & (first[:n] | ~np.r_[False, open_[:-1]])) if n else np.empty(0, int)
    tail = np.flatnonzero(open_ & (first[1:] | ~np.r_[open_[1:], False])) if n else np.empty(0, int)
    size = tail - head + 1
    order = np.argsort(-size, kind="stable")
    head, tail, size = head[order], tail[order], size[order]
    if not len(head):
        return tags
    # The neighbour outside a run is outside, unless the text begins or ends there.
    best = score[head] + np.where(first[head][:, None], 0.0, move[O])
    back = []
    for k in range(1, int(size[0])):
        live = int((size > k).sum())
        paths = best[:live, :, None] + move
        back.append(paths.argmax(1))
        best[:live] = paths.max(1) + score[head[:live] + k]
    last = best + np.where(first[tail + 1][:, None], 0.0, move[:, O])
    now = last.argmax(1)
    for k in range(int(size[0]) - 1, -1, -1):
        live = int((size > k).sum())
        tags[head[:live] + k] = now[:live]
        if k:
            now[:live] = back[k - 1][np.arange(live), now[:live]]
    return tags


def scanned(df: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of each row.

    Spans are kind:start:end in characters, by start, then kind, joined by
    commas; those of the CRF have the kind crf and never overlap a base one: of a
    stretch that does, the parts outside base spans are given. A null text is the empty one and has none; so has one without tokens. Repeated rows
    are each returned, a null id stays null. Other columns are not read, an
    empty table gives no rows.
    """
    weights, move = model
    weights = weights.astype(np.float32)
    names = [k[0] for k in KINDS] + ["crf"]

    def run(batches):
        for batch in batches:
            out = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for t in arrays.slices(batch.column("text")):
                w = tokens(t)
                f = features(t, w) if len(w.start) else np.empty((0, 0), np.int32)
                score = np.zeros((len(w.start), 3), np.float32)
                for column in f:
                    score += weights[column]
                tags = viterbi(score, move, w.offsets)
                chars = char_positions(t)
                for k in range(t.rows):
                    a, b = t.offsets[k], t.offsets[k + 1]
                    base = base_spans(t.data[a:b].tobytes().decode())
                    own = slice(w.offsets[k], w.offsets[k + 1])
                    y = tags[own]
                    begin = np.flatnonzero((y == B) | ((y == I) & (np.r_[O, y[:-1]] == O)))
                    close = np.flatnonzero((y != O) & (np.r_[y[1:], O] != I))
                    starts = chars[w.start[own]] - chars[a]
                    ends = chars[w.end[own]] - chars[a]
                    more = [
                        (s, 3, e)
                        for i, j in zip(begin, close, strict=True)
                        for s, e in uncovered(starts[i : j + 1], ends[i : j + 1], base)
                    ]
                    base = [x[:3] for x in base]
                    text_of = lambda spans: ",".join(
                        f"{names[r]}:{s}:{e}" for s, r, e in spans
                    )
                    for rank, name in enumerate(("n_assign", "n_access", "n_hex")):
                        out[name].append(sum(x[1] == rank for x in base))
                    out["base_sha256"].append(sha256(text_of(base).encode()).hexdigest())
                    out["spans"].append(text_of(sorted(base + more)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(v, x) for v, x in zip(out.values(), kinds, strict=True)]],
                ["doc_id", *out],
            )

    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )
