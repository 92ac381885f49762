"""Document fingerprints as Merkle trees over paragraphs and sections.

The leaves are paragraphs, cut further where the hash of a word says so, each
with its trailing white space. A leaf over ``MOST`` bytes, as of texts without white
space, is cut where the hash of the bytes before says so, at ``MOST`` bytes at the
latest. A section ends where the hash of a leaf says so;
the root covers the sections. As cuts depend on the words around them only, an
edit changes the leaves it touches, their sections and the root. Equal roots
mean equal texts; else the comparison goes down into sections that differ.

A fingerprint is text: root, sections (digest and number of leaves) and leaves
(digest and length), as hexadecimal numbers between dots.
"""

from __future__ import annotations

from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import arrays
from ledgerline.llm.common import partitions, unpacked

LEAF = np.uint64(3)  # a word ends a leaf if these bits of its hash are 0: 1 of 4
SECTION = np.uint64(15)
MOST = 255  # no leaf is longer, so that a byte of the fingerprint holds its length
WINDOW = 16  # bytes whose hash cuts a long leaf
APART = 32  # bytes between such cuts at least
BYTES = np.uint64(63)  # they are where these bits of the hash are 0


def _sums(values: np.ndarray, start: np.ndarray, total: int, seed: int) -> np.ndarray:
    """Hashes of runs of values that begin at ``start`` and end at the next one."""
    count = np.diff(np.r_[start, total])
    factor = arrays.multipliers(int(count.max()), seed)[arrays.within(count)]
    return arrays.mix(np.add.reduceat(values * factor, start) + count.astype(np.uint64))


def long_cuts(data: np.ndarray, powers: arrays.Powers) -> list[int]:
    """Where a leaf of over ``MOST`` bytes is cut, by the bytes before each place."""
    h = arrays.run_hashes(arrays.multipliers(256, 19)[data], WINDOW, powers)
    at = np.flatnonzero((h & BYTES) == 0) + WINDOW
    # The first of places close to each other stands; runs of one byte give none after it.
    at = at[np.diff(at, prepend=-APART) >= APART]
    out, last = [], 0
    for end in [*at[at < len(data)].tolist(), len(data)]:
        while end - last > MOST:
            # Elsewhere the smallest hash in reach decides, so that cuts fall in step again.
            last += APART + int(np.argmin(h[last + APART - WINDOW : last + MOST - WINDOW + 1]))
            out.append(last)
        if end < len(data):
            out.append(end)
        last = end
    return out


def trees(texts: list[bytes]) -> list[str]:
    """Fingerprints of texts."""
    out, powers = [], arrays.Powers(31)
    for t in arrays.slices(pa.array(texts, pa.large_binary()).cast(pa.large_string())):
        n = len(t.data)
        cut = np.zeros(n + 1, bool)
        cut[t.offsets] = True
        w = arrays.words(t)
        ends = (arrays.word_hashes(t.data, w) & LEAF) == 0
        # A leaf ends before the next word, or after a line.
        cut[w.start[1:][ends[:-1]]] = True
        cut[np.flatnonzero(t.data == 10) + 1] = True
        start = np.flatnonzero(cut[:n])
        size = np.diff(np.r_[start, n])
        for k in np.flatnonzero(size > MOST):
            own = long_cuts(t.data[start[k] : start[k] + size[k]], powers)
            cut[start[k] + np.array(own, np.int64)] = True
        start = np.flatnonzero(cut[:n])
        leaf = _sums(t.data.astype(np.uint64) + np.uint64(1), start, n, 13) if n else None
        size = np.diff(np.r_[start, n])
        first = np.searchsorted(start, t.offsets)
        for k in range(t.rows):
            own = slice(first[k], first[k + 1])
            raw = t.data[t.offsets[k] : t.offsets[k + 1]].tobytes()
            out.append(_tree(leaf[own] if n else np.empty(0, np.uint64), size[own], raw))
    return out


def _tree(leaf: np.ndarray, size: np.ndarray, raw: bytes) -> str:
    if not len(leaf):
        return f"{blake2b(raw, digest_size=16).hexdigest()}.."
    ends = (leaf & SECTION) == 0
    start = np.flatnonzero(np.r_[True, ends[:-1]])
    section = _sums(leaf, start, len(leaf), 17)
    count = np.diff(np.r_[start, len(leaf)])
    root = blake2b(section.tobytes() + len(raw).to_bytes(8, "big"), digest_size=16).hexdigest()
    above = np.stack([section & np.uint64(0xFFFFFFFF), count.astype(np.uint64)], 1).astype(">u4")
    below = ((leaf & np.uint64(0xFFFFFF)) << np.uint64(8)) | size.astype(np.uint64)
    return f"{root}.{above.tobytes().hex()}.{below.astype('>u4').tobytes().hex()}"


def _parsed(tree: str) -> tuple[str, np.ndarray, np.ndarray]:
    root, above, below = tree.split(".")
    sections = np.frombuffer(bytes.fromhex(above), ">u4").reshape(-1, 2).astype(np.int64)
    return root, sections, np.frombuffer(bytes.fromhex(below), ">u4").astype(np.int64)


def likeness(one: str, other: str) -> float:
    """Share of the two texts that lies in common leaves, from their fingerprints."""
    (ra, sa, la), (rb, sb, lb) = _parsed(one), _parsed(other)
    if ra == rb:
        return 1.0
    total = int((la & MOST).sum() + (lb & MOST).sum())
    keys, inverse = np.unique(np.r_[la, lb], return_inverse=True)
    a = np.bincount(inverse[: len(la)], minlength=len(keys))
    b = np.bincount(inverse[len(la) :], minlength=len(keys))
    common = int((np.minimum(a, b) * (keys & MOST)).sum())
    return 2 * common / total if total else 0.0


def differing(one: str, other: str) -> list[tuple[int, int]]:
    """Leaves (from, to) of the second text in branches that the first hasn't.

    Sections with equal digests are passed over whole.
    """
    (ra, sa, la), (rb, sb, lb) = _parsed(one), _parsed(other)
    if ra == rb:
        return []
    known, leaves, out, at = set(sa[:, 0].tolist()), set(la.tolist()), [], 0
    for digest, count in sb.tolist():
        if digest not in known:
            for k in range(at, at + count):
                if int(lb[k]) not in leaves:
                    if out and out[-1][1] == k:
                        out[-1] = (out[-1][0], k + 1)
                    else:
                        out.append((k, k + 1))
        at += count
    return out


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the beginning of another text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def with_next(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Packed rows in parts by range of id, each part with the row that follows it.

    Columns: part, over (1 for the row that follows), doc_id, tie, packed. Rows
    are sorted by id, a null one first, then by text; the first row follows the last.
    Only one id a part, a quantile of all ids, reaches the driver.
    """
    ids = df.select(F.col(doc_id).cast("long").alias("doc_id")).where("doc_id is not null")
    n = partitions(df)
    # Quantiles are ids that occur, as the start of a part must be.
    shares = [k / n for k in range(1, n)] or [0.5]
    least, cuts = ids.agg(
        F.min("doc_id"), F.percentile_approx("doc_id", shares, max(10_000, 20 * n))
    ).first()
    starts = [] if least is None else sorted({least, *cuts})
    last = max(0, len(starts) - 1)
    bounds = np.asarray(starts, np.int64)
    nulls = not df.where(F.col(doc_id).isNull()).isEmpty()

    def run(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            rows = {"part": [], "over": [], "doc_id": [], "tie": [], "packed": []}
            for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                raw = value.as_py() or b""
                tie = blake2b(raw, digest_size=8).digest()
                part = 0 if key is None else max(0, int(np.searchsorted(bounds, key, "right")) - 1)
                copies = [(part, 0)]
                if part and key == bounds[part]:
                    copies.append((part - 1, 1))
                if key is None or (not nulls and part == 0 and key == bounds[0]):
                    copies.append((last, 1))
                packed = squeeze(raw)
                for p, over in copies:
                    for name, x in zip(rows, (p, over, key, tie, packed), strict=True):
                        rows[name].append(x)
            yield pa.RecordBatch.from_pydict(
                rows,
                pa.schema(
                    [("part", pa.int32()), ("over", pa.int32()), ("doc_id", pa.int64()),
                     ("tie", pa.binary()), ("packed", pa.binary())]
                ),
            )

    rows = df.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")
    )
    return (
        rows.mapInArrow(run, "part int, over int, doc_id long, tie binary, packed binary")
        .repartition("part")
        .sortWithinPartitions("part", "over", F.col("doc_id").asc_nulls_first(), "tie")
    )


def compared(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint beside that of its edited text and of the next row.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null text is the empty one; all empty texts have one
    fingerprint. A single row follows itself. Rows that share an id are ordered
    by a digest of their text, repeated rows follow each other. Ids are whole
    numbers; a null one comes first. Other columns are not read, an empty table
    gives no rows. A task holds a few megabytes of texts, or one text.
    """

    def flush(rows):
        # rows: (part, over, doc_id, text); each with the next of its part.
        own = trees([r[3] for r in rows])
        pairs = [
            (i, i + 1) for i in range(len(rows) - 1)
            if rows[i][0] == rows[i + 1][0] and not rows[i][1]
        ]
        texts = [edited(rows[i][3].decode(), rows[j][3].decode()).encode() for i, j in pairs]
        new = trees(texts)
        out = {
            "doc_id": [rows[i][2] for i, _ in pairs],
            "n_chars": [len(rows[i][3].decode()) for i, _ in pairs],
            "edited_sha256": [sha256(x).hexdigest() for x in texts],
            "fingerprint": [own[i] for i, _ in pairs],
            "edited_fingerprint": new,
            "near_edited": [likeness(own[i], new[k]) for k, (i, _) in enumerate(pairs)],
            "near_next": [likeness(own[i], own[j]) for i, j in pairs],
        }
        return pa.RecordBatch.from_pydict(
            out,
            pa.schema(
                [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                 ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                 ("near_edited", pa.float64()), ("near_next", pa.float64())]
            ),
        )

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                raw = unpacked(batch.column("packed").slice(k, 1))[0]
                held.append((batch.column("part")[k].as_py(), batch.column("over")[k].as_py(),
                             batch.column("doc_id")[k].as_py(), raw))
                size += len(raw)
                if size > 4 << 20 and len(held) > 1:
                    yield flush(held)
                    held = held[-1:]
                    size = len(raw)
        if len(held) > 1:
            yield flush(held)

    return with_next(df, doc_id, text).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
