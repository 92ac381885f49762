"""Repeated runs of fixed length in texts, by sparse suffixes.

Of the suffixes of all texts, only those at anchors travel: the anchor of a run
of ``length`` symbols is the smallest of the hashed ``inner`` -symbol runs in it.
Equal runs have equal anchors, and neighbouring runs share one, so a row stands
for all consecutive runs of one anchor (a stretch). Rows meet by the content of
their anchor, a prefix whose length counted from the run's start varies:

1. Stretches with the same content are settled as they are; copies within a
   batch are settled before the shuffle, so that a frequent passage gives one
   row a batch.
2. Where an anchor has several contents, which happens at the edges of repeats,
   one stretch of each is fetched and its runs are told apart by refinement.

An anchor between ever new neighbours has as many contents as texts, so no task
takes all of them. Stretches are first counted by hash buckets of their anchors.
Those of busy buckets meet by anchor and content, their group's prefix being the
whole stretch; and single runs of them, or of any anchor of over ``crowd``
contents, meet by two 64-bit hashes of all their symbols instead of refinement.

Positions are in symbols. A text is known by its id and a hash of its content;
rows that repeat both are the same text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm import arrays
from ledgerline.llm.common import packed_texts, staged, unpacked

# Spans are settled. Entries meet by anchor, crowded ones run by run.
SPAN, ENTRY, CROWDED = 0, 1, 2
# Anchors are counted by this many bits of a hash.
BUCKET_BITS = 16
STRETCH = "anchor long, content long, kind int, many int, doc_id long, tie long, start long, runs int"
NAMES = [c.split()[0] for c in STRETCH.split(", ")]
TYPES = {"long": pa.int64(), "int": pa.int32()}
SCHEMA = pa.schema([(c.split()[0], TYPES[c.split()[1]]) for c in STRETCH.split(", ")])


class Rule(NamedTuple):
    """``symbols`` gives a slice's symbols and where each row's begin.

    With ``earlier``, a run is repeated if it also starts earlier, by id, then
    position; else if it starts anywhere else. A bucket of anchors is busy from
    ``least`` stretches on if it has more than four times the mean, and an
    anchor is crowded beyond ``crowd`` contents. Neither changes the result.
    """

    symbols: Callable[[arrays.Texts], tuple[np.ndarray, np.ndarray]]
    length: int
    inner: int
    earlier: bool
    least: int = 256
    crowd: int = 1024


def word_symbols(t: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
    w = arrays.words(t)
    return arrays.word_hashes(t.data, w), w.offsets


def byte_symbols(t: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
    return arrays.multipliers(256, 19)[t.data], t.offsets


def ties(t: arrays.Texts) -> np.ndarray:
    """A hash of each row's bytes."""
    sums = np.zeros(t.rows, np.uint64)
    size = np.diff(t.offsets)
    some = np.flatnonzero(size)
    if len(some):
        place = arrays.within(size)
        values = (t.data.astype(np.uint64) + np.uint64(1)) * arrays.multipliers(int(size.max()), 23)[place]
        sums[some] = np.add.reduceat(values, t.offsets[:-1][some])
    return arrays.mix(sums + size.astype(np.uint64)).view(np.int64)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Where in each window the smallest value lies, by its leading 32 bits; the first of ties.

    The place is kept below those bits, so that one minimum finds both.
    """
    low_bits = np.uint64(0xFFFFFFFF)
    low, span = (values & ~low_bits) | np.arange(len(values), dtype=np.uint64), 1
    while span < width:
        step = min(span, width - span)
        low = np.minimum(low[: len(low) - step], low[step:])
        span += step
    return (low & low_bits).astype(np.int64)


def stretches(t: arrays.Texts, rule: Rule, powers: arrays.Powers):
    """Rows of the slice, first runs, numbers of runs, anchors and contents."""
    symbols, offsets = rule.symbols(t)
    if len(symbols) < rule.length:
        return None
    sums, down = powers.sums(symbols)
    hashes = arrays.sum_hashes(sums, down, rule.inner)
    at = smallest(hashes, rule.length - rule.inner + 1)
    # Rows have runs from where they begin up to a window before their end.
    size = np.diff(offsets)
    counts = np.maximum(size - rule.length + 1, 0)
    inside = np.zeros(len(at) + 1, np.int8)
    some = counts > 0
    inside[offsets[:-1][some]] = 1
    np.subtract.at(inside, (offsets[:-1] + counts)[some], 1)
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    new = np.r_[True, at[1:] != at[:-1]]
    new[offsets[:-1][some]] = True
    first = np.flatnonzero(new & inside)
    if not len(first):
        return None
    # A stretch ends where the next one begins or the row has no more runs.
    row = np.searchsorted(offsets, first, "right") - 1
    following = np.r_[first[1:], len(at)]
    runs = np.minimum(following, (offsets[:-1] + counts)[row]) - first
    anchor = hashes[at[first]]
    content = (sums[first + runs - 1 + rule.length] - sums[first]) * down[first]
    content = arrays.mix(content + runs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    content = arrays.mix(content ^ (at[first] - first).astype(np.uint64))
    return row, first - offsets[row], runs, anchor, content


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: columns[n] for n in NAMES}, SCHEMA)


def _settle(c: dict, rule: Rule) -> dict:
    """Rows of one key each, from those sorted by anchor, content and place.

    ``many`` says that a content occurs more than once (or did before). Settled
    rows become spans; of each content one entry is left.
    """
    key = np.stack([c["anchor"], c["content"]], 1)
    new = np.r_[True, (key[1:] != key[:-1]).any(1)]
    group = np.cumsum(new) - 1
    where = np.stack([c["doc_id"], c["tie"], c["start"]], 1)
    # The same place twice is a repeated row; then its other rows tell nothing new.
    fresh = np.r_[True, (where[1:] != where[:-1]).any(1)] | new
    several = np.bincount(group, fresh) + np.bincount(group, c["many"] > 0) > 1
    if not rule.earlier:
        several |= np.bincount(group, minlength=group[-1] + 1) > 1
    span = ~new & fresh if rule.earlier else several[group]
    entry = new
    out = {}
    for name in NAMES:
        values = c[name]
        out[name] = np.r_[values[span], values[entry]]
    # Spans need no meeting place any more, and are dealt out by where they are.
    n = int(span.sum())
    out["anchor"][:n] = arrays.mix((out["tie"][:n] ^ out["start"][:n]).view(np.uint64)).view(np.int64)
    out["kind"] = np.r_[np.full(n, SPAN), c["kind"][entry]].astype(np.int32)
    out["many"] = np.r_[np.zeros(span.sum()), several[group[entry]]].astype(np.int32)
    return out


def _ordered(c: dict) -> dict:
    order = np.lexsort((c["start"], c["tie"], c["doc_id"], c["content"], c["anchor"]))
    return {k: v[order] for k, v in c.items()}


# Sorts before any other id.
NONE = -(2**63)


def _known(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NONE)).alias("doc_id"),
        F.col(text).cast("string").alias("text"),
    )


def _settled(batch: pa.RecordBatch, rule: Rule, powers: arrays.Powers) -> dict | None:
    """Spans and entries of a batch of texts, None if it has no run."""
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    parts = []
    for t in arrays.slices(batch.column("text")):
        got = stretches(t, rule, powers)
        if got is None:
            continue
        row, start, runs, anchor, content = got
        parts.append(
            (anchor.view(np.int64), content.view(np.int64), ids[t.first + row],
             ties(t)[row], start, runs)
        )
    if not parts:
        return None
    a, c, d, s, p, r = (np.concatenate(x) for x in zip(*parts, strict=True))
    columns = {"anchor": a, "content": c, "doc_id": d, "tie": s, "start": p, "runs": r,
               "kind": np.full(len(a), ENTRY, np.int32), "many": np.zeros(len(a), np.int32)}
    return _settle(_ordered(columns), rule)


def _bucket(anchor: np.ndarray) -> np.ndarray:
    # Anchors are the smallest hashes of their windows, so their own bits are uneven.
    return (arrays.mix(anchor.view(np.uint64)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


POWERS_SEED = 29


def busy_buckets(df: DataFrame, rule: Rule, doc_id: str, text: str) -> np.ndarray:
    """Sorted numbers of the busy buckets, counted over all texts.

    A bucket in the list has over four times the mean, so the driver gets fewer
    than a quarter of 2**16 numbers at any size.
    """

    def run(batches):
        powers = arrays.Powers(POWERS_SEED)
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            parts = [stretches(t, rule, powers) for t in arrays.slices(batch.column("text"))]
            parts = [x for x in parts if x is not None]
            if parts:
                anchor, content = (np.concatenate([x[i] for x in parts]) for i in (3, 4))
                # Equal contents of a batch travel as one row.
                _, one = np.unique(anchor ^ arrays.mix(content), return_index=True)
                total += np.bincount(_bucket(anchor[one]), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some.astype(np.int32), "n": total[some]})

    counts = (
        _known(df, doc_id, text).mapInArrow(run, "bucket int, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n"))
    )
    mean = F.sum("n").over(Window.partitionBy()) / (1 << BUCKET_BITS)
    busy = counts.withColumn("mean", mean).where((F.col("n") >= rule.least) & (F.col("n") > 4 * F.col("mean")))
    return np.array(sorted(r.bucket for r in busy.select("bucket").collect()), np.int64)


def entries(df: DataFrame, rule: Rule, doc_id: str, text: str) -> DataFrame:
    busy = busy_buckets(df, rule, doc_id, text)

    def run(batches):
        powers = arrays.Powers(POWERS_SEED)
        for batch in batches:
            c = _settled(batch, rule, powers)
            if c is None:
                continue
            hot = (c["kind"] == ENTRY) & np.isin(_bucket(c["anchor"]), busy)
            both = c["anchor"].view(np.uint64) ^ arrays.mix(c["content"].view(np.uint64))
            c["anchor"] = np.where(hot, arrays.mix(both).view(np.int64), c["anchor"])
            c["kind"] = np.where(hot, CROWDED, c["kind"]).astype(np.int32)
            yield _batch(c)

    return _known(df, doc_id, text).mapInArrow(run, STRETCH)


def matched(rows: DataFrame, rule: Rule) -> DataFrame:
    """Spans, and the entries whose anchor has several contents or is crowded."""

    def run(batches):
        for table in arrays.whole_groups(batches, "anchor"):
            c = {n: table.column(n).to_numpy() for n in NAMES}
            spans = c["kind"] == SPAN
            passed = {n: v[spans] for n, v in c.items()}
            rest = {n: v[~spans] for n, v in c.items()}
            if len(rest["anchor"]):
                one = _settle(_ordered(rest), rule)
                plain = one["kind"] == ENTRY
                place = np.flatnonzero(plain)
                _, inverse, count = np.unique(one["anchor"][plain], return_inverse=True, return_counts=True)
                keep = ~plain
                keep[place[count[inverse] > 1]] = True
                one["kind"][place[count[inverse] > rule.crowd]] = CROWDED
                passed = {n: np.r_[passed[n], one[n][keep]] for n in NAMES}
            yield _batch(passed)

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, STRETCH)


CONTEXT = pa.schema([*SCHEMA, pa.field("symbols", pa.binary())])


def _windows(symbols: np.ndarray, c: dict, at: np.ndarray, rule: Rule, powers: arrays.Powers) -> dict:
    """A row for each run of stretches, under two hashes of its symbols."""
    part = np.repeat(np.arange(len(at)), c["runs"])
    step = arrays.within(c["runs"])
    out = {n: c[n][part] for n in NAMES}
    out["start"], out["runs"] = out["start"] + step, np.ones(len(part), np.int32)
    for name, values in (("anchor", symbols), ("content", arrays.mix(symbols))):
        hashes = arrays.run_hashes(values, rule.length, powers)
        out[name] = hashes[at[part] + step].view(np.int64)
    return out


def fetched(requests: DataFrame, df: DataFrame, rule: Rule, doc_id: str, text: str) -> DataFrame:
    """Entries with the symbols of their stretch; the single runs of crowded ones.

    Equal runs within a batch are settled at once, so that a frequent one gives
    one row a batch.
    """

    def run(batches):
        powers = arrays.Powers(POWERS_SEED)
        for whole in batches:
            for batch in arrays.in_parts(whole, "packed"):
                raw = pa.array(unpacked(batch.column("packed")), pa.large_binary())
                out = {n: [] for n in CONTEXT.names}
                single = []
                for t in arrays.slices(raw.cast(pa.large_string())):
                    symbols, offsets = rule.symbols(t)
                    ties_ = ties(t)
                    crowded = {n: [] for n in [*NAMES, "at"]}
                    for k in range(t.rows):
                        doc = batch.column("doc_id")[t.first + k].as_py()
                        for r in batch.column("wanted")[t.first + k].as_py():
                            if r["tie"] != int(ties_[k]):
                                continue
                            at = int(offsets[k]) + r["start"]
                            row = {**r, "doc_id": doc, "content": 0}
                            if r["kind"] == CROWDED:
                                row["at"], into = at, crowded
                            else:
                                part = symbols[at : at + r["runs"] - 1 + rule.length]
                                row["symbols"], into = part.tobytes(), out
                            for n, values in into.items():
                                values.append(row[n])
                    if crowded["at"]:
                        at = np.array(crowded.pop("at"))
                        c = {n: np.array(v, SCHEMA.field(n).type.to_pandas_dtype()) for n, v in crowded.items()}
                        single.append(_windows(symbols, c, at, rule, powers))
                yield pa.RecordBatch.from_pydict(out, CONTEXT)
                if single:
                    c = {n: np.concatenate([x[n] for x in single]) for n in NAMES}
                    c = _settle(_ordered(c), rule)
                    c["symbols"] = pa.nulls(len(c["anchor"]), pa.binary())
                    yield pa.RecordBatch.from_pydict({n: c[n] for n in CONTEXT.names}, CONTEXT)

    wanted = requests.groupBy("doc_id").agg(
        F.collect_list(F.struct("anchor", "kind", "many", "tie", "start", "runs")).alias("wanted")
    )
    texts = packed_texts(
        df.withColumn("__id", F.coalesce(F.col(doc_id).cast("long"), F.lit(NONE))), "__id", text
    )
    return texts.join(wanted, "doc_id").mapInArrow(run, STRETCH + ", symbols binary")


def refine(block: np.ndarray, symbols: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the blocks of equal runs; a run that differs from all has -1.

    Runs are told apart a symbol at a time, each round only those that still
    share a block, so the number of rounds is the length of their common prefix.
    A round sorts no more than the blocks in which the symbol differs.
    """
    out = np.full(len(at), -1, np.int64)
    _, block, count = np.unique(block, return_inverse=True, return_counts=True)
    live = np.flatnonzero(count[block] > 1)
    live = live[np.argsort(block[live], kind="stable")]
    block = np.unique(block[live], return_inverse=True)[1].ravel()
    for depth in range(length):
        value = symbols[at[live] + depth]
        same = block[1:] == block[:-1]
        differ = same & (value[1:] != value[:-1])
        if not differ.any():
            continue
        mixed = np.zeros(block[-1] + 1, bool)
        mixed[block[1:][differ]] = True
        sub = np.flatnonzero(mixed[block])
        order = sub[np.lexsort((value[sub], block[sub]))]
        live[sub], value[sub] = live[order], value[order]
        new = np.r_[True, ~same | (value[1:] != value[:-1])]
        name = np.cumsum(new) - 1
        shared = np.bincount(name)[name] > 1
        live, name = live[shared], name[shared]
        if not len(live):
            return out
        block = np.cumsum(np.r_[0, name[1:] != name[:-1]])
    out[live] = block
    return out


def _refined(table: pa.Table, rule: Rule) -> dict:
    """Spans of the repeated runs among stretches that share their anchor."""
    place = {n: table.column(n).to_numpy() for n in ("anchor", "doc_id", "tie", "start")}
    # Stretches of one text have no run in common, so their order is that of their runs.
    order = np.lexsort((place["start"], place["tie"], place["doc_id"]))
    place = {n: v[order] for n, v in place.items()}
    column = table.column("symbols").combine_chunks()
    parts = [np.frombuffer(column[int(k)].as_buffer(), np.uint64) for k in order]
    size = np.array([len(x) for x in parts])
    begin = np.cumsum(size) - size
    runs = size - rule.length + 1
    part = np.repeat(np.arange(len(parts)), runs)
    at = begin[part] + arrays.within(runs)
    start = place["start"][part] + arrays.within(runs)
    doc, tie = place["doc_id"][part], place["tie"][part]
    symbols = np.concatenate(parts)
    # Equal runs hold their anchor at the same place.
    hashes = arrays.run_hashes(symbols, rule.inner, arrays.Powers(POWERS_SEED))
    offset = smallest(hashes, rule.length - rule.inner + 1)[at] - at
    group = np.unique(place["anchor"], return_inverse=True)[1].ravel()
    name = refine(group[part] * rule.length + offset, symbols, at, rule.length)
    hit = np.flatnonzero(name >= 0)
    if rule.earlier:
        _, first = np.unique(name[hit], return_index=True)
        hit = np.delete(hit, first)
    return {"doc_id": doc[hit], "tie": tie[hit], "start": start[hit], "runs": np.ones(len(hit), np.int32)}


def resolved(contexts: DataFrame, rule: Rule) -> DataFrame:
    """Spans of the repeated runs among what ``fetched`` gives."""
    where = ["doc_id", "tie", "start", "runs"]
    layout = pa.schema([(n, SCHEMA.field(n).type) for n in where])

    def run(batches):
        for table in arrays.whole_groups(batches, "anchor"):
            kind = table.column("kind").to_numpy()
            spans = table.filter(pa.array(kind == SPAN))
            found = [{n: spans.column(n).to_numpy() for n in where}]
            if (kind == ENTRY).any():
                found.append(_refined(table.filter(pa.array(kind == ENTRY)), rule))
            if (kind == CROWDED).any():
                single = table.filter(pa.array(kind == CROWDED))
                c = _settle(_ordered({n: single.column(n).to_numpy() for n in NAMES}), rule)
                found.append({n: c[n][c["kind"] == SPAN] for n in where})
            yield pa.RecordBatch.from_pydict(
                {n: np.concatenate([x[n] for x in found]) for n in where}, layout
            )

    return (
        contexts.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(run, "doc_id long, tie long, start long, runs int")
    )


def removed(df: DataFrame, rule: Rule, finish, schema: str, doc_id: str, text: str) -> DataFrame:
    """Each row's repeated runs put through ``finish(raw text, mask of symbols)``."""
    found = staged(matched(entries(df, rule, doc_id, text), rule), "stretches")
    contexts = fetched(found.where(F.col("kind") != SPAN), df, rule, doc_id, text)
    where = ["doc_id", "tie", "start", "runs"]
    spans = (
        found.where(F.col("kind") == SPAN)
        .select(*where)
        .union(resolved(contexts, rule))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("tie", "start", "runs")).alias("spans"))
    )

    def run(batches):
        names = [c.split()[0] for c in schema.split(", ")]
        for whole in batches:
            for batch in arrays.in_parts(whole, "packed"):
                raw = unpacked(batch.column("packed"))
                spans, rows = batch.column("spans"), []
                texts = pa.array(raw, pa.large_binary()).cast(pa.large_string())
                for t in arrays.slices(texts):
                    ties_ = ties(t)
                    symbols = rule.symbols(t)[1]
                    for k in range(t.rows):
                        mark = np.zeros(int(symbols[k + 1] - symbols[k]) + 1, np.int32)
                        own = spans[t.first + k].values
                        if own is not None and len(own):
                            s = own.field("start").to_numpy()
                            e = s + own.field("runs").to_numpy() - 1 + rule.length
                            same = own.field("tie").to_numpy() == ties_[k]
                            np.add.at(mark, s[same], 1)
                            np.add.at(mark, e[same], -1)
                        gone = np.cumsum(mark[:-1]) > 0
                        key = batch.column("doc_id")[t.first + k].as_py()
                        rows.append((None if key == NONE else key, *finish(raw[t.first + k], gone)))
                yield pa.RecordBatch.from_pydict(
                    dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))
                )

    texts = packed_texts(
        df.withColumn("__id", F.coalesce(F.col(doc_id).cast("long"), F.lit(NONE))), "__id", text
    )
    return texts.join(spans, "doc_id", "left").mapInArrow(run, schema)


def runs_of(gone: np.ndarray) -> Iterator[tuple[int, int]]:
    """Maximal runs of marked positions."""
    edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
    yield from zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)
