"""Similarity join on word shingles, as a blocked sparse product.

The incidence matrix has a row per distinct shingle set and a column per
shingle. Only the part that linked pairs must share is multiplied: of a set of n
shingles, ordered from rare to common, a pair at the threshold t shares at least
s of the first n - ceil(t n) + s, here with s growing with n. Columns are
dealt to blocks by hash. Blocks count the columns that two rows share, the
counts of a pair are added up over blocks, and pairs below s go. So do pairs
whose sizes are too far apart, or whose parity sketches differ in more bits than
a linked pair may have shingles that only one set has. What is left is
counted on whole texts.

Groups of near copies would give the square of their size in pairs. So a first
round pairs each row of a column with the first and the next one, and in large columns
along a tree of least differences, in the first few columns of each row by hash, and
the second one takes every pair of rows that the
first has not put into one component already. Components are the same as with all
pairs. In the second round a pair meets in each column that it shares. Rows carry
their first columns, and a pair whose lists have one in common leaves its block
only there, at the first such column.

Sets are held as 64-bit shingle hashes.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import arrays
from ledgerline.llm.common import packed_texts, staged, unpacked
from ledgerline.llm.components import components

SHINGLE = 4
PERCENT = 85
# The order of shingles: frequencies in this many buckets of hashes, so that
# what every task needs to know of the corpus has a fixed size.
BUCKETS = 1 << 16
SKETCH_WORDS = 16  # of 64 bits
HALF = 32 * SKETCH_WORDS
# First columns of a row, by hash, that all its entries carry.
FIRST = 4
# Sketches of unlike sets differ in half their bits. Linked sets that may differ in
# nearly as many shingles are told apart by counting the columns that they share.
SHOWN = 30 * SKETCH_WORDS
# Columns with this many rows or fewer are paired together, so many pairs in one numpy call.
SMALL = 32
PAIRS = 1 << 17
# Rows of a larger column that one tree spans, and those of them that all its trees share.
TREE = 2048
HUBS = 16


# Bytes of packed texts that are counted at once.
PACKED = 1 << 20
# Rows of pairs that a task holds to add up their counts.
HELD = 1 << 18


def spare(n):
    """How many of the first shingles of a set of n a linked pair must share.

    The part of a set that is multiplied is longer by this, less one.
    """
    return 1 + n // 20



def _sets(batch, size: int):
    """Text slice by slice: the index of the row and its shingle set."""

    for part in arrays.slices(batch.column("text")):
        for k, shingles in enumerate(arrays.shingle_sets(part, size)):
            yield part.first + k, shingles


def _name(shingles) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(shingles) -> np.ndarray:
    bits = np.bincount((shingles & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64),
                       minlength=64 * SKETCH_WORDS)
    return np.packbits((bits & 1).astype(np.uint8)).view(np.uint64)


def _prefix(shingles, level, percent: int):
    """The columns of a set that are multiplied, from rare to common."""
    k = len(shingles) - -(-percent * len(shingles) // 100) + spare(len(shingles))
    rank = level[(shingles >> np.uint64(48)).astype(np.int64)]
    return shingles[np.argsort(rank, kind="stable")[:k]]


def _lists(arrays_of: list[np.ndarray]) -> pa.ListArray:
    """64-bit values as one Arrow list a row."""
    ends = np.cumsum([0, *map(len, arrays_of)]).astype(np.int32)
    values = np.concatenate([np.empty(0, np.uint64), *arrays_of])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def shingle_classes(
    df: DataFrame, levels: list[int], doc_id: str, text: str, size: int, percent: int
) -> DataFrame:
    """doc_id, n_shingles, class (a name of the set; null if empty), its sketch, the
    columns that are multiplied and the first of them, in order of hash."""

    def run(batches):
        level = np.asarray(levels, np.int16)
        for batch in batches:
            counts, names, sketches, firsts, columns = [], [], [], [], []
            for _, shingles in _sets(batch, size):
                counts.append(len(shingles))
                names.append(_name(shingles) if len(shingles) else None)
                sketches.append(_sketch(shingles))
                chosen = _prefix(shingles, level, percent) if len(shingles) else shingles
                # A short list repeats its last column, which changes no comparison.
                first = np.sort(chosen)[:FIRST]
                first = np.pad(first, (0, FIRST - len(first)), "edge") if len(first) else np.zeros(FIRST, np.uint64)
                firsts.append(first)
                columns.append(chosen)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(names, pa.binary()),
                    _lists(sketches),
                    _lists(firsts),
                    _lists(columns),
                ],
                ["doc_id", "n_shingles", "class", "sketch", "first", "columns"],
            )

    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_shingles long, class binary, sketch array<long>, first array<long>, "
        "columns array<long>",
    )


def commonness(df: DataFrame, text: str, size: int) -> list[int]:
    """For each bucket of shingle hashes, how far above the usual its count is.

    In half powers of two; at most ``BUCKETS`` numbers reach the driver.
    """

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in arrays.slices(batch.column("text")):
                shingles = np.concatenate(list(arrays.shingle_sets(part, size)))
                total += np.bincount((shingles >> np.uint64(48)).astype(np.int64),
                                     minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"]
        )


    counts = (
        df.select(F.col(text).cast("string").alias("text"))
        .mapInArrow(run, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    total = np.zeros(BUCKETS)
    total[counts["bucket"].to_numpy(int)] = counts["n"]
    usual = max(1.0, float(np.median(total)))
    return np.maximum(0, np.round(2 * np.log2(np.maximum(total, 1) / usual))).astype(int).tolist()


def incidence(docs: DataFrame) -> DataFrame:
    """The part of the matrix that is multiplied: shingle, class and n."""
    return docs.where("class is not null").select(
        F.explode("columns").alias("shingle"), "class", F.col("n_shingles").cast("int").alias("n")
    )


def shared_columns(entries: DataFrame) -> DataFrame:
    """Entries of shingles that more than one class has, one per class."""

    def run(batches):


        for table in arrays.whole_groups(batches, "shingle"):
            start, count = arrays.group_bounds(table.column("shingle").to_numpy())
            names = table.column("class").combine_chunks()
            # Sorted by class too: a copy has the name of its neighbour.
            fresh = np.r_[True, pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)]
            fresh[start] = True
            group = np.repeat(np.arange(len(start)), count)
            many = np.bincount(group[fresh], minlength=len(start)) > 1
            yield from table.filter(fresh & many[group]).to_batches()

    return (
        entries.repartition("shingle")
        .sortWithinPartitions("shingle", "class")
        .mapInArrow(run, entries.schema)
    )


def _grid(start, count, most: int):
    """All pairs of rows of the groups with at most ``most`` rows, in batches."""
    for size in np.unique(count[(count > 1) & (count <= most)]):
        i, j = np.triu_indices(size, 1)
        heads = start[count == size]
        step = max(1, PAIRS // len(i))
        for k in range(0, len(heads), step):
            rows = heads[k : k + step, None]
            yield (rows + i).ravel(), (rows + j).ravel()


def _stars(start, count):
    """The first row of each group with all others, and each row with the next."""
    many = count > 1
    start, count = start[many], count[many]
    rest = np.repeat(start, count - 1)
    rows = rest + 1 + arrays.within(count - 1)
    yield rest, rows
    yield rows[rows - 1 > rest] - 1, rows[rows - 1 > rest]


def _trees(rows, excess):
    """Pairs that make the likeliest links reach as many rows of a large column as they can.

    Each tree takes up the row that differs least from one it has, so that rows that
    only a chain of near copies joins are in one component after this.
    """
    for k in range(0, len(rows), TREE):
        part = rows[k : k + TREE] if not k else np.r_[rows[:HUBS], rows[k : k + TREE]]
        last, left = part[0], part[1:].copy()
        near, least = np.full(len(left), last), np.full(len(left), 1 << 20)
        a, b = [], []
        while len(left):
            found = excess(last, left)
            near[found < least] = last
            np.minimum(least, found, out=least)
            best = int(least.argmin())
            last = left[best]
            if least[best] <= 0:
                a.append(near[best])
                b.append(last)
            for x in (left, near, least):
                x[best] = x[-1]
            left, near, least = left[:-1], near[:-1], least[:-1]
        yield np.asarray(a, np.int64), np.asarray(b, np.int64)


def _ranked(values) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in order, and the place of each row's value among them."""
    coded = values.combine_chunks().dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), place[coded.indices.to_numpy()]


def _across(rows, component):
    """Every pair of rows of different components."""
    own = component[rows]
    # The largest component's rows need no partners among themselves.
    big = np.bincount(own).argmax()
    others, most = rows[own != big], rows[own == big]
    for i, row in enumerate(others):
        partners = np.concatenate([most, others[i + 1 :]])
        yield np.full(len(partners), row), partners


def pairs_in_columns(columns: DataFrame, percent: int, first_only: bool) -> DataFrame:
    """Candidate pairs ``a, b`` of classes of different components.

    Rows of ``columns``: shingle, class, n, sketch, first, component. With
    ``first_only``, a row is paired only in its first columns, with the first row
    there and the next, in a large column along a tree of the likeliest links too; that
    finds most links, in a few pairs a row. Else all rows of a column are paired. Columns
    that a pair shares are counted for sets so large that their sketches say little; any other pair
    leaves at one of its columns if the lists of first columns tell which is first,
    so that hardly any is written twice.
    """

    def run(batches):
        yield from _added_up(found(batches))

    def found(batches):
        for table in arrays.whole_groups(batches, "shingle"):
            n = table.column("n").to_numpy().astype(np.int64)
            shingle = table.column("shingle").to_numpy().view(np.uint64)
            flat = table.column("sketch").combine_chunks().flatten().to_numpy()
            sketch = flat.view(np.uint64).reshape(-1, SKETCH_WORDS)
            flat = table.column("first").combine_chunks().flatten().to_numpy()
            firsts = flat.view(np.uint64).reshape(-1, FIRST)
            ids, name = _ranked(table.column("class"))
            _, component = _ranked(table.column("component"))

            def excess(a, b):
                """Above 0 for a pair that differs in more bits than linked ones do as a rule."""
                sizes = n[a] + n[b]
                need = -(-percent * sizes // (100 + percent))
                differ = np.bitwise_count(sketch[a] ^ sketch[b]).sum(-1, dtype=np.int64)
                # Many differing shingles meet in a bit, so that sketches of large sets differ less.
                usual = HALF * (1 - np.exp((2 * need - sizes) / HALF)) + 3 * np.sqrt(HALF / 2)
                return np.where(np.minimum(n[a], n[b]) >= need, differ - usual.astype(np.int64), 1 << 20)

            def allowed(a, b):
                """The pairs that may be linked and that are to leave here."""
                sizes = n[a] + n[b]
                need = -(-percent * sizes // (100 + percent))
                ok = np.flatnonzero((component[a] != component[b]) & (np.minimum(n[a], n[b]) >= need))
                if not first_only:
                    counted = sizes[ok] - 2 * need[ok] > SHOWN
                    here = _leaves_here(firsts[a[ok]], firsts[b[ok]], shingle[a[ok]])
                    ok = ok[here | counted]
                differ = np.bitwise_count(sketch[a[ok]] ^ sketch[b[ok]]).sum(-1, dtype=np.int64)
                return ok[differ <= sizes[ok] - 2 * need[ok]]

            start, count = arrays.group_bounds(table.column("shingle").to_numpy())
            if first_only:
                tried = [_stars(start, count)]
                for first, size in zip(start[count > SMALL], count[count > SMALL], strict=True):
                    tried.append(_trees(np.arange(first, first + size), excess))
            else:
                tried = [_grid(start, count, SMALL)]
                for first, size in zip(start[count > SMALL], count[count > SMALL], strict=True):
                    tried.append(_across(np.arange(first, first + size), component))
            codes, needs = [np.empty((0, 2), np.int64)], [np.empty(0, np.int64)]
            for a, b in (pair for pairs in tried for pair in pairs):
                ok = allowed(a, b)
                codes.append(np.sort(np.stack([name[a[ok]], name[b[ok]]], 1), 1))
                a, b = a[ok], b[ok]
                shared = spare(np.minimum(n[a], n[b]))
                sizes = n[a] + n[b]
                counted = sizes - 2 * -(-percent * sizes // (100 + percent)) > SHOWN
                needs.append(np.where(counted & (not first_only), shared, 1))
            pairs, place, overlap = np.unique(
                np.concatenate(codes), axis=0, return_index=True, return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(pairs[:, 0])),
                    ids.take(pa.array(pairs[:, 1])),
                    pa.array(overlap.astype(np.int64)),
                    pa.array(np.concatenate(needs)[place]),
                ],
                ["a", "b", "overlap", "need"],
            )

    if first_only:
        columns = columns.where(F.array_contains("first", F.col("shingle")))
    parts = (
        columns.repartition("shingle")
        .sortWithinPartitions("shingle", "class")
        .select("shingle", "class", "n", "sketch", "first", "component")
        .mapInArrow(run, "a binary, b binary, overlap long, need long")
    )
    counted = parts.groupBy("a", "b").agg(
        F.sum("overlap").alias("overlap"), F.min("need").alias("need")
    )
    return counted.where(F.col("overlap") >= F.col("need")).select("a", "b")


def _added_up(batches):
    """Batches of pairs with the counts of a pair added up, over ``HELD`` rows or more."""
    held, rows = [], 0

    def added():
        table = pa.Table.from_batches(held).group_by(["a", "b"])
        table = table.aggregate([("overlap", "sum"), ("need", "min")])
        return table.rename_columns(["a", "b", "overlap", "need"]).combine_chunks().to_batches()

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD:
            yield from added()
            held, rows = [], 0
    if rows:
        yield from added()


def _leaves_here(left, right, shingle):
    """Whether a pair of rows that meet at a column is to leave there.

    ``left`` and ``right`` are their first columns. If these have one in common, the
    smallest such one is the first column of all that the rows share, as a smaller
    one would be in both lists too. Else any column may be, and the pair leaves.
    """
    common = (left[:, :, None] == right[:, None, :]).any(-1)
    least = np.where(common, left, np.iinfo(np.uint64).max).min(-1)
    return ~common.any(-1) | (least == shingle)


def linked(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The candidate pairs at the threshold or above, counted on whole texts."""

    def run(batches):


        for whole in batches:
            for batch in arrays.in_parts(whole, "right", PACKED):
                sides = []
                for side in ("left", "right"):
                    column = pa.array(unpacked(batch.column(side)), pa.large_binary())
                    sides.append(
                        [s for t in arrays.slices(column.cast(pa.large_string()))
                         for s in arrays.shingle_sets(t, size)]
                    )
                keep = []
                for x, y in zip(*sides, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = texts.select(F.col("class").alias("a"), F.col("packed").alias("left"))
    right = texts.select(F.col("class").alias("b"), F.col("packed").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        run, "a binary, b binary"
    )


def near_groups(
    df: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Texts link when the Jaccard index of their distinct shingles of ``size``
    lowered words is ``percent`` in a hundred or more; ``component_id`` is the
    smallest doc_id that links reach. A text with fewer words is one shingle.
    Texts without words, null ones included, have an empty set and are linked
    with nothing, so that their component is their own id. Repeated rows share
    a component and are each returned. Rows with a null id link, but give a
    component no name. Other columns are not read; an empty table gives no rows.
    """
    levels = commonness(df, text, size)
    docs = staged(shingle_classes(df, levels, doc_id, text, size, percent), "shingle-classes")
    classes = staged(
        docs.where("class is not null")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("id"),
            F.first("sketch").alias("sketch"),
            F.first("first").alias("first"),
        ),
        "classes",
    )
    columns = staged(shared_columns(incidence(docs)), "columns")
    wanted = columns.select("class").distinct().join(classes, "class")
    texts = staged(_texts_of(df, wanted, doc_id, text, size), "texts")

    rows = columns.join(classes.select("class", "sketch", "first"), "class")
    alone = rows.withColumn("component", F.col("class"))
    tried = staged(pairs_in_columns(alone, percent, first_only=True), "pairs")
    links = staged(linked(tried, texts, size, percent), "links")
    labels = components(links)
    placed = rows.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    more = pairs_in_columns(placed, percent, first_only=False).join(
        tried.select("a", "b"), ["a", "b"], "left_anti"
    )
    links = links.union(staged(linked(more, texts, size, percent), "links"))
    labels = components(links)
    named = (
        classes.join(labels.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
        .select("class", "component", "id")
    )
    names = named.groupBy("component").agg(F.min("id").alias("component_id"))
    by_class = named.join(names, "component").select("class", "component_id")
    return docs.join(by_class, "class", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("class").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def _texts_of(df: DataFrame, classes: DataFrame, doc_id: str, text: str, size: int):
    """class, packed text of one row of each class."""

    def run(batches):


        for whole in batches:
            for batch in arrays.in_parts(whole, "packed"):
                column = pa.array(unpacked(batch.column("packed")), pa.large_binary())
                names = [
                    _name(s)
                    for t in arrays.slices(column.cast(pa.large_string()))
                    for s in arrays.shingle_sets(t, size)
                ]
                # Rows that share an id may have other texts.
                same = [a == b.as_py() for a, b in zip(names, batch.column("class"), strict=True)]
                yield batch.filter(pa.array(same, pa.bool_()))

    ids = classes.select(F.col("id").alias("__id"), "class")
    packed = packed_texts(df, doc_id, text)
    rows = packed.join(ids, packed["doc_id"].eqNullSafe(ids["__id"])).select("class", "packed")
    return rows.mapInArrow(run, "class binary, packed binary").dropDuplicates(["class"])


def one_of_each(df: DataFrame, size: int, percent: int, doc_id: str = "doc_id",
                text: str = "text") -> DataFrame:
    """The rows, all columns kept, whose id names their component.

    Of rows that share that id, those stay that are no copies of each other;
    rows with a null id stay.
    """
    named = near_groups(df, size, percent, doc_id, text)
    leaders = named.where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    nulls = df.where(F.col(doc_id).isNull())
    return df.join(leaders, df[doc_id] == leaders["__id"], "left_semi").unionByName(nulls)
