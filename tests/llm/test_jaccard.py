"""The n-gram join against a comparison of all pairs."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import jaccard_join

SCHEMA = "doc_id long, text string, first string, sketch int"


def shingles(text, size):
    words = [bytes(w).lower() for w in (text or "").encode().split()]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(docs, size, percent):
    sets = [shingles(text, size) for _, text, *_ in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = 0
    for i, j in combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and 100 * len(a & b) >= percent * len(a | b):
            parent[root(i)] = root(j)
            links += a != b
    groups = {}
    for i, doc in enumerate(docs):
        groups.setdefault(root(i), []).append(doc[0])
    return {doc[0]: (len(sets[i]), min(groups[root(i)])) for i, doc in enumerate(docs)}, links


def edited(words, n, vocabulary):
    words = list(words)
    for at in random.sample(range(len(words)), n):
        words[at] = random.choice(vocabulary)
    return " ".join(words)


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_links_around_the_threshold_equal_all_pairs(spark, size, percent):
    random.seed(size)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, doc_id = [], 0
    for length in (3, 4, 8, 15, 40, 120, 250):
        for _ in range(3):
            base = [random.choice(vocabulary) for _ in range(length)]
            for _ in range(14):
                # A changed word costs up to size shingles of about length.
                docs.append((doc_id, edited(base, random.randint(0, min(length, 1 + length // 40)), vocabulary), "", 0))
                doc_id += 1
    # A group of near copies, nearly all pairs of it just below the threshold.
    base = [random.choice(vocabulary) for _ in range(250)]
    for _ in range(120):
        docs.append((doc_id, edited(base, 3, vocabulary), "", 0))
        doc_id += 1
    docs += [(doc_id, None, "", 0), (doc_id + 1, " \t", "", 0), (doc_id + 2, "One Two", "", 0), (doc_id + 3, "one two", "", 0)]
    expected, links = brute(docs, size, percent)
    assert links > 200
    table = spark.createDataFrame(docs, SCHEMA).repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_groups(table, size, percent).collect()}
    assert got == expected


def test_a_group_around_the_threshold_is_linked_in_few_pairs(spark, monkeypatch):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [random.choice(vocabulary) for _ in range(200)]
    docs = [(0, " ".join(base), "", 0)]
    for doc_id in range(1, 300):
        # Each is a copy of some earlier one with a word changed, so many pairs differ too much.
        words = random.choice(docs)[1].split()
        docs.append((doc_id, edited(words, 1, vocabulary), "", 0))
    expected, links = brute(docs, 4, 85)
    counted, verify = [], jaccard_join.linked

    def linked(pairs, *rest):
        counted.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(jaccard_join, "linked", linked)
    table = spark.createDataFrame(docs, SCHEMA).repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_groups(table).collect()}
    assert got == expected
    assert links > 2_000
    assert sum(counted) < 3 * len(docs), counted


@pytest.mark.parametrize("rows", [33, 2048, 2049, 5000])
def test_trees_join_all_rows_that_are_alike(rows):
    # Rows are alike if near each other, or if one of them is among the first.
    pairs = list(jaccard_join._trees(np.arange(rows), lambda a, b: np.minimum(abs(a - b), np.minimum(a, b)) // 40 - 2 * (b % 2)))
    a, b = (np.concatenate(side) for side in zip(*pairs, strict=True))
    assert len(a) < rows + 16 * len(pairs)
    reached = {0}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        assert x in reached
        reached.add(y)
    assert reached >= set(range(1, rows, 2))


def test_counts_of_a_pair_are_added_up_over_batches(monkeypatch):
    monkeypatch.setattr(jaccard_join, "HELD", 4)
    names = ["a", "b", "overlap", "need"]
    batch = pa.RecordBatch.from_pydict(dict(zip(names, ([b"x", b"y"], [b"z", b"z"], [1, 2], [3, 1]), strict=True)))
    none = batch.slice(0, 0)
    tables = [pa.Table.from_batches([b]) for b in jaccard_join._added_up([none, batch, batch, none, batch])]
    assert [sorted(tuple(r.values()) for r in t.to_pylist()) for t in tables] == [
        [(b"x", b"z", 2, 3), (b"y", b"z", 4, 1)], [(b"x", b"z", 1, 3), (b"y", b"z", 2, 1)]
    ]
    assert list(jaccard_join._added_up([none])) == []
