"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from ledgerline.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int"


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(docs):
    found = Counter()
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def brute(words, lead=10):
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if is_near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= lead * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def planted():
    random.seed(12)
    docs, doc_id = [], 0
    base = ["".join(random.choice("abcé") for _ in range(random.randint(6, 11))) for _ in range(25)]
    for word in base:
        for variant in {word, word + "s", word[:3] + word[4:], word[:2] + "Z" + word[3:], word[0] + word}:
            times = random.choice([1, 2, 3, 25, 26, 260])
            for _ in range(times // 20 + 1):
                docs.append((doc_id, " ".join([variant] * min(20, times)), "clash", doc_id))
                doc_id += 1
    for word, times in (("chainabcd", 3), ("chainabce", 60), ("chainabde", 700), ("chainbbde", 8000)):
        docs += [(doc_id + i, f"{word}\n" * (times // 2), "", 0) for i in range(2)]
        doc_id += 2
    docs += [(None, "nowhere nowherE nowhere-nowhera×x ", "", 0), (None, None, "", 0), (7, "", "", 0)]
    docs += [(9, "12 Ärgerlich Ärgerlich ärgerlich ärgerlich", "", 0)] * 2
    docs.append((10, "q" * 5000 + " " + "q" * 5000 + " " + ("q" * 4999 + " ") * 2 + "wörter, " * 200_000, "", 0))
    return docs


@pytest.mark.parametrize("most", [2, spelling.GROUP])
def test_variants_equal_a_comparison_of_all(spark, most):
    docs = planted()
    table = spark.createDataFrame(docs, SCHEMA).repartition(3)
    got = [tuple(r) for r in spelling.variants(table, most=most).collect()]
    expected = brute(counted(docs))
    assert len(got) == len(expected) and set(got) == expected
    assert any(r[1] and r[2] != r[1] for r in expected), "some form has a form"


def test_pairs_of_one_state_are_found_once():
    random.seed(3)
    for _ in range(150):
        words = {"".join(random.choice("ab") for _ in range(random.randint(4, 5))) for _ in range(20)}
        inner = sorted(w + (spelling.LONG if len(w) == 5 else spelling.SHORT) for w in words)
        found = Counter()
        for begun, left, right in spelling.near_pairs(inner, ""):
            for s in begun:
                for x, y in zip(left, right):
                    found[frozenset((inner[s + x][:-1], inner[s + y][:-1]))] += 1
        pairs = {frozenset(p) for p in combinations(words, 2) if is_near(*p) and max(map(len, p)) == 5}
        assert set(found) == pairs and set(found.values()) <= {1}


def test_the_acceptor_is_minimal_and_numbers_its_words():
    strings = sorted(f"{a}{b}end" for a in "abc" for b in "xyz")
    machine = spelling.Acceptor(strings)
    assert len(machine.edges) == 6
    for number, string in enumerate(strings):
        state, at = machine.start, 0
        for symbol in string:
            state, offset = machine.edges[state][symbol]
            at += offset
        assert at == number


def test_many_words_of_one_state_are_divided(spark):
    """A third of all words share their first half; no state keeps more than the bound."""
    words = [(f"commonbeginning{a}{b}{c}", 3) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    words += [(f"{a}{b}{c}{d}rarely", 3) for a in "stuvw" for b in "abcdef" for c in "stuvw" for d in "abcdefg"]
    table = spark.createDataFrame(words, "word string, n long")
    states = spelling.by_initial_state(table, 64).groupBy(*spelling.STATE).count()
    crowded = states.where("count > 64 and lo < hi").count()
    assert crowded == 0 and states.count() > 100
    got = {r.word: r.n_near for r in spelling.near_words(table, 64).collect()}
    by_word = dict(words)
    assert got["commonbeginningaaa"] == 21
    assert got == {w: sum(is_near(w, x) for x in by_word if abs(len(w) - len(x)) < 2) for w in by_word}


def test_no_documents(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.variants(empty).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "a b", "", 0), (2, None, "", 0)], SCHEMA)).count() == 0
