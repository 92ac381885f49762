"""Packing: exact ids, whole sequences, little padding."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing

PATH = public_tokenizers.path(packing.TOKENIZER)
SCHEMA = "doc_id long, text string, length string, task int"
WORDS = [
    "Plain", "ÉTÉ", "naïve", "l'été", "it's", "IT'LL", "don't.", "word***", "...", "12345", "a1b2", "İstanbul", "H̱",
    "éclair", "ſ", "ẞ", "中文字", "🙂🙂", "x y", "a b", "\x1c", "\x01", "Ω≈ç", "<|endoftext|>", "…***", "é…!", "'s", "µm", "ÀÉÿß", "K", "ȩ́!", "co-op", "ͅ", "Σας",
]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_equal_the_tokenizer(tokenizer):
    random.seed(4)
    coder = packing.Coder(PATH)
    for _ in range(300):
        text = "".join(random.choice(WORDS) + random.choice([" ", "  ", "\n", "\t", "", "", "."]) for _ in range(30))
        got = np.frombuffer(coder.ids(text.encode()), "<u4").tolist()
        assert [*got, 2] == ids_of(tokenizer, text), text


def test_ids_equal_the_tokenizer_on_documents(spark, small, tokenizer):
    coder = packing.Coder(PATH)
    for row in spark.read.parquet(f"{small}/documents.parquet").collect():
        got = np.frombuffer(coder.ids((row.text or "").encode()), "<u4").tolist()
        assert [*got, 2] == ids_of(tokenizer, row.text)


def test_a_full_memory_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    coder = packing.Coder(PATH)
    text = " ".join(WORDS * 3)
    assert [*np.frombuffer(coder.ids(text.encode()), "<u4").tolist(), 2] == ids_of(tokenizer, text)
    assert len(coder) <= 3


def one_by_one(histogram, width):
    """Shortest-pack-first with every pack by itself; the padding left in each."""
    space = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = max(range(len(space)), key=space.__getitem__, default=None)
            if fits is None or space[fits] < length:
                space.append(width)
                fits = len(space) - 1
            space[fits] -= length
    return sorted(space)


def test_patterns_equal_packs_one_by_one():
    random.seed(9)
    for _ in range(200):
        width = random.choice([8, 16, 50])
        histogram = Counter(random.randint(1, width) for _ in range(random.randint(0, 80)))
        found = packing.patterns(histogram, width)
        spaces = [width - sum(a * b for a, b in p.content) for p in found for _ in range(p.count)]
        assert sorted(spaces) == one_by_one(histogram, width)
        held = Counter()
        for p in found:
            for length, times in p.content:
                held[length] += times * p.count
        assert held == histogram


def test_work_depends_on_lengths_not_on_counts():
    many = {length: 10**12 + length for length in range(1, 4097)}
    found = packing.patterns(many, 4096)
    assert len(found) <= 3 * 4096
    assert sum(p.count * sum(a * b for a, b in p.content) for p in found) == sum(a * b for a, b in many.items())


def checked(rows, texts, tokenizer, width):
    """Each id in one piece, each sequence gapless and numbered; the padding."""
    ids = {k: ids_of(tokenizer, t) for k, t in texts.items()}
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        whole = ids[r.doc_id]
        part = np.array(whole[r.start : r.start + r.length], "<u4").tobytes()
        assert (zlib.crc32(part), len(whole)) == (r.ids_crc32, r.doc_tokens)
        covered[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, whole in ids.items():
        assert sum(n for _, n in covered[doc_id]) == len(whole)
    assert sorted(sequences) == list(range(len(sequences)))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= width
        padding += width - at if at & (at - 1) else 0
    return padding


def test_documents_are_packed(spark, small, tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(5)
    rows = packing.packed(docs, PATH).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    padding = checked(rows, texts, tokenizer, 4096)
    # What can't be filled is about the last sequence.
    assert padding < 0.005 * sum(r.length for r in rows) + 4096


def test_nulls_repeats_and_long_texts(spark, tokenizer):
    docs = [(1, None, "", 0), (2, "", "", 0), (3, "word " * 300_000, "x", 1), (None, "no id", "", 0), (5, "twice", "", 0), (5, "twice", "", 0)]
    rows = packing.packed(spark.createDataFrame(docs, SCHEMA), PATH, width=1000).collect()
    texts = {d[0]: d[1] for d in docs}
    again = [r for r in rows if r.doc_id == 5]
    assert len(again) == 2 and (again[0].sequence_id, again[0].offset) != (again[1].sequence_id, again[1].offset)
    ids = {k: ids_of(tokenizer, t) for k, t in texts.items()}
    assert [r.length for r in rows if r.doc_id in (1, 2)] == [1, 1]
    assert sum(r.length for r in rows if r.doc_id == 3) == len(ids[3]) > 300_000
    assert packing.packed(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_sequences_hold_the_pieces(spark, small, tokenizer):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 60")
    texts = {r.doc_id: r.text for r in docs.collect()}
    width = 512
    found = {r.sequence_id: r for r in packing.sequences(docs, PATH, width, pad=7).collect()}
    places = packing.packed(docs, PATH, width).collect()
    for p in places:
        whole = ids_of(tokenizer, texts[p.doc_id])
        assert found[p.sequence_id].ids[p.offset : p.offset + p.length] == whole[p.start : p.start + p.length]
    for r in found.values():
        assert len(r.ids) == (r.n_ids if r.n_ids & (r.n_ids - 1) == 0 else width)
        assert set(r.ids[r.n_ids :]) <= {7}


def test_all_of_one_length(spark):
    """A hot length is numbered by task, not gathered; equal rests share sequences."""
    docs = spark.createDataFrame([(i, "one two three", "", 0) for i in range(3000)], SCHEMA).repartition(7)
    rows = packing.packed(docs, PATH, width=64).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3000
    assert len({r.sequence_id for r in rows}) == 3000 // 16 + 1
