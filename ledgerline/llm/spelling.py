"""Spelling variants: words that differ by one code point, led to their common form.

Near words are the pairs accepted by a composition of three machines: the minimal
acceptor of the vocabulary, a transducer that inserts, deletes or replaces one code
point, and the acceptor again. The composition is never built whole. A pair of
near words, the longer of m code points, has its edit at one place p, the length of
its longest common beginning; the m - 1 - p code points after it agree again. Pairs
are therefore divided by m and a range of p: all words with some first ``lo`` and last
``m - 1 - hi`` code points share an initial state, that of having read these ends,
and the composed machine started there accepts each pair with p from ``lo`` to
``hi`` once and no other. Initial states are counted in Spark; one with many words is
divided by halving its range, which reads further into its words, until it has few.
A range of one place has at most a word per letter, so that always ends.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, staged

SHORTEST = 7
LEAST_COUNT = 2
# A form is at least so many times as frequent.
LEAD = 10
# One run in so many loses a code point.
DAMAGE = 31
# Words of one initial state that a task takes at once.
GROUP = 4096
# Pairs from which numpy is quicker than a loop.
MANY = 256
LONG, SHORT = "\x01", "\x02"
STATE = ["m", "lo", "hi", "ends"]


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST_COUNT) -> DataFrame:
    """word and n, its occurrences, over whole texts.

    Words are maximal runs of Latin letters, A-Z lower-cased. A run whose crc32
    after ``doc_id:`` is a multiple of 31 first loses the code point at that number
    modulo its length. A null text has no words, a null doc_id reads as empty.
    """
    # Shorter runs can't become words, and a run matches from its start or not at all.
    runs = F.explode(F.regexp_extract_all("text", F.lit(rf"[A-Za-zÀ-ÿ]{{{shortest},}}"), F.lit(0)))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    lowered = found.select("id", ascii_lower(F.col("run")).alias("run"))
    hashed = lowered.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + 2))
    words = hashed.select(F.when(F.col("h") % DAMAGE == 0, damaged).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least)


def _ends(word, lo, after):
    """First ``lo`` and last ``after`` code points, the state that they lead to."""
    return F.concat(F.substring(word, F.lit(1), lo), F.substr(word, F.char_length(word) - after + 1))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row in the two halves of its range of edit places."""
    middle = ((F.col("lo") + F.col("hi") + 1) / 2).cast("int")
    ranges = F.array(
        F.struct(middle.alias("lo"), F.col("hi").alias("hi")),
        F.struct(F.col("lo").alias("lo"), (middle - 1).alias("hi")),
    )
    halved = rows.select("word", "n", "m", F.explode(ranges).alias("range"))
    halved = halved.select("word", "n", "m", "range.lo", "range.hi")
    ends = _ends(F.col("word"), F.col("lo"), F.col("m") - 1 - F.col("hi"))
    return halved.select(*STATE[:3], ends.alias("ends"), "word", "n")


def by_initial_state(words: DataFrame, most: int = GROUP) -> DataFrame:
    """Words under each initial state they share in, at most ``most`` a state.

    Written once for each round of halving; states of one place are left as they
    are, however small ``most`` is.
    """
    length = F.char_length("word")
    whole = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("m"))
    whole = whole.select("word", "n", "m", F.lit(0).alias("lo"), (F.col("m") - 1).alias("hi"))
    rows = staged(_halves(whole), "spelling-states")
    while True:
        crowded = rows.where("lo < hi").groupBy(*STATE).agg(F.count("*").alias("words"))
        crowded = staged(crowded.where(F.col("words") > most).drop("words"), "spelling-crowded")
        if crowded.isEmpty():
            return rows
        divided = _halves(rows.join(crowded, STATE, "left_semi"))
        rows = staged(rows.join(crowded, STATE, "left_anti").unionByName(divided), "spelling-states")


class Acceptor:
    """The minimal acceptor of sorted, distinct strings; it also numbers them.

    ``edges[state]`` maps a symbol to (state, offset), where offset is the number
    of strings accepted from the first state that come before those by this edge.
    """

    def __init__(self, strings: list[str]):
        self.edges: list[dict[str, tuple[int, int]]] = []
        self.size: list[int] = []
        self.known: dict[tuple, int] = {}
        path: list[list[tuple[str, int]]] = [[]]
        last = ""
        for string in strings:
            shared = 0
            for x, y in zip(last, string):
                if x != y:
                    break
                shared += 1
            self._close(path, last, shared)
            path.extend([] for _ in range(len(string) - shared))
            last = string
        self._close(path, last, 0)
        self.start = self._state(path[0])

    def _close(self, path: list, string: str, depth: int) -> None:
        while len(path) > depth + 1:
            state = self._state(path.pop())
            path[-1].append((string[len(path) - 1], state))

    def _state(self, edges: list[tuple[str, int]]) -> int:
        key = tuple(edges)
        state = self.known.get(key)
        if state is None:
            state = self.known[key] = len(self.edges)
            numbered, size = {}, 0
            for symbol, after in edges:
                numbered[symbol] = (after, size)
                size += self.size[after]
            self.edges.append(numbered)
            self.size.append(size or 1)
        return state


def near_pairs(strings: list[str], after: str) -> list[tuple[list[int], list[int], list[int]]]:
    """Pairs accepted by acceptor, one-edit transducer and acceptor.

    ``strings`` are sorted and end in LONG or SHORT; the long ones have one symbol
    more. Replacements are sought among the long ones, insertions from short to
    long. ``after`` is the symbol that follows all strings, or none: a symbol
    inserted before an equal one would have its place further on. The result is in
    parts: (starts, left, right) stands for the pairs of numbers start + left[i],
    start + right[i] of every start and i.
    """
    machine = Acceptor(strings)
    edges = machine.edges
    longs: dict[int, list[int]] = {}

    def long_ones(state: int) -> list[int]:
        if state not in longs:
            found, stack = [], [(state, 0)]
            while stack:
                at, offset = stack.pop()
                for symbol, (to, more) in edges[at].items():
                    if symbol == LONG:
                        found.append(offset + more)
                    elif symbol != SHORT:
                        stack.append((to, offset + more))
            longs[state] = found
        return longs[state]

    starts: list[list[int]] = [[] for _ in edges]
    starts[machine.start] = [0]
    parts = []
    # States are numbered after those they lead to.
    for state in range(machine.start, -1, -1):
        here = edges[state]
        begun = starts[state]
        if not begun or not here:
            continue
        left: list[int] = []
        right: list[int] = []
        out = [(s, to, offset) for s, (to, offset) in here.items() if s not in (LONG, SHORT)]
        for i, (symbol, to, offset) in enumerate(out):
            starts[to].extend([b + offset for b in begun])
            # The edit replaces one symbol by another; what follows must be equal.
            stack = [(other, to, more, offset) for _, other, more in out[:i]]
            while stack:
                p, q, a, b = stack.pop()
                if p == q:
                    same = long_ones(p)
                    left.extend([a + x for x in same])
                    right.extend([b + x for x in same])
                    continue
                p_edges, q_edges = edges[p], edges[q]
                for s, (p_to, p_more) in p_edges.items():
                    if s in q_edges and s != SHORT:
                        q_to, q_more = q_edges[s]
                        if s == LONG:
                            left.append(a + p_more)
                            right.append(b + q_more)
                        else:
                            stack.append((p_to, q_to, a + p_more, b + q_more))
            # The edit inserts this symbol; what follows must be equal, and differ from it at once.
            stack = [(state, to, 0, offset)]
            first = True
            while stack:
                p, q, a, b = stack.pop()
                p_edges, q_edges = edges[p], edges[q]
                if SHORT in p_edges:
                    if LONG in q_edges and not (first and symbol == after):
                        left.append(a + p_edges[SHORT][1])
                        right.append(b + q_edges[LONG][1])
                for s, (p_to, p_more) in p_edges.items():
                    if s in q_edges and s not in (LONG, SHORT) and not (first and s == symbol):
                        q_to, q_more = q_edges[s]
                        stack.append((p_to, q_to, a + p_more, b + q_more))
                first = False
        if left:
            parts.append((begun, left, right))
    return parts


def _group_near(words: list[str], counts: list[int], m: int, lo: int, hi: int):
    """(position, near words, best count, best position) of words with near ones."""
    behind = m - 1 - hi
    after = words[0][len(words[0]) - behind :][:1] if behind else ""
    inner = [w[lo : len(w) - behind] + (LONG if len(w) == m else SHORT) for w in words]
    order = sorted(range(len(words)), key=inner.__getitem__)
    parts = near_pairs([inner[i] for i in order], after)
    total = sum(len(begun) * len(left) for begun, left, _ in parts)
    if not total:
        return
    # Of near words of equal counts the first in code-point order is best.
    rank = {i: r for r, i in enumerate(sorted(range(len(words)), key=words.__getitem__))}
    scale = len(words)
    by_rank = {r: i for i, r in rank.items()}
    score = [counts[i] * scale + scale - 1 - rank[i] for i in order]
    if total < MANY:
        near, best = [0] * scale, [-1] * scale
        for begun, left, right in parts:
            for start in begun:
                for x, y in zip(left, right):
                    x, y = start + x, start + y
                    near[x] += 1
                    near[y] += 1
                    best[x] = max(best[x], score[y])
                    best[y] = max(best[y], score[x])
    else:
        near, best = np.zeros(scale, np.int64), np.full(scale, -1, np.int64)
        score = np.array(score, np.int64)
        for begun, left, right in parts:
            begun = np.array(begun)[:, None]
            # Few rows of starts at once, so that the sums stay small.
            step = max(1, (1 << 20) // len(left))
            for i in range(0, len(begun), step):
                x = (begun[i : i + step] + np.array(left)).ravel()
                y = (begun[i : i + step] + np.array(right)).ravel()
                near += np.bincount(x, minlength=scale) + np.bincount(y, minlength=scale)
                np.maximum.at(best, x, score[y])
                np.maximum.at(best, y, score[x])
        near, best = near.tolist(), best.tolist()
    for position, found, top in zip(order, near, best):
        if found:
            count, place = divmod(top, scale)
            yield position, found, count, by_rank[scale - 1 - place]


def near_words(words: DataFrame, most: int = GROUP) -> DataFrame:
    """word, n_near and its near word of largest n (ties: first in code-point order).

    ``words`` has word and n. Words without a near word are left out. What leaves a
    group is at most a row a word, its pairs already counted.
    """

    def run(batches):
        held, key = [], None

        def made(groups):
            rows = []
            for (m, lo, hi, _), members in groups:
                if len(members) < 2:
                    continue
                listed = [w for w, _ in members]
                counts = [n for _, n in members]
                for i, found, count, j in _group_near(listed, counts, m, lo, hi):
                    rows.append((listed[i], found, count, listed[j]))
            kinds = pa.string(), pa.int64(), pa.int64(), pa.string()
            columns = list(zip(*rows)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "found", "count", "near"])

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in [*STATE, "word", "n"]))
            groups = []
            for state, members in groupby(rows, key=lambda r: r[:4]):
                members = [r[4:] for r in members]
                if state == key:
                    held += members
                else:
                    if key is not None:
                        groups.append((key, held))
                    key, held = state, members
            yield made(groups)
        if key is not None:
            yield made([(key, held)])

    states = by_initial_state(words, most).repartition(*STATE).sortWithinPartitions(*STATE)
    parts = states.mapInArrow(run, "word string, found long, count long, near string")
    best = F.min(F.struct(-F.col("count"), F.col("near").alias("near"))).alias("best")
    return parts.groupBy("word").agg(F.sum("found").alias("n_near"), best).select(
        "word", "n_near", F.col("best.near").alias("near")
    )


def roots(links: DataFrame, longest: int) -> DataFrame:
    """word and root, the last of the chain of forms from it.

    ``links`` has word and form; chains are of at most ``longest`` links, and each
    round doubles how far a word has been followed. Written once a round.
    """
    reached = staged(links.select("word", F.col("form").alias("root")), "spelling-roots")
    done = 1
    while done < longest:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        both = reached.join(further, "root", "left")
        reached = staged(both.select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
        done *= 2
    return reached


def variants(docs: DataFrame, lead: int = LEAD, most: int = GROUP) -> DataFrame:
    """Each word with its form and the root of its forms.

    word, form, root, n, n_near and form_n. The form is the near word of largest n
    (ties: first in code-point order) if that is at least ``lead`` times the word's
    own, else null; the root is where following forms ends, the word itself without
    a form. An empty table, or texts without such words, give no rows.
    """
    words = staged(vocabulary(docs), "spelling-words")
    near = staged(near_words(words, most), "spelling-near")
    forms = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = words.join(near.join(forms, "near"), "word", "left")
    leads = F.col("near_n") >= lead * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(leads, F.col("near")).alias("form"),
        F.when(leads, F.col("near_n")).alias("form_n"),
    )
    found = staged(found, "spelling-forms")
    # Each form is lead times as frequent, so the largest n bounds the chains.
    highest = found.agg(F.max("form_n")).first()[0]
    longest, n = 0, LEAST_COUNT
    while highest is not None and n * lead <= highest:
        longest, n = longest + 1, n * lead
    links = found.where(F.col("form").isNotNull()).select("word", "form")
    if longest == 0:
        return found.select("word", "form", F.col("word").alias("root"), "n", "n_near", "form_n")
    full = found.join(roots(links, longest), "word", "left")
    return full.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
