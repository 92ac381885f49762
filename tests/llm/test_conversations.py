"""Conversation repair against all edits of short conversations."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import Row

from ledgerline.llm import conversations as c
from ledgerline.llm.conversations import BLANK, DUPLICATE, SOUND, TRUNCATED

SPACE = set(" \t\n\x0b\x0c\r")


def faults(rows):
    """First fault of each (role, text) in order."""
    seen, found = set(), []
    for role, text in rows:
        bare = text.rstrip("".join(SPACE))
        if not bare:
            found.append(BLANK)
        elif (role, text) in seen:
            found.append(DUPLICATE)
        elif bare[-1] not in ".!?":
            found.append(TRUNCATED)
        else:
            found.append(SOUND)
        seen.add((role, text))
    return found


def every_repair(rows):
    """(cost, audit, repaired rows) of all edits with up to two inserts at a place."""
    rows = list(zip(rows, faults(rows)))
    choices = []
    for (role, text), fault in rows:
        edits = [("D", 3, [])]
        if fault in (SOUND, TRUNCATED):
            extra = fault == TRUNCATED
            edits.append(("K", extra, [(role, text)]))
            edits += [("R", 2 + extra, [(new, text)]) for new in ("user", "assistant")]
        choices.append(edits)
    inserts = [
        ("I" * n, 2 * n, [(r, "") for r in new])
        for n in range(3)
        for new in itertools.product(("user", "assistant"), repeat=n)
    ]
    parts = [p for edits in choices for p in (inserts, edits)] + [inserts]
    # Extended part by part; beginnings that can't read (s?(ua)+)? any more are left.
    ways = [(0, "", [])]
    for part in parts:
        longer = ((a + cost, b + step, r + new) for a, b, r in ways for step, cost, new in part)
        ways = [w for w in longer if re.fullmatch("s?(ua)*u?", "".join(x[0][:1] or "-" for x in w[2]))]
    return [w for w in ways if re.fullmatch("(s?(ua)+)?", "".join(x[0][:1] for x in w[2]))]


def brute(rows):
    cost, audit, repaired = min(every_repair(rows))
    text = "\n".join(f"{r}:{t}" for r, t in repaired)
    return cost, audit, hashlib.sha256(text.encode()).hexdigest()


def fed(rows):
    steps = []
    path = c.Survivors(lambda step, *_: steps.append(step), hashed=True)
    for (role, text), fault in zip(rows, faults(rows)):
        path.take(role[:1], fault, role.encode(), text.encode())
    cost, digest = path.finish()
    return cost, "".join(steps), digest


TEXTS = ["Good.", "Well!", "Cut off", " \t", "So? ", ""]


def test_cheapest_edits_of_all_kinds():
    random.seed(11)
    roles = ["user", "assistant", "system", "tool", "", "u2"]
    for _ in range(250):
        n = random.randint(0, 4)
        rows = [(random.choice(roles), random.choice(TEXTS)) for _ in range(n)]
        assert fed(rows) == brute(rows), rows


def test_edits_leave_once_survivors_agree():
    steps = []
    path = c.Survivors(lambda step, *_: steps.append(step), hashed=False)
    waiting = []
    for i in range(3000):
        path.take("ua"[i % 2], SOUND, b"", b"")
        waiting.append(i + 1 - len(steps))
    assert max(waiting) <= 4 and len(path.nodes) <= 4


def test_a_tie_stays_open_over_any_length():
    """User turns only: two repairs cost the same at every row, so nothing is settled."""
    steps = []
    path = c.Survivors(lambda step, *_: steps.append(step), hashed=False)
    for _ in range(2001):
        path.take("u", SOUND, b"user", b"x.")
    assert len(steps) < 3
    cost, _ = path.finish()
    audit = "".join(steps)
    short = fed([("user", f"{i}.") for i in range(5)])
    assert short == brute([("user", f"{i}.") for i in range(5)])
    assert cost == 2002 and audit.startswith(short[1][:4])


def damaged(rows):
    """The planted faults by their definition, rows of a conversation in order."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {
        conv: sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        for conv, kept in found.items()
    }


def expected(rows):
    found = {}
    for conv, kept in damaged(rows).items():
        texts = [r[1:] for r in kept]
        kinds = faults(texts)
        turns = {t for t, *_ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[:1] for r, _ in texts]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        counts = tuple(kinds.count(k) for k in (BLANK, DUPLICATE, TRUNCATED))
        found[conv] = (gaps, *counts, illegal, *brute(texts))
    return found


SCHEMA = "conv_id long, turn long, role string, text string, place string"


@pytest.fixture(scope="module")
def odd():
    random.seed(5)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(random.randint(1, 4)):
            turn = random.choice([turn, turn, turn, turn * 3, None, 0])
            role = random.choice(["user", "assistant", "system", None, "user", "assistant"])
            rows.append((conv, turn, role, random.choice([*TEXTS, f"Only {turn}.", None])))
    rows += [(1, 0, "user", "Twice.")] * 2 + [(70, None, None, None)] * 2
    rows.append((71, 2**62, "user", "x" * 3_000_000 + "."))
    return rows


def test_audit_of_nulls_ties_and_long_texts(spark, odd):
    # A column of a name used inside is left out of account.
    table = spark.createDataFrame([(*r, "clash") for r in odd], SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in c.audited(c.damaged(table)).collect()}
    assert got == expected(odd)


def test_conversations_without_rows(spark):
    """crc32 of these keys is a multiple of 20, so that their rows are dropped."""
    gone = [i for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][:3]
    table = spark.createDataFrame([(i, 0, "user", "Hello.", "") for i in gone], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    got = c.audited(c.damaged(table)).collect()
    assert sorted(tuple(r) for r in got) == [(i, 0, 0, 0, 0, 0, 0, "", nothing) for i in gone]
    assert c.audited(c.damaged(table.limit(0))).count() == 0
    assert c.repaired(table.limit(0)).count() == 0


def test_repaired_rows_give_the_hash(spark, odd):
    table = spark.createDataFrame([(*r, "clash") for r in odd], SCHEMA)
    found = {}
    for r in c.repaired(c.damaged(table)).orderBy("conv_id", "place").collect():
        found.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, row in expected(odd).items():
        text = "\n".join(found.get(conv, []))
        assert hashlib.sha256(text.encode()).hexdigest() == row[-1], conv


def test_one_long_conversation_in_small_batches(spark):
    """Rows pass the task in batches; what is counted doesn't depend on their size."""
    rows = [(1, i, "user" if i % 3 else "assistant", f"Turn {i}" + "." * (i % 5 > 0), "") for i in range(3000)]
    table = spark.createDataFrame(rows, SCHEMA)
    whole = c.audited(c.damaged(table)).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert c.audited(c.damaged(table)).collect() == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    audit = whole[0].audit
    assert isinstance(whole[0], Row) and len(audit) - audit.count("I") == sum(len(v) for v in damaged([r[:4] for r in rows]).values())
