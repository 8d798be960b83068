import hashlib
import heapq
import random
import zlib

import pytest

from intake.llm import turns
from intake.llm.turns import audited, audited_among, damaged, repaired

SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if case == 1:
            text = ""
        if case == 2:
            text = "".join(c for c in text if c not in ".!?")
        if case == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(case, 1)
    return out


def slow_audit(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit), messages: the cheapest path, found best first."""

    def place(r):
        mark = hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        return r[0] is not None, r[0] or 0, r[1], mark

    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=place)
    faults, seen = [], set()
    for _, role, text in rows:
        rest = text.strip(BLANKS)
        faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            break
        if (i, last) in done:
            continue
        done.add((i, last))
        name = "assistant" if last == "u" else "user"
        heapq.heappush(heap, (cost + 2, audit + "I", i, name[0], (*out, (name, "", "I"))))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
            if faults[i] not in ("blank", "duplicate"):
                extra = faults[i] == "truncated"
                if last + role[:1] in ("s", "u", "su", "au", "ua") and role:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role[0], (*out, (role, text, "K"))))
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, name[0], (*out, (name, text, "R"))))
    numbers = [t for t, *_ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit), list(out)


def slow_audits(rows, ids):
    by = {i: [] for i in ids}
    for conv, *rest in rows:
        by[conv].append(rest)
    out = {}
    for conv, held in by.items():
        figures, messages = slow_audit(held)
        text = "\n".join(f"{r}:{x}" for r, x, _ in messages)
        out[conv] = (*figures, hashlib.sha256(text.encode()).hexdigest())
    return out


def answers(df):
    rows = df.collect()
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


@pytest.fixture
def some(spark):
    rng = random.Random(7)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    texts = ["a.", "b", "", " ", None, "c!", "d?  ", "e\n", "f.", "g.", "\u00a0"]
    return [
        (conv or None, rng.choice([None, 0, 1, 2, 3, 4, 5, 8, 2**60]), rng.choice(roles), rng.choice(texts))
        for conv in range(200)
        for _ in range(rng.choice([1, 2, 3, 5, 9]))
    ]


@pytest.mark.parametrize("block", [1, 2, 1 << 16])
def test_audits_equal_the_slow_ones(spark, some, block, monkeypatch):
    monkeypatch.setattr(turns, "BLOCK", block)
    rows = spark.createDataFrame(some, SCHEMA).selectExpr("*", "'x' AS conv", "'x' AS digest", "1 AS kind", "2 AS fault", "3 AS cost")
    assert answers(audited(rows)) == slow_audits(some, {r[0] for r in some})


def test_messages_equal_the_slow_ones(spark, some):
    got = {}
    for r in sorted(repaired(spark.createDataFrame(some, SCHEMA)).collect(), key=lambda r: r.place):
        got.setdefault(r.conv_id, []).append((r.role, r.text, r.edit))
    by = {}
    for conv, *rest in some:
        by.setdefault(conv, []).append(rest)
    want = {conv: slow_audit(rows)[1] for conv, rows in by.items()}
    assert got == {conv: m for conv, m in want.items() if m}


def test_damage_equals_the_slow_one(spark, some):
    got = sorted(map(tuple, damaged(spark.createDataFrame(some, SCHEMA)).collect()), key=str)
    assert got == sorted(slow_damage(some), key=str)


def test_a_giant_conversation_streams_through_blocks(spark, monkeypatch):
    """Half of all rows are one conversation, over many Arrow batches and blocks."""
    monkeypatch.setattr(turns, "BLOCK", 700)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        rng = random.Random(8)
        rows = [(1, t, rng.choice(["user", "assistant"]), f"{rng.randrange(9 * 10**5)}{rng.choice(['.', ''])}") for t in range(6000)]
        rows += [(2 + k // 6, k % 6, ("user", "assistant")[k % 2], f"t{k}.") for k in range(6000)]
        rows += [(1, 7, "user", "same.")] * 900  # repeated rows of one turn across blocks
        got = answers(audited(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == slow_audits(rows, {r[0] for r in rows})
    assert len(got[1][6]) >= 6900


def test_conversations_without_rows_and_none_at_all(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert audited(empty).count() == 0 and repaired(empty).count() == 0
    ids = spark.createDataFrame([(1,), (1,), (None,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert answers(audited_among(empty, ids)) == {1: nothing, None: nothing}
