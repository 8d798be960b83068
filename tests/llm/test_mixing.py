import math

import pytest

from intake.llm.mixing import Mix, apportion, mixed, remixed
from tests.conftest import SF_DIR
from tests.llm.conftest import by_id


def slow_targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2):
    """{source: target} by pouring the excess back until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / open_ for s in order}
        above = {s for s in order if s not in full and target[s] >= most * sizes[s]}
        if not above:
            return target
        full |= above
        if len(full) == len(order):
            return {s: most * sizes[s] for s in order}


def slow_seats(weights, caps, seats):
    """Sainte-Lague, one seat after the other."""
    got = [0] * len(weights)
    for _ in range(min(seats, sum(caps))):
        best = max(
            (i for i in range(len(got)) if got[i] < caps[i]), key=lambda i: (weights[i] / (2 * got[i] + 1), -i)
        )
        got[best] += 1
    return got


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1000, 10**6])
def test_seats_go_to_the_highest_quotients(spark, seats):
    weights = [53.0, 24.0, 23.0, 1.0, 1.0, 1.0, 0.0, 8.0, 8.0]
    caps = [10**5, 10**5, 20, 1, 1, 0, 5, 300, 300]
    rows = [(f"{i:02}", w, c) for i, (w, c) in enumerate(zip(weights, caps, strict=True))]
    got = apportion(spark.createDataFrame(rows, "party string, weight double, seats_cap long"), seats)
    got = by_id(got, "seats", key="party")
    want = slow_seats(weights, caps, seats) if seats <= 1000 else caps
    assert [got[r[0]] for r in rows] == want or (seats > 1000 and sum(got.values()) == sum(caps))


def test_many_ties(spark):
    rows = [(f"{i:05}", 1.0, 3) for i in range(3000)]
    got = apportion(spark.createDataFrame(rows, "party string, weight double, seats_cap long"), 4500)
    assert got.agg({"seats": "sum"}).first()[0] == 4500
    assert {r.seats for r in got.collect()} == {1, 2}


def test_ties_are_not_ranked_in_one_task(spark, plan):
    rows = [(f"{i:05}", 1.0, 1) for i in range(12000)]
    got = apportion(spark.createDataFrame(rows, "party string, weight double, seats_cap long"), 7000)
    ranked = [x for x in plan(got).splitlines() if "row_number() windowspecdefinition(" in x]
    assert ranked and all("row_number() windowspecdefinition(_part" in x for x in ranked)
    assert {r.party for r in got.where("seats = 1").collect()} == {f"{i:05}" for i in range(7000)}


def test_whole_table_comes_near_its_targets(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mixed(docs).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    sizes, taken = {}, {}
    for r in rows:
        assert r.size == len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", r.text) if w])
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    want = slow_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 16
    again = by_id(mixed(docs), "taken")
    assert again == {r.doc_id: r.taken for r in rows}


def test_shards_of_a_hot_source(documents):
    rows = [(i, f"w{i} " * (1 + i % 40), "en", None if i % 3 else f"s{i % 5}") for i in range(900)]
    mix = Mix(shard=500)
    got = by_id(mixed(documents(*rows, extra=True), mix), "size", "target", "taken")
    sizes, taken = {}, {}
    for i, _, _, s in rows:
        sizes[s] = sizes.get(s, 0) + got[i][0]
        taken[s] = taken.get(s, 0) + got[i][2]
        assert got[i][2] <= 2 * got[i][0]
    want = slow_targets(sizes)
    for i, _, _, s in rows:
        assert math.isclose(got[i][1], want[s], rel_tol=1e-9)
    shards = math.ceil(max(sizes.values()) / 500)
    assert all(abs(taken[s] - want[s]) <= 16 * (shards + 1) for s in want)


def test_odd_rows(documents):
    docs = documents((1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c d e"), (4, " \n\x0b"), (5, "x " * 50000, "en", None))
    rows = mixed(docs).collect()
    assert sorted(r.size for r in rows) == [0, 0, 0, 2, 2, 3, 50000]
    assert all(r.taken <= 2 * r.size for r in rows)
    assert mixed(documents()).collect() == []
    assert [(r.size, r.target, r.taken) for r in mixed(documents((1, ""), (2, None))).collect()] == [(0, 0.0, 0)] * 2


def test_remixed_repeats_whole_rows(documents):
    docs = documents(*[(i, f"w{i} " * 20, "en", f"s{i % 4}") for i in range(200)], (7, "w7 " * 20, "en", "s3"), extra=True)
    got = remixed(docs)
    assert got.columns == docs.columns
    shares = {}
    for r in mixed(docs).collect():
        shares[r.doc_id] = shares.get(r.doc_id, 0) + round(r.taken / r.size)
    counts = {i: 0 for i in shares}
    for r in got.collect():
        counts[r.doc_id] += 1
        assert r.text == f"w{r.doc_id} " * 20
    assert counts == shares and sum(counts.values()) > 250
