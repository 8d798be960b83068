import random

import numpy as np
import pytest
import xxhash

from intake.llm.common import components
from intake.llm.simhash import SimHash, fingerprint, first_of_each, linked, near_duplicates
from tests.llm.conftest import by_id

BLANK = " \t\n\x0b\x0c\r"


def slow_fingerprint(text, n=4):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in BLANK:
            words += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, distance=4):
    """{id: smallest id} by comparing all pairs; prints: [(id, bits)]."""
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= distance:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(prints):
        least[find(i)] = min(least.get(find(i), k), k)
    return {k: least[find(i)] for i, (k, _) in enumerate(prints)}


@pytest.mark.parametrize(
    "text",
    [None, "", " \n\t ", "one", "One TWO three", "a b c d", "a b c d e", "ÄRGER ärger \x85 \xa0 x y", "x " * 9000, "  a\x1cb c d e f"],
)
def test_fingerprint_equals_the_slow_one(text):
    assert fingerprint(text, 4, 42) == slow_fingerprint(text)


def test_close_prints_share_a_file():
    how = SimHash()
    rng = random.Random(1)
    masks = how.files()
    assert len(masks) == 35
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any((a ^ b) & (m % (1 << 64)) == 0 for m in masks)


def test_links_equal_brute_force_on_chains_and_clusters(spark):
    rng = random.Random(2)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        bits = rng.getrandbits(64)
        for _ in range(40):  # chains and dense clusters of different prints
            prints.add(bits)
            flip = rng.sample(range(64), rng.choice([1, 2, 4, 5]))
            step = bits
            for f in flip:
                step ^= 1 << f
            prints.add(step)
            bits = step if rng.random() < 0.5 else bits
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(s,) for s in signed], "bits long")
    got = {r.node: r.root for r in linked(rows).collect()}
    want = slow_components(list(zip(signed, prints, strict=True)))
    groups = {}
    for p in signed:
        groups.setdefault(got.get(p, p), set()).add(p)
    wanted = {}
    for p, root in want.items():
        wanted.setdefault(root, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_one_large_group_of_near_prints(spark):
    centre = 0x0123456789ABCDEF
    near = {centre}
    rng = random.Random(3)
    while len(near) < 2000:
        bits = centre
        for b in rng.sample(range(64), rng.choice([1, 2, 3])):
            bits ^= 1 << b
        near.add(bits)
    rows = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in near], "bits long")
    got = linked(rows).collect()
    assert len(got) == 2000 and len({r.root for r in got}) == 1


def test_near_duplicates_with_odd_rows(documents):
    rng = random.Random(4)
    base = " ".join(f"w{rng.randrange(900)}" for _ in range(400))
    near = base + " tail"
    rows = [(7, base), (3, near), (9, base), (5, None), (4, ""), (6, " \n"), (1, "other words entirely here now"), (9, base), (2, "x " * 30000)]
    got = near_duplicates(documents(*rows, extra=True)).collect()
    assert len(got) == len(rows)
    want = slow_components([(i, slow_fingerprint(t)) for i, t in rows])
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (i, f"{slow_fingerprint(t):016x}", want[i]) for i, t in rows
    }


def test_null_ids_and_no_rows(documents):
    got = near_duplicates(documents((None, "a b c d e"), (None, "a b c d e"), (8, "a b c d e"), (None, "z y x w v"))).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 8), (0, 8), (8, 8)]
    assert near_duplicates(documents()).collect() == []


def test_first_of_each_keeps_columns_and_one_row_of_a_group(documents):
    docs = documents((3, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (5, "quite another text with words"), (None, "a b c d e"), extra=True)
    got = first_of_each(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in got.collect()) == [0, 2, 5]


def test_components_of_a_long_chain_and_a_star(spark):
    n = 300
    order = np.random.default_rng(0).permutation(n).tolist()
    chain = [(order[i], order[i + 1]) for i in range(n - 1)]
    star = [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + star, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(n))
    assert all(got[1000 + i] == 1000 for i in range(200))
    assert len(got) == n + 200


def test_first_of_each_keeps_every_text_under_repeated_ids(documents):
    a, b = "one two three four five six seven", "quite another text with other words in it"
    cases = [(5, a), (5, b), (9, b)], [(9, b), (5, b), (5, a)], [(5, b), (9, a), (5, a), (5, b)], [(5, None), (5, ""), (5, a)]
    for rows in cases:
        got = sorted((r.doc_id, r.text) for r in first_of_each(documents(*rows, extra=True)).collect() if r.text)
        assert got == sorted({(5, t) for _, t in rows if t})
