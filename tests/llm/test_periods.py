import random
import zlib

import numpy as np
import pytest

from intake.llm.periods import COVER, MODULUS, Extensions, Periods, kept_words, periodic_runs, runs_of, stuttered


def slow_runs(words, least=6, exponent=4):
    """(start, length, period) of all runs, by start, then period, found place by place."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def slow_kept(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def slow_stutter(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def some_words(rng, n, different):
    words = [rng.randrange(different) for _ in range(n)]
    if n > 20 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 4))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_the_cover_meets_every_pair():
    differences = {(a - b) % MODULUS for a in COVER for b in COVER}
    assert differences == set(range(MODULUS))


def test_extensions_equal_word_by_word_comparison():
    rng = random.Random(1)
    for _ in range(40):
        n = rng.choice([1, 2, 31, 32, 90, 300])
        text = np.array(some_words(rng, n, rng.choice([1, 2, 40])), np.int64)
        pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
        if not pairs:
            continue
        i, j = map(np.array, zip(*pairs, strict=True))
        want = [next((k for k in range(n - b) if text[a + k] != text[b + k]), n - b) for a, b in pairs]
        assert Extensions(text).of(i, j).tolist() == want


@pytest.mark.parametrize("pairs", [7, 1 << 19])
def test_runs_equal_the_slow_ones(pairs):
    rng = random.Random(2)
    for _ in range(150):
        texts = [some_words(rng, rng.choice([0, 1, 5, 6, 7, 8, 30, 60, 200]), rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 6))]
        texts += [texts[0]]  # copies in one batch
        got = runs_of([np.array(t, np.int64) for t in texts], Periods(pairs=pairs))
        for t, runs in zip(texts, got, strict=True):
            assert [tuple(r) for r in runs.tolist()] == slow_runs(t)
            assert [t[k] for k in np.flatnonzero(kept_words(len(t), runs))] == slow_kept(t, slow_runs(t))


@pytest.mark.parametrize("at_once", [1, 50, 1 << 18])
def test_operator_over_texts_of_all_kinds(spark, documents, at_once):
    rng = random.Random(3)
    texts = {i: " ".join(f"w{w}" for w in some_words(rng, rng.choice([0, 3, 40, 90]), rng.choice([1, 3, 30]))) for i in range(30)}
    # Blanks of all kinds, a no-break space (no blank), a very long text, letters in two cases.
    texts |= {30: None, 31: "", 32: " \n\t ", 33: "a\tb\n" * 9, 34: "a\u00a0b " * 8, 35: "x y z " * 20_000, 36: "A a " * 7}
    rows = [*texts.items(), (3, texts[3])]
    got = periodic_runs(documents(*rows, extra=True), Periods(words=at_once)).collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    for r in got:
        words = (texts[r.doc_id] or "").encode().split()
        runs = [(0, 60_000, 3)] if r.doc_id == 35 else slow_runs(words)
        assert [tuple(x) for x in r.runs] == runs
        assert r.collapsed == b" ".join(slow_kept(words, runs)).decode()


def test_nothing(spark, documents):
    df = periodic_runs(documents((1, "a")).where("false"))
    assert df.columns == ["doc_id", "runs", "collapsed"] and df.count() == 0


def test_stutter_equals_the_slow_one(spark, documents):
    rows = [(i, " ".join(f"w{k % 17}" for k in range(i % 40))) for i in range(400)] + [(None, "a b c"), (401, None), (402, " ")]
    now = {r.doc_id: r.text for r in stuttered(documents(*rows)).collect()}
    assert len(now) == len(rows)
    for doc_id, text in rows:
        words = (text or "").encode().split()
        want = slow_stutter(doc_id, words)
        assert (now[doc_id] or "").encode().split() == want
        if want is words:
            assert now[doc_id] == text
