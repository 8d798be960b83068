"""Every registered query over its whole small table, against SQL or a brute-force version."""

import hashlib
import math
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from intake.llm import quality as q
from intake.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_DIR
from tests.llm import test_ann, test_jaccard, test_mixing, test_packing, test_periods, test_quality, test_secrets, test_simhash, test_turns
from tests.llm.conftest import by_id
from tools.check import connect, differs

KINDS = ("assign", "access", "hex")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    assert differs(got, connect(SF_DIR).sql(ORACLES[name]).df()) == ""


def test_op1(spark, docs):
    got = by_id(QUERIES["op1_simhash"](spark, SF_DIR), "fingerprint", "component_id")
    prints = [(r.doc_id, test_simhash.slow_fingerprint(r.text)) for r in docs]
    want = test_simhash.slow_components(prints)
    assert got == {i: (f"{bits:016x}", want[i]) for i, bits in prints}


def slow_quality(docs, labels, quantile=0.998, step=1 / 1024):
    """{doc_id: (entropy, threshold, kept)} by arrays over all texts."""
    marks = {}
    for r in labels:
        marks.setdefault(r.doc_id, []).append((r.quality or 0, r.toxic or 0))
    good = {i for i, m in marks.items() if min(a for a, _ in m) == 1 and max(b for _, b in m) == 0}
    trusted = [r for r in docs if r.doc_id in good]
    half = lambda r: xxhash.xxh64_intdigest(r.text.encode(), 42) % 2
    table = q.class_table()
    entropy = lambda bits, text: float(np.float32(bits)[q.grams_of(text, table)].astype(float).mean()) if text else None
    model = test_quality.slow_model([r.text for r in trusted])
    other = [test_quality.slow_model([r.text for r in trusted if half(r) != h]) for h in (0, 1)]
    held = {}
    for r in trusted:
        if r.text:
            held.setdefault(r.lang, []).append(math.floor(entropy(other[half(r)], r.text) / step))
    limit = {}
    for lang, steps in held.items():
        steps.sort()
        limit[lang] = next((s + 1) * step for k, s in enumerate(steps, 1) if k >= quantile * len(steps) and (k == len(steps) or steps[k] != s))
    out = {}
    for r in docs:
        e, t = entropy(model, r.text or ""), limit.get(r.lang)
        out[r.doc_id] = (e, t, e is not None and (t is None or e < t))
    return out


def test_op2(spark, docs):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    want = slow_quality(docs, labels)
    got = by_id(QUERIES["op2_quality"](spark, SF_DIR), "perplexity", "threshold", "kept")
    assert got.keys() == want.keys()
    for i, (entropy, limit, kept) in want.items():
        assert math.isclose(got[i][0], 2**entropy, rel_tol=1e-4)
        assert math.isclose(got[i][1], 2**limit, rel_tol=2e-3)
        assert got[i][2] == kept or abs(entropy - limit) < 2e-3


def test_op4(spark, docs):
    got = by_id(QUERIES["op4_secrets"](spark, SF_DIR), "base_sha256", "n_assign", "n_access", "n_hex", "spans")
    assert len(got) == len(docs)
    for r in docs:
        want = test_secrets.slow_base(r.text)
        counts = tuple(len(re.findall(k + ":", want)) for k in KINDS)
        assert got[r.doc_id][:4] == (hashlib.sha256(want.encode()).hexdigest(), *counts)
        base = ",".join(s for s in got[r.doc_id][4].split(",") if s.split(":")[0] in KINDS)
        assert base == want


def test_op6(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = by_id(QUERIES["op6_tokens"](spark, SF_DIR), "n_tokens", "start", "ordinal", "file")
    assert len(got) == len(docs)
    places = {}
    for r in docs:
        n, start, ordinal, file = got[r.doc_id]
        assert n == len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        places.setdefault(file, []).append((ordinal, start, n))
    for rows in places.values():
        at = 0
        for k, (ordinal, start, n) in enumerate(sorted(rows)):
            assert (ordinal, start) == (k, at)
            at += n + 1


def test_op7(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = QUERIES["op7_packing"](spark, SF_DIR).collect()
    n, total = test_packing.check(rows, [(r.doc_id, r.text) for r in docs], tokenizer)
    assert n <= -(-total // 1024) + 3


def test_op8(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    want = test_ann.slow([(r.vec_id, r.embedding) for r in rows])
    got = test_ann.answers(QUERIES["op8_neighbours"](spark, SF_DIR))
    assert got.keys() == want.keys()
    assert test_ann.recall(got, want) >= 0.95


def test_op10(spark, docs):
    got = by_id(QUERIES["op10_mixing"](spark, SF_DIR), "size", "source_size", "target", "taken")
    sizes, taken = {}, {}
    for r in docs:
        size, _, _, n = got[r.doc_id]
        assert size == len([w for w in re.split(r"[\x20\x09-\x0D]+", r.text or "") if w])
        assert 0 <= n <= 2 * size
        sizes[r.source] = sizes.get(r.source, 0) + size
        taken[r.source] = taken.get(r.source, 0) + n
    want = test_mixing.slow_targets(sizes)
    for r in docs:
        assert got[r.doc_id][1] == sizes[r.source]
        assert math.isclose(got[r.doc_id][2], want[r.source], rel_tol=1e-9)
    assert all(abs(taken[s] - want[s]) <= 16 for s in want)


def test_op11(spark, docs):
    got = by_id(QUERIES["op11_runs"](spark, SF_DIR), "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert len(got) == len(docs)
    for r in docs:
        words = test_periods.slow_stutter(r.doc_id, (r.text or "").encode().split())
        runs = test_periods.slow_runs(words)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = b" ".join(test_periods.slow_kept(words, runs))
        want = (len(runs), *(best or [None] * 3), best and 1000 * best[1] // best[2])
        assert got[r.doc_id] == (*want, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
    assert sum(n > 0 for n, *_ in got.values()) > len(docs) / 20


def test_op12(spark, docs):
    got = by_id(QUERIES["op12_jaccard"](spark, SF_DIR), "n_shingles", "component_id")
    assert got == test_jaccard.slow([(r.doc_id, r.text) for r in docs])


def test_op13(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = test_turns.answers(QUERIES["op13_turns"](spark, SF_DIR))
    assert got == test_turns.slow_audits(test_turns.slow_damage(rows), {r[0] for r in rows})
