import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from intake.llm.tokens import Flat, document_tokens, file_blocks, stored_blocks, token_counts, write_flat
from tests.conftest import SF_DIR


def slow(ids, end):
    """[(ordinal, start, n_tokens, closed)] of a flat sequence of ids."""
    out, start = [], 0
    for at, i in enumerate(ids):
        if i == end:
            out.append((len(out), start, at - start, True))
            start = at + 1
    return out + ([(len(out), start, len(ids) - start, False)] if start < len(ids) else [])


def counts(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.file, []).append((r.ordinal, r.start, r.n_tokens, r.closed))
    return {f: sorted(v) for f, v in out.items()}


@pytest.mark.parametrize("block, group", [(1, 2), (3, 2), (7, 3), (64, 1), (4096, 4096)])
def test_boundaries_are_stitched(spark, block, group):
    rng = random.Random(block)
    how = Flat(end=9, block=block, group=group)
    files = {f"f{k}": [9 if rng.random() < share else rng.randrange(9) for _ in range(n)] for k, (share, n) in enumerate(
        [(0.3, 200), (0.02, 500), (0.0, 50), (1.0, 40), (0.3, 1), (0.1, 333)])}
    files["closed"] = [1, 9]
    rows = []
    for name, ids in files.items():
        for b, at in enumerate(range(0, len(ids), block)):
            rows.append((name, b, np.array(ids[at : at + block], "<u2").tobytes()))
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r[:2], bytearray(r[2])) for r in rows], "file string, block long, data binary").repartition(5)
    assert counts(token_counts(df, how)) == {f: slow(ids, 9) for f, ids in files.items()}


def test_plain_files(spark, tmp_path):
    how = Flat(end=70000, width=4, block=5, group=2)
    rng = random.Random(1)
    want = {}
    for k in range(3):
        ids = [70000 if rng.random() < 0.2 else rng.randrange(90000) for _ in range(77 * k)]
        (tmp_path / f"{k}.bin").write_bytes(np.array(ids, "<u4").tobytes())
        if ids:
            want[k] = slow(ids, 70000)
    got = counts(token_counts(file_blocks(spark, str(tmp_path), how), how))
    assert {int(f[-5]): v for f, v in got.items()} == want


def test_null_and_empty_blocks(spark):
    rows = [("a", 0, bytearray(b"")), ("a", 1, None), ("a", 2, bytearray(np.array([1, 9, 2], "<u2").tobytes())), ("b", 0, None)]
    df = spark.createDataFrame(rows, "file string, block long, data binary")
    assert counts(token_counts(df, Flat(end=9))) == {"a": [(0, 0, 1, True), (1, 2, 1, False)]}


def test_documents(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, "long " * 100000), (5, "x"), (5, "x"), (None, "null id"), (6, "é中")]
    got = document_tokens(documents(*rows, extra=True), Flat(block=1000)).collect()
    want = sorted((i or 0, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == want
    assert document_tokens(documents()).collect() == []


def test_whole_table_and_its_files(spark, folder):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    how = Flat(block=1024)
    write_flat(docs, folder, how)
    blocks = stored_blocks(spark, folder)
    flat = {}
    for r in sorted(blocks.collect(), key=lambda r: r.block):
        flat[r.file] = flat.get(r.file, b"") + bytes(r.data)
    want = {f: slow(np.frombuffer(b, "<u2").tolist(), how.end) for f, b in flat.items()}
    assert counts(token_counts(blocks, how)) == want
    assert sum(map(len, want.values())) == docs.count()
    assert all(r.data is not None and len(r.data) <= 2048 for r in blocks.collect())
