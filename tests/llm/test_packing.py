import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from intake.llm.packing import Encoder, Packing, best_fit, cross, fitness, packed
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = [
    "", " ", "  two  spaces\n\n tab\t\t end ", "don't we'll I'M", "é ü ñ 中文 \U0001f600\U0001f468‍\U0001f469", "\x1c\x85\xa0  x",
    "12345 3.14 ²½ Ⅷ", "a" * 3000, "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "#" * 50, "\r\n" * 20, "’s ſ K",
]


def test_ids_are_those_of_tokenizers(tokenizer):
    encoder = Encoder()
    for text in ODD:
        assert encoder.ids(text) == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert encoder.ids(None) == []


def check(rows, docs, tokenizer, size=1024):
    """All that is promised of the pieces of ``docs`` [(doc_id, text)] with different ids."""
    by_doc, by_sequence, total = {}, {}, 0
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        at = 0
        for k, r in enumerate(sorted(by_doc.pop(doc_id), key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and 0 < r.length <= size
            assert r.length == size or k == 0
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence), total


def test_whole_table_is_packed_tightly(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    n, total = check(packed(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], tokenizer)
    assert n <= -(-total // 1024) + 3


def test_odd_texts(documents, tokenizer):
    rows = [*enumerate(ODD), (99, None), (100, "word " * 5000), (101, "x" * 1 + " y" * 1022)]
    check(packed(documents(*rows, extra=True)).collect(), rows, tokenizer)


def test_cells_islands_and_the_last_round(documents, tokenizer):
    rng = random.Random(3)
    rows = [(i, "a b" * rng.randrange(0, 300)) for i in range(600)]
    how = Packing(cell=64, islands=3, epochs=3)
    n, total = check(packed(documents(*rows), how).collect(), rows, tokenizer)
    assert n <= total / 1024 * 1.03 + 2


def test_rows_that_repeat_and_no_rows(documents):
    got = packed(documents((1, "a b c"), (1, "a b c"), (None, "a"))).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3
    assert packed(documents()).collect() == []


def test_breeding_keeps_packings_whole():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1024, 400).tolist()
    pool = [best_fit([], rng.permutation(400).tolist()[:200], lengths, 1024) for _ in range(2)]
    pool = [best_fit(p, sorted(set(range(400)) - {i for b in p for i in b}), lengths, 1024) for p in pool]
    for _ in range(30):
        child = cross(pool[0], pool[1], lengths, 1024, rng)
        assert sorted(i for b in child for i in b) == list(range(400))
        assert all(sum(lengths[i] for i in b) <= 1024 for b in child)
        pool = sorted([*pool, child], key=lambda p: fitness(p, lengths, 1024), reverse=True)[:2]
    assert len(pool[0]) <= -(-sum(lengths) // 1024) + 20
