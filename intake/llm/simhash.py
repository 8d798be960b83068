"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components.

Fingerprints of at most ``distance`` differing bits agree in at least ``blocks -
distance`` of ``blocks`` bit blocks. Each fingerprint is therefore filed under every
choice of that many blocks; a close pair shares a file and is verified there by its
Hamming distance. Copies share a fingerprint and are one row throughout.

No pairs within a file are written out. First every fingerprint is compared with the two
extremes of each of its files, which joins most groups; only files that still hold more
than one component are then searched in full, and only between components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from intake.llm.common import components, settled, whole

_ROWS = 4096


@dataclass(frozen=True)
class SimHash:
    """``words`` in a shingle, links up to ``distance`` bits, files of ``blocks`` blocks.

    More blocks make files smaller and more numerous: 7 give 35 files of 27 or more
    bits to each fingerprint, 8 give 70 of 32 bits.
    """

    words: int = 4
    distance: int = 4
    blocks: int = 7
    seed: int = 42

    def files(self) -> list[tuple[int, ...]]:
        """The bit masks, as signed longs, of each choice of blocks."""
        edges = [64 * i // self.blocks for i in range(self.blocks + 1)]
        blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
        masks = (sum(c) for c in combinations(blocks, self.blocks - self.distance))
        return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint(text: str | None, words: int, seed: int) -> int:
    """The unsigned fingerprint of one text: a bit is 1 if over half the shingles' hashes have it."""
    # bytes.lower and bytes.split know A-Z and the six blanks only.
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = list(accumulate((len(p) + 1 for p in parts), initial=0))
    n = max(1, len(parts) - words + 1)
    width = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _ROWS):
        hashes = [
            digest(line[a : b - 1], seed)
            for a, b in zip(ends[at : min(n, at + _ROWS)], ends[at + width :], strict=False)
        ]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, how: SimHash = SimHash(), keyed: bool = False) -> DataFrame:
    """doc_id and ``bits`` (the fingerprint as a signed long) of each row of ``docs``.

    Reads doc_id and text only. Null, empty and blank texts have fingerprint 0. With ``keyed`` also
    ``text_key``, a digest of the text, in which null and empty ones differ.
    """
    words, seed = how.words, how.seed

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            bits = np.array([fingerprint(t.as_py(), words, seed) for t in part.column(1)], np.uint64)
            columns = [part.column(0), pa.array(bits.view(np.int64)), *part.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "bits", "text_key"][: len(columns)])

    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    schema = "doc_id long, bits long"
    if keyed:
        columns, schema = [*columns, _text_key()], f"{schema}, text_key string"
    return docs.select(*columns).mapInArrow(batches, schema)


def _text_key() -> Column:
    return F.coalesce(F.sha2(F.col("text").cast("string"), 256), F.lit("null"))


def _close(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def linked(prints: DataFrame, how: SimHash = SimHash()) -> DataFrame:
    """Components of the distinct fingerprints ``bits``: node, root of those with a link."""
    masks = [F.struct(F.lit(i).alias("file"), F.lit(m).alias("mask")) for i, m in enumerate(how.files())]
    filed = prints.select("bits", F.explode(F.array(*masks)).alias("m")).select(
        "bits", F.col("m.file").alias("file"), F.col("bits").bitwiseAND(F.col("m.mask")).alias("key")
    )
    shared = (
        filed.groupBy("file", "key")
        .agg(F.min("bits").alias("low"), F.max("bits").alias("high"))
        .where("low < high")
    )
    filed = settled(filed.join(shared, ["file", "key"]), "files")
    ends = [
        filed.where((F.col("bits") != F.col(end)) & _close(F.col("bits"), F.col(end), how.distance)).select(
            F.col("bits").alias("u"), F.col(end).alias("v")
        )
        for end in ("low", "high")
    ]
    first = settled(components(ends[0].unionByName(ends[1]).distinct()), "components")
    # Files whose fingerprints are all in one component have nothing left to find.
    filed = filed.join(first, F.col("bits") == F.col("node"), "left").select(
        "file", "key", "bits", F.coalesce("root", "bits").alias("part")
    )
    filed = settled(filed, "files")
    mixed = (
        filed.groupBy("file", "key")
        .agg(F.min("part").alias("_low"), F.max("part").alias("_high"))
        .where("_low < _high")
        .select("file", "key")
    )
    rest = settled(filed.join(mixed, ["file", "key"]), "files")
    a, b = rest.alias("a"), rest.alias("b")
    found = a.join(
        b,
        (F.col("a.file") == F.col("b.file"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.part") < F.col("b.part"))
        & _close(F.col("a.bits"), F.col("b.bits"), how.distance),
    ).select(F.col("a.part").alias("u"), F.col("b.part").alias("v"))
    second = settled(components(found.distinct()), "components")
    # A component of the first round, and fingerprints on their own, may have moved.
    every = first.unionByName(
        second.select("node", F.col("node").alias("root")).join(first, "node", "left_anti")
    )
    moved = second.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    return every.join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))


def near_duplicates(docs: DataFrame, how: SimHash = SimHash()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of each row of ``docs``.

    component_id is the smallest doc_id that links reach, the row's own included;
    links hold between fingerprints of ``how.distance`` or fewer differing bits. Rows
    that repeat link to each other; a null doc_id is never the smallest, and a component
    of nulls only has a null id. No documents, no rows.
    """
    rows = settled(fingerprints(docs, how), "prints")
    prints = settled(rows.groupBy("bits").agg(F.min("doc_id").alias("least")), "prints")
    roots = prints.join(linked(prints.select("bits"), how), F.col("bits") == F.col("node"), "left").select(
        "bits", F.coalesce("root", "bits").alias("root"), "least"
    )
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settled(roots.join(ids, "root").select(F.col("bits").alias("_b"), "component_id"), "components")
    return rows.join(named, F.col("bits") == F.col("_b")).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, how: SimHash = SimHash()) -> DataFrame:
    """``docs``, all columns, without near-duplicates: of each component one row stays.

    It is the row with the smallest doc_id and then the least digest of the text, of rows equal in
    both the one with the least hash of all columns. An id that stands in several components keeps a
    row in each. Rows without an id all stay.
    """
    rows = settled(fingerprints(docs.where("doc_id is not null"), how, keyed=True), "prints")
    firsts = settled(rows.groupBy("bits").agg(F.min(F.struct("doc_id", "text_key")).alias("first")), "prints")
    roots = firsts.join(linked(firsts.select("bits"), how), F.col("bits") == F.col("node"), "left")
    kept = roots.groupBy(F.coalesce("root", "bits").alias("_r")).agg(F.min("first").alias("first")).select("first.*")
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("text_key"), whole(docs))
    one = one.join(settled(kept, "kept"), ["doc_id", "text_key"], "left_semi")
    place = F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy(F.xxhash64("doc")))
    one = one.withColumn("place", place).where("place = 1")
    return one.select("doc.*").unionByName(docs.where("doc_id is null"))
