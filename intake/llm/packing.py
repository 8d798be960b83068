"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents are tokenised, closed with an end token, and cut only if longer than a
sequence. Full pieces are sequences of their own. The others are dealt at random to cells of bounded
size; every cell is bred on several islands at once. An individual is a packing: crossover
injects whole bins, the fullest first, from another packing, removes the bins that hold
a document again, and best-fits the displaced documents. After each epoch the islands' best
packings migrate to the other islands of their cell; the best one at the end counts. The bins
that stay least full are then opened, and their pieces dealt and bred once more together.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from intake.llm.common import settled

SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256


@dataclass(frozen=True)
class Packing:
    """``length`` tokens to a sequence, ``end`` closes a document.

    ``vocabulary`` is the merge ranks of the byte-level vocabulary, in base64; None is
    the public one installed on every machine. The islands: ``cell`` pieces about in a cell,
    ``islands`` to a cell, ``epochs`` with a migration after each, ``children`` bred in an
    epoch, ``population`` packings on an island. Bins with less than ``open_below`` of
    their length filled are opened for the last round.
    """

    length: int = 1024
    end: int = 2
    vocabulary: str | None = None
    cell: int = 8192
    islands: int = 2
    epochs: int = 2
    children: int = 6
    population: int = 4
    open_below: float = 0.9995
    seed: int = 42


class Encoder:
    """Token ids of a text, as the tokenizers library gives them for the same vocabulary.

    The merges run in tiktoken, which is several times as fast; the one special string
    of the vocabulary is looked for first, as tokenizers does.
    """

    def __init__(self, vocabulary: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        with open(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._merges = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def plain(self, text: str | None) -> list[int]:
        """The ids of a text in which the special string is text like any other."""
        return self._merges.encode_ordinary(text or "")

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if SPECIAL not in text:
            return self._merges.encode_ordinary(text)
        first, *others = (self._merges.encode_ordinary(part) for part in text.split(SPECIAL))
        return first + [i for other in others for i in (SPECIAL_ID, *other)]


def pieces(docs: DataFrame, how: Packing = Packing()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each row of ``docs``.

    Reads doc_id and text. A null or empty text is its end token alone. Of a document
    longer than a sequence the first piece takes what does not fill one.
    """
    size, end, vocabulary = how.length, how.end, how.vocabulary

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for part in parts:
            out: list[tuple] = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                ids = np.array([*encoder.ids(text.as_py()), end], "<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
                out += [
                    (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
                ]
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(bins: list[list[int]], items: list[int], lengths: list[int], size: int) -> list[list[int]]:
    """``items``, longest first, each into the fullest bin that still holds it."""
    room = [(size - sum(lengths[i] for i in b), k) for k, b in enumerate(bins)]
    room = sorted(r for r in room if r[0])
    for i in sorted(items, key=lambda i: -lengths[i]):
        at = bisect_left(room, (lengths[i], -1))
        if at < len(room):
            left, k = room.pop(at)
            bins[k].append(i)
        else:
            left, k = size, len(bins)
            bins.append([i])
        if left > lengths[i]:
            insort(room, (left - lengths[i], k))
    return bins


def fitness(bins: list[list[int]], lengths: list[int], size: int) -> tuple[int, float]:
    """Fewer bins are better, then bins that are full or else nearly empty."""
    return -len(bins), sum((sum(lengths[i] for i in b) / size) ** 2 for b in bins)


def cross(mother: list, father: list, lengths: list[int], size: int, rng: np.random.Generator) -> list:
    """A child: some of the father's fullest bins, the mother's untouched ones, the rest best-fitted."""
    full = sorted(father, key=lambda b: -sum(lengths[i] for i in b))
    gift = [full[k] for k in np.flatnonzero(rng.random(len(full)) < np.linspace(0.6, 0.0, len(full)))]
    given = {i for b in gift for i in b}
    whole = [b for b in mother if given.isdisjoint(b)]
    # The mother's least full bins are opened as well, else nothing could move into them.
    whole.sort(key=lambda b: -sum(lengths[i] for i in b))
    whole = whole[: len(whole) - int(rng.integers(1, 2 + len(whole) // 10))] if whole else whole
    kept = [*map(list, gift), *map(list, whole)]
    have = {i for b in kept for i in b}
    return best_fit(kept, [i for i in range(len(lengths)) if i not in have], lengths, size)


def _epoch(lengths: list[int], elites: list[list[int]], how: Packing, seed: int) -> tuple[list[int], int]:
    """The best packing of an island, as bin numbers, and how many bins it has.

    ``elites`` are packings that came from islands of this cell, none at the start.
    """
    rng = np.random.default_rng(seed)
    n, size = len(lengths), how.length
    least = -(-sum(lengths) // size)

    def grouped(numbers: list[int]) -> list[list[int]]:
        bins: dict[int, list[int]] = {}
        for i, b in enumerate(numbers):
            bins.setdefault(b, []).append(i)
        return list(bins.values())

    pool = [grouped(e) for e in elites] or [best_fit([], list(range(n)), lengths, size)]
    while len(pool) < how.population and min(map(len, pool)) > least:
        some = [i for i in range(n) if rng.random() < 0.3]
        pool.append(best_fit(best_fit([], some, lengths, size), sorted(set(range(n)) - set(some)), lengths, size))
    pool.sort(key=lambda b: fitness(b, lengths, size), reverse=True)
    for _ in range(how.children):
        if len(pool[0]) <= least or len(pool) < 2:
            break
        a, b = rng.choice(min(len(pool), how.population), 2, replace=False)
        pool.append(cross(pool[a], pool[b], lengths, size, rng))
        pool.sort(key=lambda b: fitness(b, lengths, size), reverse=True)
        del pool[how.population :]
    numbers = [0] * n
    for k, b in enumerate(pool[0]):
        for i in b:
            numbers[i] = k
    return numbers, len(pool[0])


def _bred(cells: DataFrame, how: Packing, seed: int) -> DataFrame:
    """``cells`` (cell, uids, lengths) with the bin number of each piece.

    Each cell is copied to its islands; an epoch is a pass over (cell, island), a
    migration a grouping by cell that hands all islands' best to each.
    """

    def breed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            best = [
                _epoch(list(map(int, r.lengths)), [list(map(int, e)) for e in r.elites], how, hash((seed, r.epoch, r.island, r.cell)) % 2**63)
                for r in part.itertuples()
            ]
            part["numbers"] = [b[0] for b in best]
            part["bins"] = [b[1] for b in best]
            yield part[["cell", "island", "uids", "lengths", "numbers", "bins"]]

    schema = "cell long, island int, uids array<long>, lengths array<int>, numbers array<int>, bins int"
    ring = F.array(*[F.lit(i) for i in range(how.islands)])
    state = cells.withColumn("elites", F.array().cast("array<array<int>>"))
    for epoch in range(how.epochs):
        state = state.select("cell", "uids", "lengths", "elites", F.explode(ring).alias("island"))
        state = state.withColumn("epoch", F.lit(epoch)).repartition("cell", "island")
        state = settled(state.mapInPandas(breed, schema), "epoch")
        met = state.groupBy("cell").agg(
            F.first("uids").alias("uids"),
            F.first("lengths").alias("lengths"),
            F.array_sort(F.collect_list(F.struct("bins", "island", "numbers"))).alias("best"),
        )
        state = met.select("cell", "uids", "lengths", F.col("best.numbers").alias("elites"))
    return state.select("cell", F.explode(F.arrays_zip("uids", "lengths", F.col("elites")[0].alias("bin"))).alias("p")).select(
        "cell", F.col("p.uids").alias("uid"), F.col("p.lengths").alias("length"), F.col("p.bin").alias("bin")
    )


def _dealt(parts: DataFrame, how: Packing, seed: int) -> DataFrame:
    """Cells of about ``how.cell`` of the pieces (uid, length), by a seeded hash."""
    n = max(1, -(-parts.count() // how.cell))
    return (
        parts.withColumn("cell", F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(n)))
        .groupBy("cell")
        .agg(F.array_sort(F.collect_list(F.struct("uid", F.col("length").cast("int").alias("length")))).alias("p"))
        .select("cell", F.col("p.uid").alias("uids"), F.col("p.length").alias("lengths"))
    )


def packed(docs: DataFrame, how: Packing = Packing()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece.

    Offsets are gapless from 0 in each sequence. Rows that repeat are separate
    documents; columns other than doc_id and text are not read. No documents, no rows.
    """
    numbered = pieces(docs, how).withColumn("uid", F.monotonically_increasing_id())
    rows = settled(numbered, "pieces")
    short = rows.where(F.col("length") < how.length).select("uid", "length")
    first = settled(_bred(_dealt(short, how, how.seed), how, how.seed), "bins")
    filled = first.groupBy("cell", "bin").agg(F.sum("length").alias("_filled"))
    loose = filled.where(F.col("_filled") < how.open_below * how.length).select("cell", "bin")
    kept = first.join(loose, ["cell", "bin"], "left_anti").select("uid", F.lit(0).alias("round"), "cell", "bin")
    again = settled(first.join(loose, ["cell", "bin"]).select("uid", "length"), "bins")
    last = _bred(_dealt(again, how, how.seed + 1), how, how.seed + 1)
    bins = kept.unionByName(last.select("uid", F.lit(1).alias("round"), "cell", "bin"))
    # Numbers: full pieces by row (negative), others by round, cell and bin.
    bins = settled(
        bins.select(
            F.col("uid").alias("_u"),
            ((F.col("cell") * 2 + F.col("round")) * (1 << 24) + F.col("bin")).alias("sequence_id"),
        ),
        "bins",
    )
    placed = rows.where(F.col("length") < how.length).join(bins, F.col("uid") == F.col("_u")).drop("_u")
    full = rows.where(F.col("length") >= how.length).withColumn("sequence_id", -1 - F.col("uid"))
    before = Window.partitionBy("sequence_id").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
    full = full.withColumn("offset", F.lit(0).cast("long"))
    return placed.unionByName(full).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
