"""Sketches of keys: which of them a batch that was loaded earlier cannot hold.

A sketch is a Bloom filter cut into blocks, one row a block, each a bitmap of Spark's own size: a
key belongs to one block and sets ``MARKS`` places in it. With at most ``KEYS_A_BLOCK`` keys a
block (128 places a key) about one absent key in a million is taken for a held one, so a
sketch only ever says "not held" or "look". Blocks are built and asked by joins and
aggregates on (number of blocks, block); no sketch is ever whole in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES = 32768  # of Spark's bitmap_construct_agg
BLOCK_BYTES = PLACES // 8
MARKS = 4
KEYS_A_BLOCK = 256
LEAST_BLOCKS = 16

SKETCH_SCHEMA = T.StructType(
    [
        T.StructField("_batch", T.StringType()),
        T.StructField("_n_blocks", T.LongType()),
        T.StructField("_block", T.LongType()),
        T.StructField("_bits", T.BinaryType()),
    ]
)


def blocks_for(n_keys: int) -> int:
    """Blocks that so many keys need: a power of four, so that few numbers occur in one table."""
    n = LEAST_BLOCKS
    while n * KEYS_A_BLOCK < n_keys:
        n *= 4
    return n


def _hashes(key: Sequence[str]) -> list[Column]:
    """Two hashes of a key: one for its block, one for its places there."""
    return [F.xxhash64(*key).alias("_hash"), F.xxhash64(F.lit(1), *key).alias("_marks")]


def _places(marks: Column) -> list[Column]:
    return [F.shiftrightunsigned(marks, 15 * i).bitwiseAND(F.lit(PLACES - 1)) for i in range(MARKS)]


def key_sketch(keys: DataFrame, key: Sequence[str], batch: str, n_blocks: int) -> DataFrame:
    """The sketch of a batch's keys, ``SKETCH_SCHEMA``: a row for each block that has any.

    The hashes are shuffled, 16 bytes a key, not the bitmaps that each task could make of its own keys.
    """
    hashed = keys.select(*_hashes(key))
    dealt = hashed.select(F.pmod("_hash", F.lit(n_blocks)).alias("_block"), "_marks").repartition("_block")
    marked = dealt.select("_block", F.explode(F.array(*_places(F.col("_marks")))).alias("_place"))
    bits = marked.groupBy("_block").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    head = [F.lit(batch).alias("_batch"), F.lit(n_blocks).cast("long").alias("_n_blocks")]
    return bits.select(*head, "_block", "_bits")


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def suspects(
    keys: DataFrame,
    sketches: DataFrame,
    key: Sequence[str],
    sizes: Sequence[int],
    broadcast_keys: bool = False,
    broadcast_sketches: bool = False,
) -> DataFrame:
    """The keys that a sketched batch may hold, with that batch as ``_batch``.

    ``sizes`` are the numbers of blocks that occur in ``sketches``. Every key that a batch holds is
    among them; a key that none holds nearly never.
    """
    asked = keys.select(*key, *_hashes(key)).withColumn("_n_blocks", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])))
    asked = asked.select(*key, "_marks", "_n_blocks", F.pmod("_hash", "_n_blocks").alias("_block"))
    if broadcast_sketches:
        sketches = F.broadcast(sketches)
    elif broadcast_keys:
        asked = F.broadcast(asked)
    met = asked.join(sketches, ["_n_blocks", "_block"])
    found = reduce(and_, [_is_set(F.col("_bits"), place) for place in _places(F.col("_marks"))])
    return met.where(found).select(*key, "_batch")
