"""Token counts by a scan for end-of-document ids in flat token files without an index.

A flat file is token ids of fixed width, one after the other, an end id after each
document. Files are read in blocks of bounded size. Each block is searched for end ids as
one array; what a block cannot know, where its first document began and how many came
before, is stitched on by prefix scans over the blocks' sums: first over groups of blocks, then
within each group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from intake.llm.common import settled
from intake.llm.packing import Encoder
from intake.workspace import run_dir

BLOCKS = "file string, block long, data binary"


@dataclass(frozen=True)
class Flat:
    """``end`` closes a document; ids have ``width`` bytes, little-endian; ``block`` ids are
    read at a time, ``group`` blocks scanned together."""

    end: int = 50256
    width: int = 2
    block: int = 1 << 16
    group: int = 4096
    vocabulary: str | None = None

    @property
    def dtype(self) -> str:
        return f"<u{self.width}"


def write_flat(docs: DataFrame, path: str, how: Flat = Flat()) -> None:
    """Tokenises ``docs`` (doc_id, text) to flat files under ``path``, one a task.

    A file is stored as its blocks, (file, block, data), so that any file system Spark
    writes to will do; data in order of blocks is the file, byte for byte. Beside the
    files stands which documents each holds, in order (file, first, doc_ids). Null and empty texts
    are an end id alone. The end id's own string in a text is tokenised as plain text.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = Encoder(how.vocabulary), how.block * how.width
        name, number, first, waiting, ids = f"{TaskContext.get().partitionId():06d}", 0, 0, bytearray(), []

        def rows(blocks: list[bytes], ids: list) -> pa.RecordBatch:
            n, at = len(blocks), number
            columns = [
                pa.array([name] * (n + bool(ids)), pa.string()),
                pa.array([*range(at, at + n), *([first] if ids else [])], pa.int64()),
                pa.array([*blocks, *([None] if ids else [])], pa.binary()),
                pa.array([*([None] * n), *([ids] if ids else [])], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["file", "block", "data", "doc_ids"])

        for part in parts:
            ids, blocks = part.column(0).to_pylist(), []
            for text in part.column(1):
                tokens = np.array([*encoder.plain(text.as_py()), how.end])
                if tokens.max() >= 1 << 8 * how.width:
                    raise ValueError(f"a token id does not fit in {how.width} bytes")
                waiting += tokens.astype(how.dtype).tobytes()
                while len(waiting) >= size:
                    blocks.append(bytes(waiting[:size]))
                    del waiting[:size]
            yield rows(blocks, ids)
            number, first = number + len(blocks), first + len(ids)
        if waiting:
            yield rows([bytes(waiting)], [])

    shape = f"{BLOCKS}, doc_ids array<long>"
    made = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batches, shape)
    made = made.withColumn("kind", F.when(F.col("data").isNull(), "documents").otherwise("blocks"))
    made.write.partitionBy("kind").option("compression", "zstd").parquet(path)


def _stored(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(f"{BLOCKS}, doc_ids array<long>, kind string").parquet(path).where(F.col("kind") == kind)


def stored_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks that ``write_flat`` has written."""
    return _stored(spark, path, "blocks").select("file", "block", "data")


def stored_documents(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``ordinal``, ``doc_id`` of the documents that ``write_flat`` has written."""
    rows = _stored(spark, path, "documents").select("file", "block", F.posexplode("doc_ids").alias("i", "doc_id"))
    return rows.select("file", (F.col("block") + F.col("i")).alias("ordinal"), "doc_id")


def file_blocks(spark: SparkSession, path: str, how: Flat = Flat()) -> DataFrame:
    """Blocks of plain binary files, of up to 2 GB each, which is what Spark's reader of binary files takes."""
    size = how.block * how.width

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, content in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                data = memoryview(content.as_buffer())
                for block, at in enumerate(range(0, len(data), size)):
                    columns = [[name], [block], [bytes(data[at : at + size])]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary()), strict=True)],
                        names=["file", "block", "data"],
                    )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(cut, BLOCKS)


def _searched(blocks: DataFrame, how: Flat) -> DataFrame:
    """``size`` and ``ends`` (places of end ids) of each block."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes, ends = [], []
            for data in part.column(2):
                ids = np.frombuffer(data.as_buffer(), how.dtype) if data.is_valid else np.zeros(0, how.dtype)
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == how.end))
            columns = [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(ends, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "size", "ends"])

    return blocks.select("file", "block", "data").mapInArrow(batches, "file string, block long, size long, ends array<long>")


def token_counts(blocks: DataFrame, how: Flat = Flat()) -> DataFrame:
    """``file``, ``ordinal``, ``start`` (its first id's place), ``n_tokens``, ``closed`` of each document.

    n_tokens is without the end id. Ids after a file's last end are a document that is not
    closed. Blocks are numbered from 0 in each file and all but the last of a file are full or not,
    as they come; a null or empty block holds no ids. Files without ids have no documents.
    """
    found = settled(_searched(blocks, how), "ends")
    rows = found.select(
        "file", "block", F.floor(F.col("block") / how.group).alias("grp"), "size", F.size("ends").cast("long").alias("n"),
        F.try_element_at("ends", F.lit(-1)).alias("last"),
    )
    # Within a group: places count from the group's first id.
    inside = Window.partitionBy("file", "grp").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summed = lambda name, window: F.coalesce(F.sum(name).over(window), F.lit(0))
    rows = rows.withColumn("at", summed("size", inside)).withColumn("before", summed("n", inside))
    rows = rows.withColumn("last", F.col("at") + F.col("last")).withColumn("prior", F.max("last").over(inside))
    # Across groups: what each adds to its blocks' places.
    groups = rows.groupBy("file", "grp").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.max("last").alias("last"))
    across = Window.partitionBy("file").orderBy("grp").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("g_at", summed("size", across)).withColumn("g_before", summed("n", across))
    groups = groups.withColumn("g_prior", F.max(F.col("g_at") + F.col("last")).over(across))
    stitched = settled(
        rows.join(groups.select("file", "grp", "g_at", "g_before", "g_prior"), ["file", "grp"]).select(
            "file",
            "block",
            (F.col("g_at") + F.col("at")).alias("at"),
            (F.col("g_before") + F.col("before")).alias("before"),
            F.coalesce(F.col("g_at") + F.col("prior"), F.col("g_prior"), F.lit(-1)).alias("prior"),
        ),
        "stitched",
    )
    # Each end with the one before it; a block's first one follows an earlier block's last.
    ends = F.transform("ends", lambda e: F.col("at") + e)
    begins = F.concat(F.array("prior"), F.slice(ends, 1, F.greatest(F.size("ends") - 1, F.lit(0))))
    each = found.where(F.size("ends") > 0).join(stitched, ["file", "block"]).select(
        "file", "before", F.posexplode(F.arrays_zip(begins.alias("a"), ends.alias("b"))).alias("i", "x")
    )
    start = F.col("x.a") + 1
    closed = each.select(
        "file",
        (F.col("before") + F.col("i")).alias("ordinal"),
        start.alias("start"),
        (F.col("x.b") - start).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    ends = rows.groupBy("file").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    last = groups.groupBy("file").agg(F.max(F.col("g_at") + F.col("last")).alias("last"))
    first = F.coalesce("last", F.lit(-1)) + 1
    open_ = ends.join(last, "file").select(
        "file", F.col("n").alias("ordinal"), first.alias("start"), (F.col("size") - first).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(open_.where("n_tokens > 0"))


def document_tokens(docs: DataFrame, how: Flat = Flat()) -> DataFrame:
    """doc_id, file, ordinal, start, n_tokens of each row of ``docs``, counted from its flat files."""
    spark = docs.sparkSession
    path = run_dir(spark, "tokens")
    write_flat(docs, path, how)
    counts = token_counts(stored_blocks(spark, path), how)
    return counts.join(stored_documents(spark, path), ["file", "ordinal"]).select(
        "doc_id", "file", "ordinal", "start", "n_tokens"
    )
