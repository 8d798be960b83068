"""Loading accepted rows into a serving table without losing any in silence."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from intake.contracts import TableContract
from intake.functions.checksum import SUM_TYPE, row_hash
from intake.operators.dedupe import (
    BROADCAST_LIMIT,
    Duplicates,
    KeyStats,
    counts_report,
    duplicate_report,
    key_bytes,
    key_stats,
    new_rows,
)
from intake.sources.files import delete
from intake.sources.tables import Expected, ParquetTable, Table
from intake.workspace import run_dir


@dataclass(frozen=True)
class LoadResult:
    read: int
    loaded: int
    duplicates: DataFrame | None = None

    @property
    def skipped(self) -> int:
        """Rows whose key was already loaded, by this batch or an earlier one."""
        return self.read - self.loaded


def load(
    spark: SparkSession,
    batch: DataFrame,
    target: Table,
    contract: TableContract,
    batch_id: str,
    broadcast_limit: int = BROADCAST_LIMIT,
    source: str | None = None,
) -> LoadResult:
    """Append the rows of ``batch`` whose key is new; the first row of a key wins.

    Keys are settled before any row moves: a report of the keys that repeat or are
    already loaded is written to the shared folder. What was counted in it decides
    how rows are picked; a batch without such keys is appended as it is. ``batch``
    is read several times, so it should be a stored table (the staged Parquet).

    ``on_duplicate``: ``skip`` leaves repeated keys out, ``report`` also returns
    them, ``error`` refuses the whole batch. A contract without a key appends
    every row, once: a batch that a compaction or replacement holds already adds nothing.

    ``source`` says where the rows come from (their checksum, if not given). A batch id
    belongs to one source: the same batch may come again and replaces itself, other rows
    under its id are refused. One load at a time holds the target.
    """
    with target.writing(spark, batch_id):
        if not contract.key:
            target.claim(spark, batch_id, source or _rows_source(Expected.of(batch)))
            if target.settled(spark, batch_id):
                return LoadResult(batch.count(), 0)
            n = target.append(batch, batch_id)
            return LoadResult(n, n)
        return _load_keyed(spark, batch, target, contract, batch_id, broadcast_limit, source)


def _rows_source(found: Expected) -> str:
    return f"rows:{found.n_rows}:{found.checksum}"


def _load_keyed(
    spark: SparkSession,
    batch: DataFrame,
    target: Table,
    contract: TableContract,
    batch_id: str,
    broadcast_limit: int,
    source: str | None,
) -> LoadResult:
    key = contract.key
    folder = run_dir(spark, f"duplicates-{contract.name}")
    if target.empty(spark, batch_id):
        # Nothing to compare with: one scan gives the repeated keys and all that is measured.
        stats, duplicates = _store_repeats(spark, batch, key, folder, source is None)
    elif isinstance(target, ParquetTable) and target.sketched:
        stats, duplicates = _store_suspected(spark, batch, target, key, batch_id, folder, broadcast_limit, source is None)
    else:
        stats = key_stats(batch, key, identify=source is None)
        existing = target.rows(spark, except_batch=batch_id)
        report = duplicate_report(batch, existing, key, stats, broadcast_limit)
        duplicates = None if stats.n_null else _store(spark, report, key, folder)
    if stats.n_null:
        raise ValueError(f"{contract.name}: {stats.n_null} rows without a key")
    target.claim(spark, batch_id, source or _rows_source(Expected(stats.n_rows, stats.checksum)))
    wanted = contract.on_duplicate == "report"
    try:
        if duplicates.n_keys and contract.on_duplicate == "error":
            raise ValueError(
                f"{contract.name}: {duplicates.n_keys} keys repeat or are already loaded"
            )
        fresh = new_rows(batch, duplicates, key, contract.order_by, stats.n_rows, broadcast_limit)
        loaded = target.append(fresh, batch_id)
    finally:
        if not wanted:
            delete(spark, folder)
    return LoadResult(stats.n_rows, loaded, duplicates.keys if wanted else None)


def _store(
    spark: SparkSession, report: DataFrame, key: Sequence[str], path: str
) -> Duplicates:
    seen = Observation()
    report.observe(seen, *Duplicates.counts(report, key)).write.parquet(path)
    return Duplicates(spark.read.schema(report.schema).parquet(path), **seen.get)


def _store_suspected(
    spark: SparkSession,
    batch: DataFrame,
    target: ParquetTable,
    key: Sequence[str],
    batch_id: str,
    folder: str,
    limit: int,
    identify: bool,
) -> tuple[KeyStats, Duplicates | None]:
    """The report where the target has sketches: only folders that may hold a key of the batch are opened.

    Keys are counted once and written, next to the report; the sketches are asked for those, and what they cannot
    rule out is written, too, and counted by folder. In most loads that is nothing.
    """
    stats = key_stats(batch, key, identify=identify)
    if stats.n_null:
        return stats, None
    counted = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("n_in_batch"))
    counted.write.parquet(f"{folder}/keys")
    counts = spark.read.schema(counted.schema).parquet(f"{folder}/keys")
    found, unsketched = target.suspects(counts.select(*key), key, batch_id, stats.n_bytes, limit)
    asked, opened = (counts, stats.n_bytes), list(unsketched)
    if found is not None:
        seen = Observation()
        size = F.coalesce(F.sum(key_bytes(found, key)), F.lit(0)).alias("bytes")
        # Names of folders, of which the listing has all.
        names = F.collect_set("_batch").alias("batches")
        found.observe(seen, size, names).write.parquet(f"{folder}/suspects")
        opened += seen.get["batches"]
        if not unsketched:
            asked = spark.read.schema(found.schema).parquet(f"{folder}/suspects").select(*key).distinct(), seen.get["bytes"]
    keys, n_bytes = asked
    existing = target.rows_of(spark, opened) if opened else None
    report = counts_report(counts, existing, key, stats, keys if n_bytes <= limit else None)
    return stats, _store(spark, report, key, f"{folder}/report")


def _store_repeats(
    spark: SparkSession, batch: DataFrame, key: Sequence[str], path: str, identify: bool
) -> tuple[KeyStats, Duplicates]:
    """The report of a batch by itself, and its figures, observed behind the shuffle."""
    total = F.sum(row_hash(batch).cast(SUM_TYPE)) if identify else F.lit(0).cast(SUM_TYPE)
    counts = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("n_in_batch"), total.alias("_sum"))
    without = reduce(or_, [F.col(c).isNull() for c in key])
    every, seen = Observation(), Observation()
    counts = counts.observe(
        every,
        F.coalesce(F.sum("n_in_batch"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(without, F.col("n_in_batch"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum("_sum"), F.lit(0).cast(SUM_TYPE)).cast(SUM_TYPE).alias("sum"),
    )
    report = counts.where("n_in_batch > 1").select(
        *key, "n_in_batch", F.lit(False).alias("in_target")
    )
    report.observe(seen, *Duplicates.counts(report, key)).write.parquet(path)
    found = every.get
    stats = KeyStats(found["n"], found["n_null"], 0, {}, found["sum"] if identify else None)
    return stats, Duplicates(spark.read.schema(report.schema).parquet(path), **seen.get)
