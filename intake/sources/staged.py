"""Staged rows: Parquet under ``<root>/<table>/batch_id=<b>/verdict=<v>``.

One write holds both accepted and rejected rows, told apart by directory, so a
landing file is scanned once and a reader of one kind never opens the other.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.contracts import TableContract
from intake.operators.rules import CORRUPT
from intake.operators.validate import ACCEPTED, RAW_LINE, REASONS, REJECTED, VERDICT, count_columns
from intake.sources.files import create, names, read_text
from intake.sources.tables import batch_path

BATCH = "batch_id"


@dataclass(frozen=True)
class StageCounts:
    scanned: int = 0
    accepted: int = 0
    rejected: int = 0
    violations: dict[str, int] = field(default_factory=dict)


def stage(
    annotated: DataFrame, root: str, contract: TableContract, batch_id: str
) -> StageCounts:
    """Write one annotated batch; replaces an earlier attempt at the same batch.

    The counts are observed in the write itself. It is the job's last stage, where
    Spark counts each task's contribution once even if the task is run again.
    """
    seen = Observation()
    rows = annotated.observe(seen, *count_columns(contract))
    if contract.on_violation == "drop":
        rows = rows.where(F.col(VERDICT) == ACCEPTED)
    kept = [c for c in (CORRUPT, REASONS, VERDICT) if c in annotated.columns]
    writer = rows.select(*contract.columns, *kept).write.mode("overwrite").partitionBy(VERDICT)
    if contract.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", contract.max_records_per_file)
    writer.parquet(batch_path(f"{root}/{contract.name}", batch_id))
    counts = seen.get
    return StageCounts(
        counts["scanned"],
        counts["accepted"],
        counts["rejected"],
        {reason: counts[reason] for reason, _ in contract.checks},
    )


def _notes(root: str, contract: TableContract) -> str:
    return f"{root}/{contract.name}.meta"


def claim_rejected(spark: SparkSession, root: str, contract: TableContract, batches: Iterable[str], replay: str) -> list[str]:
    """Of ``batches`` those whose rejected rows are this replay's; each goes to the first replay that asks.

    What a replay has claimed once is all it gets: batches that came later are for the next one.
    """
    folder = f"{_notes(root, contract)}/replayed"
    mine = [b for b in names(spark, folder) if replay_of(spark, root, contract, b) == replay]
    return mine or [b for b in batches if b != replay and create(spark, f"{folder}/{b}", replay)]


def replay_of(spark: SparkSession, root: str, contract: TableContract, batch_id: str) -> str | None:
    """The replay that took a batch's rejected rows, if any."""
    return read_text(spark, f"{_notes(root, contract)}/replayed/{batch_id}")


def end_replay(spark: SparkSession, root: str, contract: TableContract, replay: str) -> None:
    """From here on the rows that a replay rejected again stand for those that it took."""
    create(spark, f"{_notes(root, contract)}/replays/{replay}", replay)


def _hidden(spark: SparkSession, root: str, contract: TableContract) -> list[str]:
    """Batches whose rejected rows stand elsewhere: replayed ones, and replays that have not ended."""
    claimed = {b: replay_of(spark, root, contract, b) for b in names(spark, f"{_notes(root, contract)}/replayed")}
    ended = set(names(spark, f"{_notes(root, contract)}/replays"))
    return sorted({b for b, r in claimed.items() if r in ended} | ({*claimed.values()} - ended))


def _read(
    spark: SparkSession, root: str, contract: TableContract, verdict: str, batches: Sequence[str] | None
) -> DataFrame:
    schema = contract.landing_schema
    schema = schema.add(CORRUPT, T.StringType()).add(REASONS, T.ArrayType(T.StringType()))
    schema = schema.add(BATCH, T.StringType()).add(VERDICT, T.StringType())
    base = f"{root}/{contract.name}"
    paths = [base] if batches is None else [batch_path(base, b) for b in batches]
    rows = spark.read.schema(schema).option("basePath", base).parquet(*paths)
    return rows.where(F.col(VERDICT) == verdict)


def read_staged(
    spark: SparkSession, root: str, contract: TableContract, batch_id: str | None = None
) -> DataFrame:
    """Accepted rows of one batch, or of all batches."""
    batches = None if batch_id is None else [batch_id]
    return _read(spark, root, contract, ACCEPTED, batches).select(*contract.columns)


def read_quarantine(
    spark: SparkSession, root: str, contract: TableContract, batch_id: str | None = None
) -> DataFrame:
    """Rejected rows with their reasons, and the raw line where a rule asked for it.

    Of all batches each row once: where rows were replayed, those that were rejected again stand in the replay.
    """
    rows = _read(spark, root, contract, REJECTED, None if batch_id is None else [batch_id])
    if batch_id is None and (hidden := _hidden(spark, root, contract)):
        rows = rows.where(~F.col(BATCH).isin(hidden))
    raw = [F.col(CORRUPT).alias(RAW_LINE)] if contract.wants_raw_line else []
    return rows.select(*contract.columns, *raw, REASONS)


def read_rejected(spark: SparkSession, root: str, contract: TableContract, batches: Sequence[str]) -> DataFrame:
    """Rejected rows of some batches as they were read from the landing files, to be judged again."""
    raw = [CORRUPT] if contract.wants_raw_line else []
    return _read(spark, root, contract, REJECTED, batches).select(*contract.columns, *raw)
