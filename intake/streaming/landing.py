"""Structured Streaming over a landing folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from intake.contracts import TableContract
from intake.plans.ingest import Intake, ingest_batch
from intake.sources.files import read_text
from intake.sources.landing import refused, stream_landing, stream_listing


def ingest_stream(
    spark: SparkSession,
    folder: str,
    contract: TableContract,
    intake: Intake,
    checkpoint: str,
    max_files: int | None = None,
    every: str | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Ingest new files of one table; each micro-batch is one ``ingest_batch``.

    Without ``every`` the query takes what is there and stops. Spark may run a
    micro-batch again after a crash: its batch id is made of the stream's own id, which
    lives in the checkpoint, and the epoch. So the repeat overwrites the first attempt instead of
    adding to it, and a stream with another checkpoint never takes its place.
    """

    def run(batch: DataFrame, epoch: int) -> None:
        stream = stream_id(batch.sparkSession, checkpoint)
        ingest_batch(
            batch.sparkSession,
            batch,
            contract,
            intake,
            f"{contract.name}-{stream}-{epoch:010d}",
            require_rows=False,
            source=f"stream:{stream}:{epoch}",
        )

    writer = (
        stream_landing(spark, folder, contract, max_files, archive)
        .writeStream.queryName(f"ingest_{contract.name}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(run)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave a stream when its checkpoint was made."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def log_refusals(
    spark: SparkSession, folder: str, intake: Intake, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Log the files that arrive and that no contract takes, one failed run each.

    Runs beside the tables' streams, which see their own files only.
    """

    def run(files: DataFrame, epoch: int) -> None:
        no = refused(files, intake.contracts)
        if not no.isEmpty():
            stream = stream_id(files.sparkSession, checkpoint)
            intake.audit.refusals(files.sparkSession, no, f"gate-{stream}-{epoch:010d}")

    writer = (
        stream_listing(spark, folder)
        .writeStream.queryName("refused_files")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(run)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
