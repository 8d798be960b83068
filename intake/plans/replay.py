"""Bringing rejected rows back after a contract, or a dimension it refers to, has changed."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from intake.contracts import contract_for
from intake.plans.audit import OK
from intake.plans.ingest import IngestResult, Intake, ingest_batch
from intake.sources.staged import claim_rejected, end_replay, read_rejected

STEP = "replay"


def replay(spark: SparkSession, table: str, intake: Intake, batch_id: str) -> IngestResult | None:
    """Judge a table's rejected rows again, under the present contract, as a batch of their own.

    Rows that fit now are loaded, the others stay in the quarantine, under this batch's name. Every batch that was
    loaded and has rejected rows is claimed first, by a note that only one replay can write, so each row
    is replayed once; rows that this one rejects can be replayed by a later one. Batches that were
    refused as a whole are not: their id is free for the corrected file. None if there is nothing to replay.

    Safe to repeat: a replay that died claims the same batches again, goes on, and replaces what it wrote. Until
    it has ended the quarantine shows the rows where they were.

    The names of the batches go through the driver, as they do in any listing of the staged folder.
    """
    contract = contract_for(intake.contracts, table)
    log = intake.audit.read(spark).where((F.col("table_name") == table) & (F.col("status") == OK))
    candidates = log.where(F.col("step").isin("ingest", STEP) & (F.col("rejected") > 0)).select("batch_id").distinct()
    mine = claim_rejected(
        spark, intake.staged_root, contract, sorted(r["batch_id"] for r in candidates.collect()), batch_id
    )
    if not mine:
        return None
    done = ingest_batch(
        spark,
        read_rejected(spark, intake.staged_root, contract, mine),
        contract,
        intake,
        batch_id,
        require_rows=False,
        source="replay:" + hashlib.sha256("\n".join(mine).encode()).hexdigest(),
        step=STEP,
    )
    end_replay(spark, intake.staged_root, contract, batch_id)
    return done
