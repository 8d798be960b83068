"""From a landing file to the serving table, in one recorded run."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.contracts import TableContract, by_name, contract_for
from intake.operators.validate import annotate, assert_clean, assert_not_empty, typed
from intake.plans.audit import AuditLog
from intake.plans.load import LoadResult, load
from intake.sources.landing import (
    check_key,
    check_width,
    list_landing,
    read_landing,
    refused,
    source_of,
    taken_by,
)
from intake.sources.ledger import FileLedger, exactly
from intake.sources.staged import StageCounts, read_staged, replay_of, stage
from intake.sources.tables import Expected, Table, claim, unclaim


@dataclass(frozen=True)
class IngestResult:
    batch_id: str
    staged: StageCounts
    load: LoadResult


@dataclass(frozen=True)
class Intake:
    """The places an ingest works with: contracts, staging root, targets, log."""

    contracts: Mapping[str, TableContract]
    staged_root: str
    targets: Mapping[str, Table]
    audit: AuditLog

    @staticmethod
    def of(
        contracts: Iterable[TableContract],
        staged_root: str,
        targets: Mapping[str, Table],
        audit_path: str,
    ) -> Intake:
        return Intake(by_name(contracts), staged_root, targets, AuditLog(audit_path))


def validate(
    landing: DataFrame, contract: TableContract, staged_root: str, batch_id: str
) -> StageCounts:
    """Check a batch and stage it, in one scan of the landing rows.

    ``on_violation="fail"`` counts first and stages nothing if a row is bad, which
    costs a second scan.
    """
    if contract.on_violation == "fail":
        assert_clean(landing, contract)
    return stage(annotate(landing, contract), staged_root, contract, batch_id)


def ingest_batch(
    spark: SparkSession,
    landing: DataFrame,
    contract: TableContract,
    intake: Intake,
    batch_id: str,
    require_rows: bool = True,
    source: str | None = None,
    step: str = "ingest",
) -> IngestResult:
    """Validate, stage and load one batch, and log it as ``step``. Safe to repeat.

    ``source`` says where the rows come from (their checksum, if not given): a batch id
    that belongs to another source is refused before anything is written. A batch that is
    refused itself frees its id, so that the corrected rows can come under it. Once its rejected
    rows were replayed a batch does not come again: they would arrive twice under a changed contract.
    """
    with intake.audit.run(spark, step, contract.name, batch_id) as row:
        row["schema_json"] = contract.table_schema.json()
        if replay := replay_of(spark, intake.staged_root, contract, batch_id):
            raise ValueError(f"{contract.name}: the rejected rows of batch {batch_id!r} were replayed by {replay!r}")
        if source is None:
            found = Expected.of(landing)
            source = f"rows:{found.n_rows}:{found.checksum}"
        claims = f"{intake.staged_root}/{contract.name}.meta"
        new = claim(spark, claims, batch_id, source)
        try:
            counts = validate(landing, contract, intake.staged_root, batch_id)
            row |= {
                "scanned": counts.scanned,
                "accepted": counts.accepted,
                "rejected": counts.rejected,
                "violations": counts.violations,
            }
            if require_rows:
                assert_not_empty(counts.accepted, contract)
        except Exception:
            if new:
                unclaim(spark, claims, batch_id)
            raise
        rows = typed(read_staged(spark, intake.staged_root, contract, batch_id), contract)
        done = load(spark, rows, intake.targets[contract.name], contract, batch_id, source=source)
        row |= {"loaded": done.loaded, "skipped": done.skipped}
    return IngestResult(batch_id, counts, done)


def ingest_file(
    spark: SparkSession, path: str, intake: Intake, batch_id: str, parity: bool = False
) -> IngestResult:
    """Ingest one landing file; its name says which table it belongs to.

    A refused name, a missing file or a wrong column count is logged as a failed run, too.
    """
    table = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        table = check_key(spark, path, intake.contracts, parity)
        contract = contract_for(intake.contracts, table)
        check_width(spark, path, contract)
        source = source_of(list_landing(spark, path))
    except Exception:
        with intake.audit.run(spark, "gate", table, batch_id):
            raise
    landing = read_landing(spark, path, contract)
    return ingest_batch(spark, landing, contract, intake, batch_id, source=source)


def ingest_folder(
    spark: SparkSession, folder: str, intake: Intake, batch_id: str, parallel: int = 4
) -> dict[str, IngestResult]:
    """Ingest every declared table's files below a folder, one batch per table.

    Files that no contract takes are logged as failed runs, one row each. Up to
    ``parallel`` tables are ingested at once; if one fails, the others still finish.
    """
    no = refused(list_landing(spark, folder), intake.contracts)
    if not no.isEmpty():
        intake.audit.refusals(spark, no, batch_id)

    def one(contract: TableContract) -> IngestResult:
        return ingest_batch(
            spark,
            read_landing(spark, folder, contract, contract.glob),
            contract,
            intake,
            batch_id,
            require_rows=False,
            source=source_of(list_landing(spark, folder, contract.glob)),
        )

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        run = inheritable_thread_target(spark)(one)
        runs = {name: pool.submit(run, c) for name, c in intake.contracts.items()}
    return {name: done.result() for name, done in runs.items()}


def ingest_new(
    spark: SparkSession, folder: str, intake: Intake, ledger: FileLedger, batch_id: str, parallel: int = 4
) -> dict[str, IngestResult]:
    """Ingest what has arrived below a folder since the ledger's last batch, one batch per table.

    Files are new or uploaded again; the folder is listed once for all tables, and files already taken are
    not read. Tables without a new file have no run and no result. Files that no contract takes are logged once,
    when they arrive. Safe to repeat: a batch that has not ended goes on with the files it took, one that has
    ended takes nothing more. If a table fails the others still finish, the batch stays open, and the error is raised.

    The paths of one batch's files go through the driver, as they do in any read of a folder.
    """
    listed = list_landing(spark, folder).withColumn("table_name", taken_by(spark, intake.contracts))
    files = ledger.take(spark, listed, batch_id)
    if ledger.ended(spark, batch_id):
        return {}
    no = refused(files.where("table_name IS NULL"), intake.contracts)
    found = files.where("table_name IS NOT NULL").groupBy("table_name").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    paths = {row["table_name"]: [exactly(p) for p in row["paths"]] for row in found.collect()}

    def one(contract: TableContract) -> IngestResult:
        return ingest_batch(
            spark,
            read_landing(spark, paths[contract.name], contract),
            contract,
            intake,
            batch_id,
            require_rows=False,
            source=source_of(files.where(F.col("table_name") == contract.name)),
        )

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        run = inheritable_thread_target(spark)(one)
        runs = {name: pool.submit(run, c) for name, c in intake.contracts.items() if name in paths}
    results = {name: done.result() for name, done in runs.items()}
    if not no.isEmpty():
        intake.audit.refusals(spark, no, batch_id)
    ledger.end(spark, batch_id)
    return results
