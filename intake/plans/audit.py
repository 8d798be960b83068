"""The audit log: one row per run, whether it succeeded or not."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.sources.files import delete, exists, names, rename
from intake.sources.local import rows_frame

SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("scanned", T.LongType()),
        T.StructField("accepted", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("loaded", T.LongType()),
        T.StructField("skipped", T.LongType()),
        T.StructField("violations", T.MapType(T.StringType(), T.LongType())),
        T.StructField("schema_json", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("day", T.StringType()),
    ]
)

OK = "ok"
FAILED = "failed"


class AuditLog:
    """Append-only Parquet log, by day. Rows are never changed, attempts add up.

    Every entry is a folder of its own, so that runs at the same time do not meet.
    """

    def __init__(self, path: str):
        self.path = path

    def append(self, spark: SparkSession, row: dict) -> None:
        self._write(rows_frame(spark, [row], SCHEMA), row["day"])

    def refusals(self, spark: SparkSession, files: DataFrame, batch_id: str) -> None:
        """A failed ``gate`` row for each of ``files`` (path, table_name, verdict)."""
        now = datetime.now(UTC)
        known = {
            "run_id": F.expr("uuid()"),
            "step": F.lit("gate"),
            "table_name": F.col("table_name"),
            "batch_id": F.lit(batch_id),
            "status": F.lit(FAILED),
            "started_at": F.lit(now),
            "finished_at": F.lit(now),
            "error": F.concat("verdict", F.lit(": "), "path"),
            "day": F.lit(now.strftime("%Y-%m-%d")),
        }
        rows = files.select(
            *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMA]
        )
        self._write(rows, now.strftime("%Y-%m-%d"))

    def _write(self, rows: DataFrame, day: str) -> None:
        rows.drop("day").write.parquet(f"{self.path}/day={day}/entry={uuid.uuid4().hex}")

    def read(self, spark: SparkSession) -> DataFrame:
        if not exists(spark, self.path):
            return rows_frame(spark, [], SCHEMA)
        schema = T.StructType(list(SCHEMA.fields)).add("entry", T.StringType())
        return spark.read.schema(schema).parquet(self.path).drop("entry")

    def compact(self, spark: SparkSession, day: str) -> None:
        """Gather a past day's entries, a file each, in one; for a day that is over."""
        folder = f"{self.path}/day={day}"
        entries = names(spark, folder)
        if len(entries) > 1:
            schema = T.StructType([f for f in SCHEMA if f.name != "day"])
            rows = spark.read.schema(schema).parquet(*[f"{folder}/{e}" for e in entries])
            new = f"{self.path}/_compacting-{uuid.uuid4().hex}"
            rows.coalesce(1).write.parquet(new)
            rename(spark, new, f"{folder}/entry={uuid.uuid4().hex}")
            for entry in entries:
                delete(spark, f"{folder}/{entry}")

    @contextmanager
    def run(self, spark: SparkSession, step: str, table: str, batch_id: str) -> Iterator[dict]:
        """Record the block: the caller fills in counts; an exception is noted
        as a failed run and then raised again."""
        started = datetime.now(UTC)
        row = {
            "run_id": uuid.uuid4().hex,
            "step": step,
            "table_name": table,
            "batch_id": batch_id,
            "status": OK,
            "day": started.strftime("%Y-%m-%d"),
            "started_at": started,
        }
        try:
            yield row
        except Exception as error:
            row |= {"status": FAILED, "error": f"{type(error).__name__}: {error}"}
            raise
        finally:
            row["finished_at"] = datetime.now(UTC)
            self.append(spark, row)


def latest_attempts(log: DataFrame) -> DataFrame:
    """The last attempt at each (step, table, batch).

    A stream may run a batch again after a crash; only its last attempt counts.
    """
    newest = Window.partitionBy("step", "table_name", "batch_id").orderBy(
        F.desc("started_at"), "run_id"
    )
    return (
        log.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
    )


def load_report(log: DataFrame) -> DataFrame:
    """Runs and rows per table, day and outcome.

    Outcomes are ``scanned``, ``accepted``, ``rejected``, ``loaded``, ``skipped``
    and one per reason of rejection; failed attempts count as ``failed`` runs.
    """
    totals = ["scanned", "accepted", "rejected", "loaded", "skipped"]
    pairs = [x for t in totals for x in (F.lit(t), F.coalesce(t, F.lit(0)))]
    none = F.create_map().cast("map<string,bigint>")
    done = (
        latest_attempts(log)
        .where(F.col("status") == OK)
        .select(
            "table_name",
            "day",
            F.explode(
                F.map_concat(F.create_map(*pairs), F.coalesce("violations", none))
            ).alias("outcome", "n"),
        )
    )
    failed = log.where(F.col("status") == FAILED).select(
        "table_name", "day", F.lit(FAILED).alias("outcome"), F.lit(0).cast("bigint").alias("n")
    )
    return (
        done.unionByName(failed)
        .groupBy("table_name", "day", "outcome")
        .agg(F.count(F.lit(1)).alias("n_runs"), F.sum("n").alias("n_rows"))
    )
