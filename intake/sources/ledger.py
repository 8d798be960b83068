"""Which landing files were taken: a stored listing, and what a folder holds beyond it.

A file is its path, length and time, so one that is uploaded again under its name is a new
file, as it is for a trigger on every object that arrives. (One of the same length within the clock's
step of its file system cannot be told apart.) The listing of all tables is one table of Parquet; comparing
it with the folder is one join of two listings.

Files are taken by a batch before any of their rows is loaded. Until that batch has ended no other one
begins, and the batch itself, run again, gets the files it took: so a run that died is
gone on with, and no file is loaded under two ids.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.sources.files import create, delete, names
from intake.sources.tables import ParquetTable, batch_path

IDENTITY = ("path", "length", "modificationTime")

TAKEN = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("taken_by", T.StringType()),
    ]
)


@dataclass(frozen=True)
class FileLedger:
    """The files taken so far, in ``path``; one ledger to a landing folder."""

    path: str

    @property
    def table(self) -> ParquetTable:
        return ParquetTable(self.path, TAKEN, ("path",))

    def _open(self) -> str:
        return f"{self.path}.meta/open"

    def taken(self, spark: SparkSession, batch_id: str | None = None) -> DataFrame:
        """All files, or those of one batch."""
        rows = self.table.rows(spark)
        return rows if batch_id is None else rows.where(F.col("taken_by") == batch_id)

    def fresh(self, spark: SparkSession, files: DataFrame) -> DataFrame:
        """Of listed files those that no batch has taken as they are now."""
        return files.join(self.taken(spark).select(*IDENTITY), list(IDENTITY), "left_anti")

    def take(self, spark: SparkSession, files: DataFrame, batch_id: str) -> DataFrame:
        """The batch's files: those it has already, otherwise the fresh ones of ``files``.

        ``files`` have path, length, modificationTime and table_name (null: no contract's). A batch that
        has ended takes nothing more. While another one has not, this one is refused.
        """
        batch_path("", batch_id)
        with self.table.writing(spark, batch_id):
            others = [b for b in names(spark, self._open()) if b != batch_id]
            if others:
                raise RuntimeError(f"{self.path}: batch {others[0]!r} has not ended; run it again or release it")
            if self.taken(spark, batch_id).isEmpty():
                create(spark, f"{self._open()}/{batch_id}", batch_id)
                rows = self.fresh(spark, files).withColumn("taken_by", F.lit(batch_id))
                self.table.append(rows, f"{batch_id}-{uuid.uuid4().hex}")
        return self.taken(spark, batch_id)

    def ended(self, spark: SparkSession, batch_id: str) -> bool:
        return batch_id not in names(spark, self._open())

    def end(self, spark: SparkSession, batch_id: str) -> None:
        """All files of the batch have been dealt with."""
        delete(spark, f"{self._open()}/{batch_id}")

    def release(self, spark: SparkSession, batch_id: str) -> None:
        """Gives up a batch that has not ended: its files are fresh again for the next one.

        For a batch that cannot succeed, say as a file of it is gone. Tables it has loaded already
        keep their rows; with a key they are not loaded twice.
        """
        with self.table.writing(spark, batch_id):
            if not self.ended(spark, batch_id):
                self.table.replace(self.table.rows(spark).where(F.col("taken_by") != batch_id))
                self.end(spark, batch_id)


def exactly(path: str) -> str:
    """A path as a pattern that only it fits, for readers that take patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
