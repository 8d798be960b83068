"""What a maintenance request asks for: ``/backup`` or ``/restore/<table>``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.plans.audit import AuditLog
from intake.plans.backup import backup, restore
from intake.sources.tables import Table

# The two actions and the answers a caller sees.
BACKUP = "backup"
RESTORE = "restore"
REFUSED = "refused"


def _segment(path: Column, n: int) -> Column:
    return F.split_part(F.ltrim(path, F.lit("/")), F.lit("/"), F.lit(n))


def route(requests: DataFrame, tables: Iterable[str], path: str = "path") -> DataFrame:
    """Add ``action`` and ``table_name`` to request paths.

    A backup covers all tables (no name). A restore needs a declared table, and
    anything else is ``refused``.
    """
    action = _segment(F.col(path), 1)
    table = F.nullif(_segment(F.col(path), 2), F.lit(""))
    restorable = (action == RESTORE) & F.coalesce(table.isin(*tables), F.lit(False))
    return requests.select(
        "*",
        F.when(action == BACKUP, F.lit(BACKUP))
        .when(restorable, F.lit(RESTORE))
        .otherwise(F.lit(REFUSED))
        .alias("action"),
        F.when(action == RESTORE, table).alias("table_name"),
    )


def handle(
    spark: SparkSession,
    path: str,
    tables: Mapping[str, Table],
    root: str,
    audit: AuditLog | None = None,
) -> DataFrame | int:
    """Carry a request out: the manifest of a backup, or the rows restored."""
    request = spark.sql("SELECT :path AS path", args={"path": path})
    found = route(request, tables).first()
    if found["action"] == BACKUP:
        return backup(spark, tables, root, audit=audit)
    if found["action"] == RESTORE:
        table = found["table_name"]
        return restore(spark, root, table, tables[table], audit=audit)
    raise ValueError(f"{path}: neither a backup nor a restore of a declared table")
