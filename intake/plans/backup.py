"""Snapshots of tables: written anew, checked, published last, restored singly."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from datetime import UTC, datetime
from decimal import Decimal
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.contracts import TableContract
from intake.functions.checksum import SUM_TYPE, checksum
from intake.plans.audit import AuditLog
from intake.plans.load import load
from intake.sources.files import delete, exists, names
from intake.sources.local import rows_frame
from intake.sources.tables import Expected, Table

LATEST = "latest"

PART = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("checksum", T.DecimalType(38, 0)),
        T.StructField("path", T.StringType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("snapshot_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("format", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("checksum", T.DecimalType(38, 0)),
        T.StructField("schema_json", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("key", T.ArrayType(T.StringType())),
        T.StructField("n_parts", T.IntegerType()),
        T.StructField("parts", T.ArrayType(PART)),
    ]
)

# What a measured copy is compared by: the part -1 is a table that has none.
FOUND = "table_name string, part int, rows_found bigint, sum_found decimal(38,0)"


def _manifest_path(root: str) -> str:
    return f"{root}/manifest"


def _published(root: str, snapshot_id: str) -> str:
    """The manifest's own part for one snapshot; its presence publishes it."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", snapshot_id):
        raise ValueError(f"snapshot id {snapshot_id!r} may hold only letters, digits, . _ -")
    return f"{_manifest_path(root)}/snapshot_id={snapshot_id}"


def _data(root: str, snapshot_id: str) -> str:
    return f"{root}/snapshots/{snapshot_id}"


def _parts_dir(root: str, table: str) -> str:
    return f"{root}/parts/{table}"


def _frame(spark: SparkSession, source: Table | DataFrame) -> DataFrame:
    return source if isinstance(source, DataFrame) else source.read(spark)


def _recorded(audit: AuditLog | None, spark: SparkSession, step: str, table: str, snapshot: str):
    return audit.run(spark, step, table, snapshot) if audit else nullcontext({})


def backup(
    spark: SparkSession,
    sources: Mapping[str, Table | DataFrame],
    root: str,
    tables: Sequence[str] | None = None,
    snapshot_id: str | None = None,
    fmt: str = "parquet",
    parallel: int = 4,
    audit: AuditLog | None = None,
    keys: Mapping[str, Sequence[str]] | None = None,
    parts: int = 64,
) -> DataFrame:
    """Write one snapshot of ``tables`` (all sources if none are named).

    Row count and checksum are observed in the same pass that writes. The manifest
    is written after every table is done, so a backup that dies leaves the earlier
    snapshots as they were and no half snapshot to be found. Up to ``parallel``
    tables are written at once, so small ones do not queue behind each other. With
    ``audit`` each table leaves a row there, failed or not.

    A table named in ``keys`` is stored in ``parts`` parts by the hash of its key columns (null keys
    are one key). The parts are counted and summed in a scan of their own, and only those that the
    table's newest snapshot does not hold alike are written; the others are named where they lie.
    Choose ``parts`` so that one is about what you would write again for one changed row,
    and keep it: another number, key, schema or format writes all parts. The checksum
    takes 0.0 and -0.0 for one value. A part that ``verify`` calls wrong is written again once its folder is deleted.
    """
    keys = keys or {}
    names = list(sources) if not tables else list(tables)
    unknown = sorted((set(names) | set(keys)) - set(sources))
    if unknown or not names:
        raise ValueError(f"no such table to back up: {unknown or 'none given'}")
    if parts < 1 or not all(keys.values()):
        raise ValueError("a table in parts needs a key and at least one part")
    created = datetime.now(UTC)
    snapshot = snapshot_id or created.strftime("%Y%m%dT%H%M%S%f")
    if exists(spark, _published(root, snapshot)):
        raise ValueError(f"snapshot {snapshot} already exists under {root}")

    def write(name: str) -> dict:
        with _recorded(audit, spark, "backup", name, snapshot) as row:
            found = copy_parts(name) if name in keys else copy(name)
            row |= {"scanned": found["n_rows"], "schema_json": found["schema_json"]}
            return found

    def copy(name: str) -> dict:
        df = _frame(spark, sources[name])
        seen = Observation()
        path = f"{_data(root, snapshot)}/{name}"
        counted = df.observe(seen, F.count(F.lit(1)).alias("n"), checksum(df).alias("sum"))
        counted.write.format(fmt).mode("overwrite").save(path)
        got = seen.get
        return {
            "snapshot_id": snapshot,
            "table_name": name,
            "path": path,
            "format": fmt,
            "n_rows": got["n"],
            "checksum": got["sum"],
            "schema_json": df.schema.json(),
            "created_at": created,
            "key": None,
            "n_parts": None,
            "parts": None,
        }

    def copy_parts(name: str) -> dict:
        df = _frame(spark, sources[name])
        entry = {
            "snapshot_id": snapshot,
            "table_name": name,
            "path": _parts_dir(root, name),
            "format": fmt,
            "schema_json": df.schema.json(),
            "created_at": created,
            "key": list(keys[name]),
            "n_parts": parts,
        }
        stored = _write_parts(spark, df, entry, _held_parts(spark, root, entry))
        return entry | {
            "n_rows": sum(p["n_rows"] for p in stored),
            "checksum": Decimal(sum(int(p["checksum"]) for p in stored)),
            "parts": stored,
        }

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(write), names))
    for row in rows:
        gone = sorted(_paths([row]) - _present(spark, _paths([row])))
        if gone:
            raise RuntimeError(f"parts of {row['table_name']} were removed during the backup: {gone}")
    manifest = rows_frame(spark, rows, MANIFEST)
    manifest.drop("snapshot_id").write.mode("overwrite").parquet(_published(root, snapshot))
    return manifest


def _paths(entries: Iterable) -> set[str]:
    """The folders of all parts that entries of the manifest name."""
    return {p["path"] for e in entries for p in e["parts"] or ()}


def _present(spark: SparkSession, paths: Iterable[str]) -> set[str]:
    """Those folders that are there, by one listing for all parts written together."""
    folders = {p.rpartition("/")[0] for p in paths}
    found = {f"{folder}/{name}" for folder in folders for name in names(spark, folder)}
    return found & set(paths)


def _held_parts(spark: SparkSession, root: str, entry: dict) -> dict[int, Row]:
    """The parts of the table's newest snapshot, if it was cut and written the same way."""
    entries = read_manifest(spark, root).where(F.col("table_name") == entry["table_name"])
    newest = entries.orderBy(F.desc("created_at"), F.desc("snapshot_id")).first()
    same = ("key", "n_parts", "format", "schema_json")
    if newest is None or any(newest[c] != entry[c] for c in same):
        return {}
    there = _present(spark, _paths([newest]))
    return {p["part"]: p for p in newest["parts"] if p["path"] in there}


def _write_parts(spark: SparkSession, df: DataFrame, entry: dict, held: dict[int, Row]) -> list[dict]:
    """Measures every part and writes those that are not held; what the driver sees is a row a part."""
    column = "_part"
    while column.lower() in (c.lower() for c in df.columns):
        column += "_"
    part = F.pmod(F.xxhash64(*[df[k] for k in entry["key"]]), F.lit(entry["n_parts"])).cast("int")
    measures = F.count(F.lit(1)).alias("n_rows"), checksum(df).alias("checksum")
    measured = df.groupBy(part.alias("part")).agg(*measures).orderBy("part").collect()
    folder = f"{entry['path']}/{uuid.uuid4().hex}"
    stored, new = [], []
    for m in measured:
        old = held.get(m["part"])
        if old and (old["n_rows"], old["checksum"]) == (m["n_rows"], m["checksum"]):
            stored.append(old.asDict())
        else:
            new.append(m)
            stored.append(m.asDict() | {"path": f"{folder}/{column}={m['part']}"})
    if new:
        rows = df.select("*", part.alias(column))
        if len(new) < len(measured):
            rows = rows.where(F.col(column).isin([m["part"] for m in new]))
        seen = Observation()
        # A large part is dealt to several tasks and files, small ones share a task.
        rows = rows.hint("rebalance", column).observe(seen, *measures)
        rows.write.format(entry["format"]).partitionBy(column).save(folder)
        want = sum(m["n_rows"] for m in new), sum(int(m["checksum"]) for m in new)
        if (seen.get["n_rows"], int(seen.get["checksum"])) != want:
            raise RuntimeError(f"{entry['table_name']} changed while it was backed up")
    return stored


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    if not exists(spark, _manifest_path(root)):
        return rows_frame(spark, [], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(_manifest_path(root))


def _entry(spark: SparkSession, root: str, table: str, snapshot_id: str) -> Row:
    entries = read_manifest(spark, root).where(F.col("table_name") == table)
    if snapshot_id != LATEST:
        entries = entries.where(F.col("snapshot_id") == snapshot_id)
    newest = entries.orderBy(F.desc("created_at"), F.desc("snapshot_id")).first()
    if newest is None:
        raise ValueError(f"no snapshot {snapshot_id!r} of table {table!r} under {root}")
    return newest


def read_snapshot(
    spark: SparkSession, root: str, table: str, snapshot_id: str = LATEST
) -> DataFrame:
    return _load(spark, _entry(spark, root, table, snapshot_id))


def _load(spark: SparkSession, entry: Row) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entry["schema_json"]))
    if entry["parts"] is None:
        return spark.read.format(entry["format"]).schema(schema).load(entry["path"])
    return _load_parts(spark, entry, schema, sorted(_paths([entry])))


def _load_parts(spark: SparkSession, entry: Row, schema: T.StructType, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.format(entry["format"]).schema(schema).load(paths)


def verify(spark: SparkSession, root: str, snapshot_id: str) -> DataFrame:
    """Read a snapshot back: rows and checksum found against those recorded.

    For a table in parts ``wrong_parts`` has the numbers of those that are gone or hold other
    rows than were written; it is empty for every other table.
    """
    entries = read_manifest(spark, root).where(F.col("snapshot_id") == snapshot_id)
    tables = entries.collect()
    if not tables:
        raise ValueError(f"no snapshot {snapshot_id!r} under {root}")
    found = reduce(
        DataFrame.unionByName,
        (_measure(spark, t) for t in tables),
        spark.createDataFrame([], FOUND),
    )
    whole = F.struct(F.lit(-1).alias("part"), "n_rows", "checksum", "path")
    cut = entries.select("table_name", F.explode(F.coalesce("parts", F.array(whole))).alias("p"))
    cut = cut.select("table_name", "p.part", "p.n_rows", "p.checksum").join(found, ["table_name", "part"], "left")
    rows, total = F.coalesce("rows_found", F.lit(0)), F.coalesce("sum_found", F.lit(0).cast(SUM_TYPE))
    wrong = (F.col("n_rows") != rows) | (F.col("checksum") != total)
    cut = cut.groupBy("table_name").agg(
        F.sum(rows).alias("rows_found"),
        F.sum(total).cast(SUM_TYPE).alias("sum_found"),
        F.sort_array(F.collect_list(F.when(wrong & (F.col("part") >= 0), F.col("part")))).alias("wrong_parts"),
    )
    # A table without rows has no parts.
    rows, total = F.coalesce("rows_found", F.lit(0)), F.coalesce("sum_found", F.lit(0).cast(SUM_TYPE))
    none = F.coalesce("wrong_parts", F.array().cast("array<int>"))
    same = (F.col("n_rows") == rows) & (F.col("checksum") == total) & (F.size(none) == 0)
    return entries.join(cut, "table_name", "left").select(
        "table_name",
        "n_rows",
        rows.alias("rows_found"),
        "checksum",
        same.alias("verified"),
        none.alias("wrong_parts"),
    )


def _measure(spark: SparkSession, entry: Row) -> DataFrame:
    """Rows and checksum found of each part; a part is what lies in its folder, whatever its keys."""
    if entry["parts"] is None:
        df, part = _load(spark, entry), F.lit(-1)
    else:
        schema = T.StructType.fromJson(json.loads(entry["schema_json"]))
        there = sorted(_present(spark, _paths([entry])))
        if not there:
            return spark.createDataFrame([], FOUND)
        df = _load_parts(spark, entry, schema, there)
        part = F.regexp_extract(df.metadataColumn("_metadata")["file_path"], "=([0-9]+)/[^/]*$", 1).cast("int")
    measures = F.count(F.lit(1)).alias("rows_found"), checksum(df).cast(SUM_TYPE).alias("sum_found")
    found = df.agg(*measures).withColumn("part", part) if entry["parts"] is None else df.groupBy(part.alias("part")).agg(*measures)
    return found.select(F.lit(entry["table_name"]).alias("table_name"), "part", "rows_found", "sum_found")


def restore(
    spark: SparkSession,
    root: str,
    table: str,
    target: Table,
    snapshot_id: str = LATEST,
    mode: str = "replace",
    contract: TableContract | None = None,
    audit: AuditLog | None = None,
) -> int:
    """Put one table back and return the number of rows written.

    ``replace`` sets the table to the snapshot's content. ``append`` adds only rows
    whose key is missing, which needs the contract. Either can be repeated after a
    failure: the snapshot itself is never touched, and a snapshot that has not the rows and
    the checksum of its manifest is refused before the table changes.
    """
    with _recorded(audit, spark, "restore", table, snapshot_id) as row:
        row["loaded"] = done = _restore(spark, root, table, target, snapshot_id, mode, contract)
    return done


def _restore(
    spark: SparkSession,
    root: str,
    table: str,
    target: Table,
    snapshot_id: str,
    mode: str,
    contract: TableContract | None,
) -> int:
    entry = _entry(spark, root, table, snapshot_id)
    rows = _load(spark, entry)
    expected = Expected(entry["n_rows"], entry["checksum"])
    if mode == "append":
        if contract is None or not contract.key:
            raise ValueError("restore by append needs a contract with a key")
        expected.check(Expected.of(rows), f"snapshot {entry['snapshot_id']} of {table}")
        batch = rows.select(*target.schema.fieldNames())
        batch_id = f"restore-{entry['snapshot_id']}"
        source = f"snapshot:{entry['snapshot_id']}:{entry['checksum']}"
        return load(spark, batch, target, contract, batch_id, source=source).loaded
    if mode != "replace":
        raise ValueError(f"unknown restore mode {mode!r}: use 'replace' or 'append'")
    with target.writing(spark, f"restore-{entry['snapshot_id']}"):
        target.replace(rows, expected)
    return entry["n_rows"]


def expire(spark: SparkSession, root: str, keep: int, unpublished: bool = False) -> list[str]:
    """Remove all but the newest ``keep`` snapshots and return their ids.

    A separate step, never part of a backup: the old set goes only once newer ones
    are published. Parts go when no snapshot names them any more. ``unpublished`` also removes
    what backups that failed have left; not while a backup is running, nor should two
    backups and this one run at once.
    """
    if keep < 1:
        raise ValueError("keep at least one snapshot")
    entries = read_manifest(spark, root).select("snapshot_id", "created_at", "parts").collect()
    made = {}
    for e in entries:
        made[e["snapshot_id"]] = max(e["created_at"], made.get(e["snapshot_id"], e["created_at"]))
    ids = sorted(made, key=lambda i: (made[i], i), reverse=True)
    old = ids[keep:]
    named = _paths(e for e in entries if e["snapshot_id"] not in old)
    loose = _paths(entries) - named
    for snapshot in old:
        delete(spark, _published(root, snapshot))
    if unpublished:
        left = [n for n in names(spark, f"{root}/snapshots") if n not in ids]
        old += left
        loose |= _stored_parts(spark, root) - named
    for snapshot in old:
        delete(spark, _data(root, snapshot))
    for path in sorted(loose):
        delete(spark, path)
    for folder in sorted({p.rpartition("/")[0] for p in loose}):
        if all(n.startswith(("_SUCCESS", ".")) for n in names(spark, folder)):
            delete(spark, folder)
    return old


def _stored_parts(spark: SparkSession, root: str) -> set[str]:
    """All parts under the root, named by a snapshot or not."""
    tables = [f"{root}/parts/{t}" for t in names(spark, f"{root}/parts")]
    folders = [f"{t}/{n}" for t in tables for n in names(spark, t)]
    return {f"{f}/{n}" for f in folders for n in names(spark, f) if "=" in n}
