"""Serving tables: a Parquet folder, a bucketed catalog table or a JDBC table.

All offer the same steps: ``read`` (everything, for a backup), ``rows`` (the declared
columns), ``append`` one batch, ``replace`` the content, and two guards: ``writing``
holds the table for one writer, ``claim`` ties a batch id to the source of its rows. An
append returns the number of rows written. ``settled`` says whether a batch's rows are in the
table already, under another batch's name.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.functions.checksum import checksum
from intake.operators.dedupe import key_bytes
from intake.operators.sketch import BLOCK_BYTES, SKETCH_SCHEMA, blocks_for, key_sketch, suspects
from intake.sources.files import create, delete, exists, names, read_text, size
from intake.sources.local import rows_frame

BATCH = "batch_id"
COMPACTED = "compacted"
REPLACED = "replaced"


def batch_path(root: str, batch_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch_id):
        raise ValueError(f"batch id {batch_id!r} may hold only letters, digits, . _ -")
    return f"{root}/{BATCH}={batch_id}"


def claim(spark: SparkSession, folder: str, batch_id: str, source: str) -> bool:
    """Ties a batch id to the source of its rows; says whether it was free.

    The same source may come again under its id, after a crash or on purpose, and replaces what it
    wrote. Another one is refused before anything is written: its rows would take the
    place of the first one's.
    """
    batch_path("", batch_id)
    note = f"{folder}/batches/{batch_id}"
    if create(spark, note, source):
        return True
    held = read_text(spark, note)
    if held != source:
        raise ValueError(f"batch id {batch_id!r} belongs to another source: {held}, not {source}")
    return False


def unclaim(spark: SparkSession, folder: str, batch_id: str) -> None:
    """Frees a batch id whose rows were refused before any was loaded."""
    delete(spark, f"{folder}/batches/{batch_id}")


# The notes of the writers that are alive in this process.
_live: set[str] = set()
_entering = threading.Lock()


@contextmanager
def writing(spark: SparkSession, folder: str, holder: str) -> Iterator[None]:
    """Holds a table for one writer from reading its keys to publishing the rows.

    Every run has a note of its own, so a second one is refused even under the same name, and no run
    takes away another's note. It can be run again later. A writer that died leaves its note: in
    the same application the same holder may go on, otherwise ``release`` frees the table.
    """
    note, application = f"{folder}/writer", spark.sparkContext.applicationId
    mine = f"{holder}\n{application}\n{uuid.uuid4().hex}"
    with _entering:
        if not create(spark, note, mine):
            held = read_text(spark, note) or ""
            name, *run = held.split("\n")
            dead = held not in _live and (not run or run[0] == application)
            if not (name == holder and dead):
                raise RuntimeError(f"{folder}: {name!r} is writing; run {holder!r} again later")
            delete(spark, note)
            if not create(spark, note, mine):
                raise RuntimeError(f"{folder}: another run is writing; run {holder!r} again later")
        _live.add(mine)
    try:
        yield
    finally:
        _live.discard(mine)
        if read_text(spark, note) == mine:
            delete(spark, note)


def release(spark: SparkSession, folder: str) -> None:
    """Frees a table whose writer died and will not come again."""
    delete(spark, f"{folder}/writer")


@dataclass(frozen=True)
class Expected:
    """What a copy has to hold: the number of its rows and their checksum."""

    n_rows: int
    checksum: int

    @staticmethod
    def of(df: DataFrame) -> Expected:
        return Expected(*df.agg(F.count(F.lit(1)), checksum(df)).first())

    def check(self, found: Expected, what: str) -> None:
        if found.n_rows != self.n_rows:
            raise ValueError(f"{what} has {found.n_rows} rows, not {self.n_rows}")
        if found.checksum != self.checksum:
            raise ValueError(f"{what} has other values than recorded")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows on their way to a writer.

    To be the last step before it: no shuffle may follow, since a task that feeds a
    shuffle is counted again if it is run again.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


@dataclass(frozen=True)
class Listing:
    """What a table consists of: the folders that count, by batch, below one root.

    ``held`` are the batches whose rows a compaction or replacement has put under another name,
    ``sketches`` those whose keys have a sketch, with its folder's name and its number of blocks.
    """

    root: str
    folders: Mapping[str, str] = field(default_factory=dict)
    held: tuple[str, ...] = ()
    sketches: Mapping[str, tuple[str, int]] = field(default_factory=dict)

    def text(self) -> str:
        # The last line says that the file is whole.
        return json.dumps({**asdict(self), "held": self.held}) + "\nend"

    @staticmethod
    def of(text: str | None) -> Listing | None:
        if not text or not text.endswith("\nend"):
            return None
        found = json.loads(text.removesuffix("\nend"))
        sketches = {b: tuple(s) for b, s in found.get("sketches", {}).items()}
        return Listing(found["root"], found["folders"], tuple(found["held"]), sketches)


@dataclass(frozen=True)
class ParquetTable:
    """A folder whose content is what its newest listing names.

    Every append writes a fresh folder and then publishes a listing, in which it stands instead of
    the batch's earlier one, as one new small file under the next number. A load that dies before that
    has changed nothing, a reader takes one listing, and of two writers that start from
    the same listing one is refused. Setting the whole content writes a new root the same way.
    ``vacuum`` removes what no listing needs any more.

    What is not rows (listings, new roots, claims, the writer's note) lies in ``<path>.meta``.
    With a ``key`` compaction puts the rows in its order, in files of disjoint ranges. With
    ``sketched`` every batch has a sketch of its keys, and a load opens only the folders that
    may hold a key of the new batch: for keys that arrive in no order, which ranges cannot tell apart.
    """

    path: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    sketched: bool = False

    def __post_init__(self):
        if self.sketched and not self.key:
            raise ValueError(f"{self.path}: a table without a key has no sketches")

    @property
    def meta(self) -> str:
        return f"{self.path}.meta"

    def _listing(self, spark: SparkSession) -> tuple[int, Listing]:
        """The newest whole listing, and the number of the next one."""
        folder = f"{self.meta}/listings"
        numbers = names(spark, folder)
        after = int(numbers[-1]) + 1 if numbers else 0
        for number in reversed(numbers):
            if found := Listing.of(read_text(spark, f"{folder}/{number}")):
                return after, found
        # A folder of batches without a listing is a table, too.
        batches = [n for n in names(spark, self.path) if n.startswith(f"{BATCH}=")]
        return after, Listing(self.path, {n.removeprefix(f"{BATCH}="): n for n in batches})

    def _publish(self, spark: SparkSession, number: int, listing: Listing) -> None:
        if not create(spark, f"{self.meta}/listings/{number:012d}", listing.text()):
            raise RuntimeError(f"{self.path}: another writer has published meanwhile; run again")

    def root(self, spark: SparkSession) -> str:
        """Where the current content lies."""
        return self._listing(spark)[1].root

    def _read(self, spark: SparkSession, listing: Listing) -> DataFrame:
        schema = T.StructType(list(self.schema.fields)).add(BATCH, T.StringType())
        if not listing.folders:
            return rows_frame(spark, [], schema)
        folders = [f"{listing.root}/{f}" for f in listing.folders.values()]
        return spark.read.schema(schema).option("basePath", listing.root).parquet(*folders)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, self._listing(spark)[1])

    def rows(self, spark: SparkSession, except_batch: str | None = None) -> DataFrame:
        df = self.read(spark)
        if except_batch is not None:
            df = df.where(F.col(BATCH) != except_batch)
        return df.select(*self.schema.fieldNames())

    def rows_of(self, spark: SparkSession, batches: Iterable[str]) -> DataFrame:
        """The rows of these batches; no other folder is opened."""
        listing = self._listing(spark)[1]
        only = replace(listing, folders={b: listing.folders[b] for b in batches})
        return self._read(spark, only).select(*self.schema.fieldNames())

    def suspects(
        self, keys: DataFrame, key: Sequence[str], except_batch: str, n_bytes: int, limit: int
    ) -> tuple[DataFrame | None, list[str]]:
        """The keys that a batch may hold by its sketch, with its name as ``_batch``, and the batches without one.

        None where nothing is sketched, or where the keys are of another type than the table's, since
        their hashes would differ. ``n_bytes`` is the measured size of ``keys``: what is under ``limit`` is broadcast.
        """
        spark = keys.sparkSession
        listing = self._listing(spark)[1]
        others = [b for b in listing.folders if b != except_batch]
        asked = {b: listing.sketches[b] for b in others if b in listing.sketches}
        alike = tuple(key) == self.key and all(keys.schema[c].dataType == self.schema[c].dataType for c in key)
        if not asked or not alike:
            return None, others
        sketches = spark.read.schema(SKETCH_SCHEMA).parquet(*[f"{self.meta}/sketches/{name}" for name, _ in asked.values()])
        sizes = sorted({n for _, n in asked.values()})
        found = suspects(
            keys,
            sketches,
            key,
            sizes,
            broadcast_keys=n_bytes * len(sizes) <= limit,
            broadcast_sketches=sum(n for _, n in asked.values()) * BLOCK_BYTES <= limit,
        )
        return found, [b for b in others if b not in asked]

    def _sketch(self, spark: SparkSession, folder: str, batch: str, n_rows: int) -> dict[str, tuple[str, int]]:
        """Writes the sketch of a folder that was just written, from its key columns."""
        if not self.sketched:
            return {}
        name, n_blocks = uuid.uuid4().hex, blocks_for(n_rows)
        keys = spark.read.schema(self.schema).parquet(folder).select(*self.key)
        key_sketch(keys, self.key, batch, n_blocks).write.parquet(f"{self.meta}/sketches/{name}")
        return {batch: (name, n_blocks)}

    def empty(self, spark: SparkSession, except_batch: str) -> bool:
        """Whether no other batch is there, by the listing alone."""
        return set(self._listing(spark)[1].folders) <= {except_batch}

    def settled(self, spark: SparkSession, batch_id: str) -> bool:
        return batch_id in self._listing(spark)[1].held

    def claim(self, spark: SparkSession, batch_id: str, source: str) -> None:
        claim(spark, self.meta, batch_id, source)

    def writing(self, spark: SparkSession, holder: str):
        return writing(spark, self.meta, holder)

    def append(self, df: DataFrame, batch_id: str) -> int:
        spark = df.sparkSession
        number, listing = self._listing(spark)
        batch = batch_path("", batch_id).lstrip("/")
        rows, seen = _counted(df.select(*self.schema.fieldNames()))
        folder = f"{batch}/attempt-{uuid.uuid4().hex}"
        rows.write.parquet(f"{listing.root}/{folder}")
        n = seen.get["n"]
        # An earlier attempt's sketch says nothing about this one.
        sketches = {b: s for b, s in listing.sketches.items() if b != batch_id}
        sketches |= self._sketch(spark, f"{listing.root}/{folder}", batch_id, n)
        folders = {**listing.folders, batch_id: folder}
        self._publish(spark, number, replace(listing, folders=folders, sketches=sketches))
        return n

    def replace(self, df: DataFrame, expected: Expected | None = None) -> None:
        """Set the whole content; ``df`` may read from this table.

        With ``expected`` rows and checksum are observed in the write, and the old content stays
        if they are others. Without a batch column the batches loaded before count as held by
        the new content: those without a key add nothing if they come again.
        """
        number, listing = self._listing(df.sparkSession)
        self._replace(df, expected, number, listing, REPLACED)

    def _replace(self, df: DataFrame, expected: Expected | None, number: int, listing: Listing, batch: str) -> None:
        spark, seen = df.sparkSession, Observation()
        held: Sequence[str] = listing.held
        total = checksum(df)
        if BATCH not in df.columns:
            df = df.withColumn(BATCH, F.lit(batch))
            held = sorted({*held, *listing.folders} - {COMPACTED, REPLACED})
        rows = df.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("sum"))
        new = f"{self.meta}/generations/{uuid.uuid4().hex}"
        rows.select(*self.schema.fieldNames(), BATCH).write.partitionBy(BATCH).parquet(new)
        if expected is not None:
            try:
                expected.check(Expected(seen.get["n"], seen.get["sum"]), f"the copy for {self.path}")
            except ValueError:
                delete(spark, new)
                raise
        folders = {n.removeprefix(f"{BATCH}="): n for n in names(spark, new) if n.startswith(f"{BATCH}=")}
        kept = tuple(b for b in held if b not in folders)
        # Rows that came with their batches' names keep them, and have no sketches until they are compacted.
        sketches = self._sketch(spark, f"{new}/{folders[batch]}", batch, seen.get["n"]) if set(folders) == {batch} else {}
        try:
            self._publish(spark, number, Listing(new, folders, kept, sketches))
        except RuntimeError:
            delete(spark, new)
            raise

    def compact(
        self, spark: SparkSession, n_files: int | None = None, file_bytes: int = 128 << 20, task_bytes: int = 256 << 20
    ) -> None:
        """Rewrite all batches as one, in ``n_files`` files, and check them.

        Without ``n_files`` there is a file for each ``file_bytes`` that the table has, measured, or more: a
        file's rows are sorted in one task, so they take at most about ``task_bytes`` of memory, measured, too.
        The table is read behind the lock, from the listing that the new one will follow, so that
        no load in between can be lost. A batch that comes again afterwards finds its keys loaded,
        or without a key itself held, and adds nothing. With a key the files hold disjoint ranges of it.
        """
        with self.writing(spark, "compact"):
            number, listing = self._listing(spark)
            before = self._read(spark, listing).drop(BATCH)
            n_bytes = sum(size(spark, f"{listing.root}/{f}") for f in listing.folders.values())
            # In a sort a row has a word more for each column, and its place and prefix twice.
            row_bytes = key_bytes(before, before.columns) + F.lit(8 * len(before.columns) + 32)
            n_rows, total, held = before.agg(F.count(F.lit(1)), checksum(before), F.coalesce(F.sum(row_bytes), F.lit(0))).first()
            n_files = n_files or max(1, -(-n_bytes // file_bytes), -(-held // task_bytes))
            if self.key:
                whole = before.repartitionByRange(n_files, *self.key).sortWithinPartitions(*self.key)
            else:
                whole = before.repartition(n_files)
            self._replace(whole, Expected(n_rows, total), number, listing, COMPACTED)

    def vacuum(self, spark: SparkSession) -> list[str]:
        """Remove what the current listing does not need and return its folders.

        These are earlier roots and attempts that were replaced or never published; earlier listings
        go as well. A separate step, for a time when no reader is left on an old one.
        """
        with self.writing(spark, "vacuum"):
            number, current = self._listing(spark)
            folder = f"{self.meta}/generations"
            roots = [f"{folder}/{n}" for n in names(spark, folder)] + [self.path]
            old = [r for r in roots if r != current.root and exists(spark, r)]
            used = set(current.folders.values())
            for batch in names(spark, current.root):
                if batch.startswith(f"{BATCH}=") and batch not in used:
                    inside = [f"{batch}/{n}" for n in names(spark, f"{current.root}/{batch}") if n.startswith("attempt-")]
                    old += [f"{current.root}/{f}" for f in inside if f not in used]
            asked = {name for name, _ in current.sketches.values()}
            for name in names(spark, f"{self.meta}/sketches"):
                if name not in asked:
                    delete(spark, f"{self.meta}/sketches/{name}")
            for generation in old:
                delete(spark, generation)
            for name in names(spark, f"{self.meta}/listings"):
                if int(name) < number - 1 and Listing.of(read_text(spark, f"{self.meta}/listings/{number - 1:012d}")):
                    delete(spark, f"{self.meta}/listings/{name}")
        return old


@dataclass(frozen=True)
class BucketedTable:
    """A catalog table with its files bucketed by key, for very large targets.

    A load that is too big to broadcast its keys must match them with all keys of
    the target. Here the target is already divided by key: only the batch is
    shuffled, to the table's buckets. Choose at least as many ``buckets`` as
    ``spark.sql.shuffle.partitions``, otherwise Spark shuffles the table after all.

    Setting the content writes a table beside this one and then publishes its name, as one new
    small file: ``current`` is the name that counts, and there is no moment without rows.
    """

    name: str
    path: str
    schema: T.StructType
    key: tuple[str, ...]
    buckets: int

    @property
    def meta(self) -> str:
        return f"{self.path}.meta"

    def _switches(self, spark: SparkSession) -> list[str]:
        return names(spark, f"{self.meta}/current")

    def current(self, spark: SparkSession) -> tuple[str, str]:
        """The catalog's name for the table now, and its folder."""
        for switch in reversed(self._switches(spark)):
            held = (read_text(spark, f"{self.meta}/current/{switch}") or "").split("\n")
            if len(held) == 3:
                return held[0], held[1]
        return self.name, self.path

    def read(self, spark: SparkSession) -> DataFrame:
        name, _ = self.current(spark)
        if not spark.catalog.tableExists(name):
            return rows_frame(spark, [], self.schema)
        return spark.table(name).select(*self.schema.fieldNames())

    def rows(self, spark: SparkSession, except_batch: str | None = None) -> DataFrame:
        """Rows already there. They carry no batch id: a repeated load skips them."""
        return self.read(spark)

    def empty(self, spark: SparkSession, except_batch: str) -> bool:
        return not spark.catalog.tableExists(self.current(spark)[0])

    def settled(self, spark: SparkSession, batch_id: str) -> bool:
        return False

    def claim(self, spark: SparkSession, batch_id: str, source: str) -> None:
        claim(spark, self.meta, batch_id, source)

    def writing(self, spark: SparkSession, holder: str):
        return writing(spark, self.meta, holder)

    def _write(self, df: DataFrame, mode: str, name: str, path: str, whole: bool = False) -> Expected:
        # One task per bucket, so that a write adds one file to each.
        rows = df.select(*self.schema.fieldNames()).repartition(self.buckets, *self.key)
        seen = Observation()
        sums = [checksum(rows).alias("sum")] if whole else []
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), *sums)
        writer = rows.write.mode(mode).format("parquet").option("path", path)
        writer.bucketBy(self.buckets, *self.key).sortBy(*self.key).saveAsTable(name)
        return Expected(seen.get["n"], seen.get.get("sum"))

    def append(self, df: DataFrame, batch_id: str) -> int:
        return self._write(df, "append", *self.current(df.sparkSession)).n_rows

    def replace(self, df: DataFrame, expected: Expected | None = None) -> None:
        """Set the whole content: a new table is written, checked in the write, and takes this one's place."""
        spark = df.sparkSession
        number, switch = uuid.uuid4().hex[:12], len(self._switches(spark))
        new, path = f"{self.name}_{number}", f"{self.path}-{number}"
        found = self._write(df, "error", new, path, whole=True)
        try:
            if expected is not None:
                expected.check(found, f"the copy for {self.name}")
            if not create(spark, f"{self.meta}/current/{switch:012d}", f"{new}\n{path}\nend"):
                raise RuntimeError(f"{self.name}: another writer has replaced the table meanwhile")
        except (RuntimeError, ValueError):
            self._drop(spark, new, path)
            raise

    @staticmethod
    def _drop(spark: SparkSession, name: str, path: str) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(spark, path)

    def compact(self, spark: SparkSession) -> None:
        """Rewrite the table with one file to a bucket; every append has added one to each."""
        with self.writing(spark, "compact"):
            self.replace(self.read(spark), Expected.of(self.read(spark)))

    def vacuum(self, spark: SparkSession) -> list[str]:
        """Drop the tables that were replaced, with their folders, and return their names."""
        with self.writing(spark, "vacuum"):
            now, _ = self.current(spark)
            every = [(self.name, self.path)]
            for switch in self._switches(spark):
                held = (read_text(spark, f"{self.meta}/current/{switch}") or "").split("\n")
                every += [(held[0], held[1])] if len(held) == 3 else []
            old = [(n, p) for n, p in every if n != now and (spark.catalog.tableExists(n) or exists(spark, p))]
            for name, path in old:
                self._drop(spark, name, path)
        return [n for n, _ in old]


@dataclass(frozen=True)
class JdbcTable:
    """A database table. The driver's jar must be on Spark's class path.

    ``partition_column`` (numeric or date) splits a read into ``num_partitions``
    range queries of equal width; the bounds are asked from the database. Where the column is
    text, or its values are skewed, ``predicates`` are the conditions of the parts instead, one query
    each: together they must cover every row once. With neither a read is a single query through one
    connection, which suits small tables only.
    """

    url: str
    table: str
    schema: T.StructType
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    predicates: tuple[str, ...] = ()
    num_partitions: int = 8
    fetch_size: int = 10_000
    batch_size: int = 10_000

    def __post_init__(self):
        for name in filter(None, (self.table, self.partition_column)):
            if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_$.]*", name):
                raise ValueError(f"{name!r} is not a plain identifier")
        if self.partition_column and self.predicates:
            raise ValueError("split a read by a column or by predicates, not by both")

    def _connection(self) -> dict[str, str]:
        return {"url": self.url, **self.properties}

    def bounds_query(self) -> str:
        c = self.partition_column
        return f"SELECT MIN({c}) AS low_key, MAX({c}) AS high_key FROM {self.table}"

    def read_options(self, low: object = None, high: object = None) -> dict[str, str]:
        options = {
            **self._connection(),
            "dbtable": self.table,
            "fetchsize": str(self.fetch_size),
        }
        if low is not None and high is not None:
            options |= {
                "partitionColumn": self.partition_column,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(self.num_partitions),
            }
        return options

    def write_options(self, truncate: bool = False) -> dict[str, str]:
        options = {
            **self._connection(),
            "dbtable": self.table,
            "batchsize": str(self.batch_size),
            # Caps the connections opened at once.
            "numPartitions": str(self.num_partitions),
        }
        # Empty the table and keep its definition, instead of dropping it.
        return options | {"truncate": "true"} if truncate else options

    def read(self, spark: SparkSession) -> DataFrame:
        if self.predicates:
            properties = {**self.properties, "fetchsize": str(self.fetch_size)}
            return spark.read.jdbc(
                self.url, self.table, predicates=list(self.predicates), properties=properties
            )
        low = high = None
        if self.partition_column:
            query = {**self._connection(), "query": self.bounds_query()}
            low, high = spark.read.format("jdbc").options(**query).load().first()
        return spark.read.format("jdbc").options(**self.read_options(low, high)).load()

    def rows(self, spark: SparkSession, except_batch: str | None = None) -> DataFrame:
        """Rows already there. They carry no batch id, so ``except_batch`` has no
        effect: a repeated load skips the keys its first attempt left behind."""
        return self.read(spark).select(*self.schema.fieldNames())

    def append(self, df: DataFrame, batch_id: str) -> int:
        rows, seen = _counted(df.select(*self.schema.fieldNames()))
        rows.write.format("jdbc").mode("append").options(**self.write_options()).save()
        return seen.get["n"]

    def empty(self, spark: SparkSession, except_batch: str) -> bool:
        return False

    def settled(self, spark: SparkSession, batch_id: str) -> bool:
        return False

    def claim(self, spark: SparkSession, batch_id: str, source: str) -> None:
        """The database keeps no batches; staging holds the claims of an ingest."""

    def writing(self, spark: SparkSession, holder: str):
        """The database's own key refuses a second copy of a row."""
        return nullcontext()

    def replace(self, df: DataFrame, expected: Expected | None = None) -> None:
        """Set the whole content, in place: checked before, since a database has one copy."""
        if expected is not None:
            expected.check(Expected.of(df), f"the copy for {self.table}")
        rows = df.select(*self.schema.fieldNames())
        options = self.write_options(truncate=True)
        rows.write.format("jdbc").mode("overwrite").options(**options).save()


Table = ParquetTable | BucketedTable | JdbcTable


def parquet_tables(
    root: str, names: Sequence[str], spark: SparkSession, suffix: str = ".parquet"
) -> dict[str, DataFrame]:
    """Plain Parquet files as named frames, for a backup of existing tables."""
    return {n: spark.read.parquet(f"{root}/{n}{suffix}") for n in names}
