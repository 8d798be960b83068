"""Landing files: headerless delimited text, read as strings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.contracts import TableContract
from intake.functions.keys import (
    PASS,
    UNKNOWN_TABLE,
    WRONG_TYPE,
    file_type_ok,
    key_verdict,
    table_name,
)
from intake.operators.rules import CORRUPT


def _schema(contract: TableContract) -> T.StructType:
    """The declared columns, plus the raw line where a rule asks for it."""
    schema = contract.landing_schema
    return schema.add(CORRUPT, T.StringType()) if contract.wants_raw_line else schema


def _format(contract: TableContract) -> dict[str, str]:
    """How the files of a contract are written, for reader and writer alike."""
    form = {"sep": contract.delimiter, "encoding": contract.encoding, "escape": contract.escape}
    return form | ({"lineSep": contract.line_sep} if contract.line_sep else {})


def _options(contract: TableContract) -> dict[str, str]:
    options = _format(contract) | {"header": "false", "mode": "PERMISSIVE"}
    options["multiLine"] = str(contract.multi_line).lower()
    if contract.wants_raw_line:
        # A pruned scan cannot see that a line is short or long.
        options |= {"columnNameOfCorruptRecord": CORRUPT, "columnPruning": "false"}
    return options


def read_landing(
    spark: SparkSession, path: str | list[str], contract: TableContract, glob: str | None = None
) -> DataFrame:
    """Read one file or several, or with ``glob`` the matching files below a folder."""
    reader = spark.read.schema(_schema(contract)).options(**_options(contract))
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.csv(path)


def stream_landing(
    spark: SparkSession,
    folder: str,
    contract: TableContract,
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """The same files as they arrive; each path is read once.

    With ``archive`` files that were read move there, so that the folder that every
    trigger lists does not grow.
    """
    reader = (
        spark.readStream.schema(_schema(contract))
        .options(**_options(contract))
        .option("pathGlobFilter", contract.glob)
        .option("recursiveFileLookup", "true")
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def write_landing(df: DataFrame, path: str, contract: TableContract, mode: str = "error") -> None:
    """Write rows as landing files; blanks around a value are kept."""
    (
        df.select(*contract.columns)
        .write.mode(mode)
        .options(**_format(contract))
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def check_width(spark: SparkSession, path: str, contract: TableContract) -> None:
    """Raise if the first line has another number of fields than declared.

    An empty file has no first line and is refused too.
    """
    reader = spark.read.options(**_format(contract)).option("multiLine", contract.multi_line)
    found = len(reader.csv(path).columns)
    if found != len(contract.columns):
        raise ValueError(
            f"{contract.name}: {path} has {found} columns, "
            f"the contract declares {len(contract.columns)}"
        )


def check_key(
    spark: SparkSession, key: str, tables: Iterable[str], parity: bool = False
) -> str:
    """Table name of an object key, or ``ValueError`` if the gate refuses it."""
    one = spark.sql("SELECT :key AS key", args={"key": key})
    row = one.select(
        table_name(F.col("key")).alias("name"),
        key_verdict(F.col("key"), tables, parity).alias("verdict"),
    ).first()
    if row["verdict"] == WRONG_TYPE:
        raise ValueError(f"{key}: not a csv file")
    if row["verdict"] == UNKNOWN_TABLE:
        raise ValueError(f"{key}: table {row['name']!r} has no contract")
    return row["name"]


def list_landing(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """The files below a folder, without reading them."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "modificationTime", "length")


def stream_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The same, as files arrive."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema)
    return reader.option("recursiveFileLookup", "true").load(folder).drop("content")


def source_of(files: DataFrame) -> str:
    """What says that files are the same ones: their paths, lengths and times, as a digest."""
    known = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n, total = files.agg(F.count(F.lit(1)), F.coalesce(F.sum(known), F.lit(0))).first()
    return f"files:{n}:{total}"


def taken_by(spark: SparkSession, contracts: Mapping[str, TableContract]) -> Column:
    """The contract that takes a listed file, by its ``path``; null if none does."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern
    name = F.element_at(F.split("path", "/"), -1)
    fits = [
        F.when(name.rlike(f"^(?:{pattern(c.glob).compiled().pattern()})\\z"), F.lit(c.name)) for c in contracts.values()
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def refused(files: DataFrame, contracts: Mapping[str, TableContract], parity: bool = False) -> DataFrame:
    """Of the listed files those that no contract takes, with table_name and verdict.

    Decided by the names alone, as the reader's own filter does: a file that has been moved away since
    it was listed is judged like any other.
    """
    verdict = F.when(~file_type_ok(F.col("path"), parity), F.lit(WRONG_TYPE)).otherwise(F.lit(UNKNOWN_TABLE))
    left = files.where(taken_by(files.sparkSession, contracts).isNull())
    return left.select("path", table_name(F.col("path")).alias("table_name"), verdict.alias("verdict"))


def gate(
    files: DataFrame, tables: Iterable[str], key: str = "path", parity: bool = False
) -> DataFrame:
    """Add ``table_name``, ``verdict`` and ``passed`` to a list of keys."""
    verdict = key_verdict(F.col(key), tables, parity)
    return files.select(
        "*", table_name(F.col(key)).alias("table_name"), verdict.alias("verdict")
    ).withColumn("passed", F.col("verdict") == PASS)
