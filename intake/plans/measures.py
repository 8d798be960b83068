"""Measures of loaded batches, taken once for each and merged: totals without reading rows.

A published batch folder never changes, so what was counted in it stays true. Counts, checksum and nulls
add up; the keys of a batch are kept as a HyperLogLog sketch, and sketches unite to that of several.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.functions.casts import quoted
from intake.functions.checksum import SUM_TYPE, checksum
from intake.sources.files import delete, names
from intake.sources.local import rows_frame
from intake.sources.tables import BATCH, ParquetTable

#: Logarithm of a sketch's registers: 4096 of them, a standard error of 1.6 %.
REGISTERS = 12

MEASURES = T.StructType(
    [
        T.StructField("folder", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("checksum", T.DecimalType(38, 0)),
        T.StructField("nulls", T.MapType(T.StringType(), T.LongType())),
        T.StructField("keys", T.BinaryType()),
    ]
)


def _stored(table: ParquetTable) -> str:
    return f"{table.meta}/measures"


def _key_sketch(df: DataFrame, key: Sequence[str]) -> Column:
    """The keys of a group as a sketch; rows without a whole key are not in it."""
    if not key:
        return F.lit(None).cast("binary")
    whole = reduce(lambda a, b: a & b, (df[k].isNotNull() for k in key))
    return F.hll_sketch_agg(F.when(whole, F.xxhash64(*[df[k] for k in key])), REGISTERS)


def _measured(table: ParquetTable, spark: SparkSession, folders: Mapping[str, str], root: str) -> DataFrame:
    """One row for each folder, by one scan of them all."""
    known = [{"folder": f"{root}/{f}", "_batch": unquote(f.split("/")[0].removeprefix(f"{BATCH}="))} for f in folders.values()]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("folder", "_batch")])
    df = spark.read.schema(T.StructType(list(table.schema.fields)).add(BATCH, T.StringType()))
    df = df.option("basePath", root).parquet(*[k["folder"] for k in known])
    rows = df.select(*table.schema.fieldNames())
    nulls = [[F.lit(c), F.count_if(F.col(quoted(c)).isNull())] for c in rows.columns]
    found = df.groupBy(F.col(BATCH).alias("_batch")).agg(
        F.max("_metadata.file_modification_time").alias("loaded_at"),
        F.count(F.lit(1)).alias("n"),
        checksum(rows).alias("sum"),
        F.create_map(*[c for pair in nulls for c in pair]).alias("nulls"),
        _key_sketch(rows, table.key).alias("keys"),
    )
    none = F.create_map(*[c for name, _ in nulls for c in (name, F.lit(0).cast("long"))])
    return rows_frame(spark, known, schema).join(found, "_batch", "left").select(
        "folder",
        F.col("_batch").alias("batch_id"),
        "loaded_at",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce("sum", F.lit(0)).cast(SUM_TYPE).alias("checksum"),
        F.coalesce("nulls", none).alias("nulls"),
        "keys",
    )


def batch_measures(spark: SparkSession, tables: Mapping[str, ParquetTable]) -> DataFrame:
    """table_name, batch_id, loaded_at, n_rows, checksum, nulls by column, and keys as a sketch, of each batch that counts.

    A batch that was measured before is not read again; the others are, in one scan a table, and
    their measures stored beside the listings. A repeated, replaced or compacted batch lies in another folder
    and is measured anew. A batch without rows has zeros and no time; a table without a key no sketch.
    """
    found = []
    for name, table in tables.items():
        _, listing = table._listing(spark)
        if not listing.folders:
            continue
        wanted = {f"{listing.root}/{f}": b for b, f in listing.folders.items()}
        new = set(wanted) - _known(spark, table)
        if new:
            folders = {b: f for b, f in listing.folders.items() if f"{listing.root}/{f}" in new}
            _measured(table, spark, folders, listing.root).write.parquet(f"{_stored(table)}/{uuid.uuid4().hex}")
        rows = _read(spark, table).where(F.col("folder").isin(list(wanted))).dropDuplicates(["folder"])
        found.append(rows.select(F.lit(name).alias("table_name"), *MEASURES.fieldNames()[1:]))
    schema = T.StructType([T.StructField("table_name", T.StringType()), *MEASURES.fields[1:]])
    return reduce(DataFrame.unionByName, found, spark.createDataFrame([], schema))


def _read(spark: SparkSession, table: ParquetTable) -> DataFrame:
    sets = [f"{_stored(table)}/{n}" for n in names(spark, _stored(table))]
    return spark.read.schema(MEASURES).parquet(*sets) if sets else spark.createDataFrame([], MEASURES)


def _known(spark: SparkSession, table: ParquetTable) -> set[str]:
    return {r["folder"] for r in _read(spark, table).select("folder").collect()}


def fold(spark: SparkSession, table: ParquetTable) -> None:
    """Put the stored measures of a table's present batches in one set and remove all others."""
    old = names(spark, _stored(table))
    _, listing = table._listing(spark)
    wanted = [f"{listing.root}/{f}" for f in listing.folders.values()]
    kept = _read(spark, table).where(F.col("folder").isin(wanted)).dropDuplicates(["folder"])
    kept.coalesce(1).write.parquet(f"{_stored(table)}/{uuid.uuid4().hex}")
    for name in old:
        delete(spark, f"{_stored(table)}/{name}")


def totals(measures: DataFrame, *by: str | Column) -> DataFrame:
    """Batches, rows, checksum and about how many distinct keys, by ``table_name`` and ``by``.

    Counts and checksum are exact; ``distinct_keys`` is an estimate, null without a key or rows.
    """
    return measures.groupBy("table_name", *by).agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("checksum").cast(SUM_TYPE).alias("checksum"),
        F.when(F.count("keys") > 0, F.hll_sketch_estimate(F.hll_union_agg("keys"))).alias("distinct_keys"),
    )


def null_totals(measures: DataFrame, *by: str | Column) -> DataFrame:
    """How many values of each column are null, by ``table_name``, ``by`` and ``column``."""
    flat = measures.select("*", F.explode("nulls").alias("column", "n"))
    return flat.groupBy("table_name", *by, "column").agg(F.sum("n").alias("nulls"))
