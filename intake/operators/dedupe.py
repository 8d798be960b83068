"""Duplicates inside a batch and between a batch and its target table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.functions.checksum import checksum, row_hash

# Sets of keys up to this measured size are broadcast.
BROADCAST_LIMIT = 32 * 1024 * 1024

RANGE_TYPES = (T.IntegralType, T.DecimalType, T.DateType, T.StringType)


def _sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return _sortable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_sortable(f.dataType) for f in data_type.fields)
    return True


def _total_order(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> list[Column]:
    """``order_by``, then every other column, so ties cannot matter.

    Columns that cannot be sorted, as they hold a map, count by the hash of the row.
    """
    rest = [f for f in df.schema.fields if f.name not in key and f.name not in order_by]
    plain = [F.col(f.name) for f in rest if _sortable(f.dataType)]
    hashed = [row_hash(df)] if len(plain) < len(rest) else []
    return [*[F.col(c) for c in order_by], *plain, *hashed]


def first_per_key(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Keep one row per key: the first in ``order_by``.

    A ``row_number() = 1`` filter. Spark cuts each key to one row per task
    *before* the shuffle (``WindowGroupLimit``), so a hot key sends at most one
    row per input task over the network.
    """
    window = Window.partitionBy(*key).orderBy(*(_total_order(df, key, order_by) or key))
    return (
        df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
    )


@dataclass(frozen=True)
class KeyStats:
    """Size and ranges of a batch's keys, and the rows' checksum, measured by one scan."""

    n_rows: int
    n_null: int
    n_bytes: int
    bounds: dict[str, tuple] = field(default_factory=dict)
    checksum: int | None = None


def _bytes_of(column: str, data_type: T.DataType) -> Column:
    """What a value takes in memory, or more."""
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(data_type, T.DecimalType):
        return F.lit(16)
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        # Its text, and a header for whatever is in it.
        return 8 * F.octet_length(F.to_json(F.struct(column), {"ignoreNullFields": "false"}))
    return F.lit(8)


def key_bytes(df: DataFrame, key: Sequence[str]) -> Column:
    """Memory one key takes in a broadcast: its values and a row's overhead."""
    sizes = [_bytes_of(c, df.schema[c].dataType) for c in key]
    return (reduce(add, sizes) + F.lit(16)).cast("bigint")


def key_stats(batch: DataFrame, key: Sequence[str], identify: bool = False) -> KeyStats:
    """Measures a batch's keys; with ``identify`` its rows' checksum too, in the same scan."""
    ranged = [c for c in key if isinstance(batch.schema[c].dataType, RANGE_TYPES)]
    bounds = [x for i, c in enumerate(ranged) for x in (F.min(c).alias(f"low_{i}"), F.max(c).alias(f"high_{i}"))]
    row = batch.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(reduce(or_, [F.col(c).isNull() for c in key])).alias("n_null"),
        F.coalesce(F.sum(key_bytes(batch, key)), F.lit(0)).alias("bytes"),
        (checksum(batch) if identify else F.lit(None)).alias("sum"),
        *bounds,
    ).first()
    pairs = {c: (row[f"low_{i}"], row[f"high_{i}"]) for i, c in enumerate(ranged)}
    return KeyStats(row["n"], row["n_null"], row["bytes"], pairs, row["sum"])


def in_range(target: DataFrame, key: Sequence[str], stats: KeyStats | None) -> DataFrame:
    """Only target keys between the batch's lowest and highest, in every key column.

    Reaches the scan as pushed filters, so old files and row groups are skipped
    when keys grow over time.
    """
    for column, (low, high) in (stats.bounds if stats else {}).items():
        if low is not None:
            data_type = target.schema[column].dataType
            target = target.where(
                F.col(column).between(F.lit(low).cast(data_type), F.lit(high).cast(data_type))
            )
    return target


def duplicate_report(
    batch: DataFrame,
    target: DataFrame | None,
    key: Sequence[str],
    stats: KeyStats | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Keys that repeat in the batch or already exist in the target (None: an empty one).

    Columns: the key, ``n_in_batch`` (rows of the batch) and ``in_target``. Only key
    columns are read and shuffled, each side reduced to its keys per task first.

    The target is the big side, so it should not move: when the batch's keys are
    measured to be small they are broadcast to the target scan and only matches go
    on. Otherwise the two sets of keys meet by a shuffle, or where a bucketed target
    has them already.
    """
    counts = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("n_in_batch"))
    asked = counts if stats is not None and stats.n_bytes <= broadcast_limit else None
    return counts_report(counts, target, key, stats, asked)


def counts_report(
    counts: DataFrame,
    target: DataFrame | None,
    key: Sequence[str],
    stats: KeyStats | None = None,
    asked: DataFrame | None = None,
) -> DataFrame:
    """The same from a batch's keys and their counts.

    ``asked`` are keys few enough to be broadcast, among them all that the target may hold.
    """
    if target is None:
        return counts.where("n_in_batch > 1").withColumn("in_target", F.lit(False))
    held = in_range(target.select(*key), key, stats)
    if asked is not None:
        held = held.join(F.broadcast(asked.select(*key)), list(key), "left_semi")
    held = held.distinct().withColumn("in_target", F.lit(True))
    return (
        counts.join(held, list(key), "left")
        .withColumn("in_target", F.coalesce("in_target", F.lit(False)))
        .where("n_in_batch > 1 or in_target")
    )


@dataclass(frozen=True)
class Duplicates:
    """A stored ``duplicate_report`` and what was counted while writing it."""

    keys: DataFrame
    n_keys: int
    n_bytes: int
    n_repeated: int  # keys with several rows in the batch
    n_held: int  # keys the target holds

    @staticmethod
    def counts(report: DataFrame, key: Sequence[str]) -> list[Column]:
        """Aggregates over a report, named like the fields."""
        return [
            F.count(F.lit(1)).alias("n_keys"),
            F.coalesce(F.sum(key_bytes(report, key)), F.lit(0)).alias("n_bytes"),
            F.count_if(F.col("n_in_batch") > 1).alias("n_repeated"),
            F.count_if("in_target").alias("n_held"),
        ]


def new_rows(
    batch: DataFrame,
    duplicates: Duplicates,
    key: Sequence[str],
    order_by: Sequence[str] = (),
    n_rows: int = 0,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """One row per key of the batch, leaving out keys the target holds.

    Does no more than the counts ask for. Rows are ranked only if a key repeats and
    matched only if the target holds one. Where few keys are concerned (a hot key is
    one key, however many rows it has) they are broadcast, rows of other keys pass
    straight through and only repeated rows are shuffled. Where many are, every row
    is shuffled by key once, for the ranking and the join alike.
    """
    key = list(key)
    broadcastable = duplicates.n_bytes <= broadcast_limit
    held = duplicates.keys.where("in_target").select(*key)
    if not duplicates.n_repeated:
        if not duplicates.n_held:
            return batch
        return batch.join(F.broadcast(held) if broadcastable else held, key, "left_anti")
    if broadcastable and duplicates.n_keys * 10 <= n_rows:
        concerned = F.broadcast(duplicates.keys.select(*key))
        repeated = F.broadcast(duplicates.keys.where("not in_target").select(*key))
        unique = batch.join(concerned, key, "left_anti")
        first = first_per_key(batch.join(repeated, key, "left_semi"), key, order_by)
        return unique.unionByName(first)
    first = first_per_key(batch, key, order_by)
    return first.join(held, key, "left_anti") if duplicates.n_held else first
