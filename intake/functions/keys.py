"""Table names and gates out of object keys (``ingestion/orders.csv``)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one accepted file type and the verdicts of the gate.
FILE_TYPE = "csv"
PASS = "pass"
WRONG_TYPE = "wrong type"
UNKNOWN_TABLE = "unknown table"


def table_name(key: Column) -> Column:
    """The last path segment, up to its first dot."""
    return F.split_part(F.split_part(key, F.lit("/"), F.lit(-1)), F.lit("."), F.lit(1))


def file_type_ok(key: Column, parity: bool = False) -> Column:
    """Is this a ``.csv`` file, in any case?

    ``parity=True`` is the looser classic test: the key ends in the three
    letters ``csv``, case-sensitive, with or without a dot.
    """
    if parity:
        return key.endswith(FILE_TYPE)
    return F.lower(key).endswith(f".{FILE_TYPE}")


def key_verdict(key: Column, tables: Iterable[str], parity: bool = False) -> Column:
    """``pass``, ``wrong type`` or ``unknown table``, the type being tested first."""
    known = table_name(key).isin(*tables)
    return (
        F.when(~file_type_ok(key, parity), F.lit(WRONG_TYPE))
        .when(~known, F.lit(UNKNOWN_TABLE))
        .otherwise(F.lit(PASS))
    )
