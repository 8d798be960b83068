"""Order-free checksum of a table, for comparing a copy with its source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wide enough for 1e18 rows of 64-bit hashes.
SUM_TYPE = "decimal(38,0)"


def _only_json(data_type: T.DataType) -> bool:
    """Whether a type holds a map or a variant, which cannot be hashed."""
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return True
    if isinstance(data_type, T.ArrayType):
        return _only_json(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(_only_json(f.dataType) for f in data_type.fields)
    return False


def _null_flags(value: Column, data_type: T.DataType) -> list[Column]:
    """Hashable marks of every null in a value, at any depth."""
    flags = [value.isNull()]
    if isinstance(data_type, T.StructType):
        for f in data_type.fields:
            flags += _null_flags(value[f.name], f.dataType)
    elif isinstance(data_type, T.ArrayType):
        inner = data_type.elementType
        flags.append(F.transform(value, lambda x: F.xxhash64(*_null_flags(x, inner))))
    return flags


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a whole row.

    ``xxhash64`` skips nulls, so where the nulls are is hashed as well, in nested values
    too; otherwise (null, 'a') and ('a', null) would look the same. Maps and variants cannot
    be hashed and go in as JSON, with their nulls.
    """
    parts = []
    for f in df.schema.fields:
        value = df[f.name]
        if _only_json(f.dataType):
            parts.append(F.to_json(F.struct(value), {"ignoreNullFields": "false"}))
        else:
            parts += [value, *_null_flags(value, f.dataType)]
    return F.xxhash64(*parts)


def checksum(df: DataFrame) -> Column:
    """Aggregate: sum of the row hashes. Counts repeated rows, ignores order."""
    return F.coalesce(
        F.sum(row_hash(df).cast(SUM_TYPE)), F.lit(0).cast(SUM_TYPE)
    ).cast(SUM_TYPE)
