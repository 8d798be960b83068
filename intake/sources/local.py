"""Small driver-side facts (an audit row, a manifest) as a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def rows_frame(
    spark: SparkSession, rows: Iterable[Mapping[str, object]], schema: T.StructType
) -> DataFrame:
    """A few rows as a local relation: by Arrow, so no Python worker is started."""
    full = [{c: row.get(c) for c in schema.names} for row in rows]
    arrow = pa.Table.from_pylist(full, schema=to_arrow_schema(schema))
    return spark.createDataFrame(arrow, schema).coalesce(1)
