"""Measures of batches: exact where they add up, taken once, none of a batch that does not count."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from intake.contracts import Field, TableContract
from intake.operators.rules import NotNull
from intake.plans.load import load
from intake.plans.measures import batch_measures, fold, null_totals, totals
from intake.sources.files import names
from intake.sources.tables import Expected, ParquetTable

C = TableContract("c", (Field("id", "int"), Field("v")), rules=(NotNull("id"),), key=("id",))


def frame(spark, rows):
    return spark.createDataFrame(rows, C.table_schema)


def at(folder, key=C.key):
    return ParquetTable(f"{folder}/c", C.table_schema, key)


def one(df):
    return df.first().asDict()


def test_totals_equal_those_of_the_rows(spark, folder):
    table = at(folder)
    for b in range(3):
        rows = [(i, None if i % 5 == 0 else f"v{i}") for i in range(b * 1000, b * 1000 + 1000)]
        load(spark, frame(spark, rows), table, C, f"day-{b}.x_1")
    got = one(totals(batch_measures(spark, {"c": table})))
    want = Expected.of(table.rows(spark))
    assert (got["batches"], got["n_rows"], got["checksum"]) == (3, want.n_rows, want.checksum)
    assert abs(got["distinct_keys"] - 3000) < 150
    nulls = {r["column"]: r.nulls for r in null_totals(batch_measures(spark, {"c": table})).collect()}
    assert nulls == {"id": 0, "v": 600}
    days = totals(batch_measures(spark, {"c": table}), F.to_date("loaded_at").alias("day")).collect()
    assert sum(r.n_rows for r in days) == 3000 and all(r.day is not None for r in days)


def test_a_measured_batch_is_not_read_again(spark, folder):
    table = at(folder)
    load(spark, frame(spark, [(1, "a"), (2, None)]), table, C, "one")
    before = batch_measures(spark, {"c": table}).collect()
    for file in Path(f"{folder}/c").rglob("*.parquet"):
        file.write_bytes(b"no rows can be read from this")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):
        table.rows(spark).collect()
    assert batch_measures(spark, {"c": table}).collect() == before


def test_repeated_replaced_and_compacted_batches_are_measured_anew(spark, folder):
    table = at(folder)
    tables = {"c": table}
    load(spark, frame(spark, [(1, "a"), (2, "b")]), table, C, "one", source="s")
    assert one(totals(batch_measures(spark, tables)))["n_rows"] == 2
    load(spark, frame(spark, [(1, "a"), (2, "b"), (3, "c")]), table, C, "one", source="s")
    assert [(r.batch_id, r.n_rows) for r in batch_measures(spark, tables).collect()] == [("one", 3)]
    load(spark, frame(spark, [(4, "d")]), table, C, "two")
    table.compact(spark)
    got = one(totals(batch_measures(spark, tables)))
    assert (got["batches"], got["n_rows"], got["distinct_keys"]) == (1, 4, 4)
    table.replace(frame(spark, [(9, None)]))
    assert one(totals(batch_measures(spark, tables)))["n_rows"] == 1
    stored = f"{table.meta}/measures"
    assert len(names(spark, stored)) > 1
    fold(spark, table)
    assert len(names(spark, stored)) == 1 and one(totals(batch_measures(spark, tables)))["n_rows"] == 1


def test_odd_tables(spark, folder):
    empty, keyless, none = at(f"{folder}/e"), at(f"{folder}/k", ()), at(f"{folder}/n")
    empty.append(frame(spark, []), "b")
    keyless.append(frame(spark, [(None, None), (None, "x")]), "b")
    none.append(frame(spark, [(None, "x"), (1, "x"), (1, "x")]), "b")
    got = {r.table_name: r for r in totals(batch_measures(spark, {"e": empty, "k": keyless, "n": none, "x": at(folder)})).collect()}
    assert set(got) == {"e", "k", "n"}
    assert (got["e"].n_rows, got["e"].checksum, got["k"].n_rows, got["k"].distinct_keys) == (0, 0, 2, None)
    assert (got["n"].n_rows, got["n"].distinct_keys) == (3, 1)
    assert batch_measures(spark, {"x": at(folder)}).collect() == []
