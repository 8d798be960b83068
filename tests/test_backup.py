"""Snapshots: published last, checked, restored, expired."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intake.contracts import Field, TableContract
from intake.functions.checksum import checksum
from intake.operators.rules import NotNull
from intake.plans.audit import AuditLog
from intake.plans.backup import (
    backup,
    expire,
    read_manifest,
    read_snapshot,
    restore,
    verify,
)
from intake.plans.load import load
from intake.plans.requests import handle, route
from intake.sources.files import delete, exists, names
from intake.sources.tables import Expected, ParquetTable, parquet_tables
from registry.queries import TABLES
from tests.conftest import SF_DIR

C = TableContract(
    "c", (Field("id", "int"), Field("v")), rules=(NotNull("id"),), key=("id",)
)


def frame(spark, rows):
    return spark.createDataFrame(rows, C.table_schema)


def table_at(folder, name="c"):
    return ParquetTable(f"{folder}/tables/{name}", C.table_schema)


def content(spark, target):
    return sorted(tuple(r) for r in target.rows(spark).collect())


def total(df):
    return df.agg(checksum(df)).first()[0]


def test_checksum_ignores_order_and_sees_changes(spark):
    rows = [(1, "a"), (2, None), (None, "a"), (3, "b"), (3, "b")]
    df = frame(spark, rows)
    assert total(df) == total(frame(spark, rows[::-1]).repartition(3))
    assert total(df) != total(frame(spark, rows[:-1]))
    pair = spark.createDataFrame([(None, "a")], "p string, q string")
    swapped = spark.createDataFrame([("a", None)], "p string, q string")
    assert total(pair) != total(swapped)
    assert total(frame(spark, [])) == 0


def test_checksum_of_nested_columns(spark):
    schema = "a array<int>, s struct<x:int,m:map<string,int>>, m map<string,int>, b binary"
    df = spark.createDataFrame([([1, 2], (1, {"k": 1}), {"k": 2}, bytearray(b"x"))], schema)
    assert total(df) == total(df.repartition(2))


def test_every_given_table_survives_the_round_trip(spark, folder):
    sources = parquet_tables(SF_DIR, TABLES, spark)
    manifest = backup(spark, sources, folder, snapshot_id="s1")
    assert manifest.count() == len(TABLES)
    assert verify(spark, folder, "s1").where("verified").count() == len(TABLES)
    for name in ("embeddings", "events"):
        back = read_snapshot(spark, folder, name)
        assert back.schema == T.StructType(sources[name].schema.fields)
        assert back.exceptAll(sources[name]).isEmpty()


def test_verify_notices_damage(spark, folder):
    backup(spark, {"c": frame(spark, [(1, "a"), (2, "b")])}, folder, snapshot_id="s1")
    frame(spark, [(1, "a"), (2, "x")]).write.mode("overwrite").parquet(f"{folder}/snapshots/s1/c")
    got = verify(spark, folder, "s1").first()
    assert (got.n_rows, got.rows_found, got.verified) == (2, 2, False)


def test_a_snapshot_with_lost_rows_is_not_restored(spark, folder):
    target = table_at(folder)
    target.append(frame(spark, [(1, "a"), (2, "b")]), "b1")
    root = f"{folder}/backup"
    backup(spark, {"c": target}, root, snapshot_id="s1")
    lost = frame(spark, [(1, "a")]).withColumn("batch_id", F.lit("b1"))
    lost.write.mode("overwrite").parquet(f"{root}/snapshots/s1/c")
    with pytest.raises(ValueError, match="has 1 rows, not 2"):
        restore(spark, root, "c", target)
    assert content(spark, target) == [(1, "a"), (2, "b")]


def test_a_snapshot_with_other_values_is_not_restored(spark, folder):
    target = table_at(folder)
    target.append(frame(spark, [(1, "a"), (2, "b")]), "b1")
    root = f"{folder}/backup"
    backup(spark, {"c": target}, root, snapshot_id="s1")
    changed = frame(spark, [(1, "a"), (2, "x")]).withColumn("batch_id", F.lit("b1"))
    changed.write.mode("overwrite").parquet(f"{root}/snapshots/s1/c")
    with pytest.raises(ValueError, match="other values"):
        restore(spark, root, "c", target)
    with pytest.raises(ValueError, match="other values"):
        restore(spark, root, "c", target, mode="append", contract=C)
    assert content(spark, target) == [(1, "a"), (2, "b")]


def test_checksum_sees_nested_nulls(spark):
    schema = "a array<string>, s struct<x:string,y:struct<z:string,w:string>>"
    rows = [
        [(["p", None], ("q", ("r", None)))],
        [([None, "p"], ("q", ("r", None)))],
        [(["p", None], ("q", (None, "r")))],
        [(["p"], ("q", ("r", None)))],
        [(["p", None], ("q", None))],
        [(None, ("q", None))],
    ]
    sums = [total(spark.createDataFrame(r, schema)) for r in rows]
    assert len(set(sums)) == len(rows)


def test_backup_and_restore_leave_rows_in_the_log(spark, folder):
    audit, target, root = AuditLog(f"{folder}/audit"), table_at(folder), f"{folder}/backup"
    target.append(frame(spark, [(1, "a"), (2, "b")]), "b1")
    bad = frame(spark, [(1, "a")]).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    handle(spark, "/backup", {"c": target}, root, audit)
    handle(spark, "/restore/c", {"c": target}, root, audit)
    with pytest.raises(Exception, match="lost"):
        backup(spark, {"d": bad}, root, snapshot_id="s2", audit=audit)
    with pytest.raises(ValueError, match="no snapshot"):
        restore(spark, root, "d", target, audit=audit)
    got = [(r.step, r.table_name, r.status, r.scanned, r.loaded) for r in audit.read(spark).orderBy("started_at").collect()]
    assert got == [
        ("backup", "c", "ok", 2, None),
        ("restore", "c", "ok", None, 2),
        ("backup", "d", "failed", None, None),
        ("restore", "d", "failed", None, None),
    ]


def test_expire_removes_what_failed_backups_left(spark, folder):
    good = frame(spark, [(1, "a")])
    bad = good.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    backup(spark, {"c": good}, folder, snapshot_id="s1")
    with pytest.raises(Exception, match="lost"):
        backup(spark, {"c": good, "d": bad}, folder, snapshot_id="s2")
    assert expire(spark, folder, keep=1) == []
    assert expire(spark, folder, keep=1, unpublished=True) == ["s2"]
    assert not exists(spark, f"{folder}/snapshots/s2")
    assert read_snapshot(spark, folder, "c").collect() == [(1, "a")]


def test_failed_backup_leaves_the_last_snapshot(spark, folder):
    good = frame(spark, [(1, "a")])
    bad = good.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    backup(spark, {"c": good, "d": good}, folder, snapshot_id="s1")
    with pytest.raises(Exception, match="lost"):
        backup(spark, {"c": good, "d": bad}, folder, snapshot_id="s2")
    assert {r.snapshot_id for r in read_manifest(spark, folder).collect()} == {"s1"}
    assert read_snapshot(spark, folder, "d").collect() == [(1, "a")]
    backup(spark, {"c": good, "d": good}, folder, snapshot_id="s2")  # may be tried again
    with pytest.raises(ValueError, match="already exists"):
        backup(spark, {"c": good}, folder, snapshot_id="s2")


def test_restore_replace_and_append(spark, folder):
    target = table_at(folder)
    target.append(frame(spark, [(1, "a"), (2, "b"), (3, "c")]), "b1")
    root = f"{folder}/backup"
    backup(spark, {"c": target}, root)
    target.replace(frame(spark, [(2, "changed"), (9, "extra")]))
    assert restore(spark, root, "c", target, mode="append", contract=C) == 2
    assert content(spark, target) == [(1, "a"), (2, "changed"), (3, "c"), (9, "extra")]
    assert restore(spark, root, "c", target) == 3
    assert content(spark, target) == [(1, "a"), (2, "b"), (3, "c")]
    assert {r.batch_id for r in target.read(spark).collect()} == {"b1"}
    with pytest.raises(ValueError, match="needs a contract"):
        restore(spark, root, "c", target, mode="append")
    with pytest.raises(ValueError, match="unknown restore mode"):
        restore(spark, root, "c", target, mode="merge")


def test_named_and_latest_snapshot(spark, folder):
    for i in (1, 2):
        backup(spark, {"c": frame(spark, [(i, "v")])}, folder, snapshot_id=f"s{i}")
    assert read_snapshot(spark, folder, "c").collect() == [(2, "v")]
    assert read_snapshot(spark, folder, "c", "s1").collect() == [(1, "v")]
    with pytest.raises(ValueError, match="no snapshot"):
        read_snapshot(spark, folder, "c", "s3")
    with pytest.raises(ValueError, match="no snapshot"):
        read_snapshot(spark, folder, "other")


def test_expire_keeps_the_newest(spark, folder):
    for i in (1, 2, 3):
        backup(spark, {"c": frame(spark, [(i, "v")])}, folder, snapshot_id=f"s{i}")
    assert expire(spark, folder, keep=1) == ["s2", "s1"]
    assert {r.snapshot_id for r in read_manifest(spark, folder).collect()} == {"s3"}
    assert not exists(spark, f"{folder}/snapshots/s1")
    assert read_snapshot(spark, folder, "c").collect() == [(3, "v")]
    with pytest.raises(ValueError, match="at least one"):
        expire(spark, folder, keep=0)


def test_unknown_tables_and_ids_are_refused(spark, folder):
    good = frame(spark, [(1, "a")])
    with pytest.raises(ValueError, match="no such table"):
        backup(spark, {"c": good}, folder, tables=["c", "x"])
    with pytest.raises(ValueError, match="none given"):
        backup(spark, {}, folder)
    with pytest.raises(ValueError, match="snapshot id"):
        backup(spark, {"c": good}, folder, snapshot_id="../up")
    with pytest.raises(ValueError, match="no snapshot"):
        verify(spark, folder, "s1")


def test_avro_if_the_source_is_there(spark, folder):
    good = frame(spark, [(1, "a")])
    try:
        backup(spark, {"c": good}, folder, fmt="avro")
    except Exception as error:
        if "spark-avro" in str(error) or "Failed to find data source" in str(error):
            pytest.skip("the Avro source is not on the class path")
        if "AVRO" in str(error).upper():
            pytest.skip("the Avro source is not on the class path")
        raise
    assert read_snapshot(spark, folder, "c").collect() == [(1, "a")]


def test_requests(spark, folder):
    paths = ["/backup", "/backup/", "/restore/c", "/restore/x", "/restore", "/delete/c", ""]
    asked = spark.createDataFrame([(p,) for p in paths], "path string")
    got = [(r.action, r.table_name) for r in route(asked, ["c"]).collect()]
    assert got == [
        ("backup", None),
        ("backup", None),
        ("restore", "c"),
        ("refused", "x"),
        ("refused", None),
        ("refused", None),
        ("refused", None),
    ]
    target = table_at(folder)
    target.append(frame(spark, [(1, "a")]), "b1")
    root = f"{folder}/backup"
    handle(spark, "/backup", {"c": target}, root)
    target.replace(frame(spark, []))
    assert handle(spark, "/restore/c", {"c": target}, root) == 1
    assert content(spark, target) == [(1, "a")]
    with pytest.raises(ValueError, match="neither a backup nor"):
        handle(spark, "/restore/x", {"c": target}, root)


def test_a_table_with_variants_is_backed_up_and_told_apart(spark, folder):
    def rows(text):
        return spark.createDataFrame([(1, text), (2, None)], "id int, v string").selectExpr("id", "parse_json(v) AS v")

    backup(spark, {"t": rows('{"a": [1, null]}')}, folder, snapshot_id="s")
    assert verify(spark, folder, "s").first()["verified"]
    one, other = (Expected.of(rows(t)).checksum for t in ('{"a": [1, null]}', '{"a": [1, 2]}'))
    assert one != other == Expected.of(rows('{"a":[1,2]}')).checksum


def paths_of(spark, root, snapshot):
    parts = read_manifest(spark, root).where(F.col("snapshot_id") == snapshot).first()["parts"]
    return {p["path"] for p in parts}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_one_changed_row_writes_one_part(spark, folder):
    first = [(i, f"v{i}") for i in range(200)] + [(7, "v7"), (None, "x"), (None, None)]
    second = [(i, "new" if i == 11 else v) for i, v in first]
    args = {"keys": {"c": ("id",)}, "parts": 8}
    backup(spark, {"c": frame(spark, first)}, folder, snapshot_id="s1", **args)
    backup(spark, {"c": frame(spark, first[::-1])}, folder, snapshot_id="s2", **args)
    backup(spark, {"c": frame(spark, second)}, folder, snapshot_id="s3", **args)
    one, two, three = (paths_of(spark, folder, s) for s in ("s1", "s2", "s3"))
    assert len(one) == 8 and one == two and len(three - one) == 1
    for snapshot, want in (("s1", first), ("s2", first), ("s3", second)):
        assert rows_of(read_snapshot(spark, folder, "c", snapshot)) == sorted(want, key=repr)
    # What the newest names stays, what only the older ones named goes.
    assert expire(spark, folder, keep=1) == ["s2", "s1"]
    assert all(exists(spark, p) for p in three) and not any(exists(spark, p) for p in one - three)
    got = verify(spark, folder, "s3").first()
    assert got["verified"] and got["rows_found"] == len(second) and got["wrong_parts"] == []
    target = table_at(folder)
    assert restore(spark, folder, "c", target) == len(second)
    assert rows_of(target.rows(spark)) == sorted(second, key=repr)


def test_parts_of_another_cut_are_written_anew(spark, folder):
    df = frame(spark, [(i, f"v{i}") for i in range(50)])
    cuts = [({"c": ("id",)}, 4), ({"c": ("id",)}, 5), ({"c": ("id", "v")}, 5), (None, 5), ({"c": ("id", "v")}, 5)]
    for i, (keys, parts) in enumerate(cuts):
        backup(spark, {"c": df}, folder, snapshot_id=f"s{i}", keys=keys, parts=parts)
    wider = df.withColumn("id", F.col("id").cast("long"))
    backup(spark, {"c": wider}, folder, snapshot_id="s5", keys=cuts[-1][0], parts=5)
    named = [paths_of(spark, folder, f"s{i}") for i in (0, 1, 2, 4, 5)]
    assert sum(map(len, named)) == len(set().union(*named))
    for i in range(6):
        assert verify(spark, folder, f"s{i}").first()["verified"]
        assert read_snapshot(spark, folder, "c", f"s{i}").count() == 50


def test_verify_names_the_wrong_part(spark, folder):
    df = frame(spark, [(i, f"v{i}") for i in range(100)])
    backup(spark, {"c": df, "d": df}, folder, snapshot_id="s", keys={"c": ("id",)}, parts=6)
    parts = {p["part"]: p["path"] for p in read_manifest(spark, folder).where("table_name = 'c'").first()["parts"]}
    damaged = spark.read.schema(C.table_schema).parquet(parts[2]).withColumn("v", F.lit("bad")).collect()
    frame(spark, damaged).write.mode("overwrite").parquet(parts[2])
    delete(spark, parts[5])
    got = {r.table_name: r for r in verify(spark, folder, "s").collect()}
    assert got["c"].wrong_parts == [2, 5] and not got["c"].verified
    assert got["d"].wrong_parts == [] and got["d"].verified
    target = table_at(folder)
    load(spark, df, target, C, "b")
    with pytest.raises(Exception):
        restore(spark, folder, "c", target)
    assert target.rows(spark).count() == 100
    # The next backup writes what is gone, and what differs from the table only if the manifest says so.
    backup(spark, {"c": df}, folder, snapshot_id="s2", keys={"c": ("id",)}, parts=6)
    assert paths_of(spark, folder, "s2") - set(parts.values()) and verify(spark, folder, "s2").first()["wrong_parts"] == [2]


def test_parts_of_odd_tables(spark, folder):
    keys = {"c": ("id",)}
    backup(spark, {"c": frame(spark, [])}, folder, snapshot_id="none", keys=keys)
    got = verify(spark, folder, "none").first()
    assert got["verified"] and got["n_rows"] == 0 and read_snapshot(spark, folder, "c").collect() == []
    schema = "id int, _part int, m map<string,int>, a array<int>"
    odd = spark.createDataFrame([(1, 5, {"k": 1}, [1, None]), (1, 5, {"k": 1}, [1, None]), (None, None, None, None)], schema)
    backup(spark, {"c": odd}, folder, snapshot_id="odd", keys=keys, parts=3)
    assert rows_of(read_snapshot(spark, folder, "c")) == rows_of(odd)
    assert verify(spark, folder, "odd").first()["verified"]
    for bad in ({"keys": {"x": ("id",)}}, {"keys": {"c": ()}}, {"keys": keys, "parts": 0}):
        with pytest.raises(ValueError):
            backup(spark, {"c": odd}, folder, **bad)


def test_parts_of_a_backup_that_died_are_swept(spark, folder):
    keys = {"c": ("id",)}
    good = frame(spark, [(i, "v") for i in range(20)])
    backup(spark, {"c": good}, folder, snapshot_id="s1", keys=keys, parts=2)
    failing = good.withColumn("v", F.lit("w")).withColumn(
        "v", F.when(F.col("id") == 19, F.raise_error(F.lit("gone"))).otherwise(F.col("v"))
    )
    other = frame(spark, [(i, "w") for i in range(20)])
    with pytest.raises(Exception):
        backup(spark, {"c": other, "d": failing}, folder, snapshot_id="s2", keys=keys | {"d": ("id",)}, parts=2)
    assert [r.snapshot_id for r in read_manifest(spark, folder).collect()] == ["s1"]
    stored = names(spark, f"{folder}/parts/c")
    assert len(stored) == 2
    expire(spark, folder, keep=1, unpublished=True)
    assert len(names(spark, f"{folder}/parts/c")) == 1 and verify(spark, folder, "s1").first()["verified"]
    # The same id may be used again, and shares with what was published only.
    backup(spark, {"c": good}, folder, snapshot_id="s2", keys=keys, parts=2)
    assert paths_of(spark, folder, "s2") == paths_of(spark, folder, "s1")
