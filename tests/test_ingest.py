"""Whole runs: file, folder and stream give the same table, and a log."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from intake.contracts import landing_contract
from intake.operators.rules import InSet
from intake.operators.validate import accepted
from intake.plans.audit import AuditLog, load_report
from intake.plans.ingest import Intake, ingest_batch, ingest_file, ingest_folder, ingest_new
from intake.plans.replay import replay
from intake.sources.landing import list_landing, read_landing, refused, write_landing
from intake.sources.ledger import FileLedger
from intake.sources.staged import read_quarantine
from intake.sources.tables import ParquetTable
from intake.streaming import ingest_stream, log_refusals
from intake.workspace import run_dir, shared_dir
from registry.fixtures import landing, landing_file
from tests.conftest import SF_DIR

ORDERS = landing_contract("orders")


def intake_at(folder, *contracts):
    contracts = contracts or (ORDERS,)
    targets = {c.name: ParquetTable(f"{folder}/t/{c.name}", c.table_schema) for c in contracts}
    return Intake.of(contracts, f"{folder}/staged", targets, f"{folder}/audit")


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def log(spark, intake):
    return intake.audit.read(spark).orderBy("started_at").collect()


def test_file_to_table(spark, folder):
    intake, path = intake_at(folder), landing_file(spark, SF_DIR)
    done = ingest_file(spark, path, intake, "b1")
    assert (done.staged.accepted, done.load.loaded, done.load.skipped) == (1377, 1377, 0)
    want = accepted(read_landing(spark, path, ORDERS), ORDERS)
    assert same_rows(intake.targets["orders"].rows(spark), want)
    row = log(spark, intake)[0]
    assert (row.status, row.scanned, row.accepted, row.rejected) == ("ok", 1500, 1377, 123)
    assert row.violations["not_int:id"] == 32
    assert row.loaded == 1377 and row.schema_json == ORDERS.table_schema.json()


def test_same_file_again(spark, folder):
    intake, path = intake_at(folder), landing_file(spark, SF_DIR)
    for batch_id, loaded in (("b1", 1377), ("b1", 1377), ("b2", 0)):
        assert ingest_file(spark, path, intake, batch_id).load.loaded == loaded
    assert intake.targets["orders"].rows(spark).count() == 1377


@pytest.mark.parametrize(
    ("name", "content", "message"),
    [
        ("orders.txt", "1;a;x;1;2\n", "not a csv"),
        ("people.csv", "1;a;x;1;2\n", "no contract"),
        ("orders.csv", "1;a;x;1\n", "4 columns"),
        ("orders.csv", "", "0 columns"),
        ("orders.csv", "x;a;x;1;2\n", "no row left"),
    ],
)
def test_refused_files_are_logged_and_raised(spark, folder, tmp_path, name, content, message):
    (tmp_path / name).write_text(content)
    intake = intake_at(folder)
    with pytest.raises(ValueError, match=message):
        ingest_file(spark, str(tmp_path / name), intake, "b1")
    (row,) = log(spark, intake)
    assert row.status == "failed" and message in row.error and row.loaded is None
    assert intake.targets["orders"].rows(spark).isEmpty()


def test_bad_rows_of_a_refused_file_stay_in_quarantine(spark, folder, tmp_path):
    (tmp_path / "orders.csv").write_text("x;a;x;1;2\n")
    intake = intake_at(folder)
    with pytest.raises(ValueError, match="no row left"):
        ingest_file(spark, str(tmp_path / "orders.csv"), intake, "b1")
    bad = read_quarantine(spark, f"{folder}/staged", ORDERS).collect()
    assert [(r.id, r.reasons) for r in bad] == [("x", ["not_int:id"])]


def test_folder_with_several_tables(spark, folder, tmp_path):
    people = landing_contract("people")
    (tmp_path / "orders.csv").write_text("1;a;x;1;2\n")
    (tmp_path / "orders.v2.csv").write_text("2;b;x;1;2\nbad;b;x;1;2\n")
    (tmp_path / "people.csv").write_text("1;p;x;1;2\n")
    (tmp_path / "other.csv").write_text("1;p;x;1;2\n")
    intake = intake_at(folder, ORDERS, people)
    done = ingest_folder(spark, str(tmp_path), intake, "b1")
    assert {k: (r.staged.scanned, r.load.loaded) for k, r in done.items()} == {
        "orders": (3, 2),
        "people": (1, 1),
    }
    (row,) = [r for r in log(spark, intake) if r.status == "failed"]
    assert (row.step, row.table_name, row.batch_id) == ("gate", "other", "b1")
    assert row.error.startswith("unknown table: ") and row.error.endswith("other.csv")


def test_gate_of_a_folder(spark, folder, tmp_path):
    for name in ("orders.csv", "orders.txt", "x.csv", "sub/orders.v2.CSV", "sub/y.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("1;a;x;1;2\n2;b;x;1;2;7\n" if name == "orders.csv" else "3;a;x;1;2\n")
    intake = intake_at(folder)
    done = ingest_folder(spark, str(tmp_path), intake, "b1")
    assert done["orders"].staged.violations["malformed"] == 1
    assert (done["orders"].staged.scanned, done["orders"].load.loaded) == (3, 2)
    refusals = {(r.table_name, r.error.split(":")[0]) for r in log(spark, intake) if r.step == "gate"}
    assert refusals == {("orders", "wrong type"), ("x", "unknown table"), ("y", "wrong type")}
    bad = read_quarantine(spark, f"{folder}/staged", ORDERS).collect()
    assert [r.raw_line for r in bad] == ["2;b;x;1;2;7"]


def test_refused_files_of_a_stream_are_logged_once(spark, folder, tmp_path):
    intake = intake_at(folder)
    (tmp_path / "in").mkdir()

    def run():
        log_refusals(spark, str(tmp_path / "in"), intake, f"{folder}/gate").awaitTermination()
        return sorted(r.error.rsplit("/", 1)[-1] for r in log(spark, intake))

    (tmp_path / "in/orders.csv").write_text("1;a;x;1;2\n")
    (tmp_path / "in/other.csv").write_text("1;a;x;1;2\n")
    assert run() == ["other.csv"]
    (tmp_path / "in/orders.txt").write_text("1;a;x;1;2\n")
    assert run() == run() == ["orders.txt", "other.csv"]


def test_a_batch_id_belongs_to_its_file(spark, folder, tmp_path):
    intake = intake_at(folder)
    for name, i in (("orders.a.csv", 1), ("orders.b.csv", 2)):
        (tmp_path / name).write_text(f"{i};a;x;1;2\n")
    ingest_file(spark, str(tmp_path / "orders.a.csv"), intake, "day1")
    with pytest.raises(ValueError, match="belongs to another source"):
        ingest_file(spark, str(tmp_path / "orders.b.csv"), intake, "day1")
    assert [r.id for r in intake.targets["orders"].rows(spark).collect()] == ["1"]
    assert [r.status for r in log(spark, intake)] == ["ok", "failed"]
    ingest_file(spark, str(tmp_path / "orders.b.csv"), intake, "day1-b")
    ingest_file(spark, str(tmp_path / "orders.a.csv"), intake, "day1")
    assert sorted(r.id for r in intake.targets["orders"].rows(spark).collect()) == ["1", "2"]


def test_a_new_checkpoint_takes_nobodys_place(spark, folder, tmp_path):
    intake = intake_at(folder)
    for i in (1, 2):
        (tmp_path / f"in{i}").mkdir()
        (tmp_path / f"in{i}/orders.csv").write_text(f"{i};a;x;1;2\n")
        ingest_stream(spark, str(tmp_path / f"in{i}"), ORDERS, intake, f"{folder}/c{i}").awaitTermination()
    assert sorted(r.id for r in intake.targets["orders"].rows(spark).collect()) == ["1", "2"]


def test_read_files_of_a_stream_can_be_archived(spark, folder, tmp_path):
    intake = intake_at(folder)
    (tmp_path / "in").mkdir()
    for i in (1, 2, 3):
        (tmp_path / f"in/orders.{i}.csv").write_text(f"{i};a;x;1;2\n")
        query = ingest_stream(
            spark, str(tmp_path / "in"), ORDERS, intake, f"{folder}/c", archive=str(tmp_path / "done")
        )
        query.awaitTermination()
    assert sorted(r.id for r in intake.targets["orders"].rows(spark).collect()) == ["1", "2", "3"]
    assert len(list((tmp_path / "done").rglob("orders.*.csv"))) >= 1


def test_any_failure_leaves_a_row(spark, folder):
    intake = intake_at(folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        ingest_file(spark, f"{folder}/nowhere/orders.csv", intake, "b1")
    (row,) = log(spark, intake)
    assert (row.step, row.table_name, row.status) == ("gate", "orders", "failed")
    with pytest.raises(RuntimeError), intake.audit.run(spark, "ingest", "t", "b2"):
        raise RuntimeError("x" * 10000)
    assert len(log(spark, intake)[1].error) > 10000  # whole, whatever its length


def test_a_day_of_the_log_is_gathered(spark, folder):
    audit = AuditLog(f"{folder}/audit")
    for i in range(5):
        with audit.run(spark, "ingest", "t", f"b{i}") as row:
            row["scanned"] = i
    before = sorted(tuple(r) for r in audit.read(spark).drop("violations").collect())
    audit.compact(spark, before[0][-1])
    assert sorted(tuple(r) for r in audit.read(spark).drop("violations").collect()) == before
    assert len(audit.read(spark).inputFiles()) == 1


def test_stream_equals_batch_and_sees_each_file_once(spark, folder):
    contract = ORDERS.but(file_glob="*.csv")
    intake = intake_at(folder, contract)
    rows = landing(spark, SF_DIR)
    urgent = F.coalesce(F.col("name") < "3", F.lit(False))

    def run():
        query = ingest_stream(
            spark, f"{folder}/in", contract, intake, f"{folder}/checkpoint", max_files=2
        )
        query.awaitTermination()
        return intake.targets["orders"].rows(spark)

    write_landing(rows.where(urgent).repartition(3), f"{folder}/in", contract, mode="append")
    first = run()
    assert same_rows(first, accepted(rows.where(urgent), ORDERS))
    before = len(log(spark, intake))
    assert before == 2  # three files, two at a time
    assert run().count() == first.count() and len(log(spark, intake)) == before
    write_landing(rows.where(~urgent), f"{folder}/in", contract, mode="append")
    assert same_rows(run(), accepted(rows, ORDERS))


def test_a_repeated_micro_batch_changes_nothing(spark, folder):
    intake = intake_at(folder)
    batch = read_landing(spark, landing_file(spark, SF_DIR), ORDERS)
    for _ in range(2):
        ingest_batch(spark, batch, ORDERS, intake, "orders-0000000001", require_rows=False)
    assert intake.targets["orders"].rows(spark).count() == 1377
    report = load_report(intake.audit.read(spark)).collect()
    counts = {r.outcome: (r.n_runs, r.n_rows) for r in report}
    assert counts["loaded"] == (1, 1377)  # only the last attempt is counted
    assert counts["not_int:id"] == (1, 32)


def test_report_counts_failures(spark, folder):
    audit = AuditLog(f"{folder}/audit")
    assert load_report(audit.read(spark)).isEmpty()
    with pytest.raises(RuntimeError), audit.run(spark, "ingest", "t", "b1"):
        raise RuntimeError("no")
    with audit.run(spark, "ingest", "t", "b2") as row:
        row |= {"scanned": 3, "accepted": 2, "rejected": 1, "violations": {"null:a": 1}}
    got = {r.outcome: (r.n_runs, r.n_rows) for r in load_report(audit.read(spark)).collect()}
    assert got == {
        "failed": (1, 0),
        "scanned": (1, 3),
        "accepted": (1, 2),
        "rejected": (1, 1),
        "loaded": (1, 0),
        "skipped": (1, 0),
        "null:a": (1, 1),
    }


def test_runs_write_under_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert run_dir(spark, "x").startswith(shared_dir(spark))
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_a_corrected_file_comes_under_the_refused_ones_id(spark, folder, tmp_path):
    contract = landing_contract("orders", typed=True)
    intake = intake_at(folder, contract)
    path = tmp_path / "orders.csv"
    path.write_text("none;x;2024-01-01T00:00:00Z;1;2\n")
    with pytest.raises(ValueError, match="no row left"):
        ingest_file(spark, str(path), intake, "day1")
    path.write_text("7;x;2024-01-01T00:00:00Z;1;2\n8;y;2024-01-01T00:00:00Z;1;2\n")
    assert ingest_file(spark, str(path), intake, "day1").load.loaded == 2
    path.write_text("9;x;2024-01-01T00:00:00Z;1;2\n")
    with pytest.raises(ValueError, match="belongs to another source"):
        ingest_file(spark, str(path), intake, "day1")


def test_files_are_judged_by_name_wherever_they_are_now(spark, tmp_path):
    contracts = {c.name: c for c in (landing_contract("orders"), landing_contract("part", file_glob="p-[0-9]*.{csv,txt}"))}
    names = ["orders.csv", "orders.v1.CSV", "orders.txt", "ordersx.csv", "p-1.csv", "p-12.txt", "p-x.csv", "other.csv"]
    files = spark.createDataFrame([(f"file:/gone/away/{n}",) for n in names], "path string")
    left = {r.path.rsplit("/", 1)[-1] for r in refused(files, contracts).collect()}
    for n in names:
        (tmp_path / n).write_text("x")
    seen = {
        r.path.rsplit("/", 1)[-1]
        for c in contracts.values()
        for r in list_landing(spark, str(tmp_path), c.glob).collect()
    }
    assert left == set(names) - seen == {"orders.txt", "ordersx.csv", "p-x.csv", "other.csv"}


# -- new files only -----------------------------------------------------------


def put(path, *rows, at=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(f"{r}\n" for r in rows))
    if at:
        os.utime(path, (at, at))


def row(i, name="n"):
    return f"{i};{name};2021-01-01T00:00:00Z;1;1"


def daily(folder):
    keyless = [landing_contract(n).but(key=()) for n in ("orders", "people")]
    return intake_at(folder, *keyless), FileLedger(f"{folder}/ledger")


def ids(spark, intake, table="orders"):
    return sorted(r["id"] for r in intake.targets[table].rows(spark).select(F.col("id").cast("int")).collect())


def test_daily_folder_takes_each_file_once(spark, folder, tmp_path):
    intake, ledger = daily(folder)
    landing = tmp_path / "landing"
    put(landing / "orders.1.csv", row(1), row(2))
    put(landing / "a b" / "orders.{x}[1]*.csv", row(3))
    put(landing / "people.csv", row(1))
    put(landing / "notes.txt", "hello")
    run = lambda day: ingest_new(spark, str(landing), intake, ledger, day)
    assert {n: r.load.loaded for n, r in run("d1").items()} == {"orders": 3, "people": 1}
    assert run("d1") == {} and run("d2") == {}
    put(landing / "orders.2.csv", row(4))
    assert {n: r.load.loaded for n, r in run("d3").items()} == {"orders": 1}
    assert ids(spark, intake) == [1, 2, 3, 4] and ids(spark, intake, "people") == [1]
    # Uploaded again: with other rows, and once with the same ones at another time.
    put(landing / "orders.1.csv", row(5), row(6), row(7))
    put(landing / "orders.2.csv", row(4), at=1_700_000_000)
    assert run("d4")["orders"].load.loaded == 4
    assert ids(spark, intake) == [1, 2, 3, 4, 4, 5, 6, 7]
    ledger.table.compact(spark)
    assert run("d5") == {} and ledger.taken(spark).count() == 7
    # The file of no table is logged once.
    assert [r.batch_id for r in log(spark, intake) if r.step == "gate"] == ["d1"]


def test_a_batch_that_died_goes_on_with_its_files(spark, folder, tmp_path, monkeypatch):
    intake, ledger = daily(folder)
    landing = tmp_path / "landing"
    put(landing / "orders.csv", row(1))
    put(landing / "people.csv", row(1))
    run = lambda day: ingest_new(spark, str(landing), intake, ledger, day)
    append = ParquetTable.append

    def killed(self, df, batch_id):
        if self.path.endswith("/people"):
            raise OSError("killed")
        return append(self, df, batch_id)

    with monkeypatch.context() as m:
        m.setattr(ParquetTable, "append", killed)
        with pytest.raises(OSError, match="killed"):
            run("d1")
    put(landing / "orders.2.csv", row(2))
    with pytest.raises(RuntimeError, match="'d1' has not ended"):
        run("d2")
    run("d1")
    assert (ids(spark, intake), ids(spark, intake, "people")) == ([1], [1])
    run("d2")
    assert (ids(spark, intake), ids(spark, intake, "people")) == ([1, 2], [1])


def test_a_batch_killed_while_taking_files_takes_them_again(spark, folder, tmp_path, monkeypatch):
    intake, ledger = daily(folder)
    put(tmp_path / "l" / "orders.csv", row(1))
    with monkeypatch.context() as m:
        m.setattr(ParquetTable, "append", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            ingest_new(spark, str(tmp_path / "l"), intake, ledger, "d1")
    put(tmp_path / "l" / "orders.2.csv", row(2))
    assert ingest_new(spark, str(tmp_path / "l"), intake, ledger, "d1")["orders"].load.loaded == 2


def test_released_files_are_fresh_again(spark, folder, tmp_path):
    intake, ledger = daily(folder)
    put(tmp_path / "l" / "orders.csv", row(1))
    put(tmp_path / "l" / "people.csv", row(1))
    listed = list_landing(spark, str(tmp_path / "l")).withColumn("table_name", F.lit("orders"))
    assert ledger.take(spark, listed, "d0").count() == 2
    (tmp_path / "l" / "people.csv").unlink()
    ledger.release(spark, "d0")
    assert ledger.taken(spark).isEmpty()
    assert list(ingest_new(spark, str(tmp_path / "l"), intake, ledger, "d1")) == ["orders"]
    ledger.release(spark, "d1")
    assert ledger.taken(spark).count() == 1
    with pytest.raises(ValueError, match="batch id"):
        ledger.take(spark, listed, "../d2")


def test_an_empty_folder_ends_its_batch(spark, folder, tmp_path):
    intake, ledger = daily(folder)
    (tmp_path / "l").mkdir()
    assert ingest_new(spark, str(tmp_path / "l"), intake, ledger, "d1") == {}
    assert ledger.ended(spark, "d1")


# -- replay of the quarantine -------------------------------------------------


def changing(folder):
    """A contract that wants ids in a list, its places, and the same with the list grown."""
    base = landing_contract("orders").but(key=())
    short, grown = (base.but(rules=(*base.rules, InSet("name", names))) for names in (("a",), ("a", "b")))
    intake = intake_at(folder, short)
    return intake, replace(intake, contracts={"orders": grown})


def quarantined(spark, intake):
    rows = read_quarantine(spark, intake.staged_root, intake.contracts["orders"])
    return sorted((r["id"], r["name"]) for r in rows.select("id", "name").collect())


def test_rows_that_fit_now_arrive_once_and_the_rest_stay(spark, folder, tmp_path):
    intake, grown = changing(folder)
    put(tmp_path / "1" / "orders.csv", row(1, "a"), row(2, "b"), row(3, "c"), row("x", "b"))
    put(tmp_path / "2" / "orders.csv", row(2, "b"), "4;b", row(5, "a"))
    for day in ("1", "2"):
        ingest_file(spark, str(tmp_path / day / "orders.csv"), intake, f"d{day}")
    before = quarantined(spark, intake)
    assert ids(spark, intake) == [1, 5] and len(before) == 5
    # Under the old contract nothing fits: all rows stay, once each.
    assert replay(spark, "orders", intake, "r0").staged.accepted == 0
    assert quarantined(spark, intake) == before
    done = replay(spark, "orders", grown, "r1")
    assert (done.staged.scanned, done.staged.accepted, done.load.loaded) == (5, 2, 2)
    assert ids(spark, intake) == [1, 2, 2, 5]
    assert quarantined(spark, grown) == [("3", "c"), ("4", "b"), ("x", "b")]
    # Again under the same id, and under another one: no row arrives twice.
    replay(spark, "orders", grown, "r1")
    assert replay(spark, "orders", grown, "r2").load.loaded == 0
    assert ids(spark, intake) == [1, 2, 2, 5] and len(quarantined(spark, grown)) == 3
    with pytest.raises(ValueError, match="were replayed by 'r0'"):
        ingest_file(spark, str(tmp_path / "1" / "orders.csv"), grown, "d1")
    steps = [(r.step, r.batch_id, r.status, r.loaded) for r in log(spark, intake)]
    assert ("replay", "r0", "ok", 0) in steps and ("replay", "r1", "ok", 2) in steps
    assert steps[-1] == ("ingest", "d1", "failed", None)


def test_a_replay_that_died_goes_on(spark, folder, tmp_path, monkeypatch):
    intake, grown = changing(folder)
    assert replay(spark, "orders", grown, "r0") is None
    put(tmp_path / "orders.csv", row(1, "a"), row(2, "b"), row(3, "c"))
    ingest_file(spark, str(tmp_path / "orders.csv"), intake, "d1")
    with monkeypatch.context() as m:
        m.setattr(ParquetTable, "append", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            replay(spark, "orders", grown, "r1")
    assert ids(spark, intake) == [1] and quarantined(spark, grown) == [("2", "b"), ("3", "c")]
    # What it has claimed is no other one's.
    assert replay(spark, "orders", grown, "r2") is None
    assert replay(spark, "orders", grown, "r1").load.loaded == 1
    assert ids(spark, intake) == [1, 2] and quarantined(spark, grown) == [("3", "c")]
    # A batch that came later is the next replay's, also if the first one is run again.
    put(tmp_path / "orders.csv", row(4, "b"), row(5, "c"), row(6, "a"))
    ingest_file(spark, str(tmp_path / "orders.csv"), intake, "d2")
    assert replay(spark, "orders", grown, "r1").load.loaded == 1
    assert quarantined(spark, grown) == [("3", "c"), ("4", "b"), ("5", "c")]
    assert replay(spark, "orders", grown, "r2").load.loaded == 1
    assert ids(spark, intake) == [1, 2, 4, 6] and quarantined(spark, grown) == [("3", "c"), ("5", "c")]
