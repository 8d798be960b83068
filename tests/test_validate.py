"""Rules, reasons, counts, staging: one scan, nothing lost."""

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from intake.contracts import Field, TableContract, contract_for, landing_contract
from intake.operators.rules import InSet, IntCastable, NotNull, References
from intake.operators.validate import (
    accepted,
    annotate,
    assert_clean,
    assert_not_empty,
    by_reason,
    rejected,
    typed,
    violation_counts,
)
from intake.plans.ingest import validate
from intake.sources.landing import read_landing
from intake.sources.staged import read_quarantine, read_staged
from registry.fixtures import ORDERS, landing, landing_file
from tests.conftest import SF_DIR

# Given by the fixture's description for the smallest scale.
SCANNED, ACCEPTED, STRICT = 1500, 1377, 1359
BROKEN = {
    "not_int:id": 32,
    "null:name": 29,
    "null:datetime": 25,
    "not_int:department_id": 22,
    "not_int:job_id": 19,
    "malformed": 0,
}


@pytest.fixture(scope="module")
def scan(spark):
    return read_landing(spark, landing_file(spark, SF_DIR), ORDERS)


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_counts_of_the_fixture(spark, scan):
    assert scan.count() == SCANNED
    assert accepted(scan, ORDERS).count() == ACCEPTED
    assert accepted(scan, landing_contract("orders", mode="strict")).count() == STRICT
    found = {r.reason: (r.n_rows, r.n_violations) for r in violation_counts(scan, ORDERS).collect()}
    assert found == {k: (SCANNED, n) for k, n in BROKEN.items()}


def test_same_rows_as_a_chain_of_classic_filters(spark):
    classic = spark.newSession()
    classic.conf.set("spark.sql.ansi.enabled", "false")
    rows = read_landing(classic, landing_file(spark, SF_DIR), ORDERS)
    kept = rows
    for c in ("department_id", "id", "job_id"):
        kept = kept.where(F.col(c).cast("int").isNotNull())
    kept = kept.dropna(subset=["name", "datetime"])
    assert same_rows(accepted(rows, ORDERS), kept.select(*ORDERS.columns))


def test_split_is_complete_and_every_rejection_has_a_reason(scan):
    bad = rejected(scan, ORDERS)
    assert bad.count() + accepted(scan, ORDERS).count() == SCANNED
    assert bad.where(F.size("reasons") == 0).isEmpty()
    every = bad.select(*ORDERS.columns).unionByName(accepted(scan, ORDERS))
    assert same_rows(every, scan.select(*ORDERS.columns))
    counted = {r.reason: r["count"] for r in by_reason(bad).groupBy("reason").count().collect()}
    assert counted == {reason: n for reason, n in BROKEN.items() if n}


def test_stage_counts_and_parts(spark, scan, folder):
    counts = validate(scan, ORDERS, folder, "b1")
    assert (counts.scanned, counts.accepted, counts.rejected) == (SCANNED, ACCEPTED, 123)
    assert counts.violations == BROKEN
    assert same_rows(read_staged(spark, folder, ORDERS, "b1"), accepted(scan, ORDERS))
    got = read_quarantine(spark, folder, ORDERS, "b1")
    assert same_rows(by_reason(got), by_reason(rejected(scan, ORDERS)))


def test_staging_again_replaces_the_batch_and_leaves_others(spark, scan, folder):
    validate(scan, ORDERS, folder, "b1")
    validate(scan, ORDERS, folder, "b2")
    validate(scan.limit(0), ORDERS, folder, "b1")
    assert read_staged(spark, folder, ORDERS).count() == ACCEPTED
    assert read_staged(spark, folder, ORDERS, "b2").count() == ACCEPTED


def test_drop_keeps_no_bad_rows_but_counts_them(spark, scan, folder):
    counts = validate(scan, ORDERS.but(on_violation="drop"), folder, "b1")
    assert counts.rejected == 123 and counts.violations == BROKEN
    assert read_quarantine(spark, folder, ORDERS).isEmpty()
    assert read_staged(spark, folder, ORDERS).count() == ACCEPTED


def test_fail_stages_nothing(spark, scan, folder):
    with pytest.raises(ValueError, match="not_int:id=32"):
        validate(scan, ORDERS.but(on_violation="fail"), folder, "b1")
    clean = accepted(scan, ORDERS)
    assert_clean(clean, ORDERS)
    assert validate(clean, ORDERS.but(on_violation="fail"), folder, "b1").rejected == 0


def test_not_empty():
    assert_not_empty(1, ORDERS)
    with pytest.raises(ValueError, match="no row left"):
        assert_not_empty(0, ORDERS)


def test_in_set_and_references(spark):
    pairs = [("1", "a"), ("2", "b"), ("x", None), (None, "c")]
    rows = spark.createDataFrame(pairs, "k string, v string")
    dim = spark.createDataFrame([(1,), (1,), (3,), (None,)], "id int")
    contract = TableContract(
        "t",
        (Field("k"), Field("v")),
        rules=(InSet("v", ("a", "b")), References("k", dimension=dim, key="id")),
    )
    got = {(r.k, r.v): r.reasons for r in annotate(rows, contract).collect()}
    assert got == {
        ("1", "a"): [],
        ("2", "b"): ["no_reference:k"],
        ("x", None): ["no_reference:k"],
        (None, "c"): ["not_in_set:v"],
    }
    assert accepted(rows, contract).collect() == [("1", "a")]
    assert annotate(rows, contract).count() == 4


def test_two_rules_of_one_kind_on_one_column(spark):
    rows = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "9")], "s string, k string")
    dims = [spark.createDataFrame([(i,) for i in ids], "id bigint") for ids in ((1, 2), (2, 3, 3000000000))]
    contract = TableContract(
        "t",
        (Field("s"), Field("k")),
        rules=(
            InSet("s", ("a", "b", "d")),
            InSet("s", ("b", "c", "d")),
            *[References("k", dimension=d, key="id") for d in dims],
        ),
    )
    got = {r.s: r.reasons for r in annotate(rows, contract).collect()}
    assert got == {
        "a": ["not_in_set:s#2", "no_reference:k#2"],
        "b": [],
        "c": ["not_in_set:s", "no_reference:k"],
        "d": ["no_reference:k", "no_reference:k#2"],
    }
    assert [r.s for r in accepted(rows, contract).collect()] == ["b"]
    counts = {r.reason: r.n_violations for r in violation_counts(rows, contract).collect()}
    assert counts == {"not_in_set:s": 1, "not_in_set:s#2": 1, "no_reference:k": 2, "no_reference:k#2": 2}


@pytest.mark.parametrize(
    ("data_type", "good", "bad"),
    [
        ("bigint", ["12.7", "3000000000", " 5 "], ["x", "99999999999999999999", "1e3"]),
        ("smallint", ["32767", "-1.5"], ["32768", "3000000000"]),
        ("date", ["2024-01-31"], ["yesterday", "2024-02-30"]),
        ("timestamp_ntz", ["2024-01-01 10:00:00", "2024-01-01T10:00:00Z", "2024-01-01"], ["2024-01-01T10:00:00+05:00", "soon"]),
        ("double", ["1e3", "-0.5"], ["1,5", ""]),
        ("decimal(5,2)", ["123.45"], ["12345.6", "a"]),
    ],
)
def test_an_accepted_value_is_never_loaded_as_null(spark, data_type, good, bad):
    contract = TableContract("t", (Field("id", "int"), Field("v", data_type)), rules=(NotNull("id"),))
    rows = [(str(i), v) for i, v in enumerate([*good, *bad, None])]
    df = spark.createDataFrame(rows, contract.landing_schema)
    kept = accepted(df, contract)
    assert {r.v for r in kept.collect()} == {*good, None}
    lost = typed(kept, contract).where("v IS NULL").collect()
    assert [r.id for r in lost] == [len(rows) - 1]
    reasons = {r.v: r.reasons for r in rejected(df, contract).collect()}
    assert reasons == {v: [f"not_{data_type}:v"] for v in bad}


def test_the_int_rule_follows_the_declared_type(spark):
    contract = TableContract("t", (Field("id", "bigint"),), rules=(IntCastable("id"),), key=("id",))
    df = spark.createDataFrame([("3000000000",), ("7.5",), (None,), ("x",)], contract.landing_schema)
    assert {r.id for r in typed(accepted(df, contract), contract).collect()} == {3000000000, 7}
    assert [r for r, _ in contract.checks] == ["not_int:id"]


def test_typed(spark):
    contract = landing_contract("orders", typed=True)
    row = [(" 7 ", "n", "2021-07-27T16:02:08Z", "5.9", "1")]
    got = typed(spark.createDataFrame(row, contract.landing_schema), contract)
    assert got.schema == contract.table_schema
    assert got.select("id", "department_id", F.col("datetime").cast("string")).collect() == [
        (7, 5, "2021-07-27 16:02:08")
    ]


def test_contract_mistakes_are_refused():
    fields = (Field("a"), Field("b"))
    with pytest.raises(ValueError, match="plain identifier"):
        TableContract("a;drop", fields)
    with pytest.raises(ValueError, match="twice"):
        TableContract("t", (Field("a"), Field("a")))
    with pytest.raises(ValueError, match="undeclared"):
        TableContract("t", fields, rules=(NotNull("c"),))
    with pytest.raises(ValueError, match="need a NotNull"):
        TableContract("t", fields, key=("a",))
    with pytest.raises(ValueError, match="on_violation"):
        TableContract("t", fields, on_violation="ignore")
    with pytest.raises(ValueError, match="on_duplicate"):
        TableContract("t", fields, on_duplicate="ignore")
    with pytest.raises(ValueError, match="no contract for table 'x'"):
        contract_for({}, "x")
    assert TableContract("t", fields, rules=(IntCastable("a"),), key=("a",)).key == ("a",)


def test_one_scan_in_generated_code(spark, scan, plan):
    text = plan(annotate(scan, ORDERS))
    tree = text.split("\n\n")[0]
    assert tree.count("Scan csv") == 1
    assert "PythonUDF" not in text and "BatchEval" not in text
    assert "* Project" in tree  # the star marks whole-stage code generation


def test_hot_value_of_a_large_reference_is_split(spark, plan):
    """A third of the rows refer to one key, a third to none; no side is broadcast."""
    session = spark.newSession()
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }.items():
        session.conf.set(name, value)
    n = 60_000
    k = F.when(F.col("id") % 3 == 0, "7").when(F.col("id") % 3 == 1, F.col("id").cast("string"))
    rows = session.range(0, n, 1, 8).select(k.alias("k"), F.col("id").cast("string").alias("v"))
    dim = session.range(0, n, 1, 8).where("id % 2 = 1")
    contract = TableContract(
        "t",
        (Field("k"), Field("v")),
        rules=(References("k", dimension=dim, key="id", data_type="bigint"),),
    )
    found = annotate(rows, contract).select("verdict", "v")
    got = {r.verdict: r["count"] for r in found.groupBy("verdict").count().collect()}
    bad = sum(1 for i in range(n) if i % 3 == 1 and i % 2 == 0)
    assert got == {"accepted": n - bad, "rejected": bad}
    found.collect()
    assert "skew=true" in plan(found).replace(" ", "").lower()


def test_fixture_without_csv_gives_the_same_rows(spark, scan):
    assert same_rows(landing(spark, SF_DIR), scan.select(*ORDERS.columns))


def lose_first_attempts(df):
    """Every task of ``df`` fails at its end, once, after giving out all rows."""

    def run(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("executor lost")

    return df.mapInPandas(run, df.schema)


def test_rows_and_counts_survive_lost_tasks(spark, scan, folder):
    counts = validate(lose_first_attempts(scan.repartition(4)), ORDERS, folder, "b1")
    assert (counts.scanned, counts.accepted, counts.rejected) == (SCANNED, ACCEPTED, 123)
    assert counts.violations == BROKEN
    assert same_rows(read_staged(spark, folder, ORDERS), accepted(scan, ORDERS))


def test_counts_survive_lost_tasks_behind_a_join(spark, scan, folder):
    dim = spark.range(0, 6).withColumnRenamed("id", "key")
    rule = References("department_id", dimension=dim, key="key", data_type="int")
    contract = ORDERS.but(rules=(*ORDERS.rules, rule))
    want = {r.reason: r.n_violations for r in violation_counts(scan, contract).collect()}
    counts = validate(lose_first_attempts(scan.repartition(4)), contract, folder, "b1")
    assert counts.violations == want and counts.scanned == SCANNED


@pytest.mark.parametrize("name", ["verdict", "reasons", "Raw_Line", "batch_id", "_rank", "_broken_0", "n_in_batch", "in_target"])
def test_reserved_names_are_refused(name):
    with pytest.raises(ValueError, match="reserved"):
        TableContract("t", (Field("id"), Field(name)))


def test_names_that_differ_by_case_only_are_refused():
    with pytest.raises(ValueError, match="declared twice"):
        TableContract("t", (Field("id"), Field("ID")))
