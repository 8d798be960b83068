"""Reading landing files: corner cases of the format, gates and listings."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from intake.contracts import Field, TableContract, landing_contract
from intake.operators.rules import Decoded, WellFormed
from intake.operators.validate import accepted, annotate, rejected
from intake.sources.landing import (
    check_key,
    check_width,
    gate,
    list_landing,
    read_landing,
    write_landing,
)

ORDERS = landing_contract("orders", well_formed=False)


def put(folder, content, name="orders.csv"):
    path = Path(folder, name)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_empty_fields_are_null(spark, folder):
    path = put(folder, '2;;2021;1;2\n3;"";x;1;2\n')
    assert rows(read_landing(spark, path, ORDERS)) == [
        ("2", None, "2021", "1", "2"),
        ("3", None, "x", "1", "2"),
    ]


def test_short_and_long_lines(spark, folder):
    path = put(folder, "5;short;x\n6;long;x;1;2;EXTRA\n")
    assert rows(read_landing(spark, path, ORDERS)) == [
        ("5", "short", "x", None, None),
        ("6", "long", "x", "1", "2"),
    ]
    assert [r.id for r in accepted(read_landing(spark, path, ORDERS), ORDERS).collect()] == ["6"]


def test_the_classic_contract_refuses_lines_of_another_width(spark, folder):
    contract = landing_contract("orders")
    landing = read_landing(spark, put(folder, "5;short;x\n6;long;x;1;2;EXTRA\n7;a;x;1;2\n"), contract)
    assert [r.id for r in accepted(landing, contract).collect()] == ["7"]
    bad = {r.id: (r.raw_line, r.reasons) for r in rejected(landing, contract).collect()}
    assert bad["6"] == ("6;long;x;1;2;EXTRA", ["malformed"])
    assert bad["5"] == ("5;short;x", ["not_int:department_id", "not_int:job_id", "malformed"])


def test_malformed_lines_are_seen_by_a_narrow_query(spark, folder):
    contract = landing_contract("orders", rules=(WellFormed(),), key=())
    path = put(folder, "1;a;x;1;2\n5;short;x\n6;long;x;1;2;EXTRA\n")
    landing = read_landing(spark, path, contract)
    assert [r.id for r in rejected(landing, contract).select("id").collect()] == ["5", "6"]
    raw = landing.where(F.col("_corrupt_record").isNotNull()).select("id", "_corrupt_record")
    assert rows(raw) == [("5", "5;short;x"), ("6", "6;long;x;1;2;EXTRA")]
    good = annotate(landing, contract).where("verdict = 'accepted'")
    assert [r.id for r in good.select("id").collect()] == ["1"]


def test_quotes_newlines_blank_lines(spark, folder):
    path = put(folder, '7;"q;q";x;1;2\n\n8;"two\nlines";x;1;2\n')
    got = rows(read_landing(spark, path, ORDERS))
    assert got[0] == ("7", "q;q", "x", "1", "2")
    assert len(got) == 3  # the blank line is skipped, the quoted newline splits its row


def test_header_line_is_data_and_then_rejected(spark, folder):
    path = put(folder, "id;name;datetime;department_id;job_id\n1;a;x;1;2\n")
    landing = read_landing(spark, path, ORDERS)
    assert landing.count() == 2
    assert [r.id for r in accepted(landing, ORDERS).collect()] == ["1"]


def test_byte_order_mark_and_windows_line_ends(spark, folder):
    path = put(folder, b"\xef\xbb\xbf1;a;x;1;2\r\n2;b;y;1;2\r\n")
    assert rows(read_landing(spark, path, ORDERS)) == [
        ("1", "a", "x", "1", "2"),
        ("2", "b", "y", "1", "2"),
    ]


def test_bytes_that_are_not_utf8(spark, folder):
    path = put(folder, b"1;\xff;x;1;2\n")
    assert rows(read_landing(spark, path, ORDERS)) == [("1", "�", "x", "1", "2")]


def test_written_blanks_survive(spark, folder):
    df = spark.createDataFrame([("1", " a ", "x", "1", " 7 ")], ORDERS.landing_schema)
    write_landing(df, folder, ORDERS)
    assert rows(read_landing(spark, folder, ORDERS)) == [("1", " a ", "x", "1", " 7 ")]


@pytest.mark.parametrize("content", ["", "\n\n", "1;a;x;1\n", "1;a;x;1;2;3\n"])
def test_wrong_width_is_refused(spark, folder, content):
    with pytest.raises(ValueError, match="columns"):
        check_width(spark, put(folder, content), ORDERS)


def test_right_width_passes(spark, folder):
    check_width(spark, put(folder, "1;a;x;1;2\n2;b\n"), ORDERS)


# Key, table, verdict, classic verdict.
KEYS = [
    ("ingestion/orders.csv", "orders", "pass", "pass"),
    ("ingestion/x/orders.csv", "orders", "pass", "pass"),
    ("ingestion/orders.v2.csv", "orders", "pass", "pass"),
    ("ingestion/orders.CSV", "orders", "pass", "wrong type"),
    ("ingestion/orders.xcsv", "orders", "wrong type", "pass"),
    ("ingestion/orders.txt", "orders", "wrong type", "wrong type"),
    ("ingestion/unknown.csv", "unknown", "unknown table", "unknown table"),
    ("ingestion/.csv", "", "unknown table", "unknown table"),
]


def test_gate(spark):
    keys = spark.createDataFrame([(k[0],) for k in KEYS], "key string")
    for parity in (False, True):
        found = gate(keys, ["orders"], "key", parity)
        got = [(r.key, r.table_name, r.verdict, r.passed) for r in found.collect()]
        want = [(k, t, v, v == "pass") for k, t, *vs in KEYS for v in [vs[parity]]]
        assert got == want


def test_check_key(spark):
    assert check_key(spark, "ingestion/orders.csv", ["orders"]) == "orders"
    with pytest.raises(ValueError, match="not a csv"):
        check_key(spark, "ingestion/orders.txt", ["orders"])
    with pytest.raises(ValueError, match="no contract"):
        check_key(spark, "ingestion/people.csv", ["orders"])


def test_listing_and_glob(spark, folder):
    line = "1;a;x;1;2\n"
    for name in ("orders.csv", "a/orders.v2.CSV", "orders_old.csv", "orders.txt", "people.csv"):
        put(folder, line, name)
    verdicts = {
        r.path.rsplit("/", 1)[-1]: r.verdict
        for r in gate(list_landing(spark, folder), ["orders"]).collect()
    }
    assert verdicts == {
        "orders.csv": "pass",
        "orders.v2.CSV": "pass",
        "orders_old.csv": "unknown table",
        "orders.txt": "wrong type",
        "people.csv": "unknown table",
    }
    # The glob of a contract takes exactly the files the gate passes.
    assert read_landing(spark, folder, ORDERS, ORDERS.glob).count() == 2


QUOTED = TableContract("q", (Field("id"), Field("v"), Field("w")), multi_line=True, line_sep="\n", escape='"')
ODD = [
    ("1", "two\nlines", "é ü ß"), ("2", "one\r\ntwo\r\n\r\n", "x"), ("3", 'say "no"; or', '"'), ("4", '""', "a;b"),
    ("5", "back\\", '\\"'), ("6", None, " blanks "), ("7", "\n", "\n\n"), ("8", "lone\rreturn", "end"),
]


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1", "UTF-16", "UTF-16LE", "UTF-32"])
def test_values_over_several_lines_come_back(spark, folder, encoding):
    contract = QUOTED.but(encoding=encoding)
    df = spark.createDataFrame(ODD, contract.landing_schema).coalesce(1)
    write_landing(df, f"{folder}/q.csv", contract)
    assert sorted(rows(read_landing(spark, f"{folder}/q.csv", contract))) == ODD
    check_width(spark, f"{folder}/q.csv", contract)


def test_line_ends_of_the_file_are_found(spark, folder):
    contract = QUOTED.but(line_sep=None)
    for name, end in (("unix", "\n"), ("windows", "\r\n")):
        path = put(folder, end.join(["1;a;b", '2;"x\ny";c', "3;d;e", ""]), f"{name}.csv")
        assert rows(read_landing(spark, path, contract)) == [("1", "a", "b"), ("2", "x\ny", "c"), ("3", "d", "e")]


def test_records_of_another_width_over_several_lines(spark, folder):
    contract = QUOTED.but(rules=(WellFormed(),))
    path = put(folder, '1;a;b\n2;"x\ny"\n3;"d\ne";f;g\n4;"h;\ni";j\n')
    df = read_landing(spark, path, contract)
    assert [r.id for r in accepted(df, contract).collect()] == ["1", "4"]
    assert [r.id for r in rejected(df, contract).collect()] == ["2", "3"]
    with pytest.raises(ValueError):
        check_width(spark, put(folder, '"a\nb";c\n', "short.csv"), contract)


def test_bytes_of_another_encoding_are_refused(spark, folder):
    contract = QUOTED.but(rules=(Decoded("v"),), multi_line=False, line_sep=None)
    path = put(folder, "1;caf\u00e9;x\n2;cafe;x\n3;;x\n".encode("latin-1"))
    for c in (contract, contract.but(multi_line=True), contract.but(encoding="US-ASCII")):
        bad = rejected(read_landing(spark, path, c), c).collect()
        assert [(r.id, r.reasons) for r in bad] == [("1", ["undecoded:v"])]
    latin = contract.but(encoding="ISO-8859-1")
    assert [r.v for r in accepted(read_landing(spark, path, latin), latin).collect()] == ["caf\u00e9", "cafe", None]


@pytest.mark.parametrize(
    "form", [{"encoding": "EBCDIC"}, {"encoding": "UTF-16", "multi_line": False}, {"line_sep": "\r\n"}, {"escape": ""}]
)
def test_forms_that_cannot_be_read_are_refused(form):
    with pytest.raises(ValueError):
        QUOTED.but(**form)
