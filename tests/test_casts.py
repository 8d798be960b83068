"""The casts, value by value and against the classic cast itself."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from intake.functions.casts import int_cast, int_lenient, int_strict, typed_value

# Value, lenient, strict.
CASES = [
    ("12", 12, 12),
    ("+12", 12, 12),
    (" 12 ", 12, 12),
    ("12\t", 12, 12),
    ("00012", 12, 12),
    ("-0", 0, 0),
    ("-2147483648", -2147483648, -2147483648),
    ("2147483647", 2147483647, 2147483647),
    ("\x0112\x01", 12, 12),
    ("12.7", 12, None),
    ("-12.7", -12, None),
    ("\x0112.7\x7f", 12, None),
    ("-2147483648.5", -2147483648, None),
    ("2147483647.9", 2147483647, None),
    (".5", 0, None),
    ("+.5", 0, None),
    ("-.5", 0, None),
    (".", 0, None),
    ("5.", 5, None),
    *[
        (v, None, None)
        for v in (
            "2147483648 -2147483649 2147483648.5 1e3 0x10 1_000 1,000 + - 1.2.3 1.a abc NaN "
            "true 12L 12d 1e3.5"
        ).split()
    ],
    ("- 5", None, None),
    ("1 2", None, None),
    ("", None, None),
    ("   ", None, None),
    (" 12", None, None),
    ("12\u2028", None, None),
    ("12\x85", None, None),
    (None, None, None),
]


def run(spark, values, *columns):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_table_of_values(spark):
    got = run(spark, [c[0] for c in CASES], int_lenient("v"), int_strict("v"))
    assert got == [c[1:] for c in CASES]


def test_classic_cast_agrees_on_the_table(spark):
    classic = spark.newSession()
    classic.conf.set("spark.sql.ansi.enabled", "false")
    values = [c[0] for c in CASES]
    assert run(classic, values, F.col("v").cast("int")) == [(c[1],) for c in CASES]


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("0123456789+-. eExX_,\t\n\x01\x1f\x7f", max_size=14), min_size=200))
def test_lenient_equals_the_classic_cast(spark, values):
    classic = spark.newSession()
    classic.conf.set("spark.sql.ansi.enabled", "false")
    got = run(classic, values, F.col("v").cast("int").alias("want"), int_lenient("v").alias("got"))
    assert [(v, g) for v, (w, g) in zip(values, got, strict=True) if w != g] == []


def test_answer_does_not_depend_on_the_session(spark):
    values = [c[0] for c in CASES]
    other = spark.newSession()
    other.conf.set("spark.sql.ansi.enabled", "false")
    assert run(spark, values, int_lenient("v")) == run(other, values, int_lenient("v"))


def test_typed_value(spark):
    got = run(
        spark,
        ["2021-07-27T16:02:08Z", "no date", None],
        typed_value("v", "timestamp_ntz").cast("string"),
    )
    assert got == [("2021-07-27 16:02:08",), (None,), (None,)]


def test_unknown_mode():
    with pytest.raises(ValueError, match="unknown cast mode"):
        int_cast("v", "loose")


EXACT = {
    "date": (["2024-01-01", " 2024-02-29 "], ["2024-01-01 yesterday", "2024-01-01Tjunk", "2024", "2024-1-1", "2024-02-30", "20240101"]),
    "decimal(5,2)": (["1.23", "-1.2", "1", "1.2300", ".5"], ["1.239", "1e1", "1234.5", "1.2.3", "", "."]),
    "decimal(4)": (["12", "12.0"], ["12.5", "12345"]),
    "double": (["1.5", "-1e3", ".5", "5."], ["1.5d", "1e400", "-1e400", "NaN", "Infinity", "1.5f", "0x1p3", "1,5"]),
    "float": (["1.5"], ["1e39", "1.5d"]),
    "timestamp": (
        ["2024-01-01T10:00:00Z", "2024-01-01 10:00:00.123456+05:00", "2024-01-01 10:00:00 UTC"],
        ["10:00", "2024-01-01 10:00:00", "2024-01-01", "2024-01-01T10:00:00.1234567Z", "2024-01-01T10:00Z"],
    ),
    "timestamp_ntz": (
        ["2024-01-01T10:00:00Z", "2024-01-01 10:00:00", "2024-01-01T10:00:00.5+00:00"],
        ["10:00", "2024-01-01T10:00:00+05:00", "2024", "2024-01-01T10:00:00 junk"],
    ),
}


@pytest.mark.parametrize("data_type", EXACT)
def test_accepted_values_do_not_change(spark, data_type):
    good, bad = EXACT[data_type]
    got = run(spark, good + bad, typed_value("v", data_type).isNotNull().alias("ok"))
    assert [ok for ok, in got] == [True] * len(good) + [False] * len(bad)


def test_a_timestamp_does_not_depend_on_the_sessions_zone(spark):
    session = spark.newSession()
    seen = set()
    for zone in ("UTC", "Asia/Tokyo"):
        session.conf.set("spark.sql.session.timeZone", zone)
        value = typed_value("v", "timestamp").cast("double")
        seen.add(session.createDataFrame([("2024-01-01T10:00:00+02:00",)], "v string").select(value).first()[0])
    assert len(seen) == 1
