import hashlib
import re

from pyspark.sql import functions as F

from intake.llm import secrets
from intake.llm.secrets import linked, redacted, scanned, spans_of, found_in
from tests.llm.conftest import by_id

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
KINDS = ("assign", "access", "hex")


def slow_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


HEXES = "0123456789abcdef" * 3
TEXTS = [
    None, "", "nothing here", "password=short", "password = 'longer1'", 'API_KEY:"abc.def=="; apikey: x',
    "secret: token :abcdefgh", "token=token=abcdefgh", "PASSWD\n=abcdefg", "secret: token=token: token=abcdefg",
    "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "B7" * 6, "xAKIA" + "Z" * 30 + "é", "AKIA" + "A" * 15 + "AKIA" + "1" * 16,
    HEXES[:23], HEXES[:24], "é\U0001f600" + HEXES + "g" + HEXES[:23] + " token=" + HEXES, "token = \"" + HEXES + "\"",
    "ſecret=abcdefgh toKen=abcdefgh", "password" * 3 + "=abcdef", "a" * 100000 + " token=abcdef " + "\n" * 5000,
    "token=abcdef " * 6000, "password=" + "x" * 50000, "api__key=abcdefgh api-key=abcdefgh", "secret'  =  'abcdef'",
]


def test_base_spans_equal_the_slow_ones(documents):
    got = by_id(scanned(documents(*enumerate(TEXTS), extra=True)), "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    for i, text in enumerate(TEXTS):
        want = slow_base(text)
        counts = tuple(len(re.findall(k + ":", want)) for k in KINDS)
        assert got[i][:3] == counts and got[i][3] == hashlib.sha256(want.encode()).hexdigest(), (i, text and text[:50], got[i][4][:80], want[:80])
        assert [s for s in got[i][4].split(",") if s.split(":")[0] in KINDS] == [s for s in want.split(",") if s]


VALUE = "wJalrXUtnFEMI7MDENGbPxRfiCYEXAMPLEKEY"


def spans_in(documents, text):
    return by_id(scanned(documents((1, text))), "spans")[1]


def test_weak_parts_count_only_together(documents):
    user, url = "user = bob1", "https://db.example.com:8443"
    gap = " lorem" * 60
    assert spans_in(documents, user) == ""
    assert spans_in(documents, VALUE) == ""
    assert spans_in(documents, url) == ""
    assert spans_in(documents, f"{user} {url}") == ""
    assert spans_in(documents, f"{user} {VALUE}") == f"identifier:0:11,value:12:{12 + len(VALUE)}"
    assert spans_in(documents, f"{user} {gap} {VALUE}") == ""
    three = f"{VALUE} {user} {url}"
    assert [s.split(":")[0] for s in spans_in(documents, three).split(",")] == ["value", "identifier", "endpoint"]
    assert [s.split(":")[0] for s in spans_in(documents, f"{user} {VALUE}{gap}{url}").split(",")] == ["identifier", "value"]
    key = "AKIA" + "A" * 16
    assert [s.split(":")[0] for s in spans_in(documents, f"{key} {VALUE}").split(",")] == ["access", "value"]
    assert [s.split(":")[0] for s in spans_in(documents, f"login: bob1 password=hunter22 {url}").split(",")] == ["identifier", "assign", "endpoint"]


def test_links_equal_brute_force(spark):
    import random

    rng = random.Random(7)
    rows = []
    for text in range(12):
        for _ in range(rng.choice([3, 40, 400])):
            s = rng.randrange(0, 30000)
            rows.append((f"t{text}", rng.randrange(6), s, s + 10))
    rows = sorted(set(rows))
    got = {tuple(r) for r in linked(spark.createDataFrame(rows, "text_key string, k int, s int, e int"), 200).collect()}
    role = [secrets.ROLE[k] for k in secrets.KINDS]
    want = set()
    for t, k, s, e in rows:
        needs = secrets.NEEDS.get(secrets.KINDS[k], ())
        if all(any(t == u and role[q] == n and abs(a - s) <= 200 for u, q, a, _ in rows) for n in needs):
            want.add((t, k, s, e))
    assert got == want


def test_gaps_equal_brute_force(spark):
    import random

    rng = random.Random(8)
    rows = []
    for text in range(12):
        for _ in range(rng.choice([3, 30, 60])):
            s = rng.randrange(0, 30000)
            rows.append((f"t{text}", rng.randrange(6), s, s + rng.choice([10, 199, 200, 1500])))
    rows += [("edge", 0, 0, 300), ("edge", 3, 500, 510), ("far", 0, 0, 300), ("far", 3, 501, 511), ("inside", 3, 0, 5000), ("inside", 4, 2000, 2010)]
    rows = sorted(set(rows))
    got = {tuple(r) for r in linked(spark.createDataFrame(rows, "text_key string, k int, s int, e int"), 200, gaps=True).collect()}
    role = [secrets.ROLE[k] for k in secrets.KINDS]
    want = set()
    for t, k, s, e in rows:
        needs = secrets.NEEDS.get(secrets.KINDS[k], ())
        if all(any(t == u and role[q] == n and max(a - e, s - b) <= 200 for u, q, a, b in rows) for n in needs):
            want.add((t, k, s, e))
    assert got == want
    assert ("edge", 3, 500, 510) in got and ("far", 3, 501, 511) not in got and ("inside", 4, 2000, 2010) in got


def test_an_endpoint_behind_a_long_secret_counts(documents):
    text = f"password={'x' * 300} user = bob1 https://db.example.com:8443"
    assert [s.split(":")[0] for s in spans_in(documents, text).split(",")] == ["assign", "identifier", "endpoint"]


def test_texts_that_repeat_and_no_rows(documents):
    rows = [(i % 40, "x token=abcdefgh y") for i in range(80)] + [(None, "password: abcdefgh")]
    got = scanned(documents(*rows)).collect()
    assert len(got) == 81 and all(r.n_assign == 1 for r in got)
    assert scanned(documents()).collect() == []


def test_redacted_masks_spans_and_keeps_the_rest(documents):
    texts = [None, "", "clean é text", "a token=abcdefgh b", "token=" + HEXES + " tail", HEXES + HEXES[:3] + "!" + "AKIA" + "B" * 16 + "é", f"é user = bob1 {VALUE}. end"]
    docs = documents(*enumerate(texts), extra=True)
    out = redacted(docs)
    assert out.columns == docs.columns
    got = by_id(out, "text")
    assert [got[i] for i in range(len(texts))] == [
        None, "", "clean é text", "a [secret] b", "[secret] tail", "[secret]![secret]é", "é [secret] [secret]. end"
    ]


def test_no_python_in_the_plan(documents, plan):
    docs = documents((1, "token=abcdefgh"))
    for df in (found_in(docs), spans_of(found_in(docs)), scanned(docs), redacted(docs)):
        assert not re.search("EvalPython|MapIn|FlatMap|CoGroup|Pandas|Arrow", plan(df))
    assert scanned(docs).where(F.col("n_assign") == 1).count() == 1
