"""Secret scans: base patterns, and weak parts that count only together.

Three base patterns are reported wherever they match. The parts of a credential are weaker: an
access identifier, a secret value, an endpoint. Such a part is reported only where the other
parts it needs stand within its scope, so many code points from the end of the one to the start of
the other. The parts of a text meet in an interval join on cells of its length; all but the outermost of a
kind in a cell are merged first, so that no pairs are written out. All of it is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from intake.llm.common import settled, whole

# The base patterns. A run of 24 or more hexadecimal digits is found by its
# length at once, as is an access key of 20 or more characters: where a shorter run starts,
# no longer one can. The value of an assignment is measured after matching, since
# matching goes on behind a match that is dropped.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

# Weak parts: a user or key name with its value, a run of mixed letters and digits, a service's address.
IDENTIFIER = (
    r"""(?i:\b(?:client_?id|user(?:_?name)?|login|account|access_?key(?:_?id)?))["']?"""
    r"""\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}"""
)
VALUE = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])"
    r"[A-Za-z0-9+/_-]{16,}={0,2}"
)
ENDPOINT = r"(?i:\b(?:https?|ftp|jdbc:[a-z0-9]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://)[A-Za-z0-9._~%:@-]+"

# Kinds in their order; the part of a credential that each is; what weak ones need beside them.
PATTERNS = {
    "assign": ASSIGN,
    "access": ACCESS,
    "hex": HEX,
    "identifier": IDENTIFIER,
    "value": VALUE,
    "endpoint": ENDPOINT,
}
KINDS = tuple(PATTERNS)
BASE = KINDS[:3]
ROLE = {
    "assign": "secret",
    "access": "id",
    "hex": "secret",
    "identifier": "id",
    "value": "secret",
    "endpoint": "endpoint",
}
NEEDS = {"identifier": ("secret",), "value": ("id",), "endpoint": ("id", "secret")}

FOUND = "array<struct<k: int, b: int, m: int, v: int>>"


def _matches(text: Column, kind: str) -> Column:
    """Of each match: kind, length of what lies before it (since the last), its length, its value's length."""
    pattern, number = PATTERNS[kind], KINDS.index(kind)
    before = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if kind == "assign" else 0))
    rows = F.transform(
        F.arrays_zip(whole.alias("m"), before.alias("b"), value.alias("v")),
        lambda x: F.struct(
            F.lit(number).alias("k"),
            F.length(x["b"]).alias("b"),
            F.length(x["m"]).alias("m"),
            F.length(x["v"]).alias("v"),
        ),
    )
    # There is a piece more than there are matches: it lies behind the last.
    rows = F.filter(rows, lambda x: x["m"].isNotNull())
    return F.when(text.rlike(pattern), rows).otherwise(F.array()).cast(FOUND)


def found_in(docs: DataFrame) -> DataFrame:
    """doc_id, ``text_key`` (a digest of the text) and ``found`` (its matches) of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select("*", *[_matches(F.col("text"), k).alias(f"_{k}") for k in (*BASE, "identifier")])
    # Values and addresses count beside an identifier only, so other texts are not searched for them.
    some_id = (F.size("_access") > 0) | (F.size("_identifier") > 0)
    none = F.array().cast(FOUND)
    rows = rows.select("*", *[F.when(some_id, _matches(F.col("text"), k)).otherwise(none).alias(f"_{k}") for k in ("value", "endpoint")])
    return rows.select(
        "doc_id", F.sha2("text", 256).alias("text_key"), F.concat(*[F.col(f"_{k}") for k in KINDS]).alias("found")
    )


def spans_of(found: DataFrame) -> DataFrame:
    """``text_key``, ``k`` (number of the kind), ``s``, ``e`` of each match, weak ones too.

    Each text counts once. Places are sums of lengths along the text's matches of a kind.
    """
    texts = found.where(F.size("found") > 0).dropDuplicates(["text_key"])
    each = texts.select("text_key", F.posexplode("found").alias("i", "x")).select(
        "text_key", "i", "x.k", "x.b", "x.m", "x.v"
    )
    along = Window.partitionBy("text_key", "k").orderBy("i")
    end = F.sum(F.col("b") + F.col("m")).over(along)
    placed = each.withColumn("e", end).withColumn("s", F.col("e") - F.col("m"))
    dropped = (F.col("k") == KINDS.index("assign")) & (F.col("v") < LEAST_VALUE)
    return placed.where(~dropped).select("text_key", "k", "s", "e")


def _map(of: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(x) if not isinstance(x, tuple) else F.array(*map(F.lit, x)) for k, v in of.items() for x in (KINDS.index(k), v)])


def linked(spans: DataFrame, scope: int, gaps: bool = False) -> DataFrame:
    """The base spans, and the weak ones that have all they need within ``scope``.

    With ``gaps`` the distance is that from the end of one span to the start of the other, 0 where they
    overlap; else that of their starts.
    """
    end = F.col("e") if gaps else F.col("s")
    first, last = F.floor(F.col("s") / scope), F.floor(end / scope)
    marked = spans.select("text_key", _map(ROLE)[F.col("k")].alias("role"), "s", end.alias("end"), F.explode(F.sequence(first, last)).alias("cell"))
    # Of the places that a role takes in a cell the first and the last decide for all others.
    marks = marked.groupBy("text_key", "role", "cell").agg(
        F.min(F.greatest("s", F.col("cell") * scope)).alias("low"),
        F.max(F.least("end", (F.col("cell") + 1) * scope - 1)).alias("high"),
    )
    weak = spans.where(F.col("k") >= len(BASE)).select(
        "text_key", "k", "s", "e", F.explode(_map(NEEDS)[F.col("k")]).alias("role")
    )
    near = weak.select("*", end.alias("end"), F.explode(F.sequence(first - 1, last + 1)).alias("cell"))
    met = near.join(marks, ["text_key", "role", "cell"]).where(
        (F.col("low") <= F.col("end") + scope) & (F.col("high") >= F.col("s") - scope)
    )
    met = met.groupBy("text_key", "k", "s", "e").agg(F.count_distinct("role").alias("n"))
    needed = _map({k: len(v) for k, v in NEEDS.items()})[F.col("k")]
    kept = met.where(F.col("n") == needed).select("text_key", "k", "s", "e")
    return spans.where(F.col("k") < len(BASE)).unionByName(kept)


def by_text(spans: DataFrame) -> DataFrame:
    """``text_key`` and ``spans`` [struct(s, k, e, kept)], in order, of each text with any.

    ``kept`` is where the text before a span begins: where earlier spans have ended.
    """
    order = Window.partitionBy("text_key").orderBy("s", "k")
    past = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = spans.withColumn("kept", F.coalesce(past, F.lit(0)))
    return rows.groupBy("text_key").agg(F.array_sort(F.collect_list(F.struct("s", "k", "e", "kept"))).alias("spans"))


def _written(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def scanned(docs: DataFrame, scope: int = 200) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked of each row of ``docs``.

    Reads doc_id and text. Null and empty texts have no spans: counts of 0, the digest of
    an empty string, an empty string. Texts that repeat have the same spans.
    """
    found = settled(found_in(docs), "matches")
    spans = settled(by_text(linked(settled(spans_of(found), "spans"), scope, gaps=True)), "spans")
    rows = found.select("doc_id", "text_key").join(spans, "text_key", "left")
    rows = rows.withColumn("spans", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)))
    base = F.filter("spans", lambda x: x["k"] < len(BASE))
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    return rows.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE)],
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_linked"),
    )


def redacted(docs: DataFrame, mask: str = "[secret]", scope: int = 200) -> DataFrame:
    """``docs``, all columns, with every span of its text replaced by ``mask``.

    Spans that overlap become one mask. Texts without spans, null ones too, stay as they are.
    """
    found = settled(found_in(docs), "matches")
    spans = settled(by_text(linked(settled(spans_of(found), "spans"), scope, gaps=True)), "spans")
    key = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    rows = docs.select(whole(docs), key.alias("text_key")).join(spans, "text_key", "left")
    text = F.col("doc.text").cast("string")
    cuts = F.filter("spans", lambda x: x["s"] >= x["kept"])
    heads = F.transform(cuts, lambda x: F.substr(text, x["kept"] + 1, x["s"] - x["kept"]))
    tail = F.substr(text, F.array_max(F.transform("spans", lambda x: x["e"])) + 1)
    clean = F.concat(F.array_join(F.transform(heads, lambda h: F.concat(h, F.lit(mask))), ""), tail)
    text = F.when(F.col("spans").isNull(), text).otherwise(clean)
    return rows.select(*[(text if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
