"""Quality rules: figures of each text, and lines that many documents of a host share.

Lines are normalised and hashed; the distinct documents of a host with such a line are counted, copies
of one text each on its own. Lines above the host's limit are taken out, and a document
that loses too many of its words is rejected. All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.llm.common import BLANK, ascii_lower, settled, words

# The blanks themselves, and the symbols that are counted.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rules:
    """A text needs ``least_words``; at most ``most_repeated`` percent of its words may be in repeated windows.

    A line is removed if more documents of its host have it than ``line_share`` of the host's, but
    at least ``line_floor`` and at most ``line_ceiling``: a small host can lose a line, and a large
    one does not keep what hundreds of its documents share. A document is depleted if less
    than ``least_left`` of its words remain.
    """

    least_words: int = 50
    most_repeated: int = 50
    line_floor: int = 10
    line_share: float = 0.02
    line_ceiling: int = 100
    least_left: float = 0.3


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def figures(docs: DataFrame) -> DataFrame:
    """``docs`` columns doc_id and source with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and ``lines`` (hash and words of each line that has any).

    Null texts are empty. Only doc_id, source and text are read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", "source", text.alias("text"))
    rows = rows.select(
        "doc_id",
        "source",
        "text",
        words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: F.trim(x, F.lit(BLANKS)) != "").alias("full_lines"),
    )
    # The hash of each window of three words; a window is its first word's place.
    hashed = F.transform(
        F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
    )
    rows = rows.select("*", hashed.alias("windows"))
    # Windows found twice stand next to each other when sorted; most texts have none.
    order = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h: bigint, i: int>>"))
    rows = rows.select("*", order.alias("sorted"))
    again = F.filter(
        "sorted",
        lambda x, k: F.coalesce(F.get("sorted", k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("sorted", k + 1)["h"] == x["h"], F.lit(False)),
    )
    rows = rows.select("*", F.sort_array(F.transform(again, lambda x: x["i"])).alias("places"))
    # Each place covers three words, or as many as lie before the next place.
    covered = F.transform("places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - p, F.lit(3))))
    plain = lambda x: ascii_lower(F.regexp_replace(F.trim(x, F.lit(BLANKS)), f"{BLANK}+", " "))
    line = lambda x: F.struct(
        F.xxhash64(plain(x)).alias("line"), F.regexp_count(x, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("n")
    )
    return rows.select(
        "doc_id",
        "source",
        F.size("words").cast("long").alias("n_words"),
        _without(F.col("text"), BLANKS).cast("long").alias("word_chars"),
        (F.length("text") - _without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0).cast("long"), lambda a, n: a + n).alias("n_repeat_words"),
        F.transform("full_lines", line).alias("lines"),
    )


def ruled(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    removed_words and kept of each row of ``docs``; the host of a document is its source.

    Null and empty texts have no words, and fail. Sources that are null are one host.
    Rows of one doc_id are one document in the counts, rows without an id one each; every
    row is judged by its own text. Other columns are not read.
    """
    base = figures(docs).withColumn("_row", F.monotonically_increasing_id())
    base = settled(base, "figures")
    host = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("~"))
    document = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("row"), "_row")).otherwise(F.xxhash64("doc_id"))
    lines = base.select("_row", host.alias("host"), document.alias("document"), "lines")
    limits = lines.groupBy("host").agg(F.count_distinct("document").alias("documents"))
    limit = F.greatest(F.lit(float(rules.line_floor)), F.lit(rules.line_share) * F.col("documents"))
    limits = limits.select(F.col("host"), F.least(limit, F.lit(float(rules.line_ceiling))).alias("limit"))
    lines = lines.select("_row", "host", "document", F.explode("lines").alias("l")).select(
        "_row", "host", "document", F.col("l.line").alias("line"), F.col("l.n").alias("n")
    )
    common = (
        lines.select("host", "line", "document").distinct()
        .groupBy("host", "line").agg(F.count("*").alias("documents"))
        .join(limits, "host")
        .where("documents > limit")
        .select("host", "line")
    )
    common = settled(common, "lines")
    removed = lines.join(common, ["host", "line"]).groupBy("_row").agg(F.sum("n").alias("removed"))
    removed = settled(removed.select(F.col("_row").alias("_r"), "removed"), "removed")
    rows = base.drop("lines").join(removed, F.col("_row") == F.col("_r"), "left")
    out = F.coalesce("removed", F.lit(0)).cast("long")
    failed = (F.col("n_words") < rules.least_words) | (
        100 * F.col("n_repeat_words") > rules.most_repeated * F.col("n_words")
    )
    depleted = F.col("n_words") - out < F.lit(rules.least_left) * F.col("n_words")
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        out.alias("removed_words"),
        (~failed & ~depleted).alias("kept"),
    )
