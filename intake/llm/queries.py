"""The queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.llm import oracles
from intake.llm.ann import nearest
from intake.llm.common import table
from intake.llm.jaccard import jaccard_links
from intake.llm.lines import ruled
from intake.llm.mixing import mixed
from intake.llm.packing import packed
from intake.llm.periods import periodic_runs, stuttered
from intake.llm.quality import classified
from intake.llm.secrets import scanned
from intake.llm.simhash import near_duplicates
from intake.llm.tokens import document_tokens
from intake.llm.turns import audited_among, damaged
from intake.llm.urls import Rule, judged
from intake.llm.warc import parse_records, read_archive, write_archive
from intake.workspace import run_dir

Query = Callable[[SparkSession, str], DataFrame]

# The rules for hosts and paths.
URL_RULES = (
    Rule("block", "net"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    return parse_records(read_archive(spark, path)).drop("target_uri")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urls that no rule decides are blocked where a page of theirs has under 1000 bytes."""
    thin = F.coalesce(F.octet_length("html"), F.lit(0)) < 1000
    return judged(table(spark, sf_dir, "pages"), URL_RULES, thin)


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ruled(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).drop("key")


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(stuttered(table(spark, sf_dir, "documents")))
    # The longest run, then the first one, then the shorter period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    line = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(table(spark, sf_dir, "documents"))


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return audited_among(damaged(rows), rows)


QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_warc": op3_warc,
    "op4_secrets": op4_secrets,
    "op5_urls": op5_urls,
    "op6_tokens": op6_tokens,
    "op7_packing": op7_packing,
    "op8_neighbours": op8_neighbours,
    "op9_lines": op9_lines,
    "op10_mixing": op10_mixing,
    "op11_runs": op11_runs,
    "op12_jaccard": op12_jaccard,
    "op13_turns": op13_turns,
}

ORACLES: dict[str, str] = {
    "op3_warc": oracles.WARC,
    "op5_urls": oracles.URL_FILTER,
    "op9_lines": oracles.QUALITY_RULES,
}
