"""What several operators share: reading, settling, words, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.workspace import run_dir

# What separates words (space, tab to carriage return), as a Java class.
BLANK = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared folder and read back.

    Cuts the lineage: what follows does not run the steps before it again, and a lost
    executor costs only its own tasks. Row numbers given before this step stay put.
    """
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text as an array; none for null, empty or blank texts."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{BLANK}+")
    return F.filter(parts, lambda w: w != "")


def word_count(text: Column) -> Column:
    """How many words, without keeping them."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def whole(df: DataFrame) -> Column:
    """All columns as one, ``doc``, whose fields cannot clash with columns put beside it."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("doc")


def row_key(*parts: Column, text: Column) -> Column:
    """A digest of a text and of short values beside it, null or not; equal rows have equal ones."""
    held = [F.coalesce(F.concat(F.octet_length(p.cast("string")).cast("string"), F.lit("="), p.cast("string")), F.lit("~")) for p in parts]
    return F.sha2(F.concat_ws(";", F.coalesce(F.sha2(text, 256), F.lit("~")), *held), 256)


def _sum_of(edges: DataFrame) -> tuple:
    """A fingerprint of a set of edges that does not depend on their order."""
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components: ``node``, ``root`` (the component's smallest node).

    ``edges`` has two long columns ``u`` and ``v``. Large-star and small-star rounds
    hang every node under the smallest neighbour it knows until each hangs under its
    root; the number of rounds grows with the logarithm of the longest chain. All
    steps are aggregates and joins of edges, so a node with very many neighbours is
    pre-aggregated per task and its join can be split. Nodes without edges (or with
    null ends, or only with themselves) are left out.
    """
    e = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    e = settled(e.distinct(), "edges")
    before = _sum_of(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        # Large star: neighbours above u hang under the smallest of u's neighbourhood.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settled(large.distinct(), "edges")
        # Small star: u and its lower neighbours hang under the lowest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = settled(e, "edges")
        after = _sum_of(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
