"""Approximate nearest neighbours by inner product over balanced posting lists.

Centroids are fitted on a bounded sample; every vector is filed under its nearest centroid and,
near a boundary, under others almost as near. Long lists are cut into parts of bounded
length. Queries find centroids through a graph of their neighbours that every task holds in
memory; a query reads all lists whose distance is within a ratio of the nearest one's, however
many. Lists and queries meet in a join, scores are exact.

Inner products become distances by one more coordinate: with it all vectors have the
length of the longest, and a query, which has 0 there, is nearest to the largest product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from intake.llm.common import settled


@dataclass(frozen=True)
class Lists:
    """``sample`` vectors at most train up to ``sample // 4`` centroids, one for ``length`` vectors.

    A vector is filed in up to ``copies`` lists no farther than ``file_ratio`` times its
    nearest; a query reads all lists no farther than ``read_ratio`` times. A task
    takes lists of ``bundle`` vectors together, about, none longer than ``part``, and ``part`` queries.
    ``degree`` and ``width`` are the graph's neighbours and the breadth of its search; a query
    whose search ends inside the ratio looks at all centroids.
    """

    sample: int = 16_384
    length: int = 64
    copies: int = 2
    file_ratio: float = 1.1
    read_ratio: float = 1.35
    part: int = 1024
    bundle: int = 8192
    degree: int = 24
    width: int = 288
    rounds: int = 8
    seed: int = 42


@dataclass(frozen=True)
class Graph:
    """Centroids (unit length, with the extra coordinate), neighbours of each, where searches start."""

    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray


def fit(vectors: np.ndarray, count: int, how: Lists) -> Graph:
    """Spherical k-means on unit ``vectors``, and the graph of its centroids.

    An empty centroid moves to half of the largest list, so that lists stay balanced.
    """
    rng = np.random.default_rng(how.seed)
    count = max(1, min(count, len(vectors)))
    centroids = vectors[np.sort(rng.choice(len(vectors), count, replace=False))].astype(np.float32)
    for _ in range(how.rounds):
        owner = np.concatenate([(v @ centroids.T).argmax(axis=1) for v in np.array_split(vectors, 1 + len(vectors) // 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, vectors)
        sizes = np.bincount(owner, minlength=count)
        for empty in np.flatnonzero(sizes == 0):
            largest = sizes.argmax()
            member = vectors[rng.choice(np.flatnonzero(owner == largest))]
            sums[empty], sizes[empty] = member, sizes[largest] // 2
            sizes[largest] -= sizes[empty]
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norm > 0, sums / np.maximum(norm, 1e-30), centroids).astype(np.float32)
    degree = min(how.degree, count - 1)
    near = np.empty((count, degree + 4), np.int64)
    for at in range(0, count, 1024):
        product = centroids[at : at + 1024] @ centroids.T
        product[np.arange(len(product)), np.arange(at, at + len(product))] = -np.inf
        near[at : at + 1024, :degree] = np.argpartition(-product, max(0, degree - 1), axis=1)[:, :degree]
    # A few links to anywhere keep the graph connected.
    near[:, degree:] = rng.integers(0, count, (count, 4))
    return Graph(centroids, near, rng.choice(count, min(count, 16), replace=False))


def nearest_centroids(queries: np.ndarray, graph: Graph, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroid numbers and products, nearest first, of a best-first search for each query.

    All queries walk at once: each step adds the neighbours of what they hold and keeps
    the ``width`` nearest, until nothing changes.
    """
    width = min(width, len(graph.centroids))
    held = np.tile(graph.entries, (len(queries), 1))
    before = None
    while True:
        front = held if before is None else held[:, : max(1, width // 4)]
        wide = np.concatenate([held, graph.neighbours[front].reshape(len(queries), -1)], axis=1)
        wide.sort(axis=1)
        again = np.zeros(wide.shape, bool)
        again[:, 1:] = wide[:, 1:] == wide[:, :-1]
        product = np.einsum("qd,qkd->qk", queries, graph.centroids[wide], optimize=True)
        product[again] = -np.inf
        keep = np.argsort(-product, axis=1, kind="stable")[:, :width]
        held = np.take_along_axis(wide, keep, axis=1)
        product = np.take_along_axis(product, keep, axis=1)
        if before is not None and np.array_equal(before, held):
            return held, product
        before = held


def _distance(product: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * product, 0))


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Unit vectors with one more coordinate that fills them up to ``longest``."""
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1, keepdims=True), 0))
    return np.concatenate([scaled, rest], axis=1).astype(np.float32)


def files_of(vectors: np.ndarray, graph: Graph, how: Lists) -> list[np.ndarray]:
    """The lists each (lifted) vector is filed in: the nearest, and others across a boundary."""
    out = []
    copies = min(how.copies, len(graph.centroids))
    for block in np.array_split(vectors, 1 + len(vectors) // 1024):
        product = block @ graph.centroids.T
        lists = np.argpartition(-product, copies - 1, axis=1)[:, :copies]
        product = np.take_along_axis(product, lists, axis=1)
        near = _distance(product)
        inside = near <= how.file_ratio * near.min(axis=1, keepdims=True) + 1e-6
        out += [lists[i][inside[i]] for i in range(len(block))]
    return out


def probes_of(queries: np.ndarray, graph: Graph, sizes: np.ndarray, least: int, how: Lists) -> list[np.ndarray]:
    """The lists each (unit) query reads, nearest first: those within the ratio, and others
    until they hold ``least`` vectors, by the ``sizes`` of the lists."""
    out = []
    for block in np.array_split(queries, 1 + len(queries) // 256):
        if len(block):
            lists, product = nearest_centroids(block, graph, how.width)
            found = [lists[i][row] for i, row in enumerate(_inside(lists, product, sizes, least, how))]
            # All that was found is inside: there can be more.
            more = [i for i, own in enumerate(found) if len(own) == lists.shape[1] < len(graph.centroids)]
            if more:
                product = block[more] @ graph.centroids.T
                lists = np.argsort(-product, axis=1, kind="stable")
                product = np.take_along_axis(product, lists, axis=1)
                for i, own, row in zip(more, lists, _inside(lists, product, sizes, least, how), strict=True):
                    found[i] = own[row]
            out += found
    return out


def _inside(lists: np.ndarray, product: np.ndarray, sizes: np.ndarray, least: int, how: Lists) -> np.ndarray:
    near = _distance(product)
    held = np.cumsum(sizes[lists], axis=1) - sizes[lists]
    inside = (near <= how.read_ratio * near[:, :1] + 1e-6) | (held < least)
    return inside & np.isfinite(product)


def bundled(found: list[np.ndarray], first: np.ndarray, bundles: int) -> list[tuple[int, int, np.ndarray]]:
    """(query, bundle, lists) of the lists each query reads: list l is cut into the parts from
    ``first[l]`` to ``first[l + 1]``, part p lies in bundle p % ``bundles``."""
    lists = np.concatenate(found)
    asker = np.repeat(np.arange(len(found)), [len(x) for x in found])
    cuts = first[lists + 1] - first[lists]
    asker, start, lists = (np.repeat(x, cuts) for x in (asker, first[lists], lists))
    place = np.arange(len(lists)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    # A query goes to a bundle once, also with several parts of a list there.
    rows = np.unique(np.stack([asker, (start + place) % bundles, lists], axis=1), axis=0)
    ends = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
    return [(int(x[0, 0]), int(x[0, 1]), x[:, 2]) for x in np.split(rows, ends) if len(x)]


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` of the rows that take part.

    Left out are null ids, null and empty vectors, vectors of zeros only or with a null or
    non-finite component, and those of another dimension than most have (of two
    that most have, the smaller).
    """
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(finite & F.exists(x, lambda v: v != 0))
    sizes = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("c"))
    most = sizes.orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("vector") == (most["n"] if most else 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 1))


def best_of(have: pd.DataFrame, want: pd.DataFrame, n: int) -> pd.DataFrame:
    """(q, cls, score): of each query (cls, vector, lists) the ``n`` best classes among the
    members (list, cls, vector) of its lists; equal scores go to the smaller class."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(have) and len(want):
        have = have.sort_values("list")
        members, lists, names = _matrix(have["vector"]), have["list"].to_numpy(), have["cls"].to_numpy()
        queries, asked = _matrix(want["vector"]), np.concatenate(want["lists"].to_numpy())
        asker = np.repeat(np.arange(len(want)), want["lists"].map(len))
        order = np.argsort(asked, kind="stable")
        asked, asker = asked[order], asker[order]
        for number in np.unique(lists):
            at = slice(*np.searchsorted(lists, [number, number + 1]))
            who = asker[slice(*np.searchsorted(asked, [number, number + 1]))]
            if len(who):
                product = np.einsum("qd,vd->qv", queries[who], members[at])
                least = np.full((len(who), 1), -np.inf)
                if product.shape[1] > n:
                    least = np.partition(product, -n, axis=1)[:, -n, None]
                q, v = np.nonzero(product >= least)  # ties at the end stay for now
                out.append((who[q], names[at][v], product[q, v]))
    if not out:
        return pd.DataFrame({"q": [], "cls": [], "score": []}).astype({"q": int, "cls": int, "score": float})
    q, cls, score = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.lexsort((cls, q))  # a class can be in several lists
    q, cls, score = q[order], cls[order], score[order]
    once = np.ones(len(q), bool)
    once[1:] = (q[1:] != q[:-1]) | (cls[1:] != cls[:-1])
    q, cls, score = q[once], cls[once], score[once]
    order = np.lexsort((cls, -score, q))
    q, cls, score = q[order], cls[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    top = rank < n
    return pd.DataFrame({"q": want["cls"].to_numpy()[q[top]], "cls": cls[top], "score": score[top]})


def nearest(rows: DataFrame, every: int = 20, best: int = 20, how: Lists = Lists(), vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``best`` largest inner products found for each query.

    Queries are the vectors whose id is divisible by ``every``; candidates are all vectors
    but those of the query's own id. Scores are in double precision, ties go to the smaller id. ``usable`` says which rows take part;
    rows that repeat an id and a vector count once. Equal vectors are searched once: of them only the ``best
    + 1`` smallest ids can be among any query's best.
    """
    spark = rows.sparkSession
    rows = settled(usable(rows, vector).distinct(), "vectors")
    # One row for each different vector, named by a hash of its components.
    rows = rows.withColumn("same", F.sha2(F.array_join(F.transform("vector", lambda v: F.format_string("%a", v + 0.0)), ","), 256))
    order = F.row_number().over(Window.partitionBy("same").orderBy("vec_id"))
    firsts = rows.withColumn("place", order).where(F.col("place") <= best + 1)
    firsts = settled(firsts, "vectors")
    classes = settled(
        firsts.where("place = 1").select(F.col("vec_id").alias("cls"), "same", "vector"), "classes"
    )
    members = firsts.join(classes.select("cls", "same"), "same").select("cls", "vec_id")
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "same")
    asked = asked.join(classes.select("cls", "same"), "same").select("query_id", "cls")
    asked = settled(asked, "queries")
    count, longest = classes.agg(
        F.count("*"), F.max(F.aggregate("vector", F.lit(0.0), lambda a, v: a + v * v))
    ).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = float(np.sqrt(longest))
    # A bounded sample by hash trains the centroids; every vector is filed.
    sample = classes.orderBy(F.xxhash64("cls", F.lit(how.seed))).limit(how.sample).select("vector").toPandas()
    graph = fit(lifted(_matrix(sample["vector"]), longest), min(count // how.length, how.sample // 4), how)
    # As plain arrays, which executors can read without this package.
    sent = spark.sparkContext.broadcast((graph.centroids, graph.neighbours, graph.entries))

    def filed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                part["list"] = files_of(lifted(_matrix(part["vector"]), longest), Graph(*sent.value), how)
                yield part[["cls", "vector", "list"]].explode("list")

    shape = "cls long, vector array<double>, list long"
    lists = settled(classes.select("cls", "vector").mapInPandas(filed, shape), "lists")
    sizes = np.zeros(len(graph.centroids), np.int64)
    for number, n in lists.groupBy("list").count().collect():  # a row for each centroid at most
        sizes[number] = n
    searching = classes.join(asked.select("cls").distinct(), "cls", "left_semi").select("cls", "vector")
    # Long lists are cut in parts, and parts dealt to bundles that one task can take; a query
    # goes once to each bundle with a list of its own, queries of a bundle in blocks.
    first = np.concatenate([[0], np.cumsum(-(-sizes // how.part))])
    bundles = max(1, -(-int(sizes.sum()) // how.bundle))

    def probing(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in parts:
            for at in range(0, len(whole), 256):
                part = whole.iloc[at : at + 256]
                unit = _matrix(part["vector"])
                unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                unit = np.concatenate([unit, np.zeros((len(unit), 1))], axis=1).astype(np.float32)
                found = probes_of(unit, Graph(*sent.value), sizes, how.copies * (best + 1), how)
                who, bundle, own = zip(*bundled(found, first, bundles), strict=True)
                asking = part.iloc[list(who)]
                yield pd.DataFrame(
                    {"bundle": bundle, "cls": asking["cls"].to_numpy(), "vector": asking["vector"].to_numpy(), "lists": own}
                )

    seek = searching.mapInPandas(probing, "bundle long, cls long, vector array<double>, lists array<long>")
    seek = settled(seek, "probes")
    # A row for each centroid at most.
    cuts = [(i, int(first[i]), int(first[i + 1] - first[i])) for i in range(len(sizes)) if sizes[i]]
    cuts = F.broadcast(spark.createDataFrame(cuts, "list long, first long, cuts long"))
    held = lists.join(cuts, "list").withColumn("cut", F.pmod(F.xxhash64("cls"), F.col("cuts")))
    held = held.select(F.pmod(F.col("first") + F.col("cut"), F.lit(bundles)).alias("bundle"), "list", "cls", "vector")
    blocks = settled(seek.groupBy("bundle").agg(F.ceil(F.count("*") / how.part).alias("blocks")), "parts")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    held = held.join(blocks, "bundle").select("bundle", every_block, "list", "cls", "vector")
    own_block = F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("block")
    seek = seek.join(blocks.toDF("bundle", "blocks"), "bundle").select("bundle", own_block, "cls", "vector", "lists")

    def scored(key: tuple, have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        return best_of(have, want, best + 1)

    by = ["bundle", "block"]
    found = held.groupBy(*by).cogroup(seek.groupBy(*by)).applyInPandas(scored, "q long, cls long, score double")
    # A candidate can come from several lists; its score is the same from each.
    found = found.groupBy("q", "cls").agg(F.max("score").alias("score"))
    ranked = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cls"))
    found = settled(found.withColumn("place", ranked).where(F.col("place") <= best + 1).drop("place"), "found")
    pairs = asked.join(found, asked["cls"] == found["q"]).select("query_id", found["cls"], "score")
    pairs = pairs.join(members, "cls").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        pairs.withColumn("rank", rank.cast("int"))
        .where(F.col("rank") <= best)
        .select("query_id", "rank", "vec_id", "score")
    )
