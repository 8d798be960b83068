"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

A source's documents, in seeded order, form a stream of words, cut into shards. Each
source's target is shared out among its shards; blocks of equal size then go, one by
one in principle, to the shard with the highest quotient ``weight / (2 * seats + 1)``.
That gives every shard an integer quota of blocks. A shard with quota ``q`` takes
``q`` blocks off its stream, going round it again when it ends, so no word is taken more
than twice, and all words of the first pass come before any of the second.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from intake.llm.common import row_key, settled, whole, word_count

#: Candidate quotients that one pass over the shards tries at a time.
_TRIES = 48
#: Open seats that are ranked in one go.
_RANKED = 10_000


@dataclass(frozen=True)
class Mix:
    """``weights`` go round over the sources in code point order, null last.

    ``share`` is the size of the mix over that of all sources, ``most`` the times a
    source (and a document) may be repeated, ``block`` the words of a block and
    ``shard`` the words of a shard, about.
    """

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    most: int = 2
    block: int = 16
    shard: int = 1 << 18
    seed: int = 42


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """``source``, ``source_size``, ``target`` of each row (source, source_size).

    Targets follow the weights; those above ``most`` times their source's size stop
    there and the excess goes to the others by weight, until none is above. Every
    round is one aggregate of the source table.
    """
    parts = sizes.withColumn("_null", F.col("source").isNull())
    # Ranks without a window over everything: range partitions, then offsets by part.
    parts = settled(parts.orderBy("_null", "source").withColumn("_part", F.spark_partition_id()), "sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_part").orderBy("_null", "source")
    place = F.col("_before") + F.row_number().over(inside) - 1
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    ranked = parts.join(offsets, "_part").withColumn(
        "weight", F.element_at(weights, (place % len(mix.weights) + 1).cast("int"))
    )
    ranked = settled(ranked.select("source", "source_size", "weight"), "sources")
    cap = F.lit(float(mix.most)) * F.col("source_size")
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * mix.share
    rate, capped = None, -1
    while True:
        full = F.lit(False) if rate is None else F.col("weight") * rate >= cap
        spent, left, n = ranked.agg(
            F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)
        ).first()
        if n == capped or not left:
            break
        rate, capped = (total - (spent or 0.0)) / left, n
    share = F.lit(0.0) if rate is None else F.col("weight") * rate
    return ranked.select("source", "source_size", F.least(share, cap).alias("target"))


def _seats(rate: Column) -> Column:
    """Seats whose quotient ``weight / (2k + 1)`` is at least ``rate``, within the shard's cap."""
    return F.least(F.col("seats_cap"), F.floor((F.col("weight") / rate + 1) / 2)).cast("long")


def apportion(parties: DataFrame, seats: int) -> DataFrame:
    """Sainte-Laguë: ``parties`` with a column ``seats``, in all ``seats`` of them.

    ``parties`` has ``weight`` (double), ``seats_cap`` (long) and ``party`` (a string
    that is unique, for ties). Passes of many candidates at once, each one aggregate,
    close in on the quotient of the last seat; the few seats left open between the two
    bounds are then ranked by quotient. If all caps together give fewer seats, all caps
    are filled.
    """
    top, room = parties.agg(F.max("weight"), F.sum("seats_cap")).first()
    if not top or seats <= 0:
        return parties.withColumn("seats", F.lit(0).cast("long"))
    if seats >= room:
        return parties.withColumn("seats", F.col("seats_cap").cast("long"))
    low, high = (0.0, room), (2.0 * top, 0)  # (quotient, seats that reach it)
    while low[1] - high[1] > _RANKED and high[0] - low[0] > 1e-13 * high[0]:
        foot = low[0] or high[0] * 1e-9
        step = (high[0] / foot) ** (1 / (_TRIES + 1))
        tries = [foot * step**i for i in range(_TRIES + 1)]
        # One row of a party for each candidate, summed at once.
        each = parties.select("weight", "seats_cap", F.posexplode(F.lit(tries)).alias("i", "rate"))
        given = dict(each.groupBy("i").agg(F.sum(_seats(F.col("rate")))).collect())
        tried = [(t, given[i]) for i, t in enumerate(tries)]
        low = max([low, *[x for x in tried if x[1] >= seats]], key=lambda x: x[0])
        high = min([high, *[x for x in tried if x[1] < seats and x[0] > low[0]]], key=lambda x: x[0])
    sure = parties.withColumn("_sure", _seats(F.lit(high[0])))
    sure = sure.withColumn("_most", _seats(F.lit(low[0])) if low[0] else F.col("seats_cap"))
    quotient = F.col("weight") / (2 * F.col("k") + 1)
    open_seats = sure.where("_most > _sure").select(
        "party", "weight", F.explode(F.sequence("_sure", F.col("_most") - 1)).alias("k")
    )
    open_seats = open_seats.select("party", quotient.alias("_quotient"))
    # Where many quotients tie, many seats are open: ranked by range partitions, then offsets by part.
    order = [F.desc("_quotient"), "party"]
    open_seats = settled(open_seats.orderBy(*order).withColumn("_part", F.spark_partition_id()), "seats")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = open_seats.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    open_seats = (
        open_seats.join(offsets, "_part")
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside))
        .where(F.col("_rank") <= seats - high[1])
        .groupBy("party")
        .agg(F.count("*").alias("_more"))
    )
    return sure.join(open_seats, "party", "left").select(
        *parties.columns, (F.col("_sure") + F.coalesce("_more", F.lit(0))).cast("long").alias("seats")
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, ``key``, size, source_size, target and taken of each row of ``docs``.

    Reads doc_id, text and source only, whatever else ``docs`` has; ``key`` is a digest
    of these three. Null texts have size 0; a null source is a source of its own and
    comes last; rows that repeat are separate documents. Without documents, or with
    empty ones only, all sizes, targets and takings are 0. Shards and the order in
    them are seeded by id and text, so reruns over the same files agree.
    """
    small = docs.select(
        "doc_id",
        "source",
        row_key(F.col("doc_id"), F.col("source"), text=F.col("text")).alias("key"),
        word_count(F.col("text")).alias("size"),
        F.monotonically_increasing_id().alias("_row"),
    )
    small = settled(small, "sizes")
    by_source = small.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = settled(source_targets(by_source, mix), "targets").select(
        F.col("source").alias("_s"),
        "source_size",
        "target",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / mix.shard)).cast("long").alias("_shards"),
    )
    rows = small.join(targets, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("_order", F.xxhash64("key", F.lit(mix.seed)))
    dealt = F.pmod(F.xxhash64("_order", "_row", F.lit(mix.seed + 1)), F.col("_shards"))
    rows = rows.withColumn("_shard", dealt)
    stream = Window.partitionBy("source", "_shard").orderBy("_order", "key", "_row")
    before = stream.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    rows = settled(rows, "shards")
    parties = (
        rows.groupBy("source", "_shard")
        .agg(
            F.sum("size").alias("_words"),
            F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
        )
        .where("_words > 0")
        .select(
            F.concat_ws(":", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("~")), "_shard").alias("party"),
            F.col("source").alias("_s"),
            F.col("_shard").alias("_sh"),
            "_words",
            (F.col("target") * F.col("_words") / F.col("source_size")).alias("weight"),
            F.floor(F.lit(mix.most) * F.col("_words") / mix.block).cast("long").alias("seats_cap"),
        )
    )
    parties = settled(parties, "parties")
    wanted = parties.agg(F.sum("weight")).first()[0] or 0.0
    quotas = apportion(parties, round(wanted / mix.block)).select(
        "_s", "_sh", "_words", (F.col("seats") * mix.block).alias("_quota")
    )
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_sh"))
    rows = rows.join(quotas, same, "left")
    rounds = F.floor(F.col("_quota") / F.col("_words"))
    last = F.col("_quota") - rounds * F.col("_words") - F.col("_start")
    part = F.greatest(F.lit(0), F.least(F.col("size"), last))
    taken = F.coalesce(rounds * F.col("size") + part, F.lit(0)).cast("long")
    return rows.select("doc_id", "key", "size", "source_size", "target", taken.alias("taken"))


def remixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``docs``, each row as often as the mix takes it, in whole documents.

    That is the words taken over its size, rounded; rows without words are not taken.
    Rows that repeat share what is taken of them all.
    """
    shares = mixed(docs, mix).where("size > 0").groupBy("key")
    shares = shares.agg(F.count("*").alias("_rows"), F.sum(F.round(F.col("taken") / F.col("size"))).alias("_times"))
    shares = settled(shares.select(F.col("key").alias("_key"), "_rows", F.col("_times").cast("long").alias("_times")), "shares")
    key = row_key(F.col("doc_id"), F.col("source"), text=F.col("text"))
    rows = docs.select(whole(docs), key.alias("_key"))
    rows = rows.join(shares.where("_times > 0"), "_key")
    place = F.row_number().over(Window.partitionBy("_key").orderBy("_rows"))
    times = F.floor(F.col("_times") / F.col("_rows")) + (place <= F.col("_times") % F.col("_rows")).cast("long")
    rows = rows.withColumn("_copies", times).where("_copies > 0")
    return rows.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))).select("doc.*")
