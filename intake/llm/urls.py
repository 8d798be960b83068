"""URL filters: host rules, and exact membership in a list by a cascade of Bloom filters.

The cascade is made for a closed universe, every key that will be asked. Level 0 holds
the listed keys, level 1 those others that level 0 lets through, level 2 the listed keys
that level 1 lets through, and so on until nobody is let through wrongly. Asking goes down
the levels until one says no; the answer is exact for every key of the universe.

Keys are dealt by hash to shards of bounded size, each with a cascade of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intake.llm.common import ascii_lower, settled


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.

    Null or without ``://``: empty.
    """
    return ascii_lower(F.coalesce(F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end; empty as the host is."""
    return F.coalesce(F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and paths that start like this one."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    def fits(self, at_host: Column, at_path: Column) -> Column:
        own = (at_host == self.host) | at_host.endswith(f".{self.host}")
        return own & at_path.startswith(self.path)


def longest_rule(rules: Iterable[Rule], at_host: Column, at_path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = rule.fits(at_host, at_path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


@dataclass(frozen=True)
class Cascade:
    """``bits`` per key of a level, ``hashes`` of a key, keys to a shard (about).

    Filters of up to ``broadcast`` bytes, measured, travel to the tasks; larger ones stay
    in their shards and the keys go there.
    """

    bits: int = 8
    hashes: int = 5
    shard: int = 1 << 17
    broadcast: int = 64 << 20


LEVELS = "shard int, level int, bits binary"


def _places(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, size: int) -> np.ndarray:
    """Bit places of keys, a row for each hash, other ones on each level."""
    a = h1 + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
    b = (h2 ^ (h2 >> np.uint64(29))) * np.uint64(2 * level + 0x2545F4914F6CDD1D) | np.uint64(1)
    i = np.arange(hashes, dtype=np.uint64)[:, None]
    mixed = a + i * b
    mixed ^= mixed >> np.uint64(31)
    return (mixed * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)) % np.uint64(size)


def _holds(bits: np.ndarray, h1: np.ndarray, h2: np.ndarray, level: int, hashes: int) -> np.ndarray:
    at = _places(h1, h2, level, hashes, len(bits) * 8)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def shard_levels(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray, how: Cascade) -> list[bytes]:
    """The filters of one shard. Keys with both hashes equal must agree in ``listed``."""
    levels: list[bytes] = []
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    while len(inside):
        if len(levels) > 500:
            raise ValueError("a listed and another key have the same hashes")
        bits = np.zeros(max(8, -(-len(inside) * how.bits // 8)), np.uint8)
        at = _places(h1[inside], h2[inside], len(levels), how.hashes, len(bits) * 8).ravel()
        np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        through = outside[_holds(bits, h1[outside], h2[outside], len(levels), how.hashes)]
        levels.append(bits.tobytes())
        inside, outside = through, inside
    return levels


def ask(levels: list[np.ndarray], h1: np.ndarray, h2: np.ndarray, how: Cascade) -> np.ndarray:
    """Whether keys of the universe are listed: the first level that says no decides."""
    answer = np.zeros(len(h1), bool)
    open_ = np.arange(len(h1))
    for level, bits in enumerate(levels):
        through = _holds(bits, h1[open_], h2[open_], level, how.hashes)
        answer[open_[~through]] = level % 2 == 1
        open_ = open_[through]
    answer[open_] = len(levels) % 2 == 1
    return answer


def _hashed(keys: DataFrame, key: Column, shards: int) -> DataFrame:
    """``keys`` with two hashes and a shard, of a key that is never null."""
    # The first argument seeds the hash of the second, so these are independent.
    two = keys.withColumn("h1", F.xxhash64(F.lit(1), key)).withColumn("h2", F.xxhash64(F.lit(2), key))
    return two.withColumn("shard", F.pmod(F.xxhash64(F.lit(3), key), F.lit(shards)).cast("int"))


def build(universe: DataFrame, how: Cascade = Cascade()) -> tuple[DataFrame, int]:
    """The filters of (key, listed) rows and the number of their shards.

    A key counts once, and is listed if any of its rows is. Null keys are left out.
    Shards get their keys by hash, so none is much larger than the others.
    """
    keys = universe.where("key is not null").groupBy("key").agg(F.coalesce(F.bool_or("listed"), F.lit(False)).alias("listed"))
    keys = settled(keys, "universe")
    shards = max(1, -(-keys.count() // how.shard))

    def levels(pdf: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (pdf[h].to_numpy(np.int64).view(np.uint64) for h in ("h1", "h2"))
        made = shard_levels(h1, h2, pdf["listed"].to_numpy(bool), how)
        return pd.DataFrame({"shard": pdf["shard"].iloc[0], "level": range(len(made)), "bits": made})

    hashed = _hashed(keys, F.col("key"), shards).select("shard", "h1", "h2", "listed")
    return settled(hashed.groupBy("shard").applyInPandas(levels, LEVELS), "cascade"), shards


def is_listed(rows: DataFrame, key: str, filters: DataFrame, shards: int, how: Cascade = Cascade()) -> DataFrame:
    """``rows`` with a boolean ``listed``; null keys are not listed."""
    size = filters.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
    known = F.coalesce(F.col(key), F.lit(""))
    if size <= how.broadcast:
        by_shard: dict[int, list[np.ndarray]] = {}
        for shard, _, bits in sorted(filters.collect()):
            by_shard.setdefault(shard, []).append(np.frombuffer(bits, np.uint8))
        sent = filters.sparkSession.sparkContext.broadcast(by_shard)

        @F.pandas_udf("boolean")
        def listed(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for h1, h2, shard in batches:
                out = np.zeros(len(h1), bool)
                a, b = (h.to_numpy(np.int64).view(np.uint64) for h in (h1, h2))
                for s in np.unique(shard):
                    at = np.flatnonzero(shard.to_numpy() == s)
                    out[at] = ask(sent.value.get(s, []), a[at], b[at], how)
                yield pd.Series(out)

        asked = _hashed(rows, known, shards)
        asked = asked.withColumn("listed", listed("h1", "h2", "shard") & F.col(key).isNotNull())
        return asked.drop("h1", "h2", "shard")
    # Too large to send: the distinct keys go to their shards and come back with the answer.
    keys = _hashed(rows.select(F.col(key).alias("key")).where("key is not null").distinct(), F.col("key"), shards)

    def answered(pdf: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        levels = [np.frombuffer(b, np.uint8) for b in bits.sort_values("level")["bits"]]
        h1, h2 = (pdf[h].to_numpy(np.int64).view(np.uint64) for h in ("h1", "h2"))
        return pd.DataFrame({"_key": pdf["key"], "listed": ask(levels, h1, h2, how)})

    found = keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(answered, "_key string, listed boolean")
    return rows.join(found, F.col(key) == F.col("_key"), "left").drop("_key").withColumn("listed", F.coalesce("listed", F.lit(False)))


def judged(pages: DataFrame, rules: Iterable[Rule], listed: Column, how: Cascade = Cascade()) -> DataFrame:
    """page_id, host, path, rule, verdict of each row (page_id, url, ...) of ``pages``.

    The longest rule that fits decides. Otherwise a url is blocked if its key (host and path) is listed: if
    ``listed`` holds for any page of that key. A null url, or one without ``://``, has
    no key and is allowed unless a rule fits its empty host. Rows that repeat are judged alike.
    """
    at = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), listed.alias("listed"))
    at = at.withColumn("key", F.when(F.col("host") != "", F.concat("host", "path")))
    at = settled(at, "urls")
    filters, shards = build(at.select("key", "listed"), how)
    name, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    asked = is_listed(at.drop("listed"), "key", filters, shards, how)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return asked.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"))

