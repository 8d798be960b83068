"""Exact Jaccard join of shingle sets by prefixes under several global token orders.

Two sets that are similar enough share a token among the first few of each, whatever order
all tokens stand in. So a pair is a candidate only if its prefixes meet under *every* one of
several orders. The orders put widespread tokens last (by a counting sketch over all
documents, a fixed number of counters) and are seeded hashes otherwise.

Single tokens make poor lists: the more texts there are, the more of them stand in several by chance,
in any order. So sets of about one size are cut by the value of their tokens into more parts than two
linked ones can differ in, and the index has a list for the whole content of each part; sets that link
have one alike. Sets alone in their lists, or without a partner whose size and parity bits allow a
link, are done. For the others, the prefixes under all orders and the sets themselves are stored, and
a pair must meet under every order before its sets are intersected.

Equal sets are one class throughout, and no pairs within a list are written out: each class is
first compared with one other of a list or two, lists that are left in one component are then
done, the others are compared with one class of each list, and only what remains in several
components even so is compared in full, between components.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from intake.llm.common import components, settled

_BITS = 1024
_PARITY = tuple(f"p{k}" for k in range(_BITS // 64))
_FOLDED = tuple(f"f{k}" for k in range(4))
_CHUNK = 4096
_HELD = 1 << 16
_KEYS = 1 << 25
_CUT = re.compile(rb"[\x20\x09-\x0D]")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@dataclass(frozen=True)
class Jaccard:
    """Sets of ``words``-word shingles; links from ``percent`` per cent of the union on.

    ``orders`` global orders are used. ``counters`` (a power of two) counts
    how widespread tokens are, in 8 bytes each. ``hubs`` rounds compare each class with a single one
    of a list, and as many more with one of each list left, before the rest is compared in full.
    """

    words: int = 3
    percent: int = 90
    orders: int = 3
    counters: int = 1 << 20
    hubs: int = 2
    seed: int = 42

    def prefix(self, size: int) -> int:
        """How many first tokens of a set meet those of any similar one."""
        return size - -(-self.percent * size // 100) + 1 if size else 0

    def bands(self) -> list[tuple[int, int, int]]:
        """Bands of sizes: the least size, the number of parts, and how many may be empty in a set.

        Linked sets are of one band or of two that follow each other. Parts are one and the empty ones more
        than the tokens by which two linked sets of the band differ, so that a part with tokens is alike in both
        if either has no more empty ones than that. No parts where linked sets are equal.
        """
        found, low = [], 1
        while low < 1 << 40 and self.percent < 100:
            after = max(low + 1, -(-low * 100**3 // self.percent**3))
            differ = (100 - self.percent) * 2 * (after - 1) // (100 + self.percent)
            # As many as random values leave empty in the smallest sets, and three deviations.
            empty = (differ + 1) * math.exp(-low * self.percent / 100 / (differ + 1))
            spare = int(empty + 3 * math.sqrt(empty))
            found.append((low, differ + 1 + spare if differ else 0, spare))
            low = after
        return found


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX[0]
    values = (values ^ (values >> np.uint64(29))) * _MIX[1]
    return values ^ (values >> np.uint64(32))


# A number for each byte, none for the blanks (space, tab to carriage return).
_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
_BYTE = np.where(_BLANK, np.uint64(0), np.array([xxhash.xxh64_intdigest(bytes([b]), 1) | 1 for b in range(256)], np.uint64))
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start, and their hashes: polynomials of their bytes, mixed."""
    data = np.frombuffer(text, np.uint8)
    word = ~_BLANK[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    place = (np.arange(len(data)) - starts[np.maximum(np.cumsum(first) - 1, 0)]) * word
    powers = np.full(int(place.max()) + 1, _BASE)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    return starts, _mixed(np.add.reduceat(_BYTE[data] * powers[place], starts))


def _pieces(text: bytes, size: int) -> Iterator[bytes]:
    """A text in pieces of at least ``size`` bytes, cut at blanks."""
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def shingle_sets(texts: pa.Array, how: Jaccard) -> Iterator[np.ndarray]:
    """For each text the 64-bit tokens of its distinct shingles, ascending; none without words.

    A-Z count as a-z; fewer words than a shingle has are one shingle. Short texts are hashed
    together, long ones piece by piece.
    """

    def one(each: np.ndarray) -> np.ndarray:
        width = min(how.words, len(each))
        n = len(each) - width + 1 if width else 0
        tokens = np.full(n, width, np.uint64)
        for k in range(width):
            tokens *= _MIX[2]
            tokens += each[k : k + n]
        tokens = _mixed(tokens)
        tokens.sort()
        return tokens[np.concatenate(([True], tokens[1:] != tokens[:-1]))] if n else tokens

    def together(held: list[bytes]) -> Iterator[np.ndarray]:
        # bytes.lower knows A-Z only.
        starts, hashes = _word_hashes(b"\n".join(held).lower())
        ends = np.cumsum([len(t) + 1 for t in held])
        cuts = [0, *np.searchsorted(starts, ends)]
        yield from (one(hashes[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))

    held, size = [], 0
    for text in texts:
        now = text.as_py() or b""
        if size + len(now) > _HELD and held:
            yield from together(held)
            held, size = [], 0
        if len(now) > _HELD:
            yield one(np.concatenate([_word_hashes(part.lower())[1] for part in _pieces(now, _HELD)]))
        else:
            held.append(now)
            size += len(now)
    if held:
        yield from together(held)


def _class_of(tokens: np.ndarray, how: Jaccard) -> int:
    """A set's number: equal for equal sets; 0 for the empty one."""
    return xxhash.xxh64_intdigest(tokens.tobytes(), how.seed) if len(tokens) else 0


def _parity(tokens: np.ndarray, bits: int = _BITS) -> np.ndarray:
    """The parity of the tokens of each of ``bits`` places: at least as many tokens of two sets differ as bits do."""
    place = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8), bitorder="little").view("<i8")


def _more_parity(tokens: np.ndarray) -> np.ndarray | None:
    """More such bits for a large set, whose many tokens would fill the first ones: 1 to 4 for each token."""
    bits = _BITS
    while bits < len(tokens):
        bits *= 4
    return _parity(tokens, bits) if bits > _BITS else None


def _ordered(tokens: np.ndarray, how: Jaccard, levels: np.ndarray, order: int) -> np.ndarray:
    """The set's prefix under one order: level first, then that order's hash, then the token."""
    n = how.prefix(len(tokens))
    level = levels[(tokens >> np.uint64(64 - how.counters.bit_length() + 1)).astype(np.int64)]
    rank = (_mixed(tokens + np.uint64(order + 1) * _MIX[2]) >> np.uint64(8)) | (level << np.uint64(56))
    return tokens[np.argsort(rank, kind="stable")[:n]]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _text_key() -> Column:
    return F.xxhash64("text")


def _scanned(docs: DataFrame, how: Jaccard) -> DataFrame:
    """doc_id, text_key, class, n and parity of each row; and rows of counters (``chunk`` not null)."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - how.counters.bit_length() + 1)
        counts = np.zeros(how.counters, np.int64)
        waiting, n_waiting = [], 0
        names = ["doc_id", "text_key", "class", "n", *_PARITY, "more", "chunk", "counts"]
        for part in parts:
            classes, sizes, parity, more = [], [], [], []
            for tokens in shingle_sets(part.column(2), how):
                classes.append(_class_of(tokens, how))
                sizes.append(len(tokens))
                parity.append(_parity(tokens))
                more.append(_more_parity(tokens))
                waiting.append((tokens >> shift).astype(np.int64))
                n_waiting += len(tokens)
                if n_waiting >= how.counters:
                    counts += np.bincount(np.concatenate(waiting), minlength=how.counters)
                    waiting, n_waiting = [], 0
            bits = np.array(parity, np.int64).reshape(-1, len(_PARITY))
            rows = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array(np.array(classes, np.uint64).view(np.int64)),
                    pa.array(np.array(sizes, np.int64)), *[pa.array(np.ascontiguousarray(bits[:, k])) for k in range(len(_PARITY))],
                    pa.array(more, pa.list_(pa.int64())), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                ],
                names=names,
            )
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=how.counters)
        chunks = counts.reshape(-1, min(_CHUNK, how.counters))
        used = np.flatnonzero(chunks.any(axis=1))
        if len(used):
            n = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64())] * (4 + len(_PARITY))
                + [pa.nulls(n, pa.list_(pa.int64())), pa.array(used.astype(np.int32)), pa.array([chunks[k].astype("<i8").tobytes() for k in used], pa.binary())],
                names=names,
            )

    longs = ", ".join(f"{c} long" for c in _PARITY)
    return docs.select("doc_id", _text_key().alias("text_key"), F.col("text").cast("binary")).mapInArrow(
        batches, f"doc_id long, text_key long, class long, n long, {longs}, more array<long>, chunk int, counts binary"
    )


def _levels(scanned: DataFrame, how: Jaccard) -> np.ndarray:
    """How widespread each counter's tokens are: 0 up to four times the mean, then by powers of two.

    Counters are added up by streams of their rows, each chunk in one task; the driver gets 8 bytes a
    counter, however many documents there are.
    """
    width = min(_CHUNK, how.counters)

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for part in parts:
            for chunk, counts in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                now = np.frombuffer(counts.as_py(), "<i8")
                totals[chunk] = totals[chunk] + now if chunk in totals else now
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
            names=["chunk", "counts"],
        )

    sums = scanned.where("chunk is not null").select("chunk", "counts").repartition("chunk")
    counts = np.zeros(how.counters, np.int64)
    for row in sums.mapInArrow(summed, "chunk int, counts binary").collect():
        counts[row.chunk * width : (row.chunk + 1) * width] = np.frombuffer(row.counts, "<i8")
    ratio = counts / (4 * max(1.0, counts.mean()))
    return np.floor(np.log2(np.maximum(ratio, 1))).astype(np.uint8)


def _salted(values: np.ndarray, salt: int) -> np.ndarray:
    return _mixed(values + np.uint64(salt * int(_MIX[2]) % (1 << 64)))


def _lists(tokens: np.ndarray, how: Jaccard, levels: np.ndarray, bands: list[tuple[int, int, int]]) -> np.ndarray:
    """The lists a set stands in: one for each part with tokens, in its band and in the next if links reach it.

    Where more parts are empty than the band allows, its prefix under the first order stands in for those.
    """
    n, found = len(tokens), [tokens[:0]]
    own = bisect_right(bands, n, key=lambda band: band[0]) - 1
    for k, (low, parts, spare) in enumerate(bands[own : own + 2], own):
        if not parts or 100 * n < how.percent * low:
            continue
        place = ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        heads = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        found.append(_salted(np.add.reduceat(tokens, heads), 2 * k + 1))
        if parts - len(heads) > spare:
            found.append(_salted(_ordered(tokens, how, levels, 0), 2 * k + 2))
    return np.concatenate(found)


def _index(docs: DataFrame, how: Jaccard, levels) -> DataFrame:
    """token, class of each document's lists; copies in one task at most once."""
    bands = how.bands()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = levels.value.astype(np.uint64)
        seen: set[int] = set()
        for part in parts:
            lists, classes = [], []
            for tokens in shingle_sets(part.column(0), how):
                number = _class_of(tokens, how)
                if len(tokens) and number not in seen:
                    if len(seen) >= 1 << 18:
                        seen.clear()
                    seen.add(number)
                    lists.append(_lists(tokens, how, high, bands))
                    classes.append(number)
            if lists:
                numbers = np.repeat(np.array(classes, np.uint64), [len(each) for each in lists]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(lists).view(np.int64)), pa.array(numbers)], names=["token", "class"])

    return docs.select(F.col("text").cast("binary")).mapInArrow(batches, "token long, class long")


def _wanted(chosen: DataFrame) -> np.ndarray:
    """Bits by text key, set for those of the chosen classes: 4 MB however many there are."""
    place = (F.col("text_key").bitwiseAND(F.lit(_KEYS - 1)) + 1).alias("place")
    chunk, bit = F.bitmap_bucket_number("place"), F.bitmap_bit_position("place")
    found = chosen.select(place).groupBy((chunk - 1).alias("chunk")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    bits = np.zeros((_KEYS >> 15, 1 << 12), np.uint8)
    for row in found.collect():
        bits[row.chunk] = np.frombuffer(row.bits, np.uint8)
    return bits.reshape(-1)


def _sets(docs: DataFrame, chosen: DataFrame, how: Jaccard, levels) -> DataFrame:
    """class, tokens (ascending) and the prefixes o0, o1 ... under the orders, of the chosen classes.

    Texts whose key has no bit are left where they are; the few others with one go by their class.
    """
    orders = range(how.orders)
    wanted = docs.sparkSession.sparkContext.broadcast(_wanted(chosen))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, bits = levels.value.astype(np.uint64), wanted.value
        seen: set[int] = set()
        for part in parts:
            keys = part.column(0).to_numpy() & (_KEYS - 1)
            rows: dict[int, list[np.ndarray]] = {}
            for tokens in shingle_sets(part.column(1).filter(pa.array((bits[keys >> 3] >> (keys & 7) & 1).astype(bool))), how):
                number = _class_of(tokens, how)
                if number not in seen:
                    if len(seen) >= 1 << 18:
                        seen.clear()
                    seen.add(number)
                    rows[number] = [tokens, *[_ordered(tokens, how, high, k) for k in orders]]
            columns = zip(*rows.values(), strict=True) if rows else [()] * (how.orders + 1)
            lists = [pa.array([a.view(np.int64) for a in c], pa.list_(pa.int64())) for c in columns]
            numbers = pa.array(np.array(list(rows), np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([numbers, *lists], names=["class", "tokens", *[f"o{k}" for k in orders]])

    schema = "class long, tokens array<long>" + "".join(f", o{k} array<long>" for k in orders)
    found = docs.select(_text_key().alias("text_key"), F.col("text").cast("binary")).mapInArrow(batches, schema)
    found = found.join(chosen.select("class"), "class", "left_semi")
    columns = ["tokens", *[f"o{k}" for k in orders]]
    return found.groupBy("class").agg(*[F.first(c).alias(c) for c in columns])


def _alike(a: str, b: str, how: Jaccard) -> Column:
    """Whether the sizes of two sets leave a link possible."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    return 100 * F.least(n, m) >= how.percent * F.greatest(n, m)


def _near(a: str, b: str, how: Jaccard, parity: tuple[str, ...], more: bool = False) -> Column:
    """Whether the parity bits of two sets leave a link possible: few tokens are in one set only."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")

    def few(differ: Column) -> Column:
        # |a & b| >= p (n + m) / (100 + p), so that the others are at most (100 - p) (n + m) / (100 + p).
        return (100 + how.percent) * differ <= (100 - how.percent) * (n + m)

    near = few(reduce(add, [F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in parity]))
    if not more:
        return near
    x, y = F.col(f"{a}.more"), F.col(f"{b}.more")
    bits = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, c: s + c)
    return near & F.when(F.size(x) == F.size(y), few(bits)).otherwise(F.lit(True))


def _with_partner(lists: DataFrame, possible) -> DataFrame:
    """The rows of the lists that have another class, ``possible`` together, in their list."""
    a, b = lists.alias("a"), lists.alias("b")
    met = (F.col("a.token") == F.col("b.token")) & (F.col("a.class") != F.col("b.class")) & possible("a", "b")
    return a.join(b, met, "left_semi")


def _beside(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """The pairs (a, b, ra, rb) with the rows of ``table`` of both classes as ``x`` and ``y``.

    Pairs go to the table, as a broadcast where Spark finds them small; then only rows of
    classes in pairs move.
    """
    columns = F.struct(*[c for c in table.columns if c != "class"])
    first = table.select(F.col("class").alias("a"), columns.alias("x")).join(pairs, "a")
    second = table.select(F.col("class").alias("b"), columns.alias("y")).join(pairs.select("b"), "b", "left_semi")
    return first.join(second, "b")


def _verified(pairs: DataFrame, marks: DataFrame, sets: DataFrame, how: Jaccard) -> DataFrame:
    """Of the pairs (a, b, ra, rb) those that are links.

    Parity bits first, then prefixes must meet under every order, then the sets are intersected.
    """
    near = _beside(pairs, marks).where(_near("x", "y", how, _PARITY, more=True)).select("a", "b", "ra", "rb")
    held = _beside(settled(near, "pairs"), sets)
    for k in range(how.orders):
        held = held.where(F.arrays_overlap(f"x.o{k}", f"y.o{k}"))
    common = F.size(F.array_intersect("x.tokens", "y.tokens"))
    union = F.size("x.tokens") + F.size("y.tokens") - common
    return held.where(100 * common >= how.percent * union).select("ra", "rb")


def _merged(parts: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Components (node, root) after ``links`` (u, v) between roots, from those before."""
    if links.isEmpty():
        return parts
    new = settled(components(links.distinct()), "components")
    if parts is None:
        return new
    moved = new.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    every = parts.unionByName(new.select("node", F.col("node").alias("root")).join(parts, "node", "left_anti"))
    return settled(every.join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root")), "components")


def _linked(filed: DataFrame, marks: DataFrame, sets: DataFrame, how: Jaccard) -> DataFrame | None:
    """Components (node, root) of the classes, from the lists (token, class, n, folded parity)."""

    def rooted(rows: DataFrame, parts: DataFrame | None) -> DataFrame:
        if parts is None:
            return rows.withColumn("root", F.col("class"))
        named = parts.select(F.col("node").alias("class"), F.col("root").alias("_r"))
        return rows.join(named, "class", "left").withColumn("root", F.coalesce("_r", "class")).drop("_r")

    def links(a: DataFrame, b: DataFrame, met: Column) -> DataFrame:
        a, b = a.alias("a"), b.alias("b")
        met = (F.col("a.token") == F.col("b.token")) & met & _alike("a", "b", how) & _near("a", "b", how, _FOLDED)
        ends = [F.col(f"{e}.{c}").alias(n) for e, c, n in (("a", "class", "a"), ("b", "class", "b"), ("a", "root", "ra"), ("b", "root", "rb"))]
        pairs = settled(a.join(b, met).select(*ends).distinct(), "pairs")
        found = settled(_verified(pairs, marks, sets, how), "links")
        return found.select(F.col("ra").alias("u"), F.col("rb").alias("v"))

    def several(lists: DataFrame, parts: DataFrame | None) -> DataFrame:
        """The lists that are left in several components."""
        lists = settled(rooted(lists.select(*filed.columns), parts), "lists")
        left = lists.groupBy("token").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low < _high")
        return settled(lists.join(left.select("token"), "token"), "lists")

    def to_hubs(rows: DataFrame, turn: int) -> DataFrame:
        hub = F.struct(F.xxhash64("class", F.lit(turn)), "token", "class", "n", "root", *_FOLDED)
        hubs = rows.groupBy("token").agg(F.min(hub).alias("hub")).select("hub.*")
        return links(rows, hubs, F.col("a.root") != F.col("b.root"))

    parts = None
    row = F.struct("token", "class", "n", *_FOLDED)
    for turn in range(how.hubs):
        # One list of each class, and of each list one class that all others are compared with.
        one = filed.groupBy("class").agg((F.min(row) if turn % 2 == 0 else F.max(row)).alias("r")).select("r.*")
        parts = _merged(parts, to_hubs(settled(rooted(one, parts), "lists"), turn))
    lists = several(filed, parts)
    for turn in range(how.hubs, 2 * how.hubs):
        # All lists that are left, in the same way.
        if lists.isEmpty():
            return parts
        parts = _merged(parts, to_hubs(lists, turn))
        lists = several(lists, parts)
    return _merged(parts, links(lists, lists, (F.col("a.root") < F.col("b.root"))))


def jaccard_links(docs: DataFrame, how: Jaccard = Jaccard()) -> DataFrame:
    """doc_id, n_shingles (distinct ones), component_id of each row of ``docs``.

    Rows link if ``100 * intersection >= percent * union`` of their shingle sets; component_id is the
    smallest doc_id that links reach, the row's own included. Rows without words link to nothing and
    keep their own id. Rows that repeat link to each other; a null doc_id is never the
    smallest, and a component of nulls only has a null id. Reads doc_id and text, whole texts.
    No documents, no rows. Tokens and classes are 64-bit hashes; two different sets found under one
    class raise (another ``seed`` helps).
    """
    spark: SparkSession = docs.sparkSession
    texts = _texts(docs)
    scanned = settled(_scanned(texts, how), "scanned")
    rows = scanned.where("chunk is null").drop("chunk", "counts")
    levels = spark.sparkContext.broadcast(_levels(scanned, how))
    mark = F.struct("n", *_PARITY, "more")
    classes = rows.where("n > 0").groupBy("class").agg(
        F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"), F.min(mark).alias("mark"), F.max(mark).alias("_other")
    )
    clash = F.raise_error(F.lit("two shingle sets have one hash: choose another seed"))
    step = len(_PARITY) // len(_FOLDED)
    folded = [reduce(Column.bitwiseXOR, [F.col(p) for p in _PARITY[k * step : (k + 1) * step]]).alias(f) for k, f in enumerate(_FOLDED)]
    checked = F.when(F.col("mark") != F.col("_other"), clash).otherwise(F.col("mark")).alias("mark")
    classes = classes.select("class", "least", "text_key", checked).select("class", "least", "text_key", "mark.*")
    classes = settled(classes.select("*", *folded), "classes")
    # Lists are cut down to classes with a partner, then with one by size and parity bits.
    index = _index(texts, how, levels).repartition("token").distinct()
    filed = settled(_with_partner(index, lambda a, b: F.lit(True)), "lists")
    marked = filed.join(classes.select("class", "n", *_FOLDED), "class")
    near = lambda a, b: _alike(a, b, how) & _near(a, b, how, _FOLDED)
    filed = settled(_with_partner(marked, near), "lists")
    chosen = classes.drop("least").join(filed.select("class").distinct(), "class", "left_semi")
    chosen = settled(chosen, "classes")
    sets = settled(_sets(texts, chosen, how, levels), "sets")
    parts = _linked(filed, chosen.drop("text_key"), sets, how)
    roots = classes.select("class", F.col("class").alias("root"), "least")
    if parts is not None:
        roots = classes.join(parts, F.col("class") == F.col("node"), "left").select(
            "class", F.coalesce("root", "class").alias("root"), "least"
        )
    ids = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settled(roots.join(ids, "root").select(F.col("class").alias("_c"), "component_id"), "components")
    out = rows.where("n > 0").join(named, F.col("class") == F.col("_c")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(alone)
