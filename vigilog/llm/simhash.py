"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint has 64 bits; its first 46 are two words of 23 bits. The anchors are the pairs
of words of the perfect binary code of length 23, whose balls of radius 3 cover every
word exactly once: 2 ** 24 anchors, found from a word by its syndrome.

Fingerprints x and y at most t bits apart have a midpoint z with at most floor(t / 2) bits to
x and ceil(t / 2) to y. The anchor that covers z is, word by word, within radius 3 plus
these bits of x and of y. So every fingerprint is copied to all anchors whose distance
beyond the covering radius, added over both words, is at most ceil(t / 2), and each anchor
compares what it got: no link is missed. (Copying one side to radius plus t and the other
side to its own anchor finds the same links with five times the copies at t = 3.)

An anchor with more than CELL_ROWS fingerprints is not compared pair by pair. Its
fingerprints are linked exactly through their common midpoints instead, with work in
proportion to their number.

Nulls: a null text has no word, and its fingerprint is 0; a null id is no component's smallest unless there is no
other. Empty texts have fingerprint 0 as well; very long ones are hashed whole, one at a time. Ties: a bit set in exactly half of
the hashes is 0; of rows with a component's smallest id the one of the lowest row hash is kept. Repeated rows share a
fingerprint, and one of them is kept. An empty table gives no row. Columns carried along keep their names; the
added ones win.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vigilog.llm import common
from vigilog.llm.components import connected
from vigilog.operators.joins import join_least
from vigilog.sources.lake import materialise, scratch_path

BITS = 64
THRESHOLD = 3
SHINGLE = 3
SEED = 42
# Fixed values of the code: word length, bits of a check value, covering radius, and the
# generator x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
WORD_BITS, CHECK_BITS, RADIUS = 23, 11, 3
GENERATOR = 0b101011100011
CELL_ROWS = 2048
# Pairs compared in one numpy step.
STEP_PAIRS = 4_000_000

FINGERPRINT = StructType([StructField("fingerprint_bits", LongType(), False)])


def fingerprint(text: str) -> int:
    """64 bits, each set where more than half of the shingle hashes set it; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
        count = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
        count = len(words) - SHINGLE + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=count)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, count, 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``fingerprint_bits`` to every row; a null text counts as empty (0)."""

    def compute(values: dict[str, list]) -> list[pa.Array]:
        return [pa.array([fingerprint(t or "") for t in values[text]], pa.int64())]

    return common.add_columns(docs, [text], FINGERPRINT, compute, keep)


class Code:
    """Error patterns of the code by check value and cost, the bits beyond the radius."""

    def __init__(self, reach: int):
        columns = []
        for place in range(WORD_BITS):
            value = 1 << place
            for top in range(WORD_BITS - 1, CHECK_BITS - 1, -1):
                if value >> top & 1:
                    value ^= GENERATOR << (top - CHECK_BITS)
            columns.append(value)
        half = WORD_BITS // 2
        self.half = half
        self.low = self._sums(columns[:half])
        self.high = self._sums(columns[half:])
        checks, patterns, costs = [], [], []
        for weight in range(RADIUS + reach + 1):
            for places in combinations(range(WORD_BITS), weight):
                check = pattern = 0
                for p in places:
                    check ^= columns[p]
                    pattern |= 1 << p
                checks.append(check)
                patterns.append(pattern)
                costs.append(max(0, weight - RADIUS))
        checks, patterns, costs = (np.array(x, dtype=np.int64) for x in (checks, patterns, costs))
        self.patterns, self.starts, self.sizes = [], [], []
        for cost in range(reach + 1):
            mine = np.flatnonzero(costs == cost)
            mine = mine[np.argsort(checks[mine], kind="stable")]
            sizes = np.bincount(checks[mine], minlength=1 << CHECK_BITS)
            self.patterns.append(patterns[mine])
            self.sizes.append(sizes)
            self.starts.append(np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])[:-1])

    @staticmethod
    def _sums(columns: list[int]) -> np.ndarray:
        table = np.zeros(1 << len(columns), dtype=np.int64)
        for i, column in enumerate(columns):
            table[1 << i : 2 << i] = table[: 1 << i] ^ column
        return table

    def check(self, words: np.ndarray) -> np.ndarray:
        return self.low[words & ((1 << self.half) - 1)] ^ self.high[words >> self.half]


@lru_cache(maxsize=2)
def code(reach: int) -> Code:
    return Code(reach)


def anchors(prints: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Every anchor of every fingerprint: the fingerprint's index and the anchor's number.

    A code word is told by its upper 12 bits, since the code is cyclic.
    """
    own = code(reach)
    bits = prints.view(np.uint64)
    mask = np.uint64((1 << WORD_BITS) - 1)
    first = (bits & mask).astype(np.int64)
    second = (bits >> np.uint64(WORD_BITS) & mask).astype(np.int64)
    check1, check2 = own.check(first), own.check(second)
    owners, numbers = [], []
    for cost1 in range(reach + 1):
        for cost2 in range(reach + 1 - cost1):
            size1, size2 = own.sizes[cost1][check1], own.sizes[cost2][check2]
            size = size1 * size2
            owner = np.repeat(np.arange(len(prints)), size)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            width = size2[owner]
            word1 = first[owner] ^ own.patterns[cost1][own.starts[cost1][check1[owner]] + place // np.maximum(width, 1)]
            word2 = second[owner] ^ own.patterns[cost2][own.starts[cost2][check2[owner]] + place % np.maximum(width, 1)]
            owners.append(owner)
            numbers.append((word1 >> CHECK_BITS) << (WORD_BITS - CHECK_BITS) | word2 >> CHECK_BITS)
    return np.concatenate(owners), np.concatenate(numbers)


def forest(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``count`` items through given pairs."""
    root = np.arange(count)
    while len(left):
        low, high = np.minimum(root[left], root[right]), np.maximum(root[left], root[right])
        apart = low != high
        if not apart.any():
            break
        left, right = left[apart], right[apart]
        np.minimum.at(root, high[apart], low[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _close_in_runs(keys: np.ndarray, prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Within runs of equal keys, each fingerprint that has a close one, and its root."""
    left, right = [], []
    alive, step = np.arange(len(keys)), 1
    while True:
        alive = alive[alive + step < len(keys)]
        alive = alive[keys[alive] == keys[alive + step]]
        if not len(alive):
            break
        near = np.bitwise_count(prints[alive] ^ prints[alive + step]) <= threshold
        left.append(alive[near])
        right.append(alive[near] + step)
        step += 1
    if not left:
        return prints[:0], prints[:0]
    root = forest(len(keys), np.concatenate(left), np.concatenate(right))
    moved = root != np.arange(len(keys))
    return prints[moved], prints[root[moved]]


def _compare(batches: Iterator[pa.RecordBatch], threshold: int, most: int) -> Iterator[pa.RecordBatch]:
    """Links within anchors, from rows sorted by anchor; a run may span batches.

    Rows of an anchor with more than ``most`` rows come back with a null right end.
    """
    held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    crowded = None

    def links(left: np.ndarray, right: np.ndarray | None) -> pa.RecordBatch:
        ends = pa.nulls(len(left), pa.int64()) if right is None else pa.array(right.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), ends], names=["left", "right"])

    def settle(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        over = np.repeat(sizes > most, sizes)
        if over.any():
            yield links(prints[over], None)
        several = np.repeat((sizes > 1) & (sizes <= most), sizes)
        keys, prints, sizes = keys[several], prints[several], sizes[(sizes > 1) & (sizes <= most)]
        parts = np.cumsum(sizes.astype(np.int64) ** 2) // STEP_PAIRS
        ends = np.cumsum(sizes)
        start = 0
        for part in np.unique(parts):
            end = int(ends[np.flatnonzero(parts == part)[-1]])
            left, right = _close_in_runs(keys[start:end], prints[start:end], threshold)
            if len(left):
                yield links(left, right)
            start = end

    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        prints = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        if crowded is not None:
            more = keys == crowded
            if more.any():
                yield links(prints[more], None)
                keys, prints = keys[~more], prints[~more]
        if not len(keys):
            continue
        keys, prints = np.concatenate([held_key, keys]), np.concatenate([held, prints])
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        yield from settle(keys[:cut], prints[:cut])
        held_key, held, crowded = keys[cut:], prints[cut:], None
        if len(held) > most:
            yield links(held, None)
            crowded, held_key, held = int(held_key[0]), held_key[:0], held[:0]
    yield from settle(held_key, held)


def _midpoints(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, point and distance of all points at most ``bits`` flips from fingerprints."""
    masks = [(0, 0)]
    for weight in range(1, bits + 1):
        masks += [(sum(1 << p for p in places), weight) for places in combinations(range(BITS), weight)]
    flips = np.array([m for m, _ in masks], dtype=np.uint64)
    points = prints[:, None] ^ flips[None, :]
    return np.repeat(prints, len(flips)), points.ravel(), np.tile(np.array([w for _, w in masks], dtype=np.int32), len(prints))


def links_by_midpoints(crowd: DataFrame, threshold: int) -> DataFrame:
    """Links that connect exactly the fingerprints (column ``left``) within ``threshold``.

    Every point within half the threshold of a fingerprint gathers all within the other
    half; they are linked to it in a star. Work is in proportion to the fingerprints.
    """
    near, far = threshold // 2, (threshold + 1) // 2

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for start in range(0, len(prints), 256):
                owner, point, distance = _midpoints(prints[start : start + 256], far)
                yield pa.RecordBatch.from_arrays([pa.array(point.view(np.int64)), pa.array(distance), pa.array(owner.view(np.int64))], names=["point", "flips", "left"])

    spread_out = crowd.mapInArrow(spread, "point bigint, flips int, left bigint")
    centre = F.min(F.when(F.col("flips") <= near, F.col("left"))).alias("right")
    centres = spread_out.groupBy("point").agg(centre, F.count(F.lit(1)).alias("n")).where("right IS NOT NULL AND n > 1")
    return spread_out.join(centres.hint("merge"), "point").where("left <> right").select("left", "right").distinct()


def link_fingerprints(prints: DataFrame, column: str, threshold: int = THRESHOLD, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (left, right) whose components are those of all pairs at most ``threshold`` bits apart.

    Within an anchor every fingerprint is linked to the first one it reaches there.
    """
    if not 0 <= threshold <= 4:
        raise ValueError("the threshold can be 0 to 4 bits")
    spark = prints.sparkSession
    common.ship_code(spark)
    reach = (threshold + 1) // 2

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for start in range(0, len(values), 2048):
                part = values[start : start + 2048]
                owner, number = anchors(part, reach)
                yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), pa.array(part[owner])], names=["anchor", "left"])

    copies = prints.select(F.col(column).alias("left")).mapInArrow(spread, "anchor int, left bigint")
    gathered = copies.repartition("anchor").sortWithinPartitions("anchor")
    found = gathered.mapInArrow(lambda batches: _compare(batches, threshold, cell_rows), "left bigint, right bigint")
    found = materialise(found, scratch_path(spark, "anchor-links"))
    crowd = found.where("right IS NULL").select("left").distinct()
    linked = found.where("right IS NOT NULL")
    if crowd.isEmpty():
        return linked
    return linked.union(links_by_midpoints(materialise(crowd, scratch_path(spark, "crowded")), threshold))


def group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Add ``fingerprint_bits``, ``component_root`` and ``component_id`` to every row.

    ``keep`` names further columns carried along; ``component_root`` names a component even
    where ids are null. The component id is the smallest id reachable through links, ids
    of rows with equal fingerprints included; null ids count only where a component has no
    other. Rows without words have fingerprint 0 and are linked like any other.
    """
    spark = docs.sparkSession
    carried = [F.col(f"`{c}`").alias(f"__keep_{i}") for i, c in enumerate(keep or [])]
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"), *carried)
    names = ["doc_id", *narrow.columns[2:]]
    narrow = materialise(with_fingerprints(narrow, "__text", names), scratch_path(spark, "fingerprints"))
    distinct = materialise(narrow.groupBy("fingerprint_bits").agg(F.min("doc_id").alias("first_id")), scratch_path(spark, "distinct"))
    parts = connected(link_fingerprints(distinct, "fingerprint_bits", threshold), "left", "right")
    # All joins are shuffles: a side small enough to be sent to all would be gathered on the driver.
    rooted = distinct.join(parts.hint("merge"), distinct["fingerprint_bits"] == parts["node"], "left").select(
        "fingerprint_bits", "first_id", F.coalesce("component", "fingerprint_bits").alias("component_root")
    )
    rooted = materialise(rooted, scratch_path(spark, "rooted"))
    labels = join_least(rooted, rooted, "component_root", "first_id", "fingerprint_bits", "component_id")
    found = narrow.join(labels.select("fingerprint_bits", "component_root", "component_id").hint("merge"), "fingerprint_bits", "left")
    back = [F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep or [])]
    return found.select("doc_id", *back, "fingerprint_bits", "component_root", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """One row of each component: that of the smallest id, with all its columns.

    Of several rows with this id the one with the lowest row hash stays, and of equal rows
    one. A null id stays only where the component has no other.
    """
    marked = docs.withColumn("__print", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    grouped = materialise(group(marked, doc_id, text, threshold, keep=["__print"]), scratch_path(docs.sparkSession, "groups"))
    rows = grouped.groupBy("component_root", "doc_id", "__print").agg(F.count(F.lit(1)).alias("equal"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__print", "equal")).alias("first")
    kept = rows.groupBy("component_root").agg(first).select("first.*")
    kept = materialise(kept.select(F.col("doc_id").alias("__kept_id"), F.col("__print").alias("__kept_print"), "equal"), scratch_path(docs.sparkSession, "kept"))
    same = (marked["__print"] == kept["__kept_print"]) & marked[doc_id].eqNullSafe(kept["__kept_id"])
    left = marked.join(kept.hint("merge"), same, "left_semi").drop("__print")
    return left if kept.where("equal > 1").isEmpty() else left.dropDuplicates()


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    digits = F.lpad(F.lower(F.hex("fingerprint_bits")), 16, "0")
    return group(docs).select("doc_id", digits.alias("fingerprint"), "component_id")
