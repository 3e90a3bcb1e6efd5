"""How filters on documents interact, with copies found by radix text tries.

Every document gets a mask of the filters it fails. Four of them are told from the text alone;
the fifth fails a text that a smaller id holds too. For it, texts are dealt out by ranges: a
directory of prefixes is refined, four times longer at each level, until no range holds more
than its share of all bytes or a range holds a single text. Each range's full texts go into a
compressed trie whose terminals hold the least id; what doesn't hold it is a copy.

Before that shuffle every task puts its own texts into such a trie, block by block: a copy of
a text that the block holds with a smaller id is settled there, so a text is sent once for
each block however many copies there are. Masks are then reduced to counts per part,
from which the removals of all orders of the filters are added up.

Nulls: a null text is empty, a null part is the empty string; a null id is smaller than none and
larger than none, so it is no copy and makes none. Empty and very long texts are texts like
others; a long one is read through piece by piece for its words. Ties: rows of equal id and text
are no copies of each other. Repeated rows count one by one. An empty table gives no row.
Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from vigilog.llm import common
from vigilog.operators.joins import shuffle_tasks
from vigilog.sources.lake import materialise, scratch_path

FILTERS = "ABCDE"
BITS = {name: 1 << place for place, name in enumerate(FILTERS)}
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # of 100 words
MOST_CAPITALS = 10  # of 100 code points
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SPACE = re.compile(rb"[\x20\x09-\x0D]")

# Bytes of texts in the trie of one block, and bytes of a text whose words are listed at once.
BLOCK_BYTES = 1 << 25
PIECE_BYTES = 1 << 20
# Bytes of the shortest prefix, and how much longer the next ones are.
FIRST_PREFIX, PREFIX_GROWTH = 4, 4
# Ranges wanted for each task of a shuffle, and in all; their bytes are at least LEAST_RANGE.
RANGES_PER_TASK, MOST_RANGES, LEAST_RANGE = 8, 1 << 18, 1 << 16
# Prefixes a task counts before it hands its counts on, and rows and bytes of a batch it emits.
HELD_NODES = 200_000
BATCH_ROWS, BATCH_BYTES = 1024, 1 << 23

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


class Node:
    __slots__ = ("edges", "held", "least", "mask")

    def __init__(self) -> None:
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.least = None
        self.mask = 0
        # Rows with the least id, by part.
        self.held: dict[str, int] = {}


def _shared(label: bytes, text: bytes, place: int) -> int:
    """Length of the common prefix of a label and the rest of a text."""
    low, high = 0, min(len(label), len(text) - place)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[place + low : place + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed trie: a branch without forks is one labelled edge."""

    def __init__(self) -> None:
        self.root = Node()
        self.bytes = 0

    def terminal(self, text: bytes) -> Node:
        """The node where a text ends, made if it is missing."""
        node, place = self.root, 0
        while place < len(text):
            edge = node.edges.get(text[place])
            if edge is None:
                child = Node()
                node.edges[text[place]] = (text[place:], child)
                self.bytes += len(text) - place
                return child
            label, child = edge
            if not text.startswith(label, place):
                cut = _shared(label, text, place)
                fork = Node()
                fork.edges[label[cut]] = (label[cut:], child)
                node.edges[text[place]] = (label[:cut], fork)
                label, child = label[:cut], fork
            node, place = child, place + len(label)
        return node

    def add(self, text: bytes, key, part: str, mask: int, n: int) -> list[tuple]:
        """Put rows of a text in; returns those now known to be copies, as (key, part, mask, n)."""
        node = self.terminal(text)
        if node.least is not None and key > node.least:
            return [(key, part, mask | BITS["E"], n)]
        beaten = []
        if node.least is None or key < node.least:
            beaten = [(node.least, p, node.mask | BITS["E"], m) for p, m in node.held.items()]
            node.least, node.mask, node.held = key, mask, {}
        node.held[part] = node.held.get(part, 0) + n
        return beaten

    def walk(self, whole: bool) -> Iterator[tuple[bytes, Node]]:
        """Terminals, with their texts if ``whole``."""
        open_nodes = [(b"", self.root)]
        while open_nodes:
            text, node = open_nodes.pop()
            if node.held:
                yield text, node
            open_nodes.extend((text + label if whole else b"", child) for label, child in node.edges.values())


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text cut at white space into pieces of about PIECE_BYTES."""
    start = 0
    while len(text) - start > PIECE_BYTES:
        cut = SPACE.search(text, start + PIECE_BYTES)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


def failures_of(text: bytes, chars: int) -> int:
    """Mask of the filters that a text alone fails; ``chars`` is its number of code points."""
    words, distinct = 0, set()
    for piece in _pieces(text):
        # The white space of bytes is the six characters that part words here.
        found = piece.split()
        words += len(found)
        distinct.update(found)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        BITS["A"] * (words < LEAST_WORDS)
        + BITS["B"] * (100 * len(distinct) < LEAST_DISTINCT * words)
        + BITS["C"] * (100 * capitals > MOST_CAPITALS * chars)
        + BITS["D"] * (len(text.translate(None, SYMBOLS)) < len(text))
    )


def _levels(longest: int) -> list[int]:
    """Prefix lengths up to the first one beyond ``longest``."""
    lengths = [FIRST_PREFIX]
    while lengths[-1] <= longest:
        lengths.append(lengths[-1] * PREFIX_GROWTH)
    return lengths


def _name(prefix: bytes, level: int) -> int:
    """A signed number for a prefix at a level. Equal numbers of two prefixes only put two
    ranges in one place."""
    value = xxhash.xxh64_intdigest(prefix, level)
    return value - (1 << 64) if value >> 63 else value


def _count_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, bytes, low, high) per prefix of a text: bytes below it, least and largest hash of its texts."""
    held: dict[int, list[int]] = {}

    def flush() -> pa.RecordBatch:
        columns = [list(held), *([v[i] for v in held.values()] for i in range(3))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "bytes", "low", "high"])

    for batch in common.slices(batches):
        for text in batch.column(0).to_pylist():
            size, whole = len(text), _name(text, 0)
            for level, length in enumerate(_levels(size)):
                entry = held.setdefault(_name(text[:length], level + 1), [0, whole, whole])
                entry[0] += size
                entry[1], entry[2] = min(entry[1], whole), max(entry[2], whole)
        if len(held) > HELD_NODES:
            yield flush()
            held.clear()
    yield flush()


def prefix_directory(texts: DataFrame, ranges: int | None = None) -> np.ndarray:
    """Sorted names of the prefixes whose range is split further.

    A range is split while it holds several texts and more than its share of all bytes, so at
    most ``ranges`` prefixes of each level reach the driver, whatever the table's size.
    """
    spark = texts.sparkSession
    common.ship_code(spark)
    ranges = ranges or min(MOST_RANGES, RANGES_PER_TASK * shuffle_tasks(spark))
    counted = texts.mapInArrow(_count_prefixes, "node bigint, bytes bigint, low bigint, high bigint")
    nodes = counted.groupBy("node").agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
    # Only what may be split is written: a range of a single text never is.
    nodes = materialise(nodes.where((F.col("low") < F.col("high")) & (F.col("bytes") > LEAST_RANGE)), scratch_path(spark, "prefixes"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length(texts.columns[0])), F.lit(0))).first()[0]
    split = nodes.where(F.col("bytes") > F.lit(total / ranges)).select("node").toArrow()
    return np.sort(split.column(0).to_numpy())


def ranges_of(texts: list[bytes], directory: np.ndarray) -> np.ndarray:
    """The range each text is in: its first prefix that isn't split further."""
    found = np.zeros(len(texts), dtype=np.int64)
    alive = list(range(len(texts)))
    for level, length in enumerate(_levels(max(map(len, texts), default=0))):
        names = np.array([_name(texts[i][:length], level + 1) for i in alive], dtype=np.int64)
        found[alive] = names
        if not len(directory) or not alive:
            break
        place = np.minimum(np.searchsorted(directory, names), len(directory) - 1)
        alive = [i for i, split in zip(alive, directory[place] == names, strict=True) if split and len(texts[i]) >= length]
    return found


def _emit(rows: list[tuple], texts: list[bytes] | None, cells: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    """Rows (key, part, mask, n); without texts they are settled."""
    keys, parts, masks, counts = zip(*rows, strict=True) if rows else ((),) * 4
    arrays = [
        pa.array(cells, pa.int64()),
        pa.array(texts if texts is not None else [None] * len(rows), pa.binary()),
        pa.array(keys, kind),
        pa.array(parts, pa.string()),
        pa.array(masks, pa.int32()),
        pa.array(counts, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["cell", "text", "key", "part", "mask", "n"])


def _settle_blocks(batches: Iterator[pa.RecordBatch], directory: np.ndarray, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Masks of a task's documents; one row per distinct text of a block keeps its text."""
    trie, kind, spread = Trie(), pa.int64(), 0

    def leave() -> Iterator[pa.RecordBatch]:
        rows, texts, held = [], [], 0
        for text, node in trie.walk(whole=True):
            rows += [(node.least, part, node.mask, n) for part, n in node.held.items()]
            texts += [text] * len(node.held)
            held += len(text) * len(node.held)
            if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                yield _emit(rows, texts, ranges_of(texts, directory), kind)
                rows, texts, held = [], [], 0
        if rows:
            yield _emit(rows, texts, ranges_of(texts, directory), kind)

    for batch in common.slices(batches):
        kind = batch.column(0).type
        settled: list[tuple] = []
        chars = pc.utf8_length(batch.column(1)).to_pylist()
        texts = batch.column(1).cast(pa.binary())
        for i, (key, part) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            text = texts[i].as_py()
            mask = failures_of(text, chars[i])
            if key is None:
                settled.append((None, part, mask, 1))
                continue
            settled += trie.add(text, key, part, mask, 1)
            if trie.bytes > block_bytes:
                yield from leave()
                trie = Trie()
        # Settled rows need no range; they are dealt out evenly.
        cells = np.arange(spread, spread + len(settled), dtype=np.int64) * 7_919
        spread += len(settled)
        if settled:
            yield _emit(settled, None, cells, kind)
    yield from leave()


def _settle_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, part, mask, n) of whole ranges, which come one after the other."""
    trie, current, kind = Trie(), None, pa.int64()

    def out(rows: list[tuple]) -> pa.RecordBatch:
        keys, parts, masks, counts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, kind), pa.array(parts, pa.string()), pa.array(masks, pa.int32()), pa.array(counts, pa.int64())], names=["key", "part", "mask", "n"]
        )

    for batch in common.slices(batches):
        kind = batch.column(2).type
        rows: list[tuple] = []
        texts = batch.column(1)
        for i, (cell, *row) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4, 5)), strict=True)):
            text = texts[i].as_py()
            if text is None:
                rows.append(tuple(row))
                continue
            if cell != current:
                rows += [(node.least, part, node.mask, n) for _, node in trie.walk(whole=False) for part, n in node.held.items()]
                trie, current = Trie(), cell
            rows += trie.add(text, *row)
        if rows:
            yield out(rows)
    rows = [(node.least, part, node.mask, n) for _, node in trie.walk(whole=False) for part, n in node.held.items()]
    if rows:
        yield out(rows)


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", ranges: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, part, mask, n): how many rows of an id and part fail the filters of a mask.

    An id has one row for each of its masks and parts at most. ``ranges`` bounds the
    prefixes split at each level (default: some for each task of a shuffle).
    """
    common.ship_code(docs.sparkSession)
    kind = docs.schema[key].dataType
    body = F.coalesce(F.col(text), F.lit("")).alias("text")
    rows = docs.select(F.col(key).alias("key"), body, F.coalesce(F.col(part), F.lit("")).alias("part"))
    directory = prefix_directory(docs.select(body.cast("binary").alias("text")), ranges)
    narrow = [StructField("key", kind), StructField("part", StringType()), StructField("mask", IntegerType()), StructField("n", LongType())]
    local = StructType([StructField("cell", LongType()), StructField("text", docs.select(body.cast("binary")).schema[0].dataType), *narrow])
    blocks = rows.mapInArrow(lambda batches: _settle_blocks(batches, directory, block_bytes), local)
    gathered = blocks.repartition("cell").sortWithinPartitions("cell")
    settled = gathered.mapInArrow(_settle_ranges, StructType(narrow))
    return settled.groupBy("key", "part", "mask").agg(F.sum("n").alias("n"))


def orders() -> list[str]:
    return ["".join(order) for order in permutations(FILTERS)]


def interactions(masks: DataFrame) -> DataFrame:
    """What each filter removes at each step of each order, from (part, mask, n, good, toxic).

    A part has at most one row per mask, so a part is at most 32 rows before the orders.
    """
    names = orders()
    own = [BITS[order[step]] for order in names for step in range(len(FILTERS))]
    earlier = [sum(BITS[f] for f in order[:step]) for order in names for step in range(len(FILTERS))]
    steps = masks.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(own) - 1))))
    place = F.col("at") + 1
    steps = steps.withColumn("own", F.element_at(F.lit(own), place)).withColumn("earlier", F.element_at(F.lit(earlier), place))
    mask = F.col("mask")
    fails, gone = mask.bitwiseAND(F.col("own")) != 0, mask.bitwiseAND(F.col("earlier")) != 0
    # A filter is first among the failed ones in one of as many orders as there are failed ones.
    first = F.floor(F.lit(len(names)) / F.bit_count(mask)).cast("long")

    def added(condition: Column, value: str) -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0)))

    counts = {
        "kept": added(~fails & ~gone, "n"),
        "removed": added(fails & ~gone, "n"),
        "redundant": added(fails & gone, "n"),
        "unique_fails": added(mask == F.col("own"), "n"),
        "good_lost": added(fails & ~gone, "good"),
        "toxic_lost": added(fails & ~gone, "toxic"),
        "shapley": F.sum(F.when(fails, F.col("n") * first).otherwise(F.lit(0))),
    }
    summed = steps.groupBy("part", "at").agg(*[counts[c].cast("long").alias(c) for c in COUNTS])
    order = F.element_at(F.lit(names), F.floor(F.col("at") / len(FILTERS)).cast("int") + 1)
    return summed.select("part", order.alias("filter_order"), (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"), *COUNTS)


def audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", label_key: str = "doc_id", good: str = "quality", toxic: str = "toxic", **limits: int
) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of COUNTS.

    A document counts as good or toxic if any label row of its id says so; ids without a
    label row, null ids included, are neither. ``limits`` are those of ``failures``.
    """
    failed = failures(docs, key, text, part, **limits)
    known = labels.where(F.col(label_key).isNotNull()).groupBy(F.col(label_key).alias("key"))
    known = known.agg(F.max((F.col(good) == 1).cast("int")).alias("is_good"), F.max((F.col(toxic) == 1).cast("int")).alias("is_toxic"))
    # Both sides have few rows per id: repeated ids were added up before.
    marked = failed.join(known, "key", "left")
    masks = marked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("is_good") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
    )
    return interactions(masks)


def query(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def oracle() -> str:
    letters = " UNION ALL ".join(f"SELECT '{name}' AS f, {bit} AS bit" for name, bit in BITS.items())
    aliases = [f"l{i}" for i in range(len(FILTERS))]
    differ = " AND ".join(f"{a}.f <> {b}.f" for i, a in enumerate(aliases) for b in aliases[:i])
    steps = " UNION ALL ".join(
        f"SELECT {' || '.join(f'{a}.f' for a in aliases)} AS filter_order, {i + 1} AS step, l{i}.bit AS own, {' + '.join(['0', *(f'{a}.bit' for a in aliases[:i])])} AS earlier "
        f"FROM {', '.join(f'letters {a}' for a in aliases)} WHERE {differ}"
        for i in range(len(FILTERS))
    )
    return f"""
WITH letters AS ({letters}), steps AS ({steps}),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+') AS w FROM documents),
failed AS (
  SELECT doc_id, part, CASE WHEN len(w) < {LEAST_WORDS} THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(body) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END AS mask
  FROM texts),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic, 120 // greatest(bit_count(mask), 1) AS first_in
  FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, mask)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
  CAST(coalesce(sum(n) FILTER (WHERE mask & (own | earlier) = 0), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (WHERE mask & own > 0 AND mask & earlier = 0), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (WHERE mask & own > 0 AND mask & earlier > 0), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (WHERE mask = own), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(good) FILTER (WHERE mask & own > 0 AND mask & earlier = 0), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(toxic) FILTER (WHERE mask & own > 0 AND mask & earlier = 0), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * first_in) FILTER (WHERE mask & own > 0), 0) AS BIGINT) AS shapley
FROM masks CROSS JOIN steps GROUP BY part, filter_order, step"""
