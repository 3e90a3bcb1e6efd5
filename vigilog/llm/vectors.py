"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) are vectors of a sample that lie apart from each other, one for every
ENTRIES_PER_PIVOT distinct vectors, so that a list doesn't grow with the table. A vector is described
by its NEAREST pivots in order. Inverted lists are kept per pair of pivots, and a vector is in that of each pair whose
ranks in its order add up to RANK_SUM at most: near pivots are paired with many, the last with the first only.
So two vectors meet exactly if they share two pivots that stand early enough in the orders of both; every
pair that meets is then verified by its exact cosine. Only the sample is bounded (by
PIVOT_BYTES, beyond which lists grow again): every vector is indexed.

Exact copies are one entry with a count. A list beyond LIST_ROWS entries is cut into blocks,
and each pair of blocks is compared by a task of its own, so no pair is lost. Lists give
back sums and one link per entry and list, never pairs.

Nulls: null vectors, vectors with null or non-finite numbers and zero vectors, empty ones too, link with
nothing, as rows of a null label do; a null id is linked, but keeps nothing. Very long vectors are compared like others, with
vectors of their length. Ties: equally near pivots stand in their order, at the last place any of them may stand, and a cosine of exactly the
threshold links. Repeated rows are one entry with a count, and each is another vector to the others. An
empty table gives no row. Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from vigilog.llm import common
from vigilog.llm.components import connected
from vigilog.llm.simhash import forest
from vigilog.operators.joins import fits_in_broadcast, spread_lookup
from vigilog.sources.lake import materialise, scratch_path

THRESHOLD = 0.98
# Distinct vectors per pivot, fewest pivots of a vector length, most bytes of all pivots beyond
# these, and lengths that get pivots. Twice as many vectors are sampled as pivots are wanted.
ENTRIES_PER_PIVOT = 40
FEWEST_PIVOTS = 64
PIVOT_BYTES = 32 * 1024 * 1024
MOST_LENGTHS = 64
# Pivots lie at least this many times the angle of the threshold apart.
APART = 2.5
NEAREST = 7
RANK_SUM = 8
# Cosines to pivots held at a time.
COSINES = 4_000_000
LIST_ROWS = 1024
# Runs up to this length are compared by shifts over many lists at once.
SHORT_RUN = 16


def comparable(vector: Column) -> Column:
    """Whether a vector is not null, holds only finite numbers, and not only zeros."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one in double precision; scaled first, so that squares don't overflow."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def apart(rows: np.ndarray, count: int, closest: float) -> np.ndarray:
    """The first ``count`` unit rows whose cosines to all rows chosen before are ``closest`` at most:
    pivots that are nearly the same would be ordered by chance, and a crowd of copies would get many."""
    chosen = rows[:0]
    for start in range(0, len(rows), 256):
        block = rows[start : start + 256]
        if len(chosen):
            block = block[(block @ chosen.T).max(axis=1) <= closest]
        among, kept = block @ block.T, []
        for place in range(len(block)):
            if not kept or among[place, kept].max() <= closest:
                kept.append(place)
        chosen = np.concatenate([chosen, block[kept]])
        if len(chosen) >= count:
            break
    return chosen[:count]


def pivot_counts(totals: dict[int, int], per_pivot: int = ENTRIES_PER_PIVOT, most_bytes: int = PIVOT_BYTES) -> dict[int, int]:
    """Pivots wanted per vector length; what lengths want beyond the fewest is cut in one
    proportion where it would exceed ``most_bytes``."""
    beyond = {size: max(total // per_pivot - FEWEST_PIVOTS, 0) for size, total in totals.items()}
    wanted = sum(4 * size * more for size, more in beyond.items())
    share = min(1.0, most_bytes / wanted) if wanted else 1.0
    return {size: FEWEST_PIVOTS + int(more * share) for size, more in beyond.items()}


def find_pivots(entries: DataFrame, threshold: float = THRESHOLD, per_pivot: int = ENTRIES_PER_PIVOT) -> dict[int, np.ndarray]:
    """Pivots per vector length as single-precision rows, the same ones on every run.

    Only the MOST_LENGTHS most frequent lengths get pivots; vectors of another length share one
    list with those of their label.
    """
    closest = float(np.cos(min(np.pi, APART * np.arccos(threshold))))
    sized = entries.select(F.size("vector").alias("size"), "vector")
    frequent = sized.groupBy("size").count().orderBy(F.desc("count"), "size").limit(MOST_LENGTHS).collect()
    totals = {size: total for size, total in sorted(frequent)}
    counts = pivot_counts(totals, per_pivot)
    if not counts:
        return {}
    # Entries are distinct, so a hash draws about twice as many of them as there are pivots.
    share = F.create_map(*[F.lit(x) for size, total in totals.items() for x in (size, 2.0 * counts[size] / total)])
    lot = F.xxhash64("vector").alias("lot")
    drawn = sized.select("vector", "size", lot).where(F.pmod("lot", F.lit(1 << 30)) / F.lit(float(1 << 30)) < share[F.col("size")])
    lots, rows = {size: [] for size in totals}, {size: [] for size in totals}
    for batch in drawn.select("vector", "lot").toArrow().to_batches():
        for places, found in _by_size(batch.column(0)):
            lots[found.shape[1]].append(batch.column(1).to_numpy()[places])
            rows[found.shape[1]].append(found)
    pivots = {}
    for size in totals:
        if rows[size]:
            order = np.argsort(np.concatenate(lots[size]), kind="stable")
            pivots[size] = apart(unit(np.concatenate(rows[size])[order]).astype(np.float32), counts[size], closest)
    return pivots


def nearest_pivots(rows: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each unit row, the nearest first."""
    width, rows = min(nearest, len(pivots)), rows.astype(np.float32)
    found = np.empty((len(rows), width), dtype=np.int64)
    step = max(1, COSINES // max(1, len(pivots)))
    for start in range(0, len(rows), step) if width else ():
        cosines = rows[start : start + step] @ pivots.T
        few = np.sort(np.argpartition(-cosines, width - 1, axis=1)[:, :width], axis=1)
        order = np.argsort(-np.take_along_axis(cosines, few, axis=1), axis=1, kind="stable")
        found[start : start + step] = np.take_along_axis(few, order, axis=1)
    return found


def list_keys(rows: np.ndarray, labels: np.ndarray, pivots: np.ndarray | None, nearest: int = NEAREST, rank_sum: int = RANK_SUM) -> np.ndarray:
    """Sorted numbers of the lists each vector belongs to: one per pair of its nearest pivots whose
    ranks, from 1, add up to ``rank_sum`` at most; a single one where there are fewer than two pivots."""
    order = nearest_pivots(rows, rows[:0] if pivots is None else pivots, nearest)
    width = order.shape[1]
    pairs = [(a, b) for b in range(width) for a in range(b) if a + b + 2 <= rank_sum]
    base = (labels.astype(np.uint64) * np.uint64(65_537) + np.uint64(rows.shape[1])) * np.uint64(0x9E3779B97F4A7C15)
    keys = []
    for a, b in pairs:
        key = base
        for pivot in (np.minimum(order[:, a], order[:, b]), np.maximum(order[:, a], order[:, b])):
            key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + pivot.astype(np.uint64)
        keys.append(key.view(np.int64))
    return np.sort(np.stack(keys or [base.view(np.int64)], axis=1), axis=1)


def _by_size(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of vectors of one length, and these vectors as a matrix."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        flat = vectors.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
        yield places, flat.reshape(len(places), int(size))


def index(entries: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Add ``lists``, the numbers of the inverted lists of every entry."""
    spark = entries.sparkSession
    common.ship_code(spark)
    sent = spark.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
            lists: list = [None] * batch.num_rows
            for places, rows in _by_size(batch.column(batch.schema.get_field_index("vector"))):
                keys = list_keys(unit(rows), labels[places].astype(np.int64), sent.value.get(rows.shape[1]))
                for place, key in zip(places.tolist(), keys.tolist(), strict=True):
                    lists[place] = key
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int64()))], names=[*batch.schema.names, "lists"])

    return entries.mapInArrow(run, StructType([*entries.schema.fields, StructField("lists", ArrayType(LongType()))]))


def _pairs_in_runs(run_of: np.ndarray, rows: np.ndarray, blocks: np.ndarray, crossed: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of rows within runs; in a crossed run only between its two blocks."""
    left, right = [], []
    starts = np.flatnonzero(np.concatenate([[True], run_of[1:] != run_of[:-1]]))
    sizes = np.diff(np.append(starts, len(run_of)))
    alive, step = np.flatnonzero(np.repeat(sizes <= SHORT_RUN, sizes)), 1
    while len(alive):
        alive = alive[alive + step < len(run_of)]
        alive = alive[run_of[alive] == run_of[alive + step]]
        for part in np.array_split(alive, len(alive) // 20_000 + 1):
            near = np.einsum("ij,ij->i", rows[part], rows[part + step]) >= threshold
            left.append(part[near])
            right.append(part[near] + step)
        step += 1
    for start, size in zip(starts[sizes > SHORT_RUN].tolist(), sizes[sizes > SHORT_RUN].tolist(), strict=True):
        part = rows[start : start + size]
        a, b = np.nonzero(part @ part.T >= threshold)
        upper = a < b
        left.append(a[upper] + start)
        right.append(b[upper] + start)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = np.concatenate(left), np.concatenate(right)
    use = ~crossed[left] | (blocks[left] != blocks[right])
    return left[use], right[use]


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Per entry and list with a link: copies linked to it, and the root of its links.

    A pair that meets in several lists is counted in the lowest of them only.
    """

    def settle(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        column = {n: table.column(n).combine_chunks() for n in table.column_names}
        flat = {n: column[n].to_numpy(zero_copy_only=False) for n in ("list", "low", "high", "block", "node", "copies")}
        lists_flat = column["lists"]
        changed = (flat["list"][1:] != flat["list"][:-1]) | (flat["low"][1:] != flat["low"][:-1]) | (flat["high"][1:] != flat["high"][:-1])
        run = np.concatenate([np.zeros(1, np.int64), np.cumsum(changed)])
        in_run = np.bincount(run)[run]
        for places, rows in _by_size(column["vector"]):
            several = in_run[places] > 1
            places = places[several]
            if not len(places):
                continue
            rows = unit(rows[several])
            block, crossed = flat["block"][places], flat["low"][places] != flat["high"][places]
            left, right = _pairs_in_runs(run[places], rows, block, crossed, threshold)
            if not len(left):
                continue
            lists = lists_flat.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False).reshape(len(places), -1)
            here = flat["list"][places]
            links = np.zeros(len(places), dtype=np.int64)
            copies = flat["copies"][places]
            for start in range(0, len(left), 200_000):
                a, b = left[start : start + 200_000], right[start : start + 200_000]
                common_list = (lists[a][:, :, None] == lists[b][:, None, :]).any(axis=2)
                first = lists[a, np.argmax(common_list, axis=1)] == here[a]
                np.add.at(links, a[first], copies[b[first]])
                np.add.at(links, b[first], copies[a[first]])
            root = forest(len(places), left, right)
            linked = np.unique(np.concatenate([left, right]))
            node = flat["node"][places]
            yield pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(links[linked]), pa.array(node[root[linked]])], names=["node", "links", "root"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        # Rows of the last run wait for the next batch; a run has at most two blocks.
        keys = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("list", "low", "high")]
        last = np.logical_and.reduce([k == k[-1] for k in keys])
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield from settle([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield from settle(held)


def link(entries: DataFrame, threshold: float = THRESHOLD, list_rows: int = LIST_ROWS, pivots: dict[int, np.ndarray] | None = None) -> DataFrame:
    """(node, links, root) of entries (node, copies, label, vector): how many other
    vectors are linked in a list, and a linked node, per list with a link."""
    spark = entries.sparkSession
    pivots = find_pivots(entries, threshold) if pivots is None else pivots
    indexed = materialise(index(entries, pivots), scratch_path(spark, "lists"))
    long = indexed.select("node", F.explode("lists").alias("list")).groupBy("list").count().where(F.col("count") > list_rows)
    long = materialise(long.select("list", F.ceil(F.col("count") / F.lit(list_rows)).cast("int").alias("blocks")), scratch_path(spark, "long-lists"))
    copies = indexed.withColumn("list", F.explode("lists"))
    # Each row of a cut list goes to every pair of blocks its own block belongs to.
    few = fits_in_broadcast(long)
    cut = copies.join(F.broadcast(long), "list", "left") if few else spread_lookup(copies, long, ["list"], ["node"])
    cut = cut.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    cut = cut.select("list", "low", "high", "block", "node", "copies", "lists", "vector")
    gathered = cut.repartition("list", "low", "high").sortWithinPartitions("list", "low", "high")
    return gathered.mapInArrow(lambda batches: _verify(batches, threshold), "node bigint, links bigint, root bigint")


def group(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, list_rows: int = LIST_ROWS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Rows are compared where labels are equal and not null and vectors equally long.
    Null vectors, zero vectors and vectors with null or non-finite numbers link with nothing and
    are their own component. A repeated row counts as another vector. A null id is linked
    like any other; its component is the smallest other id, or null, and it isn't kept.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).cast("long").alias("label"))
    usable = F.col("label").isNotNull() & comparable(F.col("vector"))
    # Two hashes of different kinds name a distinct vector.
    rows = rows.withColumn("usable", usable).withColumn("print", F.when(usable, F.struct("label", F.xxhash64("vector").alias("a"), F.hash("vector").alias("b"))))
    entries = rows.where("usable").groupBy("print").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
    )
    entries = materialise(entries.withColumn("node", F.monotonically_increasing_id()), scratch_path(spark, "vectors"))
    links = link(entries.select("node", "copies", "label", "vector"), threshold, list_rows)
    links = materialise(links.groupBy("node", "root").agg(F.sum("links").alias("links")), scratch_path(spark, "vector-links"))
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected(links, "node", "root")
    rooted = entries.select("node", "print", "first_id", "copies").join(counted, "node", "left").join(parts, "node", "left")
    rooted = rooted.withColumn("component", F.coalesce("component", "node"))
    least = rooted.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = spread_lookup(rooted, least, ["component"], ["node"], "inner").select("print", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    # A vector may have very many copies: they are spread by their ids.
    found = spread_lookup(rows.select("vec_id", "usable", "print"), known, ["print"], ["vec_id"])
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return group(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def oracle() -> str:
    """All cosines within a label, and what links reach, in SQL; for small tables."""
    return f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS y FROM reached GROUP BY x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id, vec_id <= coalesce(y, vec_id) AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.x LEFT JOIN counted ON vec_id = counted.x"""
