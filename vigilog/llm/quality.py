"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are its words, repeated neighbours among them, and short runs of its shape (letters as
a or A, digits as 0, everything else as it is), hashed and weighted by TF-IDF over the
corpus. A truncated singular value decomposition of a bounded sample of labelled texts
gives the latent space. The sampled texts' vectors are sent to every task, which takes exact
cosines of its documents with all of them, block by block, and weights the labels of the
nearest ones by similarity.

Nulls: null and empty texts get the share of label 1 among the labelled rows, as all texts do where
nothing was learned; null keys and labels teach nothing. Very long texts are counted piece by piece. Ties: of
equally similar neighbours at the last place, which of them vote is open, but the same for equal texts. Repeated
rows are rows like others, and an id with several labels counts for each. An empty table gives no row.
Input columns named like the added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from vigilog.llm import common
from vigilog.llm.ngrams import code_points, counts, inverse_frequency, weighted

WORDS, SHAPES = 1024, 1024
WIDTH = WORDS + SHAPES
RANK = 64
# Labelled texts sampled per label: with RANK floats each they are what is broadcast.
PER_LABEL = 2000
NEIGHBOURS = 25
SHARPNESS = 8
THRESHOLD = 0.3

COLUMNS = StructType([StructField("score", DoubleType(), False), StructField("predicted", IntegerType(), False)])


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float


@lru_cache(maxsize=1)
def shape_table() -> np.ndarray:
    """Shape of every code point: a, A, 0, or the character itself."""
    table = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord("A") if char.isupper() else ord("a")
        elif char.isdigit():
            table[code] = ord("0")
    return table


def _mix(values: np.ndarray) -> np.ndarray:
    x = values * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def terms(texts: list[str]) -> np.ndarray:
    """Counts of hashed words, repeated words and shapes, one row per text."""
    codes, owner = code_points(texts)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    inside = ~blank
    starts = np.flatnonzero(inside & np.concatenate([[True], blank[:-1]]))
    found = np.zeros((len(texts), WIDTH), dtype=np.int64)
    if len(starts):
        ends = np.flatnonzero(inside & np.concatenate([blank[1:], [True]])) + 1
        # A word's hash adds its code points, each times a mix of its place.
        place = np.arange(len(codes))
        place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(codes))))
        power = _mix((place.astype(np.uint64) & np.uint64(63)) + np.uint64(1))
        mixed = np.where(inside, codes.astype(np.uint64) * power, np.uint64(0))
        words = _mix(np.add.reduceat(mixed, starts) + (ends - starts).astype(np.uint64))
        own = owner[starts]
        again = np.concatenate([[False], (words[1:] == words[:-1]) & (own[1:] == own[:-1])])
        found[:, :WORDS] += counts(own, (words % np.uint64(WORDS - 1)).astype(np.int64) + 1, len(texts), WORDS)
        # Bucket 0 counts words that repeat the one before.
        found[:, 0] = np.bincount(own[again], minlength=len(texts))
    shape = shape_table()[codes].astype(np.uint64)
    run = (shape[:-2] << np.uint64(42)) ^ (shape[1:-1] << np.uint64(21)) ^ shape[2:]
    within = owner[:-2] == owner[2:]
    if within.any():
        found[:, WORDS:] += counts(owner[:-2][within], (_mix(run[within]) % np.uint64(SHAPES)).astype(np.int64), len(texts), SHAPES)
    return found


def term_frequency(texts: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many rows each hashed term occurs, and the number of rows, over all rows."""
    common.ship_code(texts.sparkSession)
    return common.sum_over_texts(texts, text, lambda block: (common.counts_of(block, terms) > 0).sum(axis=0), WIDTH)


def fit(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", per_label: int = PER_LABEL) -> Model:
    """Learn from the texts of ``docs`` that ``labels`` marks 0 or 1, matched by ``key``.

    At most ``per_label`` rows of each label are used, so the space and the vectors
    sent out are bounded; the term weights cover every row of ``docs``. Other labels, null
    keys and empty texts teach nothing; an id with several labels counts for each.
    """
    frequency, rows = term_frequency(docs, text)
    idf = inverse_frequency(frequency, rows)
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    totals = common.label_totals(known, "label", 2)
    # At most 2 * per_label ids and labels are sent out.
    drawn = F.broadcast(common.sample_per_label(known, "label", totals, per_label, ["key"]))
    texts = docs.where(F.length(text) > 0).select(F.col(key).alias("key"), F.col(text).alias("text"))
    matched = common.first_per_label(texts.join(drawn, "key"), "label", per_label, ["key", "text"])
    narrow = common.sparse_counts(matched, "text", terms, ["label"]).withColumn("one", F.lit(1))

    def learn(table: pa.Table) -> pa.Table:
        labels = np.array(table.column("label").to_pylist(), dtype=np.int64)
        rows = weighted(common.dense_counts(table, WIDTH), idf)
        order = np.lexsort([*rows[:, :3].T, labels])
        rows, labels = rows[order], labels[order]
        _, axes = np.linalg.eigh((rows.T @ rows).astype(np.float64))
        axes = axes[:, ::-1][:, : min(RANK, len(rows))].astype(np.float32)
        vectors = unit(rows @ axes)
        kinds = [-1] * len(axes) + labels.tolist()
        return pa.table({"kind": pa.array(kinds, pa.int32()), "place": pa.array(range(len(kinds)), pa.int64()), "vector": common.float_rows(np.concatenate([axes, vectors]))})

    schema = StructType([StructField("kind", IntegerType()), StructField("place", LongType()), StructField("vector", ArrayType(FloatType()))])
    # WIDTH + 2 * per_label rows of RANK floats come back.
    learned = sorted(narrow.groupBy("one").applyInArrow(learn, schema).collect(), key=lambda r: r["place"])
    axes = np.array([r["vector"] for r in learned if r["kind"] < 0], dtype=np.float32).reshape(-1, min(RANK, len(learned[0]["vector"])) if learned else 1)
    vectors = np.array([r["vector"] for r in learned if r["kind"] >= 0], dtype=np.float32).reshape(-1, axes.shape[1])
    labels = np.array([r["kind"] for r in learned if r["kind"] >= 0], dtype=np.float32)
    counted = sum(totals.values())
    prior = totals.get(1, 0) / counted if counted else 0.5
    return Model(idf, axes, vectors, labels, prior)


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(norms > 0, norms, 1.0)[:, None]


def vote(model: Model, tf: np.ndarray) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors."""
    if not len(model.vectors):
        return np.full(len(tf), model.prior)
    cosines = unit(weighted(tf, model.idf) @ model.axes) @ model.vectors.T
    k = min(NEIGHBOURS, cosines.shape[1])
    nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.clip(np.take_along_axis(cosines, nearest, axis=1).astype(np.float64), 0.0, 1.0) ** SHARPNESS
    total = weight.sum(axis=1)
    votes = (weight * model.labels[nearest]).sum(axis=1)
    return np.where(total > 0, votes / np.where(total > 0, total, 1.0), model.prior)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 is likelier) and ``predicted`` to every row.

    Null and empty texts, and all texts where nothing was learned, get the share of label
    1 among the labelled rows. Input columns named like the added ones are replaced.
    """

    def compute(values: dict[str, list]) -> list[pa.Array]:
        scores = [vote(model, common.counts_of(block, terms)) for _, block in common.text_blocks(values[text])]
        joined = np.concatenate(scores) if scores else np.zeros(0)
        return [pa.array(np.clip(joined, 0.0, 1.0)), pa.array((joined >= threshold).astype(np.int32))]

    return common.add_columns(docs, [text], COLUMNS, compute, keep)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label is kept from learning; a null id is not."""
    return F.coalesce(common.remainder(doc_id, 5) == 0, F.lit(False))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = fit(docs, labels.where(~held_out()), "quality")
    return score(docs, model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")
