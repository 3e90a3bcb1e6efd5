"""Language identification by nearest centroid.

A text's vector holds TF-IDF weights of hashed letter bigrams and trigrams, at unit length.
Every language gets several centroids (spherical k-means over a bounded sample); a text
gets the language of the centroid with the highest cosine. It is rejected if that cosine
is lower than what known texts of about its length reach, or if it has no letter.

Nulls: a null text, an empty text and one without letters give ``und``, 0.0 and rejected; a null
language teaches nothing, and without any language every text is ``und`` and rejected.
Very long texts are one vector like others. Ties go to the language that sorts first. Repeated rows
are rows like others in the weights, and get equal predictions. An empty table gives
no row. Input columns named like the added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, StringType, StructField, StructType

from vigilog.llm import common
from vigilog.llm.ngrams import inverse_frequency, letter_ngrams, weighted

UNKNOWN = "und"
WIDTH = 4096
CENTROIDS = 4
# Sampled documents per language for the centroids.
PER_LANGUAGE = 600
# Languages whose centroids are sent out and compared together; more take several passes.
BLOCK_LANGUAGES = 256
# Length bands: powers of two of the number of n-grams.
BANDS = 32
# One in SPARE sampled rows takes no part in the centroids; a text is rejected below TOLERANCE
# times a low quantile of the cosines that these rows reach in its length band and the
# neighbouring ones. The share falls with the square of the band below FULL_BAND, since short texts vary more.
SPARE = 4
LOW = 0.01
TOLERANCE = 0.6
FULL_BAND = 6

COLUMNS = StructType(
    [
        StructField("lang_pred", StringType(), False),
        StructField("score", DoubleType(), False),
        StructField("rejected", BooleanType(), False),
    ]
)


@dataclass(frozen=True)
class Model:
    """languages[i] is the language of centroids[i]; floors[b] is the lowest accepted
    cosine of length band b."""

    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    floors: np.ndarray


def ngrams(block: list[str]) -> np.ndarray:
    return letter_ngrams(block, WIDTH)


def document_frequency(texts: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many rows each hashed n-gram occurs, and the number of rows, over all rows."""
    return common.sum_over_texts(texts, text, lambda block: (common.counts_of(block, ngrams) > 0).sum(axis=0), WIDTH)


def _cluster(rows: np.ndarray, clusters: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means with farthest-first starts; returns centroids and labels."""
    chosen = [0]
    nearest = rows @ rows[0]
    for _ in range(min(clusters, len(rows)) - 1):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    centroids = rows[chosen]
    for _ in range(rounds):
        place = np.argmax(rows @ centroids.T, axis=1)
        sums = np.stack([rows[place == i].sum(axis=0) for i in range(len(centroids))])
        norms = np.linalg.norm(sums, axis=1)
        centroids = np.where(norms[:, None] > 0, sums / np.where(norms > 0, norms, 1.0)[:, None], centroids)
    return centroids.astype(np.float32), np.argmax(rows @ centroids.T, axis=1)


def band(sizes: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(sizes, 1)).astype(np.int64), BANDS - 1)


def _floors(reached: np.ndarray) -> np.ndarray:
    """Lowest accepted cosine per length band, from rows of bands and of cosines.

    A band nobody was seen near takes the floor of the next shorter one, the first ones 0.
    """
    floors, last = np.zeros(BANDS, dtype=np.float32), 0.0
    for own in range(BANDS):
        near = reached[1][np.abs(reached[0] - own) <= 1]
        if len(near):
            last = float(np.quantile(near, LOW)) * TOLERANCE * min(1.0, (own / FULL_BAND) ** 2)
        floors[own] = last
    return floors


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", identity: list[str] | None = None, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from all rows whose language is not null.

    Document frequencies cover every such row; centroids and rejection floors come from at
    most ``per_language`` rows of each language. Rows without a letter teach nothing.
    """
    known = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    totals = common.label_totals(known, lang, BLOCK_LANGUAGES)
    frequency, count = document_frequency(known, text)
    idf = inverse_frequency(frequency, count)
    sampled = common.sample_per_label(known, lang, totals, per_language, identity or [text])

    def learn(key: tuple, table: pa.Table) -> pa.Table:
        tf = common.dense_counts(table, WIDTH)
        sizes, spare = tf.sum(axis=1), np.array(table.column("spare").to_pylist(), dtype=bool)
        vectors, spare, bands = weighted(tf[sizes > 0], idf), spare[sizes > 0], band(sizes[sizes > 0])
        spare &= not spare.all()
        learned = vectors[~spare]
        centroids = _cluster(learned, CENTROIDS)[0] if len(learned) else np.zeros((0, WIDTH), np.float32)
        best = (vectors[spare] @ centroids.T).max(axis=1, initial=-1.0)
        # Bands and cosines of the spare rows come along with the first centroid.
        reached = [np.stack([bands[spare], best]).ravel().astype(np.float32).tolist()] + [[]] * (len(centroids) - 1)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(centroids), pa.string()), "vector": common.float_rows(centroids), "reached": pa.array(reached[: len(centroids)], pa.list_(pa.float32()))})

    schema = StructType([StructField("lang", StringType()), StructField("vector", ArrayType(FloatType())), StructField("reached", ArrayType(FloatType()))])
    spared = F.pmod(F.xxhash64(F.lit("spare"), *(identity or [text])), F.lit(SPARE)) == 0
    narrow = sampled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), spared.alias("spare"))
    narrow = common.sparse_counts(narrow, "text", ngrams, ["lang", "spare"])
    # CENTROIDS rows of WIDTH floats, 64 KiB in all, come back for each language.
    learned = sorted(narrow.groupBy("lang").applyInArrow(learn, schema).collect())
    pairs = [np.array(r["reached"]).reshape(2, -1) for r in learned]
    floors = _floors(np.concatenate(pairs, axis=1)) if pairs else np.zeros(BANDS, dtype=np.float32)
    centroids = np.array([r["vector"] for r in learned], dtype=np.float32).reshape(len(learned), WIDTH)
    return Model(idf, [r["lang"] for r in learned], centroids, floors)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred``, ``score`` (cosine, 0 to 1) and ``rejected`` to every row.

    With more languages than a block has, blocks are compared one after the other, and a row
    keeps the best of those so far.
    """
    added = {n.lower() for n in COLUMNS.names}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    found = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))
    names = sorted(set(model.languages))
    blocks = [names[i : i + BLOCK_LANGUAGES] for i in range(0, len(names), BLOCK_LANGUAGES)] or [[]]
    for block in blocks:
        wanted = set(block)
        places = [i for i, name in enumerate(model.languages) if name in wanted]
        part = Model(model.idf, [model.languages[i] for i in places], model.centroids[places], model.floors)
        found = _compared(found, part, [*kept, "__text"], block is not blocks[0])
    return found.select(*[F.col(f"`{c}`") for c in kept], *COLUMNS.names)


def _compared(docs: DataFrame, model: Model, keep: list[str], again: bool) -> DataFrame:
    """Rows with the best language of a block, or of those before where it is as near."""

    def compute(values: dict[str, list]) -> list[pa.Array]:
        languages, scores, rejected = [], [], []
        for start, block in common.text_blocks(values["__text"]):
            tf = common.counts_of(block, ngrams)
            sizes = tf.sum(axis=1)
            if not model.languages:
                languages += [UNKNOWN] * len(block)
                scores += [0.0] * len(block)
                rejected += [True] * len(block)
                continue
            cosines = weighted(tf, model.idf) @ model.centroids.T
            best = np.argmax(cosines, axis=1)
            top = np.clip(cosines[np.arange(len(block)), best].astype(np.float64), 0.0, 1.0)
            empty = sizes == 0
            chosen = [UNKNOWN if none else model.languages[i] for none, i in zip(empty, best, strict=True)]
            top = np.where(empty, 0.0, top)
            if again:
                before = np.array(values["score"][start : start + len(block)])
                former = values["lang_pred"][start : start + len(block)]
                chosen = [own if nearer else old for own, old, nearer in zip(chosen, former, top > before, strict=True)]
                top = np.maximum(top, before)
            languages += chosen
            scores += top.tolist()
            rejected += (empty | (top < model.floors[band(sizes)])).tolist()
        return [pa.array(languages, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]

    inputs = ["__text", "lang_pred", "score"] if again else ["__text"]
    return common.add_columns(docs, inputs, COLUMNS, compute, keep)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(common.remainder(doc_id, 4) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, then predict for all of them."""
    model = fit(docs.where(~held_out()), identity=["doc_id", "text"])
    return predict(docs, model).withColumn("held_out", held_out())


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score", "rejected")


