"""A corpus pipeline of five stages, each an operator of ``vigilog.llm``.

Every stage takes the documents its predecessor kept and returns the columns of
``documents``; the last one adds the ids. Stages are written as Parquet and read again.

Null texts and texts without letters are rejected by the first stage. Ties, repeated rows,
null ids and empty tables are handled as the operators' descriptions say; further columns of
the documents are carried through unchanged, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.llm import language, mixing, pieces, privacy, simhash
from vigilog.sources.lake import discard, materialise, scratch_path, scratch_scope


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Documents under neutral column names, so that no added column can clash."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _original(df: DataFrame, names: dict[str, str], *more: str) -> DataFrame:
    return df.select(*[F.col(short).alias(c) for c, short in names.items()], *more)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected; the model learns from these documents."""
    model = language.fit(docs.where(~language.held_out()), identity=["doc_id", "text"])
    plain, names = _plain(docs)
    return _original(language.predict(plain, model, names["text"]).where(~F.col("rejected")), names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    plain, names = _plain(docs)
    return _original(simhash.keep_one(plain, names["doc_id"], names["text"]), names)


def protect_privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are replaced; lengths are those of the new texts."""
    plain, names = _plain(docs)
    text = F.when(F.col(names["text"]).isNotNull(), F.col("sanitised"))
    changed = privacy.protect(plain, names["text"]).withColumn(names["text"], text)
    if "n_chars" in names:
        length = F.length(names["text"]).cast(dict(docs.dtypes)["n_chars"])
        changed = changed.withColumn(names["n_chars"], F.coalesce(length, F.col(names["n_chars"])))
    return _original(changed, names)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled with the probabilities that match the target weights."""
    plain, names = _plain(docs)
    axes = {"source": F.col(names["source"]), "lang": F.col(names["lang"]), "topic": mixing.topic(names["text"])}
    mixed = mixing.mix(plain, key=names["doc_id"], text=names["text"], axes=axes)
    return _original(mixed.where("sampled"), names)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``piece_ids``, ``n_pieces`` and the text decoded from the ids, ``piece_text``."""
    plain, names = _plain(docs)
    encoded = pieces.encode(plain, text=names["text"])
    added = [F.col("ids").alias("piece_ids"), F.size("ids").cast("long").alias("n_pieces"), F.col("decoded").alias("piece_text")]
    return _original(encoded, {c: short for c, short in names.items() if c not in ("piece_ids", "n_pieces", "piece_text")}, *added)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("PII", protect_privacy),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# Rolling hashes of shingles, centroids and piece merges are beyond SQL; the tests hold the
# pipeline against a version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    former: list[str] = []
    for name, stage in STAGES:
        path = scratch_path(spark, name.split()[0].lower())
        # What a stage needs in between goes as soon as its result is written, and so does what it has read.
        with scratch_scope(spark):
            docs = materialise(stage(spark, docs, sf_dir), path)
        discard(spark, former)
        former = [path]
    return docs
