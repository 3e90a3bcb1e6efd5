"""Raw zone: headerless CSV logs, their preview, their listing, and what of them was landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vigilog.sources.schemas import AUTH_RAW, REDTEAM_RAW


# What is kept of the object that a line came from; constant over a file, so nearly free in Parquet.
LINEAGE = {"objet": "file_path", "objet_taille": "file_size", "objet_modifie": "file_modification_time"}
MANIFEST = "objet string, path string, length bigint, modificationTime timestamp, nb_lignes bigint, premiere_seconde bigint, derniere_seconde bigint"
# The column of a tolerant read that holds a line it could not read.
CORRUPT = "ligne"


def _read_csv(spark: SparkSession, path: str | list[str], schema: StructType, mode: str = "FAILFAST") -> DataFrame:
    # FAILFAST only checks the columns a query reads, so the strict read belongs in
    # the landing job, which reads all of them; everything else starts from its copy.
    return (
        spark.read.schema(schema)
        .option("header", False)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("escape", '"')
        .csv(path)
    )


def _with_lineage(df: DataFrame) -> DataFrame:
    return df.select("*", *[F.col(f"_metadata.{known}").alias(name) for name, known in LINEAGE.items()])


def read_auth(spark: SparkSession, path: str | list[str], lineage: bool = False) -> DataFrame:
    """Strict; ``lineage`` adds the object each line came from."""
    df = _read_csv(spark, path, AUTH_RAW)
    return _with_lineage(df) if lineage else df


def read_redteam(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, REDTEAM_RAW)


def read_auth_split(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tolerant: lineage, and the whole line in ``ligne`` where it could not be read.

    All columns have to be read together, since a line is only checked for the columns wanted.
    """
    return _with_lineage(_read_csv(spark, path, StructType([*AUTH_RAW.fields, StructField(CORRUPT, StringType())]), "PERMISSIVE"))


def rejects(lines: DataFrame) -> DataFrame:
    """The unreadable lines of a tolerant read with the reason: number of fields, or a field's type."""
    fields = ", ".join(f"`{name}` string" for name in AUTH_RAW.names)
    as_texts = F.from_csv(F.col(CORRUPT), f"{fields}, _odd string", {"columnNameOfCorruptRecord": "_odd", "escape": '"'})
    reason = F.when(as_texts["_odd"].isNotNull(), "nombre de champs").otherwise("type d'un champ")
    return lines.where(F.col(CORRUPT).isNotNull()).select(*LINEAGE, CORRUPT, reason.alias("raison"))


def preview(spark: SparkSession, path: str, lines: int = 10) -> DataFrame:
    """The first lines of the first file by name that isn't empty, in file order.

    A compressed file is one split, whose first lines are read and no more. The splits of
    a plain file are ordered by where they begin.
    """
    first = manifest(spark, path).where("length > 0").agg(F.min("path")).first()[0]
    if first is None:
        return spark.createDataFrame([], "value string")
    text = spark.read.text(first)
    if first.endswith((".gz", ".bz2", ".zst", ".snappy", ".lz4")):
        return text.limit(lines)
    placed = text.select("value", F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_place"))
    return placed.orderBy("_start", "_place").limit(lines).select("value")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files below a folder with size and modification time; contents are never read.

    ``objet`` is the name that lines read from a file carry; it is spelt as a URI.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("objet"))
    )


def lineage(landed: DataFrame) -> DataFrame:
    """Lines and first and last second per object, from the lines' own metadata."""
    seconds = F.col("temps_secondes")
    return landed.groupBy(*LINEAGE).agg(F.count(F.lit(1)).alias("nb_lignes"), F.min(seconds).alias("premiere_seconde"), F.max(seconds).alias("derniere_seconde"))


IDENTITY = ["objet", "length", "modificationTime"]


def manifest_of(objects: DataFrame, landed: DataFrame) -> DataFrame:
    """The listed objects with what was landed of each; an object without lines has 0."""
    known = lineage(landed).withColumnsRenamed(dict(zip(LINEAGE, IDENTITY, strict=True)))
    joined = objects.join(known, IDENTITY, "left").withColumn("nb_lignes", F.coalesce("nb_lignes", F.lit(0)))
    return joined.select("objet", "path", "length", "modificationTime", "nb_lignes", "premiere_seconde", "derniere_seconde")


def not_landed(objects: DataFrame, landed: DataFrame) -> DataFrame:
    """Objects that a manifest doesn't know, or knows with another size or time."""
    return objects.join(landed, IDENTITY, "leftanti")
