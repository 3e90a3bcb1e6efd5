"""Tables replaced in one step, together.

Every write of a table is a folder of its own, which nothing reads until a pointer names it. The
pointers of all tables written together are one small file, added last to a table of
pointers that is only ever added to: readers see all of them or none, and between two writes
every table stays readable. A job that ends midway leaves folders that nothing points to.

One job publishes at a time. Paths are kept relative to the lake, so a lake can be moved.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilog.sources.lake import POINTER, Lake, discard, pointers, write_all

# Versions of a table that `vacuum` leaves: the current one, and one for readers still on the former.
KEPT = 2


class Draft:
    """A set of tables on its way to being published together."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark, self.lake = spark, lake
        self.folder = f"{lake.VERSIONS}/{uuid.uuid4().hex}"
        self.written: dict[str, str] = {}

    def write(self, tables: dict[str, DataFrame]) -> None:
        """Write tables into the draft, independent ones together; may be called again for others."""
        paths = {name: f"{self.folder}/{name}.parquet" for name in tables}
        write_all({f"{self.lake.base}/{path}": tables[name] for name, path in paths.items()})
        self.written.update(paths)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.lake.base}/{self.written[table]}")

    def publish(self) -> None:
        """Point to all written tables, in one file."""
        known = pointers(self.spark, self.lake)
        last = known.agg(F.max("numero")).first()[0] if known is not None else None
        rows = [((last or 0) + 1, name, path) for name, path in sorted(self.written.items())]
        added = self.spark.createDataFrame(rows, POINTER).coalesce(1)
        added.write.mode("append").parquet(self.lake.pointers())


def vacuum(spark: SparkSession, lake: Lake, kept: int = KEPT) -> list[str]:
    """Delete versions beyond the ``kept`` latest ones of each table; returns the paths deleted.

    Tables go before the pointers to them, so that it can be run again after an end midway. A
    file of pointers goes when none of its tables is left.
    """
    known = pointers(spark, lake)
    if known is None:
        return []
    newest_first = Window.partitionBy("table").orderBy(F.desc("numero"), F.desc("chemin"))
    ranked = known.select("*", F.col("_metadata.file_path").alias("file")).withColumn("rank", F.row_number().over(newest_first)).collect()
    old = [row for row in ranked if row["rank"] > kept]
    needed = {row["file"] for row in ranked if row["rank"] <= kept}
    gone = discard(spark, {f"{lake.base}/{row['chemin']}" for row in old})
    folders = [{row["chemin"].rsplit("/", 1)[0] for row in ranked if (row["rank"] > kept) == is_old} for is_old in (True, False)]
    discard(spark, {f"{lake.base}/{folder}" for folder in folders[0] - folders[1]})
    discard(spark, {row["file"] for row in old} - needed)
    return gone

