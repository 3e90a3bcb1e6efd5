"""Tables in buckets of a key: joins and group-bys on that key need no shuffle.

A bucket is one file holding all rows of its keys, so write tables here that have few rows per
key, such as counts per (user, machine), and not the log by user. Tables joined to each other
need equal numbers of buckets. The files lie at a given path; the catalog only holds
how they are laid out, and `attach` tells it to another session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vigilog.operators.joins import shuffle_tasks


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int | None = None, name: str = "buckets") -> DataFrame:
    """Write rows by key, sorted in each bucket, and read them as such.

    As many buckets as tasks of a shuffle, if not said otherwise.
    """
    spark = df.sparkSession
    count = buckets or shuffle_tasks(spark)
    table = f"{name}_{uuid.uuid4().hex}"
    # Dealt out as the buckets are, so that a task writes one file.
    dealt = df.repartition(count, *keys)
    dealt.write.mode("overwrite").option("path", path).option("compression", "zstd").bucketBy(count, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:]).saveAsTable(table)
    return spark.table(table)


def attach(spark: SparkSession, path: str, keys: list[str], buckets: int, name: str = "buckets") -> DataFrame:
    """Bucketed files of another session, as they were written."""
    table = f"{name}_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
