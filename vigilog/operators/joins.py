"""Join building blocks that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Estimated in-memory size up to which a side is sent to every executor.
BROADCAST_LIMIT = 64 * 1024 * 1024
# What a hashed row costs beyond its text: pointers, fixed fields, padding.
ROW_OVERHEAD = 96
SALT_BUCKETS = 64
BLOCK_ROWS = 50_000


def estimated_bytes(df: DataFrame) -> int:
    """Measure a side: its row count and text volume, in one distributed pass."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    width = F.lit(ROW_OVERHEAD)
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()[0]


def fits_in_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    return limit > 0 and estimated_bytes(df) <= limit


def spread_lookup(left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str], how: str = "left") -> DataFrame:
    """Join to a table with one row per key, without gathering a hot key in one task.

    The left rows of a key are spread over salts taken from other columns. The right
    side is copied only to the (key, salt) pairs that occur, so rare keys are not
    multiplied, and the first join sees at most SALT_BUCKETS rows per key.
    """
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALT_BUCKETS)).alias("_salt")
    salted = left.select("*", salt)
    wanted = salted.select(*keys, "_salt").distinct().join(right, keys, "inner")
    return salted.join(wanted, [*keys, "_salt"], how).drop("_salt")


def join_least(left: DataFrame, rows: DataFrame, key: str, value: str, spread_by: str, name: str) -> DataFrame:
    """Add to ``left`` the smallest ``value`` that ``rows`` has for its key, as ``name``.

    Rows of a key are spread over salts taken from ``spread_by``, and what each salt has found
    is brought together, SALT_BUCKETS rows a key at most. Every pair of key and ``spread_by``
    in ``left`` has to be in ``rows``. The sides meet in a shuffle whatever their size: a side
    sent to all would first be gathered on the driver.
    """
    salt = F.pmod(F.xxhash64(spread_by), F.lit(SALT_BUCKETS)).alias("_salt")
    found = rows.select("*", salt).groupBy(key, "_salt").agg(F.min(value).alias(name))
    known = found.withColumn(name, F.min(name).over(Window.partitionBy(key)))
    return left.select("*", salt).join(known.hint("merge"), [key, "_salt"]).drop("_salt")


def shuffle_tasks(spark: SparkSession) -> int:
    """Tasks of a shuffle before AQE joins any: its initial number where that is set."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(tasks, int(initial)) if initial else tasks


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Emit each row ``times`` times (NULL or below 1: none) and drop that column.

    Rows are first cut into blocks of at most BLOCK_ROWS copies and the blocks dealt
    out one by one, so a key with billions of copies is written in parallel. The number
    of tasks is fixed: by bytes alone AQE would put many small blocks, hence very many
    copies, into one task.
    """
    tasks = shuffle_tasks(df.sparkSession)
    last_block = F.floor((F.col(times) - 1) / BLOCK_ROWS)
    blocks = df.where(F.col(times) > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block))
    )
    size = F.least(F.lit(BLOCK_ROWS).cast("long"), F.col(times) - F.col("_block") * BLOCK_ROWS)
    dealt = blocks.withColumn("_size", size).drop("_block").repartition(tasks)
    copies = F.explode(F.array_repeat(F.lit(True), F.col("_size").cast("int")))
    return dealt.withColumn("_copy", copies).drop("_copy", "_size", times)
