"""Shards by extendible hashing, in DataFrame functions only.

A row's place is the bits of a hash of its content. The directory starts with one bucket; only a
bucket of several rows whose bytes exceed the limit is split on the next bit, until every
bucket fits. Bytes and rows are counted per prefix of LEVEL_BITS bits, and all depths up to there are added up from
these counts; a cell that is still too large is counted again LEVEL_BITS deeper.

Rows that agree in every hash bit, such as copies of one row, cannot be split by bits. Such
a bucket becomes pages: its rows are dealt out by running numbers.

Nulls: a null counts as a value of its own in the hash, and a null text as 0 bytes, as an empty one. A very
long text is a shard of its own if it exceeds the limit alone. Ties and repeated rows share all bits. An
empty table gives no row. Input columns named like the added ones are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.sources.lake import materialise, scratch_path

LIMIT = 64 * 1024 * 1024
# The registered query's limit: one that its tables exceed many times at every size.
QUERY_LIMIT = 256 * 1024
LEVEL_BITS = 8
# Hash bits in all: the leading 14 hexadecimal digits of an MD5 digest.
HASH_BITS = 56
# Directory levels small enough to send out whatever the data: 2 ** 16 entries at most.
SENT_LEVELS = 2
NULL_TEXT = "\\N"
SEPARATOR = "\x1f"


def bits_of(columns: list[str]) -> Column:
    """HASH_BITS bits of the columns' texts; nulls count as a text of their own."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_TEXT)) for c in columns]
    digest = F.md5(F.concat_ws(SEPARATOR, *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def shift(bits: Column, by: Column | int) -> Column:
    return F.call_function("shiftright", bits, by if isinstance(by, Column) else F.lit(by)).cast("bigint")


def _buckets(cells: DataFrame, limit: int, above: int, depth: int) -> DataFrame:
    """(prefix, depth, bytes, full) of buckets, from bytes and rows per cell of ``depth`` bits.

    A bucket is the shallowest prefix of ``above`` or more bits that fits the limit or is
    one row. Cells too large at ``depth`` come back as they are, marked full.
    """
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(above), F.lit(depth))))
    prefix = shift(F.col("cell"), F.lit(depth) - F.col("depth"))
    summed = levels.groupBy("depth", prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    summed = summed.withColumn("full", (F.col("bytes") > limit) & (F.col("n") > 1))
    split = F.col("full") & (F.col("depth") < depth)
    parents = summed.where(split).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    leaves = summed.where(~split).withColumn("parent", shift(F.col("prefix"), 1))
    below = leaves.where(F.col("depth") > above).join(parents, ["depth", "parent"], "left_semi")
    return below.unionByName(leaves.where(F.col("depth") == above)).select("prefix", "depth", "bytes", "full")


def directory(sized: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(prefix, depth, bytes, full, level) of every bucket of rows (bits, bytes).

    Full buckets exceed the limit: their rows agree in every bit.
    """
    spark = sized.sparkSession
    found, rest = [], sized
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        depth = level * LEVEL_BITS
        cells = rest.groupBy(shift(F.col("bits"), HASH_BITS - depth).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
        buckets = materialise(_buckets(cells, limit, depth - LEVEL_BITS, depth), scratch_path(spark, "buckets"))
        if depth == HASH_BITS:
            found.append(buckets.withColumn("level", F.lit(level)))
            break
        large = buckets.where("full")
        found.append(buckets.where(~F.col("full")).withColumn("level", F.lit(level)))
        if large.isEmpty():
            break
        cell = shift(F.col("bits"), HASH_BITS - depth)
        rest = sized.withColumn("cell", cell).join(large.select(F.col("prefix").alias("cell")), "cell", "left_semi").select("bits", "bytes")
    return reduce(DataFrame.unionByName, found)


def _placed(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Rows with their bucket's prefix, depth and whether it cannot be split further.

    A level's buckets are spelt out as directory entries of the level's bits, so that each
    level is one equi-join; a row finds its entry at exactly one level.
    """
    last = buckets.agg(F.max("level")).first()[0] or 0
    for level in range(1, last + 1):
        depth = level * LEVEL_BITS
        width = shift(F.lit(1 << LEVEL_BITS).cast("bigint"), F.col("depth") - (depth - LEVEL_BITS))
        first = F.col("prefix") * width
        entries = buckets.where(F.col("level") == level).select(
            F.explode(F.sequence(first, first + width - 1)).alias(f"cell{level}"),
            F.struct("prefix", "depth", "full").alias(f"bucket{level}"),
        )
        if level <= SENT_LEVELS:
            entries = F.broadcast(entries)
        rows = rows.withColumn(f"cell{level}", shift(F.col("bits"), HASH_BITS - depth)).join(entries, f"cell{level}", "left")
    bucket = F.coalesce(*[F.col(f"bucket{i}") for i in range(1, last + 1)]) if last else F.lit(None).cast("struct<prefix:bigint,depth:int,full:boolean>")
    return rows.select("row", "bytes", bucket.alias("bucket")).select("row", "bytes", "bucket.*")


def _paged(rows: DataFrame, limit: int) -> DataFrame:
    """Deal rows of unsplittable buckets out into pages of at most the limit.

    Rows are numbered within bucket and reading task, and what the tasks before hold is
    added, so no bucket is gathered in one task.
    """
    rows = materialise(rows.withColumn("task", F.spark_partition_id()), scratch_path(rows.sparkSession, "unsplit"))
    keys = ["prefix", "depth"]
    totals = rows.groupBy(*keys, "task").agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("largest"))
    so_far = Window.partitionBy(*keys).orderBy("task")
    before = totals.select(
        *keys, "task", (F.sum("n").over(so_far) - F.col("n")).alias("before"), F.max("largest").over(Window.partitionBy(*keys)).alias("largest")
    )
    number = F.row_number().over(Window.partitionBy(*keys, "task").orderBy("bytes")) - 1
    per_page = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(limit) / F.col("largest")))
    page = F.floor((F.col("before") + F.col("number")) / per_page).cast("bigint")
    return rows.withColumn("number", number).join(before, [*keys, "task"]).select("row", "bytes", *keys, page.alias("page"))


def assign(docs: DataFrame, key: list[str], text: str = "text", limit: int = LIMIT, keep: list[str] | None = None) -> DataFrame:
    """Add ``shard`` (its hash prefix in binary digits), ``shard_depth``, ``page`` and ``n_bytes``.

    ``n_bytes`` is the UTF-8 size of the text, 0 for a null. ``key`` names the columns that are
    hashed. The rows of a (shard, page) hold at most ``limit`` bytes, unless it is one row
    that is larger alone. Pages other than 0 occur only where rows of equal key exceed
    the limit together; which copy gets which page is open. An empty table stays
    empty. Input columns named like the added ones are replaced.
    """
    spark = docs.sparkSession
    added = {"shard", "shard_depth", "page", "n_bytes"}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), bits_of(key).alias("bits"), size.alias("bytes"))
    buckets = materialise(directory(rows.select("bits", "bytes"), limit), scratch_path(spark, "directory"))
    placed = _placed(rows, buckets)
    paged = placed.where(~F.col("full")).select("row", "bytes", "prefix", "depth", F.lit(0).cast("bigint").alias("page"))
    if not buckets.where("full").isEmpty():
        paged = paged.unionByName(_paged(placed.where("full").drop("full"), limit))
    digits = F.lpad(F.bin("prefix"), HASH_BITS, "0")
    return paged.select("row.*", F.substr(digits, F.lit(HASH_BITS + 1) - F.col("depth"), F.col("depth")).alias("shard"), F.col("depth").alias("shard_depth"), "page", F.col("bytes").alias("n_bytes"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard and page; each is written by one task, and fits the limit."""
    assigned.repartition("shard", "page").write.partitionBy("shard", "page").option("compression", "zstd").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return assign(docs, ["doc_id", "text"], limit=QUERY_LIMIT, keep=["doc_id"])


def oracle(limit: int = QUERY_LIMIT) -> str:
    """The same shards in SQL, where all rows differ: every depth is added up for itself."""
    return f"""
WITH hashed AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
    CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '\\N') || chr(31) || coalesce(text, '\\N')), {HASH_BITS // 4}) AS BIGINT) AS bits
  FROM documents),
levels AS (
  SELECT depth, bits >> ({HASH_BITS} - depth) AS prefix, sum(n_bytes) AS total, count(*) AS n
  FROM hashed CROSS JOIN range(0, {HASH_BITS + 1}) AS d(depth) GROUP BY ALL),
own AS (
  SELECT h.doc_id, h.bits, h.n_bytes, min(l.depth) AS depth
  FROM hashed h JOIN levels l ON l.prefix = h.bits >> ({HASH_BITS} - l.depth) AND (l.total <= {limit} OR l.n = 1 OR l.depth = {HASH_BITS})
  GROUP BY ALL)
SELECT doc_id, right(lpad(bin(bits >> ({HASH_BITS} - depth)), {HASH_BITS}, '0'), CAST(depth AS INTEGER)) AS shard,
  CAST(depth AS INTEGER) AS shard_depth, CAST(0 AS BIGINT) AS page, CAST(n_bytes AS BIGINT) AS n_bytes
FROM own"""
