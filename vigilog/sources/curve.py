"""A log ordered along a space-filling curve, so that readers of few pairs skip most of it.

Users and machines are cut into ranges of equally many names; the bits of a row's two range
numbers, interleaved, are its cell. Within each day rows are ordered by cell, so a file and
each of its row groups hold few cells: neighbouring users on neighbouring machines. The
cells of the wanted pairs become a filter of a few intervals on that column, which Parquet's
statistics decide without reading the rows.

A cell with very many rows is cut by their second. Null names are in the first range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.functions.columns import calendar_day
from vigilog.operators.joins import shuffle_tasks
from vigilog.sources.lake import DAY_PARTITION, FILE_ROWS, write_table

CELL = "cellule"
AXES = ("source_user_domain", "destination_computer")
# Bits of a range number: 64 ranges of names, 4,096 cells.
BITS = 6
# Intervals of cells in a filter; beyond, the nearest ones are joined.
MOST_INTERVALS = 64
ROW_GROUP_BYTES = 8 * 1024 * 1024


def name_ranges(log: DataFrame, column: str, bits: int = BITS) -> list[str]:
    """First names of all ranges but the first: at most 2 ** bits - 1 strings, in order."""
    count = 1 << bits
    names = log.select(F.col(column).alias("name")).where("name IS NOT NULL").distinct()
    # Spark's own range partitioning; a range's number is its partition.
    firsts = names.repartitionByRange(count, "name").groupBy(F.spark_partition_id().alias("range")).agg(F.min("name").alias("first"))
    return sorted(row["first"] for row in firsts.collect())[1:]


def range_number(name: Column, firsts: list[str]) -> Column:
    """How many ranges begin at or before a name, by halving."""
    if not firsts:
        return F.lit(0)
    middle = len(firsts) // 2
    above = range_number(name, firsts[middle + 1 :]) + F.lit(middle + 1)
    return F.when(name >= F.lit(firsts[middle]), above).otherwise(range_number(name, firsts[:middle]))


def cell(names: list[Column], ranges: list[list[str]], bits: int = BITS) -> Column:
    """The place on the curve: the bits of the range numbers, in turns."""
    numbers = [range_number(name, firsts) for name, firsts in zip(names, ranges, strict=True)]
    parts = [
        F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)), len(numbers) * bit + axis) for bit in range(bits) for axis, number in enumerate(numbers)
    ]
    return reduce(Column.bitwiseOR, parts).cast("int")


def write_along_curve(log: DataFrame, path: str, file_rows: int = FILE_ROWS) -> None:
    """Lay a log out by day and, within each day, along the curve; the ranges are kept beside it.

    One shuffle by ranges of (day, cell, second).
    """
    ranges = [name_ranges(log, column) for column in AXES]
    spark = log.sparkSession
    kept = [(axis, place, first) for axis, firsts in zip(AXES, ranges, strict=True) for place, first in enumerate(firsts)]
    write_table(spark.createDataFrame(kept, "axe string, place int, debut string").coalesce(1), f"{path}/plages")
    placed = log.withColumn(CELL, cell([F.col(a) for a in AXES], ranges))
    if DAY_PARTITION not in log.columns:
        placed = placed.withColumn(DAY_PARTITION, calendar_day(F.col("temps_secondes")))
    order = [DAY_PARTITION, CELL, "temps_secondes"]
    dealt = placed.repartitionByRange(shuffle_tasks(spark), *order).sortWithinPartitions(*order)
    writer = dealt.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", file_rows)
    writer.option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(DAY_PARTITION).parquet(f"{path}/lignes")


def read_along_curve(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/lignes")


def intervals(cells: list[int], most: int = MOST_INTERVALS) -> list[tuple[int, int]]:
    """Cells as intervals; the smallest gaps are closed until there are at most ``most``."""
    found = [(c, c) for c in sorted(set(cells))]
    if len(found) <= 1:
        return found
    gaps = sorted(range(1, len(found)), key=lambda i: (found[i][0] - found[i - 1][1], i), reverse=True)
    wide = sorted(i for i in gaps[: most - 1] if found[i][0] - found[i - 1][1] > 1)
    edges = [0, *wide, len(found)]
    return [(found[a][0], found[b - 1][1]) for a, b in zip(edges, edges[1:], strict=False)]


def read_for_pairs(spark: SparkSession, path: str, pairs: DataFrame, names: tuple[str, str] = AXES) -> DataFrame:
    """Rows of the cells that the given pairs lie in: all rows of these pairs, and neighbours.

    Only numbers of cells reach the driver, at most 2 ** (2 * BITS).
    """
    kept = spark.read.parquet(f"{path}/plages").collect()
    ranges = [[row["debut"] for row in sorted(kept, key=lambda r: r["place"]) if row["axe"] == axis] for axis in AXES]
    wanted = pairs.select(cell([F.col(n) for n in names], ranges).alias(CELL)).distinct().collect()
    log = read_along_curve(spark, path)
    spans = [F.col(CELL).between(low, high) for low, high in intervals([row[CELL] for row in wanted])]
    return log.where(reduce(Column.__or__, spans)) if spans else log.limit(0)
