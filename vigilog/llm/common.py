"""What the operators share: code shipping, blocks of texts, Arrow mapping, sampling."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

ROOT = Path(__file__).resolve().parents[2]
# Texts handled together by one numpy step: bounds the arrays a task holds at once.
BLOCK_CHARS = 1 << 18
BLOCK_TEXTS = 512
# Rows of an Arrow batch turned into Python values at once.
SLICE_ROWS = 1024
# A text beyond this is counted in pieces.
PIECE_CHARS = 1 << 20
BLANKS = " \t\n\v\f\r"
BLANK = re.compile(r"[ \t-\r]")

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the session was started.

    Nothing is sent where the package's folder is the working directory or on PYTHONPATH.
    """
    context = spark.sparkContext
    known = [Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    if ROOT in known or context.applicationId in _shipped:
        return
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="vigilog-code-")), "vigilog.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted((ROOT / "vigilog").rglob("*.py")):
            archive.write(source, source.relative_to(ROOT))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def pieces(text: str) -> Iterator[tuple[str, int]]:
    """A long text as (piece, 1) and (overlap, -1): each piece but the first begins with the last
    word of the one before, and that word is what is taken off again.

    So counts of anything within a word, between two neighbouring words or along three characters
    add up to those of the whole text. A text without blanks stays whole.
    """
    start = 0
    while len(text) - start > PIECE_CHARS:
        at, word = start + PIECE_CHARS, start
        while word <= start:
            cut = BLANK.search(text, at)
            if cut is None:
                yield text[start:], 1
                return
            at = cut.end()
            end = start + len(text[start : cut.start()].rstrip(BLANKS))
            word = 1 + max(text.rfind(blank, start, end) for blank in BLANKS)
        yield text[start:at], 1
        yield text[word:at], -1
        start = word
    yield text[start:], 1


def counts_of(block: list[str], measure: Callable[[list[str]], np.ndarray]) -> np.ndarray:
    """``measure`` of a block's texts, one row each; a long text is measured piece by piece."""
    if len(block) == 1 and len(block[0]) > PIECE_CHARS:
        total = 0
        for piece, sign in pieces(block[0]):
            total = total + sign * measure([piece])
        return total
    return measure(block)


def sparse_counts(rows: DataFrame, text: str, measure: Callable[[list[str]], np.ndarray], keep: list[str]) -> DataFrame:
    """Columns ``keep`` with the counts of each text that aren't 0, as ``places`` and ``counts``.

    Counted where the texts are read, so whoever gathers rows gathers numbers, as many as the
    measure has at most, however long the texts are.
    """
    ints = ArrayType(IntegerType())

    def compute(values: dict[str, list]) -> list[pa.Array]:
        places, numbers = [], []
        for _, block in text_blocks(values[text]):
            for row in counts_of(block, measure):
                hit = np.flatnonzero(row)
                places.append(hit.astype(np.int32))
                numbers.append(np.minimum(row[hit], np.iinfo(np.int32).max).astype(np.int32))
        return [pa.array(places, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int32()))]

    return add_columns(rows, [text], StructType([StructField("places", ints), StructField("counts", ints)]), compute, keep)


def dense_counts(table: pa.Table, width: int) -> np.ndarray:
    """The matrix behind rows of ``sparse_counts``."""
    found = np.zeros((table.num_rows, width), dtype=np.int64)
    for row, (places, numbers) in enumerate(zip(table.column("places").to_pylist(), table.column("counts").to_pylist(), strict=True)):
        found[row, places] = numbers
    return found


def text_blocks(texts: list[str | None], chars: int = BLOCK_CHARS, count: int = BLOCK_TEXTS) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts with their first index; a longer text is a block of its own.

    A null text counts as empty.
    """
    start, held, block = 0, 0, []
    for index, text in enumerate(texts):
        text = text or ""
        if block and (held + len(text) > chars or len(block) >= count):
            yield start, block
            start, held, block = index, 0, []
        block.append(text)
        held += len(text)
    if block:
        yield start, block


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop columns whose names an operator is about to write; its own columns win."""
    taken = {name.lower() for name in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def add_columns(
    df: DataFrame, inputs: list[str], added: StructType, compute: Callable[[dict[str, list]], list[pa.Array]], keep: list[str] | None = None
) -> DataFrame:
    """Rows of ``df`` with columns computed from whole Arrow batches.

    ``compute`` gets the input columns as lists and returns one Arrow array per added
    field. ``keep`` names the columns carried along (default: all). Row order within a
    batch is kept, so repeated rows and null keys need no key to be matched up.
    """
    ship_code(df.sparkSession)
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in {n.lower() for n in added.names}]
    # Inputs get names of their own, so that a replaced column can still be read.
    source = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(inputs)])
    width = len(kept)
    names = list(added.names)
    schema = StructType([*source.schema.fields[:width], *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = {c: batch.column(width + i).to_pylist() for i, c in enumerate(inputs)}
            arrays = compute(values)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *arrays], names=[*kept, *names])

    return source.mapInArrow(run, schema)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of a column's text, modulo a number; null for a null value."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def label_totals(rows: DataFrame, label: str, most: int) -> dict | None:
    """Rows per label value; None where there are more values than ``most``."""
    found = rows.where(F.col(label).isNotNull()).groupBy(label).count().limit(most + 1).collect()
    return None if len(found) > most else {value: total for value, total in sorted(found)}


def sample_per_label(rows: DataFrame, label: str, totals: dict | None, per_label: int, identity: list[str]) -> DataFrame:
    """At most ``per_label`` rows of each label value, the same ones on every run.

    A first cut by hash leaves about half as many again, so little is sorted however
    common a label is; the exact cut then takes the lowest hashes and is combined before
    the shuffle. Rows of equal identity share a hash. Without totals there is no first cut.
    """
    known = rows.where(F.col(label).isNotNull())
    if totals is None:
        return first_per_label(known, label, per_label, identity)
    if not totals:
        return rows.limit(0)
    # Bits the order of the exact cut doesn't begin with.
    draw = F.pmod(F.xxhash64(*identity), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.create_map(*[F.lit(x) for value, total in totals.items() for x in (value, 1.5 * per_label / total)])
    return first_per_label(known.where(draw < share[F.col(label)]), label, per_label, identity)


def first_per_label(rows: DataFrame, label: str, per_label: int, identity: list[str]) -> DataFrame:
    """The ``per_label`` rows of each label with the lowest hashes of their identity."""
    place = F.row_number().over(Window.partitionBy(label).orderBy(F.xxhash64(*identity), *identity))
    return rows.withColumn("__place", place).where(F.col("__place") <= per_label).drop("__place")


def float_rows(matrix: np.ndarray) -> pa.Array:
    """A float matrix as an Arrow list column."""
    count, width = matrix.shape
    offsets = pa.array(np.arange(count + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix, dtype=np.float32).ravel()))


def sum_over_texts(rows: DataFrame, text: str, measure: Callable[[list[str]], np.ndarray], width: int) -> tuple[np.ndarray, int]:
    """Sum of a vector over all texts, and the number of rows.

    Each task adds up its own texts, so at most ``width`` + 1 rows leave a task, and as
    many reach the driver, whatever was read.
    """
    ship_code(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 1, dtype=np.int64)
        for batch in slices(batches):
            for _, block in text_blocks(batch.column(0).to_pylist()):
                total[:width] += measure(block)
            total[width] += batch.num_rows
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=["place", "n"])

    summed = rows.select(text).mapInArrow(run, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    vector = np.zeros(width + 1, dtype=np.int64)
    for place, n in summed.collect():
        vector[place] = n
    return vector[:width], int(vector[width])
