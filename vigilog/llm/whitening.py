"""Whitening vectors along the leading components of their covariance.

Vectors are put on a grid of whole numbers, and every distinct one counts once in the fit. Its
sums are exact; its covariance adds up products of centred numbers. The leading components
come from spectrum slicing: the signs in an LDLᵀ factorisation of the shifted covariance
tell how many eigenvalues lie above a shift, so halving isolates each one by its number;
Rayleigh quotient iteration then converges cubically to it, and two more counts certify that the
value found is the one with that number. Eigenvalues too close to be told apart are taken
together: any orthonormal basis of their space will do.

Nulls: null vectors and vectors with null or non-finite entries are dropped; a null id is kept.
Empty vectors have no component, so no row. Vectors of each length are fitted on their own, so an unusual
length neither fails nor disturbs the others; very long vectors cost the square of
their length. Ties: equal vectors get equal rows, and each component's largest entry
(the first of ties) is positive. Repeated rows count once in the fit and are all returned. Components
without variance, as of a single distinct vector, are left out. An empty table gives no row. Numbers beyond
the grid's 62 bits are set to its ends; a deviation beyond a long is null in ``deviation``
and exact in ``deviation_wide`` (null beyond 38 digits). Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm import common
from vigilog.sources.lake import materialise, scratch_path

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
FARTHEST = float(1 << 62)
# Part of the largest eigenvalue below which one counts as zero, for each dimension.
ZERO = 8 * np.finfo(float).eps
# Width, relative to the largest eigenvalue, at which eigenvalues count as one.
TOGETHER = 64 * np.finfo(float).eps
ITERATIONS = 40
WIDEST = 10**38
# Values of vectors that a numpy step holds at once.
STEP_VALUES = 1 << 18


def complete(vector: Column) -> Column:
    """Whether a vector is not null and holds only finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd, F.lit(False))


def grid(vector: Column) -> Column:
    """Whole numbers for the entries of a vector."""
    scaled = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(FARTHEST)), F.lit(-FARTHEST))))
    return F.transform(scaled, lambda c: c.cast("long") + F.lit(SHIFT).cast("long"))


def inertia(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``: positive pivots of LDLᵀ.

    Pivots are chosen on the diagonal, or as a block of two, so that entries don't grow
    (Bunch and Kaufman); a block's two eigenvalues have different signs.
    """
    rest = matrix - shift * np.eye(len(matrix))
    bound, above = (1 + 17**0.5) / 8, 0
    tiny = np.finfo(float).eps * max(np.abs(rest).max(initial=0.0), 1e-300)
    while len(rest):
        column = np.abs(rest[1:, 0])
        place = int(np.argmax(column)) + 1 if len(column) else 0
        largest = column[place - 1] if len(column) else 0.0
        pivot, size = 0, 1
        if abs(rest[0, 0]) < bound * largest:
            other = np.abs(rest[place])
            other[place] = 0.0
            if abs(rest[0, 0]) * other.max() < bound * largest**2:
                pivot, size = (place, 1) if abs(rest[place, place]) >= bound * other.max() else (place, 2)
        if size == 1:
            if pivot:
                rest[[0, pivot]] = rest[[pivot, 0]]
                rest[:, [0, pivot]] = rest[:, [pivot, 0]]
            head = rest[0, 0] if abs(rest[0, 0]) > tiny else -tiny
            above += head > 0
            rest = rest[1:, 1:] - np.outer(rest[1:, 0], rest[0, 1:]) / head
        else:
            rest[[1, pivot]] = rest[[pivot, 1]]
            rest[:, [1, pivot]] = rest[:, [pivot, 1]]
            above += 1
            rest = rest[2:, 2:] - rest[2:, :2] @ np.linalg.solve(rest[:2, :2], rest[:2, 2:])
    return above


def _iterate(matrix: np.ndarray, start: float, known: np.ndarray, seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from a shift, in the space that ``known`` leaves."""
    size = len(matrix)
    vector = np.random.default_rng(seed).standard_normal(size)
    value, scale = start, max(np.abs(matrix).max(), 1e-300)
    for step in range(ITERATIONS):
        vector -= known.T @ (known @ vector)
        vector /= np.linalg.norm(vector)
        # The first steps keep the shift, which lies near the wanted eigenvalue alone.
        if step > 2:
            value = float(vector @ matrix @ vector)
            if np.linalg.norm(matrix @ vector - value * vector) <= 4 * np.finfo(float).eps * scale * size**0.5:
                break
        try:
            vector = np.linalg.solve(matrix - value * np.eye(size), vector)
        except np.linalg.LinAlgError:
            vector = np.linalg.solve(matrix - (value + np.finfo(float).eps * scale) * np.eye(size), vector)
        vector /= np.abs(vector).max()
    vector -= known.T @ (known @ vector)
    vector /= np.linalg.norm(vector)
    return float(vector @ matrix @ vector), vector


def leading(matrix: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest positive eigenvalues of a covariance, falling, and their unit vectors as rows."""
    size = len(matrix)
    values, vectors = np.zeros(0), np.zeros((0, size))
    if not size:
        return values, vectors
    # No eigenvalue lies beyond the largest sum of a row; those up to the floor count as zero.
    top = float(np.abs(matrix).sum(axis=1).max())
    floor = max(ZERO * size * top, 0.0)
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(matrix, shift)
        return counts[shift]

    width = TOGETHER * top
    wanted = min(count, above(floor)) if top > 0 else 0
    while len(values) < wanted:
        number = len(values) + 1
        # The narrowest slice known to hold this number, from all counts so far.
        low = max(s for s, n in counts.items() if n >= number)
        high = min((s for s, n in counts.items() if n < number), default=top + width)
        while above(low) - (above(high) if high < top else 0) > 1 and high - low > width:
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= number else (low, middle)
        together = above(low) - (above(high) if high < top else 0)
        if together == 1:
            # Nearer to the wanted value than to its neighbours, which may lie just outside.
            for _ in range(4):
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= number else (low, middle)
        while True:
            found = [_iterate(matrix, (low + high) / 2, vectors, number)]
            for k in range(1, together):
                known = np.concatenate([vectors, [v for _, v in found]])
                found.append(_iterate(matrix, (low + high) / 2, known, number + k))
            inside = all(low - width <= value <= high + width for value, _ in found)
            # Counted on both sides of the value: it has the number it was looked for.
            if inside and above(found[0][0] + width) < number <= above(min(v for v, _ in found) - width):
                break
            if high - low <= width:
                break
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= number else (low, middle)
        found.sort(key=lambda pair: -pair[0])
        values = np.append(values, [v for v, _ in found])
        vectors = np.concatenate([vectors, [v for _, v in found]])
    values, vectors = values[:wanted], vectors[:wanted]
    for row in vectors:
        if row[np.argmax(np.abs(row))] < 0:
            row *= -1
    return values, vectors


@dataclass(frozen=True)
class Model:
    """What is known of the vectors of one length."""

    count: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def offsets(self, rows: np.ndarray) -> np.ndarray:
        """n x - S for rows of whole numbers, exactly: as longs where they fit, else as Python's numbers."""
        widest = max((abs(s) for s in self.sums), default=0)
        if self.count * max(int(np.abs(rows).max(initial=0)), 1) + widest < 1 << 62:
            return self.count * rows - np.array(self.sums, dtype=np.int64)
        return self.count * rows.astype(object) - np.array(self.sums, dtype=object)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return self.offsets(rows).astype(np.float64) / self.count

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return (self.centred(rows) @ self.vectors.T) / np.sqrt(self.values)

    def deviations(self, rows: np.ndarray) -> list[int]:
        offsets = self.offsets(rows)
        if offsets.dtype != object and int(np.abs(offsets).max(initial=0)) ** 2 * max(rows.shape[1], 1) < 1 << 62:
            return (offsets * offsets).sum(axis=1).tolist()
        return [sum(int(d) ** 2 for d in row) for row in offsets]


def _by_length(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches with places of vectors of one length, and these vectors as a matrix, a bounded number at once."""
    for batch in batches:
        sizes = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            places = np.flatnonzero(sizes == size)
            step = max(1, STEP_VALUES // max(int(size), 1))
            for start in range(0, len(places), step):
                some = places[start : start + step]
                flat = batch.column(column).take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)
                yield batch, some, flat.reshape(len(some), int(size))


def _added_up(rows: DataFrame, measure, kind: str) -> DataFrame:
    """(size, place, value): numbers measured on a matrix of vectors of one length, summed over all.

    Each task hands on one row for each length and place, however many vectors it read.
    """
    common.ship_code(rows.sparkSession)
    arrow = pa.decimal128(38, 0) if kind.startswith("decimal") else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, _, matrix in _by_length(batches, 0):
            size = matrix.shape[1]
            more = measure(matrix)
            held[size] = held[size] + more if size in held else more
        for size, numbers in held.items():
            values = [Decimal(int(v)) for v in numbers] if kind.startswith("decimal") else numbers
            columns = [pa.array(np.full(len(numbers), size, np.int32)), pa.array(np.arange(len(numbers), dtype=np.int32)), pa.array(values, arrow)]
            yield pa.RecordBatch.from_arrays(columns, names=["size", "place", "value"])

    found = rows.mapInArrow(run, f"size int, place int, value {kind}")
    return found.groupBy("size", "place").agg(F.sum("value").cast(kind).alias("value"))


def _count_and_sums(matrix: np.ndarray) -> np.ndarray:
    """The number of rows, then the sum of each column, beyond longs where need be."""
    exact = matrix if int(np.abs(matrix).max(initial=0)) * max(len(matrix), 1) < 1 << 62 else matrix.astype(object)
    return np.concatenate([np.array([len(matrix)], dtype=object), exact.sum(axis=0).astype(object)])


def _upper(matrix: np.ndarray) -> np.ndarray:
    return matrix[np.triu_indices(len(matrix))]


def _square(numbers: np.ndarray, size: int) -> np.ndarray:
    found = np.zeros((size, size))
    found[np.triu_indices(size)] = numbers
    return found + np.triu(found, 1).T


def distinct(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Every vector on the grid once, as ``x``. Copies are dropped before and after the shuffle."""
    return vectors.where(complete(F.col(vector))).select(grid(F.col(vector)).alias("x")).distinct()


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Model]:
    """A model per vector length.

    Every distinct vector counts. A length's sums and the upper half of its covariance reach
    the driver: numbers by the square of the vector's length, not by the table's.
    """
    spark = vectors.sparkSession
    fitted = materialise(distinct(vectors, vector), scratch_path(spark, "grid"))
    sums: dict[int, dict[int, int]] = {}
    for size, place, value in _added_up(fitted, _count_and_sums, "decimal(38,0)").collect():
        sums.setdefault(size, {})[place] = int(value)
    known = {size: Model(found[0], [found[i + 1] for i in range(size)], np.zeros(0), np.zeros((0, size)), np.zeros(0)) for size, found in sums.items()}

    def products(matrix: np.ndarray) -> np.ndarray:
        centred = known[matrix.shape[1]].centred(matrix)
        return _upper(centred.T @ centred)

    # One length after the other, so that one covariance is held at a time.
    covariances = _added_up(fitted, products, "double") if any(known) else None
    if covariances is not None and len(known) > 1:
        covariances = materialise(covariances, scratch_path(spark, "covariances"))
    models = {}
    for size, model in known.items():
        if not size:
            continue
        rows = covariances.where(F.col("size") == size).select("place", "value").toArrow()
        numbers = np.zeros(size * (size + 1) // 2)
        numbers[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
        covariance = _square(numbers, size) / model.count
        values, found = leading(covariance, components)
        if len(values):
            models[size] = Model(model.count, model.sums, values, found, values / np.trace(covariance))
    return _certified(fitted, models)


def _certified(fitted: DataFrame, models: dict[int, Model]) -> dict[int, Model]:
    """Models with their identity error: how far whitening the fit list is from unit covariance."""

    def products(matrix: np.ndarray) -> np.ndarray:
        model = models.get(matrix.shape[1])
        if model is None:
            return np.zeros(0)
        # Centred on the exact mean, hence of mean zero themselves.
        white = model.whitened(matrix)
        return _upper(white.T @ white)

    found: dict[int, np.ndarray] = {size: np.zeros(len(m.values) * (len(m.values) + 1) // 2) for size, m in models.items()}
    if models:
        for size, place, value in _added_up(fitted, products, "double").collect():
            found[size][place] = value
    out = {}
    for size, model in models.items():
        width = len(model.values)
        error = float(np.abs(_square(found[size], width) / model.count - np.eye(width)).max())
        out[size] = Model(model.count, model.sums, model.values, model.vectors, model.explained, error)
    return out


def whiten(vectors: DataFrame, models: dict[int, Model], vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened,
    explained, identity_error, deviation_wide. A length without a model gives no row."""
    common.ship_code(vectors.sparkSession)
    rows = vectors.where(complete(F.col(vector))).select(F.col(vec_id).alias("vec_id"), grid(F.col(vector)).alias("x"))
    kind = dict(rows.dtypes)["vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, places, matrix in _by_length(common.slices(batches), 1):
            model = models.get(matrix.shape[1])
            if model is None:
                continue
            width, count = len(model.values), len(places)
            each = np.repeat(np.arange(count), width)
            exact = model.deviations(matrix)
            narrow = pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())
            wide = pa.array([Decimal(d) if d < WIDEST else None for d in exact], pa.decimal128(38, 0))
            columns = [
                batch.column(0).take(pa.array(places[each])),
                pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), count)),
                pa.array(np.full(count * width, model.count, np.int64)),
                narrow.take(pa.array(each)),
                pa.array(model.whitened(matrix).ravel()),
                pa.array(np.tile(model.explained, count)),
                pa.array(np.full(count * width, model.identity_error)),
                wide.take(pa.array(each)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_wide"])

    return rows.mapInArrow(
        run, f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, deviation_wide decimal(38,0)"
    )


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whiten(vectors, fit(vectors))
