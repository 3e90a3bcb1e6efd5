from __future__ import annotations

import numpy as np
import pytest
from compare import assert_same

from vigilog.llm import vectors
from vigilog.llm.simhash import forest


def brute(rows):
    """Links and components by all cosines in double precision."""
    usable = [i for i, (_, v, l) in enumerate(rows) if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, left, right = [0] * len(rows), [], []
    for i in usable:
        for j in usable:
            if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    links[i] += 1
                    left.append(i)
                    right.append(j)
    root = forest(len(rows), np.array(left, int), np.array(right, int))
    return [(rows[i][0], links[i], rows[root[i]][0]) for i in range(len(rows))]


def planted(seed):
    draw = np.random.default_rng(seed)
    rows = []
    for group, size in enumerate((60, 5, 2, 2)):
        centre = draw.normal(size=32)
        rows += [(centre + draw.normal(size=32) * 0.09, group % 2) for _ in range(size)]
        rows += [(centre, group % 2)] * 3
    rows += [(draw.normal(size=32), int(draw.integers(0, 2))) for _ in range(150)]
    return [(i, np.float32(v).tolist(), label) for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("list_rows", [1024, 16])
def test_planted_groups_against_brute_force(spark, list_rows):
    rows = planted(3)
    found = sorted(tuple(r) for r in vectors.group(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"), list_rows=list_rows).collect())
    expected = sorted(brute(rows))
    linked, exact = sum(r[1] for r in found), sum(r[1] for r in expected)
    assert linked >= 0.97 * exact and all(f[1] <= e[1] for f, e in zip(found, expected, strict=True))
    assert sum(f[2] == e[2] for f, e in zip(found, expected, strict=True)) >= 0.97 * len(rows)
    assert all(kept == (i == c) for i, _, c, kept in found)


def test_recall_over_the_given_vectors(spark, sf_dir):
    found = {r.vec_id: r for r in vectors.query(spark, sf_dir).collect()}
    given = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected = {r[0]: r for r in brute(given)}
    assert set(found) == set(expected)
    assert sum(r.n_links for r in found.values()) >= 0.9 * sum(r[1] for r in expected.values())
    assert all(found[i].n_links <= r[1] for i, r in expected.items())


def test_equals_sql(spark, sf_dir, tmp_path):
    assert_same(vectors.query(spark, sf_dir), sf_dir, vectors.oracle())
    rows = [(i, v if i % 9 else v[:-1], label if i % 7 else None) for i, v, label in planted(8)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert_same(vectors.query(spark, str(tmp_path)), str(tmp_path), vectors.oracle())


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (None, [1.0, 0.01], 1), (10, [1.0, 0.0, 0.0], 1), (11, [], 1), (12, [1e300, 1e290], 3), (13, [1e-300, 0.0], 3),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, n_links string")
    found = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in vectors.group(df).collect())
    linked = {"1": (3, 1, True), "None": (3, 1, False), "12": (1, 12, True), "13": (1, 12, False)}
    expected = [(str(i), *linked.get(str(i), (0, i, True))) for i, _, _ in rows if i != 2] + [("2", 3, 1, False)] * 2
    assert found == sorted(expected)
    assert vectors.group(df.limit(0)).count() == 0


def test_lengths_without_pivots_are_compared_too(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MOST_LENGTHS", 3)
    draw = np.random.default_rng(12)
    rows = []
    for size in range(2, 12):
        for i in range(12):
            near = draw.standard_normal(size)
            rows += [(len(rows), near.tolist(), i % 2), (len(rows) + 1, (near * 1.001).tolist(), i % 2), (len(rows) + 2, (near + 0.3 * draw.standard_normal(size)).tolist(), i % 2)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    entries = table.selectExpr("embedding AS vector").distinct()
    assert len(vectors.find_pivots(entries)) == 3
    found = {r.vec_id: r.n_links for r in vectors.group(table, list_rows=8).collect()}
    unit = [(i, np.array(v) / np.linalg.norm(v), label) for i, v, label in rows]
    expected = {i: sum(j != i and len(w) == len(v) and other == label and float(v @ w) >= 0.98 for j, w, other in unit) for i, v, label in unit}
    assert found == expected and sum(found.values()) > 200


def clustered(draw, count, clusters, width, size=64):
    centres = vectors.unit(draw.standard_normal((clusters, size)))
    return vectors.unit(centres[draw.integers(0, clusters, count)] + width * draw.standard_normal((count, size)) / np.sqrt(size))


def mates(draw, rows, cosine):
    """Rows at exactly this cosine to the given ones."""
    across = draw.standard_normal(rows.shape)
    across = vectors.unit(across - (across * rows).sum(axis=1, keepdims=True) * rows)
    return cosine * rows + np.sqrt(1 - cosine**2) * across


def pivots_of(rows, count):
    return vectors.apart(rows[: 2 * count].astype(np.float32), count, float(np.cos(vectors.APART * np.arccos(vectors.THRESHOLD))))


@pytest.mark.parametrize("clusters, width", [(100, 0.8), (2000, 1.5)])
def test_lists_do_not_grow_with_the_table(clusters, width):
    cosines, copies = [], []
    for count in (10_000, 100_000):
        draw = np.random.default_rng(5)
        rows = clustered(draw, count, clusters, width)
        pivots = pivots_of(rows, vectors.pivot_counts({64: count})[64])
        labels = np.zeros(count, np.int64)
        _, sizes = np.unique(vectors.list_keys(rows, labels, pivots), return_counts=True)
        cosines.append((sizes.astype(float) ** 2).sum() / 2 / count)
        copies.append((sizes * np.ceil(sizes / vectors.LIST_ROWS)).sum() / count)
        some = rows[:3000]
        a, b = (vectors.list_keys(r, labels[:3000], pivots) for r in (some, mates(draw, some, 0.981)))
        assert (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean() >= 0.99
    assert cosines[1] <= 3 * cosines[0] and copies[1] <= 1.1 * copies[0]


def test_order_of_pivots_decides_the_lists():
    rows = vectors.unit(np.array([[5.0, 4, 3, 2, 1, 0.5, 0.2, 0.1], [0.1, 0.2, 0.5, 1, 2, 3, 4, 5]]))
    keys = vectors.list_keys(rows, np.zeros(2, np.int64), np.eye(8, dtype=np.float32))
    assert vectors.nearest_pivots(rows, np.eye(8, dtype=np.float32), 7).tolist() == [[0, 1, 2, 3, 4, 5, 6], [7, 6, 5, 4, 3, 2, 1]]
    # The pairs of ranks from 1 to 7 with a sum of 8 at most, and in reverse order those of other pivots.
    assert keys.shape == (2, 12) and all(len(set(k)) == 12 for k in keys.tolist())
    shared = {frozenset((a, b)) for b in range(1, 7) for a in range(b) if a + b + 2 <= 8} & {frozenset((7 - a, 7 - b)) for b in range(1, 7) for a in range(b) if a + b + 2 <= 8}
    assert len(set(keys[0].tolist()) & set(keys[1].tolist())) == len(shared)


def test_pivots_stay_within_their_bytes():
    assert vectors.pivot_counts({64: 1000, 32: 40}) == {64: 64, 32: 64}
    assert vectors.pivot_counts({64: 10_000})[64] == 250
    counts = vectors.pivot_counts({64: 10**11, 768: 10**10, 3: 5})
    assert counts[3] == 64 and sum(4 * size * (n - 64) for size, n in counts.items()) <= vectors.PIVOT_BYTES
    assert vectors.pivot_counts({}) == {}
