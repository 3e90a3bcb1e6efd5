from __future__ import annotations

import re

import edges
import numpy as np
import pytest
import xxhash

from vigilog.llm import components, simhash


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_groups(prints, threshold=3):
    values = np.array(prints, dtype=np.uint64)
    left, right = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= threshold)
    return simhash.forest(len(values), left, right)


def test_whole_texts_against_brute_force(spark, sf_dir):
    rows = sorted(simhash.query(spark, sf_dir).collect())
    texts = sorted(edges.texts_of(spark, sf_dir))
    prints = [brute_print(t) for _, t in texts]
    roots = brute_groups(prints)
    assert [tuple(r) for r in rows] == [(i, f"{p:016x}", texts[root][0]) for (i, _), p, root in zip(texts, prints, roots, strict=True)]
    assert len(set(roots)) < len(roots)


def crowd(seed, centres=3, size=120):
    """Fingerprints in dense groups, chains between them, and strangers."""
    draw = np.random.default_rng(seed)
    out = set()
    for _ in range(centres):
        value = int(draw.integers(0, 2**63))
        for _ in range(size):
            out.add(value ^ sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 3), replace=False)))
        for _ in range(6):
            value ^= sum(1 << int(b) for b in draw.choice(64, 3, replace=False))
            out.add(value)
    return sorted(out | {int(x) for x in draw.integers(0, 2**63, 200)})


@pytest.mark.parametrize("threshold", [0, 1, 2, 3, 4])
def test_links_are_complete_at_any_list_size(spark, threshold):
    values = crowd(threshold)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "v bigint")
    roots = brute_groups(values, threshold)
    for cell_rows in (2048, 4) if threshold < 4 else (2048,):
        links = simhash.link_fingerprints(df, "v", threshold, cell_rows)
        parts = dict(tuple(r) for r in components.connected(links, "left", "right").collect())
        found = [parts.get(v, v) for v in signed]
        assert len({(f, int(r)) for f, r in zip(found, roots, strict=True)}) == len(set(found)) == len(set(roots.tolist()))


def test_anchors_cover_every_close_pair():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 2**63, 300).astype(np.int64)
    owner, number = simhash.anchors(values, 2)
    for i, value in enumerate(values.tolist()):
        other = value ^ sum(1 << int(b) for b in draw.choice(63, draw.integers(0, 4), replace=False))
        _, theirs = simhash.anchors(np.array([other], dtype=np.int64), 2)
        assert set(number[owner == i]) & set(theirs)


def test_awkward_rows(spark):
    rows = simhash.group(edges.frame(spark), keep=["lang"]).collect()
    assert len(rows) == len(edges.TEXTS)
    empty = [r for r in rows if r.fingerprint_bits == 0]
    assert len(empty) == 4 and {r.component_id for r in empty} == {2}
    assert {r.component_id for r in rows if r.doc_id in (1, 8)} == {1}
    alone = [r for r in rows if r.doc_id is None and r.fingerprint_bits != 0]
    assert [r.component_id for r in alone] == [None]
    assert simhash.group(edges.frame(spark, [])).count() == 0


def test_one_row_of_each_group_stays(spark):
    kept = simhash.keep_one(edges.frame(spark))
    assert kept.columns == edges.frame(spark).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "5", "6", "7", "None"])
    assert simhash.keep_one(edges.frame(spark, [])).count() == 0


def test_the_driver_holds_no_side_of_a_join(spark, monkeypatch):
    """Not even of small tables, nor a plan of several stars: its memory is the same for any number of links."""
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    for module in (components, simhash):
        monkeypatch.setattr(module, "materialise", lambda df, path, write=module.materialise: write(planned(df), path))
    values = spark.createDataFrame([(v,) for v in np.array(crowd(7), dtype=np.uint64).view(np.int64).tolist()], "v bigint")
    links = planned(simhash.link_fingerprints(values, "v", cell_rows=4))
    assert planned(components.connected(links, "left", "right")).count() > 200
    assert planned(simhash.group(edges.frame(spark))).count() == len(edges.TEXTS)
    assert planned(simhash.keep_one(edges.frame(spark))).count() == 6
    assert len(plans) > 15 and any("SortMergeJoin" in plan for plan in plans)
    assert not any("Broadcast" in plan for plan in plans)
    assert max(plan.count("Exchange ") for plan in plans) <= 8


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (5, 5), (None, 3), (201, 200)] + [(300, 300 + i) for i in range(1, 50)]
    found = dict(tuple(r) for r in components.connected(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect())
    assert found == {**dict.fromkeys([*range(41), 100], 0), 200: 200, 201: 200, **dict.fromkeys(range(300, 350), 300)}
    assert components.connected(spark.createDataFrame([(1, 1)], "a bigint, b bigint"), "a", "b").count() == 0
