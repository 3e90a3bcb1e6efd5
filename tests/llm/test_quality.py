from __future__ import annotations

from collections import Counter

import edges
import numpy as np
import pytest

from vigilog.llm import quality


def test_held_out_quality(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.query(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert scored.count() == docs
    held = scored.join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    pairs = [(a > b) + 0.5 * (a == b) for a in good for b in bad]
    assert sum(pairs) / len(pairs) >= 0.97
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in held)


def test_terms_against_plain_python():
    texts = ["ab cd cd,  x", "", " \n ", "Éa1 é"]
    found = quality.terms(texts)
    for row, text in zip(found, texts, strict=True):
        words = text.split()
        assert row[1 : quality.WORDS].sum() == len(words)
        assert row[0] == sum(a == b for a, b in zip(words, words[1:], strict=False))
        assert row[quality.WORDS :].sum() == max(len(text) - 1, 0)
    same = quality.terms(["ab cd", "x ab", "ab"])[:, 1 : quality.WORDS]
    assert ((same[0] > 0) & (same[1] > 0)).sum() == 1 and (same[2] > 0).sum() == 1


def test_votes_against_brute_force():
    draw = np.random.default_rng(0)
    axes = np.linalg.qr(draw.normal(size=(quality.WIDTH, 16)))[0].astype(np.float32)
    vectors = quality.unit(draw.normal(size=(90, 16))).astype(np.float32)
    labels = draw.integers(0, 2, 90).astype(np.float32)
    model = quality.Model(np.ones(quality.WIDTH, np.float32), axes, vectors, labels, 0.4)
    tf = quality.terms(["some words in a text", "others, with 123 !", ""])
    for row, score in zip(tf, quality.vote(model, tf), strict=True):
        point = np.log1p(row.astype(float)) @ axes
        if not point.any():
            assert score == 0.4
            continue
        cosines = vectors @ (point / np.linalg.norm(point))
        near = np.argsort(-cosines)[: quality.NEIGHBOURS]
        weights = np.clip(cosines[near], 0, 1) ** quality.SHARPNESS
        assert score == pytest.approx((weights * labels[near]).sum() / weights.sum(), rel=1e-4)


def test_the_sample_is_bounded_whatever_repeats(spark):
    docs = spark.range(4000).selectExpr("CAST(CASE WHEN id < 3000 THEN 1 ELSE id END AS BIGINT) AS doc_id", "concat('text ', id) AS text")
    labels = docs.select("doc_id").distinct().selectExpr("doc_id", "CAST(doc_id % 2 AS INT) AS quality")
    model = quality.fit(docs, labels, "quality", per_label=50)
    assert all(n <= 50 for n in Counter(model.labels.tolist()).values()) and len(model.vectors) == len(model.labels) > 0


def test_awkward_rows(spark):
    docs = edges.frame(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, 1), (6, 0), (None, 1), (7, None), (99, 1)], "doc_id bigint, quality int")
    scored = quality.score(docs, quality.fit(docs, labels, "quality"))
    rows = scored.collect()
    assert len(rows) == len(edges.TEXTS) and scored.columns.count("score") == 1
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 8)}) == 1
    assert len({r.score for r in rows if not r.text}) == 1
    empty = edges.frame(spark, [])
    model = quality.fit(empty, labels.limit(0), "quality")
    assert quality.score(empty, model).count() == 0
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
