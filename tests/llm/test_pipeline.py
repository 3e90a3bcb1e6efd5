from __future__ import annotations

import math

import edges
import numpy as np
import pytest
from compare import oracle
from test_privacy import brute, brute_spans, brute_terms
from test_simhash import brute_groups, brute_print

import corpus_pipeline as pipeline
from __spark_entry__ import oracle_sql, queries
from vigilog.llm import language, mixing, pieces, privacy
from vigilog.llm import queries as registered
from vigilog.llm.ngrams import letter_ngrams

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Documents before the first stage and after each, every stage run once."""
    docs = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        docs.append(pipeline.materialise(stage(spark, docs[-1], sf_dir), pipeline.scratch_path(spark, name[:3])))
    return docs


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(steps):
    assert all(df.columns == COLUMNS for df in steps[:5])
    assert steps[5].columns == [*COLUMNS, "piece_ids", "n_pieces", "piece_text"]


def test_language_stage(steps):
    """Every text against plain cosines with the centroids and the floor of its length."""
    model = language.fit(steps[0].where(~language.held_out()), identity=["doc_id", "text"])
    kept = set()
    for i, row in rows(steps[0]).items():
        tf = letter_ngrams([row.text or ""], language.WIDTH)[0]
        if tf.sum() == 0:
            continue
        vector = np.log1p(tf.astype(float)) * model.idf
        best = max(float(vector @ c) for c in model.centroids) / np.linalg.norm(vector)
        if best >= model.floors[int(math.log2(tf.sum()))]:
            kept.add(i)
    assert kept == set(rows(steps[1])) and len(kept) >= 0.99 * steps[0].count()


def test_near_duplicate_stage(steps):
    before = sorted(rows(steps[1]).items())
    roots = brute_groups([brute_print(r.text) for _, r in before])
    assert set(rows(steps[2])) == {before[i][0] for i in set(roots.tolist())}


def replaced(text, terms):
    """A text with its spans replaced, from spans and terms found by plain code."""
    marks = [(start, -end, f"[{kind.upper()}]") for kind, start, end in brute(text)]
    for kind, start, end in brute_spans(text, terms):
        word = text[start:end]
        if kind == "term":
            gone = terms[word.lower()] >= privacy.REMOVE
            marks.append((start, -end, "[NUMBER]" if any(c in "0123456789" for c in word) else "" if gone else "[NAME]" if word[0].isupper() else "[TERM]"))
    out, at = "", 0
    for start, end, mark in sorted(marks):
        if -end > at:
            out, at = out + text[at : max(start, at)] + mark, -end
    return out + text[at:]


def test_privacy_stage(steps):
    before, after = rows(steps[2]), rows(steps[3])
    terms = brute_terms([r.text or "" for r in before.values()])
    assert before.keys() == after.keys()
    for i, row in after.items():
        assert row.text == replaced(before[i].text, terms) and row.n_chars == len(row.text)
    assert sum(row.text != before[i].text for i, row in after.items()) > 10


def test_mixing_stage(spark, steps, tmp_path):
    """The stage against the raking in SQL, over what the stages before have left."""
    steps[3].write.parquet(f"{tmp_path}/documents.parquet")
    names, _, found = oracle(str(tmp_path), mixing.oracle(sanitised=True))
    sampled = {row[names.index("doc_id")] for row in found if row[names.index("sampled")]}
    assert set(rows(steps[4])) == sampled != set()


def test_topics_outlast_the_privacy_stage(spark, sf_dir, steps):
    before, after = ({r.doc_id: r.t for r in df.select("doc_id", mixing.topic().alias("t")).collect()} for df in steps[2:4])
    assert before == after and "contact" in before.values()
    texts = ["write to a.b@c.org", "call +1 (202) 555-0173 now", "from 10.0.0.1", "card 4111 1111 1111 1111", "see @handle", "a plain note"]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in enumerate(texts)], steps[2].schema)
    changed = pipeline.protect_privacy(spark, docs, sf_dir).select("doc_id", mixing.topic().alias("t"))
    assert [r.t for r in changed.orderBy("doc_id").collect()] == ["contact", *["figures"] * 3, "contact", "note"]


def test_encoding_stage(steps):
    encoder = pieces.Encoder(open(pieces.model_path(), "rb").read())
    for row in steps[5].collect():
        assert row.piece_ids == encoder.pieces.encode(row.text) and row.n_pieces == len(row.piece_ids)
        assert row.piece_text == encoder.pieces.decode(row.piece_ids)


def test_run(spark, sf_dir, steps):
    assert sorted(pipeline.run(spark, sf_dir).collect()) == sorted(steps[5].collect())


def test_awkward_rows(spark, sf_dir):
    for texts in (edges.TEXTS, []):
        docs = edges.frame(spark, texts)
        for name, stage in pipeline.STAGES:
            docs = pipeline.materialise(stage(spark, docs, sf_dir), pipeline.scratch_path(spark, name[:3]))
            assert docs.columns[: len(edges.CLASHING)] == edges.frame(spark, []).columns[: len(edges.CLASHING)]
        if not texts:
            assert docs.count() == 0


def test_every_operator_is_registered():
    names = set(registered.all_queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} and len(names) == 13
    assert names | {"pipeline"} <= set(queries()) and set(registered.checks()) <= set(oracle_sql())
    assert pipeline.ORACLE_SQL is None
