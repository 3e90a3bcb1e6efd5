from __future__ import annotations

import hashlib
from pathlib import Path

import edges
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from vigilog.llm import pieces

MODEL = Path(pieces.model_path()).read_bytes()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ENCODER = pieces.Encoder(MODEL, table_words=50)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_whole_texts_against_the_library(spark, sf_dir):
    texts = dict(edges.texts_of(spark, sf_dir))
    for row in pieces.query(spark, sf_dir).collect():
        ids = LIBRARY.encode(texts[row.doc_id])
        assert tuple(row)[1:] == (len(ids), digest(",".join(map(str, ids))), digest(LIBRARY.decode(ids)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab  ▁\n\té中😀　 ﬁ<s>0x"), st.characters(codec="utf-8")), max_size=60), max_size=5))
def test_any_text(texts):
    found = ENCODER.encode(texts)
    assert [f.tolist() for f in found] == [LIBRARY.encode(t) for t in texts]
    assert ENCODER.decode(found) == [LIBRARY.decode(LIBRARY.encode(t)) for t in texts]


def test_pieces_that_cross_markers_need_whole_texts():
    own = pieces.Encoder(MODEL)
    assert own.cut is not None
    own.cut = None
    assert [f.tolist() for f in own.encode(["a b", ""])] == [LIBRARY.encode("a b"), []]


def test_awkward_rows(spark):
    encoded = pieces.encode(edges.frame(spark))
    rows = encoded.collect()
    assert encoded.columns.count("ids") == 1 and len(rows) == len(edges.TEXTS)
    for row in rows:
        assert row.ids == LIBRARY.encode(row.text or "")
        assert row.decoded == LIBRARY.decode(row.ids)
    assert pieces.encode(edges.frame(spark, [])).count() == 0


def test_table_holds_each_word_of_several_tasks_once(spark):
    texts = ["alpha beta alpha", "beta  gamma", None, "", "alpha beta", "x" * 200 + " beta", "x" * 200, "only"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").repartition(8)
    rows = pieces.word_table(docs).collect()
    table = {r.word: [int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)] for r in rows}
    assert len(rows) == len(table) and "x" * 200 not in table and "only" not in table and "beta" in table
    assert all(ids == LIBRARY.encode(word) for word, ids in table.items() if word)
    encoded = pieces.encode(docs, words=pieces.word_table(docs))
    assert {r.doc_id: r.ids for r in encoded.collect()} == {i: LIBRARY.encode(t or "") for i, t in enumerate(texts)}
    fewer = pieces.word_table(docs, most=1)
    assert fewer.count() <= 1
    assert {r.doc_id: r.ids for r in pieces.encode(docs, words=fewer).collect()} == {i: LIBRARY.encode(t or "") for i, t in enumerate(texts)}
    assert pieces.word_table(docs.limit(0)).count() == 0


def test_shared_words_outlast_the_own_table():
    texts = [" ".join(f"w{i}q{j}" for j in range(40)) for i in range(6)]
    shared = dict(zip(["w0q1", "w5q3"], ENCODER.segment(["w0q1", "w5q3"]), strict=True))
    own = pieces.Encoder(MODEL, table_words=30, shared=shared)
    for text in texts:
        assert own.encode([text])[0].tolist() == LIBRARY.encode(text)
        assert shared.items() <= own.table.items()
