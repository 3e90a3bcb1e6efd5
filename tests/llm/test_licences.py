from __future__ import annotations

import random
import re
from collections import Counter

import edges
import pytest
from compare import assert_same

from vigilog.llm import licences

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts):
    """Templates are tried at every word of every text; texts are (id, text)."""
    listed = [words_of(t) for _, t in texts]
    frequency = Counter(w for words in listed for w in set(words))
    out = []
    for (i, _), words in zip(texts, listed, strict=True):
        places = [(s, label) for phrase, label in licences.PHRASES for s in range(len(words)) if words[s : s + len(phrase.split())] == phrase.split()]
        shares = [1.0] * bool(places)
        labels = {label for _, label in places}
        for label, passage, keys in licences.TEMPLATES:
            own = passage.split()
            rare = sorted({w for w in own if frequency[w]}, key=lambda w: (frequency[w], w))[:4]
            anchors = [q for q, w in enumerate(own) if w in rare]
            must = {q + j for k in keys for q in range(len(own)) if own[q : q + len(k.split())] == k.split() for j in range(len(k.split()))}
            for s in range(-len(own), len(words)):
                same = [0 <= s + q < len(words) and words[s + q] == w for q, w in enumerate(own)]
                votes = sum(same[q] for q in anchors)
                if anchors and votes >= min(2, len(anchors)) and all(same[q] for q in must) and sum(same) >= 0.8 * len(own):
                    labels.add(label)
                    shares.append(sum(same) / len(own))
        starts = [s for s, _ in places]
        base = ",".join(sorted({label for _, label in places}))
        out.append((i, len(words), len(places), min(starts, default=None), max(starts, default=None), base, ",".join(sorted(labels)), max(shares, default=0.0)))
    return out


def found(df):
    return sorted(map(str, (tuple(r) for r in licences.summary(licences.scan(df, licences.fit(df), keep=["doc_id"]), "doc_id").collect())))


def test_equals_sql(spark, sf_dir):
    assert_same(licences.query(spark, sf_dir), sf_dir, licences.oracle())


def licensed():
    draw = random.Random(4)
    filler = "river stone cloud window paper garden license version under the gnu by cc 2 0".split()
    texts = []
    for n, (_, passage, _) in enumerate(licences.TEMPLATES):
        for change in range(4):
            words = passage.split()
            if change == 1:
                words[draw.randrange(len(words))] = "other"
            if change == 2:
                words = words[: len(words) * 3 // 4]
            if change == 3:
                words = [w.upper() + draw.choice([",", ".", " -", ""]) for w in words] * 2
            around = [draw.choice(filler) for _ in range(20)]
            texts.append((n * 10 + change, " ".join(around[:10] + words + around[10:])))
    texts += [(1000 + i, " ".join(draw.choice(filler) for _ in range(60))) for i in range(30)]
    return texts


def test_against_every_place_tried(spark, tmp_path):
    texts = licensed() + [(1, None), (None, "under the MIT license, ünder the mit license"), (2, "Under\x00the-MIT/license" * 3)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    assert found(docs) == sorted(map(str, brute(texts)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert_same(licences.query(spark, str(tmp_path)), str(tmp_path), licences.oracle())


def test_every_template_is_found_in_its_own_words(spark):
    texts = [(i, f"Some words. {passage.capitalize()}; and more words") for i, (_, passage, _) in enumerate(licences.TEMPLATES)]
    rows = found(spark.createDataFrame(texts, "doc_id bigint, text string"))
    assert len(rows) == len(texts)
    for i, (label, _, _) in enumerate(licences.TEMPLATES):
        row = next(r for r in rows if r.startswith(f"({i},"))
        assert label in row.split("'")[3].split(",") and row.endswith("1.0)")


def test_awkward_rows(spark):
    texts = [*edges.TEXTS, (20, "under the mit license " * 5000), (21, "x" * 100_000 + " cc by nc")]
    docs = edges.frame(spark, texts).withColumnsRenamed({"base": "matches", "score": "n_words"})
    index = licences.fit(docs)
    scanned = licences.scan(docs, index)
    assert scanned.columns.count("matches") == 1 and scanned.columns.count("n_words") == 1
    rows = licences.summary(scanned, "doc_id").collect()
    assert sorted((str(r.doc_id), r.n_words) for r in rows) == sorted((str(i), len(words_of(t))) for i, t in texts)
    most = next(r for r in rows if r.doc_id == 20)
    assert (most.n_base, most.first_word, most.last_word, most.labels, most.score) == (5000, 0, 4999 * 4, "mit", 1.0)
    empty = edges.frame(spark, [])
    assert licences.scan(empty, licences.fit(empty)).count() == 0


@pytest.mark.parametrize("size", [1, 7, 100])
def test_pieces_of_long_texts(monkeypatch, size):
    numbers = {w.encode(): i for i, w in enumerate(licences.vocabulary())}
    texts = [t for _, t in licensed()[:20]] + ["", " ", "é" * 50 + " mit", "mit" * 100]
    whole = [licences.word_numbers(t.encode(), numbers).tolist() for t in texts]
    monkeypatch.setattr(licences, "PIECE_BYTES", size)
    assert [licences.word_numbers(t.encode(), numbers).tolist() for t in texts] == whole
    assert all(len(w) == len(words_of(t)) for w, t in zip(whole, texts, strict=True))


def test_rare_words_lead(spark):
    docs = spark.createDataFrame([(i, "license version 2 under the") for i in range(20)] + [(30, "gnu general public license version 3")], "doc_id bigint, text string")
    index = licences.fit(docs)
    place = next(i for i, t in enumerate(licences.TEMPLATES) if t[0] == "gpl-3")
    assert index.rare(place) == ["3", "general", "gnu", "public"] and index.frequency["license"] == 21
    assert index.needed[place] == 2
