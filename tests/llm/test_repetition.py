from __future__ import annotations

import re
from collections import Counter

import edges
from compare import assert_same

from vigilog.llm import repetition


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    duplicates = sum(line in lines[:i] for i, line in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return [len(words), sum(map(len, words)), symbols, duplicates, len(repeated), failed]


def brute_shares(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    chars = max(sum(map(len, words)), 1)
    shares = []
    for n in (2, 3, 4):
        grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        most = max(grams.values(), default=0)
        shares.append(min(1.0, max((most * sum(map(len, g)) / chars for g, c in grams.items() if c == most), default=0)) if most > 1 else 0.0)
    for n in range(5, 11):
        seen, covered = set(), set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            covered |= set(range(i, i + n)) if gram in seen else set()
            seen.add(gram)
        shares.append(sum(len(words[i]) for i in covered) / chars)
    return shares


def test_whole_texts_against_brute_force(spark, sf_dir):
    texts = dict(edges.texts_of(spark, sf_dir))
    found = repetition.query(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        text = texts[row.doc_id]
        assert list(row)[1:7] == brute(text)
        if row.n_words < 400:
            assert [round(v, 9) for v in list(row)[11:]] == [round(v, 9) for v in brute_shares(text)]


def test_equals_sql(spark, sf_dir, tmp_path):
    assert_same(repetition.query(spark, sf_dir), sf_dir, repetition.oracle())
    edges.frame(spark).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    assert_same(repetition.query(spark, str(tmp_path)), str(tmp_path), repetition.oracle())


def test_good_texts_stay_and_bad_ones_go(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = repetition.query(spark, sf_dir).where("NOT base_failed").join(labels, "doc_id")
    counts = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.02 * counts[1, True]
    assert counts.get((0, True), 0) <= 0.1 * counts[0, False]


def test_awkward_rows(spark):
    judged = repetition.judge(edges.frame(spark))
    rows = judged.collect()
    assert len(rows) == len(edges.TEXTS)
    assert sorted((str(r.doc_id), r.n_words) for r in rows) == sorted((str(i), brute(t)[0]) for i, t in edges.TEXTS)
    assert all(r.base_failed and not r.kept and r.word_chars == 0 for r in rows if not (r.text or "").strip())
    assert repetition.judge(edges.frame(spark, [])).count() == 0
    assert judged.columns.count("kept") == 1 and "score" in judged.columns


def test_long_repetition_is_exact():
    words = [str(i % 3) for i in range(1000)] + [f"w{i}" for i in range(500)]
    assert repetition.measure(" ".join(words))[:5] == brute(" ".join(words))[:5]
