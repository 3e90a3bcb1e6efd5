from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import edges
import numpy as np
from compare import assert_same
from pyspark.sql import functions as F

from vigilog.llm import audit


def brute(docs, labels):
    """Every order is applied to every document; docs are (id, text, lang)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    ids = defaultdict(list)
    for i, text, _ in docs:
        if i is not None:
            ids[text or ""].append(i)
    failed = []
    for i, text, lang in docs:
        body = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", body)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", body)) > 10 * len(body)}
        fails["D"] = bool(re.search(r"[#$%&*|]", body))
        fails["E"] = i is not None and min(ids[body]) < i
        failed.append((lang or "", i, {f for f, hit in fails.items() if hit}))
    rows = {}
    removed_by = Counter()
    for order in permutations("ABCDE"):
        for part in {p for p, _, _ in failed}:
            alive = [(i, f) for p, i, f in failed if p == part]
            gone = []
            for step, name in enumerate(order):
                out = [(i, f) for i, f in alive if name in f]
                redundant = sum(name in f for _, f in gone)
                alive = [(i, f) for i, f in alive if name not in f]
                gone += out
                removed_by[part, name] += len(out)
                unique = sum(f == {name} for p, _, f in failed if p == part)
                rows[part, "".join(order), step + 1] = [len(alive), len(out), redundant, unique, sum(i in good for i, _ in out), sum(i in toxic for i, _ in out)]
    return {(p, o, s): (*v, removed_by[p, o[s - 1]]) for (p, o, s), v in rows.items()}


def random_docs(seed, count):
    draw = random.Random(seed)
    words = ["aa", "bb", "Cc", "DD", "é", "x$y", "zz"]
    base = [" ".join(draw.choice(words) for _ in range(draw.choice([3, 99, 100, 101, 150]))) for _ in range(40)]
    base += [" ".join(f"w{k}" for k in range(n)) for n in (99, 100, 120)]
    base += [b + t for b in base[:10] for t in ("", " ", "x")] + ["", None]
    docs = [(draw.choice([None, *range(60)]), draw.choice(base), draw.choice(["en", "de", "", None])) for _ in range(count)]
    labels = [(draw.choice([None, *range(80)]), draw.choice([0, 1, None]), draw.choice([0, 1, None])) for _ in range(60)]
    return docs, labels


def frames(spark, docs, labels, tasks=4):
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(tasks),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


def test_equals_sql(spark, sf_dir):
    assert assert_same(audit.query(spark, sf_dir), sf_dir, audit.oracle()) == 4 * 120 * 5


def test_awkward_tables_equal_sql(spark, tmp_path):
    edges.frame(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (8, None, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert_same(audit.query(spark, str(tmp_path)), str(tmp_path), audit.oracle())


def test_against_every_order_applied(spark):
    docs, labels = random_docs(1, 400)
    expected = brute(docs, labels)
    for limits in ({}, {"ranges": 1}, {"ranges": 1 << 20, "block_bytes": 1}, {"ranges": 64, "block_bytes": 1000}):
        assert found(audit.audit(*frames(spark, docs, labels), **limits)) == expected


def test_split_ranges_keep_copies_together(spark, monkeypatch):
    """With ranges of a few bytes most prefixes are split, down to single texts."""
    monkeypatch.setattr(audit, "LEAST_RANGE", 1)
    docs, labels = random_docs(2, 300)
    tables = frames(spark, docs, labels)
    directory = audit.prefix_directory(tables[0].selectExpr("cast(coalesce(text, '') as binary) as text"), 1 << 20)
    assert len(directory) > 20
    bodies = sorted({(t or "").encode() for _, t, _ in docs})
    cells = audit.ranges_of(bodies * 2, directory)
    assert (cells[: len(bodies)] == cells[len(bodies) :]).all() and len(np.unique(cells)) == len(bodies)
    assert found(audit.audit(*tables, ranges=1 << 20)) == brute(docs, labels)


def test_one_text_and_one_id_with_most_rows(spark):
    docs = [(i, "the same text " * 40, "en") for i in range(500)] + [(7, f"text {i}", "de") for i in range(300)] + [(None, "the same text " * 40, None)] * 200
    labels = [(3, 1, 0), (7, 1, 1), (7, 0, 0)]
    assert found(audit.audit(*frames(spark, docs, labels, 7), block_bytes=2000)) == brute(docs, labels)


def test_trie_against_a_dictionary():
    draw = random.Random(3)
    texts = [bytes(draw.choice(b"ab") for _ in range(draw.randrange(9))) for _ in range(3000)]
    trie, least, copies = audit.Trie(), {}, 0
    keys = list(range(3000))
    draw.shuffle(keys)
    for text, key in zip(texts, keys, strict=True):
        copies += len(trie.add(text, key, "", 0, 1))
        least[text] = min(key, least.get(text, key))
    assert {t: n.least for t, n in trie.walk(whole=True)} == least and copies == 3000 - len(least)


def test_long_texts_are_cut_between_words(monkeypatch):
    texts = [" ".join(f"word{i % 97}" for i in range(5000)), "x" * 9000, "A b\tc\n" * 700, "", " " * 500]
    whole = [audit.failures_of(t.encode(), len(t)) for t in texts]
    monkeypatch.setattr(audit, "PIECE_BYTES", 13)
    assert [audit.failures_of(t.encode(), len(t)) for t in texts] == whole


def test_empty_and_foreign_columns(spark):
    empty = edges.frame(spark, [])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit.audit(empty, labels).count() == 0
    clash = edges.frame(spark).withColumns({name: F.lit("x") for name in ("part", "mask", "n", "key", "cell")})
    assert audit.audit(clash, labels).count() == 2 * 600

