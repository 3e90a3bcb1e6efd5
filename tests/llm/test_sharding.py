from __future__ import annotations

import edges
import pytest
from compare import assert_same
from pyspark.sql import functions as F

from vigilog.llm import sharding


@pytest.mark.parametrize("limit", [sharding.LIMIT, 300_000, 20_000])
def test_equals_sql(spark, sf_dir, limit):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assigned = sharding.assign(docs, ["doc_id", "text"], limit=limit, keep=["doc_id"])
    assert_same(assigned, sf_dir, sharding.oracle(limit))
    full = assigned.groupBy("shard", "page").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).where(f"b > {limit} AND n > 1")
    assert full.count() == 0


def test_many_levels(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(sharding, "LEVEL_BITS", 2)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert_same(sharding.assign(docs, ["doc_id", "text"], limit=20_000, keep=["doc_id"]), sf_dir, sharding.oracle(20_000))


def test_copies_of_one_row_become_pages(spark):
    rows = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit("x" * 100).alias("text")).repartition(5)
    pages = sharding.assign(rows, ["doc_id", "text"], limit=10_000).groupBy("shard", "page").agg(F.sum("n_bytes").alias("b")).collect()
    assert len({r.shard for r in pages}) == 1 and len(pages) == 30 and {r.b for r in pages} == {10_000}


def test_shards_are_written_whole(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assigned = sharding.assign(docs, ["doc_id"], limit=500_000)
    sharding.write_shards(assigned, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == docs.count()
    assert all(len(list(p.glob("page=*/*.parquet"))) == 1 for p in (tmp_path / "shards").glob("shard=*"))


def test_awkward_rows(spark):
    assigned = sharding.assign(edges.frame(spark), ["doc_id", "text"], limit=60)
    rows = assigned.collect()
    assert len(rows) == len(edges.TEXTS) and assigned.columns.count("shard") == 1
    assert sorted(r.n_bytes for r in rows) == sorted(len((t or "").encode()) for _, t in edges.TEXTS)
    copies = [(r.shard, r.page) for r in rows if r.doc_id == 1]
    assert copies[0][0] == copies[1][0] and {p for _, p in copies} == {0, 1}
    assert sharding.assign(edges.frame(spark, []), ["doc_id"]).count() == 0
