"""The bitmap of a large list's keys: it loses no row, and lets few others through."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vigilog.operators import cleaning, detection, keyfilter
from vigilog.plans.fixture import attack_list, auth_log

KEYS = ["a", "b"]


def numbered(spark, first, count):
    return spark.range(first, first + count).select((F.col("id") % 977).alias("a"), F.concat(F.lit("k"), F.col("id")).alias("b"))


def test_every_listed_row_stays_and_few_others(spark):
    listed = numbered(spark, 0, 50_000)
    found = keyfilter.key_map(listed.union(listed.where("a < 5")), KEYS, 50_000)
    assert found.count == -(-50_000 * keyfilter.BITS_PER_KEY // keyfilter.BLOCK_BITS)
    assert keyfilter.maybe_listed(listed, found).count() == 50_000
    others = 200_000
    passed = keyfilter.maybe_listed(numbered(spark, 1_000_000, others), found).count()
    assert 0 < passed < 0.01 * others


def test_blocks_are_complete_and_bounded(spark):
    found = keyfilter.key_map(numbered(spark, 0, 10), KEYS, 300_000)
    blocks = found.blocks.collect()
    assert sorted(r["_block"] for r in blocks) == list(range(found.count))
    assert {len(r["_words"]) for r in blocks} == {keyfilter.BLOCK_BITS // keyfilter.WORD_BITS}
    set_bits = sum(bin(w & (1 << 64) - 1).count("1") for r in blocks for w in r["_words"])
    assert 10 < set_bits <= 10 * keyfilter.PROBES
    most = keyfilter.MAP_BYTES * 8 // keyfilter.BLOCK_BITS
    assert keyfilter.block_count(0) == 1 and keyfilter.block_count(100_000_000) == most
    assert keyfilter.block_count(1_000_000_000) == 0


def test_too_large_a_list_has_no_map(spark):
    assert keyfilter.key_map(numbered(spark, 0, 10), KEYS, 10**6, map_bytes=1 << 13) is None
    log = numbered(spark, 0, 100)
    assert keyfilter.maybe_listed(log, None) is log


def test_nulls_and_other_names(spark):
    listed = spark.createDataFrame([(1, "x"), (2, None), (None, "y")], "a bigint, b string")
    rows = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (2, None, 3), (None, "y", 4), (9, "z", 5)], "c bigint, d string, n int")
    found = keyfilter.key_map(listed, KEYS, 3)
    assert sorted(r.n for r in keyfilter.maybe_listed(rows, found, ["c", "d"]).collect()) == [1, 2]
    empty = keyfilter.key_map(listed.limit(0), KEYS, 0)
    assert keyfilter.maybe_listed(rows, empty, ["c", "d"]).count() == 0


def test_shuffled_log_rows_are_the_matches_and_few_others(spark, sf_dir):
    """What `_match_counts` sends through its shuffle, on a list of a third of a log of a million rows."""
    silver = cleaning.to_silver(auth_log(spark, sf_dir)).where("source_user_domain IS NOT NULL AND destination_computer IS NOT NULL")
    log = silver.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(99)))).withColumn("temps_secondes", F.col("temps_secondes") + F.col("copy") * 10_000_000)
    named = log.withColumnRenamed("source_user_domain", "user_domain")
    third = F.pmod(F.xxhash64(*detection.MOMENT), F.lit(3)) == 0
    attacks = detection.measured(named.where(third).select(*detection.MOMENT), limit=0)
    total, wanted = log.count(), named.where(third).count()
    left = detection._maybe_attacked(attacks, detection._within_span(attacks, detection._log_side(log)), detection.MOMENT)
    assert wanted <= left.count() <= wanted + 0.01 * total
    assert total > 500_000


@pytest.mark.parametrize("map_bytes", [keyfilter.MAP_BYTES, 1 << 10])
def test_same_rows_with_and_without_a_map(spark, sf_dir, monkeypatch, map_bytes):
    monkeypatch.setattr(keyfilter.block_count, "__defaults__", (map_bytes,))
    monkeypatch.setattr(keyfilter.key_map, "__defaults__", (map_bytes,))
    silver = cleaning.to_silver(auth_log(spark, sf_dir))
    listed = attack_list(spark, sf_dir)
    large = detection.validation_strict(detection.measured(listed, limit=0), silver)
    small = detection.validation_strict(detection.measured(listed), silver)
    assert large.count() > 0 and large.exceptAll(small).isEmpty() and small.exceptAll(large).isEmpty()


def test_empty_list(spark, sf_dir):
    silver = cleaning.to_silver(auth_log(spark, sf_dir))
    none = detection.measured(attack_list(spark, sf_dir).limit(0), limit=0)
    assert detection.validation_strict(none, silver).count() == 0
