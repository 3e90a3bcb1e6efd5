"""Tables in buckets of a key: no shuffle on that key, same rows."""

from __future__ import annotations

import pytest
from test_plans import plan

from vigilog.operators import cleaning, gold
from vigilog.plans.fixture import auth_log
from vigilog.sources import buckets
from vigilog.sources.lake import scratch_path


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def pairs(spark, sf_dir):
    return gold.pair_activity(cleaning.to_silver(auth_log(spark, sf_dir)))


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_users_are_joined_without_a_shuffle(spark, pairs, no_broadcast):
    stored = buckets.write_bucketed(pairs, scratch_path(spark, "pairs"), [gold.USER])
    profiles = gold.user_profiles(stored)
    text = plan(profiles, "simple")
    assert "SortMergeJoin" in text and "Exchange" not in text
    for table in (gold.failure_rate_by_user(stored), gold.machines_by_user(stored)):
        assert "Exchange" not in plan(table, "simple")
    assert same(profiles, gold.user_profiles(pairs))


def test_distinct_lines_without_a_shuffle(spark, sf_dir):
    log = auth_log(spark, sf_dir)
    stored = buckets.write_bucketed(log, scratch_path(spark, "seconds"), ["temps_secondes"])
    distinct = cleaning.to_silver_distinct(stored)
    assert "Exchange" not in plan(distinct, "simple")
    assert same(distinct, cleaning.to_silver_distinct(log)) and distinct.count() < log.count()


def test_buckets_of_another_session(spark, pairs, no_broadcast):
    path = scratch_path(spark, "pairs")
    stored = buckets.write_bucketed(pairs, path, [gold.USER], buckets=5)
    again = buckets.attach(spark, path, [gold.USER], 5)
    assert again.schema == stored.schema and same(again, stored)
    joined = gold.failure_rate_by_user(stored).join(gold.machines_by_user(again), gold.USER)
    assert "Exchange" not in plan(joined, "simple") and joined.count() > 0


def test_null_keys_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4)], "k string, n int")
    stored = buckets.write_bucketed(rows, str(tmp_path / "rows"), ["k"], buckets=3)
    assert same(stored, rows) and {(r.k, r["count"]) for r in stored.groupBy("k").count().collect()} == {("a", 1), ("b", 1), (None, 2)}
    assert buckets.write_bucketed(rows.limit(0), str(tmp_path / "none"), ["k"]).count() == 0
