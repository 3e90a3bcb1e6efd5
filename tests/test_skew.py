"""Hot keys, duplicates and the way taken by attack lists too large to broadcast."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from vigilog.operators import cleaning, detection, gold, joins
from vigilog.plans.fixture import attack_list, auth_log
from vigilog.sources.lake import write_by_day

NEVER_BROADCAST = 0


def rate_strict(attacks, log):
    return detection.detection_rate_strict(detection.matches(attacks, log))


def compare(attacks, log, *tables):
    return detection.compare_criteria(attacks, detection.matches(attacks, log), *tables)


def both_ways(attacks):
    return [detection.measured(attacks, limit) for limit in (joins.BROADCAST_LIMIT, NEVER_BROADCAST)]


def counted(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def skewed(spark, sf_dir):
    """A third of the log is one user on one machine, half of that in one second."""
    silver = cleaning.to_silver(auth_log(spark, sf_dir))
    rows = silver.count() // 2
    hot = spark.range(rows).select(
        F.when(F.col("id") % 2 == 0, 3600).otherwise(F.col("id") % 86400).cast("long").alias("temps_secondes"),
        F.lit("UHOT@DOM1").alias("source_user_domain"),
        F.lit("UHOT@DOM1").alias("destination_user_domain"),
        F.lit("C1").alias("source_computer"),
        F.lit("C7").alias("destination_computer"),
        F.lit("machine").alias("categorie_destination"),
        F.lit("NTLM").alias("authentication_type"),
        F.lit("Network").alias("logon_type"),
        F.lit("LogOn").alias("authentication_orientation"),
        (F.col("id") % 3 != 0).alias("succes"),
    )
    hot = hot.withColumn("heure_du_jour", (F.col("temps_secondes") % 86400) / F.lit(3600.0))
    log = silver.unionByName(hot)
    known = attack_list(spark, sf_dir)
    hot_attacks = spark.range(known.count() // 2).select(
        F.when(F.col("id") < 3, 3600).otherwise(F.col("id") * 11).cast("long").alias("temps_secondes"),
        F.lit("UHOT@DOM1").alias("user_domain"),
        F.lit("C1").alias("source_computer"),
        F.lit("C7").alias("destination_computer"),
    )
    attacks = known.unionByName(hot_attacks)
    return attacks.cache(), log.cache(), rows


def test_both_ways_give_the_same_rows(skewed):
    attacks, log, _ = skewed
    off_hours = gold.off_hours_activity(log)
    pairs = gold.pair_activity(log)
    tables = gold.failure_rate_by_user(pairs), gold.machines_by_user(pairs), gold.rare_pairs(pairs)
    for make, inputs in (
        (detection.validation_loose, (off_hours,)),
        (detection.detection_rate_loose, (off_hours,)),
        (detection.validation_strict, (log,)),
        (rate_strict, (log,)),
        (detection.detection_flags, (log, *tables)),
        (compare, (log, *tables)),
    ):
        small, large = (counted(make(listed, *inputs)) for listed in both_ways(attacks))
        assert small and small == large, make.__name__


def test_strict_fan_out_of_a_hot_second(skewed):
    attacks, log, rows = skewed
    second = (F.col("temps_secondes") == 3600) & (F.col("user_domain") == "UHOT@DOM1")
    events = log.where("temps_secondes = 3600 AND source_user_domain = 'UHOT@DOM1'").count()
    assert events >= rows // 2
    for listed in both_ways(attacks):
        matched = detection.validation_strict(listed, log)
        assert matched.where(second).count() == 3 * events


def test_rates_count_the_validated_rows(skewed):
    attacks, log, _ = skewed
    off_hours = gold.off_hours_activity(log)
    for listed in both_ways(attacks):
        for rows, rate in (
            (detection.validation_loose(listed, off_hours), detection.detection_rate_loose(listed, off_hours)),
            (detection.validation_strict(listed, log), rate_strict(listed, log)),
        ):
            flags = Counter(row.detecte_par_anomalie_horaire for row in rows.collect())
            total, found, percent = rate.first()
            assert (total, found) == (flags[True] + flags[False], flags[True])
            assert percent == pytest.approx(100 * found / total, abs=0.006)


def test_gold_against_plain_counting(skewed):
    _, log, _ = skewed
    rows = log.select("source_user_domain", "destination_computer", "categorie_destination", "succes").collect()
    users, pairs, machines = {}, Counter(), {}
    for user, destination, category, succeeded in rows:
        if user is not None:
            total, failed = users.get(user, (0, 0))
            users[user] = (total + 1, failed + (succeeded is not True))
            if category == "machine":
                pairs[user, destination] += 1
        if destination is not None:
            n, seen = machines.setdefault((destination, category), (0, set()))
            machines[destination, category] = (n + 1, seen | ({user} - {None}) if user not in seen else seen)
    shared = gold.pair_activity(log)
    rates = {r.source_user_domain: (r.total_tentatives, r.nb_echecs) for r in gold.failure_rate_by_user(shared).collect()}
    assert rates == {u: v for u, v in users.items() if v[0] >= 10}
    assert {tuple(r)[:2] for r in gold.rare_pairs(shared).collect()} == {p for p, n in pairs.items() if n == 1}
    diversity = {r.source_user_domain: r.nb_machines_distinctes for r in gold.machines_by_user(shared).collect()}
    assert diversity == Counter(user for user, _ in pairs)
    activity = {tuple(r)[:2]: tuple(r)[2:] for r in gold.activity_by_machine(shared).collect()}
    assert activity == {k: (n, len(seen)) for k, (n, seen) in machines.items()}


@pytest.mark.parametrize("times", [0, 1, 2, joins.BLOCK_ROWS, joins.BLOCK_ROWS + 1, 3 * joins.BLOCK_ROWS - 1])
def test_repeat_rows(spark, times):
    df = spark.createDataFrame([("a", times), ("b", 2), ("c", None)], "k string, n bigint")
    repeated = joins.repeat_rows(df, "n").groupBy("k").count().collect()
    expected = {"a": times, "b": 2}
    assert {r.k: r["count"] for r in repeated} == {k: n for k, n in expected.items() if n}


def test_copies_of_one_row_are_spread(spark):
    df = spark.createDataFrame([("hot", 40 * joins.BLOCK_ROWS), ("cold", 1)], "k string, n bigint")
    repeated = joins.repeat_rows(df, "n").groupBy(F.spark_partition_id().alias("task")).count().collect()
    sizes = [r["count"] for r in repeated]
    assert sum(sizes) == 40 * joins.BLOCK_ROWS + 1
    assert len(sizes) == 8 and max(sizes) <= 7 * joins.BLOCK_ROWS


def test_a_hot_day_is_cut(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 100 == 0, F.col("id") * 30).otherwise(5).alias("temps_secondes"),
        F.sha2(F.col("id").cast("string"), 256).alias("texte"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_by_day(rows, str(tmp_path / "day"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "day" / "jour_part=0").glob("*.parquet"))) > 3
    assert spark.read.parquet(str(tmp_path / "day")).count() == 200_000


def test_spread_lookup(spark):
    left = spark.range(5000).select(
        F.when(F.col("id") < 4000, "hot").when(F.col("id") < 4900, F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.createDataFrame([("hot", 1), ("4500", 2), ("other", 3)], "k string, w int")
    spread = joins.spread_lookup(left, right, ["k"], ["v"])
    assert counted(spread) == counted(left.join(right, "k", "left"))
    inner = joins.spread_lookup(left, right, ["k"], ["v"], "inner")
    assert counted(inner) == counted(left.join(right, "k"))


def test_join_least(spark):
    value = F.when(F.col("id") % 7 > 0, 9000 - F.col("id")).alias("v")
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").when(F.col("id") < 4900, F.col("id").cast("string")).alias("k"), F.col("id").alias("s"), value)
    left = rows.where("s % 3 = 0")
    found = joins.join_least(left, rows, "k", "v", "s", "w")
    assert counted(found) == counted(left.join(rows.groupBy("k").agg(F.min("v").alias("w")), "k"))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_size_is_measured(spark):
    df = spark.createDataFrame([("abcd", 1), (None, 2)], "s string, n int")
    assert joins.estimated_bytes(df) == 4 + 2 * joins.ROW_OVERHEAD
    assert joins.estimated_bytes(df.limit(0)) == 0
    assert joins.fits_in_broadcast(df, 4 + 2 * joins.ROW_OVERHEAD)
    assert not joins.fits_in_broadcast(df, 3 + 2 * joins.ROW_OVERHEAD)
    assert not joins.fits_in_broadcast(df.limit(0), 0)


def test_no_attack_matches(spark, skewed):
    _, log, _ = skewed
    attacks = spark.createDataFrame([(-5, "U0@X", "C1", "C2")], "temps_secondes long, user_domain string, source_computer string, destination_computer string")
    pairs = gold.pair_activity(log)
    tables = gold.failure_rate_by_user(pairs), gold.machines_by_user(pairs), gold.rare_pairs(pairs)
    for listed in both_ways(attacks):
        assert detection.validation_strict(listed, log).count() == 0
        row = compare(listed, log, *tables).first()
        assert row.total_evenements == 0 and row.detectes_horaire is None and row.pct_horaire is None
        loose = detection.validation_loose(listed, gold.off_hours_activity(log)).collect()
        assert [tuple(r) for r in loose] == [(-5, "U0@X", "C2", False)]
