"""Plans: what is read, what is pushed down, what is shuffled, what is broadcast."""

from __future__ import annotations

import re

import pytest

from vigilog.operators import cleaning, detection, gold, joins
from vigilog.plans import catalog
from vigilog.plans.catalog import all_queries
from vigilog.plans.fixture import attack_list, auth_log
from vigilog.plans import jobs
from vigilog.sources import lake
from vigilog.sources.lake import read_silver, write_by_day


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def read_columns(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>\n", text)]


@pytest.fixture(scope="module")
def zones(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("zones") / "silver")
    write_by_day(cleaning.to_silver(auth_log(spark, sf_dir)), path)
    csv = str(tmp_path_factory.mktemp("zones") / "redteam")
    attack_list(spark, sf_dir).write.parquet(csv)
    return read_silver(spark, path, with_day=True), spark.read.parquet(csv)


def test_distinct_machines_read_three_columns(zones):
    text = plan(gold.machines_by_user(gold.pair_activity(zones[0])))
    assert read_columns(text) == [{"source_user_domain", "destination_computer", "categorie_destination"}]
    assert "EqualTo(categorie_destination,machine)" in text
    assert "IsNotNull(source_user_domain)" in text


def test_filters_reach_the_scan(zones):
    text = plan(gold.off_hours_activity(zones[0]))
    assert "LessThan(heure_du_jour,6.0),GreaterThan(heure_du_jour,22.0)" in text.replace("Or(", "").replace(" ", "")
    assert read_columns(text) == [{"source_user_domain", "destination_computer", "heure_du_jour"}]


def test_one_shuffle_per_simple_aggregate(zones):
    for df in (
        gold.connections_by_user_hour(zones[0]),
        gold.volume_by_day(zones[0]),
        gold.failure_rate_by_user(gold.attempts(zones[0])),
        gold.rare_pairs(gold.pair_activity(zones[0])),
        gold.off_hours_activity(zones[0]),
    ):
        assert plan(df, "simple").count("Exchange hashpartitioning") == 1


def test_small_list_never_shuffles_the_log(zones):
    text = plan(detection.validation_strict(detection.measured(zones[1]), zones[0]), "simple")
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text
    assert "dynamicpruning" in text


def test_large_list_is_not_broadcast(spark, zones):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matched = detection.validation_strict(detection.measured(zones[1], limit=0), zones[0])
        assert matched.collect()
        text = plan(matched, "simple").split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Only the bitmap of its keys is sent out.
    assert text.count("BroadcastExchange") == 1 and text.count("BroadcastHashJoin") == 1
    assert "SortMergeJoin" in text


def test_bitmap_stands_before_the_shuffle_of_the_log(zones):
    matched = detection.validation_strict(detection.measured(zones[1], limit=0), zones[0])
    lines = plan(matched, "simple").splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "heure_du_jour" in line)
    above = [re.search(r"[A-Z][A-Za-z]+", line).group() for line in lines[:scan] if re.search(r"[A-Z]", line)][::-1]
    assert above.index("BroadcastHashJoin") < above.index("HashAggregate") < above.index("Exchange")


def test_days_outside_a_large_list_are_not_read(zones):
    silver, attacks = zones
    few_days = attacks.where("temps_secondes BETWEEN 86400 AND 259199")
    matched = detection.validation_strict(detection.measured(few_days, limit=0), silver)
    filters = max(re.findall(r"PartitionFilters: \[(.*?)(?:\]|\.\.\.)", plan(matched, "simple")), key=len)
    assert "jour_part" in filters and ">= 1)" in filters and "<= 2)" in filters
    assert matched.count() == detection.validation_strict(detection.measured(few_days), silver).count() > 0


def test_days_without_attacks_are_not_read(zones):
    silver, attacks = zones
    one_day = attacks.where("temps_secondes BETWEEN 86400 AND 172799")
    matched = detection.validation_strict(detection.measured(one_day), silver)
    assert matched.collect()
    final = plan(matched, "simple").split("== Initial Plan ==")[0]
    # The days come from the broadcast the join uses anyway.
    assert "SubqueryBroadcast dynamicpruning" in final and "ReusedExchange" in final


def test_cleaning_is_a_single_narrow_stage(spark, sf_dir):
    assert "Exchange" not in plan(cleaning.to_silver(auth_log(spark, sf_dir)), "simple")


def test_expanded_rows_are_not_shuffled_again(spark, zones):
    attacks = detection.measured(zones[1], limit=0)
    for made in (detection.validation_loose(attacks, gold.off_hours_activity(zones[0])), detection.validation_strict(attacks, zones[0])):
        text = plan(jobs._in_few_files(attacks, made), "simple")
        lines = text.splitlines()
        repeated = min(i for i, line in enumerate(lines) if "Generate explode(array_repeat" in line)
        assert not [line for line in lines[:repeated] if "Exchange" in line]


def test_user_tables_are_cut_to_a_small_list(spark, zones):
    silver, listed = zones
    attacks = detection.measured(listed)
    path = lake.scratch_path(spark, "users")
    gold.failure_rate_by_user(gold.attempts(silver)).write.parquet(path + "/rates")
    pairs = gold.pair_activity(silver)
    gold.machines_by_user(pairs).write.parquet(path + "/machines")
    gold.rare_pairs(pairs).write.parquet(path + "/rare")
    tables = [spark.read.parquet(f"{path}/{name}") for name in ("rates", "machines", "rare")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(detection._known_of_pairs(attacks, attacks.rows.select("user_domain", "destination_computer"), *tables), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 6


def test_row_counts_repeat_no_rows(spark, sf_dir):
    text = plan(catalog.all_queries()["gold_row_counts"](spark, sf_dir), "simple")
    assert "array_repeat" not in text


def test_tasks_of_repeated_rows_follow_the_initial_number(spark):
    assert joins.shuffle_tasks(spark) == 8
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "24")
    try:
        df = spark.createDataFrame([("a", 30 * joins.BLOCK_ROWS)], "k string, n bigint")
        assert joins.repeat_rows(df, "n").rdd.getNumPartitions() == 24
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cartesian_or_nested_loop_join(spark, name):
    text = plan(all_queries()[name](spark, "/root/testdata/sf0.001"), "simple")
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "Python" not in text
