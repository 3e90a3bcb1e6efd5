"""Versions that replace tables in one step, and days that are added or replaced."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import assert_same
from pyspark.sql import functions as F

from vigilog.operators import cleaning, detection, gold
from vigilog.plans import jobs
from vigilog.plans.fixture import attack_list, auth_log
from vigilog.plans.oracle import checks
from vigilog.sources import raw
from vigilog.sources.lake import GOLD_TABLES, Lake, current_paths, pointers, read_gold, read_landed, read_silver
from vigilog.sources.versions import Draft, vacuum

DAY = "floor(temps_secondes / 86400)"
AGGREGATES = [name for name in GOLD_TABLES if name != "validation_redteam"]


def write_csv(df, path):
    df.write.option("compression", "gzip").option("escape", '"').csv(str(path))
    return str(path)


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def of_other_days(found, days):
    return {p: t for p, t in found.items() if not any(f"jour_part={d}/" in p for d in days)}


@pytest.fixture(scope="module")
def updated(spark, sf_dir, tmp_path_factory):
    """A lake of all days but the last three, which are delivered later."""
    base = tmp_path_factory.mktemp("updated")
    log = auth_log(spark, sf_dir)
    lake = Lake(str(base / "lake"))
    jobs.land(spark, lake, write_csv(log.where(f"{DAY} < 28"), base / "first"), write_csv(attack_list(spark, sf_dir), base / "redteam"))
    jobs.silver(spark, lake)
    jobs.gold_tables(spark, lake)
    zones = [lake.landed(), lake.silver(), *[lake.state(name) for name in gold.STATES]]
    before = {zone: files(zone) for zone in zones}
    later = write_csv(log.where(f"{DAY} >= 28"), base / "later")
    reports = jobs.update(spark, lake, later)
    return lake, before, later, reports


@pytest.mark.parametrize("name", AGGREGATES)
def test_updated_tables_equal_a_rebuild(spark, sf_dir, updated, name):
    assert assert_same(read_gold(spark, updated[0], name), sf_dir, checks()[name]) > 0


def test_zones_hold_the_whole_log(spark, sf_dir, updated):
    lake, _, _, reports = updated
    assert_same(read_landed(spark, lake.landed()), sf_dir, checks()["bronze_landed"])
    assert_same(read_silver(spark, lake.silver()), sf_dir, checks()["silver_auth"])
    assert_same(reports["gold_row_counts"], sf_dir, checks()["gold_row_counts"])


def test_other_days_are_left_alone(updated):
    lake, before, _, _ = updated
    for zone, found in before.items():
        after = files(zone)
        assert found and {p: t for p, t in after.items() if p in found} == found
        added = set(after) - set(found)
        assert added and not of_other_days(dict.fromkeys(added, 0), [28, 29, 30])


def test_a_delivery_can_be_repeated(spark, sf_dir, updated):
    lake, _, later, _ = updated
    before = current_paths(spark, lake)
    assert jobs.update(spark, lake, later, again=True)
    assert current_paths(spark, lake)["volume_par_jour"] != before["volume_par_jour"]
    jobs.detect(spark, lake)
    for name in ("volume_par_jour", "activite_par_machine", "validation_redteam", "comparaison_criteres_detection"):
        assert_same(read_gold(spark, lake, name), sf_dir, checks()[name])


def test_files_landed_before_are_not_read(spark, updated):
    lake, _, later, _ = updated
    before = current_paths(spark, lake), files(lake.landed()), files(lake.delivery())
    assert jobs.update(spark, lake, later) == {}
    assert (current_paths(spark, lake), files(lake.landed()), files(lake.delivery())) == before
    known = spark.read.parquet(lake.manifest())
    assert known.agg(F.sum("nb_lignes")).first()[0] == read_landed(spark, lake.landed()).count()
    listed = raw.manifest(spark, later)
    assert listed.count() > 0 and raw.not_landed(listed, known).isEmpty()
    # A file that was written again is another one.
    changed = known.withColumn("modificationTime", F.expr("modificationTime - INTERVAL 1 SECOND"))
    assert raw.not_landed(listed, changed).count() == listed.count()


def test_a_day_that_loses_its_rows_of_a_state(spark, tmp_path):
    """A corrected day without off-hours lines takes the former ones out."""
    columns = "destination_user_domain, source_computer, destination_computer, authentication_type, logon_type, authentication_orientation, success_failure"
    line = ["U1@D", "C1", "C2", "NTLM", "Network", "LogOn", "Success"]

    def log(name, seconds):
        rows = [(s, "U9@D", *line) for s in seconds]
        return write_csv(spark.createDataFrame(rows, ["temps_secondes", "source_user_domain", *columns.split(", ")]), tmp_path / name)

    lake = Lake(str(tmp_path / "lake"))
    attacks = write_csv(spark.createDataFrame([(3600, "U9@D", "C1", "C2")], "a bigint, b string, c string, d string"), tmp_path / "attacks")
    jobs.land(spark, lake, log("first", [3600, 40_000, 93_600, 130_000]), attacks)
    jobs.silver(spark, lake)
    jobs.gold_tables(spark, lake)
    assert read_gold(spark, lake, "anomalies_horaires").count() == 2
    jobs.update(spark, lake, log("second", [40_000, 40_001]))
    night = read_gold(spark, lake, "anomalies_horaires").collect()
    assert [round(r.heure_du_jour * 3600) for r in night] == [7200] and read_gold(spark, lake, "validation_redteam").first().detecte_par_anomalie_horaire
    jobs.update(spark, lake, log("third", [86_400 + 40_000]))
    assert read_gold(spark, lake, "anomalies_horaires").count() == 0
    assert sorted(tuple(r) for r in read_gold(spark, lake, "volume_par_jour").collect()) == [(0, 2, 0), (1, 1, 0)]
    assert read_gold(spark, lake, "connexions_par_utilisateur_heure").agg(F.sum("nb_connexions")).first()[0] == 3


def test_states_of_no_days(spark, sf_dir):
    silver = cleaning.to_silver(auth_log(spark, sf_dir).withColumn("jour_part", F.expr(f"CAST({DAY} AS INT)")), "jour_part").limit(0)
    for name, state in gold.with_marks(gold.day_states(silver), [4]).items():
        assert state.count() == 1 and gold.merged(state, name).count() == 0


# -- versions --------------------------------------------------------------------------


def test_tables_are_published_together(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert current_paths(spark, lake) == {} and pointers(spark, lake) is None
    with pytest.raises(LookupError):
        read_gold(spark, lake, "a")
    for round_, count in ((1, 3), (2, 5)):
        draft = Draft(spark, lake)
        draft.write({"a": spark.range(count)})
        draft.write({"b": draft.read("a").where("id > 0")})
        if round_ == 2:
            assert read_gold(spark, lake, "a").count() == 3 and read_gold(spark, lake, "b").count() == 2
        draft.publish()
    assert read_gold(spark, lake, "a").count() == 5 and read_gold(spark, lake, "b").count() == 4


def test_a_job_that_ends_midway_leaves_the_former_tables(spark, sf_dir, updated, monkeypatch):
    lake = updated[0]
    jobs.gold_tables(spark, lake)
    before = current_paths(spark, lake)

    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(detection, "compare_criteria", fail)
    with pytest.raises(RuntimeError):
        jobs.detect(spark, lake)
    assert current_paths(spark, lake) == before
    assert_same(read_gold(spark, lake, "validation_redteam"), sf_dir, checks()["validation_redteam_loose"])
    monkeypatch.undo()
    jobs.detect(spark, lake)
    assert_same(read_gold(spark, lake, "validation_redteam"), sf_dir, checks()["validation_redteam"])


def test_a_publication_that_fails_is_not_seen(spark, tmp_path):
    lake = Lake(str(tmp_path))
    draft = Draft(spark, lake)
    draft.write({"a": spark.range(1)})
    draft.publish()
    late = Draft(spark, lake)
    broken = spark.range(10).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        late.write({"a": spark.range(2), "b": broken})
    assert read_gold(spark, lake, "a").count() == 1 and list(current_paths(spark, lake)) == ["a"]


def test_vacuum_keeps_the_latest_versions(spark, tmp_path):
    lake = Lake(str(tmp_path))
    assert vacuum(spark, lake) == []
    for count in range(1, 5):
        draft = Draft(spark, lake)
        draft.write({"a": spark.range(count), **({"b": spark.range(9)} if count == 1 else {})})
        draft.publish()
    gone = vacuum(spark, lake, kept=2)
    assert len(gone) == 2 and not any(Path(p).exists() for p in gone)
    assert vacuum(spark, lake, kept=2) == []
    assert read_gold(spark, lake, "a").count() == 4 and read_gold(spark, lake, "b").count() == 9
    # The first file of pointers still names the only version of b.
    assert len(list(Path(lake.pointers()).glob("part-*.parquet"))) == 3
    assert len(list(Path(lake.base, lake.VERSIONS).iterdir())) == 3
