"""The jobs from raw files to served results, and invariants between the tables."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from compare import assert_same
from pyspark.sql import functions as F

from vigilog.operators import detection, gold
from vigilog.plans import jobs
from vigilog.plans.fixture import attack_list, auth_log
from vigilog.plans.oracle import checks
from vigilog.sources.lake import GOLD_TABLES, Lake, current_paths, read_gold, read_silver, register_views, write_table
from vigilog.sources.schemas import AUTH_SILVER


@pytest.fixture(scope="module")
def built(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    auth, redteam = str(base / "auth"), str(base / "redteam")
    auth_log(spark, sf_dir).write.option("compression", "gzip").csv(auth)
    attack_list(spark, sf_dir).write.option("compression", "gzip").csv(redteam)
    lake = Lake(str(base / "lake"))
    jobs.land(spark, lake, auth, redteam)
    reports = {f"profile_{k}": v for k, v in jobs.profile(spark, lake).items()}
    reports.update(jobs.silver(spark, lake))
    reports.update(jobs.gold_tables(spark, lake))
    loose = read_gold(spark, lake, "validation_redteam").count()
    reports.update(jobs.detect(spark, lake))
    return lake, reports, loose


def table(spark, lake, name):
    return read_gold(spark, lake, name)


@pytest.mark.parametrize("name", [*GOLD_TABLES, "comparaison_criteres_detection"])
def test_written_tables(spark, sf_dir, built, name):
    assert assert_same(table(spark, built[0], name), sf_dir, checks()[name]) > 0


@pytest.mark.parametrize(
    "report, check",
    [
        ("profile_freq_logon_type", "diag_freq_logon_type"),
        ("profile_malformed_source_computer", "diag_malformed_source_computer"),
        ("profile_time_bounds", "diag_time_bounds"),
        ("profile_missing_counts", "diag_missing_counts"),
        ("silver_row_count", "silver_row_count"),
        ("silver_category_distribution", "silver_category_distribution"),
        ("silver_residual_missing", "silver_residual_missing"),
        ("gold_row_counts", "gold_row_counts"),
        ("taux_detection_loose", "taux_detection_loose"),
        ("taux_detection_rigoureux", "taux_detection_rigoureux"),
        ("seuils_detection", "seuils_detection"),
    ],
)
def test_reports(sf_dir, built, report, check):
    assert_same(built[1][report], sf_dir, checks()[check])


def test_served_queries(spark, sf_dir, built):
    served = jobs.serve(spark, built[0])
    assert len(served) == 8
    for name in served:
        assert_same(spark.read.parquet(built[0].report(name)), sf_dir, checks()[name])
    assert spark.read.parquet(built[0].report("evolution_temporelle")).count() == 31


def test_loose_validation_stays(spark, sf_dir, built):
    assert_same(spark.read.parquet(built[0].report("validation_redteam_loose")), sf_dir, checks()["validation_redteam_loose"])


def test_silver_schema_survives(spark, built):
    silver = read_silver(spark, built[0].silver())
    assert silver.schema == AUTH_SILVER
    assert read_silver(spark, built[0].silver(), with_day=True).columns[-1] == "jour_part"


def test_invariants(spark, built):
    lake, _, loose = built
    silver = read_silver(spark, lake.silver())
    total = silver.count()
    known = silver.where("source_user_domain IS NOT NULL").count()

    def added(name, column):
        return table(spark, lake, name).agg(F.sum(column)).first()[0]

    assert added("volume_par_jour", "nb_connexions") == total
    assert added("connexions_par_utilisateur_heure", "nb_connexions") == known
    rare = table(spark, lake, "paires_rares_utilisateur_machine").drop("nb_occurrences")
    machine_pairs = silver.where("categorie_destination = 'machine'").select(rare.columns)
    assert rare.join(machine_pairs, rare.columns, "leftanti").count() == 0
    strict = table(spark, lake, "validation_redteam").count()
    compared = table(spark, lake, "comparaison_criteres_detection").first()
    assert strict == compared.total_evenements
    assert strict != loose


def test_comparison_counts_the_flags(spark, built):
    lake = built[0]
    attacks = detection.measured(spark.read.parquet(lake.attacks()))
    log = read_silver(spark, lake.silver(), with_day=True)
    tables = [
        table(spark, lake, name)
        for name in (
            "taux_echec_par_utilisateur",
            "machines_distinctes_par_utilisateur",
            "paires_rares_utilisateur_machine",
        )
    ]
    flags = detection.detection_flags(attacks, log, *tables)
    summed = flags.agg(*[F.sum(F.col(f).cast("int")) for f in detection.CRITERIA.values()]).first()
    compared = detection.compare_criteria(attacks, detection.matches(attacks, log), *tables).first()
    assert list(summed) == [compared[f"detectes_{name}"] for name in detection.CRITERIA]


@pytest.mark.parametrize("name", sorted(gold.ORDERS))
def test_tables_are_written_in_order(spark, built, name):
    """Files by name, and rows within a file, follow the order of the table."""
    path = current_paths(spark, built[0])[name].removeprefix("file:")
    rows = [row for part in sorted(Path(path).glob("part-*.parquet")) for row in pq.read_table(part).to_pylist()]

    def key(row):
        values = [(-row[c[1:]] if c[0] == "-" else row[c]) for c in gold.ORDERS[name]]
        return [(v is not None, v.encode() if isinstance(v, str) else v) for v in values]

    assert len(rows) > 20 and rows == sorted(rows, key=key)


def test_views_for_sql_users(spark, built):
    lake = built[0]
    names = register_views(spark, lake)
    assert {"auth_brut", "auth_silver", "redteam", "validation_redteam"} <= set(names)
    joined = spark.sql(
        """SELECT count(*) AS n FROM redteam r JOIN auth_silver s
           ON r.user_domain = s.source_user_domain AND r.destination_computer = s.destination_computer
           AND r.temps_secondes = s.temps_secondes"""
    ).first().n
    assert joined == spark.table("validation_redteam").count()
    assert register_views(spark, Lake(lake.base + "/nothing")) == []


def test_codecs(spark, tmp_path, built):
    small = spark.range(10)
    write_table(small, str(tmp_path / "zstd"))
    write_table(small, str(tmp_path / "default"), compression=None)
    assert [p.name for p in (tmp_path / "zstd").glob("*.zstd.parquet")]
    assert not [p.name for p in (tmp_path / "default").glob("*.zstd.parquet")]
    assert spark.read.parquet(str(tmp_path / "default")).count() == 10


def test_jobs_can_be_run_again(spark, built):
    lake = built[0]
    before = table(spark, lake, "comparaison_criteres_detection").collect()
    jobs.gold_tables(spark, lake)
    jobs.detect(spark, lake)
    assert table(spark, lake, "comparaison_criteres_detection").collect() == before


def test_command_line(built, capsys):
    jobs.main(["serve", "--lake", built[0].base])
    shown = capsys.readouterr().out
    assert "--- top_machines: 20 rows in " in shown and "|au_moins_un|" in shown


def test_command_line_wants_its_inputs():
    for arguments in (["land", "--lake", "x"], ["land", "--lake", "x", "--auth", "y"], ["gold"], ["nothing", "--lake", "x"]):
        with pytest.raises(SystemExit):
            jobs.main(arguments)


def test_pairs_serve_the_same_tables(spark, built):
    silver = read_silver(spark, built[0].silver())
    direct = gold.failure_rate_by_user(gold.attempts(silver))
    from_pairs = gold.failure_rate_by_user(gold.pair_activity(silver))
    assert direct.exceptAll(from_pairs).count() == 0
    assert from_pairs.exceptAll(direct).count() == 0
