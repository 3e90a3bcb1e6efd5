"""Jobs for spark-submit: each reads one zone of a lake and writes the next.

    spark-submit vigilog/plans/jobs.py land    --lake URI --auth FILES --redteam FILES
    spark-submit vigilog/plans/jobs.py profile --lake URI
    spark-submit vigilog/plans/jobs.py silver  --lake URI
    spark-submit vigilog/plans/jobs.py gold    --lake URI
    spark-submit vigilog/plans/jobs.py detect  --lake URI
    spark-submit vigilog/plans/jobs.py serve   --lake URI
    spark-submit vigilog/plans/jobs.py update  --lake URI --auth FILES
    spark-submit vigilog/plans/jobs.py vacuum  --lake URI

A job may be run again at any time: it overwrites what it wrote and reads nothing that
it overwrites. Gold tables are published together once all are written, so they are readable at
any time, however a job ends; vacuum deletes versions that are no longer the current or the
former one.

update takes files that hold whole days, and of these the ones not landed before: their days
are landed, cleaned and aggregated, in place of the same days if the lake has them, and the
Gold tables are merged anew from the partial aggregates of all days. Only the order of gold and detect matters: both write validation_redteam,
gold its first, loose form and detect the strict one in its place, so run detect again
after gold. The loose form also stays as the report validation_redteam_loose.
"""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.operators import cleaning, detection, gold, profiling, serving
from vigilog.sources import raw
from vigilog.sources.buckets import write_bucketed
from vigilog.sources.lake import (
    COMPARISON_TABLE,
    DAY_PARTITION,
    FILE_ROWS,
    GOLD_TABLES,
    Lake,
    current_paths,
    materialise,
    read_gold,
    read_landed,
    read_silver,
    scratch_path,
    write_all,
    write_by_day,
    write_table,
)
from vigilog.sources.versions import Draft, vacuum

VALIDATION_TABLE = "validation_redteam"
SHOWN = 25


def land(spark: SparkSession, lake: Lake, auth_path: str, redteam_path: str, keep_rejects: bool = False) -> None:
    """Read of the raw files into splittable copies of the same columns, and their manifest.

    All columns are read here, so a malformed line anywhere stops the job; with ``keep_rejects``
    it goes to the table of rejects instead, with the reason.
    A gzip file is one partition however large it is, so its rows have to be shuffled
    once. Gathering them by day in that shuffle spares every later job another one.
    """
    objects = raw.manifest(spark, auth_path)
    _land_lines(spark, lake, _paths(objects), lake.landed(), keep_rejects, "overwrite")
    write_table(raw.manifest_of(objects, spark.read.parquet(lake.landed())), lake.manifest())
    write_table(raw.read_redteam(spark, redteam_path), lake.attacks())


def _paths(objects: DataFrame) -> list[str]:
    found = sorted(row[0] for row in objects.where("length > 0").select("path").collect())
    if not found:
        raise ValueError("no file to land")
    return found


def _land_lines(spark: SparkSession, lake: Lake, paths: list[str], target: str, keep_rejects: bool, mode: str) -> None:
    """Lines of files by day, each with the object it came from."""
    if not keep_rejects:
        write_by_day(raw.read_auth(spark, paths, lineage=True), target)
        return
    # Files are read once; what is written of them is splittable and parted.
    lines = raw.read_auth_split(spark, paths).withColumn("rejet", F.col(raw.CORRUPT).isNotNull())
    lines.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).partitionBy("rejet").parquet(lake.reading())
    read = spark.read.schema(lines.schema).parquet(lake.reading())
    write_by_day(read.where("NOT rejet").drop("rejet", raw.CORRUPT), target)
    raw.rejects(read.where("rejet")).write.mode(mode).option("compression", "zstd").parquet(lake.rejects())


def profile(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Ten reports from one pass over the log."""
    profiled = materialise(profiling.one_pass(read_landed(spark, lake.landed())), lake.report("profil"))
    return _save_reports(lake, profiling.reports_of(profiled))


def silver(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    landed = read_landed(spark, lake.landed(), with_day=True)
    write_by_day(cleaning.to_silver(landed, DAY_PARTITION), lake.silver())
    cleaned = read_silver(spark, lake.silver())
    return _save_reports(
        lake,
        {
            "silver_row_count": cleaning.row_count(cleaned),
            "silver_category_distribution": cleaning.category_distribution(cleaned),
            "silver_residual_missing": cleaning.residual_missing(cleaned),
        },
    )


def gold_tables(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The seven aggregates, the first validation and the row count of each table."""
    _write_states(gold.day_states(read_silver(spark, lake.silver(), with_day=True)), lake, replace_days=False)
    return _publish_gold(spark, lake)


def update(spark: SparkSession, lake: Lake, auth_path: str, keep_rejects: bool = False, again: bool = False) -> dict[str, DataFrame]:
    """Land, clean and aggregate the days of new files, and merge the Gold tables anew.

    Only files that the manifest doesn't know are read; without any, nothing is done
    (``again``: all that are listed). Files hold whole days. Days are replaced, so a delivery
    can be corrected; no other day is read or written, but for the merge of the partial
    aggregates. The manifest is added to last: an update that ended midway is done again.
    """
    objects = raw.manifest(spark, auth_path)
    if not again:
        objects = raw.not_landed(objects, _manifest(spark, lake))
    objects = materialise(objects, scratch_path(spark, "objects"))
    if objects.where("length > 0").isEmpty():
        return {}
    _land_lines(spark, lake, _paths(objects), lake.delivery(), keep_rejects, "append")
    delivered = spark.read.parquet(lake.delivery())
    write_by_day(delivered, lake.landed(), replace_days=True)
    write_by_day(cleaning.to_silver(delivered, DAY_PARTITION), lake.silver(), replace_days=True)
    # The days are read from the folders' names.
    days = [row[0] for row in delivered.select(DAY_PARTITION).distinct().collect()]
    added = read_silver(spark, lake.silver(), with_day=True).where(F.col(DAY_PARTITION).isin(days))
    _write_states(gold.with_marks(gold.day_states(added), days), lake, replace_days=True)
    reports = _publish_gold(spark, lake)
    new = raw.not_landed(raw.manifest_of(objects, delivered), _manifest(spark, lake))
    materialise(new, scratch_path(spark, "manifest")).write.mode("append").option("compression", "zstd").parquet(lake.manifest())
    return reports


def _manifest(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(raw.MANIFEST).parquet(lake.manifest())


def _write_states(states: dict[str, DataFrame], lake: Lake, replace_days: bool) -> None:
    """Partial aggregates by day. Rows of a day are gathered by size, so a day is a few files."""
    with ThreadPoolExecutor(len(states)) as pool:
        for _ in pool.map(lambda name: write_by_day(states[name].hint("rebalance", F.col(DAY_PARTITION)), lake.state(name), replace_days=replace_days), states):
            pass


def _publish_gold(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Gold tables merged from the partial aggregates of all days, published together."""
    draft = Draft(spark, lake)
    states = {name: spark.read.parquet(lake.state(name)) for name in gold.STATES}
    attacks = detection.measured(spark.read.parquet(lake.attacks()))
    # By user, so that the tables of users need no further shuffle.
    pairs = write_bucketed(gold.merged(states["paires"], "paires"), lake.pairs(), [gold.USER], name="paires")
    draft.write(gold.in_order(gold.tables_from_states(states) | gold.tables_from_pairs(pairs)))
    loose = detection.validation_loose(attacks, draft.read("anomalies_horaires"))
    draft.write({VALIDATION_TABLE: _in_few_files(attacks, loose)})
    written = {name: draft.read(name) for name in GOLD_TABLES}
    reports = _save_reports(
        lake,
        {
            "gold_row_counts": gold.row_counts(written),
            "taux_detection_loose": detection.detection_rate(written[VALIDATION_TABLE], "nb_detectes"),
            "validation_redteam_loose": written[VALIDATION_TABLE],
        },
    )
    draft.publish()
    return reports


def detect(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Strict validation in place of the first one, thresholds and comparison of criteria."""
    log = read_silver(spark, lake.silver(), with_day=True)
    attacks = detection.measured(spark.read.parquet(lake.attacks()))
    rates = read_gold(spark, lake, "taux_echec_par_utilisateur")
    machines = read_gold(spark, lake, "machines_distinctes_par_utilisateur")
    pairs = read_gold(spark, lake, "paires_rares_utilisateur_machine")
    draft = Draft(spark, lake)
    draft.write({VALIDATION_TABLE: _in_few_files(attacks, detection.validation_strict(attacks, log))})
    # The log is matched once; the rate and the comparison start from the written matches.
    validation = draft.read(VALIDATION_TABLE)
    matched = detection.as_matches(validation)
    draft.write({COMPARISON_TABLE: detection.compare_criteria(attacks, matched, rates, machines, pairs)})
    reports = _save_reports(
        lake,
        {
            "taux_detection_rigoureux": detection.detection_rate(validation, "nb_a_horaire_inhabituel"),
            "seuils_detection": detection.thresholds(rates, machines),
        },
    )
    draft.publish()
    return reports


def serve(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The dashboard queries, written to the lake in full from the Gold tables."""
    published = current_paths(spark, lake)

    def table(name: str) -> DataFrame:
        return spark.read.parquet(published[name])

    served = {
        "top_machines": serving.top_machines(table("activite_par_machine")),
        "evolution_temporelle": serving.volume_over_time(table("volume_par_jour")),
        "top_utilisateurs": serving.top_users(table("taux_echec_par_utilisateur")),
        "activite_par_heure": serving.activity_by_hour(table("connexions_par_utilisateur_heure")),
        "efficacite_criteres": serving.criteria_efficacy(table(COMPARISON_TABLE)),
        "relation_utilisateur_machine": serving.user_machine_relations(table("paires_rares_utilisateur_machine")),
        "anomalies_horaires_classees": serving.off_hours_ranking(table("anomalies_horaires")),
        "diversite_machines": serving.machine_diversity(table("machines_distinctes_par_utilisateur")),
    }
    return _save_reports(lake, served)


def _in_few_files(attacks: detection.AttackList, df: DataFrame) -> DataFrame:
    """Few matches come out of very many tasks where the list was broadcast; AQE gathers
    them by size. The other way has dealt its rows out evenly already."""
    return df.hint("rebalance") if attacks.small else df


def _save_reports(lake: Lake, reports: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Written first, so that showing them does not compute them again."""
    write_all({lake.report(name): df for name, df in reports.items()})
    return {name: df.sparkSession.read.parquet(lake.report(name)) for name, df in reports.items()}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["land", "profile", "silver", "gold", "detect", "serve", "update", "vacuum"])
    parser.add_argument("--lake", required=True, help="base URI of the zones")
    parser.add_argument("--auth", help="raw authentication log (CSV, optionally gzip)")
    parser.add_argument("--redteam", help="raw list of known attacks (CSV, optionally gzip)")
    parser.add_argument("--keep-rejects", action="store_true", help="land, update: put malformed lines aside instead of stopping")
    parser.add_argument("--again", action="store_true", help="update: also read files that were landed before")
    given = parser.parse_args(arguments)
    if given.job == "land" and not (given.auth and given.redteam):
        parser.error("land needs --auth and --redteam")
    if given.job == "update" and not given.auth:
        parser.error("update needs --auth")

    spark = SparkSession.builder.appName(f"vigilog-{given.job}").getOrCreate()
    lake = Lake(given.lake)
    if given.job == "land":
        land(spark, lake, given.auth, given.redteam, given.keep_rejects)
        return
    if given.job == "vacuum":
        for path in vacuum(spark, lake):
            print(f"deleted {path}")
        return
    run = {"profile": profile, "silver": silver, "gold": gold_tables, "detect": detect, "serve": serve}
    reports = update(spark, lake, given.auth, given.keep_rejects, given.again) if given.job == "update" else run[given.job](spark, lake)
    for name, df in reports.items():
        print(f"--- {name}: {df.count()} rows in {lake.report(name)}, of which up to {SHOWN} are shown")
        df.show(SHOWN, truncate=False)


if __name__ == "__main__":
    main()
