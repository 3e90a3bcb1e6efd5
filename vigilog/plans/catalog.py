"""Every dataset of the project as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.operators import cleaning, detection, gold, profiling, serving
from vigilog.operators.detection import AttackList
from vigilog.plans import jobs
from vigilog.plans.fixture import attack_list, auth_log
from vigilog.sources import buckets, curve, lake, raw

Query = Callable[[SparkSession, str], DataFrame]


def _on_raw(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(auth_log(spark, sf_dir))


def _on_silver(make: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: make(cleaning.to_silver(auth_log(spark, sf_dir)))


def _on_attacks(make: Callable[[AttackList, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        attacks = detection.measured(attack_list(spark, sf_dir))
        return make(attacks, cleaning.to_silver(auth_log(spark, sf_dir)))

    return query


# -- raw files: the derived log is written as gzip CSV and read back ------------------


def _csv_folder(df: DataFrame, name: str) -> str:
    path = lake.scratch_path(df.sparkSession, name)
    df.write.option("compression", "gzip").option("header", False).option("escape", '"').csv(path)
    return path


def bronze_auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.read_auth(spark, _csv_folder(auth_log(spark, sf_dir), "auth"))


def bronze_redteam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.read_redteam(spark, _csv_folder(attack_list(spark, sf_dir), "redteam"))


def bronze_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines of a raw log written in the order of all its columns."""
    log = auth_log(spark, sf_dir)
    return raw.preview(spark, _csv_folder(log.orderBy(*log.columns), "auth"))


def bronze_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lake.scratch_path(spark, "landed")
    lake.write_by_day(bronze_auth(spark, sf_dir), path)
    return lake.read_landed(spark, path)


def silver_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lake.scratch_path(spark, "silver")
    lake.write_by_day(cleaning.to_silver(auth_log(spark, sf_dir)), path)
    return lake.read_silver(spark, path)


# -- detection ------------------------------------------------------------------------


def _loose(attacks: AttackList, silver: DataFrame) -> DataFrame:
    return detection.validation_loose(attacks, gold.off_hours_activity(silver))


def _loose_rate(attacks: AttackList, silver: DataFrame) -> DataFrame:
    return detection.detection_rate_loose(attacks, gold.off_hours_activity(silver))


def _pairs(silver: DataFrame) -> DataFrame:
    """The shared pre-aggregate, written once: several tables are then read from it.

    The write is a job of its own, which runs when a query that needs it is built.
    """
    return lake.materialise(gold.pair_activity(silver), lake.scratch_path(silver.sparkSession, "paires"))


def _criteria_tables(silver: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    pairs = _pairs(silver)
    return gold.failure_rate_by_user(pairs), gold.machines_by_user(pairs), gold.rare_pairs(pairs)


def _flags(attacks: AttackList, silver: DataFrame) -> DataFrame:
    return detection.detection_flags(attacks, silver, *_criteria_tables(silver))


def _comparison(attacks: AttackList, silver: DataFrame) -> DataFrame:
    return detection.compare_criteria(attacks, detection.matches(attacks, silver), *_criteria_tables(silver))


def _thresholds(silver: DataFrame) -> DataFrame:
    """Building this already reads the log once and writes the pairs both tables start from."""
    rates, machines, _ = _criteria_tables(silver)
    return detection.thresholds(rates, machines)


def _failure_rates(silver: DataFrame) -> DataFrame:
    return gold.failure_rate_by_user(gold.attempts(silver))


# Table names. A single table is cheapest straight from the log: nothing is
# written in between.
GOLD = {
    "connexions_par_utilisateur_heure": gold.connections_by_user_hour,
    "activite_par_machine": lambda silver: gold.activity_by_machine(gold.pair_activity(silver)),
    "anomalies_horaires": gold.off_hours_activity,
    "taux_echec_par_utilisateur": _failure_rates,
    "machines_distinctes_par_utilisateur": lambda silver: gold.machines_by_user(gold.pair_activity(silver)),
    "volume_par_jour": gold.volume_by_day,
    "paires_rares_utilisateur_machine": lambda silver: gold.rare_pairs(gold.pair_activity(silver)),
}


def _gold_counts(attacks: AttackList, silver: DataFrame) -> DataFrame:
    """Off-hours activity and the pairs serve several counts, so both are written once."""
    tables = {**gold.tables_from_log(silver), **gold.tables_from_pairs(_pairs(silver))}
    off_hours = lake.materialise(tables["anomalies_horaires"], lake.scratch_path(silver.sparkSession, "anomalies"))
    tables["anomalies_horaires"] = off_hours
    return gold.row_counts(tables, {"validation_redteam": detection.loose_row_count(attacks, off_hours)})


# -- the whole way through a lake: raw files, landed, cleaned, built, compared ----------


@lru_cache(maxsize=8)
def _built_lake(application: str, sf_dir: str) -> lake.Lake:
    """A lake taken through all jobs, once for each session and data; several queries read it."""
    spark = SparkSession.active()
    made = lake.Lake(lake.scratch_path(spark, "lake"))
    jobs.land(spark, made, _csv_folder(auth_log(spark, sf_dir), "auth"), _csv_folder(attack_list(spark, sf_dir), "redteam"))
    jobs.silver(spark, made)
    jobs.gold_tables(spark, made)
    jobs.detect(spark, made)
    return made


def _lake(spark: SparkSession, sf_dir: str) -> lake.Lake:
    return _built_lake(spark.sparkContext.applicationId, sf_dir)


def lake_gold_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts the gold job reports for the tables it has written."""
    return spark.read.parquet(_lake(spark, sf_dir).report("gold_row_counts"))


def lake_validation_redteam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict validation that the detect job publishes in place of the loose one."""
    return lake.read_gold(spark, _lake(spark, sf_dir), "validation_redteam")


def lake_comparaison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison of criteria that the detect job publishes."""
    return lake.read_gold(spark, _lake(spark, sf_dir), "comparaison_criteres_detection")


# -- tables in buckets of a key ---------------------------------------------------------


def user_profiles_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is known of each user, joined without a shuffle over pairs in buckets of users."""
    pairs = gold.pair_activity(cleaning.to_silver(auth_log(spark, sf_dir)))
    return gold.user_profiles(buckets.write_bucketed(pairs, lake.scratch_path(spark, "paires"), [gold.USER]))


def silver_distinct_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log without duplicates, from a copy in buckets of its seconds."""
    log = buckets.write_bucketed(auth_log(spark, sf_dir), lake.scratch_path(spark, "secondes"), ["temps_secondes"])
    return cleaning.to_silver_distinct(log)


# -- a log ordered along a curve of users and machines -----------------------------------


def validation_redteam_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict validation that reads only the cells of the list's pairs."""
    path = lake.scratch_path(spark, "ordonne")
    curve.write_along_curve(cleaning.to_silver(auth_log(spark, sf_dir)), path)
    listed = attack_list(spark, sf_dir)
    log = curve.read_for_pairs(spark, path, listed, ("user_domain", "destination_computer"))
    return detection.validation_strict(detection.measured(listed), log.drop(curve.CELL))


# -- what was landed of each raw object ---------------------------------------------------


def bronze_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and first and last second of each raw file, one file a day, from the landed lines."""
    path = lake.scratch_path(spark, "auth")
    log = auth_log(spark, sf_dir).withColumn("day", F.floor(F.col("temps_secondes") / 86400))
    log.repartition("day").write.partitionBy("day").option("compression", "gzip").option("escape", '"').csv(path)
    landed = lake.scratch_path(spark, "landed")
    objects = raw.manifest(spark, path)
    lake.write_by_day(raw.read_auth(spark, [row[0] for row in objects.select("path").collect()], lineage=True), landed)
    found = raw.manifest_of(objects, spark.read.parquet(landed))
    return found.select(F.regexp_extract("path", "/(day=[^/]*)/", 1).alias("objet"), "nb_lignes", "premiere_seconde", "derniere_seconde")


# -- a lake that gets its last days later ----------------------------------------------


def _long_form(spark: SparkSession, made: lake.Lake) -> DataFrame:
    """The seven aggregates as one table: name, key, and the counts."""
    second = F.round(F.col("heure_du_jour") * 3600).cast("bigint").cast("string")
    # Which columns of a table are its key and its counts.
    columns = {
        "connexions_par_utilisateur_heure": (["source_user_domain", "heure"], ["nb_connexions", "nb_echecs"]),
        "activite_par_machine": (["destination_computer", "categorie_destination"], ["nb_evenements", "nb_utilisateurs_distincts"]),
        "anomalies_horaires": (["source_user_domain", "destination_computer", second], ["nb_connexions_horaire_inhabituel"]),
        "taux_echec_par_utilisateur": (["source_user_domain"], ["total_tentatives", "nb_echecs"]),
        "machines_distinctes_par_utilisateur": (["source_user_domain"], ["nb_machines_distinctes", "nb_connexions_totales"]),
        "volume_par_jour": (["jour"], ["nb_connexions", "nb_echecs"]),
        "paires_rares_utilisateur_machine": (["source_user_domain", "destination_computer"], ["nb_occurrences"]),
    }
    rows = []
    for name, (keys, counts) in columns.items():
        key = F.concat_ws("|", *[F.coalesce(F.col(k) if isinstance(k, str) else k, F.lit("")).cast("string") for k in keys])
        first, second_count = F.col(counts[0]), F.col(counts[1]) if len(counts) > 1 else F.lit(0)
        rows.append(lake.read_gold(spark, made, name).select(F.lit(name).alias("nom"), key.alias("cle"), first.cast("bigint").alias("n1"), second_count.cast("bigint").alias("n2")))
    return reduce(DataFrame.unionByName, rows)


def lake_updated_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All aggregates of a lake that got the second half of its days, and a corrected one,
    after its Gold tables were first built."""
    log = auth_log(spark, sf_dir)
    middle = log.agg(F.floor((F.min("temps_secondes") + F.max("temps_secondes")) / 2 / 86400).cast("int")).first()[0] or 0
    day = F.floor(F.col("temps_secondes") / 86400)
    made = lake.Lake(lake.scratch_path(spark, "lake"))
    # Of the middle day the first delivery has only the even seconds.
    first = log.where((day < middle) | ((day == middle) & (F.col("temps_secondes") % 2 == 0)))
    jobs.land(spark, made, _csv_folder(first, "auth"), _csv_folder(attack_list(spark, sf_dir), "redteam"))
    jobs.silver(spark, made)
    jobs.gold_tables(spark, made)
    jobs.update(spark, made, _csv_folder(log.where(day >= middle), "auth"))
    return _long_form(spark, made)


def _of_large_list(make: Callable[[AttackList, DataFrame], DataFrame]) -> Query:
    """A query over the attacks, taking the way of a list too large to send out."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        attacks = detection.measured(attack_list(spark, sf_dir), limit=0)
        return make(attacks, cleaning.to_silver(auth_log(spark, sf_dir)))

    return query


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "bronze_auth": bronze_auth,
        "bronze_redteam": bronze_redteam,
        "bronze_preview": bronze_preview,
        "bronze_landed": bronze_landed,
    }
    for column in ("authentication_type", "logon_type", "authentication_orientation", "success_failure"):
        found[f"diag_freq_{column}"] = _on_raw(lambda df, c=column: profiling.frequencies(df, c))
    for side in ("source", "destination"):
        found[f"diag_malformed_{side}_user"] = _on_raw(
            lambda df, c=f"{side}_user_domain": profiling.malformed_accounts(df, c)
        )
        found[f"diag_malformed_{side}_computer"] = _on_raw(
            lambda df, c=f"{side}_computer": profiling.malformed_computers(df, c)
        )
    found["diag_time_bounds"] = _on_raw(profiling.time_bounds)
    found["diag_missing_counts"] = _on_raw(profiling.missing_counts)
    found["silver_auth"] = _on_silver(lambda silver: silver)
    found["silver_auth_distinct"] = _on_raw(cleaning.to_silver_distinct)
    found["silver_written"] = silver_written
    found["silver_row_count"] = _on_silver(cleaning.row_count)
    found["silver_category_distribution"] = _on_silver(cleaning.category_distribution)
    found["silver_residual_missing"] = _on_silver(cleaning.residual_missing)
    found["silver_sample"] = _on_silver(cleaning.sample)
    found.update({name: _on_silver(make) for name, make in GOLD.items()})
    found["validation_redteam_loose"] = _on_attacks(_loose)
    found["validation_redteam"] = _on_attacks(detection.validation_strict)
    found["taux_detection_loose"] = _on_attacks(_loose_rate)
    found["taux_detection_rigoureux"] = _on_attacks(
        lambda attacks, silver: detection.detection_rate_strict(detection.matches(attacks, silver))
    )
    found["seuils_detection"] = _on_silver(_thresholds)
    found["detection_flags"] = _on_attacks(_flags)
    found["comparaison_criteres_detection"] = _on_attacks(_comparison)
    found["gold_row_counts"] = _on_attacks(_gold_counts)
    found["detection_flags_large_list"] = _of_large_list(_flags)
    found["validation_redteam_large_list"] = _of_large_list(detection.validation_strict)
    found["validation_redteam_loose_large_list"] = _of_large_list(_loose)
    found["comparaison_criteres_large_list"] = _of_large_list(_comparison)
    found["lake_gold_row_counts"] = lake_gold_row_counts
    found["lake_validation_redteam"] = lake_validation_redteam
    found["lake_comparaison"] = lake_comparaison
    found["lake_updated_gold"] = lake_updated_gold
    found["user_profiles_colocated"] = user_profiles_colocated
    found["silver_auth_distinct_colocated"] = silver_distinct_colocated
    found["bronze_manifest"] = bronze_manifest
    found["validation_redteam_ordered"] = validation_redteam_ordered
    found["diag_one_pass"] = _on_raw(profiling.one_pass)
    for name, table, serve in (
        ("top_machines", "activite_par_machine", serving.top_machines),
        ("evolution_temporelle", "volume_par_jour", serving.volume_over_time),
        ("top_utilisateurs", "taux_echec_par_utilisateur", serving.top_users),
        ("activite_par_heure", "connexions_par_utilisateur_heure", serving.activity_by_hour),
        ("relation_utilisateur_machine", "paires_rares_utilisateur_machine", serving.user_machine_relations),
        ("anomalies_horaires_classees", "anomalies_horaires", serving.off_hours_ranking),
        ("diversite_machines", "machines_distinctes_par_utilisateur", serving.machine_diversity),
    ):
        found[name] = _on_silver(lambda silver, t=table, s=serve: s(GOLD[t](silver)))
    found["efficacite_criteres"] = _on_attacks(lambda a, s: serving.criteria_efficacy(_comparison(a, s)))
    return found
