"""Small queries over the Gold tables for a dashboard. Rankings break ties by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.operators.detection import ANY_CRITERION, CRITERIA

TOP = 20


def top_machines(activity: DataFrame, top: int = TOP) -> DataFrame:
    return activity.orderBy(F.desc("nb_evenements"), "destination_computer", "categorie_destination").limit(top)


def volume_over_time(volume: DataFrame) -> DataFrame:
    return volume.orderBy("jour")


def top_users(failure_rates: DataFrame, top: int = TOP) -> DataFrame:
    return failure_rates.orderBy(F.desc("taux_echec_pct"), "source_user_domain").limit(top)


def activity_by_hour(by_user_hour: DataFrame) -> DataFrame:
    return (
        by_user_hour.groupBy("heure")
        .agg(F.sum("nb_connexions").alias("nb_connexions"), F.sum("nb_echecs").alias("nb_echecs"))
        .orderBy("heure")
    )


def criteria_efficacy(comparison: DataFrame) -> DataFrame:
    """The one-row comparison as one row per criterion."""
    names = [*CRITERIA, ANY_CRITERION]
    cells = [(F.lit(n), F.col(f"detectes_{n}"), F.col(f"pct_{n}")) for n in names]
    rows = F.stack(F.lit(len(names)), *[cell for row in cells for cell in row])
    return comparison.select(rows.alias("critere", "detectes", "pct"))


def user_machine_relations(pairs: DataFrame) -> DataFrame:
    """Every rare pair, by user; all of them occur once, so none ranks above another."""
    return pairs.orderBy(F.desc("nb_occurrences"), "source_user_domain", "destination_computer")


def off_hours_ranking(off_hours: DataFrame) -> DataFrame:
    """Every off-hours activity, the most frequent first."""
    return off_hours.orderBy(
        F.desc("nb_connexions_horaire_inhabituel"), "source_user_domain", "destination_computer", "heure_du_jour"
    )


def machine_diversity(machines: DataFrame) -> DataFrame:
    """Every user, those on most machines first."""
    return machines.orderBy(F.desc("nb_machines_distinctes"), "source_user_domain")
