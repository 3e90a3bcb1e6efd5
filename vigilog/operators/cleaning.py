"""Cleaned (Silver) table and the checks made on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.functions import columns as c
from vigilog.operators.profiling import frequencies


def to_silver(raw: DataFrame, *carried: str) -> DataFrame:
    """One narrow projection: typed, with missing values as NULL.

    ``carried`` names columns to keep as they are, such as the day of the layout.
    """
    return raw.select(
        "temps_secondes",
        c.hour_of_day(F.col("temps_secondes")).alias("heure_du_jour"),
        c.null_if_missing("source_user_domain"),
        c.null_if_missing("destination_user_domain"),
        c.null_if_missing("source_computer"),
        c.null_if_missing("destination_computer"),
        c.destination_category(F.col("destination_computer")).alias("categorie_destination"),
        c.canonical_auth_type(F.col("authentication_type")).alias("authentication_type"),
        c.null_if_missing("logon_type"),
        c.null_if_missing("authentication_orientation"),
        c.is_success(F.col("success_failure")).alias("succes"),
        *carried,
    )


def to_silver_distinct(raw: DataFrame) -> DataFrame:
    """Variant without exact duplicates; not the default.

    It shuffles the whole log, but for a log in buckets of ``temps_secondes``: equal lines are of
    one second, so each bucket is made distinct where it is read.
    """
    return to_silver(raw).distinct()


def row_count(silver: DataFrame) -> DataFrame:
    return silver.agg(F.count(F.lit(1)).alias("nb_lignes"))


def category_distribution(silver: DataFrame) -> DataFrame:
    return frequencies(silver, "categorie_destination")


def residual_missing(silver: DataFrame) -> DataFrame:
    """Rows where cleaning left a ``?``; expected 0."""
    left = (F.col("authentication_type") == c.MISSING) | (F.col("logon_type") == c.MISSING)
    return silver.where(left).agg(F.count(F.lit(1)).alias("nb_points_interrogation_restants"))


def sample(silver: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in the order of all columns: a heap per task, not a sort of the log."""
    return silver.orderBy(*silver.columns).limit(rows)
