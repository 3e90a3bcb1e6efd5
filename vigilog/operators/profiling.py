"""Profiling of the raw log before cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.columns import MISSING, count_if, is_not_computer_name, lacks_at_sign

TOP = 20

# Report column -> raw column; the result column keeps "?" as an ordinary value.
MISSING_REPORT = {
    "nb_manquants_source_user": "source_user_domain",
    "nb_manquants_dest_user": "destination_user_domain",
    "nb_manquants_source_computer": "source_computer",
    "nb_manquants_dest_computer": "destination_computer",
    "nb_manquants_auth_type": "authentication_type",
    "nb_manquants_logon_type": "logon_type",
    "nb_manquants_orientation": "authentication_orientation",
}


def frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("nb")).orderBy(F.desc("nb"), column)


def _most_frequent(df: DataFrame, column: str, condition: Column, top: int) -> DataFrame:
    return frequencies(df.where(condition), column).limit(top)


def malformed_accounts(raw: DataFrame, column: str, top: int = TOP) -> DataFrame:
    """Most frequent accounts without a domain; ties in the ranking go by name."""
    return _most_frequent(raw, column, lacks_at_sign(F.col(column)), top)


def malformed_computers(raw: DataFrame, column: str, top: int = TOP) -> DataFrame:
    """Most frequent names that are not C, digits and an optional ``$``."""
    return _most_frequent(raw, column, is_not_computer_name(F.col(column)), top)


def time_bounds(raw: DataFrame) -> DataFrame:
    seconds = F.col("temps_secondes")
    return raw.agg(
        F.min(seconds).alias("min_temps"),
        F.max(seconds).alias("max_temps"),
        count_if(seconds < 0).alias("nb_negatifs"),
        F.count(F.lit(1)).alias("nb_total_lignes"),
    )


def missing_counts(raw: DataFrame) -> DataFrame:
    counts = [count_if(F.col(source) == MISSING).alias(name) for name, source in MISSING_REPORT.items()]
    return raw.agg(*counts, F.count(F.lit(1)).alias("nb_total_lignes"))


# -- everything in one pass --------------------------------------------------------------

# The profiled columns. A measure is named by its kind and column.
FREQUENCY_COLUMNS = ("authentication_type", "logon_type", "authentication_orientation", "success_failure")
USER_COLUMNS = ("source_user_domain", "destination_user_domain")
COMPUTER_COLUMNS = ("source_computer", "destination_computer")
# The measure that every line is in.
EVERY_LINE = f"freq_{FREQUENCY_COLUMNS[0]}"


def one_pass(raw: DataFrame) -> DataFrame:
    """(mesure, valeur, nb, min_temps, max_temps, nb_negatifs): all that is profiled, counted together.

    Each line becomes one row per measure it belongs to, which the aggregate below the
    shuffle takes in at once; only distinct values leave a task. The reports are read off it.
    """
    wanted = [(f"freq_{c}", c, F.lit(True)) for c in FREQUENCY_COLUMNS]
    wanted += [(f"malformed_{c}", c, F.coalesce(lacks_at_sign(F.col(c)), F.lit(False))) for c in USER_COLUMNS]
    wanted += [(f"malformed_{c}", c, F.coalesce(is_not_computer_name(F.col(c)), F.lit(False))) for c in COMPUTER_COLUMNS]
    cells = [cell for name, column, belongs in wanted for cell in (F.lit(name), F.col(column), belongs)]
    rows = raw.select("temps_secondes", F.stack(F.lit(len(wanted)), *cells).alias("mesure", "valeur", "compte"))
    seconds = F.col("temps_secondes")
    return (
        rows.where("compte")
        .groupBy("mesure", "valeur")
        .agg(
            F.count(F.lit(1)).alias("nb"),
            F.min(seconds).alias("min_temps"),
            F.max(seconds).alias("max_temps"),
            count_if(seconds < 0).alias("nb_negatifs"),
        )
    )


def reports_of(profile: DataFrame, top: int = TOP) -> dict[str, DataFrame]:
    """The ten reports, from the rows of `one_pass`."""

    def counted(name: str, column: str) -> DataFrame:
        return profile.where(F.col("mesure") == name).select(F.col("valeur").alias(column), "nb").orderBy(F.desc("nb"), column)

    found = {f"freq_{c}": counted(f"freq_{c}", c) for c in FREQUENCY_COLUMNS}
    found.update({f"malformed_{c}": counted(f"malformed_{c}", c).limit(top) for c in (*USER_COLUMNS, *COMPUTER_COLUMNS)})
    found["time_bounds"] = profile.where(F.col("mesure") == EVERY_LINE).agg(
        F.min("min_temps").alias("min_temps"), F.max("max_temps").alias("max_temps"), F.sum("nb_negatifs").alias("nb_negatifs"), _lines().alias("nb_total_lignes")
    )
    # A missing mark is an ordinary value of a frequency, and malformed as a name.
    missing = []
    for report, column in MISSING_REPORT.items():
        measure = f"freq_{column}" if column in FREQUENCY_COLUMNS else f"malformed_{column}"
        is_missing = (F.col("mesure") == measure) & (F.col("valeur") == MISSING)
        missing.append(F.sum(F.when(is_missing, F.col("nb")).otherwise(0)).alias(report))
    found["missing_counts"] = profile.agg(*missing, _lines().alias("nb_total_lignes"))
    return found


def _lines() -> Column:
    return F.coalesce(F.sum(F.when(F.col("mesure") == EVERY_LINE, F.col("nb"))), F.lit(0))
