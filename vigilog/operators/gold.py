"""Aggregate (Gold) tables over the cleaned log.

Three tables need distinct users or machines. They are defined over `pair_activity`, one
row per (user, destination, category) with its counts: left as a plan it is the usual
two-step distinct count, so a hot user or machine is split over tasks by the other half
of the pair; written once, it serves all three, and the failure rates too, without
another pass over the log.

The jobs don't aggregate the whole log at once: `day_states` keeps partial aggregates per day
of the layout, and every table is a merge of them, so a day that is added or replaced is the
only one read again. `ORDERS` is the order that four tables are written in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.functions import columns as c
from vigilog.sources.lake import DAY_PARTITION

USER = "source_user_domain"
DESTINATION = "destination_computer"
CATEGORY = "categorie_destination"
MIN_ATTEMPTS = 10
# How written tables are ordered. Names break ties.
ORDERS = {
    "anomalies_horaires": ["-nb_connexions_horaire_inhabituel", USER, DESTINATION, "heure_du_jour"],
    "taux_echec_par_utilisateur": ["-taux_echec_pct", USER],
    "machines_distinctes_par_utilisateur": ["-nb_machines_distinctes", USER],
    "volume_par_jour": ["jour"],
}


def attempts(silver: DataFrame) -> DataFrame:
    """Every log line as one attempt of its user."""
    return silver.select(
        USER,
        F.lit(1).cast("long").alias("nb_tentatives"),
        c.failure(F.col("succes")).alias("nb_echecs"),
    )


def pair_activity(silver: DataFrame) -> DataFrame:
    return silver.groupBy(USER, DESTINATION, CATEGORY).agg(
        F.count(F.lit(1)).alias("nb_tentatives"),
        F.sum(c.failure(F.col("succes"))).alias("nb_echecs"),
    )


def _known_user(df: DataFrame) -> DataFrame:
    return df.where(F.col(USER).isNotNull())


def _to_machines(df: DataFrame) -> DataFrame:
    return _known_user(df).where(F.col(CATEGORY) == "machine")


def connections_by_user_hour(silver: DataFrame) -> DataFrame:
    return (
        _known_user(silver)
        .groupBy(USER, c.hour_bucket(F.col("heure_du_jour")).alias("heure"))
        .agg(
            F.count(F.lit(1)).alias("nb_connexions"),
            F.sum(c.failure(F.col("succes"))).alias("nb_echecs"),
        )
    )


def activity_by_machine(pairs: DataFrame) -> DataFrame:
    return (
        pairs.where(F.col(DESTINATION).isNotNull())
        .groupBy(DESTINATION, CATEGORY)
        .agg(
            F.sum("nb_tentatives").alias("nb_evenements"),
            F.count(USER).alias("nb_utilisateurs_distincts"),
        )
    )


def off_hours_activity(silver: DataFrame) -> DataFrame:
    """Keyed by the exact second of day, so nearly as large as its filtered input."""
    return (
        _known_user(silver)
        .where(c.off_hours(F.col("heure_du_jour")))
        .groupBy(USER, DESTINATION, "heure_du_jour")
        .agg(F.count(F.lit(1)).alias("nb_connexions_horaire_inhabituel"))
    )


def failure_rate_by_user(counted: DataFrame) -> DataFrame:
    """From `attempts` or from `pair_activity`; users with few attempts are left out."""
    return (
        _known_user(counted)
        .groupBy(USER)
        .agg(F.sum("nb_tentatives").alias("total_tentatives"), F.sum("nb_echecs").alias("nb_echecs"))
        .where(F.col("total_tentatives") >= MIN_ATTEMPTS)
        .withColumn("taux_echec_pct", c.percent(F.col("nb_echecs"), F.col("total_tentatives")))
    )


def machines_by_user(pairs: DataFrame) -> DataFrame:
    return (
        _to_machines(pairs)
        .groupBy(USER)
        .agg(
            F.count(DESTINATION).alias("nb_machines_distinctes"),
            F.sum("nb_tentatives").alias("nb_connexions_totales"),
        )
    )


def volume_by_day(silver: DataFrame) -> DataFrame:
    return silver.groupBy(c.day_index(F.col("temps_secondes")).alias("jour")).agg(
        F.count(F.lit(1)).alias("nb_connexions"),
        F.sum(c.failure(F.col("succes"))).alias("nb_echecs"),
    )


def rare_pairs(pairs: DataFrame) -> DataFrame:
    """Users seen exactly once on a machine."""
    return (
        _to_machines(pairs)
        .where(F.col("nb_tentatives") == 1)
        .select(USER, DESTINATION, F.col("nb_tentatives").alias("nb_occurrences"))
    )


def user_profiles(pairs: DataFrame) -> DataFrame:
    """Every user with enough attempts: attempts, failure rate, machines, machines seen once.

    Group-bys and joins are all by user: over pairs in buckets of users nothing is shuffled.
    """
    rare = rare_pairs(pairs).groupBy(USER).agg(F.count(F.lit(1)).alias("nb_paires_rares"))
    known = failure_rate_by_user(pairs).join(machines_by_user(pairs), USER, "left").join(rare, USER, "left")
    return known.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("nb_machines_distinctes", "nb_connexions_totales", "nb_paires_rares")})


def tables_from_log(silver: DataFrame) -> dict[str, DataFrame]:
    return {
        "connexions_par_utilisateur_heure": connections_by_user_hour(silver),
        "anomalies_horaires": off_hours_activity(silver),
        "volume_par_jour": volume_by_day(silver),
    }


def tables_from_pairs(pairs: DataFrame) -> dict[str, DataFrame]:
    return {
        "activite_par_machine": activity_by_machine(pairs),
        "taux_echec_par_utilisateur": failure_rate_by_user(pairs),
        "machines_distinctes_par_utilisateur": machines_by_user(pairs),
        "paires_rares_utilisateur_machine": rare_pairs(pairs),
    }


# -- partial aggregates by day ---------------------------------------------------------

# State -> its keys beside the day, and its counts, which are added up over days.
STATES = {
    "heures": ([USER, "heure"], ["nb_connexions", "nb_echecs"]),
    "paires": ([USER, DESTINATION, CATEGORY], ["nb_tentatives", "nb_echecs"]),
    "anomalies": ([USER, DESTINATION, "heure_du_jour"], ["nb_connexions_horaire_inhabituel"]),
    "volume": (["jour"], ["nb_connexions", "nb_echecs"]),
}


def day_states(silver: DataFrame) -> dict[str, DataFrame]:
    """Partial aggregates of a log with the day of its layout.

    A bucketed day that changes at noon draws on two days of the layout, so it is in both.
    """
    failed = F.sum(c.failure(F.col("succes")))
    lines = F.count(F.lit(1))
    keyed = {
        "heures": (_known_user(silver), [USER, c.hour_bucket(F.col("heure_du_jour")).alias("heure")], [lines, failed]),
        "paires": (silver, [USER, DESTINATION, CATEGORY], [lines, failed]),
        "anomalies": (_known_user(silver).where(c.off_hours(F.col("heure_du_jour"))), [USER, DESTINATION, "heure_du_jour"], [lines]),
        "volume": (silver, [c.day_index(F.col("temps_secondes")).alias("jour")], [lines, failed]),
    }
    return {
        name: rows.groupBy(DAY_PARTITION, *keys).agg(*[count.alias(n) for count, n in zip(counts, STATES[name][1], strict=True)])
        for name, (rows, keys, counts) in keyed.items()
    }


def with_marks(states: dict[str, DataFrame], days: list[int]) -> dict[str, DataFrame]:
    """States with a row of zero lines for each day, so that a day that has lost its last row of
    a state still replaces what it had."""
    out = {}
    for name, state in states.items():
        marks = state.sparkSession.createDataFrame([(day,) for day in days], f"{DAY_PARTITION} int")
        kinds = dict(state.dtypes)
        keys, counts = STATES[name]
        blank = [F.lit(None).cast(kinds[k]).alias(k) for k in keys] + [F.lit(0).cast("long").alias(n) for n in counts]
        out[name] = state.unionByName(marks.select(DAY_PARTITION, *blank))
    return out


def merged(state: DataFrame, name: str) -> DataFrame:
    """A state added up over all days: a Gold table, or for ``paires`` what four of them start from."""
    keys, counts = STATES[name]
    return state.where(F.col(counts[0]) > 0).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in counts])


def tables_from_states(states: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables that need no pairs."""
    return {
        "connexions_par_utilisateur_heure": merged(states["heures"], "heures"),
        "anomalies_horaires": merged(states["anomalies"], "anomalies"),
        "volume_par_jour": merged(states["volume"], "volume"),
    }


def in_order(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables in their written order: ranges of it over files, each sorted, nulls last as in a ranking."""

    def by(column: str):
        return F.desc_nulls_last(column[1:]) if column[0] == "-" else F.asc(column)

    return {name: df.orderBy(*[by(column) for column in ORDERS[name]]) if name in ORDERS else df for name, df in tables.items()}


def row_counts(named: dict[str, DataFrame], counted: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per table name with its number of rows.

    ``counted`` holds tables whose one-row count (``nb_lignes``) is known more cheaply.
    """
    counts = {name: df.agg(F.count(F.lit(1)).alias("nb_lignes")) for name, df in named.items()} | (counted or {})
    named_counts = [df.select(F.lit(name).alias("nom"), "nb_lignes") for name, df in counts.items()]
    return reduce(DataFrame.unionByName, named_counts)
