"""Known attacks against the log: matching, detection flags, thresholds, comparison.

An attack list is normally tiny, and then it is broadcast and the log is never
shuffled. Its size is measured first. A list that does not fit takes another way with
the same rows: a bitmap of its hashed keys is sent out instead, and rows of the log or of a
table that cannot be listed are dropped at the scan; both sides are counted per key, so that no
key has more than one row on either side of the join, and rows are repeated afterwards only
where they are wanted. Results that are only counted never repeat them.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions import columns as c
from vigilog.operators.joins import (
    BROADCAST_LIMIT,
    fits_in_broadcast,
    repeat_rows,
    spread_lookup,
)
from vigilog.operators.keyfilter import key_map, maybe_listed
from vigilog.sources.lake import DAY_PARTITION

PAIR = ["user_domain", "destination_computer"]
MOMENT = ["temps_secondes", *PAIR]
USER = ["user_domain"]
THRESHOLD_LEVEL = 0.95
THRESHOLD_DECIMALS = 6
CRITERIA = {
    "horaire": "flag_horaire",
    "echec": "flag_echec",
    "machines": "flag_machines",
    "paire_rare": "flag_paire_rare",
}
ANY_CRITERION = "au_moins_un"


class AttackList(NamedTuple):
    """Known attacks, and whether they were measured small enough to broadcast.

    For a large list also about how many different keys it has, and its first and last second.
    """

    rows: DataFrame
    small: bool
    distinct: dict[str, int] = {}
    span: tuple[int, int] | None = None


def measured(attacks: DataFrame, limit: int = BROADCAST_LIMIT) -> AttackList:
    """One pass over the list, two over a large one; a limit of 0 always takes the way of large lists."""
    rows = attacks.select(*MOMENT)
    if fits_in_broadcast(rows, limit):
        return AttackList(rows, True)
    counts = {_key_name(keys): F.approx_count_distinct(F.struct(*keys)) for keys in (MOMENT, PAIR, USER)}
    first, last, *found = rows.agg(F.min("temps_secondes"), F.max("temps_secondes"), *counts.values()).first()
    return AttackList(rows, False, dict(zip(counts, found, strict=True)), None if first is None else (first, last))


def _key_name(keys: list[str]) -> str:
    return ",".join(keys)


def _maybe_attacked(attacks: AttackList, table: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a log or table whose key a large list may hold, by the bitmap of its keys."""
    return maybe_listed(table, key_map(attacks.rows, keys, attacks.distinct[_key_name(keys)]))


def _by_attack_name(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("source_user_domain", "user_domain")


def _rows_per(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


# -- loose validation: was the pair ever active off hours? ---------------------------


def _off_hours_rows(attacks: AttackList, off_hours: DataFrame) -> DataFrame:
    """Off-hours rows per (user, machine), only for the pairs of the attack list (if large,
    for those and few others).

    Catalyst pushes the broadcast semi-join below the aggregation that made `off_hours`
    when that is still a plan and not a written table.
    """
    rows = _by_attack_name(off_hours).select(*PAIR)
    if attacks.small:
        rows = rows.join(F.broadcast(attacks.rows.select(*PAIR)), PAIR, "leftsemi")
    else:
        rows = _maybe_attacked(attacks, rows, PAIR)
    return _rows_per(rows, PAIR, "nb_anomalies")


def validation_loose(attacks: AttackList, off_hours: DataFrame) -> DataFrame:
    """Each attack with whether its pair was ever seen off hours.

    A left join that keeps its fan-out: one row per off-hours row of the pair.
    """
    seen = _off_hours_rows(attacks, off_hours)
    if attacks.small:
        joined = attacks.rows.withColumn("nb", F.lit(1)).join(F.broadcast(seen), PAIR, "left")
    else:
        joined = spread_lookup(_rows_per(attacks.rows, MOMENT, "nb"), seen, PAIR, ["temps_secondes"])
    flagged = joined.select(
        *MOMENT,
        F.col("nb_anomalies").isNotNull().alias("detecte_par_anomalie_horaire"),
        (F.col("nb") * F.coalesce("nb_anomalies", F.lit(1))).alias("nb"),
    )
    return repeat_rows(flagged, "nb")


def detection_rate_loose(attacks: AttackList, off_hours: DataFrame) -> DataFrame:
    """Detection rate over the rows of `validation_loose`, counted per pair."""
    joined = _rows_per(attacks.rows, PAIR, "nb").join(_off_hours_rows(attacks, off_hours), PAIR, "left")
    # The list may name no user or machine; such rows match nothing but still count.
    total = F.sum(F.col("nb") * F.coalesce("nb_anomalies", F.lit(1)))
    found = F.sum(F.col("nb") * F.coalesce("nb_anomalies", F.lit(0)))
    return _rate(joined.agg(total.alias("total"), found.alias("found")), "nb_detectes")


def loose_row_count(attacks: AttackList, off_hours: DataFrame) -> DataFrame:
    """Number of rows of `validation_loose`, added up per pair instead of repeated."""
    return detection_rate_loose(attacks, off_hours).select(F.col("total_evenements_redteam").alias("nb_lignes"))


def detection_rate(validation: DataFrame, found_name: str) -> DataFrame:
    """Rate over a written validation table."""
    counts = validation.agg(
        F.count(F.lit(1)).alias("total"),
        c.count_if(F.col("detecte_par_anomalie_horaire")).alias("found"),
    )
    return _rate(counts, found_name)


def _rate(counts: DataFrame, found_name: str) -> DataFrame:
    return counts.select(
        F.coalesce("total", F.lit(0)).alias("total_evenements_redteam"),
        F.col("found").alias(found_name),
        c.percent(F.col("found"), F.col("total")).alias("taux_detection_pct"),
    )


# -- strict validation: was this very event off hours? -------------------------------


def _log_side(silver: DataFrame) -> DataFrame:
    day = [DAY_PARTITION] if DAY_PARTITION in silver.columns else []
    return _by_attack_name(silver).select(*MOMENT, "heure_du_jour", *day)


def _attack_side(attacks: AttackList, log: DataFrame) -> DataFrame:
    if DAY_PARTITION not in log.columns:
        return attacks.rows
    # The cleaned log never holds the missing mark, so the filter drops no match; a
    # filtered side is what lets Spark prune the days of the log at run time.
    return attacks.rows.where(F.col("user_domain") != c.MISSING).withColumn(
        DAY_PARTITION, c.calendar_day(F.col("temps_secondes"))
    )


def _match_broadcast(attacks: AttackList, silver: DataFrame) -> DataFrame:
    log = _log_side(silver)
    listed = _attack_side(attacks, log)
    return log.join(F.broadcast(listed), listed.columns, "inner").select(*MOMENT, "heure_du_jour")


def matches(attacks: AttackList, silver: DataFrame) -> DataFrame:
    """Matched (second, user, machine) with ``nb``, the joined rows each line stands for.

    From a broadcast list every joined row is a line of its own: whoever counts them
    adds them up before its shuffle. Otherwise there is one line per key.
    """
    if attacks.small:
        return as_matches(_match_broadcast(attacks, silver))
    return _match_counts(attacks, silver)


def _within_span(attacks: AttackList, log: DataFrame) -> DataFrame:
    """Seconds, and days of the layout, between the list's first and last; pruned at the scan."""
    if attacks.span is None:
        return log.limit(0)
    first, last = attacks.span
    near = log.where(F.col("temps_secondes").between(first, last))
    if DAY_PARTITION in log.columns:
        near = near.where(F.col(DAY_PARTITION).between(first // c.SECONDS_PER_DAY, last // c.SECONDS_PER_DAY))
    return near


def _match_counts(attacks: AttackList, silver: DataFrame) -> DataFrame:
    log = _maybe_attacked(attacks, _within_span(attacks, _log_side(silver)), MOMENT)
    listed = _attack_side(attacks, log)
    keys = listed.columns
    in_list = _rows_per(listed, keys, "nb_liste")
    in_log = _rows_per(log, [*keys, "heure_du_jour"], "nb_journal")
    return in_list.join(in_log, keys, "inner").select(
        *MOMENT, "heure_du_jour", (F.col("nb_liste") * F.col("nb_journal")).alias("nb")
    )


def as_matches(validation: DataFrame) -> DataFrame:
    """The matches behind a strict validation table: nothing is joined again."""
    return validation.select(*MOMENT, "heure_du_jour", F.lit(1).cast("long").alias("nb"))


def validation_strict(attacks: AttackList, silver: DataFrame) -> DataFrame:
    """Attacks joined to the log on user, machine and second, every match kept."""
    if attacks.small:
        matched = _match_broadcast(attacks, silver)
    else:
        matched = repeat_rows(_match_counts(attacks, silver), "nb")
    flag = F.coalesce(c.off_hours(F.col("heure_du_jour")), F.lit(False))
    return matched.withColumn("detecte_par_anomalie_horaire", flag)


def detection_rate_strict(matched: DataFrame) -> DataFrame:
    """Detection rate over the rows of `validation_strict`, from `matches`."""
    found = F.when(c.off_hours(F.col("heure_du_jour")), F.col("nb")).otherwise(0)
    counts = matched.agg(F.sum("nb").alias("total"), F.sum(found).alias("found"))
    return _rate(counts, "nb_a_horaire_inhabituel")


# -- thresholds ----------------------------------------------------------------------


def threshold(table: DataFrame, column: str) -> DataFrame:
    """Interpolated 95th percentile as a one-row table.

    Values are counted before the percentile, so its single task sees each distinct
    value once: at most 10,001 for a percentage with two decimals, and for counts of
    machines at most the square root of twice the number of (user, machine) pairs.
    """
    counted = table.groupBy(column).agg(F.count(F.lit(1)).alias("_nb"))
    exact = F.percentile(column, F.lit(THRESHOLD_LEVEL), F.col("_nb"))
    return counted.agg(F.round(exact, THRESHOLD_DECIMALS).alias("seuil"))


def thresholds(failure_rates: DataFrame, machines: DataFrame) -> DataFrame:
    one_row = failure_rates.sparkSession.range(1)
    return one_row.select(
        threshold(failure_rates, "taux_echec_pct").scalar().alias("seuil_echec"),
        threshold(machines, "nb_machines_distinctes").scalar().alias("seuil_machines"),
    )


# -- flags and comparison of criteria ------------------------------------------------


def _of_list(attacks: AttackList, table: DataFrame, keys: list[str]) -> DataFrame:
    """A table's rows for the keys of the attack list where that is small enough to send
    out; the rest is then small enough to be sent to the rows it is joined to. Of a large list
    the bitmap of its keys leaves those rows and few others."""
    if not attacks.small:
        return _maybe_attacked(attacks, table, keys)
    return F.broadcast(table.join(F.broadcast(attacks.rows.select(*keys).distinct()), keys, "leftsemi"))


def _known_of_pairs(
    attacks: AttackList, rows: DataFrame, failure_rates: DataFrame, machines: DataFrame, pairs: DataFrame
) -> DataFrame:
    """Add what is known of each user and (user, machine), and the flags that follow.

    ``rows`` must hold few rows per pair. The per-user tables are never joined to events,
    so an account with a third of all events weighs no more than its machines.
    """
    rare = _of_list(attacks, _by_attack_name(pairs).withColumnRenamed("nb_occurrences", "occurrences_paire"), PAIR)
    rates = _of_list(attacks, _by_attack_name(failure_rates).select("user_domain", "taux_echec_pct"), USER)
    diversity = _of_list(attacks, _by_attack_name(machines).select("user_domain", "nb_machines_distinctes"), USER)
    known = rows.join(rare, PAIR, "left").join(rates, USER, "left").join(diversity, USER, "left")
    # Each flag may be NULL, which is not a detection.
    return known.withColumns(
        {
            "flag_echec": F.col("taux_echec_pct") > threshold(failure_rates, "taux_echec_pct").scalar(),
            "flag_machines": F.col("nb_machines_distinctes")
            > threshold(machines, "nb_machines_distinctes").scalar(),
            "flag_paire_rare": F.col("occurrences_paire") == 1,
        }
    )


def detection_flags(
    attacks: AttackList,
    silver: DataFrame,
    failure_rates: DataFrame,
    machines: DataFrame,
    pairs: DataFrame,
) -> DataFrame:
    """One row per matched event with the measures and the flag of each criterion."""
    profile = _known_of_pairs(attacks, attacks.rows.select(*PAIR).distinct(), failure_rates, machines, pairs)
    if attacks.small:
        # One row per pair of a list that fits: the profile is no larger.
        events = _match_broadcast(attacks, silver).join(F.broadcast(profile), PAIR, "inner")
    else:
        counted = _match_counts(attacks, silver)
        events = repeat_rows(spread_lookup(counted, profile, PAIR, ["temps_secondes"], "inner"), "nb")
    return events.select(
        *MOMENT,
        "heure_du_jour",
        "taux_echec_pct",
        "nb_machines_distinctes",
        "occurrences_paire",
        c.off_hours(F.col("heure_du_jour")).alias("flag_horaire"),
        "flag_echec",
        "flag_machines",
        "flag_paire_rare",
    )


def compare_criteria(
    attacks: AttackList,
    matched: DataFrame,
    failure_rates: DataFrame,
    machines: DataFrame,
    pairs: DataFrame,
) -> DataFrame:
    """Events caught by each criterion and by any of them, with percentages; one row.

    ``matched`` comes from `matches`, or from a strict validation table by `as_matches`.
    Works on counts per (user, machine, off-hours or not) instead of joined events.
    """
    weighted = matched.groupBy(*PAIR, c.off_hours(F.col("heure_du_jour")).alias("flag_horaire")).agg(
        F.sum("nb").alias("nb")
    )
    known = _known_of_pairs(attacks, weighted, failure_rates, machines, pairs)
    flags = {name: F.col(flag) for name, flag in CRITERIA.items()}
    flags[ANY_CRITERION] = reduce(Column.__or__, flags.values())
    counts = known.agg(
        F.coalesce(F.sum("nb"), F.lit(0)).alias("total_evenements"),
        *[F.sum(F.when(flag, F.col("nb")).otherwise(0)).alias(f"detectes_{name}") for name, flag in flags.items()],
    )
    shares = {
        f"pct_{name}": c.percent(F.col(f"detectes_{name}"), F.col("total_evenements")) for name in flags
    }
    return counts.withColumns(shares)
