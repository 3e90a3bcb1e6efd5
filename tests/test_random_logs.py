"""Random logs with missing, malformed and negative values against the SQL engine."""

from __future__ import annotations

import random

import pytest
from compare import assert_same

from vigilog.operators import cleaning, detection, gold, joins
from vigilog.plans.oracle import checks_on_given_log
from vigilog.sources.lake import read_silver, write_by_day
from vigilog.sources.schemas import AUTH_RAW, REDTEAM_RAW

HOUR = 3600
SECONDS = [-86400, -43200, -1, 0, 1, 1800, 1801, 5400, 21599, 21600, 43200, 43201, 79200, 79201, 84600, 86399, 86400, 129600, 30 * HOUR, 100 * HOUR, None]
USERS = ["U1@D", "U2@D", "U3@D", "U4", "C9$@D", "?", None, "U5@D", "é@D", ""]
MACHINES = ["C1", "C2", "C3", "CORP", "c4", "C5$", "TGT", "U7", "?", None, "SRV1", ""]
TYPES = ["NTLM", "Kerberos", "?", None, "MICROSOFT_AUTHENTICATION_PACKAG", "MICROSOFT_AUTHENTICATION_PACKAGE_V1", "MICROSOFTxAUTHENTICATIONxPACKAGE"]
LOGONS = ["Batch", "Network", "?", None]
RESULTS = ["Success", "Success", "Fail", "?", None]


def random_log(seed, rows):
    rng = random.Random(seed)

    def line():
        return (
            rng.choice(SECONDS), rng.choice(USERS), rng.choice(USERS), rng.choice(MACHINES), rng.choice(MACHINES),
            rng.choice(TYPES), rng.choice(LOGONS), rng.choice(["LogOn", "LogOff", "?", None]), rng.choice(RESULTS),
        )

    log = [line() for _ in range(rows)]
    log += log[: rows // 3]
    attacks = [(s, u, "C1", d) for s, u, _, _, d, *_ in rng.sample(log, rows // 8)]
    attacks += [(rng.choice(SECONDS), rng.choice(USERS), "C1", rng.choice(MACHINES)) for _ in range(rows // 8)]
    return log, attacks + attacks[:5]


@pytest.mark.parametrize("seed, rows", [(1, 40), (2, 1500)])
def test_every_table(spark, tmp_path, seed, rows):
    log, known = random_log(seed, rows)
    spark.createDataFrame(log, AUTH_RAW).write.parquet(str(tmp_path / "auth_brut.parquet"))
    spark.createDataFrame(known, REDTEAM_RAW).write.parquet(str(tmp_path / "redteam.parquet"))
    raw = spark.read.parquet(str(tmp_path / "auth_brut.parquet"))
    listed = spark.read.parquet(str(tmp_path / "redteam.parquet"))
    write_by_day(cleaning.to_silver(raw), str(tmp_path / "silver_by_day"))
    silver = read_silver(spark, str(tmp_path / "silver_by_day"))
    dated = read_silver(spark, str(tmp_path / "silver_by_day"), with_day=True)
    pairs = gold.pair_activity(silver)
    tables = gold.failure_rate_by_user(pairs), gold.machines_by_user(pairs), gold.rare_pairs(pairs)
    off_hours = gold.off_hours_activity(silver)

    sql = checks_on_given_log()
    found = {"silver_auth": silver, **gold.tables_from_log(silver), **gold.tables_from_pairs(pairs)}
    found["seuils_detection"] = detection.thresholds(*tables[:2])
    for name, df in found.items():
        assert_same(df, str(tmp_path), sql[name])
    for limit in (joins.BROADCAST_LIMIT, 0):
        attacks = detection.measured(listed, limit)
        for log_frame in (silver, dated):
            for name, df in {
                "validation_redteam": detection.validation_strict(attacks, log_frame),
                "taux_detection_rigoureux": detection.detection_rate_strict(detection.matches(attacks, log_frame)),
                "detection_flags": detection.detection_flags(attacks, log_frame, *tables),
                "comparaison_criteres_detection": detection.compare_criteria(
                    attacks, detection.matches(attacks, log_frame), *tables
                ),
            }.items():
                assert_same(df, str(tmp_path), sql[name])
        for name, df in {
            "validation_redteam_loose": detection.validation_loose(attacks, off_hours),
            "taux_detection_loose": detection.detection_rate_loose(attacks, off_hours),
        }.items():
            assert_same(df, str(tmp_path), sql[name])
