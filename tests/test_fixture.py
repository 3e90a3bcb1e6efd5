"""The derived log: known sizes and results, and no dependence on the session."""

from __future__ import annotations

import pytest
from conftest import TESTDATA

from __spark_entry__ import queries
from vigilog.plans.fixture import attack_list, auth_log

SIZES = {
    "0.001": {
        "silver_auth": 1020,
        "silver_auth_distinct": 1000,
        "bronze_redteam": 16,
        "validation_redteam_loose": 60,
        "validation_redteam": 18,
    },
    "0.01": {
        "silver_auth": 10200,
        "silver_auth_distinct": 10000,
        "bronze_redteam": 151,
        "validation_redteam_loose": 296,
        "validation_redteam": 167,
    },
    "0.1": {
        "silver_auth": 102000,
        "silver_auth_distinct": 100000,
        "bronze_redteam": 1504,
        "validation_redteam_loose": 3022,
        "validation_redteam": 1663,
    },
}
RATES = {
    "0.001": ((60, 58, 96.67), (18, 4, 22.22), (14.036, 13.85), (18, 4, 1, 1, 0, 5)),
    "0.01": ((296, 246, 83.11), (167, 53, 31.74), (11.9175, 36.0), (167, 53, 11, 9, 11, 72)),
    "0.1": ((3022, 2524, 83.52), (1663, 556, 33.43), (12.0725, 37.0), (1663, 556, 77, 111, 138, 760)),
}


@pytest.mark.parametrize("scale", SIZES)
def test_known_sizes(spark, scale):
    every = queries()
    found = {name: every[name](spark, f"{TESTDATA}/sf{scale}").count() for name in SIZES[scale]}
    assert found == SIZES[scale]


@pytest.mark.parametrize("scale", RATES)
def test_known_rates(spark, scale):
    every = queries()

    def row(name):
        return tuple(every[name](spark, f"{TESTDATA}/sf{scale}").first())

    loose, strict, thresholds, comparison = RATES[scale]
    assert row("taux_detection_loose") == loose
    assert row("taux_detection_rigoureux") == strict
    assert row("seuils_detection") == thresholds
    assert row("comparaison_criteres_detection")[:6] == comparison


def test_session_time_zone_does_not_matter(spark, sf_dir):
    before = auth_log(spark, sf_dir).collect(), attack_list(spark, sf_dir).collect()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        after = auth_log(spark, sf_dir).collect(), attack_list(spark, sf_dir).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after
