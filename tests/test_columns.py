"""Edge values of the column rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vigilog.functions import columns as c


def evaluate(spark, values, kind, build):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [row[0] for row in df.coalesce(1).select(build(F.col("v")).alias("r")).collect()]


def test_hour_of_day(spark):
    assert evaluate(spark, [0, 1800, 86399, 86400, 90000], "bigint", c.hour_of_day) == [
        0.0, 0.5, 86399 / 3600.0, 0.0, 1.0
    ]


@pytest.mark.parametrize(
    "second, bucket", [(1800, 0), (1801, 1), (5400, 2), (82800, 23), (84600, 24), (86399, 24), (86400, 0)]
)
def test_hour_bucket_rounds_half_to_even(spark, second, bucket):
    assert evaluate(spark, [second], "bigint", lambda v: c.hour_bucket(c.hour_of_day(v))) == [bucket]


@pytest.mark.parametrize("second, day", [(1, 0), (43200, 0), (43201, 1), (129600, 2), (86400, 1)])
def test_day_index_switches_at_noon(spark, second, day):
    assert evaluate(spark, [second], "bigint", c.day_index) == [day]


def test_calendar_day_is_not_the_day_index(spark):
    assert evaluate(spark, [1, 43201, 86399, 86400], "bigint", c.calendar_day) == [0, 0, 0, 1]


@pytest.mark.parametrize(
    "second, off", [(21599, True), (21600, False), (79200, False), (79201, True), (0, True), (43200, False)]
)
def test_off_hours_bounds_are_strict(spark, second, off):
    assert evaluate(spark, [second], "bigint", lambda v: c.off_hours(c.hour_of_day(v))) == [off]


def test_destination_category(spark):
    values = ["TGT", "U12", "C12", "CORP", "c12", "?", None, "TGT2"]
    assert evaluate(spark, values, "string", c.destination_category) == [
        "ticket_kerberos", "identifiant_utilisateur", "machine", "machine", "autre", "autre", "autre", "autre",
    ]


def test_canonical_auth_type(spark):
    values = [
        "MICROSOFT_AUTHENTICATION_PACKAGE_V1_0",
        "MICROSOFT_AUTHENTICATION_PACKAGE_V1",
        "MICROSOFT_AUTHENTICATION_PACKAG",
        "MICROSOFTxAUTHENTICATIONxPACKAGE",
        "?",
        None,
        "Kerberos",
    ]
    merged = "MICROSOFT_AUTHENTICATION_PACKAGE_V1_0"
    assert evaluate(spark, values, "string", c.canonical_auth_type) == [
        merged, merged, "MICROSOFT_AUTHENTICATION_PACKAG", merged, None, None, "Kerberos",
    ]


def test_success_and_failure(spark):
    values = ["Success", "Fail", "?", None]
    assert evaluate(spark, values, "string", c.is_success) == [True, False, False, None]
    assert evaluate(spark, values, "string", lambda v: c.failure(c.is_success(v))) == [0, 1, 1, 1]


@pytest.mark.parametrize("part, whole, share", [(201, 20000, 1.0), (1, 3, 33.33), (0, 5, 0.0), (1, 0, None), (2, 2, 100.0)])
def test_percent(spark, part, whole, share):
    df = spark.createDataFrame([(part, whole)], "p bigint, w bigint")
    assert df.select(c.percent(F.col("p"), F.col("w"))).first()[0] == share


def test_computer_name(spark):
    values = ["C12", "C12$", "C12\n", "C", "SRV3", "?", "c1", "C1$$", None]
    assert evaluate(spark, values, "string", c.is_not_computer_name) == [
        False, False, True, True, True, True, True, True, None
    ]


def test_account_without_domain(spark):
    assert evaluate(spark, ["U1@DOM1", "U1", "?", None], "string", c.lacks_at_sign) == [False, True, True, None]
