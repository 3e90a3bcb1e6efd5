"""Declared schemas; nothing is inferred from the raw files."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


AUTH_RAW = _struct(
    ("temps_secondes", LongType()),
    ("source_user_domain", StringType()),
    ("destination_user_domain", StringType()),
    ("source_computer", StringType()),
    ("destination_computer", StringType()),
    ("authentication_type", StringType()),
    ("logon_type", StringType()),
    ("authentication_orientation", StringType()),
    ("success_failure", StringType()),
)

REDTEAM_RAW = _struct(
    ("temps_secondes", LongType()),
    ("user_domain", StringType()),
    ("source_computer", StringType()),
    ("destination_computer", StringType()),
)

AUTH_SILVER = _struct(
    ("temps_secondes", LongType()),
    ("heure_du_jour", DoubleType()),
    ("source_user_domain", StringType()),
    ("destination_user_domain", StringType()),
    ("source_computer", StringType()),
    ("destination_computer", StringType()),
    ("categorie_destination", StringType()),
    ("authentication_type", StringType()),
    ("logon_type", StringType()),
    ("authentication_orientation", StringType()),
    ("succes", BooleanType()),
)
