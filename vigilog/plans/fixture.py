"""An authentication log and an attack list seen through the `events` table.

The given tables hold no authentication log, so one is derived: every event becomes one
log line, some lines twice. The attack list is a sparse selection of those lines, as a
list of known attacks is of a real log; some of its entries are moved to a time that the
log does not have. The expressions are common to Spark and to the SQL check, except for
the conversion of the timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.sources.schemas import AUTH_RAW, REDTEAM_RAW

# Whole seconds since 2024-01-01, from calendar fields: no session time zone involved.
SPARK_SECONDS = (
    "datediff(CAST(ts AS DATE), DATE '2024-01-01') * 86400L"
    " + hour(ts) * 3600 + minute(ts) * 60 + second(ts)"
)
DUCKDB_SECONDS = "date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts)"

# The derivation of each text column, the same text in both engines.
LOG_COLUMNS = {
    "source_user_domain": """
        CASE WHEN event_id % 211 = 0 THEN '?'
             WHEN event_id % 97 = 0 THEN 'U' || user_id
             ELSE 'U' || user_id || '@DOM' || (user_id % 3 + 1) END""",
    "destination_user_domain": """
        CASE WHEN event_id % 103 = 0 THEN '?'
             WHEN event_id % 101 = 0 THEN 'SYSTEM'
             ELSE 'U' || ((user_id * 7) % 150) || '@DOM1' END""",
    "source_computer": """
        CASE WHEN event_id % 307 = 0 THEN '?'
             WHEN event_id % 89 = 0 THEN 'C' || (user_id % 40) || '$'
             WHEN event_id % 83 = 0 THEN 'SRV' || (user_id % 5)
             ELSE 'C' || (user_id % 40) END""",
    "destination_computer": """
        CASE WHEN event_id % 20 = 0 THEN 'TGT'
             WHEN event_id % 37 = 0 THEN 'U' || (user_id % 10)
             WHEN event_id % 41 = 0 THEN '?'
             WHEN event_id % 43 = 0 THEN 'SRV' || (user_id % 5)
             ELSE 'C' || ((user_id * 13 + event_id % (1 + user_id % 60)) % 120) END""",
    "authentication_type": """
        CASE event_id % 9 WHEN 0 THEN 'Kerberos' WHEN 1 THEN 'NTLM' WHEN 2 THEN 'Negotiate'
             WHEN 3 THEN 'MICROSOFT_AUTHENTICATION_PACKAGE_V1_0'
             WHEN 4 THEN 'MICROSOFT_AUTHENTICATION_PACKAGE_V1'
             WHEN 5 THEN 'MICROSOFT_AUTHENTICATION_PACKAG' ELSE '?' END""",
    "logon_type": """
        CASE event_id % 7 WHEN 0 THEN 'Batch' WHEN 1 THEN 'Service' WHEN 2 THEN 'Interactive'
             WHEN 3 THEN '?' ELSE 'Network' END""",
    "authentication_orientation": """
        CASE WHEN event_id % 307 = 1 THEN '?'
             WHEN event_type = 'signup' THEN 'LogOff' ELSE 'LogOn' END""",
    "success_failure": """
        CASE WHEN event_id % 401 = 2 THEN NULL
             WHEN event_type = 'error' AND event_id % (2 + user_id % 7) = 0 THEN 'Fail'
             ELSE 'Success' END""",
}
WRITTEN_TWICE = "event_id % 50 = 7"
IS_ATTACK = "event_id % 250 = 7 OR event_id % 110 = 3 OR event_id % 500 = 1"
ATTACK_DELAY = "CASE WHEN event_id % 500 = 1 THEN 100000000 ELSE 0 END"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def auth_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine raw columns; one pass over the events."""
    lines = _events(spark, sf_dir).select(
        F.expr(f"CAST({SPARK_SECONDS} + 1 AS BIGINT)").alias("temps_secondes"),
        *[F.expr(text).alias(name) for name, text in LOG_COLUMNS.items()],
        F.explode(F.expr(f"CASE WHEN {WRITTEN_TWICE} THEN array(1, 2) ELSE array(1) END")).alias("_copy"),
    )
    return lines.select(*AUTH_RAW.names)


def attack_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = LOG_COLUMNS["source_user_domain"]
    return (
        _events(spark, sf_dir)
        .where(IS_ATTACK)
        .select(
            F.expr(f"CAST({SPARK_SECONDS} + 1 + {ATTACK_DELAY} AS BIGINT)").alias("temps_secondes"),
            F.expr(user).alias("user_domain"),
            F.expr(LOG_COLUMNS["source_computer"]).alias("source_computer"),
            F.expr(LOG_COLUMNS["destination_computer"]).alias("destination_computer"),
        )
        .where("user_domain <> '?'")
        .select(*REDTEAM_RAW.names)
    )
