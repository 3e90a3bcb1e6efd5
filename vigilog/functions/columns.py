"""Column builders for the cleaning, bucketing and scoring rules.

Every numeric rule of the project is written here once. Two of them differ from
what a plain Spark cast or round would give:

* bucketing an hour or a day rounds half to even (``rint``), it does not truncate;
* a percentage is rounded on the scaled value, so 1.005 becomes 1.0, not 1.01.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the log format and of the cleaned tables.
MISSING = "?"
SECONDS_PER_DAY = 86400
SECONDS_PER_HOUR = 3600.0
TICKET = "TGT"
PACKAGE_PATTERN = "MICROSOFT_AUTHENTICATION_PACKAGE%"
PACKAGE_NAME = "MICROSOFT_AUTHENTICATION_PACKAGE_V1_0"
SUCCESS = "Success"
COMPUTER_PATTERN = r"^C[0-9]+\$?\z"
FIRST_USUAL_HOUR = 6
LAST_USUAL_HOUR = 22


def null_if_missing(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(MISSING)).alias(name)


def hour_of_day(seconds: Column) -> Column:
    """Fractional hour in [0, 24), taking second 0 as midnight."""
    return (seconds % SECONDS_PER_DAY) / F.lit(SECONDS_PER_HOUR)


def hour_bucket(hour: Column) -> Column:
    """Nearest whole hour, 0 to 24: 23:30 and later fall in bucket 24."""
    return F.rint(hour).cast("int")


def day_index(seconds: Column) -> Column:
    """Nearest whole day: the index changes at noon."""
    return F.rint(seconds / SECONDS_PER_DAY).cast("int")


def calendar_day(seconds: Column) -> Column:
    """True day number, used only to lay out the cleaned table on disk."""
    return F.floor(seconds / SECONDS_PER_DAY).cast("int")


def destination_category(raw_computer: Column) -> Column:
    return (
        F.when(raw_computer == TICKET, "ticket_kerberos")
        .when(raw_computer.startswith("U"), "identifiant_utilisateur")
        .when(raw_computer.startswith("C"), "machine")
        .otherwise("autre")
    )


def canonical_auth_type(raw_type: Column) -> Column:
    """Merge the spellings of one long package name; ``_`` in the pattern is a wildcard."""
    return F.when(raw_type.like(PACKAGE_PATTERN), PACKAGE_NAME).otherwise(
        F.nullif(raw_type, F.lit(MISSING))
    )


def is_success(result: Column) -> Column:
    return result == SUCCESS


def failure(succeeded: Column) -> Column:
    """1 unless the attempt is known to have succeeded; an unknown result is a failure."""
    return F.when(succeeded, F.lit(0)).otherwise(F.lit(1)).cast("long")


def off_hours(hour: Column) -> Column:
    """Strict bounds: exactly 6.0 and 22.0 are usual hours."""
    return (hour < FIRST_USUAL_HOUR) | (hour > LAST_USUAL_HOUR)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; NULL when there is nothing to divide by."""
    share = F.lit(100.0) * part / F.nullif(whole, F.lit(0))
    return F.round(share * 100) / 100


def count_if(condition: Column) -> Column:
    """Rows where the condition holds; NULL on empty input, as a SUM would give."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long"))


def lacks_at_sign(account: Column) -> Column:
    return ~account.contains("@")


def is_not_computer_name(computer: Column) -> Column:
    return ~computer.rlike(COMPUTER_PATTERN)
