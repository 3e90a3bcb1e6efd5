"""The profile from one pass: the reports of ten queries, from one scan."""

from __future__ import annotations

import pytest
from test_plans import plan

from vigilog.operators import profiling
from vigilog.plans.fixture import auth_log
from vigilog.sources.lake import materialise, scratch_path
from vigilog.sources.schemas import AUTH_RAW


def separate(log):
    found = {f"freq_{c}": profiling.frequencies(log, c) for c in profiling.FREQUENCY_COLUMNS}
    found.update({f"malformed_{c}": profiling.malformed_accounts(log, c) for c in profiling.USER_COLUMNS})
    found.update({f"malformed_{c}": profiling.malformed_computers(log, c) for c in profiling.COMPUTER_COLUMNS})
    found["time_bounds"] = profiling.time_bounds(log)
    found["missing_counts"] = profiling.missing_counts(log)
    return found


def test_one_scan_and_one_shuffle(spark, sf_dir):
    log = materialise(auth_log(spark, sf_dir), scratch_path(spark, "log"))
    text = plan(profiling.one_pass(log), "simple")
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and text.count("HashAggregate") == 2


@pytest.mark.parametrize("case", ["log", "odd", "empty"])
def test_reports_equal_ten_queries(spark, sf_dir, case):
    odd = [(None,) * 9, (-5, "?", "a@b", "C1", "?", "?", None, "", "Success"), (7, "", None, "c1", "C2$", None, "?", "?", None)]
    log = {"log": auth_log(spark, sf_dir), "odd": spark.createDataFrame(odd, AUTH_RAW), "empty": spark.createDataFrame([], AUTH_RAW)}[case]
    profile = materialise(profiling.one_pass(log), scratch_path(spark, "profile"))
    ours, theirs = profiling.reports_of(profile), separate(log)
    assert ours.keys() == theirs.keys() and len(ours) == 10
    for name, report in ours.items():
        assert report.dtypes == theirs[name].dtypes and report.collect() == theirs[name].collect(), name
