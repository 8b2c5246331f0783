"""Loads do not depend on the session's time zone, ANSI mode or adaptive execution."""

from datetime import date, timedelta

import pytest

from tablekeel import plan_load, run_load
from tests.helpers import database, day_spec, month_spec, report_of
from workload.queries import daily_events

SETTINGS = [
    # Daylight saving starts at midnight here, so some days have no 00:00.
    {"spark.sql.session.timeZone": "America/Sao_Paulo"},
    {"spark.sql.session.timeZone": "Pacific/Apia"},
    {"spark.sql.ansi.enabled": "false"},
    {"spark.sql.adaptive.enabled": "false"},
    {"spark.sql.sources.partitionOverwriteMode": "DYNAMIC"},
]


@pytest.fixture(params=SETTINGS, ids=lambda s: "=".join(*s.items()))
def session(spark, request):
    other = spark.newSession()
    for name, value in request.param.items():
        other.conf.set(name, value)
    return other


def test_windows(session):
    days = plan_load(session, day_spec("s", "x"), "2011-12-28,2018-12-31").partitions
    assert days == tuple(str(date(2011, 12, 28) + timedelta(days=i)) for i in range(len(days)))
    assert days[-1] == "2018-12-31"
    months = plan_load(session, month_spec("s", "SELECT ({target_date_list})"), "2011-12,2018-11").partitions
    assert months == tuple(f"{y}-{m:02}" for y in range(2011, 2019) for m in range(1, 13))[11:-1]
    late = day_spec("s", "x", processing_strategy="last_and_current_month")
    window = plan_load(session, late, now=date(2017, 10, 16))
    assert (window.start_date, window.end_date) == (date(2017, 9, 1), date(2017, 10, 15))


def test_load_and_reload(session):
    spec = daily_events("/root/testdata/sf0.001", database(session))
    first = report_of(run_load(session, spec, "2024-01-01,2024-01-30"))
    again = report_of(run_load(session, spec, "2024-01-10,2024-01-12"))
    assert [(d, n, n, n, s) for d, n, _, _, s in first[9:12]] == again
    assert session.table(spec.target).count() == 1000
