"""Checks between reading and writing: each stops the load and leaves the target as it was."""

import logging
from datetime import date, datetime

import pytest

from tablekeel import DataQualityError, SourceError, SpecError, run_load
from tests.helpers import DAYS, database, day_spec, days_of, full_spec, month_spec, report_of, rows_of, source, tables_of

RANGE = f"{DAYS[0]},{DAYS[-1]}"


@pytest.fixture
def loaded(spark):
    """A target holding two rows for each of the four days."""
    schema = database(spark)
    run_load(spark, day_spec(schema, source(spark, days_of(2))), RANGE)
    return schema


def refused(spark, spec, target_date, match, error=DataQualityError, modes=(False,), **options):
    """The load fails with the message, in a dry run too if asked, and changes nothing."""
    exists = spark.catalog.tableExists(spec.target)
    before = rows_of(spark.table(spec.target)) if exists else None
    for dry_run in modes:
        with pytest.raises(error, match=match):
            run_load(spark, spec, target_date, dry_run=dry_run, **options)
    assert spark.catalog.tableExists(spec.target) == exists
    if exists:
        assert rows_of(spark.table(spec.target)) == before


def unfiltered(view):
    return f"SELECT * FROM {view} WHERE d IN ({{target_date_list}}) OR true"


def test_no_rows(spark, loaded):
    spec = day_spec(loaded, source(spark, []))
    refused(spark, spec, RANGE, "no rows", modes=(True, False))


def test_no_rows_full(spark):
    schema = database(spark)
    spec = full_spec(schema, "SELECT 1 AS a")
    run_load(spark, spec)
    refused(spark, full_spec(schema, "SELECT 1 AS a WHERE false"), None, "no rows", modes=(True, False))
    assert tables_of(spark, schema) == ["t"]


@pytest.mark.parametrize(
    "bad", ["2023-12-31", "2024-01-05", "2024-01-015", "2024-01-1", "zzz", "", None, "2024-01-01 "]
)
def test_key_that_is_no_expected_partition(spark, loaded, bad):
    view = source(spark, [*days_of(1), (1, 1.0, bad), (2, 1.0, bad)])
    refused(spark, day_spec(loaded, view, unfiltered(view)), RANGE, "2 rows have a d")


def test_null_keys_are_counted(spark, loaded):
    view = source(spark, [*days_of(1), (1, 1.0, None), (2, 1.0, "x")])
    refused(spark, day_spec(loaded, view, unfiltered(view)), RANGE, "2 rows .* 1 rows NULL", modes=(True, False))


def test_many_distinct_bad_keys_are_summed_up(spark, loaded):
    query = "SELECT id, 0.5D AS v, concat('bad', id) AS d FROM range(100000) WHERE 'x' NOT IN ({target_date_list})"
    spec = day_spec(loaded, None, query.replace("id,", "CAST(id AS INT) AS id,", 1))
    refused(spark, spec, RANGE, "100000 rows have a d.*lowest 'bad0', highest 'bad99999'")


def test_rows_only_outside_the_range(spark, loaded):
    view = source(spark, [(1, 1.0, "2025-01-01")])
    refused(spark, day_spec(loaded, view, unfiltered(view)), RANGE, "no partition from")


def test_gap_is_refused(spark, loaded):
    view = source(spark, [r for r in days_of(3) if r[2] not in DAYS[1:3]])
    refused(spark, day_spec(loaded, view), RANGE, f"{DAYS[1]}, {DAYS[2]}.*gap", modes=(True, False))


def test_missing_day_the_target_lacks_too_is_a_warning(spark, loaded, caplog):
    view = source(spark, days_of(3))
    with caplog.at_level(logging.WARNING):
        report = run_load(spark, day_spec(loaded, view), f"{DAYS[0]},2024-01-06")
    assert "2024-01-05, 2024-01-06" in caplog.text
    assert report_of(report) == [(d, 3, 2, 3, "written") for d in DAYS] + [
        ("2024-01-05", 0, 0, 0, "missing"),
        ("2024-01-06", 0, 0, 0, "missing"),
    ]


def test_missing_day_without_target(spark):
    view = source(spark, days_of(1, DAYS[:1]))
    report = run_load(spark, day_spec(database(spark), view), RANGE)
    assert [r[4] for r in report_of(report)] == ["written", "missing", "missing", "missing"]


@pytest.mark.parametrize("column", ["D", "day", "d "])
def test_key_column_must_be_there_exactly(spark, loaded, column):
    view = source(spark, days_of(1))
    query = f"SELECT id, v, d AS `{column}` FROM {view} WHERE d IN ({{target_date_list}})"
    refused(spark, day_spec(loaded, view, query), RANGE, "not in the query result")


def test_timestamp_key(spark):
    view = source(spark, [(1, datetime(2024, 1, 1))], "id int, d timestamp")
    refused(spark, day_spec(database(spark), view), DAYS[0], "YYYY-MM-DD text or a date, got timestamp")


def test_date_key_for_months(spark):
    query = "SELECT DATE '2024-01-01' AS m WHERE '2024-01-01' IN ({target_date_list})"
    refused(spark, month_spec(database(spark), query), "2024-01", "YYYY-MM text, got date")


def test_date_key_for_days(spark):
    view = source(spark, [(i, date.fromisoformat(d)) for i, d in enumerate(DAYS)], "id int, d date")
    spec = day_spec(database(spark), view)
    run_load(spark, spec, RANGE)
    report = run_load(spark, spec, f"{DAYS[1]},{DAYS[2]}")
    assert report_of(report) == [(DAYS[1], 1, 1, 1, "written"), (DAYS[2], 1, 1, 1, "written")]
    assert spark.table(spec.target).count() == 4
    assert dict(spark.table(spec.target).dtypes)["d"] == "date"


def test_invalid_sql(spark, loaded):
    spec = day_spec(loaded, "no_such_table")
    refused(spark, spec, RANGE, "could not be analysed", SourceError)
    refused(spark, day_spec(loaded, None, "SELEKT {target_date_list}"), RANGE, "could not be analysed", SourceError)


def test_error_at_run_time(spark, loaded):
    view = source(spark, days_of(1))
    query = f"SELECT id, v, IF(id < 0, d, raise_error('boom')) AS d FROM {view} WHERE d IN ({{target_date_list}})"
    spec = day_spec(loaded, view, query)
    refused(spark, spec, RANGE, "boom", SourceError)


def test_error_at_run_time_in_full_and_view(spark):
    schema = database(spark)
    run_load(spark, full_spec(schema, "SELECT 1L AS a"))
    broken = "SELECT IF(id < 5, id, raise_error('boom')) AS a FROM range(10)"
    for strategy, table in (("full", "t"), ("view", "w")):
        spec = full_spec(schema, f"SELECT a FROM ({broken}) WHERE a >= 0", strategy, table=table)
        with pytest.raises(SourceError, match="boom"):
            run_load(spark, spec)
    assert tables_of(spark, schema) == ["t"]
    assert spark.table(f"{schema}.t").collect()[0].a == 1


@pytest.mark.parametrize("target_date, match", [("2024-02-30", "2024-02-30"), ("2024-01", "2024-01"), (5, "text")])
def test_bad_target_date(spark, loaded, target_date, match):
    refused(spark, day_spec(loaded, source(spark, days_of(1))), target_date, match, SpecError)
