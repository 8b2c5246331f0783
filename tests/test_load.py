"""Whole loads: what is replaced, what is kept, what is reported."""

import os
from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablekeel import DataQualityError, SourceError, SpecError, plan_load, preview_rows, run_load
from tests.helpers import DAYS, database, day_spec, days_of, full_spec, month_spec, report_of, rows_of, source, tables_of

RANGE = f"{DAYS[0]},{DAYS[-1]}"


def fingerprint(df):
    """Count and order-free hash of the rows."""
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())


@pytest.mark.parametrize("rebalance", [False, True])
def test_only_the_asked_partitions_change(spark, rebalance):
    schema = database(spark)
    run_load(spark, day_spec(schema, source(spark, days_of(5))), RANGE)
    other = spark.table(f"{schema}.t").where(~F.col("d").isin(DAYS[1:3]))
    kept = fingerprint(other)
    view = source(spark, [(i, -1.0, d) for i, (_, _, d) in enumerate(days_of(2))])
    report = run_load(
        spark, day_spec(schema, view), f"{DAYS[1]},{DAYS[2]}", rebalance=rebalance
    )
    assert report_of(report) == [(d, 2, 5, 2, "written") for d in DAYS[1:3]]
    spark.catalog.refreshTable(f"{schema}.t")
    assert fingerprint(spark.table(f"{schema}.t").where(~F.col("d").isin(DAYS[1:3]))) == kept
    assert rows_of(spark.table(f"{schema}.t").where("v < 0").select("d")) == [(d,) for d in DAYS[1:3] for _ in "12"]


def test_session_settings_are_left_alone(spark):
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    run_load(spark, day_spec(database(spark), source(spark, days_of(1))), RANGE)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode == "STATIC"


def test_a_table_made_by_others_loses_nothing(spark):
    schema = database(spark)
    seed = spark.createDataFrame(days_of(3), "id int, v double, d string")
    seed.write.partitionBy("d").format("orc").saveAsTable(f"{schema}.t")
    run_load(spark, day_spec(schema, source(spark, days_of(1))), DAYS[2])
    counts = {r.d: r["count"] for r in spark.table(f"{schema}.t").groupBy("d").count().collect()}
    assert counts == {DAYS[0]: 3, DAYS[1]: 3, DAYS[2]: 1, DAYS[3]: 3}


def test_loading_twice_is_loading_once(spark):
    schema = database(spark)
    spec = day_spec(schema, source(spark, days_of(4)))
    run_load(spark, spec, RANGE)
    once = rows_of(spark.table(spec.target))
    report = run_load(spark, spec, RANGE)
    assert rows_of(spark.table(spec.target)) == once
    assert report_of(report) == [(d, 4, 4, 4, "written") for d in DAYS]


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(1, 3)))
def test_any_split_of_a_range_gives_the_same_table(spark, cuts):
    schema = database(spark)
    view = source(spark, days_of(2))
    bounds = [0, *sorted(cuts), 4]
    for a, b in zip(bounds, bounds[1:]):
        run_load(spark, day_spec(schema, view), f"{DAYS[a]},{DAYS[b - 1]}")
    assert sorted(rows_of(spark.table(f"{schema}.t"))) == sorted(days_of(2))


def test_default_range_reloads_late_days(spark):
    view = source(spark, [(1, 1.0, "2023-12-01"), (2, 1.0, "2024-01-14"), (3, 1.0, "2024-01-15")])
    spec = day_spec(database(spark), view, processing_strategy="last_and_current_month")
    report = report_of(run_load(spark, spec, now=date(2024, 1, 15)))
    assert (report[0][0], report[-1][0], len(report)) == ("2023-12-01", "2024-01-14", 45)
    assert rows_of(spark.table(spec.target).select("id")) == [(1,), (2,)]


MONTHLY = "SELECT id, v, substr(d, 1, 7) AS m FROM {view} WHERE d IN ({{target_date_list}})"


def test_month_to_date_replaces_the_whole_month(spark):
    view = source(spark, [(1, 1.0, "2024-03-01"), (2, 1.0, "2024-03-09"), (3, 1.0, "2024-03-10"), (4, 1.0, "2024-02-29")])
    spec = month_spec(database(spark), MONTHLY.format(view=view))
    run_load(spark, spec, "2024-02,2024-03")
    report = run_load(spark, spec, now=date(2024, 3, 10))
    assert report_of(report) == [("2024-03", 2, 3, 2, "written")]
    assert rows_of(spark.table(spec.target)) == [(1, 1.0, "2024-03"), (2, 1.0, "2024-03"), (4, 1.0, "2024-02")]


def test_month_load_on_the_second(spark):
    view = source(spark, [(1, 1.0, "2024-05-01"), (2, 1.0, "2024-05-02")])
    spec = month_spec(database(spark), MONTHLY.format(view=view))
    assert report_of(run_load(spark, spec, now=date(2024, 5, 2))) == [("2024-05", 1, 0, 1, "written")]


def test_dry_run_writes_nothing(spark):
    schema = database(spark)
    spec = day_spec(schema, source(spark, days_of(2)))
    report = run_load(spark, spec, f"{DAYS[3]},2024-01-05", dry_run=True)
    assert report_of(report) == [(DAYS[3], 2, 0, 0, "would_write"), ("2024-01-05", 0, 0, 0, "missing")]
    assert tables_of(spark, schema) == []
    run_load(spark, spec, RANGE)
    before = rows_of(spark.table(spec.target))
    report = run_load(spark, day_spec(schema, source(spark, days_of(1))), RANGE, dry_run=True)
    assert report_of(report) == [(d, 1, 2, 2, "would_write") for d in DAYS]
    assert rows_of(spark.table(spec.target)) == before


def test_dry_run_of_month_full_and_view(spark):
    schema = database(spark)
    view = source(spark, days_of(2))
    month = month_spec(schema, MONTHLY.format(view=view))
    assert report_of(run_load(spark, month, "2024-01", dry_run=True)) == [("2024-01", 8, 0, 0, "would_write")]
    full = full_spec(schema, f"SELECT * FROM {view}")
    assert report_of(run_load(spark, full, dry_run=True)) == [(None, 8, 0, 0, "would_write")]
    as_view = full_spec(schema, "SELECT 1 AS a", "view")
    assert report_of(run_load(spark, as_view, dry_run=True)) == [(None, 1, None, None, "would_write")]
    assert tables_of(spark, schema) == []


def test_preview_rows(spark):
    spec = day_spec(database(spark), source(spark, days_of(2)))
    assert rows_of(preview_rows(spark, spec, DAYS[1])) == sorted(r for r in days_of(2) if r[2] == DAYS[1])
    assert rows_of(preview_rows(spark, full_spec("default", "SELECT 1 AS a"))) == [(1,)]
    assert not spark.catalog.tableExists(spec.target)


def evaluations(spark, spec_of, rows, **options):
    """How often the source rows are computed: each adds one to an accumulator."""
    seen = spark.sparkContext.accumulator(0)

    def touch(value):
        seen.add(1)
        return value

    name = f"touch_{os.urandom(4).hex()}"
    spark.udf.register(name, spark.udf.register(name, touch, "string").asNondeterministic())
    run_load(spark, spec_of(name), **options)
    return seen.value / rows


def test_source_evaluations(spark):
    view = source(spark, days_of(5))

    def day(touch):
        query = f"SELECT * FROM {view} WHERE {touch}(d) IN ({{target_date_list}})"
        return day_spec(database(spark), view, query)

    def full(touch):
        return full_spec(database(spark), f"SELECT * FROM {view} WHERE {touch}(d) IS NOT NULL")

    assert evaluations(spark, day, 20, target_date=RANGE) == 1
    assert evaluations(spark, day, 20, target_date=RANGE, dry_run=True) == 1
    assert evaluations(spark, full, 20) == 1


def test_loading_leaves_no_folder_behind(spark):
    """One folder of each load that the catalog refers to, and no other files."""
    schema = database(spark)
    spec = day_spec(schema, source(spark, days_of(2)))
    folder = spark.catalog.getDatabase(schema).locationUri.removeprefix("file:")
    run_load(spark, spec, RANGE)
    run_load(spark, spec, RANGE)
    assert tables_of(spark, schema) == ["t"]
    held = {f for f in spark.table(spec.target).inputFiles()}
    there = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    assert len(there) == len(held) == 4
    with pytest.raises(ValueError, match="no rows"):
        run_load(spark, day_spec(schema, source(spark, [])), RANGE)
    again = [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    assert sorted(again) == sorted(there)


def test_what_is_counted_is_what_is_published(spark, tmp_path):
    """A source that differs each time it runs: the rows that were checked are the ones that arrive."""
    schema = database(spark)
    run_load(spark, day_spec(schema, source(spark, days_of(1000))), RANGE)
    query = f"SELECT CAST(id AS INT) AS id, rand() AS v, '{DAYS[0]}' AS d FROM range(4000) WHERE rand() < 0.5 AND 'x' NOT IN ({{target_date_list}})"
    report = report_of(run_load(spark, day_spec(schema, None, query), DAYS[0]))
    assert report[0][1] == report[0][3] == spark.table(f"{schema}.t").where(F.col("d") == DAYS[0]).count()
    assert spark.table(f"{schema}.t").count() == 3000 + report[0][1]


def test_a_new_column_of_a_failed_load_is_not_added(spark):
    schema = database(spark)
    view = source(spark, days_of(1))
    run_load(spark, day_spec(schema, view), RANGE)
    wider = f"SELECT *, IF(id < 200, 1, raise_error('boom')) AS n FROM {view} WHERE d IN ({{target_date_list}})"
    with pytest.raises(SourceError, match="boom"):
        run_load(spark, day_spec(schema, view, wider), RANGE)
    gap = f"SELECT *, 1 AS n FROM {view} WHERE d IN ({{target_date_list}}) AND d <> '{DAYS[1]}'"
    with pytest.raises(DataQualityError, match="gap"):
        run_load(spark, day_spec(schema, view, gap), RANGE)
    assert spark.table(f"{schema}.t").columns == ["id", "v", "d"]
    assert spark.table(f"{schema}.t").count() == 4


@pytest.mark.parametrize("kind", ["day", "full", "view"])
def test_damaged_source_files(spark, tmp_path, kind):
    good = str(tmp_path / "good")
    spark.createDataFrame(days_of(200), "id int, v double, d string").coalesce(1).write.parquet(good)
    for file in (tmp_path / "good").glob("*.parquet"):
        data = bytearray(file.read_bytes())
        rest = 8 + int.from_bytes(data[-8:-4], "little")  # the footer stays
        data[4:-rest] = bytes(len(data) - rest - 4)
        file.write_bytes(data)
    for crc in (tmp_path / "good").glob(".*.crc"):
        crc.unlink()
    schema = database(spark)
    if kind == "day":
        spec, when = day_spec(schema, f"parquet.`{good}`"), RANGE
    else:
        query = f"SELECT id, v, d FROM parquet.`{good}`" if kind == "full" else f"SELECT v FROM parquet.`{good}` WHERE v > 1"
        spec, when = full_spec(schema, query, kind), None
    with pytest.raises(SourceError) as failed:
        run_load(spark, spec, when)
    assert failed.value.__cause__ is not None
    assert tables_of(spark, schema) == []


def test_options_that_do_not_apply_are_refused(spark):
    for options in ({"rebalance": True}, {"compact": True}):
        with pytest.raises(SpecError, match="a view stores nothing"):
            run_load(spark, full_spec("default", "SELECT 1 AS a", "view"), **options)
    with pytest.raises(SpecError, match="dry run"):
        run_load(spark, full_spec("default", "SELECT 1 AS a"), dry_run=True, compact=True)


def test_time_zone_of_yesterday(spark):
    evening = datetime(2024, 1, 3, 1, 0, tzinfo=timezone.utc)
    assert plan_load(spark, day_spec("s", "x"), now=evening).partitions == ("2024-01-02",)
    assert plan_load(spark, day_spec("s", "x", time_zone="America/Sao_Paulo"), now=evening).partitions == ("2024-01-01",)
    with pytest.raises(SpecError, match="time_zone"):
        day_spec("s", "x", time_zone="Mars/Olympus")


def test_preview_of_a_full_load_is_checked(spark):
    with pytest.raises(DataQualityError, match="no rows"):
        preview_rows(spark, full_spec("default", "SELECT 1 AS a WHERE false"))
    with pytest.raises(SpecError, match="CAST"):
        preview_rows(spark, full_spec("default", "SELECT NULL AS a"))


@pytest.mark.parametrize("exists", [False, True])
def test_a_failed_write_can_be_repeated(spark, tmp_path, exists):
    """The write dies once; the next run finds nothing in its way."""
    schema = database(spark)
    if exists:
        run_load(spark, day_spec(schema, source(spark, days_of(2))), RANGE)
    failed = str(tmp_path / "failed")
    failing = f"fail_{os.urandom(4).hex()}"

    def fail_once(day):
        if not os.path.exists(failed):
            open(failed, "w").close()
            raise RuntimeError("task lost")
        return day

    spark.udf.register(failing, fail_once, "string")
    view = source(spark, [(1, 1.0, DAYS[0])])
    spec = day_spec(schema, view, f"SELECT id, v, {failing}(d) AS d FROM {view} WHERE d IN ({{target_date_list}})")
    with pytest.raises(SourceError, match="task lost"):
        run_load(spark, spec, DAYS[0])
    assert spark.catalog.tableExists(spec.target) == exists
    if exists:
        assert spark.table(spec.target).count() == 8
    before = 2 if exists else 0
    assert report_of(run_load(spark, spec, DAYS[0])) == [(DAYS[0], 1, before, 1, "written")]


def test_spec_may_be_a_mapping(spark):
    view = source(spark, days_of(1))
    config = dict(
        table="t", schema=database(spark), partition_column="d", partition_type="day",
        processing_strategy="single_day", partition_query=f"SELECT * FROM {view} WHERE d IN ({{target_date_list}})",
        catalog="spark_catalog",
    )
    assert report_of(run_load(spark, config, DAYS[0])) == [(DAYS[0], 1, 0, 1, "written")]
    assert report_of(run_load(spark, config, DAYS[0])) == [(DAYS[0], 1, 1, 1, "written")]


def test_full_takes_no_target_date(spark):
    for strategy in ("full", "view"):
        with pytest.raises(SpecError, match="target_date"):
            run_load(spark, full_spec("default", "SELECT 1 AS a", strategy), "2024-01-01")


def test_plan_reads_only_key_and_filter_columns_for_the_check(spark, capsys):
    from tablekeel.operators.quality import partition_ledger
    from tablekeel.operators.spine import listed_partitions
    from tablekeel.sources.extract import extract
    from workload.queries import daily_events

    plan = plan_load(spark, daily_events("/root/testdata/sf0.001"), "2024-01-10,2024-01-12")
    ledger = partition_ledger(listed_partitions(spark, plan.partitions), extract(spark, plan.query), "event_day")
    ledger.explain("formatted")
    physical = capsys.readouterr().out
    assert "ReadSchema: struct<ts:timestamp_ntz>" in physical
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in physical and "LessThan(ts,2024-01-13T00:00)" in physical
    assert "Join" not in physical and "Broadcast" not in physical
