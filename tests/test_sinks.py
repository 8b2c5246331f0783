"""Tables, views, schema changes, layout and compaction."""

import pytest
from pyspark.sql import functions as F

from tablekeel import SpecError, compact_partitions, run_load
from tablekeel.sinks.layout import spread_for_write
from tests.helpers import DAYS, database, day_spec, days_of, full_spec, report_of, rows_of, source, tables_of

RANGE = f"{DAYS[0]},{DAYS[-1]}"


def files_per_day(spark, name):
    files = spark.table(name).select("d", "_metadata.file_path").distinct().groupBy("d").count()
    return {r.d: r["count"] for r in files.collect()}


def test_table_is_created_partitioned(spark):
    spec = day_spec(database(spark), source(spark, days_of(1)))
    run_load(spark, spec, RANGE)
    columns = {c.name: c.isPartition for c in spark.catalog.listColumns(spec.target)}
    assert columns == {"id": False, "v": False, "d": True}
    assert files_per_day(spark, spec.target) == dict.fromkeys(DAYS, 1)


def test_key_may_stand_anywhere_in_the_query(spark):
    view = source(spark, days_of(1))
    spec = day_spec(database(spark), view, f"SELECT d, v, id FROM {view} WHERE d IN ({{target_date_list}})")
    run_load(spark, spec, RANGE)
    run_load(spark, day_spec(spec.schema, view), DAYS[0])
    assert rows_of(spark.table(spec.target).select("id", "v", "d")) == rows_of(spark.table(view))


def test_new_column_is_null_in_earlier_rows(spark):
    schema = database(spark)
    view = source(spark, days_of(1))
    run_load(spark, day_spec(schema, view), RANGE)
    wider = f"SELECT *, named_struct('a', id, 'b', array(v)) AS extra, 7 AS n FROM {view} WHERE d IN ({{target_date_list}})"
    run_load(spark, day_spec(schema, view, wider), DAYS[1])
    rows = spark.table(f"{schema}.t").collect()
    assert {r.d: r.n for r in rows} == {d: 7 if d == DAYS[1] else None for d in DAYS}
    assert {r.d: r.extra and r.extra.a for r in rows} == {d: 100 if d == DAYS[1] else None for d in DAYS}


def test_column_left_out_becomes_null(spark):
    schema = database(spark)
    view = source(spark, days_of(1))
    run_load(spark, day_spec(schema, view), RANGE)
    narrow = f"SELECT d, id FROM {view} WHERE d IN ({{target_date_list}})"
    run_load(spark, day_spec(schema, view, narrow), DAYS[0])
    assert {r.d: r.v for r in spark.table(f"{schema}.t").collect()} == {d: None if d == DAYS[0] else 0.0 for d in DAYS}


def test_columns_match_without_regard_to_case(spark):
    schema = database(spark)
    view = source(spark, days_of(1))
    run_load(spark, day_spec(schema, view), RANGE)
    upper = f"SELECT id AS ID, v + 1 AS V, d FROM {view} WHERE d IN ({{target_date_list}})"
    run_load(spark, day_spec(schema, view, upper), RANGE)
    assert spark.table(f"{schema}.t").columns == ["id", "v", "d"]
    assert {r.v for r in spark.table(f"{schema}.t").collect()} == {1.0}


def test_untyped_null(spark):
    schema = database(spark)
    view = source(spark, days_of(1))
    query = f"SELECT id, NULL AS v, d FROM {view} WHERE d IN ({{target_date_list}})"
    with pytest.raises(SpecError, match="CAST"):
        run_load(spark, day_spec(schema, view, query), RANGE)
    run_load(spark, day_spec(schema, view), RANGE)
    run_load(spark, day_spec(schema, view, query), RANGE)
    assert {r.v for r in spark.table(f"{schema}.t").collect()} == {None}


@pytest.mark.parametrize("full", [False, True])
def test_changed_type_is_refused(spark, full):
    schema = database(spark)
    view = source(spark, days_of(1))
    make = (lambda q: full_spec(schema, q)) if full else (lambda q: day_spec(schema, view, q + " WHERE d IN ({target_date_list})"))
    run_load(spark, make(f"SELECT id, v, d FROM {view}"), None if full else RANGE)
    before = rows_of(spark.table(f"{schema}.t"))
    with pytest.raises(SpecError, match="v is string in the query and double"):
        run_load(spark, make(f"SELECT id, CAST(v AS STRING) AS v, d FROM {view}"), None if full else RANGE)
    assert rows_of(spark.table(f"{schema}.t")) == before


def test_full_replaces_everything(spark):
    schema = database(spark)
    assert report_of(run_load(spark, full_spec(schema, "SELECT id FROM range(5)"))) == [(None, 5, 0, 5, "written")]
    report = run_load(spark, full_spec(schema, "SELECT id FROM range(2, 4)"))
    assert report_of(report) == [(None, 2, 5, 2, "written")]
    assert rows_of(spark.table(f"{schema}.t")) == [(2,), (3,)]
    assert tables_of(spark, schema) == ["t"]


def test_full_keeps_the_union_of_columns(spark):
    schema = database(spark)
    run_load(spark, full_spec(schema, "SELECT 1 AS a, 'x' AS b"))
    run_load(spark, full_spec(schema, "SELECT 2.5D AS c, 3 AS A"))
    assert spark.table(f"{schema}.t").columns == ["a", "b", "c"]
    assert rows_of(spark.table(f"{schema}.t")) == [(3, None, 2.5)]


def test_full_may_read_its_own_target(spark):
    schema = database(spark)
    run_load(spark, full_spec(schema, "SELECT id FROM range(3)"))
    run_load(spark, full_spec(schema, f"SELECT id + 10 AS id FROM {schema}.t"))
    assert rows_of(spark.table(f"{schema}.t")) == [(10,), (11,), (12,)]


def test_partitioned_may_read_its_own_target(spark):
    schema = database(spark)
    view = source(spark, days_of(2))
    run_load(spark, day_spec(schema, view), RANGE)
    query = f"SELECT id, v + 5 AS v, d FROM {schema}.t WHERE d IN ({{target_date_list}})"
    run_load(spark, day_spec(schema, view, query), DAYS[1])
    found = {d: set() for d in DAYS}
    for r in spark.table(f"{schema}.t").collect():
        found[r.d].add(r.v)
    assert found == {d: {5.0, 6.0} if d == DAYS[1] else {0.0, 1.0} for d in DAYS}


def test_view(spark, caplog):
    schema = database(spark)
    spec = full_spec(schema, "SELECT id FROM range(3)", "view")
    assert report_of(run_load(spark, spec)) == [(None, 3, None, 3, "written")]
    changed = full_spec(schema, "SELECT id FROM range(3) WHERE id < 0", "view")
    assert report_of(run_load(spark, changed)) == [(None, 0, None, 0, "written")]
    assert "returns no rows" in caplog.text
    assert spark.catalog.getTable(f"{schema}.t").tableType == "VIEW"


def test_view_that_no_longer_resolves_can_be_replaced(spark):
    schema = database(spark)
    run_load(spark, full_spec(schema, "SELECT 1 AS a", table="base"))
    run_load(spark, full_spec(schema, f"SELECT a FROM {schema}.base", "view"))
    spark.sql(f"DROP TABLE {schema}.base")
    run_load(spark, full_spec(schema, "SELECT 2 AS a", "view"))
    assert rows_of(spark.table(f"{schema}.t")) == [(2,)]


def test_full_may_be_rebalanced(spark):
    schema = database(spark)
    many = "SELECT /*+ REPARTITION(6) */ id FROM range(100)"
    for options, files in (({}, 1), ({"compact": False}, 6), ({"rebalance": True}, 1)):
        run_load(spark, full_spec(schema, many), **options)
        table = spark.table(f"{schema}.t")
        assert table.count() == 100
        assert table.select("_metadata.file_path").distinct().count() == files


def test_schema_must_exist(spark):
    with pytest.raises(SpecError, match="no_such_schema.*does not exist"):
        run_load(spark, full_spec("no_such_schema", "SELECT 1 AS a"))


def test_tables_and_views_do_not_replace_each_other(spark):
    schema = database(spark)
    view = source(spark, days_of(1))
    run_load(spark, full_spec(schema, "SELECT 1 AS a", "view", table="w"))
    run_load(spark, full_spec(schema, "SELECT 1 AS a", table="t"))
    run_load(spark, day_spec(schema, view, table="p"), RANGE)
    for spec, target_date in (
        (full_spec(schema, "SELECT 1 AS a", table="w"), None),
        (day_spec(schema, view, table="w"), RANGE),
        (full_spec(schema, "SELECT 1 AS a", "view", table="t"), None),
        (day_spec(schema, view, table="t"), RANGE),
        (full_spec(schema, "SELECT 1 AS a", table="p"), None),
        (day_spec(schema, view, f"SELECT d AS e FROM {view} WHERE d IN ({{target_date_list}})", table="p", partition_column="e"), RANGE),
    ):
        with pytest.raises(SpecError, match="target"):
            run_load(spark, spec, target_date)


def test_odd_names(spark):
    schema = database(spark)
    view = source(spark, days_of(1))
    query = f"SELECT id AS `a b`, d AS `the.day` FROM {view} WHERE d IN ({{target_date_list}})"
    spec = day_spec(schema, view, query, table="odd_name", partition_column="the.day")
    run_load(spark, spec, RANGE)
    run_load(spark, spec, DAYS[0], compact=True)
    assert spark.table(spec.target).count() == 4


def scattered(spark, schema, rows=400):
    query = f"""
        SELECT /*+ REPARTITION(5) */ CAST(id AS INT) AS id, CAST(id AS DOUBLE) AS v,
               element_at(array({{target_date_list}}), CAST(id % 4 AS INT) + 1) AS d
        FROM range({rows})"""
    spec = day_spec(schema, None, query)
    run_load(spark, spec, RANGE, rebalance=False)
    return spec


def test_compaction_merges_files_and_keeps_rows(spark):
    spec = scattered(spark, database(spark))
    before = rows_of(spark.table(spec.target))
    assert files_per_day(spark, spec.target) == dict.fromkeys(DAYS, 5)
    assert compact_partitions(spark, spec.target, "d", DAYS[:2]) == DAYS[:2]
    assert files_per_day(spark, spec.target) == {DAYS[0]: 1, DAYS[1]: 1, DAYS[2]: 5, DAYS[3]: 5}
    assert compact_partitions(spark, spec.target, "d", DAYS[:2]) == []
    assert rows_of(spark.table(spec.target)) == before


def test_compaction_gives_a_large_partition_several_files(spark):
    spec = scattered(spark, database(spark), rows=40_000)
    size = spark.table(spec.target).where(F.col("d") == DAYS[0]).select("_metadata.file_path", "_metadata.file_size").distinct()
    total = sum(r.file_size for r in size.collect())
    compact_partitions(spark, spec.target, "d", DAYS[:1], file_bytes=total // 2 + 1)
    assert 1 <= files_per_day(spark, spec.target)[DAYS[0]] <= 2
    compact_partitions(spark, spec.target, "d", DAYS, file_bytes=total)
    assert max(files_per_day(spark, spec.target).values()) <= 2
    assert rows_of(spark.table(spec.target).select("id")) == rows_of(spark.range(40_000).selectExpr("CAST(id AS INT)"))


def test_compaction_with_the_load(spark):
    schema = database(spark)
    spec = scattered(spark, schema)
    run_load(spark, spec, RANGE, rebalance=False, compact=True)
    assert files_per_day(spark, spec.target) == dict.fromkeys(DAYS, 1)
    assert spark.table(spec.target).count() == 400


def test_compaction_of_many_partitions_with_different_file_counts(spark):
    name = f"{database(spark)}.wide"
    frame = spark.range(0, 4000, 1, 20).where("id % 20 <= id % 400 / 20").selectExpr("id", "concat('k', id % 400) AS d")
    frame.write.partitionBy("d").saveAsTable(name)
    rows = rows_of(spark.table(name))
    values = sorted({r[1] for r in rows})
    assert len(values) > 150
    done = compact_partitions(spark, name, "d", values)
    assert len(done) > 100
    assert set(files_per_day(spark, name).values()) == {1}
    assert rows_of(spark.table(name)) == rows


@pytest.mark.parametrize("external", [False, True])
def test_full_keeps_kind_comment_and_properties(spark, tmp_path, external):
    schema = database(spark)
    where = f"LOCATION '{tmp_path}/kept'" if external else ""
    spark.sql(f"CREATE TABLE {schema}.t (id BIGINT) USING parquet {where} COMMENT 'mine' TBLPROPERTIES ('owner.team' = 'x')")
    spark.sql(f"INSERT INTO {schema}.t VALUES (7)")
    run_load(spark, full_spec(schema, f"SELECT id + 1 AS id FROM {schema}.t"))
    run_load(spark, full_spec(schema, f"SELECT id + 1 AS id FROM {schema}.t"))
    assert rows_of(spark.table(f"{schema}.t")) == [(9,)]
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {schema}.t").collect()}
    assert told["Type"] == ("EXTERNAL" if external else "MANAGED")
    assert told["Comment"] == "mine" and "owner.team=x" in told["Table Properties"]


def test_full_load_that_fails_before_the_switch_changes_nothing(spark, monkeypatch):
    from tablekeel.sinks import tables

    schema = database(spark)
    run_load(spark, full_spec(schema, "SELECT 1 AS a"))

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "evolve", killed)
    with pytest.raises(KeyboardInterrupt):
        run_load(spark, full_spec(schema, "SELECT 2 AS a, 3 AS b"))
    monkeypatch.undo()
    assert rows_of(spark.table(f"{schema}.t")) == [(1,)]
    assert report_of(run_load(spark, full_spec(schema, "SELECT 2 AS a, 3 AS b"))) == [(None, 1, 1, 1, "written")]


def test_shuffle_partitions_for_many_values(spark):
    rows = spark.range(10).selectExpr("id", "'x' AS d")
    for values, wanted in ((1, 8), (600, 2000), (100, 400)):
        plan = spread_for_write(rows, "d", values)._jdf.queryExecution().analyzed().toString()
        assert f", {wanted}" in plan.split("RebalancePartitions")[1].split("\n")[0]


def test_without_adaptive_execution_small_days_get_few_files(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spec = scattered(spark, database(spark))
        run_load(spark, spec, RANGE)
        assert max(files_per_day(spark, spec.target).values()) <= 2
        assert spark.table(spec.target).columns == ["id", "v", "d"]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_a_column_named_like_the_helper_is_kept(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        view = source(spark, [(1, 1.0, DAYS[0])], "salt int, v double, d string")
        spec = day_spec(database(spark), view)
        run_load(spark, spec, DAYS[0])
        assert rows_of(spark.table(spec.target)) == [(1, 1.0, DAYS[0])]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_compaction_needs_the_right_table(spark):
    schema = database(spark)
    run_load(spark, full_spec(schema, "SELECT 1 AS d"))
    for name, key in ((f"{schema}.t", "d"), (f"{schema}.none", "d")):
        with pytest.raises(SpecError):
            compact_partitions(spark, name, key, DAYS)


@pytest.fixture
def small_partitions(spark):
    names = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in [*names, "spark.sql.adaptive.enabled"]:
        spark.conf.unset(name)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_hot_key_is_written_by_many_tasks(spark, small_partitions, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    key = F.when(F.col("id") < 60_000, DAYS[0]).otherwise(DAYS[1])
    rows = spark.range(0, 64_000, 1, 16).select("id", F.rand(1).alias("v"), key.alias("d"))
    spread = spread_for_write(rows, "d")
    per_task = spread.groupBy("d", F.spark_partition_id().alias("task")).count() if adaptive == "false" else None
    schema = database(spark)
    spread.write.partitionBy("d").saveAsTable(f"{schema}.hot")
    assert spark.table(f"{schema}.hot").count() == 64_000
    assert spark.table(f"{schema}.hot").columns == ["id", "v", "d"]
    assert files_per_day(spark, f"{schema}.hot")[DAYS[0]] >= 4
    if per_task is not None:
        assert max(r["count"] for r in per_task.collect()) < 40_000


def test_load_of_a_hot_key(spark, small_partitions):
    query = f"""
        SELECT CAST(id AS INT) AS id, rand(1) AS v, IF(id < 60000, '{DAYS[0]}', '{DAYS[1]}') AS d
        FROM range(0, 64000, 1, 16) WHERE 'x' NOT IN ({{target_date_list}})"""
    spec = day_spec(database(spark), None, query)
    report = run_load(spark, spec, f"{DAYS[0]},{DAYS[1]}")
    assert report_of(report) == [(DAYS[0], 60000, 0, 60000, "written"), (DAYS[1], 4000, 0, 4000, "written")]
    files = files_per_day(spark, spec.target)
    assert files[DAYS[0]] >= 4 and files[DAYS[1]] <= 8
