"""Crashes, concurrent loads, contents and nested types: what a switch leaves behind, whatever happens to it."""

import json

import pytest
from pyspark.sql import functions as F

import tablekeel.sinks.journal as journal
import tablekeel.sinks.tables as tables
from tablekeel import ConflictError, SpecError, VerificationError, compact_partitions, run_load
from tablekeel.operators.quality import partition_contents, reconcile_contents
from tablekeel.sinks.folders import children, normal
from tablekeel.sources.target import partition_locations, target_state
from tests.helpers import DAYS, database, day_spec, days_of, full_spec, report_of, rows_of, source

RANGE = f"{DAYS[0]},{DAYS[-1]}"


class Killed(BaseException):
    """The driver is gone: nothing that would clean up runs."""


def loaded(spark, times=1):
    view = source(spark, days_of(3))
    spec = day_spec(database(spark), view)
    for _ in range(times):
        run_load(spark, spec, RANGE)
    return spec


def changed(spec, expression="v + 100 AS v"):
    query = spec.partition_query.replace("SELECT *", f"SELECT id, {expression}, d")
    return day_spec(spec.schema, None, query)


def folders_beside(spark, spec):
    """Folders of loads that hold anything, and those that the catalog refers to; journals."""
    base = target_state(spark, spec.target).location.split("__loads/")[0]
    ids = [c for c in children(spark, f"{base}__loads") if c != "journal"]
    held = {f"{base}__loads/{i}/{p}" for i in ids for p in children(spark, f"{base}__loads/{i}") if "=" in p}
    used = set(partition_locations(spark, spec.target, "d", DAYS).values())
    return {normal(f) for f in held}, {normal(f) for f in used}, children(spark, f"{base}__loads/journal")


def killed_after(monkeypatch, statements, real):
    """The driver dies before the given statement of those that switch partitions, and undoes nothing."""
    left = [statements]

    def apply(spark, journal_, wanted):
        for one in wanted:
            if not left[0]:
                raise Killed
            left[0] -= 1
            real(spark, journal_, [one])

    def gone(*_):
        raise Killed

    monkeypatch.setattr(journal, "_apply", apply)
    monkeypatch.setattr(journal, "undo", gone)


@pytest.mark.parametrize("times", [0, 1, 2])
@pytest.mark.parametrize("statements", [0, 2, 4])
def test_a_driver_that_dies_between_switches(spark, monkeypatch, times, statements):
    spec = loaded(spark, times)
    before = rows_of(spark.table(spec.target)) if times else []
    killed_after(monkeypatch, statements, journal._apply)
    if statements == 4:  # all partitions are switched, but not checked
        monkeypatch.setattr(tables, "verify_partitions", lambda *_: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        run_load(spark, changed(spec), RANGE)
    monkeypatch.undo()
    spark.catalog.refreshTable(spec.target)
    if 0 < statements < 4:
        assert before != rows_of(spark.table(spec.target)) != [(i, v + 100, d) for i, v, d in days_of(3)]

    with pytest.raises(ConflictError, match="another load is publishing"):
        run_load(spark, spec, DAYS[0])  # it may still be alive
    monkeypatch.setattr(journal, "clock", lambda: journal.time.time() + 2 * journal.LEASE)
    journal.recover(spark, target_state(spark, spec.target).location.split("__loads/")[0])
    assert rows_of(spark.table(spec.target)) == before
    held, used, journals = folders_beside(spark, spec)
    assert held <= used and journals == []
    run_load(spark, spec, RANGE)
    assert rows_of(spark.table(spec.target)) == rows_of(spark.createDataFrame(days_of(3)))
    held, used, journals = folders_beside(spark, spec)
    assert held == used and journals == []


def test_a_driver_that_dies_after_the_last_check(spark, monkeypatch):
    spec = loaded(spark)
    monkeypatch.setattr(journal, "finish", lambda *_: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        run_load(spark, changed(spec), RANGE)
    monkeypatch.undo()
    run_load(spark, spec, DAYS[0])
    rows = {(i, v if d == DAYS[0] else v + 100, d) for i, v, d in days_of(3)}
    assert set(rows_of(spark.table(spec.target))) == rows
    held, used, journals = folders_beside(spark, spec)
    assert held == used and journals == []


@pytest.mark.parametrize("later", [DAYS[1], DAYS[3]])
def test_two_loads_at_the_same_time(spark, monkeypatch, later):
    """The second begins and ends while the first has written its rows and not yet switched to them."""
    spec = loaded(spark)
    real = tables.publish_partitions

    def meanwhile(*args):
        monkeypatch.setattr("tablekeel.plans.load.publish_partitions", real)
        run_load(spark, changed(spec, "v + 7 AS v"), later)
        real(*args)

    monkeypatch.setattr("tablekeel.plans.load.publish_partitions", meanwhile)
    first = f"{DAYS[0]},{DAYS[2]}"
    if later == DAYS[1]:
        with pytest.raises(ConflictError, match="in the meantime: 2024-01-02"):
            run_load(spark, changed(spec), first)
        added = {DAYS[1]: 7}
    else:
        run_load(spark, changed(spec), first)
        added = {DAYS[0]: 100, DAYS[1]: 100, DAYS[2]: 100, DAYS[3]: 7}
    assert rows_of(spark.table(spec.target)) == sorted(((i, v + added.get(d, 0), d) for i, v, d in days_of(3)), key=repr)
    held, used, journals = folders_beside(spark, spec)
    assert held <= used and journals == []


def test_a_load_gives_way_to_one_that_is_switching(spark, monkeypatch):
    spec = loaded(spark)

    def meanwhile(*_):
        monkeypatch.undo()
        with pytest.raises(ConflictError, match="another load is publishing"):
            run_load(spark, changed(spec, "v + 7 AS v"), DAYS[1])

    monkeypatch.setattr(tables, "verify_partitions", meanwhile)
    run_load(spark, changed(spec), RANGE)
    assert rows_of(spark.table(spec.target)) == sorted(((i, v + 100, d) for i, v, d in days_of(3)), key=repr)


def test_a_failed_check_puts_the_old_rows_back(spark, monkeypatch):
    spec = loaded(spark)
    before = rows_of(spark.table(spec.target))
    monkeypatch.setattr(tables, "verify_partitions", lambda *_: (_ for _ in ()).throw(VerificationError("other rows")))
    for target_date in (RANGE, DAYS[1]):
        with pytest.raises(VerificationError):
            run_load(spark, changed(spec), target_date)
        assert rows_of(spark.table(spec.target)) == before
    held, used, journals = folders_beside(spark, spec)
    assert held <= used and journals == []


@pytest.mark.parametrize("column", ["v", "id"])
def test_a_value_swapped_in_a_staged_file_is_refused(spark, monkeypatch, column):
    """As many rows as were counted, but not those that were written."""
    spec = loaded(spark)
    before = rows_of(spark.table(spec.target))
    real = tables.read_back

    def damaged(session, folder, kind, schema):
        there = real(session, folder, kind, schema)
        day = f"{folder}/d={DAYS[2]}"
        rows = there.where(F.col("d") == DAYS[2]).drop("d").collect()
        other = [r.asDict() | {column: rows[(i + 1) % len(rows)][column]} for i, r in enumerate(rows)]
        columns = [f for f in there.schema if f.name != "d"]
        session.createDataFrame([tuple(r[f.name] for f in columns) for r in other], type(schema)(columns)).write.mode("overwrite").parquet(day)
        return real(session, folder, kind, schema)

    monkeypatch.setattr(tables, "read_back", damaged)
    with pytest.raises(VerificationError, match="other rows than were written"):
        run_load(spark, changed(spec), RANGE)
    assert rows_of(spark.table(spec.target)) == before
    run_load(spark, changed(spec), RANGE, verify="counts")
    assert spark.table(spec.target).count() == len(before)
    with pytest.raises(SpecError):
        run_load(spark, spec, RANGE, verify="nothing")


def test_compaction_compares_contents(spark, monkeypatch):
    spec = loaded(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    run_load(spark, day_spec(spec.schema, None, spec.partition_query.replace("SELECT", "SELECT /*+ REPARTITION(6) */")), RANGE, rebalance=False)
    before = rows_of(spark.table(spec.target))
    real = tables.spread_for_write
    monkeypatch.setattr(tables, "spread_for_write", lambda df, *a: real(df.withColumn("v", F.col("v") + (F.col("id") % 2)), *a))
    with pytest.raises(VerificationError, match="would change the rows"):
        compact_partitions(spark, spec.target, "d", DAYS)
    monkeypatch.undo()
    assert rows_of(spark.table(spec.target)) == before
    assert compact_partitions(spark, spec.target, "d", DAYS) == DAYS


def test_contents_tell_where_a_null_is_and_how_often_a_row_occurs(spark):
    schema = "k string, a int, b int, m map<string,int>, l array<int>"
    one = [("x", 1, None, {"a": 1}, [1, None]), ("x", 2, 3, None, None), ("y", 1, 1, {}, []), ("y", 1, 1, {}, []), (None, None, None, None, None)]
    frame = lambda rows: spark.createDataFrame(rows, schema)
    sums = lambda rows: {r.partition_value: r.content for r in partition_contents(frame(rows), "k").collect()}
    assert sums(one) == sums(one[::-1])
    others = [
        [("x", None, 1, {"a": 1}, [1, None])] + one[1:],
        [("x", 1, None, {"a": 1}, [None, 1])] + one[1:],
        one[:3] + [("y", 1, 2, {}, [])] + one[4:],
        one[:3] + [("y", 1, 1, None, [])] + one[4:],
    ]
    for rows in others:
        assert sums(rows) != sums(one)
        compared = {r.partition_value: (r.same_rows, r.same_content) for r in reconcile_contents(frame(one), "k", frame(rows), "k", ["a", "b", "m", "l"]).collect()}
        assert sum(not same for _, same in compared.values()) == 1 and all(counts for counts, _ in compared.values())


def statement_log(monkeypatch, spark):
    seen, real = [], type(spark).sql

    def sql(self, text, *args, **kw):
        seen.append(text)
        return real(self, text, *args, **kw)

    monkeypatch.setattr(type(spark), "sql", sql)
    return seen


def test_new_partitions_take_one_statement(spark, monkeypatch):
    view = source(spark, days_of(1))
    spec = day_spec(database(spark), view)
    seen = statement_log(monkeypatch, spark)
    run_load(spark, spec, RANGE)
    assert len([s for s in seen if s.startswith("ALTER TABLE")]) == 1
    seen.clear()
    run_load(spark, spec, RANGE)
    assert len([s for s in seen if s.startswith("ALTER TABLE")]) == len(DAYS)
    assert not [s for s in seen if s.startswith("DESCRIBE") and "PARTITION" in s]


# --- Whole tables ---


@pytest.mark.parametrize("lost", ["reply", "interrupt", "before"])
def test_a_whole_table_is_never_left_empty(spark, monkeypatch, lost):
    schema = database(spark)
    run_load(spark, full_spec(schema, "SELECT id FROM range(30)"))
    real = type(spark).sql

    def sql(self, text, *args, **kw):
        if "SET LOCATION" in text and not sql.done:
            sql.done = True
            if lost != "before":
                real(self, text, *args, **kw)
            raise KeyboardInterrupt if lost == "interrupt" else RuntimeError("no reply")
        return real(self, text, *args, **kw)

    sql.done = False
    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises((RuntimeError, KeyboardInterrupt)):
        run_load(spark, full_spec(schema, "SELECT id + 1000 AS id FROM range(7)"))
    monkeypatch.undo()
    spark.catalog.refreshTable(f"{schema}.t")
    assert rows_of(spark.table(f"{schema}.t")) == rows_of(spark.range(30))
    run_load(spark, full_spec(schema, "SELECT id FROM range(7)"))
    assert spark.table(f"{schema}.t").count() == 7


def test_a_catalog_out_of_reach_keeps_both_folders(spark, monkeypatch):
    schema = database(spark)
    run_load(spark, full_spec(schema, "SELECT id FROM range(30)"))
    monkeypatch.setattr(journal, "locations", lambda *_: (_ for _ in ()).throw(RuntimeError("no catalog")))
    with pytest.raises(RuntimeError):
        run_load(spark, full_spec(schema, "SELECT id FROM range(7)"))
    monkeypatch.undo()
    base = target_state(spark, f"{schema}.t").location.split("__loads/")[0]
    (left,) = [c for c in children(spark, f"{base}__loads/journal") if c.endswith(".json")]
    told = json.loads(journal.read_text(spark, f"{base}__loads/journal/{left}"))
    assert children(spark, told["changes"][0]["new"]) and spark.table(f"{schema}.t").count() == 30
    monkeypatch.setattr(journal, "clock", lambda: journal.time.time() + 2 * journal.LEASE)
    assert report_of(run_load(spark, full_spec(schema, "SELECT id FROM range(9)"))) == [(None, 9, 30, 9, "written")]
    assert children(spark, f"{base}__loads/journal") == [] and not children(spark, told["changes"][0]["new"])


def test_a_new_whole_table_is_never_seen_empty(spark, monkeypatch):
    schema = database(spark)
    seen = []
    real = type(spark).sql

    def sql(self, text, *args, **kw):
        if spark.catalog.tableExists(f"{schema}.t"):
            seen.append(spark.table(f"{schema}.t").count())
        return real(self, text, *args, **kw)

    monkeypatch.setattr(type(spark), "sql", sql)
    run_load(spark, full_spec(schema, "SELECT id FROM range(5)"))
    monkeypatch.undo()
    assert set(seen) <= {5} and [t.name for t in spark.catalog.listTables(schema) if not t.isTemporary] == ["t"]


# --- Nested types ---


def test_nested_fields_are_merged(spark):
    schema = database(spark)
    view = source(spark, days_of(1))
    where = f"FROM {view} WHERE d IN ({{target_date_list}})"
    first = "named_struct('a', 1, 'b', named_struct('c', 'x')) AS s, array(named_struct('p', 1)) AS l, map('k', named_struct('q', 1)) AS m, 5L AS n"
    run_load(spark, day_spec(schema, None, f"SELECT id, {first}, d {where}"), RANGE)
    second = (
        "named_struct('new', true, 'B', named_struct('C', 'y', 'e', 2.5D)) AS s, "
        "array(named_struct('r', 'z', 'p', 7), NULL) AS l, map('k', named_struct('t', 9)) AS m, 6 AS n"
    )
    run_load(spark, day_spec(schema, None, f"SELECT id, {second}, d {where}"), f"{DAYS[1]},{DAYS[2]}")
    null = "CAST(NULL AS STRUCT<a: INT>) AS s, CAST(NULL AS ARRAY<STRUCT<p: INT>>) AS l, 7S AS n"
    run_load(spark, day_spec(schema, None, f"SELECT id, {null}, d {where}"), DAYS[3])
    table = spark.table(f"{schema}.t")
    kinds = dict(table.dtypes)
    assert kinds["s"] == "struct<a:int,b:struct<c:string,e:double>,new:boolean>" and kinds["n"] == "bigint"
    assert kinds["l"] == "array<struct<p:int,r:string>>" and kinds["m"] == "map<string,struct<q:int,t:int>>"
    rows = {r.d: r for r in table.collect()}
    assert rows[DAYS[0]].s.asDict(True) == {"a": 1, "b": {"c": "x", "e": None}, "new": None}
    assert rows[DAYS[1]].s.asDict(True) == {"a": None, "b": {"c": "y", "e": 2.5}, "new": True}
    assert [x and tuple(x) for x in rows[DAYS[1]].l] == [(7, "z"), None] and rows[DAYS[0]].l[0].r is None
    assert tuple(rows[DAYS[2]].m["k"]) == (None, 9) and tuple(rows[DAYS[0]].m["k"]) == (1, None)
    assert (rows[DAYS[3]].s, rows[DAYS[3]].l, rows[DAYS[3]].m, rows[DAYS[3]].n) == (None, None, None, 7)


@pytest.mark.parametrize(
    ("have", "want", "fits"),
    [
        ("INT", "BIGINT", True),
        ("BIGINT", "INT", False),
        ("FLOAT", "DOUBLE", True),
        ("DOUBLE", "FLOAT", False),
        ("INT", "DECIMAL(10,0)", True),
        ("INT", "DECIMAL(10,2)", False),
        ("DECIMAL(5,2)", "DECIMAL(8,3)", True),
        ("DECIMAL(8,3)", "DECIMAL(8,2)", False),
        ("BIGINT", "DOUBLE", False),
        ("DATE", "TIMESTAMP_NTZ", True),
        ("STRUCT<a: INT>", "STRUCT<a: BIGINT>", True),
        ("STRUCT<a: BIGINT>", "STRUCT<a: INT>", False),
        ("ARRAY<SMALLINT>", "ARRAY<INT>", True),
        ("MAP<INT, INT>", "MAP<BIGINT, BIGINT>", True),
        ("MAP<STRUCT<a: INT, b: INT>, INT>", "MAP<STRUCT<a: INT>, INT>", False),
        ("STRING", "INT", False),
    ],
)
def test_types_widen_without_loss_only(spark, have, want, fits):
    schema = database(spark)
    run_load(spark, full_spec(schema, f"SELECT CAST(NULL AS {want}) AS c"))
    narrow = full_spec(schema, f"SELECT CAST(NULL AS {have}) AS c")
    if not fits:
        with pytest.raises(SpecError, match="in the query and"):
            run_load(spark, narrow)
        return
    kind = spark.table(f"{schema}.t").dtypes
    run_load(spark, narrow)
    assert spark.table(f"{schema}.t").dtypes == kind


# --- Unchanged partitions ---


def statuses(report):
    return [r.status for r in report.orderBy("partition_value").collect()]


@pytest.mark.parametrize("verify", ["content", "counts"])
def test_only_changed_partitions_are_switched(spark, verify):
    spec = loaded(spark)
    before = partition_locations(spark, spec.target, "d", DAYS)
    late = changed(spec, f"CASE WHEN d = '{DAYS[1]}' AND id % 100 = 1 THEN -1.0D ELSE v END AS v")
    report = run_load(spark, late, RANGE, skip_unchanged=True, verify=verify)
    assert statuses(report) == ["unchanged", "written", "unchanged", "unchanged"]
    assert all(r.rows_read == r.rows_before == r.rows_after == 3 for r in report.collect())
    after = partition_locations(spark, spec.target, "d", DAYS)
    assert [v for v in DAYS if before[v] != after[v]] == [DAYS[1]]
    assert rows_of(spark.table(spec.target)) == rows_of(spark.sql(late.partition_query.replace("{target_date_list}", str(DAYS)[1:-1])))
    held, used, journals = folders_beside(spark, spec)
    assert held <= used and not journals


def test_nothing_is_switched_if_nothing_has_changed(spark, monkeypatch):
    spec = loaded(spark)
    before = partition_locations(spark, spec.target, "d", DAYS)
    monkeypatch.setattr(tables, "switch", lambda *_: pytest.fail("switched"))
    assert statuses(run_load(spark, spec, RANGE, skip_unchanged=True)) == ["unchanged"] * 4
    assert partition_locations(spark, spec.target, "d", DAYS) == before
    held, used, _ = folders_beside(spark, spec)
    assert held <= used


def test_new_partitions_and_columns_are_changes(spark):
    view = source(spark, days_of(2))
    spec = day_spec(database(spark), view)
    assert statuses(run_load(spark, spec, f"{DAYS[0]},{DAYS[1]}", skip_unchanged=True)) == ["written"] * 2
    assert statuses(run_load(spark, spec, RANGE, skip_unchanged=True)) == ["unchanged"] * 2 + ["written"] * 2
    wider = changed(spec, "v, id + 1 AS extra")
    assert statuses(run_load(spark, wider, RANGE, skip_unchanged=True)) == ["written"] * 4
    # A NULL in place of a value is a change, and rows in another order or number of files are none.
    nulled = changed(spec, f"CASE WHEN d = '{DAYS[0]}' THEN NULL ELSE v END AS v, id + 1 AS extra")
    shuffled = day_spec(spec.schema, None, nulled.partition_query.replace("SELECT", "SELECT /*+ REPARTITION(5) */", 1))
    assert statuses(run_load(spark, shuffled, RANGE, skip_unchanged=True)) == ["written"] + ["unchanged"] * 3


def test_a_failed_comparison_leaves_everything(spark, monkeypatch):
    spec = loaded(spark)
    before = rows_of(spark.table(spec.target))
    held = folders_beside(spark, spec)
    monkeypatch.setattr(tables, "target_partitions", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        run_load(spark, changed(spec), RANGE, skip_unchanged=True)
    monkeypatch.undo()
    assert rows_of(spark.table(spec.target)) == before and folders_beside(spark, spec) == held


def test_skipping_needs_partitions_that_are_written(spark):
    spec = loaded(spark)
    with pytest.raises(SpecError):
        run_load(spark, spec, RANGE, dry_run=True, skip_unchanged=True)
    with pytest.raises(SpecError):
        run_load(spark, full_spec(spec.schema, "SELECT 1 AS a"), skip_unchanged=True)
