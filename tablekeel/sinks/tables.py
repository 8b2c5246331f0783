"""Publishing rows into tables: write once, audit, then switch to the new files.

Rows are written to a folder of their own beside the target, ``<table>__loads/<id>``, and
counted there. Only then does the catalog point the target's partitions, or the whole
table, at that folder, under a journal. What the target then holds is compared with what was
counted and written, and a difference puts everything back. A load that dies before the
switch leaves at most a folder that nothing refers to.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from decimal import Decimal

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeel.errors import DataQualityError, SpecError, VerificationError
from tablekeel.operators.guards import CheckedSource, Unexpected
from tablekeel.operators.quality import (
    distinct_partitions,
    partition_contents,
    partition_counts,
    reconcile_contents,
    row_hash,
    total_rows,
)
from tablekeel.sinks.folders import delete, escaped, file_names, listed_files, new_folder, normal, table_folder
from tablekeel.sinks.journal import Change, Swap, sql_text, switch, switch_files, written_beside
from tablekeel.sinks.layout import Evolution, check_typed, evolve, expected_keys_only, fit_to_target, spread_for_write
from tablekeel.sources.extract import source_errors
from tablekeel.sources.target import (
    FILE_FORMATS,
    SELF_DESCRIBING,
    TargetState,
    key_in,
    partition_locations,
    target_partitions,
    target_state,
)
from tablekeel.spec import LoadSpec, quoted

DYNAMIC_OVERWRITE = "partitionOverwriteMode"
#: Bytes that a file should have at least, on average, for its partition not to be worth merging.
FILE_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class StagedRows:
    """Rows written to a folder beside the target, read back from there."""

    frame: DataFrame
    folder: str
    evolution: Evolution
    unexpected: Unexpected | None = None
    #: Where the target's partitions were when the load began.
    seen: Mapping[str, str] = field(default_factory=dict)
    #: The sum of the hashes of all rows as they were written; None if contents are not to be compared.
    content: Decimal | None = None


# --- Listed partitions ---


@contextmanager
def staged_partitions(
    spark: SparkSession,
    source: DataFrame,
    spec: LoadSpec,
    state: TargetState | None,
    expected: Sequence[str],
    rebalance: bool,
    contents: bool = True,
) -> Iterator[StagedRows]:
    """The query's rows, evaluated once and written by partition; removed again if the load fails."""
    key = spec.partition_column
    seen = partition_locations(spark, state.name, key, expected) if state and state.lists_partitions else {}
    fitted, evolution = (source, Evolution()) if state is None else fit_to_target(source, state)
    check_typed(list(fitted.schema))
    value = F.col(quoted(key))
    bad = ~F.coalesce(key_in(key, fitted.schema[key].dataType, expected), F.lit(False))
    strange = Observation()
    watched = fitted.observe(
        strange,
        F.min(F.when(bad, value.cast("string"))).alias("lowest"),
        F.max(F.when(bad, value.cast("string"))).alias("highest"),
        F.count(F.when(bad & value.isNull(), F.lit(1))).alias("null_rows"),
    )
    rows = expected_keys_only(watched, key, expected)
    rows = rows.select(*[quoted(c) for c in rows.columns if c != key], quoted(key))
    folder = new_folder(spark, state, spec)
    kind = state.provider if state and state.provider in SELF_DESCRIBING else "parquet"
    try:
        with source_errors("the query could not be executed"):
            spread = spread_for_write(rows, key, len(expected)) if rebalance else rows
            written = Observation()
            if contents:
                # In the tasks that write, after the shuffle: each of them counts once, however often it is tried.
                spread = spread.observe(written, F.sum(row_hash(spread.schema, spread.columns)).alias("content"))
            spread.write.format(kind).partitionBy(key).save(folder)
        content = observed(written).get("content") if contents else None
        unexpected = Unexpected(**(observed(strange) or {"lowest": None, "highest": None, "null_rows": 0}))
        yield StagedRows(read_back(spark, folder, kind, rows.schema), folder, evolution, unexpected, seen, content)
    except BaseException:
        delete(spark, [folder])
        raise


def observed(seen: Observation) -> dict:
    try:
        return seen.get
    except Py4JJavaError:  # Spark has found the query to be empty before it ran, and left out what watches it
        return {}


def read_back(spark: SparkSession, folder: str | list[str], kind: str, schema: T.StructType) -> DataFrame:
    return spark.read.format(kind).schema(_nullable(schema)).load(folder)


def unchanged_partitions(
    spark: SparkSession, checked: CheckedSource, staged: StagedRows, name: str, state: TargetState | None
) -> dict[str, Decimal]:
    """The partitions that the target holds with the very rows that were staged, and the content of each.

    Partitions whose counts differ are not read. If the load brings columns or nested fields
    that the target lacks, no partition is as it was.
    """
    likely = [p.partition_value for p in checked.partitions if p.rows_read and p.rows_read == p.rows_before]
    if state is None or not likely or staged.evolution != Evolution():
        return {}
    key, columns = checked.key, staged.frame.columns
    rows = staged.frame.where(key_in(key, staged.frame.schema[key].dataType, likely))
    held = partition_contents(target_partitions(spark, name, key, likely), key, columns)
    # One row per partition and side, so that those which agree are few.
    return {r.partition_value: r.content for r in partition_contents(rows, key, columns).intersect(held).collect()}


def publish_partitions(
    spark: SparkSession,
    checked: CheckedSource,
    staged: StagedRows,
    name: str,
    state: TargetState | None,
    unchanged: Mapping[str, Decimal] | None = None,
) -> None:
    """Make the staged rows the target's partitions, creating the table if need be.

    The guards have made sure that only listed partitions are in the files, and that a
    listed one without rows has none in the target to remove. New columns are added here,
    not before, so that a failed load leaves the schema as it was. The unchanged partitions
    keep their files, and what was staged of them is removed.
    """
    if unchanged:
        staged = _without(spark, staged, checked.key, unchanged)
    if state is None:
        empty = spark.createDataFrame([], staged.frame.schema)
        empty.write.format("parquet").option(DYNAMIC_OVERWRITE, "dynamic").partitionBy(checked.key).saveAsTable(name)
        state = target_state(spark, name)
    else:
        evolve(spark, name, staged.evolution)
    counts = {p.partition_value: p.rows_read for p in checked.partitions if p.rows_read}
    counts = {v: n for v, n in counts.items() if v not in (unchanged or {})}
    if not counts:
        delete(spark, [staged.folder])
        return
    _publish(spark, staged, name, checked.key, counts, state)


def _without(spark: SparkSession, staged: StagedRows, key: str, unchanged: Mapping[str, Decimal]) -> StagedRows:
    rest = staged.frame.where(~key_in(key, staged.frame.schema[key].dataType, list(unchanged)))
    content = None if staged.content is None else staged.content - sum(unchanged.values())
    delete(spark, [f"{staged.folder}/{escaped(key)}={escaped(v)}" for v in unchanged])
    return replace(staged, frame=rest, content=content)


def _publish(
    spark: SparkSession, staged: StagedRows, name: str, key: str, counts: Mapping[str, int], state: TargetState
) -> None:
    """Switch the partitions to the staged folder and compare what the target then holds.

    A table whose partitions the catalog does not list, or whose format needs more than
    the files, is overwritten from the staged rows by Spark instead.
    """

    def check() -> None:
        verify_partitions(spark, name, key, counts, staged)

    if state.lists_partitions and state.provider in SELF_DESCRIBING:
        changes = [Change(v, staged.seen.get(v), f"{staged.folder}/{escaped(key)}={escaped(v)}") for v in counts]
        switch(spark, name, key, table_folder(spark, state), changes, check)
        return
    _overwrite_partitions(spark, staged.frame, name, state)
    spark.catalog.refreshTable(name)
    check()
    delete(spark, [staged.folder])


def _overwrite_partitions(spark: SparkSession, df: DataFrame, name: str, state: TargetState) -> None:
    # The setting has to live on the table: as a write option or on a table without it,
    # the same statement would empty every other partition.
    if not state.replaces_only_written_partitions:
        spark.sql(f"ALTER TABLE {name} SET SERDEPROPERTIES ('{DYNAMIC_OVERWRITE}'='dynamic')")
        state = target_state(spark, name)
        if not state.replaces_only_written_partitions:
            raise SpecError(f"target {name} cannot be set to replace single partitions")
    with source_errors("the checked rows could not be written"):
        df.select(*[quoted(c) for c in spark.table(name).columns]).write.insertInto(name, overwrite=True)


def verify_partitions(spark: SparkSession, name: str, key: str, counts: Mapping[str, int], staged: StagedRows) -> None:
    """Compare what the target holds of the partitions with the rows that were counted, and with what was written.

    Contents are compared as one sum over all partitions, so the target is read once; if
    they differ, a second reading says where, unless the files themselves have changed.
    """
    held = target_partitions(spark, name, key, list(counts))
    found = partition_counts(held, key) if staged.content is None else partition_contents(held, key, staged.frame.columns)
    found = {r.partition_value: r for r in found.collect()}
    wrong = [v for v in sorted({*counts, *found}) if counts.get(v, 0) != (found[v].row_count if v in found else 0)]
    if wrong:
        told = (f"{v} ({counts.get(v, 0)} checked, {found[v].row_count if v in found else 0} in the target)" for v in wrong)
        raise VerificationError(f"{name} differs from the checked rows: {', '.join(told)}")
    if staged.content is not None and sum(r.content for r in found.values()) != staged.content:
        apart = reconcile_contents(staged.frame, key, held, key, staged.frame.columns).where("NOT same_content")
        where = ", ".join(sorted(r.partition_value for r in apart.collect())) or "the files are not those that were written"
        raise VerificationError(f"{name} has other rows than were written: {where}")


# --- Whole tables ---


def replace_table(
    spark: SparkSession, source: DataFrame, spec: LoadSpec, state: TargetState | None, rebalance: bool, merge: bool
) -> int:
    """Replace the whole target with the query's rows and return their number.

    The rows go to a folder of their own and are counted there; then the table's location
    changes, in one step. The table keeps its kind, comment, properties and grants, the
    query runs once and may read the target itself, and until that step a failure leaves
    the old rows in place. ``merge`` writes small files once more as fewer before it.
    """
    fitted, evolution = (source, Evolution()) if state is None else fit_to_target(source, state)
    check_typed(list(fitted.schema))
    kind, options = (state.provider, state.options) if state else ("parquet", {})
    made: list[str] = []

    def written(rows: DataFrame) -> tuple[str, DataFrame, int]:
        made.append(folder := new_folder(spark, state, spec))
        rows.write.format(kind).options(**options).save(folder)
        back = spark.read.format(kind).options(**options).schema(_nullable(rows.schema)).load(folder)
        return folder, back, total_rows(back).first().row_count

    def check() -> None:
        held = total_rows(spark.table(spec.target)).first().row_count
        if held != rows:
            raise VerificationError(f"{spec.target} holds {held} rows, {rows} were written")

    try:
        with source_errors("the query could not be executed"):
            folder, back, rows = written(spread_for_write(fitted) if rebalance else fitted)
        if rows == 0:
            raise DataQualityError("the query returned no rows for a full load")
        if merge and not rebalance and _has_small_files(spark, folder):
            folder, back, again = written(spread_for_write(back))
            if again != rows:
                raise VerificationError(f"merging files of {spec.target} found {rows} rows and left {again}")
        if state is not None:
            evolve(spark, spec.target, evolution)
    except BaseException:
        delete(spark, made)
        raise
    if state is None:
        create_at(spark, spec, back, folder)
        check()
    else:
        change = Change(None, state.location, folder)
        switch(spark, spec.target, "", table_folder(spark, state), [change], check)
    delete(spark, [f for f in made if f != folder])
    return rows


def create_at(spark: SparkSession, spec: LoadSpec, rows: DataFrame, folder: str) -> None:
    """A new table with its rows in place: made empty under another name, pointed at them, and then renamed."""
    before = spec.sibling(f"{spec.table}__new_{uuid.uuid4().hex[:8]}")
    try:
        spark.createDataFrame([], rows.schema).write.format("parquet").saveAsTable(before)
        empty = target_state(spark, before).location
        spark.sql(f"ALTER TABLE {before} SET LOCATION {sql_text(folder)}")
        delete(spark, [empty])
        spark.sql(f"ALTER TABLE {before} RENAME TO {spec.target}")
    except BaseException:
        if spark.catalog.tableExists(before):
            spark.sql(f"DROP TABLE {before}")
        if not (spark.catalog.tableExists(spec.target) and normal(target_state(spark, spec.target).location) == normal(folder)):
            delete(spark, [folder])
        raise
    spark.catalog.refreshTable(spec.target)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def _has_small_files(spark: SparkSession, folder: str, file_bytes: int = FILE_BYTES) -> bool:
    files = listed_files(spark, [folder]).agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    return files.n >= 2 * -(-(files.bytes or 0) // file_bytes) and files.n > 1


# --- Compaction ---


def small_file_partitions(
    spark: SparkSession, name: str, key: str, values: Sequence[str], file_bytes: int = FILE_BYTES, least_factor: float = 2.0
) -> DataFrame:
    """The listed partitions whose files below file_bytes are at least least_factor times those their bytes need.

    ``partition_value, files, bytes, files_needed``, of these small files; from a listing of the folders.
    """
    folders = _folders_of(spark, target_state(spark, name), key, values)
    if not folders:
        return spark.createDataFrame([], "partition_value string, files bigint, bytes bigint, files_needed bigint")
    of = spark.createDataFrame([(v, f.rstrip("/")) for v, f in folders.items()], "partition_value string, folder string")
    of = of.withColumn("folder", F.regexp_replace("folder", "^file:/+", "file:/"))
    return (
        listed_files(spark, list(folders.values()))
        .where(F.col("length") < file_bytes)
        .join(F.broadcast(of), "folder")
        .groupBy("partition_value")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .withColumn("files_needed", F.ceil(F.col("bytes") / F.lit(file_bytes)))
        .where(F.col("files") >= F.greatest(F.lit(2), least_factor * F.col("files_needed")))
    )


def _folders_of(spark: SparkSession, state: TargetState, key: str, values: Sequence[str]) -> dict[str, str]:
    if state.lists_partitions:
        return partition_locations(spark, state.name, key, values)
    present = {r.partition_value for r in distinct_partitions(target_partitions(spark, state.name, key, values), key).collect()}
    return {v: f"{state.location.rstrip('/')}/{escaped(key)}={escaped(v)}" for v in values if v in present}


def compact_partitions(
    spark: SparkSession, name: str, key: str, values: Sequence[str], file_bytes: int = FILE_BYTES, least_factor: float = 2.0
) -> list[str]:
    """Merge the small files of the listed partitions where there are many; return which partitions.

    Files of at least file_bytes are neither read nor moved. The others of a partition are
    merged if they are at least least_factor times the files that their bytes would fill, and
    more than one. The rows stay the same: they are written beside the table, compared
    there, and only then swapped in. The new files follow
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so file_bytes should not be above
    half of that. Partitions already in good shape are not touched, and partitions in a text
    format are written once more as a whole.
    """
    state = target_state(spark, name)
    if state is None or state.is_view or state.partition_columns != (key,) or state.provider not in FILE_FORMATS:
        raise SpecError(f"{name} is no table partitioned by {key}")
    found = small_file_partitions(spark, name, key, values, file_bytes, least_factor)
    chosen = sorted(r.partition_value for r in found.select("partition_value").collect())
    if not chosen:
        return []
    if state.provider in SELF_DESCRIBING:
        _merge_small_files(spark, name, key, chosen, state, file_bytes)
        return chosen
    rows = target_partitions(spark, name, key, chosen)
    kind = state.provider if state.provider in SELF_DESCRIBING else "parquet"
    folder = new_folder(spark, state)
    seen = partition_locations(spark, name, key, chosen) if state.lists_partitions else {}
    try:
        spread_for_write(rows, key, len(chosen)).write.format(kind).partitionBy(key).save(folder)
        staged = StagedRows(read_back(spark, folder, kind, rows.schema), folder, Evolution(), seen=seen)
        compared = reconcile_contents(rows, key, staged.frame, key, rows.columns).collect()
        wrong = sorted(r.partition_value for r in compared if not r.same_content)
        if wrong:
            raise VerificationError(f"merging files of {name} would change the rows of {', '.join(wrong)}")
    except BaseException:
        delete(spark, [folder])
        raise
    _publish(spark, staged, name, key, {r.partition_value: r.source_rows for r in compared}, state)
    return chosen


def _merge_small_files(
    spark: SparkSession, name: str, key: str, chosen: Sequence[str], state: TargetState, file_bytes: int
) -> None:
    """Write the rows of the small files once more, compare them, and swap the files within their folders."""
    spark.catalog.refreshTable(name)
    folders = _folders_of(spark, state, key, chosen)
    before = file_names(spark, list(folders.values()))
    small: dict[str, list[str]] = {}
    for row in listed_files(spark, list(folders.values())).where(F.col("length") < file_bytes).toLocalIterator():
        small.setdefault(row.folder, []).append(row.name)
    # Sizes are known from the listing, so Spark leaves out the other files before it reads any.
    rows = target_partitions(spark, name, key, chosen).where(F.col("_metadata.file_size") < file_bytes)
    work = new_folder(spark, state)
    with written_beside(spark, name, before, work):
        spread_for_write(rows, key, len(chosen)).write.format(state.provider).partitionBy(key).save(f"{work}/rows")
        merged = read_back(spark, f"{work}/rows", state.provider, rows.schema)
        compared = reconcile_contents(rows, key, merged, key, rows.columns).collect()
        wrong = sorted(r.partition_value for r in compared if not r.same_content)
        if wrong:
            raise VerificationError(f"merging files of {name} would change the rows of {', '.join(wrong)}")
        held = file_names(spark, [f"{work}/rows"])
    swaps = []
    for value, folder in folders.items():
        part = f"{escaped(key)}={escaped(value)}"
        stage, aside = f"{work}/rows/{part}", f"{work}/replaced/{part}"
        into = tuple(sorted(held.get(normal(stage), ())))
        swaps.append(Swap(normal(folder), stage, aside, tuple(sorted(small.get(normal(folder), ()))), into))
    # The folders keep their place in the catalog, if it lists them at all.
    stay = folders if state.lists_partitions else {None: state.location}
    switch_files(spark, name, key, table_folder(spark, state), stay, swaps, before, work, lambda: None)
