"""Tables that are clustered by the key and not partitioned by it: files are replaced, not folders.

A file holds one key, or a few small ones, sorted. A load writes its rows beside the
table, finds the files that hold any of its keys, writes what else is in them once more, and
swaps these files for the new ones under a journal. All other files are left as they are,
and the statistics in the files keep most of them from being read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tablekeel.errors import VerificationError
from tablekeel.operators.guards import CheckedSource
from tablekeel.operators.quality import row_hash
from tablekeel.sinks.folders import delete, file_names, new_folder, normal, table_folder
from tablekeel.sinks.journal import Swap, switch_files, written_beside
from tablekeel.sinks.layout import Evolution, check_typed, evolve, fit_to_target, spread_for_write
from tablekeel.sinks.tables import StagedRows, create_at, observed, read_back, verify_partitions
from tablekeel.sources.extract import source_errors
from tablekeel.sources.target import TargetState, key_in, target_partitions, target_state
from tablekeel.spec import LoadSpec, quoted


@dataclass(frozen=True)
class ClusteredRows(StagedRows):
    """Staged rows, and the files that the target had when the load began."""

    before: frozenset[str] = frozenset()
    work: str = ""


def clustered_for_write(df: DataFrame, key: str, values: int = 1) -> DataFrame:
    """As :func:`spread_for_write`, and sorted by the key, so that few row groups hold a given one."""
    return spread_for_write(df, key, values).sortWithinPartitions(F.col(quoted(key)))


def touched_files(spark: SparkSession, name: str, key: str, values: Sequence[str]) -> list[str]:
    """The names of the target's files that hold rows of the listed keys; only the key is read, and where it may be."""
    rows = target_partitions(spark, name, key, values)
    return sorted(r.file_name for r in rows.select("_metadata.file_name").distinct().collect())


@contextmanager
def staged_clustered(
    spark: SparkSession,
    source: DataFrame,
    spec: LoadSpec,
    state: TargetState | None,
    expected: Sequence[str],
    rebalance: bool,
    contents: bool = True,
) -> Iterator[ClusteredRows]:
    """The query's rows, evaluated once and written as they will be stored; removed again if the load fails."""
    key = spec.partition_column
    before = frozenset()
    if state is not None:
        spark.catalog.refreshTable(state.name)
        before = file_names(spark, [state.location])[normal(state.location)]
    rows, evolution = (source, Evolution()) if state is None else fit_to_target(source, state)
    check_typed(list(rows.schema))
    work = new_folder(spark, state, spec)
    kind = state.provider if state else "parquet"
    try:
        with source_errors("the query could not be executed"):
            spread = clustered_for_write(rows, key, len(expected)) if rebalance else rows
            written = Observation()
            if contents:
                spread = spread.observe(written, F.sum(row_hash(spread.schema, spread.columns)).alias("content"))
            spread.write.format(kind).save(f"{work}/rows")
        content = observed(written).get("content") if contents else None
        frame = read_back(spark, f"{work}/rows", kind, rows.schema)
        yield ClusteredRows(frame, f"{work}/rows", evolution, content=content, before=before, work=work)
    except BaseException:
        delete(spark, [work])
        raise


def publish_clustered(
    spark: SparkSession, checked: CheckedSource, staged: ClusteredRows, spec: LoadSpec, state: TargetState | None
) -> None:
    """Replace the rows of the checked keys by the staged ones, and leave every other row in place."""
    key, name = checked.key, spec.target
    counts = {p.partition_value: p.rows_read for p in checked.partitions if p.rows_read}

    def check() -> None:
        verify_partitions(spark, name, key, counts, staged)

    if state is None:
        create_at(spark, spec, staged.frame, staged.folder)
        check()
        # A new name may have moved the rows, and then leaves the folder above them empty.
        if not normal(target_state(spark, name).location).startswith(normal(staged.work)):
            delete(spark, [staged.work])
        return
    folder = normal(state.location)
    with written_beside(spark, name, {folder: staged.before}, staged.work):
        evolve(spark, name, staged.evolution)
        touched = touched_files(spark, name, key, list(counts))
        if touched:
            _carry(spark, staged, state, name, key, list(counts), touched)
        held = file_names(spark, [staged.work])
    swaps = [
        Swap(folder, f"{staged.work}/{part}", f"{staged.work}/replaced", out, tuple(sorted(held.get(normal(f"{staged.work}/{part}"), ()))))
        for part, out in (("rows", ()), ("carried", tuple(touched)))
    ]
    base = table_folder(spark, state)
    switch_files(spark, name, key, base, {None: state.location}, swaps, {folder: staged.before}, staged.work, check)


def _carry(
    spark: SparkSession, staged: ClusteredRows, state: TargetState, name: str, key: str, values: Sequence[str], files: Sequence[str]
) -> None:
    """Write the other rows of the touched files once more, and compare them with what they were."""
    schema = spark.table(name).schema
    rows = read_back(spark, [f"{state.location.rstrip('/')}/{f}" for f in files], state.provider, schema)
    kept = rows.where(~F.coalesce(key_in(key, schema[key].dataType, values), F.lit(False)))
    clustered_for_write(kept, key, len(files)).write.format(state.provider).save(f"{staged.work}/carried")
    again = read_back(spark, f"{staged.work}/carried", state.provider, schema)
    was, now = _summed(kept), _summed(again)
    if was != now:
        raise VerificationError(f"{name}: {was.row_count} rows had to be carried over, the {now.row_count} written differ from them")


def _summed(rows: DataFrame) -> Row:
    return rows.agg(F.count("*").alias("row_count"), F.sum(row_hash(rows.schema, rows.columns)).alias("content")).first()
