"""``run_load``: plan, read, check, publish and verify one target."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeel.errors import DataQualityError, SpecError, VerificationError
from tablekeel.functions.dates import window_days, window_partitions
from tablekeel.operators.guards import CheckedSource, Unexpected, check_key_column, check_partitions
from tablekeel.operators.quality import bounds_of, total_rows
from tablekeel.operators.spine import listed_partitions, plan_loads, single_request
from tablekeel.sinks.clustered import publish_clustered, staged_clustered
from tablekeel.sinks.folders import table_folder
from tablekeel.sinks.journal import recover
from tablekeel.sinks.layout import check_typed, fit_to_target
from tablekeel.sinks.tables import (
    compact_partitions,
    publish_partitions,
    replace_table,
    staged_partitions,
    unchanged_partitions,
)
from tablekeel.sinks.views import publish_view
from tablekeel.sources.extract import extract, fill_date_list, source_errors
from tablekeel.sources.target import (
    SELF_DESCRIBING,
    TargetState,
    check_target_kind,
    target_partitions,
    target_state,
)
from tablekeel.spec import LoadSpec

log = logging.getLogger(__name__)

REPORT_SCHEMA = (
    "partition_value string, rows_read bigint, rows_before bigint, rows_after bigint, status string"
)


@dataclass(frozen=True)
class LoadPlan:
    """What one partitioned load covers: its window, its partitions and its final query."""

    start_date: date
    end_date: date
    partitions: tuple[str, ...]
    query: str


def plan_load(
    spark: SparkSession, spec: LoadSpec, target_date: str | None = None, now: date | datetime | None = None
) -> LoadPlan:
    """Work out the window of a day or month load and fill in its query."""
    request = single_request(
        spark, spec.partition_type, spec.processing_strategy, target_date, _run_date(now, spec.time_zone)
    )
    windows = plan_loads(request).select("start_date", "end_date", "error")
    start, end = F.col("start_date"), F.col("end_date")
    window = windows.select(
        "*",
        window_days(start, end).alias("days"),
        window_partitions(F.lit(spec.partition_type), start, end).alias("partitions"),
    ).first()
    if window.error:
        raise SpecError(window.error)
    return LoadPlan(
        window.start_date,
        window.end_date,
        tuple(window.partitions),
        fill_date_list(spec.partition_query, window.days),
    )


def _run_date(now: date | datetime | None, time_zone: str = "") -> date:
    """The run's calendar day, in UTC unless the spec names a time zone."""
    zone = ZoneInfo(time_zone) if time_zone else timezone.utc
    if now is None:
        now = datetime.now(zone)
    if not isinstance(now, datetime):
        return now
    return (now.astimezone(zone) if now.tzinfo else now).date()


def run_load(
    spark: SparkSession,
    spec: LoadSpec | Mapping[str, str | None],
    target_date: str | None = None,
    dry_run: bool = False,
    now: date | datetime | None = None,
    *,
    rebalance: bool | None = None,
    compact: bool | None = None,
    verify: str = "content",
    skip_unchanged: bool = False,
) -> DataFrame:
    """Load or reload one target and report row counts per partition.

    ``target_date`` names a day, month or range (``a,b``) and wins over the spec's
    strategy, which counts back from ``now``. With ``dry_run`` all checks run and
    nothing is written; it reads the key column and the filter columns only.

    The query runs once. Its rows are written beside the target, checked there, and
    switched in. ``rebalance`` shuffles rows into well-filled files before the write;
    partitioned loads do so unless told otherwise, as for queries whose tasks already
    hold one partition value each. ``compact`` merges small files: for a whole-table load
    before the switch and unless told otherwise, for the loaded partitions if asked.
    ``verify`` compares what a partitioned target then holds with the rows that were written:
    by ``content``, a hash of every row, which reads the loaded partitions once, or by ``counts``.
    ``skip_unchanged`` switches only the partitions whose rows differ from those in the target,
    for ranges of which few partitions have got late rows; the others keep their files, and
    their status is ``unchanged``. Partitions with equal counts are compared by a hash of every row.

    Raises :class:`ConflictError` if another load has published the same partitions since this
    one began. A load that died while it switched its target is finished or undone first.

    Returns ``partition_value, rows_read, rows_before, rows_after, status``: a row per
    expected partition, or a single one with no partition value for a whole-table load.
    """
    spec = spec if isinstance(spec, LoadSpec) else LoadSpec.from_mapping(spec)
    if spec.is_view and (rebalance is not None or compact is not None):
        raise SpecError("a view stores nothing, so it takes neither rebalance nor compact")
    if dry_run and compact:
        raise SpecError("a dry run writes nothing, so it takes no compact")
    if skip_unchanged and (dry_run or not spec.is_partitioned):
        raise SpecError("skip_unchanged applies to partitioned loads that write")
    if spec.is_clustered and (skip_unchanged or compact):
        raise SpecError("a clustered table takes neither skip_unchanged nor compact")
    if verify not in ("content", "counts"):
        raise SpecError(f"verify must be content or counts, got {verify!r}")
    state = _open_target(spark, spec, target_date)
    if not spec.is_view and not dry_run and recover(spark, table_folder(spark, state, spec)):
        state = _open_target(spark, spec, target_date)
    if spec.is_view:
        return _load_view(spark, spec, dry_run)
    if not spec.is_partitioned:
        return _load_full(spark, spec, state, dry_run, rebalance is True, compact is not False)
    if skip_unchanged and state is not None and state.provider not in SELF_DESCRIBING:
        raise SpecError(f"the contents of {spec.target} can not be compared: its format is {state.provider}")
    plan = plan_load(spark, spec, target_date, now)
    source = _partitioned_source(spark, spec, plan, state)
    if dry_run:
        checked = _check(spark, spec, plan, source, state)
        return _report(
            spark,
            (
                (p.partition_value, p.rows_read, p.rows_before, p.rows_before,
                 "would_write" if p.rows_read else "missing")
                for p in checked.partitions
            ),
        )
    contents = verify == "content" and (state is None or state.provider in SELF_DESCRIBING)
    staging = staged_clustered if spec.is_clustered else staged_partitions
    with staging(spark, source, spec, state, plan.partitions, rebalance is not False, contents) as staged:
        checked = _check(spark, spec, plan, staged.frame, state, staged.unexpected)
        unchanged = unchanged_partitions(spark, checked, staged, spec.target, state) if skip_unchanged else {}
    if spec.is_clustered:
        publish_clustered(spark, checked, staged, spec, state)
    else:
        publish_partitions(spark, checked, staged, spec.target, state, unchanged)
    if compact:
        _try_compaction(spark, spec, [p.partition_value for p in checked.partitions if p.rows_read])

    def status(value: str, rows: int) -> str:
        return "unchanged" if value in unchanged else "written" if rows else "missing"

    # Rows read are rows after: publishing has compared the two, partition by partition.
    report = _report(
        spark,
        (
            (p.partition_value, p.rows_read, p.rows_before, p.rows_read, status(p.partition_value, p.rows_read))
            for p in checked.partitions
        ),
    )
    loaded = report.where("rows_after > 0").select("partition_value", F.col("rows_after").alias("row_count"))
    bounds = bounds_of(loaded).first()
    log.info("%s: %d rows in %s to %s", spec.target, bounds.row_count, bounds.min_partition, bounds.max_partition)
    return report


def preview_rows(
    spark: SparkSession,
    spec: LoadSpec | Mapping[str, str | None],
    target_date: str | None = None,
    now: date | datetime | None = None,
) -> DataFrame:
    """The rows a load would publish, after all checks, as a lazy DataFrame."""
    spec = spec if isinstance(spec, LoadSpec) else LoadSpec.from_mapping(spec)
    state = _open_target(spark, spec, target_date)
    if spec.is_view:
        return extract(spark, spec.partition_query)
    if not spec.is_partitioned:
        source = extract(spark, spec.partition_query)
        _check_columns(source, state)
        _rows_of_full(source)
        return source
    plan = plan_load(spark, spec, target_date, now)
    return _check(spark, spec, plan, _partitioned_source(spark, spec, plan, state), state).frame


def _open_target(spark: SparkSession, spec: LoadSpec, target_date: str | None) -> TargetState | None:
    if target_date is not None and not isinstance(target_date, str):
        raise SpecError(f"target_date must be text, got {type(target_date).__name__}")
    spec.check_target_date(target_date)
    if not spark.catalog.databaseExists(spec.target_schema):
        raise SpecError(f"target schema {spec.target_schema} does not exist")
    state = target_state(spark, spec.target)
    check_target_kind(spec, state)
    return state


def _partitioned_source(
    spark: SparkSession, spec: LoadSpec, plan: LoadPlan, state: TargetState | None
) -> DataFrame:
    source = extract(spark, plan.query)
    check_key_column(source, spec.partition_column, spec.partition_type)
    _check_columns(source, state)
    return source


def _check_columns(source: DataFrame, state: TargetState | None) -> None:
    """Find columns that cannot be stored before any data is read."""
    if state is None:
        check_typed(list(source.schema))
    else:
        fit_to_target(source, state)


def _check(
    spark: SparkSession,
    spec: LoadSpec,
    plan: LoadPlan,
    source: DataFrame,
    state: TargetState | None,
    put_together: Unexpected | None = None,
) -> CheckedSource:
    present = None
    if state is not None:
        present = target_partitions(spark, spec.target, spec.partition_column, plan.partitions)
    spine = listed_partitions(spark, plan.partitions)
    return check_partitions(source, spec.partition_column, spine, present, put_together)


def _try_compaction(spark: SparkSession, spec: LoadSpec, values: list[str]) -> None:
    try:
        compact_partitions(spark, spec.target, spec.partition_column, values)
    except VerificationError:
        raise
    except Exception:  # the load itself is complete, so upkeep only warns
        log.warning("could not compact %s", spec.target, exc_info=True)


def _rows_of_full(source: DataFrame) -> int:
    with source_errors("the query could not be executed"):
        rows = total_rows(source).first().row_count
    if rows == 0:
        raise DataQualityError("the query returned no rows for a full load")
    return rows


def _load_full(
    spark: SparkSession, spec: LoadSpec, state: TargetState | None, dry_run: bool, rebalance: bool, merge: bool
) -> DataFrame:
    source = extract(spark, spec.partition_query)
    _check_columns(source, state)
    before = total_rows(spark.table(spec.target)).first().row_count if state else 0
    if dry_run:
        return _report(spark, [(None, _rows_of_full(source), before, before, "would_write")])
    rows = replace_table(spark, source, spec, state, rebalance, merge)  # which has counted them in the target
    return _report(spark, [(None, rows, before, rows, "written")])


def _load_view(spark: SparkSession, spec: LoadSpec, dry_run: bool) -> DataFrame:
    source = extract(spark, spec.partition_query)
    with source_errors("the query could not be executed"):
        rows = source.count()
    if rows == 0:
        log.warning("the query of view %s returns no rows", spec.target)
    if dry_run:
        return _report(spark, [(None, rows, None, None, "would_write")])
    publish_view(spark, spec)
    return _report(spark, [(None, rows, None, spark.table(spec.target).count(), "written")])


def _report(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), REPORT_SCHEMA)
