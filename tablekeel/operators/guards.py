"""The checks between reading and writing. Only what passes them can be written."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeel.errors import DataQualityError
from tablekeel.operators.quality import (
    fold_unexpected,
    gap_partitions,
    missing_partitions,
    out_of_range_partitions,
    partition_ledger,
    summary_of,
)
from tablekeel.sources.extract import source_errors

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class PartitionCount:
    partition_value: str
    rows_read: int
    rows_before: int


@dataclass(frozen=True)
class CheckedSource:
    """Source rows that passed every guard, with what was counted on the way.

    The sinks take nothing else, so no partition can be replaced unchecked.
    """

    frame: DataFrame
    key: str
    partitions: tuple[PartitionCount, ...]

    @property
    def expected(self) -> list[str]:
        return [p.partition_value for p in self.partitions]

    @property
    def rows_read(self) -> int:
        return sum(p.rows_read for p in self.partitions)


def check_key_column(df: DataFrame, key: str, partition_type: str) -> None:
    """The key must be in the result under exactly this name, with a usable type."""
    if key not in df.columns:
        raise DataQualityError(f"partition_column {key!r} is not in the query result {df.columns}")
    key_type = df.schema[key].dataType
    usable = isinstance(key_type, T.StringType) or (
        partition_type == "day" and isinstance(key_type, T.DateType)
    )
    if not usable:
        shape = "YYYY-MM-DD text or a date" if partition_type == "day" else "YYYY-MM text"
        raise DataQualityError(
            f"partition_column {key!r} must be {shape}, got {key_type.simpleString()}"
        )


@dataclass(frozen=True)
class Unexpected:
    """The keys that a write has put together, as they were: the least, the greatest, and rows without one."""

    lowest: str | None
    highest: str | None
    null_rows: int


def check_partitions(
    source: DataFrame, key: str, spine: DataFrame, target: DataFrame | None, put_together: Unexpected | None = None
) -> CheckedSource:
    """Count in one Spark job, run the guards over the counts, and return the checked source.

    What is collected is one row per expected partition and one that sums up everything
    unexpected, however many distinct bad keys there are. Rows written to files have
    their bad keys put together as NULL there; ``put_together`` says what they were.
    """
    folded = fold_unexpected(partition_ledger(spine, source, key, target))
    with source_errors("the query could not be executed"):
        settled = source.sparkSession.createDataFrame(folded.collect(), folded.schema)

    expected = sorted(settled.where("is_expected").collect(), key=lambda r: r.partition_value)
    first, last = expected[0].partition_value, expected[-1].partition_value
    counts = settled.select("partition_value", F.col("rows_read").alias("row_count"))
    if summary_of(counts).first().row_count == 0:
        raise DataQualityError(f"the query returned no rows for {first} to {last}")
    for bad in out_of_range_partitions(settled).collect():
        seen = put_together or settled.where("NOT is_expected").first()
        raise DataQualityError(
            f"{bad.row_count} rows have a {key} that is no partition from {first} to {last}: "
            f"lowest {seen.lowest!r}, highest {seen.highest!r}, {seen.null_rows} rows NULL"
        )
    gaps = sorted(r.partition_value for r in gap_partitions(settled).collect())
    if gaps:
        raise DataQualityError(
            f"the query has no rows for {key} {', '.join(gaps)}, which the target holds: "
            "loading would leave a data gap"
        )
    missing = sorted(r.partition_value for r in missing_partitions(settled).collect())
    if missing:
        log.warning("no source rows for %s %s; the target has none either", key, ", ".join(missing))
    return CheckedSource(
        source, key, tuple(PartitionCount(r.partition_value, r.rows_read, r.rows_before) for r in expected)
    )
