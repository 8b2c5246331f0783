"""Spines: one row per partition that a window covers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeel.functions.dates import (
    is_given,
    parse_period,
    period_end,
    request_error,
    request_part,
    request_parts,
    strategy_end,
    strategy_error,
    strategy_start,
    window_partitions,
)


def plan_loads(requests: DataFrame) -> DataFrame:
    """Add ``start_date, end_date, error`` to rows of load requests.

    ``requests`` has ``partition_type, processing_strategy, target_date, run_date``;
    other columns are kept. A given ``target_date`` wins over the strategy. Both dates
    are inclusive, and NULL exactly where ``error`` says why.

    Narrow whatever the number of rows. Going step by step, over columns that are
    dropped again, keeps the text from being split and parsed anew at every mention.
    """
    kind, strategy = F.col("partition_type"), F.col("processing_strategy")
    target_date, run_date = F.col("target_date"), F.col("run_date")
    parts = F.col("_parts")
    texts = (F.col("_first_text"), F.col("_last_text"))
    days = (F.col("_first_day"), F.col("_last_day"))
    steps = (
        requests.withColumn("_parts", request_parts(target_date))
        .withColumns(
            {
                "_first_text": request_part(target_date, parts, 0),
                "_last_text": request_part(target_date, parts, 1),
            }
        )
        .withColumns({"_first_day": parse_period(kind, texts[0]), "_last_day": parse_period(kind, texts[1])})
        .withColumn(
            "error",
            F.when(is_given(target_date), request_error(kind, target_date, parts, texts, days)).otherwise(
                strategy_error(kind, strategy, run_date)
            ),
        )
    )
    start = F.when(is_given(target_date), days[0]).otherwise(strategy_start(strategy, run_date))
    end = F.when(is_given(target_date), period_end(kind, days[1])).otherwise(strategy_end(run_date))
    is_valid = F.col("error").isNull()
    return steps.select(
        *requests.columns,
        F.when(is_valid, start).alias("start_date"),
        F.when(is_valid, end).alias("end_date"),
        "error",
    )


def expected_partitions(windows: DataFrame, partition_type: Column | str) -> DataFrame:
    """One row per partition value of every window (``start_date, end_date``).

    Months are stepped through directly rather than taken as the distinct months
    of all days, so no shuffle is needed.
    """
    kind = F.lit(partition_type) if isinstance(partition_type, str) else partition_type
    values = window_partitions(kind, F.col("start_date"), F.col("end_date"))
    others = [c for c in windows.columns if c not in ("start_date", "end_date")]
    return windows.select(*others, F.explode(values).alias("partition_value"))


def single_request(
    spark: SparkSession, partition_type: str, strategy: str, target_date: str | None, run_date: date
) -> DataFrame:
    """One load request as a one-row DataFrame."""
    return spark.range(0, 1, 1, 1).select(
        F.lit(partition_type).alias("partition_type"),
        F.lit(strategy).alias("processing_strategy"),
        F.lit(target_date).cast("string").alias("target_date"),
        F.lit(run_date).cast("date").alias("run_date"),
    )


def listed_partitions(spark: SparkSession, values: Sequence[str]) -> DataFrame:
    """The spine of one load whose partition values are already known."""
    texts = F.split(F.lit(",".join(values)), ",")
    return spark.range(0, 1, 1, 1).select(F.explode(texts).alias("partition_value"))
