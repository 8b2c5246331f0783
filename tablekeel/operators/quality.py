"""Row counts per partition, and the comparisons the guards are made of.

Only the key column is ever read here, but for comparisons of contents. All results are DataFrames with at most one
row per distinct key, and every aggregation combines within the map tasks before
its shuffle, so one key that holds most of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeel.spec import quoted

#: A sum of 64-bit hashes, of more rows than there can be.
CONTENT = T.DecimalType(38, 0)
#: Types whose values the hash functions do not take, or take without telling where a NULL is.
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def partition_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per partition. Order the result by ``partition_value`` where it is shown."""
    column = F.col(quoted(key))
    return (
        df.groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .select(column.cast("string").alias("partition_value"), "row_count")
    )


def total_rows(df: DataFrame) -> DataFrame:
    """One row: the number of rows."""
    return df.agg(F.count("*").alias("row_count"))


def distinct_partitions(df: DataFrame, key: str) -> DataFrame:
    """The partition values present."""
    return df.select(F.col(quoted(key)).cast("string").alias("partition_value")).distinct()


def partition_bounds(df: DataFrame, key: str) -> DataFrame:
    """One row: first and last partition value as text, and the sum of all counts."""
    return bounds_of(partition_counts(df, key))


def bounds_of(counts: DataFrame) -> DataFrame:
    """The same, over rows per partition that are counted already."""
    return counts.agg(
        F.min("partition_value").alias("min_partition"),
        F.max("partition_value").alias("max_partition"),
        F.sum("row_count").alias("row_count"),
    )


def key_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct partition values and rows whose key is NULL.

    Counted over the per-key counts, so that no distinct aggregate is shuffled.
    """
    return summary_of(partition_counts(df, key))


def summary_of(counts: DataFrame) -> DataFrame:
    """The same, over rows per partition that are counted already."""
    null_rows = F.sum(F.when(F.col("partition_value").isNull(), F.col("row_count")))
    return counts.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.count("partition_value").alias("partition_count"),
        F.coalesce(null_rows, F.lit(0)).alias("null_key_rows"),
    )


def partition_ledger(
    spine: DataFrame, source: DataFrame, key: str, target: DataFrame | None = None
) -> DataFrame:
    """Everything the guards compare: one row per partition value seen anywhere.

    ``partition_value, is_expected, rows_read, rows_before``. Source and target are
    counted per key, each in one fused scan-and-count stage; the counts and the spine
    are then stacked and summed up. That answers what three joins against the spine
    would, with a single pass over the source and nothing broadcast; NULL keys form a
    row too.
    """
    none = F.lit(0).cast("bigint")
    sides = [
        _entry(spine, F.lit(True), none, none),
        _entry(partition_counts(source, key), F.lit(False), F.col("row_count"), none),
    ]
    if target is not None:
        sides.append(_entry(partition_counts(target, key), F.lit(False), none, F.col("row_count")))
    return (
        reduce(DataFrame.unionByName, sides)
        .groupBy("partition_value")
        .agg(
            F.max("is_expected").alias("is_expected"),
            F.sum("rows_read").alias("rows_read"),
            F.sum("rows_before").alias("rows_before"),
        )
    )


def _entry(df: DataFrame, is_expected: Column, rows_read: Column, rows_before: Column) -> DataFrame:
    return df.select(
        "partition_value",
        is_expected.alias("is_expected"),
        rows_read.alias("rows_read"),
        rows_before.alias("rows_before"),
    )


def fold_unexpected(ledger: DataFrame) -> DataFrame:
    """The ledger with all that is not expected in one row, however many keys that is.

    That row has no partition value; lowest, highest and null_rows tell which keys it had.
    """
    value = F.col("partition_value")
    is_bad = ~F.col("is_expected") & (F.col("rows_read") > 0)
    expected = F.when(F.col("is_expected"), value)
    return (
        ledger.groupBy(expected.alias("expected_value"), "is_expected")
        .agg(
            F.sum("rows_read").alias("rows_read"),
            F.sum("rows_before").alias("rows_before"),
            F.min(F.when(is_bad, value)).alias("lowest"),
            F.max(F.when(is_bad, value)).alias("highest"),
            F.coalesce(F.sum(F.when(is_bad & value.isNull(), F.col("rows_read"))), F.lit(0)).alias("null_rows"),
        )
        .withColumnRenamed("expected_value", "partition_value")
    )


def out_of_range_partitions(ledger: DataFrame) -> DataFrame:
    """Source keys that are no expected partition: outside the range, malformed or NULL."""
    return ledger.where(~F.col("is_expected") & (F.col("rows_read") > 0)).select(
        "partition_value", F.col("rows_read").alias("row_count")
    )


def missing_partitions(ledger: DataFrame) -> DataFrame:
    """Expected partitions without source rows, with the target rows they would leave stale."""
    return ledger.where(F.col("is_expected") & (F.col("rows_read") == 0)).select(
        "partition_value", "rows_before"
    )


def gap_partitions(ledger: DataFrame) -> DataFrame:
    """Missing partitions that do hold target rows: loading would open a gap."""
    return missing_partitions(ledger).where("rows_before > 0").select(
        "partition_value", F.col("rows_before").alias("rows_at_risk")
    )


def reconcile_partitions(
    source: DataFrame, source_key: str, target: DataFrame, target_key: str
) -> DataFrame:
    """Source and target row counts side by side, for every partition either of them has.

    As in :func:`partition_ledger`, stacked counts stand in for a full outer join.
    """
    none = F.lit(0).cast("bigint")
    read = partition_counts(source, source_key).select(
        "partition_value", F.col("row_count").alias("source_rows"), none.alias("target_rows")
    )
    held = partition_counts(target, target_key).select(
        "partition_value", none.alias("source_rows"), F.col("row_count").alias("target_rows")
    )
    return (
        read.unionByName(held)
        .groupBy("partition_value")
        .agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))
        .withColumn("is_match", F.col("source_rows") == F.col("target_rows"))
    )


def row_hash(schema: T.StructType, columns: Sequence[str]) -> Column:
    """A hash of the row's columns, by which equal rows are equal; which of them are NULL counts too.

    Nested values are hashed by their JSON text, and maps in the order they are stored in.
    """
    values, nulls = [], []
    for name in columns:
        kind, column = schema[name].dataType, F.col(quoted(name))
        values.append(F.to_json(F.struct(column)) if isinstance(kind, NESTED) else column)
        nulls.append(column.isNull())
    marks = [F.concat(*[F.when(n, "1").otherwise("0") for n in nulls[i : i + 64]]) for i in range(0, len(nulls), 64)]
    return F.xxhash64(*values, *marks).cast(CONTENT)


def partition_contents(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per partition and their content: the sum of the hashes of all rows, whatever their order.

    ``partition_value, row_count, content``. columns: those that are compared, by default all.
    """
    column = F.col(quoted(key))
    summed = F.sum(row_hash(df.schema, columns or df.columns)).alias("content")
    counts = df.groupBy(column).agg(F.count("*").alias("row_count"), summed)
    return counts.select(column.cast("string").alias("partition_value"), "row_count", "content")


def reconcile_contents(
    source: DataFrame, source_key: str, target: DataFrame, target_key: str, columns: Sequence[str]
) -> DataFrame:
    """As :func:`reconcile_partitions`, and whether the rows are the same in the columns that are compared.

    ``partition_value, source_rows, target_rows, same_rows, same_content``. Either side is
    read once, and stacked sums stand in for a full outer join.
    """
    none = F.lit(0)
    read = partition_contents(source, source_key, columns).select(
        "partition_value", F.col("row_count").alias("source_rows"), none.alias("target_rows"), "content"
    )
    held = partition_contents(target, target_key, columns).select(
        "partition_value", none.alias("source_rows"), F.col("row_count").alias("target_rows"), (-F.col("content")).alias("content")
    )
    both = read.unionByName(held).groupBy("partition_value")
    sums = both.agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"), F.sum("content").alias("apart"))
    same = F.col("source_rows") == F.col("target_rows")
    return sums.select("partition_value", "source_rows", "target_rows", same.alias("same_rows"), (same & (F.col("apart") == 0)).alias("same_content"))
