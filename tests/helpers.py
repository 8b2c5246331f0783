"""Small sources and targets for the tests."""

import uuid

from tablekeel import LoadSpec

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]


def database(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def source(spark, rows, schema="id int, v double, d string"):
    """A temporary view over the given rows; its name can be used in a partition_query."""
    name = f"src_{uuid.uuid4().hex[:10]}"
    spark.createDataFrame(rows, schema).coalesce(1).createOrReplaceTempView(name)
    return name


def days_of(rows_per_day, days=DAYS):
    return [(i * 100 + j, float(j), day) for i, day in enumerate(days) for j in range(rows_per_day)]


def day_spec(schema, view, query=None, **changes):
    fields = dict(
        table="t",
        schema=schema,
        partition_type="day",
        processing_strategy="single_day",
        partition_column="d",
        partition_query=query or f"SELECT * FROM {view} WHERE d IN ({{target_date_list}})",
    )
    return LoadSpec(**{**fields, **changes})


def month_spec(schema, query, **changes):
    return day_spec(
        schema, None, query, partition_type="month", processing_strategy="single_month",
        partition_column="m", **changes,
    )


def full_spec(schema, query, strategy="full", **changes):
    fields = dict(
        table="t", schema=schema, partition_type="full", processing_strategy=strategy, partition_query=query
    )
    return LoadSpec(**{**fields, **changes})


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def report_of(df):
    return [tuple(r) for r in df.orderBy("partition_value").collect()]


def tables_of(spark, schema):
    """Names of the tables and views in a schema, leaving out temporary views."""
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)
