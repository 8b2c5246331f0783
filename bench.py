"""Headline loads and queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

``queries`` holds seconds per load or query. ``straightforward`` holds the seconds of
the same loads and reloads written the obvious way, which evaluates the source query five times
(two counts before the write, the write, two counts after it) and checks nothing.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tablekeel import LoadSpec, plan_load, run_load
from workload.queries import ALL_DAYS, ALL_MONTHS, QUERIES, daily_events, monthly_orders, products
from workload.scratch import fresh_database

SHIPPED = "1995-01,2001-11"
READ_QUERIES = (
    "extract_day",
    "extract_month",
    "day_spine",
    "month_spine",
    "strategy_windows",
    "parse_target_dates",
    "choose_window",
    "partition_row_counts",
    "partition_bounds",
    "total_rows",
    "quality_summary",
    "out_of_range_partitions",
    "missing_partitions",
)


def monthly_lineitem(sf_dir: str, schema: str) -> LoadSpec:
    """The largest table by month of shipping."""
    return LoadSpec(
        table="lineitem_monthly",
        schema=schema,
        partition_type="month",
        processing_strategy="single_month",
        partition_column="ship_month",
        partition_query=f"""
            SELECT l.*, date_format(l.l_shipdate, 'yyyy-MM') AS ship_month
            FROM parquet.`{sf_dir}/lineitem.parquet` l
            WHERE CAST(l.l_shipdate AS DATE) IN ({{target_date_list}})
              AND l.l_shipdate >= array_min(array({{target_date_list}}))
              AND l.l_shipdate < date_add(array_max(array({{target_date_list}})), 1)""",
    )


def revenue_by_month(sf_dir: str, schema: str) -> LoadSpec:
    """A metrics table: a join and an aggregation that return far less than they read."""
    return LoadSpec(
        table="revenue_monthly",
        schema=schema,
        partition_type="month",
        processing_strategy="single_month",
        partition_column="order_month",
        partition_query=f"""
            SELECT o.o_orderpriority,
                   sum(l.l_extendedprice * (1 - l.l_discount)) AS revenue,
                   count(*) AS line_count,
                   date_format(o.o_orderdate, 'yyyy-MM') AS order_month
            FROM parquet.`{sf_dir}/orders.parquet` o
            JOIN parquet.`{sf_dir}/lineitem.parquet` l ON l.l_orderkey = o.o_orderkey
            WHERE CAST(o.o_orderdate AS DATE) IN ({{target_date_list}})
              AND o.o_orderdate >= array_min(array({{target_date_list}}))
              AND o.o_orderdate < date_add(array_max(array({{target_date_list}})), 1)
            GROUP BY o.o_orderpriority, date_format(o.o_orderdate, 'yyyy-MM')""",
    )


def straightforward_load(spark: SparkSession, spec: LoadSpec, target_date: str, table: str | None = None) -> None:
    """The five-pass load, for comparison, into an existing table with the right options or into a new one."""
    df = spark.sql(plan_load(spark, spec, target_date).query)

    def count() -> None:
        # A DataFrame of its own each time, or Spark would reuse the shuffle of the first.
        df.groupBy(spec.partition_column).count().orderBy(spec.partition_column).collect()

    count()
    count()
    if table:
        df.write.partitionBy(spec.partition_column).saveAsTable(table)
    else:
        df.select(spark.table(spec.target).columns).write.insertInto(spec.target, overwrite=True)
    count()
    count()


def clocked(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    with tempfile.TemporaryDirectory(prefix="tablekeel-bench-") as folder:
        builder = (
            SparkSession.builder.master(f"local[{cpus}]")
            .appName("tablekeel-bench")
            .config("spark.sql.shuffle.partitions", cpus)
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
            .config("spark.checkpoint.dir", f"{folder}/checkpoint")
            .config("spark.driver.memory", "8g")
            .config("spark.ui.enabled", "false")
            .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        )
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
        try:
            seconds, plain = measure(spark, sf_dir)
        finally:
            spark.stop()
    line = {
        "metric": "total time of headline loads and queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "straightforward": plain,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(line))


def measure(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], dict[str, float]]:
    seconds: dict[str, float] = {}
    plain: dict[str, float] = {}

    def timed(name: str, work: Callable[[], object], into: dict[str, float] = seconds, runs: int = 1) -> None:
        """Best of the runs; only what can be repeated with the same outcome has more than one."""
        into[name] = round(min(clocked(work) for _ in range(runs)), 3)

    def against_plain(name: str, spec: LoadSpec, target_date: str) -> None:
        timed(name, lambda: run_load(spark, spec, target_date), runs=2)
        timed(name, lambda: straightforward_load(spark, spec, target_date), plain, runs=2)

    schema = fresh_database(spark, "bench")
    days, months = daily_events(sf_dir, schema), monthly_orders(sf_dir, schema)
    late = LoadSpec.from_mapping({**vars(days), "processing_strategy": "last_and_current_month"})
    lines, revenue = monthly_lineitem(sf_dir, schema), revenue_by_month(sf_dir, schema)

    warm_up = fresh_database(spark, "warm_up")
    for _ in range(2):
        run_load(spark, daily_events(sf_dir, warm_up), "2024-01-01,2024-01-02")
    run_load(spark, products(sf_dir, warm_up))

    firsts = (
        ("load_30_days", days, ALL_DAYS),
        ("load_80_months", months, ALL_MONTHS),
        ("load_lineitem", lines, SHIPPED),
        ("load_metrics", revenue, ALL_MONTHS),
    )
    for name, spec, when in firsts:
        timed(name, lambda spec=spec, when=when: run_load(spark, spec, when))
        copy = f"{schema}.{spec.table}_plain"
        timed(name, lambda spec=spec, when=when, copy=copy: straightforward_load(spark, spec, when, copy), plain)
    timed("replace_full", lambda: run_load(spark, products(sf_dir, schema)), runs=2)

    against_plain("reload_3_days", days, "2024-01-10,2024-01-12")
    against_plain("reload_2_months", months, "1996-02,1996-03")
    against_plain("reload_lineitem", lines, SHIPPED)
    against_plain("reload_lineitem_year", lines, "1996-01,1996-12")
    against_plain("reload_metrics", revenue, ALL_MONTHS)
    timed("reload_late_days", lambda: run_load(spark, late, now=date(2024, 1, 31)), runs=2)
    timed("check_30_days", lambda: run_load(spark, days, ALL_DAYS, dry_run=True), runs=2)

    for name in READ_QUERIES:
        timed(name, lambda name=name: noop(QUERIES[name](spark, sf_dir)), runs=2)
    return seconds, plain


if __name__ == "__main__":
    main()
