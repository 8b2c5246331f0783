"""One query per operator. Each takes a session and the folder of the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tablekeel
from tablekeel import LoadSpec, plan_load, run_load
from tablekeel.operators import quality
from tablekeel.operators.spine import expected_partitions, plan_loads, single_request
from tablekeel.sources.extract import extract
from tablekeel.sources.target import target_partitions
from workload.scratch import fresh_database

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ALL_DAYS = "2024-01-01,2024-01-30"
ALL_MONTHS = "1995-01,2001-08"

# The day list is an exact filter; the two comparisons repeat it in a form that reaches
# the parquet scan, where it skips row groups.
ON_TARGET_DAYS = """CAST(e.ts AS DATE) IN ({target_date_list})
    AND e.ts >= array_min(array({target_date_list}))
    AND e.ts < date_add(array_max(array({target_date_list})), 1)"""
IN_TARGET_MONTHS = """CAST(o.o_orderdate AS DATE) IN ({target_date_list})
    AND o.o_orderdate >= array_min(array({target_date_list}))
    AND o.o_orderdate < date_add(array_max(array({target_date_list})), 1)"""


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_events(
    sf_dir: str, schema: str = "scratch", columns: str = "e.event_id, e.value", where: str = "", hint: str = ""
) -> LoadSpec:
    """Events by day, with the given columns and an optional further condition."""
    condition = ON_TARGET_DAYS + (f"\n    AND ({where})" if where else "")
    return LoadSpec(
        table="events_daily",
        schema=schema,
        partition_type="day",
        processing_strategy="single_day",
        partition_column="event_day",
        partition_query=f"""
            SELECT {hint} {columns}, CAST(CAST(e.ts AS DATE) AS STRING) AS event_day
            FROM parquet.`{sf_dir}/events.parquet` e
            WHERE {condition}""",
    )


def monthly_orders(sf_dir: str, schema: str = "scratch", where: str = "") -> LoadSpec:
    """Orders by month, with an optional further condition."""
    condition = IN_TARGET_MONTHS + (f"\n    AND ({where})" if where else "")
    return LoadSpec(
        table="orders_monthly",
        schema=schema,
        partition_type="month",
        processing_strategy="single_month",
        partition_column="order_month",
        partition_query=f"""
            SELECT o.o_orderkey, o.o_totalprice, date_format(o.o_orderdate, 'yyyy-MM') AS order_month
            FROM parquet.`{sf_dir}/orders.parquet` o
            WHERE {condition}""",
    )


def products(sf_dir: str, schema: str = "scratch", where: str = "true") -> LoadSpec:
    """The product dimension, loaded whole."""
    return LoadSpec(
        table="dim_product",
        schema=schema,
        partition_type="full",
        processing_strategy="full",
        partition_query=f"""
            SELECT p.p_partkey AS product_code, p.p_name AS product_name, p.p_brand AS product_brand
            FROM parquet.`{sf_dir}/part.parquet` p
            WHERE {where}""",
    )


def planned_source(spark: SparkSession, spec: LoadSpec, target_date: str) -> DataFrame:
    return extract(spark, plan_load(spark, spec, target_date).query)


def day_range(spark: SparkSession, target_date: str) -> DataFrame:
    """The spine of one day request."""
    windows = plan_loads(single_request(spark, "day", "single_day", target_date, None))
    return expected_partitions(windows.select("start_date", "end_date"), "day")


# --- Reading the source ---


@query
def extract_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = daily_events(sf_dir, columns="e.event_id, e.event_type, e.value")
    return planned_source(spark, spec, "2024-01-02,2024-01-29")


@query
def extract_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planned_source(spark, monthly_orders(sf_dir), "1995-02,2001-07")


@query
def projection_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(
        spark,
        f"""
        SELECT p.p_partkey AS product_code,
               p.p_name AS product_name,
               CAST(p.p_size AS STRING) AS size_text,
               CASE WHEN p.p_retailprice >= 1000 THEN 'premium' ELSE 'standard' END AS price_band
        FROM parquet.`{sf_dir}/part.parquet` p""",
    )


@query
def compound_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = daily_events(
        sf_dir,
        columns="e.event_id, nullif(e.event_type, 'error') AS event_type, e.value",
        where="e.value >= 20 OR nullif(e.event_type, 'error') IS NULL",
    )
    return planned_source(spark, spec, "2024-01-02,2024-01-29").drop("event_day")


# --- Dates ---


@query
def day_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day between each user's first and last event."""
    day = F.col("ts").cast("date")
    active = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))
    )
    return expected_partitions(active, "day")


@query
def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month between each customer's first and last order."""
    day = F.col("o_orderdate").cast("date")
    active = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))
    )
    return expected_partitions(active, "month")


@query
def strategy_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every strategy would refresh, had it run on each of the order dates."""
    strategies = F.array(
        *[
            F.struct(F.lit(kind).alias("partition_type"), F.lit(name).alias("processing_strategy"))
            for kind, name in (
                ("day", "single_day"),
                ("day", "last_and_current_month"),
                ("month", "single_month"),
            )
        ]
    )
    runs = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_orderdate").cast("date").alias("run_date"))
        .distinct()
        .select("run_date", F.inline(strategies))
        .withColumn("target_date", F.lit(None).cast("string"))
    )
    return plan_loads(runs).select(
        "run_date", F.col("processing_strategy").alias("strategy"), "start_date", "end_date"
    )


def load_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date request per order: well-formed and malformed ones, by priority and status."""
    day = F.col("o_orderdate").cast("date")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    text, month = day.cast("string"), F.date_format(day, "yyyy-MM")
    target_date = (
        F.when(priority == "1-URGENT", text)
        .when(priority == "2-HIGH", F.concat(text, F.lit(" , "), F.date_add(day, 9).cast("string")))
        .when(priority == "3-MEDIUM", F.concat(text, F.lit(","), F.date_sub(day, 1).cast("string")))
        .when((priority == "4-NOT SPECIFIED") & (status == "F"), month)
        .when(
            priority == "4-NOT SPECIFIED",
            F.concat(month, F.lit(","), F.date_format(F.add_months(day, 2), "yyyy-MM")),
        )
        .when(status == "F", F.concat(F.date_format(day, "yyyy"), F.lit("-02-30")))
        .when(status == "O", F.concat(F.lit(" "), text))
        .otherwise(F.concat_ws(",", text, text, text))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.when(priority == "4-NOT SPECIFIED", "month").otherwise("day").alias("partition_type"),
        F.when(priority == "4-NOT SPECIFIED", "single_month")
        .when(status == "F", "single_day")
        .otherwise("last_and_current_month")
        .alias("processing_strategy"),
        target_date.alias("target_date"),
        day.alias("run_date"),
        status.alias("status"),
    )


@query
def parse_target_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_loads(load_requests(spark, sf_dir)).select(
        "request_id",
        "partition_type",
        "target_date",
        "start_date",
        "end_date",
        F.col("error").isNull().alias("is_valid"),
    )


@query
def choose_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given request wins over the strategy; where it is absent or empty the strategy applies."""
    month = F.col("partition_type") == "month"
    day = F.col("run_date").cast("string")
    week = F.concat(day, F.lit(","), F.date_add("run_date", 6).cast("string"))
    given = (
        F.when((F.col("status") == "F") & month, F.date_format("run_date", "yyyy-MM"))
        .when((F.col("status") == "F") & (F.col("request_id") % 2 == 0), week)
        .when(F.col("status") == "F", day)
        .when(F.col("status") == "O", F.lit(""))
        .cast("string")
    )
    requests = load_requests(spark, sf_dir).withColumn("target_date", given)
    return plan_loads(requests).select(
        "request_id", "processing_strategy", "run_date", "target_date", "start_date", "end_date"
    )


# --- Counts and checks ---


def event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_type", F.col("ts").cast("date").cast("string").alias("event_day")
    )


@query
def partition_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality.partition_counts(event_keys(spark, sf_dir), "event_day")
    return counts.withColumnRenamed("partition_value", "event_day").orderBy("event_day")


@query
def total_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.total_rows(table(spark, sf_dir, "lineitem"))


@query
def partition_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM").alias("ship_month")
    )
    return quality.partition_bounds(shipped, "ship_month")


@query
def distinct_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = monthly_orders(sf_dir, fresh_database(spark, "distinct"))
    run_load(spark, spec, ALL_MONTHS)
    months = plan_load(spark, spec, "1995-06,2000-12").partitions
    present = target_partitions(spark, spec.target, "order_month", months)
    return quality.distinct_partitions(present, "order_month").withColumnRenamed(
        "partition_value", "order_month"
    )


@query
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("event_type") != "error", F.col("event_day"))
    return quality.key_summary(event_keys(spark, sf_dir).select(key.alias("event_day")), "event_day")


@query
def out_of_range_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = day_range(spark, "2024-01-05,2024-01-25")
    ledger = quality.partition_ledger(spine, event_keys(spark, sf_dir), "event_day")
    return quality.out_of_range_partitions(ledger)


@query
def missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spine = day_range(spark, "2023-12-25,2024-02-03")
    ledger = quality.partition_ledger(spine, event_keys(spark, sf_dir), "event_day")
    return quality.missing_partitions(ledger).select("partition_value")


@query
def gap_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that has stopped delivering weekends, against a target that holds them."""
    spec = daily_events(sf_dir, fresh_database(spark, "gap"))
    run_load(spark, spec, ALL_DAYS)
    plan = plan_load(spark, spec, "2024-01-01,2024-01-31")
    weekdays = table(spark, sf_dir, "events").where(~F.dayofweek("ts").isin(1, 7))
    source = weekdays.select(F.col("ts").cast("date").cast("string").alias("event_day"))
    target = target_partitions(spark, spec.target, "event_day", plan.partitions)
    spine = day_range(spark, "2024-01-01,2024-01-31")
    return quality.gap_partitions(quality.partition_ledger(spine, source, "event_day", target))


@query
def reconcile_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = daily_events(sf_dir, fresh_database(spark, "reconcile"))
    run_load(spark, spec, ALL_DAYS)
    return quality.reconcile_partitions(
        event_keys(spark, sf_dir), "event_day", spark.table(spec.target), "event_day"
    )


@query
def reconcile_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that has since changed the values of one day and lost rows of another."""
    spec = daily_events(sf_dir, fresh_database(spark, "contents"))
    run_load(spark, spec, ALL_DAYS)
    source = spark.sql(plan_load(spark, spec, ALL_DAYS).query)
    day, kept = F.col("event_day"), spark.table(spec.target).columns
    lost = (day == "2024-01-20") & (F.col("event_id") % 7 == 0)
    source = source.withColumn("value", F.when(day == "2024-01-12", F.col("value") * 2).otherwise(F.col("value")))
    return quality.reconcile_contents(source.where(~lost), "event_day", spark.table(spec.target), "event_day", kept)


# --- Publishing ---


@query
def replace_day_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fresh_database(spark, "replace_day")
    run_load(spark, daily_events(sf_dir, schema), ALL_DAYS)
    doubled = daily_events(sf_dir, schema, columns="e.event_id, e.value * 2 AS value")
    run_load(spark, doubled, "2024-01-10,2024-01-12")
    return spark.table(doubled.target)


@query
def replace_clustered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days replaced in a table without partitions, twice, the second time with a new column."""
    schema = fresh_database(spark, "clustered")
    run_load(spark, replace(daily_events(sf_dir, schema), layout="clustered"), ALL_DAYS)
    for columns, days in (
        ("e.event_id, e.value * 2 AS value", "2024-01-10,2024-01-12"),
        ("e.event_id, e.value * 3 AS value, e.event_type", "2024-01-12,2024-01-13"),
    ):
        spec = replace(daily_events(sf_dir, schema, columns=columns), layout="clustered")
        run_load(spark, spec, days)
    return spark.table(spec.target)


@query
def replace_month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fresh_database(spark, "replace_month")
    run_load(spark, monthly_orders(sf_dir, schema), ALL_MONTHS)
    finished = monthly_orders(sf_dir, schema, where="o.o_orderstatus = 'F'")
    run_load(spark, finished, "1996-02,1996-03")
    return spark.table(finished.target)


@query
def replace_staged_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregating query, evaluated once: order totals by month, reloaded for one year."""
    totals = LoadSpec(
        table="customer_months",
        schema=fresh_database(spark, "staged"),
        partition_type="month",
        processing_strategy="single_month",
        partition_column="order_month",
        partition_query=f"""
            SELECT c.c_nationkey, count(*) AS orders, date_format(o.o_orderdate, 'yyyy-MM') AS order_month
            FROM parquet.`{sf_dir}/orders.parquet` o
            JOIN parquet.`{sf_dir}/customer.parquet` c ON c.c_custkey = o.o_custkey
            WHERE {IN_TARGET_MONTHS}
            GROUP BY c.c_nationkey, date_format(o.o_orderdate, 'yyyy-MM')""",
    )
    run_load(spark, totals, ALL_MONTHS)
    run_load(spark, totals, "1996-01,1996-12")
    return spark.table(totals.target)


@query
def replace_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fresh_database(spark, "replace_full")
    run_load(spark, products(sf_dir, schema))
    large = products(sf_dir, schema, where="p.p_size > 25")
    run_load(spark, large)
    return spark.table(large.target)


@query
def evolve_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fresh_database(spark, "evolve")
    run_load(spark, daily_events(sf_dir, schema), ALL_DAYS)
    wider = daily_events(sf_dir, schema, columns="e.event_id, e.value, e.event_type")
    run_load(spark, wider, "2024-01-15")
    return spark.table(wider.target)


@query
def evolve_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct that gains a field, and a narrower number, from one reload on."""
    schema = fresh_database(spark, "nested")
    seed = "e.event_id, named_struct('kind', e.event_type) AS detail, 1L AS version"
    run_load(spark, daily_events(sf_dir, schema, columns=seed), ALL_DAYS)
    wider = "e.event_id, named_struct('worth', e.value, 'kind', e.event_type) AS detail, 2 AS version"
    spec = daily_events(sf_dir, schema, columns=wider)
    run_load(spark, spec, "2024-01-15,2024-01-17")
    return spark.table(spec.target).select("event_id", "detail.kind", "detail.worth", "version", "event_day")


@query
def publish_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = LoadSpec(
        table="events_by_type",
        schema=fresh_database(spark, "view"),
        partition_type="full",
        processing_strategy="view",
        partition_query=f"""
            SELECT e.event_type, count(*) AS row_count
            FROM parquet.`{sf_dir}/events.parquet` e
            GROUP BY e.event_type""",
    )
    run_load(spark, spec)
    return spark.table(spec.target)


@query
def create_on_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = daily_events(sf_dir, fresh_database(spark, "create"))
    run_load(spark, spec, ALL_DAYS)
    return spark.table(spec.target)


@query
def preview_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = daily_events(sf_dir, fresh_database(spark, "dry_run"))
    report = run_load(spark, spec, ALL_DAYS, dry_run=True)
    if spark.catalog.tableExists(spec.target):
        raise AssertionError("a dry run must not create its target")
    spark.sql(f"DROP DATABASE {spec.schema} CASCADE")
    return report.select("partition_value", F.col("rows_read").alias("would_write"))


@query
def compact_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded as eight files a day, then compacted."""
    schema = fresh_database(spark, "compact")
    scattered = daily_events(sf_dir, schema, hint="/*+ REPARTITION(8) */")
    run_load(spark, scattered, ALL_DAYS, rebalance=False)
    days = plan_load(spark, scattered, ALL_DAYS).partitions
    tablekeel.compact_partitions(spark, scattered.target, "event_day", days)
    return spark.table(scattered.target)


@query
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late purchases: the target was first loaded without them, and up to the 29th only."""
    schema = fresh_database(spark, "report")
    early = daily_events(sf_dir, schema, where="e.event_type <> 'purchase'")
    run_load(spark, early, "2024-01-01,2024-01-29")
    report = run_load(spark, daily_events(sf_dir, schema), "2024-01-01,2024-02-02")
    spark.sql(f"DROP DATABASE {schema} CASCADE")
    return report


@query
def reload_changed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reload of all days, of which one has new values and another lost rows since: only these are switched."""
    schema = fresh_database(spark, "changed")
    run_load(spark, daily_events(sf_dir, schema), ALL_DAYS)
    doubled = "e.value * CASE WHEN CAST(e.ts AS DATE) = DATE '2024-01-12' THEN 2 ELSE 1 END AS value"
    kept = "CAST(e.ts AS DATE) <> DATE '2024-01-20' OR e.event_id % 7 <> 0"
    changed = daily_events(sf_dir, schema, columns=f"e.event_id, {doubled}", where=kept)
    report = run_load(spark, changed, ALL_DAYS, skip_unchanged=True)
    spark.sql(f"DROP DATABASE {schema} CASCADE")
    return report
