"""Publishing a query as a view."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tablekeel.sources.extract import source_errors
from tablekeel.spec import LoadSpec


def publish_view(spark: SparkSession, spec: LoadSpec) -> None:
    """Create the view, or point an existing one at the query."""
    with source_errors("the view could not be created"):
        spark.sql(f"CREATE OR REPLACE VIEW {spec.target} AS {spec.partition_query}")
