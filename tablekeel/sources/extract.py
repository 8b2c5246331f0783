"""The source side of a load: fill in the date list and let Spark analyse the query."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from tablekeel.errors import SourceError
from tablekeel.spec import DATE_LIST_PLACEHOLDER


def fill_date_list(query: str, days: Iterable[str]) -> str:
    """Put the days, quoted and comma-separated, wherever the placeholder stands.

    The list is always one of days. A month load filters its source by days too and
    emits a ``YYYY-MM`` key.
    """
    return query.replace(DATE_LIST_PLACEHOLDER, ", ".join(f"'{day}'" for day in days))


def extract(spark: SparkSession, query: str) -> DataFrame:
    """The source rows as a lazy DataFrame."""
    with source_errors("the query could not be analysed"):
        return spark.sql(query)


@contextmanager
def source_errors(what: str) -> Iterator[None]:
    """Re-raise Spark's errors as :class:`SourceError`, with the cause attached."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as cause:
        raise SourceError(f"partition_query failed: {what}: {cause}") from cause
