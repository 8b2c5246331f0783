"""Checked, partition-wise loads of catalog tables from Spark SQL queries."""

from tablekeel.errors import ConflictError, DataQualityError, SourceError, SpecError, VerificationError
from tablekeel.plans.load import plan_load, preview_rows, run_load
from tablekeel.sinks.tables import compact_partitions
from tablekeel.spec import LoadSpec

__all__ = [
    "ConflictError",
    "DataQualityError",
    "LoadSpec",
    "SourceError",
    "SpecError",
    "VerificationError",
    "compact_partitions",
    "plan_load",
    "preview_rows",
    "run_load",
]
