"""Where the workload's own tables go."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_database(spark: SparkSession, purpose: str) -> str:
    """A new, empty database with a folder of its own.

    Its folder is in the shared one the cluster names in ``spark.checkpoint.dir``, or
    in the session's warehouse. Only a local session without either writes to a
    temporary folder, which is removed when Python exits.
    """
    name = f"tk_{purpose}_{uuid.uuid4().hex[:10]}"
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tablekeel-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    location = f" LOCATION '{folder.rstrip('/')}/{name}'" if folder else ""
    spark.sql(f"CREATE DATABASE {name}{location}")
    return name
