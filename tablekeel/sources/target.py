"""The present state of a target: does it exist, what is it, which rows does it hold."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeel.errors import SpecError
from tablekeel.spec import LoadSpec, quoted

# Built-in file formats whose dynamic partition overwrite is understood.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")
# Formats whose files hold column names and types, so that any folder can be switched in.
SELF_DESCRIBING = ("parquet", "orc")


@dataclass(frozen=True)
class TargetState:
    """Catalog facts about an existing target. No data is read to learn them."""

    name: str
    is_view: bool
    provider: str
    storage_properties: str
    partition_columns: tuple[str, ...]
    schema: T.StructType
    location: str = ""
    lists_partitions: bool = False

    @property
    def options(self) -> dict[str, str]:
        """How files of the table are written, such as the separator of a text format."""
        pairs = (p.partition("=") for p in self.storage_properties.strip("[]").split(", "))
        ours = ("partitionoverwritemode", "path", "serialization.format")
        return {k: v for k, _, v in pairs if k and k.lower() not in ours}

    @property
    def replaces_only_written_partitions(self) -> bool:
        return "partitionOverwriteMode=dynamic" in self.storage_properties


def target_state(spark: SparkSession, name: str) -> TargetState | None:
    """The target's catalog entry, or None when there is none yet."""
    if not spark.catalog.tableExists(name):
        return None
    described = [(r.col_name, r.data_type) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    details = dict(_section(described, "# Detailed Table Information"))
    is_view = details.get("Type") == "VIEW"
    partitioning = _section(described, "# Partition Information")
    return TargetState(
        name=name,
        is_view=is_view,
        provider=details.get("Provider", "").lower(),
        storage_properties=details.get("Storage Properties", ""),
        partition_columns=tuple(column for column, _ in partitioning if column != "# col_name"),
        # A view is replaced whatever its columns, even one that no longer resolves.
        schema=T.StructType() if is_view else spark.table(name).schema,
        location=details.get("Location", ""),
        lists_partitions=details.get("Partition Provider", "") == "Catalog",
    )


def _section(described: list[tuple[str, str]], heading: str) -> list[tuple[str, str]]:
    """The rows of a table description below a heading, up to the next blank row."""
    below = [i for i, (label, text) in enumerate(described) if label == heading and not text]
    if not below:
        return []
    rest = described[below[-1] + 1 :]
    blank = [i for i, (label, _) in enumerate(rest) if not label]
    return rest[: blank[0]] if blank else rest


def partition_literal(key: str, key_type: T.DataType, value: str) -> str:
    """The partition as SQL names it: ``PARTITION (key = value)``."""
    text = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"PARTITION ({quoted(key)} = {'DATE ' if isinstance(key_type, T.DateType) else ''}{text})"


def session_table(spark: SparkSession, name: str):
    """The session's own catalog and the table's identifier there, for what no SQL statement does in one go."""
    session, option = spark._jsparkSession.sessionState(), spark._jvm.scala.Option
    parts = session.sqlParser().parseMultipartIdentifier(name)
    *above, table = [parts.apply(i) for i in range(parts.length())]
    names = [option.apply(part) for part in reversed(above)]
    return session.catalog(), spark._jvm.org.apache.spark.sql.catalyst.TableIdentifier(table, *names)


def partition_locations(spark: SparkSession, name: str, key: str, values: Sequence[str]) -> dict[str, str]:
    """The folder of each listed partition that the catalog knows, from one listing of the catalog."""
    wanted = set(values)
    catalog, table = session_table(spark, name)
    listed = catalog.listPartitions(table, spark._jvm.scala.Option.empty()).mkString("\n")
    found = re.findall(r"^\s*Partition Values: \[[^=\n]*=(.*)\]\n\s*Location: (.*)$", listed, re.MULTILINE)
    return {value: location for value, location in found if value in wanted}


def check_target_kind(spec: LoadSpec, state: TargetState | None) -> None:
    """Refuse a target that is not the kind of object the spec describes.

    Spark itself would turn a view into a table without a word, and would replace
    the whole of a table that is partitioned by something else.
    """
    if state is None:
        return
    if spec.is_view != state.is_view:
        kinds = {True: "a view", False: "a table"}
        raise SpecError(
            f"target {state.name} is {kinds[state.is_view]}, the spec describes {kinds[spec.is_view]}"
        )
    if spec.is_view:
        return
    if state.provider not in FILE_FORMATS:
        raise SpecError(f"target {state.name} has format {state.provider!r}; known are {', '.join(FILE_FORMATS)}")
    if spec.is_clustered and (state.provider not in SELF_DESCRIBING or spec.partition_column not in state.schema.names):
        raise SpecError(
            f"target {state.name} cannot be clustered: it needs a column {spec.partition_column} and to be "
            f"{' or '.join(SELF_DESCRIBING)}, and is {state.provider}"
        )
    wanted = (spec.partition_column,) if spec.is_partitioned and not spec.is_clustered else ()
    if state.partition_columns != wanted:
        raise SpecError(
            f"target {state.name} is partitioned by {list(state.partition_columns)}, the spec by {list(wanted)}"
        )


def key_in(key: str, key_type: T.DataType, values: Sequence[str]) -> Column:
    """``key IN (values)`` with literals of the key's own type, so that it prunes partitions."""
    texts = ["'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values]
    if isinstance(key_type, T.DateType):
        texts = [f"DATE {text}" for text in texts]
    return F.expr(f"{quoted(key)} IN ({', '.join(texts)})")


def target_partitions(spark: SparkSession, name: str, key: str, values: Sequence[str]) -> DataFrame:
    """The listed partitions of the target; the catalog prunes all others."""
    table = spark.table(name)
    return table.where(key_in(key, table.schema[key].dataType, values))

