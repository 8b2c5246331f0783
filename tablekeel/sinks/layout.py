"""How rows are spread over files, and how columns are fitted to the target."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeel.errors import SpecError
from tablekeel.operators.quality import partition_counts
from tablekeel.sources.target import TargetState, key_in, session_table, target_state
from tablekeel.spec import quoted

# Shuffle partitions per partition value: with four, few values share one and get split together.
SHUFFLE_PARTITIONS_PER_VALUE = 4


def spread_for_write(df: DataFrame, key: str | None = None, values: int = 1) -> DataFrame:
    """Give the writer a few well-filled files for each of the key's (number of) values.

    Rebalancing shuffles by the key, joins up small partitions and splits large ones
    at ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, from the sizes actually
    written. A key that holds a third of all rows becomes many tasks, not one. Up to
    ``spark.shuffle.minNumPartitionsToHighlyCompress`` shuffle partitions Spark knows the
    exact sizes it splits by, so that many are used at most; with more values than a
    quarter of that, several share a partition and are split together. A higher
    ``spark.sql.shuffle.partitions`` of the session holds all the same.

    Without adaptive execution the hint does nothing. Then rows are counted per key first,
    which evaluates the source's key column once more, and only the keys with more rows
    than fit the advisory size are salted, by as many files as they need.
    """
    spark = df.sparkSession
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        if not key:
            return df.hint("rebalance")
        exact = int(spark.sparkContext.getConf().get("spark.shuffle.minNumPartitionsToHighlyCompress", "2000"))
        wanted = min(values * SHUFFLE_PARTITIONS_PER_VALUE, exact)
        return df.hint("rebalance", max(usual, wanted), F.col(quoted(key)))
    if not key:
        return df
    return _salted(df, key)


def _salted(df: DataFrame, key: str) -> DataFrame:
    """Shuffled by the key, and rows of large keys also by the task that read them: repeatable when a task is retried."""
    per_file = rows_per_file(df)
    # As many keys as there are files' worth of rows, at most.
    large = {
        r.partition_value: -(-r.row_count // per_file)
        for r in partition_counts(df, key).where(F.col("row_count") > per_file).collect()
    }
    salt = free_name(df, "salt")
    salts = F.lit(1)
    if large:
        table = F.create_map(*[F.lit(x) for pair in large.items() if pair[0] is not None for x in pair])
        salts = F.coalesce(F.try_element_at(table, F.col(quoted(key)).cast("string")), F.lit(large.get(None, 1)))
    salted = df.withColumn(salt, F.pmod(F.spark_partition_id(), salts))
    return salted.repartition(F.col(quoted(key)), F.col(quoted(salt))).drop(salt)


def rows_per_file(df: DataFrame) -> int:
    """About how many rows make up the advisory size, taking 20 bytes for a text or nested value and 8 for others."""
    wide = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    width = sum(20 if isinstance(f.dataType, wide) else 8 for f in df.schema)
    advised = df.sparkSession.sql("SET spark.sql.adaptive.advisoryPartitionSizeInBytes").first().value
    return max(1, as_bytes(advised) // max(1, width))


def as_bytes(text: str) -> int:
    """A size setting such as ``64MB``, ``64m`` or ``67108864b`` as a number; 64 MB for what is none."""
    found = re.fullmatch(r"\s*(\d+)\s*([kmgt]?)i?b?\s*", text.lower())
    if not found:
        return 64 << 20
    return int(found[1]) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[found[2]]


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the DataFrame does not have."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def expected_keys_only(df: DataFrame, key: str, expected: Sequence[str]) -> DataFrame:
    """Keys outside the expected ones become NULL, so that rows with them share one folder, however many there are."""
    key_column = F.col(quoted(key))
    kept = F.when(key_in(key, df.schema[key].dataType, expected), key_column)
    return df.select(*[kept.alias(c) if c == key else F.col(quoted(c)) for c in df.columns])


@dataclass(frozen=True)
class Evolution:
    """What a load brings that its target lacks: new columns, and columns whose type gains nested fields."""

    added: tuple[T.StructField, ...] = ()
    changed: tuple[T.StructField, ...] = ()


def fit_to_target(df: DataFrame, state: TargetState) -> tuple[DataFrame, Evolution]:
    """Line the columns up with an existing target, and name what it lacks.

    Columns, and fields of structs wherever they are nested, are matched by name without
    regard to case. What only the target has becomes NULL, and what only the query has is
    added to the target. A value of a narrower type is stored in the target's where nothing
    is lost by it; any other change of a type is an error.
    """
    incoming = {f.name.lower(): f for f in df.schema}
    known = {f.name.lower() for f in state.schema}
    added = tuple(f for name, f in incoming.items() if name not in known)
    check_typed(list(added))
    changed: list[T.StructField] = []
    is_key = {c.lower() for c in state.partition_columns}

    def fitted(field: T.StructField) -> Column:
        given = incoming.get(field.name.lower())
        if given is None or isinstance(given.dataType, T.NullType):
            return F.lit(None).cast(field.dataType).alias(field.name)
        kind = merged_type(given.dataType, field.dataType, given.name, state.name)
        if kind.simpleString() != field.dataType.simpleString():
            changed.append(T.StructField(field.name, kind, True))
        return converted(F.col(quoted(given.name)), given.dataType, kind).alias(field.name)

    def key(field: T.StructField) -> Column:
        given = incoming.get(field.name.lower())
        if given is not None and given.dataType != field.dataType:
            raise _differ(given.dataType, field.dataType, given.name, state.name)
        return fitted(field)

    data = [fitted(f) for f in state.schema if f.name.lower() not in is_key]
    keys = [key(f) for f in state.schema if f.name.lower() in is_key]
    new = [F.col(quoted(f.name)) for f in added]
    return df.select(*data, *new, *keys), Evolution(added, tuple(changed))


def _differ(given: T.DataType, want: T.DataType, where: str, name: str) -> SpecError:
    return SpecError(f"column {where} is {given.simpleString()} in the query and {want.simpleString()} in {name}")


def merged_type(given: T.DataType, want: T.DataType, where: str, name: str) -> T.DataType:
    """The target's type with the nested fields that only the query has at the end of their structs."""
    if isinstance(given, T.NullType) or given.simpleString() == want.simpleString() or holds(want, given):
        return want
    if isinstance(given, T.StructType) and isinstance(want, T.StructType):
        incoming = {f.name.lower(): f for f in given}
        fields = []
        for field in want:
            other = incoming.pop(field.name.lower(), None)
            kind = merged_type(other.dataType, field.dataType, f"{where}.{other.name}", name) if other else field.dataType
            fields.append(T.StructField(field.name, kind, True))
        check_typed(list(incoming.values()))
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in incoming.values()])
    if isinstance(given, T.ArrayType) and isinstance(want, T.ArrayType):
        return T.ArrayType(merged_type(given.elementType, want.elementType, f"{where}[]", name), True)
    if isinstance(given, T.MapType) and isinstance(want, T.MapType):
        keys = merged_type(given.keyType, want.keyType, f"{where}.key", name)
        if keys.simpleString() != want.keyType.simpleString():
            raise _differ(given, want, where, name)
        return T.MapType(keys, merged_type(given.valueType, want.valueType, f"{where}.value", name), True)
    raise _differ(given, want, where, name)


#: Whole numbers, from narrow to wide, and the digits that the widest value of each has.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def holds(want: T.DataType, given: T.DataType) -> bool:
    """Whether every value of the given type is one of the wanted type too."""
    digits = WHOLE.get(type(given))
    if digits and type(want) in WHOLE:
        return digits <= WHOLE[type(want)]
    if isinstance(want, T.DecimalType):
        if isinstance(given, T.DecimalType):
            return want.scale >= given.scale and want.precision - want.scale >= given.precision - given.scale
        return bool(digits) and want.precision - want.scale >= digits
    if isinstance(want, T.DoubleType):
        return isinstance(given, T.FloatType) or bool(digits) and digits <= 10
    if isinstance(want, T.FloatType):
        return bool(digits) and digits <= 5
    return isinstance(want, T.TimestampNTZType) and isinstance(given, T.DateType)


def converted(column: Column, given: T.DataType, to: T.DataType) -> Column:
    """The column as the merged type; fields that it lacks are NULL, and a NULL struct stays one."""
    if given.simpleString() == to.simpleString():
        return column
    if isinstance(given, T.StructType) and isinstance(to, T.StructType):
        incoming = {f.name.lower(): f for f in given}
        fields = []
        for field in to:
            other = incoming.get(field.name.lower())
            value = converted(column.getField(other.name), other.dataType, field.dataType) if other else F.lit(None).cast(field.dataType)
            fields.append(value.alias(field.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(given, T.ArrayType) and isinstance(to, T.ArrayType):
        return F.transform(column, lambda x: converted(x, given.elementType, to.elementType))
    if isinstance(given, T.MapType) and isinstance(to, T.MapType):
        if given.keyType.simpleString() != to.keyType.simpleString():
            column = F.transform_keys(column, lambda k, _: converted(k, given.keyType, to.keyType))
        return F.transform_values(column, lambda _, v: converted(v, given.valueType, to.valueType))
    return column.cast(to)


def check_typed(fields: list[T.StructField]) -> None:
    """A bare NULL has no type to store; the query has to CAST it."""
    untyped = [f.name for f in fields if isinstance(f.dataType, T.NullType)]
    if untyped:
        raise SpecError(f"column(s) {', '.join(untyped)} are untyped NULL; CAST them in the query")


def evolve(spark: SparkSession, name: str, evolution: Evolution) -> None:
    """Add new columns and nested fields to the target; rows already there read them as NULL."""
    if evolution.added:
        # Columns a later query leaves out stay NULL, so none is declared NOT NULL.
        ddl = T.StructType([T.StructField(f.name, f.dataType, True) for f in evolution.added]).toDDL()
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl})")
    if evolution.changed:
        _change_types(spark, name, {f.name: f for f in evolution.changed})


def _change_types(spark: SparkSession, name: str, changed: Mapping[str, T.StructField]) -> None:
    """Give columns their new types in the catalog, which has no SQL statement for nested fields of file tables."""
    is_key = set(target_state(spark, name).partition_columns)
    schema = T.StructType([changed.get(f.name, f) for f in spark.table(name).schema if f.name not in is_key])
    catalog, table = session_table(spark, name)
    catalog.alterTableDataSchema(table, spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()))
    spark.catalog.refreshTable(name)
