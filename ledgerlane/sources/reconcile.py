"""Tables whose tenants store a column under different types, read as one table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VariantType,
)

from ledgerlane.sources.schemas import TENANT

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
_NESTED = (StructType, ArrayType, MapType, VariantType)


class Stored(NamedTuple):
    """Folders or files that share a schema."""

    paths: tuple[str, ...]
    schema: StructType


class Plan(NamedTuple):
    """How a table is read: its ``stored`` schemas, the ``types`` each column is stored under, and the one it gets."""

    path: str
    stored: list[Stored]
    types: dict[str, list[DataType]]
    wanted: dict[str, DataType]


class Reconciled(NamedTuple):
    """``frame``: all rows under the common types; ``lost``: (tenant_db, name, stored_type, value, rows) of values these can't hold."""

    frame: DataFrame
    lost: DataFrame


def _join(left: DataType, right: DataType) -> DataType:
    """The least type that holds all values of both; text where there is no other."""
    if left == right:
        return left
    if isinstance(left, _WHOLE) and isinstance(right, _WHOLE):
        return max(left, right, key=lambda kind: _DIGITS[type(kind)])
    numbers = (*_WHOLE, DecimalType)
    if isinstance(left, numbers) and isinstance(right, numbers):
        sides = [(kind.precision - kind.scale, kind.scale) if isinstance(kind, DecimalType) else (_DIGITS[type(kind)], 0) for kind in (left, right)]
        whole, scale = map(max, zip(*sides))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
    exact = (ByteType, ShortType, IntegerType, FloatType, DoubleType)
    if isinstance(left, exact) and isinstance(right, exact):
        return DoubleType()
    if {type(left), type(right)} == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    return StringType()


def common_type(kinds: Iterable[DataType]) -> DataType:
    """The least type of the lattice that holds all values of the given ones: int, long, decimal, text; float with int, double, text; date, time, text.

    Nested values that differ in type become JSON text.
    """
    return reduce(_join, kinds)


def _lister(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)


def _merged_schema(spark: SparkSession, path: str) -> StructType | None:
    """The columns of all files under a path, from their footers; None where files disagree on a type."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        return None


def stored_schemas(spark: SparkSession, path: str, tenants: Sequence[str] | None = None) -> list[Stored]:
    """The distinct schemas under a table's folder, and the tenants' folders that have each.

    One footer read per tenant, in which Spark merges its files; only a tenant whose own files disagree is looked at file by file.
    """
    names = [(status.getPath().toString(), status.getPath().getName()) for status in _lister(spark, path) if status.isDirectory()]
    wanted = [folder for folder, name in names if name.startswith(f"{TENANT}=") and (tenants is None or name.split("=", 1)[1] in tenants)]
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for folder in wanted or [path]:
        schema = _merged_schema(spark, folder)
        places = [folder] if schema else [s.getPath().toString() for s in _lister(spark, folder) if s.isFile() and s.getPath().getName().endswith(".parquet")]
        for place in places:
            own = schema or spark.read.parquet(place).schema
            own = StructType([StructField(field.name, field.dataType) for field in own.fields if field.name != TENANT])
            groups.setdefault(own.json(), (own, []))[1].append(place)
    return [Stored(tuple(places), schema) for schema, places in groups.values()]


def _text(value: Column, kind: DataType) -> Column:
    return F.to_json(value) if isinstance(kind, _NESTED) else value.cast("string")


def _converted(value: Column, kind: DataType, wanted: DataType) -> Column:
    if kind == wanted:
        return value
    if isinstance(wanted, StringType):
        return _text(value, kind)
    if isinstance(kind, _NESTED) or isinstance(wanted, _NESTED):
        return F.lit(None).cast(wanted)
    return value.try_cast(wanted)


def _lost(value: Column, kind: DataType, wanted: DataType) -> Column | None:
    """Whether a value does not survive the change of type: it comes back as another one. None where all do."""
    if kind == wanted or isinstance(wanted, StringType) or common_type([kind, wanted]) == wanted:
        return None
    if isinstance(kind, StringType):
        return value.isNotNull() & _converted(value, kind, wanted).isNull()
    if isinstance(kind, _NESTED) or isinstance(wanted, _NESTED):
        return value.isNotNull()
    return ~_converted(value, kind, wanted).try_cast(kind).eqNullSafe(value)


def reading_plan(spark: SparkSession, path: str, declared: StructType | None = None, tenants: Sequence[str] | None = None) -> Plan:
    """The declared type of each column, or the least common one of its stored types. Only footers are read."""
    stored, types = stored_schemas(spark, path, tenants), {}
    for _, schema in stored:
        for field in schema.fields:
            kinds = types.setdefault(field.name, [])
            if field.dataType not in kinds:
                kinds.append(field.dataType)
    fixed = {field.name: field.dataType for field in (declared.fields if declared else [])}
    return Plan(path, stored, types, {name: common_type(kinds) for name, kinds in types.items()} | fixed)


def _rows(spark: SparkSession, plan: Plan, stored: Stored, fields: Sequence[StructField]) -> DataFrame:
    schema = StructType([*fields, StructField(TENANT, StringType())])
    return spark.read.option("basePath", plan.path).schema(schema).parquet(*stored.paths)


def reconciled(spark: SparkSession, plan: Plan) -> Reconciled:
    """Read a table whose tenants disagree on types: one read per distinct schema, every column under one type.

    A value that the type can't hold exactly becomes NULL and is told in ``lost``, so nothing changes silently. Columns that a tenant lacks are NULL.
    Text counts as kept if it reads as a value of the type.
    """
    frames, losses = [], []
    for stored in plan.stored:
        kinds = {field.name: field.dataType for field in stored.schema.fields}
        rows = _rows(spark, plan, stored, stored.schema.fields)
        bad = {name: test for name, kind in kinds.items() if (test := _lost(F.col(f"`{name}`"), kind, plan.wanted[name])) is not None}
        columns = [F.col(TENANT)]
        for name, kind in plan.wanted.items():
            value = _converted(F.col(f"`{name}`"), kinds[name], kind) if name in kinds else F.lit(None).cast(kind)
            columns.append((F.when(~F.coalesce(bad[name], F.lit(False)), value) if name in bad else value).alias(name))
        frames.append(rows.select(*columns))
        if bad:
            entries = []
            for name in bad:
                told = [F.lit(name).alias("name"), F.lit(kinds[name].simpleString()).alias("stored_type")]
                entries.append(F.when(bad[name], F.struct(*told, _text(F.col(f"`{name}`"), kinds[name]).alias("value"))))
            told = rows.select(TENANT, F.explode(F.array_compact(F.array(*entries))).alias("entry")).select(TENANT, "entry.*")
            losses.append(told.groupBy(TENANT, "name", "stored_type", "value").agg(F.count("*").alias("rows")))
    nothing = spark.createDataFrame([], f"{TENANT} string, name string, stored_type string, value string, rows long")
    return Reconciled(reduce(DataFrame.unionByName, frames), reduce(DataFrame.unionByName, losses, nothing))


def type_drift(spark: SparkSession, plan: Plan) -> DataFrame:
    """Columns that tenants store under several types, or not under the declared one.

    One row per tenant and stored type of such a column: (tenant, name, stored_type, common_type, filled, lost): how many values it has there, and
    how many of them the common type can't hold. Every schema is scanned once, for these columns only.
    """
    drifted = {name for name, kinds in plan.types.items() if len(kinds) > 1 or kinds[0] != plan.wanted[name]}
    parts = []
    for stored in plan.stored:
        own, counts = [field for field in stored.schema.fields if field.name in drifted], []
        for name, kind in ((field.name, field.dataType) for field in own):
            value, wanted = F.col(f"`{name}`"), plan.wanted[name]
            bad = _lost(value, kind, wanted)
            told = [F.lit(text).alias(label) for label, text in (("name", name), ("stored_type", kind.simpleString()), ("common_type", wanted.simpleString()))]
            lost = F.lit(0).cast("long") if bad is None else F.count_if(bad)
            counts.append(F.struct(*told, F.count(value).alias("filled"), lost.alias("lost")))
        if own:
            summed = _rows(spark, plan, stored, own).groupBy(F.col(TENANT).alias("tenant")).agg(F.array(*counts).alias("columns"))
            parts.append(summed.select("tenant", F.explode("columns").alias("entry")).select("tenant", "entry.*"))
    nothing = spark.createDataFrame([], "tenant string, name string, stored_type string, common_type string, filled long, lost long")
    return reduce(DataFrame.unionByName, parts, nothing)
