"""Differences between two snapshots of a table, down to nested fields, also of records without a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType, VariantType

from ledgerlane.sources.publish import store

_ENTRY = "array<struct<path: string, left: string, right: string>>"
_OPEN = "array<struct<path: string, old: variant, new: variant>>"


def _text(value: Column, kind: DataType) -> Column:
    return F.to_json(value) if isinstance(kind, (StructType, MapType, ArrayType, VariantType)) else value.cast("string")


def _step(name: Column) -> Column:
    """One step of a path; a name that holds a dot or a backtick is put in backticks, so that no two paths read the same."""
    quoted = F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))
    return F.when(name.contains(".") | name.contains("`"), quoted).otherwise(name)


def _whole(path: Column, kinds: tuple[DataType, DataType], left: Column, right: Column) -> Column:
    return F.array(
        F.struct(path.alias("path"), _text(left, kinds[0]).alias("left"), _text(right, kinds[1]).alias("right"))
    ).cast(_ENTRY)


def _fields(left: StructType, right: StructType) -> list[tuple[str, DataType | None, DataType | None]]:
    """The fields of both sides, those of the left first, with their type on each side."""
    sides = [{field.name: field.dataType for field in kind.fields} for kind in (left, right)]
    return [(name, sides[0].get(name), sides[1].get(name)) for name in dict.fromkeys([*sides[0], *sides[1]])]


def _field(side: Column, kind: DataType | None, name: str, other: DataType | None) -> tuple[Column, DataType]:
    """A field of one side; NULL of the other side's type where it has none."""
    return (F.lit(None).cast(other), other) if kind is None else (side.getField(name), kind)


def _inside(path: Column | None, left_kind: StructType, right_kind: StructType, left: Column, right: Column, skip: Sequence[str] = ()) -> Column:
    entries = []
    for name, old_kind, new_kind in _fields(left_kind, right_kind):
        if name not in skip:
            old, old_type = _field(left, old_kind, name, new_kind)
            new, new_type = _field(right, new_kind, name, old_kind)
            step = _step(F.lit(name))
            entries.append(_differences(step if path is None else F.concat(path, F.lit("."), step), (old_type, new_type), old, new))
    return F.flatten(F.array(*entries)) if entries else F.array().cast(_ENTRY)


def _differences(path: Column, kinds: tuple[DataType, DataType], left: Column, right: Column) -> Column:
    """Entries for everything that differs between two values. Values of different types always differ, unless both are NULL."""
    nothing, (old, new) = F.array().cast(_ENTRY), kinds
    both_null, one_null = left.isNull() & right.isNull(), left.isNull() | right.isNull()
    if isinstance(old, StructType) and isinstance(new, StructType):
        inner = _inside(path, old, new, left, right)
    elif isinstance(old, MapType) and isinstance(new, MapType) and old.keyType == new.keyType:
        keys = F.array_sort(F.array_union(F.map_keys(left), F.map_keys(right)))
        inner = F.flatten(F.transform(keys, lambda key: _map_entry(path, (old, new), left, right, key)))
    elif isinstance(old, ArrayType) and isinstance(new, ArrayType):
        length = F.greatest(F.size(left), F.size(right))
        places = F.when(length > 0, F.sequence(F.lit(0), length - 1)).otherwise(F.array().cast("array<int>"))
        inner = F.flatten(F.transform(places, lambda place: _array_entry(path, (old, new), left, right, place)))
    elif isinstance(old, VariantType) and isinstance(new, VariantType):
        return F.when(F.to_json(left).eqNullSafe(F.to_json(right)), nothing).otherwise(_whole(path, kinds, left, right))
    elif old == new and not isinstance(old, MapType):
        return F.when(left.eqNullSafe(right), nothing).otherwise(_whole(path, kinds, left, right))
    else:
        return F.when(both_null, nothing).otherwise(_whole(path, kinds, left, right))
    # A value against no value is one difference; two values are compared inside.
    return F.when(both_null, nothing).when(one_null, _whole(path, kinds, left, right)).otherwise(inner)


def _map_entry(path: Column, kinds: tuple[MapType, MapType], left: Column, right: Column, key: Column) -> Column:
    """One map key. A key present on one side only differs even if it holds NULL there."""
    at, values = F.concat(path, F.lit("."), _step(key.cast("string"))), (kinds[0].valueType, kinds[1].valueType)
    old, new = F.element_at(left, key), F.element_at(right, key)
    both = F.map_contains_key(left, key) & F.map_contains_key(right, key)
    return F.when(both, _differences(at, values, old, new)).otherwise(_whole(at, values, old, new))


def _array_entry(path: Column, kinds: tuple[ArrayType, ArrayType], left: Column, right: Column, place: Column) -> Column:
    at, values = F.concat(path, F.lit("."), place.cast("string")), (kinds[0].elementType, kinds[1].elementType)
    old, new = F.get(left, place), F.get(right, place)
    both = (place < F.size(left)) & (place < F.size(right))
    return F.when(both, _differences(at, values, old, new)).otherwise(_whole(at, values, old, new))


def _objects(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string, variant>")


def _lists(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _kind(value: Column) -> Column:
    """What a schemaless value is; NULL without one."""
    told = F.schema_of_variant(value)
    number = told.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(told.startswith("OBJECT<"), "object").when(told.startswith("ARRAY<"), "list").when(number, "number").otherwise("other")


def _same_number(left: Column, right: Column) -> Column:
    """Whether two numbers are equal whatever their spelling: 100 and 1e2."""
    exact = [F.try_variant_get(value, "$", "decimal(38,18)") for value in (left, right)]
    near = [F.try_variant_get(value, "$", "double") for value in (left, right)]
    return F.coalesce(exact[0] == exact[1], near[0] == near[1], F.lit(False))


def _children(path: Column, kind: Column, left: Column, right: Column) -> Column:
    """The members of two objects by name, or of two lists by place, that differ as text."""

    def child(step: Column, old: Column, new: Column) -> Column:
        return F.struct(F.concat(path, F.lit("."), step).alias("path"), old.alias("old"), new.alias("new"))

    old, new = _objects(left), _objects(right)
    names = F.array_union(F.map_keys(old), F.map_keys(new))
    members = F.transform(names, lambda name: child(_step(name), F.element_at(old, name), F.element_at(new, name)))
    first, second = _lists(left), _lists(right)
    length = F.greatest(F.size(first), F.size(second))
    places = F.when(length > 0, F.sequence(F.lit(0), length - 1)).otherwise(F.array().cast("array<int>"))
    elements = F.transform(places, lambda place: child(place.cast("string"), F.get(first, place), F.get(second, place)))
    return F.filter(F.when(kind == "object", members).otherwise(elements).cast(_OPEN), _open)


def _open(pair: Column) -> Column:
    """Members are sorted by name in a variant, so equal text means equal values in any order of names."""
    return ~F.to_json(pair["old"]).eqNullSafe(F.to_json(pair["new"]))


def variant_differences(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What differs between two schemaless values: (keys, path, left, right) from rows (keys, path, old, new).

    Objects are compared name by name, lists place by place, and a value against none, or against one of another kind, is one
    difference. The order of names and the spelling of a number don't matter; JSON null is a value, and differs from a missing one.
    A round compares one level of all records: equal parts are dropped, differing containers on both sides give a row per differing member.
    The rows of a round are stored, so rounds don't repeat each other, and there are as many as the records are deep. Nothing is shuffled, and
    a record with millions of members becomes rows.
    """
    found = None
    while True:
        judged = pairs.withColumns({"_old_kind": _kind(F.col("old")), "_new_kind": _kind(F.col("new"))})
        alike = F.coalesce(F.col("_old_kind") == F.col("_new_kind"), F.lit(False))
        inner = alike & F.col("_old_kind").isin("object", "list")
        equal = alike & (F.col("_old_kind") == "number") & _same_number(F.col("old"), F.col("new"))
        done = judged.where(~inner & ~equal & _open(F.struct("old", "new")))
        done = done.select(*keys, "path", F.to_json("old").alias("left"), F.to_json("new").alias("right"))
        found = done if found is None else found.unionByName(done)
        members = _children(F.col("path"), F.col("_old_kind"), F.col("old"), F.col("new"))
        pairs = judged.where(inner).select(*keys, F.explode(members).alias("pair")).select(*keys, "pair.path", "pair.old", "pair.new")
        pairs = store(pairs, "members")
        if pairs.isEmpty():
            return found


def _tagged(value: Column, kind: DataType) -> Column:
    """A value as text that tells type, length and content; NULL for NULL. Members and map keys come in a fixed order."""
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), _record_text([(field, value.getField(field.name)) for field in kind.fields]))
    if isinstance(kind, MapType):
        pairs = F.transform(
            F.map_entries(value),
            lambda pair: F.concat(_tagged(pair["key"], kind.keyType), F.lit("="), F.coalesce(_tagged(pair["value"], kind.valueType), F.lit("-"))),
        )
        return F.concat(F.lit("m["), F.array_join(F.array_sort(pairs), ";"), F.lit("]"))
    if isinstance(kind, ArrayType):
        places = F.transform(value, lambda element: F.coalesce(_tagged(element, kind.elementType), F.lit("-")))
        return F.concat(F.lit("a["), F.array_join(places, ";"), F.lit("]"))
    text = _text(value, kind)
    return F.concat(F.lit(f"{kind.simpleString()}:"), F.octet_length(text).cast("string"), F.lit(":"), text)


def _record_text(fields: Sequence[tuple[StructField, Column]]) -> Column:
    """Fields by name; those that are NULL are left out, as a field that a record lacks is NULL."""
    parts = []
    for field, value in sorted(fields, key=lambda pair: pair[0].name):
        name = f"{len(field.name.encode())}:{field.name}="
        parts.append(F.coalesce(F.concat(F.lit(name), _tagged(value, field.dataType), F.lit(";")), F.lit("")))
    return F.concat(F.lit("r{"), *parts, F.lit("}"))


def record_hash(df: DataFrame, skip: Sequence[str] = ()) -> Column:
    """SHA-256 of a record that doesn't depend on the order of columns, nested fields, map keys or members of a schemaless value.

    Equal hashes mean that :func:`snapshot_diff` finds nothing. The reverse holds but for numbers of several spellings (0.0 and -0.0).
    """
    return F.sha2(_record_text([(field, F.col(f"`{field.name}`")) for field in df.schema.fields if field.name not in skip]), 256)


def changed_records(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both snapshots without the records that are equal in them.

    Only keys and hashes are shuffled to find them. The keys of the others are stored; where they are few, the planner broadcasts them after
    seeing their size, and the records that stay are not shuffled either.
    """
    hashes = [frame.select(*keys, record_hash(frame, keys).alias(name)) for frame, name in ((left, "_old"), (right, "_new"))]
    changed = hashes[0].join(hashes[1], list(keys), "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new"))).select(*keys)
    changed = store(changed, "changed")
    return tuple(frame.join(changed, list(keys), "left_semi").select(*frame.columns) for frame in (left, right))


def snapshot_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], by_hash: bool = False) -> DataFrame:
    """What differs between the records of two snapshots: one row per record key and path, with both values as text.

    Records are matched on ``keys`` (unique in each snapshot, so the one shuffle is even). All columns and nested fields of
    either side count; one that a side lacks is NULL there. A record missing on one
    side differs in every column it fills on the other. Nested records are compared field by field, maps key by key and
    lists place by place. Values of different types differ. In paths a name that holds a dot stands in backticks.
    VARIANT columns of both sides are compared as :func:`variant_differences` says; those inside maps and lists as a whole.

    With ``by_hash`` equal records are found by their hashes first (:func:`changed_records`): worth it where records are wide and few change.
    """
    if by_hash:
        left, right = changed_records(left, right, keys)

    def record(frame: DataFrame, name: str) -> DataFrame:
        columns = [F.col(f"`{column}`") for column in frame.columns if column not in keys]
        return frame.select(*keys, F.struct(*(columns or [F.lit(0).alias("_")])).alias(name))

    sides = record(left, "_old"), record(right, "_new")
    kinds = [StructType([field for field in frame.schema.fields if field.name not in keys]) for frame in (left, right)]
    free = [name for name, old, new in _fields(*kinds) if isinstance(old, VariantType) and isinstance(new, VariantType)]
    entries = _inside(None, kinds[0], kinds[1], F.col("_old"), F.col("_new"), skip=free)
    joined = sides[0].join(sides[1], list(keys), "full_outer")
    if not free:
        return joined.select(*keys, F.explode(entries).alias("entry")).select(*keys, "entry.path", "entry.left", "entry.right")
    pairs = [F.struct(_step(F.lit(name)).alias("path"), F.col("_old").getField(name).alias("old"), F.col("_new").getField(name).alias("new")) for name in free]
    both = joined.select(*keys, entries.alias("entries"), F.filter(F.array(*pairs).cast(_OPEN), _open).alias("open"))
    both = store(both.where((F.size("entries") > 0) | (F.size("open") > 0)), "differing")
    typed = both.select(*keys, F.explode("entries").alias("entry")).select(*keys, "entry.path", "entry.left", "entry.right")
    pairs = both.select(*keys, F.explode("open").alias("pair")).select(*keys, "pair.path", "pair.old", "pair.new")
    return typed.unionByName(variant_differences(pairs, keys))
