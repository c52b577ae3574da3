"""Reading and reshaping nested values without leaving the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def once(c: Column, use) -> Column:
    """``use(c)`` with ``c`` bound to a name: however often it is used, it is written and evaluated once."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def json_path(c: Column, path: str) -> Column:
    """Dotted path into JSON text, null when any step is missing."""
    return F.get_json_object(c, "$." + path)


def tag_value(c: Column, tag: str, kind: str = "string", place: int = 0) -> Column:
    """``tag.Value[place]`` of a JSON object keyed by tags, null when absent."""
    return F.try_variant_get(F.try_parse_json(c), f"$['{tag}'].Value[{place}]", kind)


def map_to_text(c: Column, null_as: str = "") -> Column:
    """Map values as text; nulls become ``null_as``."""
    return F.transform_values(c, lambda _, v: F.coalesce(v.cast("string"), F.lit(null_as)))


def association_ids(c: Column) -> Column:
    """Ids out of an association list, whether a bare array or wrapped as ``{"results": [...]}`` JSON text.

    Entries may be objects with an ``id`` or plain scalars; entries without an id are dropped.
    """
    whole = F.try_parse_json(c)
    inner = F.coalesce(F.try_variant_get(whole, "$.results", "array<variant>"), whole.try_cast("array<variant>"))
    each = F.transform(
        inner, lambda v: F.coalesce(F.try_variant_get(v, "$.id", "string"), F.try_variant_get(v, "$", "string"))
    )
    return F.filter(each, lambda v: v.isNotNull() & ~v.startswith("{"))


def poly_to_text(c: Column) -> Column:
    """JSON value of any type as text: strings bare, booleans in lower case, containers as JSON, null as null."""
    value = F.try_parse_json(c)
    return F.when(F.is_variant_null(value), F.lit(None).cast("string")).otherwise(value.cast("string"))


def ref_struct(c: Column) -> Column:
    """Reference object in JSON text as ``{id, type, name}``; null without an id."""
    ref_id = json_path(c, "id")
    parts = F.struct(
        ref_id.alias("id"),
        F.coalesce(json_path(c, "resourceType"), json_path(c, "type")).alias("type"),
        F.coalesce(json_path(c, "displayName"), json_path(c, "name")).alias("name"),
    )
    return F.when(ref_id.isNotNull(), parts)


def first_of(c: Column) -> Column:
    """First element, null for an empty or missing array."""
    return F.get(c, F.lit(0))


def find(c: Column, test) -> Column:
    """First element for which ``test`` holds."""
    return F.get(F.filter(c, test), F.lit(0))


def _all_null(c: Column, kind: T.StructType) -> Column:
    empty = F.lit(True)
    for field in kind.fields:
        empty = empty & c[field.name].isNull()
    return empty


def null_if_empty(c: Column, kind: T.DataType) -> Column:
    """Empty text, empty map and all-null struct as null, at every depth; arrays keep their length."""
    if isinstance(kind, T.StringType):
        return F.when(c != "", c)
    if isinstance(kind, T.MapType):
        return F.when(F.size(c) > 0, c)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.MapType, T.ArrayType)):
        return F.transform(c, lambda v: null_if_empty(v, kind.elementType))
    if isinstance(kind, T.StructType):
        rebuilt = F.struct(*[null_if_empty(c[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), once(rebuilt, lambda r: F.when(~_all_null(r, kind), r)))
    return c


def is_nested(kind: T.DataType) -> bool:
    """True for struct, array, map and variant columns."""
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType))


def value_with_fallback(top: Column | None, values: Column, name: str) -> Column:
    """The top-level value, else ``textEntry`` of the entry called ``name`` in the values map."""
    entry = F.try_element_at(values, F.lit(name))["textEntry"]
    return entry if top is None else F.coalesce(top, entry)


def without_keys(c: Column, names: Sequence[str]) -> Column:
    """Map without the named keys; null when nothing is left."""
    rest = F.map_filter(c, lambda k, _: ~k.isin(*names))
    return F.when(F.size(rest) > 0, rest)
