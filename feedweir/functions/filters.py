"""Predicates built from plain specifications; all of them stay visible to pushdown."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Predicate = tuple[str, str, object]


def _literal(value: object, kind: T.DataType) -> Column | None:
    """``value`` in the column's type; None when it cannot be written in it."""
    try:
        if isinstance(kind, T.BooleanType):
            return F.lit(str(value).lower() in ("true", "1", "yes"))
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return F.lit(int(str(value)))
        if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
            return F.lit(float(str(value)))
    except ValueError:
        return None
    return F.lit(value).cast(kind) if isinstance(kind, T.StringType) else F.lit(value).try_cast(kind)


def field_type(schema: T.StructType, name: str) -> T.DataType:
    """Type of a dotted field."""
    kind: T.DataType = schema
    for part in name.split("."):
        kind = kind[part].dataType
    return kind


def predicate(schema: T.StructType, name: str, op: str, value: object) -> Column:
    """One of eq, ne, gt, gte, lt, lte, in. A null field matches only ``ne``."""
    c, kind = F.col(name), field_type(schema, name)
    if op == "in":
        choices = value if isinstance(value, (list, tuple, set)) else str(value).split(",")
        return F.coalesce(c.cast("string").isin(*[str(v).strip() for v in choices]), F.lit(False))
    literal = _literal(value, kind)
    if literal is None:
        return c.isNull() if op == "ne" else F.lit(False)
    if op == "eq":
        return c == literal
    if op == "ne":
        return ~c.eqNullSafe(literal)
    compare = {"gt": c > literal, "gte": c >= literal, "lt": c < literal, "lte": c <= literal}
    return compare[op]


def all_of(*conditions: Column | None) -> Column:
    """AND of the conditions that are given; true when there is none."""
    given = [c for c in conditions if c is not None]
    return functools.reduce(lambda a, b: a & b, given, F.lit(True))


def any_of(*conditions: Column | None) -> Column:
    """OR of the conditions that are given; false when there is none."""
    given = [c for c in conditions if c is not None]
    return functools.reduce(lambda a, b: a | b, given, F.lit(False))


def apply_predicates(df: DataFrame, predicates: Iterable[Predicate]) -> DataFrame:
    """Rows for which every ``(column, op, value)`` holds."""
    return df.filter(all_of(*[predicate(df.schema, *p) for p in predicates]))


def condition(schema: T.StructType, spec: Mapping[str, object] | Sequence) -> Column:
    """Nested ``{"and": [...]}``, ``{"or": [...]}``, ``{"not": ...}`` over ``(column, op, value)`` leaves."""
    if isinstance(spec, Mapping):
        ((kind, inner),) = spec.items()
        if kind == "not":
            return ~condition(schema, inner)
        parts = [condition(schema, each) for each in inner]
        return all_of(*parts) if kind == "and" else any_of(*parts)
    return predicate(schema, *spec)


def filter_equals(df: DataFrame, **values: object) -> DataFrame:
    """Equality options; an option that is None or empty is not set."""
    return apply_predicates(df, [(k, "eq", v) for k, v in values.items() if v not in (None, "")])


def search_text(df: DataFrame, query: str) -> DataFrame:
    """Rows whose record text contains the query, ignoring case."""
    record = F.lower(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    return df.filter(record.contains(query.lower())) if query else df


def parse_filter_option(text: str | None, reserved: Sequence[str] = ()) -> list[Predicate]:
    """Filters given as a JSON object; keys the reader manages itself are refused."""
    if not text or not text.strip():
        return []
    values = json.loads(text)
    if not isinstance(values, dict):
        raise ValueError("filters must be a JSON object")
    taken = sorted(set(values) & set(reserved))
    if taken:
        raise ValueError(f"filters may not set {', '.join(taken)}")
    return [(k, "in" if isinstance(v, list) else "eq", v) for k, v in values.items()]


def valid_id(c: Column) -> Column:
    """Digits and dots only, never two dots in a row."""
    return c.rlike(r"^[0-9.]+$") & ~c.contains("..")


def wildcard(c: Column, pattern: str) -> Column:
    """Name filter with ``*`` and ``?``, ignoring case."""
    escaped = pattern.lower().replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return F.lower(c).like(escaped.replace("*", "%").replace("?", "_"))


def filter_name(df: DataFrame, column: str, pattern: str | None) -> DataFrame:
    """Rows whose name fits the wildcard; no pattern keeps all."""
    return df.filter(wildcard(F.col(column), pattern)) if pattern and pattern != "*" else df
