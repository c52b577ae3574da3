"""Small text, date and key functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Text forms tried in this order.
DATETIME_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]",
    "yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]'Z'",
)

# Metric types of report headers.
INTEGER_METRICS = ("TYPE_INTEGER", "TYPE_MILLISECONDS")
FLOAT_METRICS = (
    "TYPE_FLOAT",
    "TYPE_CURRENCY",
    "TYPE_SECONDS",
    "TYPE_MINUTES",
    "TYPE_HOURS",
    "TYPE_FEET",
    "TYPE_MILES",
    "TYPE_METERS",
    "TYPE_KILOMETERS",
    "TYPE_STANDARD",
)


# ---------------------------------------------------------------- names


def snake_case(c: Column) -> Column:
    """camelCase and PascalCase to snake_case."""
    words = F.regexp_replace(c, "(.)([A-Z][a-z]+)", "$1_$2")
    return F.lower(F.regexp_replace(words, "([a-z0-9])([A-Z])", "$1_$2"))


def _snake_name(name: str) -> str:
    import re

    words = re.sub("(.)([A-Z][a-z]+)", r"\1_\2", name)
    return re.sub("([a-z0-9])([A-Z])", r"\1_\2", words).lower()


def _snake_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        fields = [T.StructField(_snake_name(f.name), _snake_type(f.dataType), f.nullable) for f in kind.fields]
        return T.StructType(fields)
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_snake_type(kind.elementType), kind.containsNull)
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _snake_type(kind.valueType), kind.valueContainsNull)
    return kind


def _snake_map_keys(c: Column, kind: T.DataType) -> Column:
    """Rewrite map keys wherever they are nested; everything else passes through."""
    if isinstance(kind, T.MapType):
        values = F.transform_values(c, lambda _, v: _snake_map_keys(v, kind.valueType))
        return F.transform_keys(values, lambda k, _: snake_case(k))
    if isinstance(kind, T.ArrayType) and "MapType" in repr(kind):
        return F.transform(c, lambda v: _snake_map_keys(v, kind.elementType))
    if isinstance(kind, T.StructType) and "MapType" in repr(kind):
        parts = [_snake_map_keys(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    return c


def snake_keys(df: DataFrame) -> DataFrame:
    """All column names, nested field names and map keys in snake_case."""
    return df.select(
        *[
            _snake_map_keys(F.col(f"`{f.name}`"), f.dataType).cast(_snake_type(f.dataType)).alias(_snake_name(f.name))
            for f in df.schema.fields
        ]
    )


def safe_name(c: Column, place: Column) -> Column:
    """Header text as a column name of letters, digits and ``_``; blank headers become ``_col{place}``."""
    name = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "[^a-zA-Z0-9_]+", "_")
    name = F.regexp_replace(F.regexp_replace(name, "_+", "_"), "^_+|_+$", "")
    return F.when(name == "", F.concat(F.lit("_col"), place.cast("string"))).otherwise(name)


def report_header(c: Column) -> Column:
    """CSV report header: no byte order mark, lower case, blanks as ``_``."""
    return F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"^\x{FEFF}", ""))), " ", "_")


# ---------------------------------------------------------------- dates


def _iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_SECONDS)


def odata_date(c: Column) -> Column:
    """``/Date(milliseconds)/`` text, with or without an offset, as UTC ISO text; other text stays."""
    millis = F.regexp_extract(c, r"^/Date\((-?\d+)([+-]\d{4})?\)/", 1).try_cast("bigint")
    return F.coalesce(_iso(F.timestamp_millis(millis)), c)


def epoch_ms(c: Column) -> Column:
    """Milliseconds since the epoch as UTC ISO text; anything that is no number is null."""
    return _iso(F.timestamp_millis(c.try_cast("bigint")))


def ymd(c: Column) -> Column:
    """``YYYYMMDD`` text as a date, null when it is none."""
    return F.when(c.rlike(r"^\d{8}"), F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd"))


def any_timestamp(c: Column, formats: Sequence[str] = DATETIME_FORMATS) -> Column:
    """First of ``formats`` that fits, as a UTC timestamp; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def canonical_utc(c: Column) -> Column:
    """ISO text with any offset as ``YYYY-MM-DDTHH:MM:SSZ``; a time without offset is UTC."""
    return _iso(F.try_to_timestamp(c))


# ---------------------------------------------------------------- text


def preview(c: Column, n: int = 100) -> Column:
    """First ``n`` characters of the value as text."""
    return F.left(c.cast("string"), F.lit(n))


def b64_text(c: Column) -> Column:
    """Base64 payload as UTF-8 text, undecodable bytes replaced."""
    return F.decode(F.unbase64(c), "UTF-8")


def typed_metric(c: Column, kind: Column) -> tuple[Column, Column, Column]:
    """A metric's text by its declared type: ``(integer, float, text)``, two of them null."""
    whole, real = kind.isin(*INTEGER_METRICS), kind.isin(*FLOAT_METRICS)
    return (
        F.when(whole, c.try_cast("bigint")),
        F.when(real, c.try_cast("double")),
        F.when(~whole & ~real, c),
    )


# ---------------------------------------------------------------- keys


def key_from_reference(
    c: Column, keys: Sequence[str], types: Mapping[str, str] | None = None, entity_set: str | None = None
) -> dict[str, Column]:
    """Key columns out of an entity reference such as ``.../Orders(OrderID=1,Lang='en')``.

    Null when the reference names another set, or its keys do not cover ``keys``. Quoted values lose their quotes;
    doubled quotes inside stand for one.
    """
    types = types or {}
    path = F.regexp_replace(F.regexp_replace(c, r"[?#].*$", ""), "/+$", "")
    last = F.try_url_decode(F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\+", "%2B"))
    predicate = F.regexp_extract(last, r"^[^(]*\((.*)\)$", 1)
    fits = last.rlike(r"^[^(]*\(.*\)$")
    if entity_set:
        collection = F.regexp_extract(last, r"^([^(]*)\(", 1)
        fits = fits & ((collection == entity_set) | collection.endswith("." + entity_set))
    # A literal is a quoted run (doubled quotes stay inside) or anything up to the next comma.
    literal = r"('(?:[^']|'')*'|[^',]+)"

    def value_of(key: str) -> Column:
        named = F.regexp_extract(predicate, rf"(?:^|,)\s*{key}\s*=\s*{literal}", 1)
        if len(keys) == 1:
            alone = F.when(predicate.rlike(rf"^\s*{literal}\s*$"), F.trim(predicate))
            named = F.when(named != "", named).otherwise(F.coalesce(alone, F.lit("")))
        raw = F.when(fits & (named != ""), named)
        text = F.when(
            raw.startswith("'"), F.replace(F.regexp_replace(raw, "^'|'$", ""), F.lit("''"), F.lit("'"))
        ).otherwise(F.trim(raw))
        return text

    found = {key: value_of(key) for key in keys}
    complete = F.lit(True)
    for column in found.values():
        complete = complete & column.isNotNull()
    return {k: F.when(complete, v).try_cast(types.get(k, "string")) for k, v in found.items()}
