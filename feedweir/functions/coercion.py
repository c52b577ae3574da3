"""Typed coercion of loosely typed records, as expressions Spark can compile."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.functions.nested import once

# Accepted spellings and date forms, tried in this order.
TRUE_WORDS = ("true", "t", "yes", "y", "1")
FALSE_WORDS = ("false", "f", "no", "n", "0")
DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "d-M-yyyy", "yyyy/M/d")
TIMESTAMP_FORMATS = ("yyyy-M-d H:m:s", "yyyy/M/d H:m:s")

ERRORS = "_errors"
BROKEN = "__broken"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType, T.DecimalType)


def to_integer(c: Column, kind: T.DataType) -> Column:
    """Whole numbers as they are; text with a point goes through a float and is truncated."""
    text = F.trim(c.cast("string"))
    through_float = text.try_cast("double").try_cast("bigint")
    plain = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    return F.when(text.contains("."), through_float).otherwise(plain).try_cast(kind)


def to_boolean(c: Column) -> Column:
    """Known words ignoring case; any other text is true unless it is empty."""
    word = F.lower(c)
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(F.length(c) > 0)


def to_date(c: Column) -> Column:
    """First date form that fits, then ISO."""
    tries = [F.try_to_date(c, f) for f in DATE_FORMATS]
    return F.coalesce(*tries, F.try_to_timestamp(c).cast("date"))


def to_timestamp(c: Column) -> Column:
    """ISO text first, then the two plain forms; times without a zone are UTC."""
    return F.coalesce(F.try_to_timestamp(c), *[F.try_to_timestamp(c, F.lit(f)) for f in TIMESTAMP_FORMATS])


def to_binary(c: Column) -> Column:
    """Base64, else hex, else the UTF-8 bytes of the text."""
    return F.coalesce(F.try_to_binary(c, F.lit("base64")), F.try_to_binary(c, F.lit("hex")), F.encode(c, "UTF-8"))


def _from_text(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, _WHOLE):
        return to_integer(c, kind)
    if isinstance(kind, _REAL):
        return F.trim(c).try_cast(kind)
    if isinstance(kind, T.BooleanType):
        return to_boolean(c)
    if isinstance(kind, T.DateType):
        return to_date(c)
    if isinstance(kind, T.TimestampType):
        return to_timestamp(c)
    if isinstance(kind, T.TimestampNTZType):
        return to_timestamp(c).cast("timestamp_ntz")
    if isinstance(kind, T.BinaryType):
        return to_binary(c)
    if isinstance(kind, T.VariantType):
        return F.try_parse_json(c)
    raise TypeError(f"no coercion from text to {kind.simpleString()}")


def _scalar(c: Column, source: T.DataType, kind: T.DataType) -> Column:
    if isinstance(source, T.StringType):
        return _from_text(c, kind)
    if isinstance(kind, T.StringType):
        return F.initcap(c.cast("string")) if isinstance(source, T.BooleanType) else c.cast("string")
    numeric = isinstance(source, (*_WHOLE, *_REAL))
    if numeric and isinstance(kind, T.TimestampType):
        return F.timestamp_micros((c.cast("decimal(28,6)") * 1_000_000).try_cast("bigint"))
    if numeric and isinstance(kind, T.BooleanType):
        return c != 0
    if isinstance(kind, T.BinaryType):
        return F.encode(c.cast("string"), "UTF-8")
    return c.try_cast(kind)


def _texts_only(kind: T.DataType) -> T.DataType:
    """Same shape with every leaf as text, so a JSON value of the wrong type is not lost while parsing."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _texts_only(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_texts_only(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), _texts_only(kind.valueType))
    return T.StringType()


def _struct(c: Column, source: T.StructType, kind: T.StructType, mode: str) -> Column:
    parts = []
    for field in kind.fields:
        if field.name in source.names:
            value = coerce_value(c[field.name], source[field.name].dataType, field.dataType, mode)
            if not field.nullable and mode == "fail":
                missing = F.raise_error(F.lit(f"required field {field.name} is missing")).cast(field.dataType)
                value = F.when(value.isNull(), missing).otherwise(value)
        elif field.nullable:
            value = F.lit(None).cast(field.dataType)
        else:
            raise ValueError(f"required field {field.name} is not in the input")
        parts.append(value.alias(field.name))
    return F.when(c.isNotNull(), F.struct(*parts))


def _parse(c: Column, kind: T.DataType) -> tuple[Column, Callable[[Column], Column]]:
    """JSON text with text leaves, and a test whether such a parsed value holds all that the text says.

    A struct that is read in part carries the broken text in an extra field.
    """
    if isinstance(kind, T.StructType):
        shape = T.StructType([*_texts_only(kind).fields, T.StructField(BROKEN, T.StringType())])
        parsed = F.from_json(c, shape, {"columnNameOfCorruptRecord": BROKEN})
        return parsed, lambda v: v.isNotNull() & v[BROKEN].isNull()
    if isinstance(kind, T.ArrayType) and kind.containsNull:
        single = F.when(c.rlike(r"^\s*\{"), F.concat(F.lit("["), c, F.lit("]"))).otherwise(F.to_json(F.array(c)))
        c = F.when(c.rlike(r"^\s*\["), c).otherwise(single)
    return F.from_json(c, _texts_only(kind)), lambda v: v.isNotNull()


def loses(c: Column, source: T.DataType, kind: T.DataType) -> Column:
    """Whether a part of ``c`` that is not null, at any depth, becomes null as ``kind``; never null itself."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        if isinstance(source, T.StringType):
            parsed, whole = _parse(c, kind)
            shape = _texts_only(kind)
            return c.isNotNull() & F.coalesce(once(parsed, lambda v: ~whole(v) | loses(v, shape, kind)), F.lit(True))
        if isinstance(kind, T.ArrayType):
            if not isinstance(source, T.ArrayType):
                return loses(c, source, kind.elementType)
            return F.coalesce(F.exists(c, lambda v: loses(v, source.elementType, kind.elementType)), F.lit(False))
        if isinstance(kind, T.MapType) and isinstance(source, T.MapType):
            keys = F.exists(F.map_keys(c), lambda v: loses(v, source.keyType, kind.keyType))
            values = F.exists(F.map_values(c), lambda v: loses(v, source.valueType, kind.valueType))
            return F.coalesce(keys | values, F.lit(False))
        if isinstance(kind, T.StructType) and isinstance(source, T.StructType):
            parts = [loses(c[f.name], source[f.name].dataType, f.dataType) for f in kind.fields if f.name in source.names]
            return F.coalesce(reduce(Column.__or__, parts, F.lit(False)), F.lit(False))
        return c.isNotNull()
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
        return F.lit(False) if isinstance(kind, T.StringType) else c.isNotNull()
    return c.isNotNull() & _scalar(c, source, kind).isNull()


def coerce_value(c: Column, source: T.DataType, kind: T.DataType, mode: str = "fail") -> Column:
    """``c`` of type ``source`` as ``kind``; a value that does not fit fails or becomes null, by ``mode``."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        if isinstance(source, T.StringType):
            shape = _texts_only(kind)
            parsed, whole = _parse(c, kind)
            if mode != "fail":
                return once(parsed, lambda v: coerce_value(v, shape, kind, mode))
            if isinstance(kind, T.StructType):
                empty = F.raise_error(F.lit("an empty object is no struct; use null")).cast("string")
                parsed, whole = _parse(F.when(c.rlike(r"^\s*\{\s*\}\s*$"), empty).otherwise(c), kind)
            problem = F.raise_error(F.concat(F.lit("no JSON of the expected shape: "), c)).cast(kind)
            return once(
                parsed, lambda v: F.when(c.isNotNull() & ~whole(v), problem).otherwise(coerce_value(v, shape, kind, mode))
            )
        if isinstance(kind, T.ArrayType):
            if not isinstance(source, T.ArrayType):
                if not kind.containsNull:
                    raise ValueError(f"{source.simpleString()} is no array")
                return F.when(c.isNotNull(), F.array(coerce_value(c, source, kind.elementType, mode)))
            return F.transform(c, lambda v: coerce_value(v, source.elementType, kind.elementType, mode))
        if isinstance(kind, T.MapType) and isinstance(source, T.MapType):
            values = F.transform_values(c, lambda _, v: coerce_value(v, source.valueType, kind.valueType, mode))
            return F.transform_keys(values, lambda k, _: coerce_value(k, source.keyType, kind.keyType, mode))
        if isinstance(kind, T.StructType) and isinstance(source, T.StructType):
            return _struct(c, source, kind, mode)
        raise ValueError(f"cannot turn {source.simpleString()} into {kind.simpleString()}")
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c) if isinstance(kind, T.StringType) else F.lit(None).cast(kind)
    value = _scalar(c, source, kind)
    if mode != "fail" or isinstance(kind, (T.StringType, T.BinaryType)):
        return value
    problem = F.concat(F.lit("cannot convert '"), c.cast("string"), F.lit(f"' to {kind.simpleString()}"))
    return F.when(c.isNotNull() & value.isNull(), F.raise_error(problem).cast(kind)).otherwise(value)


def coerce(df: DataFrame, schema: T.StructType, mode: str = "fail") -> DataFrame:
    """Records coerced to ``schema``.

    ``fail`` stops at the first value that does not fit, broken JSON included; ``permissive`` nulls it and lists the
    column in ``_errors``, wherever in the column the value was.
    """
    columns, errors = [], []
    for field in schema.fields:
        if field.name not in df.columns:
            if not field.nullable:
                raise ValueError(f"required field {field.name} is not in the input")
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        source = F.col(f"`{field.name}`")
        value = coerce_value(source, df.schema[field.name].dataType, field.dataType, mode)
        bad = loses(source, df.schema[field.name].dataType, field.dataType) if mode == "permissive" else F.lit(False)
        if not field.nullable:
            bad = bad | value.isNull()
            if mode == "fail":
                missing = F.raise_error(F.lit(f"required field {field.name} is missing")).cast(field.dataType)
                value = F.when(source.isNull(), missing).otherwise(value)
        errors.append(F.when(bad, F.lit(field.name)))
        columns.append(value.alias(field.name))
    if mode == "permissive":
        columns.append(F.array_compact(F.array(*errors)).alias(ERRORS))
    return df.select(*columns)


def project_to_schema(c: Column, schema: T.DataType) -> Column:
    """JSON text as ``schema``; a part of the wrong shape becomes null."""
    return F.from_json(c, schema)


def num_or_null(c: Column) -> Column:
    """A number, or null."""
    return c.try_cast("double")


def bool_or(c: Column, default: bool = False) -> Column:
    """Known words and numbers as booleans, ``default`` for the rest."""
    word = F.lower(F.trim(c.cast("string")))
    number = word.try_cast("double")
    return (
        F.when(word.isin(*TRUE_WORDS), True)
        .when(word.isin(*FALSE_WORDS), False)
        .when(number.isNotNull(), number != 0)
        .otherwise(F.lit(default))
    )


def str_list(c: Column, kind: T.DataType) -> Column:
    """An array of texts: arrays element by element, anything else as a single element."""
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda v: v.cast("string"))
    return F.when(c.isNotNull(), F.array(c.cast("string")))
