"""Checks on tables: fields, drift, population, required values, keys, round trips; and synthetic rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.functions.literals import literal
from feedweir.session import settle


# Different keys of an object above which it is a map, whose keys are no fields.
MOST_KEYS = 1000


def path_counts(df: DataFrame, json_column: str, most_keys: int = MOST_KEYS) -> DataFrame:
    """Fields of JSON documents: one row per dotted ``path`` with how often it occurs (``n``) and its ``kind``.

    Documents are opened level by level, arrays by their elements, until nothing is left to open. An object whose keys
    at one path are more than ``most_keys`` different ones is a map (``kind`` map) and has one path, ``….*``, for all its
    values; so documents keyed by an id make no more paths than others. Other kinds are struct, array and value, the
    first of them that occurs. Keys are counted by sketches and values by paths. Only the paths of maps pass the driver, of
    which there is at most one for each ``most_keys`` values; values stay in the tasks that opened them.
    """
    top = df.select(F.lit(None).cast("string").alias("path"), F.try_parse_json(json_column).alias("v"))
    level, found = top.where("v IS NOT NULL"), None
    while True:
        level = settle(level)
        if level.isEmpty():
            break
        keyed = level.select("path", F.explode(F.try_variant_get("v", "$", "map<string,variant>")).alias("key", "v"))
        keys = keyed.groupBy("path").agg((F.approx_count_distinct("key") > most_keys).alias("open"))
        # one row per path that holds maps; dealt out by path, all values of a path would meet in one task
        opened = settle(keys.where("open")).withColumnRenamed("path", "__path")
        here = F.when(F.col("open"), F.lit("*")).otherwise(F.col("key"))
        kids = keyed.join(F.broadcast(opened), F.col("path").eqNullSafe(F.col("__path")), "left")
        kids = kids.select(F.concat_ws(".", "path", here).alias("path"), "v")
        kind = F.regexp_extract(F.schema_of_variant("v"), "^(OBJECT|ARRAY)", 1)
        kids = kids.withColumn("kind", F.when(kind == "OBJECT", 0).when(kind == "ARRAY", 1).otherwise(2))
        counted = kids.groupBy("path").agg(F.count("*").alias("n"), F.min("kind").alias("kind"))
        maps = opened.where("__path IS NOT NULL").select(F.col("__path").alias("path"), F.lit(True).alias("map"))
        found = counted if found is None else found.unionByName(counted)
        found = found.join(maps, "path", "left").withColumn("kind", F.when(F.col("map"), -1).otherwise(F.col("kind"))).drop("map")
        found = settle(found)
        inside = level.select("path", F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("v"))
        level = kids.where("kind < 2").select("path", "v").unionByName(inside)
    names = F.element_at(F.array(*[F.lit(n) for n in ("map", "struct", "array", "value")]), F.col("kind") + 2)
    if found is None:
        return df.sparkSession.createDataFrame([], "path string, n bigint, kind string")
    return found.groupBy("path").agg(F.sum("n").alias("n"), F.min("kind").alias("kind")).select("path", "n", names.alias("kind"))


def field_paths(df: DataFrame, json_column: str) -> DataFrame:
    """Dotted paths of all fields that occur in JSON documents."""
    return path_counts(df, json_column).select("path")


def _declared(schema: T.StructType) -> list[tuple[str, bool]]:
    """Declared paths, and whether anything below a path is covered because it is a map or a variant."""
    rows: list[tuple[str, bool]] = []

    def walk(kind: T.StructType, prefix: str) -> None:
        for field in kind.fields:
            here, inner = prefix + field.name, field.dataType
            inner = inner.elementType if isinstance(inner, T.ArrayType) else inner
            rows.append((here, isinstance(inner, (T.MapType, T.VariantType))))
            if isinstance(inner, T.StructType):
                walk(inner, here + ".")

    walk(schema, "")
    return rows


def schema_paths(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Declared paths as rows ``path, open``."""
    return spark.createDataFrame(_declared(schema), "path string, open boolean")


def field_sets(declared: DataFrame, seen: DataFrame) -> DataFrame:
    """Every path with where it occurs: declared, seen or both."""
    left = declared.select("path").distinct().withColumn("d", F.lit(True))
    right = seen.select("path").distinct().withColumn("s", F.lit(True))
    place = F.when(F.col("d").isNull(), "seen").when(F.col("s").isNull(), "declared").otherwise("both")
    return left.join(right, "path", "full_outer").select("path", place.alias("place"))


def schema_drift(df: DataFrame, json_column: str, schema: T.StructType) -> DataFrame:
    """Paths that occur in the documents and that no declared field covers; what is declared is as short as a schema."""
    declared = _declared(schema)
    names, opened = [p for p, _ in declared], [p + "." for p, is_open in declared if is_open]
    loose = ~F.col("path").isin(names)
    for start in opened:
        loose = loose & ~F.col("path").startswith(start)
    return field_paths(df, json_column).where(loose)


def column_population(df: DataFrame, allow: Sequence[str] = ()) -> DataFrame:
    """Per column: rows with a value, and whether a column that should hold values never does. One pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("filled")) for c in df.columns])
    empty = (F.col("filled") == 0) & ~F.col("column").isin(*allow) if allow else F.col("filled") == 0
    return counts.select(F.inline(pairs)).withColumn("never_filled", empty)


def required_nulls(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Nulls per required column, and rows in which every column is null under the name ``*``. One pass."""
    everything = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in df.columns])
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required], F.count_if(everything).alias("*"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in [*required, "*"]])
    return counts.select(F.inline(pairs))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; a key is counted on the map side first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def slices_equal_table(slices: Sequence[DataFrame], df: DataFrame) -> DataFrame:
    """One row: rows lost and rows added by reading a table in slices; both are zero when the round trip holds.

    Multiplicities count, so a row delivered twice is found as well.
    """
    names = df.columns
    together = reduce(DataFrame.unionByName, [s.select(*names) for s in slices])
    marked = df.withColumn("__d", F.lit(1)).unionByName(together.withColumn("__d", F.lit(-1)))
    balance = marked.groupBy(*names).agg(F.sum("__d").alias("d"))
    lost = F.sum(F.when(F.col("d") > 0, F.col("d")))
    extra = F.sum(F.when(F.col("d") < 0, -F.col("d")))
    zero = F.lit(0).cast("bigint")
    return balance.agg(F.coalesce(lost, zero).alias("lost"), F.coalesce(extra, zero).alias("added"))


# ---------------------------------------------------------------- synthetic rows


def _seeded(kind: T.DataType, draw: Column, name: str, nullable: bool) -> Column:
    """A value of a type from a 64-bit draw."""
    spread = F.pmod(draw, F.lit(1_000_000))
    if isinstance(kind, T.StringType):
        value = F.concat(F.lit(f"{name}_"), spread.cast("string"))
    elif isinstance(kind, T.BooleanType):
        value = F.pmod(draw, F.lit(2)) == 0
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.timestamp_seconds(F.lit(1_704_067_200) + spread).cast(kind)
    elif isinstance(kind, T.DateType):
        value = F.date_add(F.lit(dt.date(2024, 1, 1)), F.pmod(draw, F.lit(365)).cast("int"))
    elif isinstance(kind, T.BinaryType):
        value = F.encode(spread.cast("string"), "UTF-8")
    elif isinstance(kind, T.ArrayType):
        value = F.array(_seeded(kind.elementType, draw, name, False))
    elif isinstance(kind, T.MapType):
        value = F.create_map(_seeded(kind.keyType, draw, "key", False), _seeded(kind.valueType, draw, name, False))
    elif isinstance(kind, T.StructType):
        value = F.struct(*[_seeded(f.dataType, F.xxhash64(draw, F.lit(f.name)), f.name, f.nullable).alias(f.name) for f in kind.fields])
    elif isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        value = (spread / 100).cast(kind)
    else:
        value = spread.try_cast(kind)
    return F.when(F.pmod(F.xxhash64(draw, F.lit("null")), F.lit(5)) != 0, value) if nullable else value


def synthetic(
    ids: DataFrame, schema: T.StructType, keys: Sequence[str], cursor: str | None = None, seed: int = 42, id_column: str = "id"
) -> DataFrame:
    """One row per id: unique keys, a cursor that grows with the id, every other value a seeded hash; a fifth of the
    optional values are null. Rows depend only on id and seed, so lost tasks come back the same."""
    n = F.col(id_column).cast("bigint")
    columns = []
    for field in schema.fields:
        kind, draw = field.dataType, F.xxhash64(n, F.lit(field.name), F.lit(seed))
        if field.name in keys:
            value = F.concat(F.lit(f"{field.name}_"), n.cast("string")) if isinstance(kind, T.StringType) else n.cast(kind)
        elif field.name == cursor:
            steps = F.timestamp_seconds(F.lit(1_704_067_200) + n)
            value = n.cast(kind) if isinstance(kind, T.NumericType) else steps.cast(kind)
        else:
            value = _seeded(kind, draw, field.name, field.nullable)
        columns.append(value.alias(field.name))
    return ids.select(*columns)


def with_future_rows(df: DataFrame, cursor: str, run_start: dt.datetime, order_by: Sequence[str], k: int) -> DataFrame:
    """``k`` rows again with a cursor past the moment a run began, to prove that a read stops there."""
    late = df.orderBy(*order_by).limit(k)
    shifted = late.withColumn(cursor, literal(run_start + dt.timedelta(hours=1), df.schema[cursor].dataType))
    return df.unionByName(shifted)
