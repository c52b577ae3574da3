"""What tables there are, as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA = "tableName string, primary_keys array<string>, cursor_field string, ingestion_type string"
INGESTION_TYPES = ("snapshot", "cdc", "cdc_with_deletes", "append")


def catalog_metadata(
    spark: SparkSession, tables: Sequence[str], configs: Mapping[str, Mapping[str, object]]
) -> DataFrame:
    """Keys, cursor and ingestion type per table, in the order asked for. Rows are table names, not data."""
    rows = []
    for name in tables:
        config = configs.get(name)
        if config is None:
            raise ValueError(f"unknown table {name}; available: {', '.join(sorted(configs))}")
        rows.append((name, config.get("primary_keys"), config.get("cursor_field"), config.get("ingestion_type")))
    return spark.createDataFrame(rows, METADATA)


def list_namespaces(df: DataFrame, prefix: Sequence[str] = (), namespace: str = "namespace") -> DataFrame:
    """Namespaces one level below a prefix, each once, sorted."""
    depth = len(prefix)
    under = F.slice(namespace, 1, depth) == F.array(*[F.lit(p) for p in prefix]) if depth else F.lit(True)
    inside = df.filter((F.size(namespace) > depth) & under)
    return inside.select(F.slice(namespace, 1, depth + 1).alias("namespace")).distinct().orderBy("namespace")


def list_tables(df: DataFrame, namespace: Sequence[str], column: str = "namespace", name: str = "name") -> DataFrame:
    """Tables directly in a namespace, sorted."""
    here = F.col(column) == F.array(*[F.lit(p) for p in namespace]) if namespace else F.size(column) == 0
    return df.filter(here).select(column, name).distinct().orderBy(name)


def list_objects(df: DataFrame, search: str | None = None, name: str = "name") -> DataFrame:
    """Objects whose name matches a regular expression, ignoring case."""
    found = df.filter(F.col(name).rlike(f"(?i){search}")) if search else df
    return found.select(name).distinct().orderBy(name)


def object_metadata(df: DataFrame, key: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Columns other than ``keep`` as rows ``key, value``; nulls are left out; the key filter ignores case."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in df.columns if c not in keep]
    )
    rows = df.select(*keep, F.inline(pairs)).filter("value IS NOT NULL")
    return rows.filter(F.lower("key") == key.lower()) if key else rows


def table_name(table: str, catalog: str | None = None, schema: str | None = None, destination: str | None = None) -> str:
    """Full name when both catalog and schema are given, the bare table otherwise."""
    name = destination or table
    return name if catalog is None or schema is None else f"`{catalog}`.`{schema}`.`{name}`"


def metadata_problems(catalog: DataFrame, fields: DataFrame) -> DataFrame:
    """Tables that break the metadata rules, one row per problem.

    ``fields`` has ``tableName`` and ``columns`` (array of names). The type must be known, keys must exist in the
    schema, change feeds need keys, and all but snapshots and appends need a cursor that exists.
    """
    joined = catalog.join(fields, "tableName", "left")
    kind = F.coalesce("ingestion_type", F.lit("cdc"))
    needs_keys, needs_cursor = kind != "append", kind.isin("cdc", "cdc_with_deletes")
    no_keys = F.coalesce(F.size("primary_keys"), F.lit(0)) < 1
    lost = F.array_except(F.coalesce("primary_keys", F.array().cast("array<string>")), F.coalesce("columns", F.array().cast("array<string>")))
    rules: list[tuple[str, Column]] = [
        ("unknown ingestion type", ~kind.isin(*INGESTION_TYPES)),
        ("no primary keys", needs_keys & no_keys),
        ("key not in schema", F.size(lost) > 0),
        ("no cursor", needs_cursor & F.col("cursor_field").isNull()),
        ("cursor not in schema", F.col("cursor_field").isNotNull() & ~F.coalesce(F.array_contains("columns", F.col("cursor_field")), F.lit(False))),
    ]
    found = F.array_compact(F.array(*[F.when(test, F.lit(text)) for text, test in rules]))
    return joined.select("tableName", F.explode(found).alias("problem"))


def parse_table_list(text: str) -> list[str]:
    """Table names given as a JSON list."""
    names = json.loads(text)
    if not isinstance(names, list):
        raise ValueError("the table list must be a JSON array")
    return [str(n) for n in names]


def schemas_frame(spark: SparkSession, schemas: Iterable[tuple[str, T.StructType]]) -> DataFrame:
    """``tableName, columns`` of the given schemas."""
    return spark.createDataFrame([(n, s.names) for n, s in schemas], "tableName string, columns array<string>")
