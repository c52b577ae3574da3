"""Queries over files: tables written out in other formats and read back with the readers for them."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.operators import slicing
from feedweir.plans.registry import query, table
from feedweir.session import checkpoint_dir, settle
from feedweir.sources import readers, sinks


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("json_event_files", "O-26", "O-28", sql="SELECT event_id, event_type, value FROM events WHERE event_id % 10 <> 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Zipped lines of JSON, every tenth cut off in the middle and some blank."""
    line = F.to_json(F.struct("event_id", "event_type", "value"))
    cut = F.when(F.col("event_id") % 10 == 3, F.substring(line, 1, 20)).otherwise(line)
    blank = F.when(F.col("event_id") % 7 == 0, "\n \n").otherwise("")
    folder = _folder(spark, "json")
    table(spark, d, "events").select(F.concat(cut, blank).alias("value")).write.option("compression", "gzip").text(folder)
    schema = T.StructType.fromDDL("event_id bigint, event_type string, value double")
    return readers.read_json_events(spark, folder, schema)


@query(
    "wrapped_event_files",
    "O-26",
    sql="SELECT event_id, event_type FROM events",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """Files that hold a list of records, or an object with the list under one of three names."""
    rows = table(spark, d, "events").select("user_id", F.struct("event_id", "event_type").alias("r"))
    lists = rows.groupBy("user_id").agg(F.to_json(F.collect_list("r")).alias("list"))
    name = F.element_at(F.array(*[F.lit(n) for n in ("events", "data", "records")]), (F.col("user_id") % 3 + 1).cast("int"))
    wrapped = F.when(F.col("user_id") % 4 == 0, F.col("list")).otherwise(F.concat(F.lit('{"'), name, F.lit('": '), F.col("list"), F.lit("}")))
    folder = _folder(spark, "wrapped")
    lists.select(wrapped.alias("value")).write.text(folder)
    schema = T.StructType.fromDDL("event_id bigint, event_type string")
    return readers.unwrap_events(spark.read.text(folder), "value", schema)


@query(
    "csv_report_files",
    "O-27",
    sql="""
SELECT o_orderkey::VARCHAR AS order_key, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS order_status,
    'Say "hi", ' || o_orderpriority AS the_priority FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """A report whose headers have capitals, blanks and a byte order mark, with empty cells and quoted commas."""
    folder = _folder(spark, "csv")
    status = F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    names = ["﻿Order Key", "Order Status", "The Priority"]
    rows = table(spark, d, "orders").select("o_orderkey", status, F.concat(F.lit('Say "hi", '), "o_orderpriority")).toDF(*names)
    rows.write.csv(folder, header=True, escape='"', emptyValue="")
    return readers.read_csv_report(spark, folder, escape='"')


@query(
    "metadata_documents",
    "O-32",
    sql="""
SELECT 'Part' || p_partkey AS entity, 'ID' AS property, 'bigint' AS kind, true AS is_key, false AS nullable FROM part
UNION ALL SELECT 'Part' || p_partkey, p_brand, CASE WHEN p_size > 30 THEN 'decimal(38,' || p_size % 10 || ')' ELSE 'decimal(' || p_size || ',0)' END, false, true FROM part
UNION ALL SELECT 'Part' || p_partkey, 'Made', 'timestamp', false, true FROM part
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """A document per brand with an entity type per part, its decimal facets out of the part's size."""
    size = F.col("p_size")
    facets = F.when(size > 30, F.format_string("Precision='40' Scale='%d'", size % 10)).otherwise(F.format_string("Precision='%d' Scale='0'", size))
    entity = F.concat(
        F.format_string("<EntityType Name='Part%d'><Key><PropertyRef Name='ID'/></Key>", "p_partkey"),
        F.lit("<Property Name='ID' Type='Edm.Int64' Nullable='false'/>"),
        F.format_string("<Property Name='%s' Type='Edm.Decimal' %s/>", "p_brand", facets),
        F.lit("<Property Name='Made' Type='Edm.DateTimeOffset'/></EntityType>"),
    )
    folder = _folder(spark, "edmx")
    schemas = table(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.collect_list(entity), "\n").alias("types"))
    document = F.concat(F.lit("<Edmx><Schema>"), "types", F.lit("</Schema></Edmx>"))
    schemas.select("p_brand", document.alias("value")).write.partitionBy("p_brand").text(folder)
    found = readers.read_edmx(spark, folder)
    kind = readers.edm_type(F.col("type"), F.col("precision"), F.col("scale"))
    return found.select("entity", "property", kind.alias("kind"), "is_key", "nullable")


@query(
    "materialized_table",
    "O-34",
    "O-14",
    sql="SELECT o_custkey, count(*) AS orders, true AS clustered FROM orders GROUP BY 1",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """A query's result kept as a table; its files hold ranges of the clustering column that do not overlap."""
    name = f"customer_orders_{uuid.uuid4().hex}"
    counted = table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    kept = sinks.materialize(counted, name, cluster_by=["o_custkey"])
    files = kept.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("o_custkey").alias("low"), F.max("o_custkey").alias("high"))
    # one row per file
    after = F.lead("low").over(Window.orderBy("low"))
    clustered = files.select(F.coalesce(F.col("high") < after, F.lit(True)).alias("ok")).agg(F.bool_and("ok").alias("ok")).scalar()
    rows = settle(kept.withColumn("clustered", clustered))
    spark.sql(f"DROP TABLE {name}")
    return rows


@query("filter_enforced", "O-137", sql="SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-10'")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a source that filters, behind a check that fails the job if none of them were newer."""
    since = dt.datetime(2024, 1, 10)
    rows = slicing.slice_after(table(spark, d, "events").select("event_id", "ts"), "ts", since)
    return slicing.assert_filter_honored(rows, F.col("ts"), since)
