"""Streaming queries: each one runs a stream over a whole table to its end and returns what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedweir.operators.ordering import block_of
from feedweir.plans.registry import query, table
from feedweir.session import checkpoint_dir
from feedweir.sources import batchlog, readers, sinks
from feedweir.streaming import tables as Z


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


FILES = 3


def file_stream(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows written as several files in no order of time, read as a stream of one file per micro-batch.

    So every batch but the first brings rows older than some that were there before.
    """
    folder = _folder(spark, name)
    rows.repartition(FILES, "event_id").write.parquet(folder)
    return readers.read_stream(spark, folder, rows.schema, max_files=1)


def events_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream of several micro-batches."""
    return file_stream(spark, table(spark, d, "events"), "events")


EVENTS = "SELECT event_id, ts, user_id, event_type, value FROM events"
COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


@query("stream_append", "O-08", "O-18", "O-19", "O-35", "O-168", "O-169", "O-174", sql=EVENTS)
def _(spark: SparkSession, d: str) -> DataFrame:
    out = _folder(spark, "append")
    Z.run_to_end(Z.stream_append(events_stream(spark, d).select(*COLUMNS), out, out + "-log"))
    return spark.read.parquet(out)


@query(
    "stream_scd1_deletes",
    "O-166",
    sql="""
SELECT user_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1 AND event_type <> 'error'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    out = _folder(spark, "scd1")
    rows = events_stream(spark, d).select("user_id", "ts", "event_type", "value")
    feed = rows.filter("event_type <> 'error'")
    gone = rows.filter("event_type = 'error'").select("user_id", "ts")
    Z.run_to_end(Z.stream_scd1(feed, out, ["user_id"], "ts", out + "-log", deletes=gone))
    Z.compact(spark, out, ["user_id"], "ts")
    return Z.read_scd1(spark, out, ["user_id"], "ts").select("user_id", "ts", "event_type", "value")


@query("stream_overlapping_slices", "O-170", "O-18", "O-166", sql="SELECT event_id, ts, user_id, event_type, value FROM events")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Each read reaches two days back behind the one before; the merge takes every row once."""
    out, folder = _folder(spark, "slices"), _folder(spark, "slices-in")
    rows, day = table(spark, d, "events").select(*COLUMNS), F.dayofmonth("ts")
    for first, end in ((1, 11), (11, 21), (21, 32)):
        rows.filter((day >= first - 2) & (day < end)).coalesce(1).write.mode("append").parquet(folder)
    feed = readers.read_stream(spark, folder, rows.schema, max_files=1)
    Z.run_to_end(Z.stream_scd1(feed, out, ["event_id"], "ts", out + "-log"))
    return Z.read_scd1(spark, out, ["event_id"], "ts").select(*COLUMNS)


@query(
    "stream_scd2",
    "O-167",
    sql="""
WITH states AS (SELECT user_id, ts, event_type, lag(event_type) OVER w AS was FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
changes AS (SELECT * FROM states WHERE was IS NULL OR was <> event_type)
SELECT user_id, ts, event_type, ts AS "__START_AT", lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT" FROM changes
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    out = _folder(spark, "scd2")
    feed = events_stream(spark, d).select("user_id", "ts", "event_type")
    Z.run_to_end(Z.stream_scd2(feed, out, ["user_id"], "ts", out + "-log"))
    log = Z.read_log(spark, out)
    return Z.read_scd2(spark, out, ["user_id"], "ts", track=["event_type"], split=block_of(log, "ts", "day"))


def sliced_stream(spark: SparkSession, rows: DataFrame, name: str, slices: list[tuple[int, int]]) -> DataFrame:
    """Rows as a stream of one file per span of days (first, end) of the month; spans may overlap."""
    folder, day = _folder(spark, name), F.dayofmonth("ts")
    for first, end in slices:
        # the rows of a span become one file; the table is read by all tasks
        rows.filter((day >= first) & (day < end)).repartition(1).write.mode("append").parquet(folder)
    return readers.read_stream(spark, folder, rows.schema, max_files=1)


@query(
    "stream_dedup",
    "O-171",
    "O-120",
    sql="""
WITH RECURSIVE kept AS (
    SELECT user_id, event_type, min(ts) AS ts FROM events GROUP BY 1, 2
    UNION ALL
    SELECT k.user_id, k.event_type, min(e.ts) FROM kept k JOIN events e
    ON e.user_id = k.user_id AND e.event_type = k.event_type AND e.ts >= k.ts + INTERVAL 3 DAY
    GROUP BY k.user_id, k.event_type, k.ts
)
SELECT user_id, event_type, ts, count(*) OVER (PARTITION BY user_id, event_type) AS times FROM kept
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """A user's event is delivered again three days after it was, and not before; every read reaches two days back."""
    out = _folder(spark, "dedup")
    rows = table(spark, d, "events").select("user_id", "event_type", "ts")
    feed = sliced_stream(spark, rows, "dedup-in", [(1, 9), (7, 17), (15, 25), (23, 32)])
    Z.run_to_end(Z.stream_append(Z.stream_dedup(feed, ["user_id"], "ts", "3 days"), out, out + "-log"))
    times = F.count("*").over(Window.partitionBy("user_id", "event_type"))
    return spark.read.parquet(out).select("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), times.alias("times"))


@query(
    "stream_key_watermarks",
    "O-172",
    "O-132",
    sql="""
WITH batches AS (
    SELECT *, greatest(least((day(ts) - 1) // 8, 3), 0) AS batch FROM events
), known AS (
    SELECT *, max(ts) OVER (PARTITION BY user_id ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS since FROM batches
)
SELECT event_id, user_id, ts, max(ts) OVER (PARTITION BY user_id) AS cursor FROM known WHERE since IS NULL OR ts > since
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """Four batches, each of which reads all days before again: rows come once, and the state says the newest per user."""
    out = _folder(spark, "watermarks")
    rows = table(spark, d, "events").select("event_id", "user_id", "ts")
    feed = sliced_stream(spark, rows, "watermarks-in", [(1, 9), (1, 17), (1, 25), (1, 32)])
    Z.run_to_end(Z.stream_watermarks(feed, out, "user_id", "ts", out + "-state"))
    newest = Z.newest_per_key(spark, out + "-state")
    return Z.read_log(spark, out).join(newest, "user_id").select("event_id", "user_id", "ts", "cursor")


@query(
    "stream_levels",
    "O-166",
    "O-167",
    sql="""
SELECT o_custkey, max(o_orderkey) AS o_orderkey, count(*) OVER () AS customers, true AS few_folders, true AS whole_before
FROM orders GROUP BY o_custkey
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """A stream of 13 batches, merged by levels as it runs; what a reader planned before the trim reads the same."""
    out, folder = _folder(spark, "levels"), _folder(spark, "levels-in")
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    rows.repartition(13, "o_orderkey").write.parquet(folder)
    feed = readers.read_stream(spark, folder, rows.schema, max_files=1)
    Z.run_to_end(Z.stream_scd1(feed, out, ["o_custkey"], "o_orderkey", out + "-log"))
    planned = Z.read_scd1(spark, out, ["o_custkey"], "o_orderkey")
    before = planned.agg(F.count("*"), F.sum(F.xxhash64("o_custkey", "o_orderkey").cast("decimal(38,0)"))).first()
    held = batchlog.cover(batchlog.folders(spark, out))
    batchlog.trim(spark, out, 0)
    left = batchlog.folders(spark, out)
    now = Z.read_scd1(spark, out, ["o_custkey"], "o_orderkey")
    after = now.agg(F.count("*"), F.sum(F.xxhash64("o_custkey", "o_orderkey").cast("decimal(38,0)"))).first()
    return now.select(
        "o_custkey",
        "o_orderkey",
        F.lit(after[0]).cast("long").alias("customers"),
        F.lit(len(left) == len(held) <= 6 and left[-1].last == 12).alias("few_folders"),
        F.lit(before == after).alias("whole_before"),
    )


@query(
    "stream_windows",
    "O-173",
    sql="""
SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    out = _folder(spark, "windows")
    counted = Z.stream_windows(events_stream(spark, d), "ts", "6 hours", keys=["event_type"], delay="1 day")

    def save(batch: DataFrame, number: int) -> None:
        sinks.write_target(batch, out, number)

    # Complete mode: the last batch holds every window, also those the watermark has not closed.
    writer = counted.writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", out + "-log")
    Z.run_to_end(writer.trigger(availableNow=True).start())
    return sinks.read_target(spark, out).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query("stream_snapshot", "O-175", "O-143", sql="SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark: SparkSession, d: str) -> DataFrame:
    out = _folder(spark, "snapshot")

    def read(session: SparkSession) -> DataFrame:
        return table(session, d, "customer").select("c_custkey", "c_name", "c_acctbal")

    running = Z.stream_snapshot(spark, read, out, out + "-log", interval="1 second")
    Z.stop_after_snapshot(running, spark, out)
    return Z.newest_snapshot(spark, out)
