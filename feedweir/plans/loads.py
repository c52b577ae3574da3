"""Queries over incremental loads: tables filled in steps, with late rows, broken loads and loads without news."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweir.plans.ingest import Flow, flow_of, ingested, load_table
from feedweir.plans.registry import query, table
from feedweir.session import checkpoint_dir
from feedweir.sources import batchlog


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _flow(source: str, kind: str, scd: str, keys: list[str], cursor: str | None, **config: object) -> Flow:
    entry = {"source_table": source, "table_configuration": {"scd_type": scd, **config}}
    return flow_of(entry, {"primary_keys": keys, "cursor_field": cursor, "ingestion_type": kind})


class _Broken(Exception):
    """A load that ends between its last file and its commit."""


def _break() -> None:
    raise _Broken


def events_until(spark: SparkSession, d: str, day: int) -> tuple[DataFrame, DataFrame]:
    """What a source has of the events after ``day`` days: rows, and errors as deletes. Every tenth comes a week late."""
    rows = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    came = F.dayofmonth("ts") + F.when(F.col("event_id") % 10 == 0, 7).otherwise(0)
    there = rows.filter(came <= day) if day < 40 else rows
    gone = there.filter("event_type = 'error'").select("user_id", "ts")
    return there.filter("event_type <> 'error'"), gone


def _in_steps(spark: SparkSession, d: str, flow: Flow, deletes: bool) -> str:
    """Four loads, the second of which breaks off at first, and a fifth without news."""
    target = _folder(spark, flow.source)
    for step, day in enumerate((8, 16, 24, 40, 40)):
        feed, gone = events_until(spark, d, day)
        if step == 1:
            try:
                load_table(spark, flow, feed, gone if deletes else None, target, before_commit=_break)
            except _Broken:
                pass
        load_table(spark, flow, feed, gone if deletes else None, target)
    return target


@query(
    "ingest_two_steps",
    "O-09",
    "O-03",
    "O-01",
    sql="""
SELECT user_id, ts, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1 AND event_type <> 'error'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """A type 1 table with a delete feed, filled in steps."""
    flow = _flow("events1", "cdc_with_deletes", "SCD_TYPE_1", ["user_id"], "ts")
    return ingested(spark, _in_steps(spark, d, flow, True))


@query(
    "ingest_history_steps",
    "O-09",
    "O-02",
    "O-04",
    sql="""
WITH states AS (
    SELECT user_id, ts, event_id, event_type, value, event_type = 'error' AS gone,
        lag(event_type = 'error') OVER w AS was_gone FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), opening AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS next_ts FROM states WHERE NOT gone OR NOT was_gone)
SELECT user_id, ts, event_id, event_type, value, ts AS "__START_AT", next_ts AS "__END_AT" FROM opening WHERE NOT gone
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """The history of the same feed; a load reads 30 days back, which no row is late by."""
    flow = _flow("events2", "cdc_with_deletes", "SCD_TYPE_2", ["user_id"], "ts", lookback=30 * 86400)
    return ingested(spark, _in_steps(spark, d, flow, True))


@query(
    "ingest_append_steps",
    "O-08",
    "O-118",
    sql="SELECT user_id, ts, event_id, event_type, value FROM events WHERE event_type <> 'error'",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """An append takes late rows too, each of them once."""
    flow = _flow("events3", "append", "APPEND_ONLY", [], "ts", lookback=30 * 86400)
    return ingested(spark, _in_steps(spark, d, flow, False))


@query(
    "ingest_snapshot_steps",
    "O-05",
    "O-06",
    "O-09",
    sql="""
SELECT c_custkey, c_name, c_acctbal, 1 AS "__START_AT", CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN 2 END AS "__END_AT" FROM customer
UNION ALL SELECT c_custkey, c_name, c_acctbal + 1, 2, NULL FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 = 0
UNION ALL SELECT c_custkey, c_name, c_acctbal, 3, NULL FROM customer WHERE c_custkey % 5 = 0
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots: the same one twice (one load), one with rows gone and changed, one with the gone rows back."""
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    raised = F.col("c_acctbal") + F.when(F.col("c_custkey") % 7 == 0, 1).otherwise(0)
    changed = rows.withColumn("c_acctbal", F.when(F.col("c_custkey") % 5 == 0, F.col("c_acctbal")).otherwise(raised).cast(rows.schema["c_acctbal"].dataType))
    flow, target = _flow("customer", "snapshot", "SCD_TYPE_2", ["c_custkey"], None), _folder(spark, "customer")
    for snapshot in (rows, rows, changed.filter("c_custkey % 5 <> 0"), changed):
        load_table(spark, flow, snapshot, None, target)
    return ingested(spark, target)


@query(
    "ingest_unchanged",
    "O-09",
    "O-144",
    sql="""
SELECT 'append' AS kind, count(*) AS rows, 1 AS loads, true AS same_files FROM events
UNION ALL SELECT 'history', count(*), 1, true FROM events
UNION ALL SELECT 'newest', count(DISTINCT user_id), 1, true FROM events
UNION ALL SELECT 'snapshot', count(*), 1, true FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """A second load of an unchanged feed adds no row and no file, whatever the table is."""
    feed = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    flows = {
        "append": _flow("a", "append", "APPEND_ONLY", [], "ts"),
        "history": _flow("h", "cdc", "SCD_TYPE_2", ["user_id"], "ts"),
        "newest": _flow("n", "cdc", "SCD_TYPE_1", ["user_id"], "ts"),
        "snapshot": _flow("s", "snapshot", "SCD_TYPE_1", ["event_id"], None),
    }
    out = None
    for kind, flow in flows.items():
        target = _folder(spark, kind)
        load_table(spark, flow, feed, None, target)
        before = batchlog.folders(spark, target)
        again = load_table(spark, flow, feed, None, target)
        same = again == 0 and batchlog.folders(spark, target) == before
        counted = ingested(spark, target).agg(F.count("*").alias("rows")).select(
            F.lit(kind).alias("kind"), "rows", F.lit(batchlog.last_done(spark, target)).alias("loads"), F.lit(same).alias("same_files")
        )
        out = counted if out is None else out.unionByName(counted)
    return out
