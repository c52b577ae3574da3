"""From a plain specification to tables: which operator a source table goes through, and where it lands.

Loads are incremental. What a load is going to read is noted before it, what it has read after it, and a table is a
log of changes (``sources.batchlog``): a load adds the rows that are news and rewrites none. A load that broke off is
repeated with the bounds it had noted, over its own files, so nothing is lost or delivered twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from feedweir.operators.changes import DELETED, END, START, cluster_columns, extend_history, scd1, scd2, snapshot_diff
from feedweir.operators.changes import row_hash as short_hash
from feedweir.operators.ordering import block_of
from feedweir.operators.slicing import row_hash
from feedweir.sources import batchlog
from feedweir.sources.catalog import INGESTION_TYPES, table_name

# Options of a table's configuration that steer the load and are not passed to the reader.
RESERVED = ("primary_keys", "sequence_by", "scd_type", "cluster_by", "lookback")
SCD_TYPES = ("SCD_TYPE_1", "SCD_TYPE_2", "APPEND_ONLY")
# The load that a change came with, in the log of a snapshot table.
LOAD = "__load"


@dataclass(frozen=True)
class Flow:
    """How one source table is ingested."""

    source: str
    destination: str
    kind: str
    keys: list[str]
    sequence: str | None
    scd_type: str
    with_deletes: bool
    cluster_by: list[str] | None
    lookback: float | None = None
    options: dict[str, str] = field(default_factory=dict)


def _names(value: object) -> list[str] | None:
    if value is None:
        return None
    return [str(v) for v in value] if isinstance(value, (list, tuple)) else [str(value)]


def flow_of(entry: Mapping[str, object], metadata: Mapping[str, object]) -> Flow:
    """Keys and sequence of the specification win over the table's metadata; a missing type is a change feed;
    ``APPEND_ONLY`` makes it an append; history is type 1 unless type 2 is asked for."""
    config = dict(entry.get("table_configuration") or {})
    scd = str(config.get("scd_type") or "SCD_TYPE_1").upper()
    if scd not in SCD_TYPES:
        raise ValueError(f"scd_type must be one of {', '.join(SCD_TYPES)}")
    kind = "append" if scd == "APPEND_ONLY" else str(metadata.get("ingestion_type") or "cdc")
    if kind not in INGESTION_TYPES:
        raise ValueError(f"unknown ingestion type {kind}")
    source = str(entry["source_table"])
    keys = _names(config.get("primary_keys")) or list(metadata.get("primary_keys") or [])
    sequence = config.get("sequence_by") or metadata.get("cursor_field")
    if kind != "append" and not keys:
        raise ValueError(f"{source}: a {kind} table needs primary keys")
    if kind.startswith("cdc") and not sequence:
        raise ValueError(f"{source}: a change feed needs a sequence column")
    return Flow(
        source=source,
        destination=table_name(
            source, entry.get("destination_catalog"), entry.get("destination_schema"), entry.get("destination_table")
        ),
        kind=kind,
        keys=keys,
        sequence=None if sequence is None else str(sequence),
        scd_type="2" if scd == "SCD_TYPE_2" else "1",
        with_deletes=kind == "cdc_with_deletes",
        cluster_by=cluster_columns(config.get("cluster_by")),
        lookback=None if config.get("lookback") is None else float(config["lookback"]),
        options={k: str(v) for k, v in config.items() if k not in RESERVED},
    )


def undelivered(feed: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of an append feed, read whole, that the target does not hold: its multiset difference by whole-row hash.

    Of rows that are equal in the columns both have, as many copies are returned as the target lacks, whenever they
    come and whatever their cursor is: late rows, rows tied with delivered ones and repeated rows all arrive.
    """
    names = [c for c in feed.columns if c in target.columns]
    have = target.select(row_hash(target, names).alias("__seen")).groupBy("__seen").agg(F.count("*").alias("__have"))
    hashed = feed.withColumn("__seen", row_hash(feed, names))
    want = hashed.groupBy("__seen").agg(F.count("*").alias("__want")).join(have, "__seen", "left")
    want = want.withColumn("__have", F.coalesce("__have", F.lit(0))).where(F.col("__want") > F.col("__have"))
    lacking = hashed.join(want.drop("__want"), "__seen")
    fresh = lacking.where(F.col("__have") == 0).select(*feed.columns)
    # Copies of delivered rows: one row per hash, or per row that differs in columns the target does not have.
    rows = lacking.where(F.col("__have") > 0).withColumn("__row", row_hash(feed))
    held = F.first(F.struct(*feed.columns)).alias("__held")
    rows = rows.groupBy("__seen", "__row").agg(held, F.first("__have").alias("__have"), F.count("*").alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy("__seen").orderBy("__row"))
    copies = F.least(F.col("__n"), upto - F.col("__have"))
    rows = rows.withColumn("__copies", copies).where(F.col("__copies") > 0)
    rows = rows.select("__held", F.explode(F.sequence(F.lit(1).cast("long"), "__copies")))
    return fresh.unionByName(rows.select("__held.*"))


def apply_flow(
    flow: Flow,
    feed: DataFrame,
    deletes: DataFrame | None = None,
    target: DataFrame | None = None,
    version: object = 0,
    split: Column | None = None,
) -> DataFrame:
    """The table after this load."""
    if flow.kind == "append":
        if target is not None:
            feed = undelivered(feed, target)
        return feed if target is None else target.unionByName(feed, allowMissingColumns=True)
    if flow.kind == "snapshot":
        if flow.scd_type == "2":
            if target is None:
                first = F.lit(version)
                return feed.withColumns({START: first, END: F.lit(None).cast(feed.select(first).schema[0].dataType)})
            return extend_history(target, feed, flow.keys, version)
        return feed
    removed = deletes if flow.with_deletes else None
    if flow.scd_type == "2":
        return scd2(feed, flow.keys, flow.sequence, deletes=removed, split=split)
    return scd1(feed, flow.keys, flow.sequence, deletes=removed)


Reader = Callable[[SparkSession, str, Mapping[str, str]], DataFrame]


def _after(df: DataFrame, flow: Flow, since: str | None) -> DataFrame:
    """Rows that a load has to look at: those without a cursor, and those from ``since`` less the lookback on."""
    if since is None or flow.sequence is None or flow.lookback is None:
        return df
    kind = df.schema[flow.sequence].dataType
    bound = F.lit(since).cast(kind)
    if flow.lookback and kind.typeName() in ("timestamp", "timestamp_ntz", "date"):
        bound = (bound.cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(flow.lookback).cast("decimal(18,6)"))).cast(kind)
    elif flow.lookback:
        bound = (bound - F.lit(flow.lookback)).cast(kind)
    return df.where((F.col(flow.sequence) >= bound) | F.col(flow.sequence).isNull())


def _until(df: DataFrame, flow: Flow, until: str | None) -> DataFrame:
    if until is None or flow.sequence is None:
        return df
    limit = F.lit(until).cast(df.schema[flow.sequence].dataType)
    return df.where((F.col(flow.sequence) <= limit) | F.col(flow.sequence).isNull())


def _identity(flow: Flow) -> tuple[list[str], str]:
    """The columns that tell the rows of a table's log apart, and the one whose greatest value wins."""
    if flow.kind == "snapshot":
        return (flow.keys if flow.scd_type == "1" else [*flow.keys, LOAD]), LOAD
    return (flow.keys if flow.scd_type == "1" else [*flow.keys, flow.sequence]), str(flow.sequence)


def _reduced(flow: Flow, rows: DataFrame) -> DataFrame:
    """The rows of a log that can still matter; all rows of an append."""
    if flow.kind == "append":
        return rows
    keys, seq = _identity(flow)
    return scd1(rows, keys, seq, keep_deleted=True)


def news(candidates: DataFrame, known: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Of reduced ``candidates``, the rows that win against what the log ``known`` has for their keys."""

    def rank(df: DataFrame) -> Column:
        return F.struct(
            F.col(seq).isNotNull().alias("dated"), F.col(seq).alias("at"), F.col(DELETED).alias("gone"),
            short_hash(df, sorted(c for c in df.columns if c != DELETED)).alias("tie"),
        )

    shared = [c for c in known.columns if c in candidates.columns]
    best = known.select(*shared).withColumn("__rank", rank(known.select(*shared)))
    best = best.groupBy(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(F.max("__rank").alias("__rank"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{i}"))
    mine = rank(candidates.select(*shared))
    both = candidates.withColumn("__mine", mine).join(best, same, "left")
    return both.where(F.col("__rank").isNull() | (F.col("__mine") > F.col("__rank"))).select(*candidates.columns)


def changes_of(flow: Flow, feed: DataFrame, deletes: DataFrame | None, log: DataFrame | None, load: int, since: str | None) -> DataFrame:
    """What a load adds to a table's log."""
    if flow.kind == "append":
        return feed if log is None else undelivered(feed, _after(log, flow, since))
    if flow.kind == "snapshot":
        if log is None:
            return feed.withColumns({DELETED: F.lit(False), LOAD: F.lit(load)})
        current = scd1(log, flow.keys, LOAD).drop(LOAD)
        held = [c for c in feed.columns if c in current.columns]
        added = {c: F.lit(None).cast(feed.schema[c].dataType) for c in feed.columns if c not in held}
        moved = snapshot_diff(current.select(*held).withColumns(added), feed, flow.keys).where("_change <> 'unchanged'")
        return moved.withColumns({DELETED: F.col("_change") == "delete", LOAD: F.lit(load)}).drop("_change")
    rows = feed.withColumn(DELETED, F.lit(False))
    if deletes is not None:
        rows = rows.unionByName(deletes.withColumn(DELETED, F.lit(True)), allowMissingColumns=True)
    keys, seq = _identity(flow)
    candidates = scd1(rows, keys, seq, keep_deleted=True)
    return candidates if log is None else news(candidates, log, keys, seq)


def table_of(flow: Flow, log: DataFrame, split: Column | None = None) -> DataFrame:
    """The table that a log of changes stands for."""
    if flow.kind == "append":
        return log
    seq = _identity(flow)[1]
    if flow.scd_type == "1":
        table = scd1(log, flow.keys, seq)
        return table.drop(LOAD) if flow.kind == "snapshot" else table
    split = block_of(log, seq) if split is None else split
    tracked = [c for c in log.columns if c not in {*flow.keys, seq, DELETED}]
    history = scd2(log, flow.keys, seq, track=tracked, split=split)
    return history.drop(LOAD) if flow.kind == "snapshot" else history


def ingested(spark: SparkSession, target: str, split: Column | None = None) -> DataFrame:
    """A table that ``ingest`` has loaded, as of its newest finished load."""
    done = batchlog.last_done(spark, target)
    if done is None:
        raise FileNotFoundError(f"nothing loaded into {target} yet")
    flow = Flow(**batchlog.noted(spark, target, done, "done")["flow"])
    return table_of(flow, batchlog.read(spark, target, done), split)


def _cursor_of(flow: Flow, feeds: list[DataFrame], since: str | None) -> str | None:
    """The newest cursor of the feeds, never older than the one before; None without a cursor column."""
    if flow.sequence is None or flow.kind == "snapshot":
        return None
    tops = None
    for df in feeds:
        top = df.agg(F.max(flow.sequence).alias("top"))
        tops = top if tops is None else tops.unionByName(top)
    if since is not None:
        kind = tops.schema["top"].dataType
        tops = tops.unionByName(feeds[0].sparkSession.range(1).select(F.lit(since).cast(kind).alias("top")))
    return tops.agg(F.max("top").cast("string")).first()[0]


def load_table(
    spark: SparkSession,
    flow: Flow,
    feed: DataFrame,
    deletes: DataFrame | None,
    target: str,
    keep_seconds: float = 24 * 3600,
    before_commit: Callable[[], None] = lambda: None,
) -> int:
    """One load of a table: note the bounds, write the news, note that it is done. Returns the rows that were added.

    With ``lookback`` (seconds, or units of a number cursor) only rows from the stored cursor less that are read;
    without one the feed is read whole, so rows may come as late as they like. Either way nothing but news is written,
    and a load without news leaves no file.
    """
    done = batchlog.last_done(spark, target)
    state = {} if done is None else batchlog.noted(spark, target, done, "done")
    load, since = (0 if done is None else done) + 1, state.get("cursor")
    feeds = [_after(df, flow, since) for df in (feed, deletes) if df is not None]
    plan = batchlog.noted(spark, target, load, "planned")
    if plan is None:
        plan = {"since": since, "until": _cursor_of(flow, feeds, since), "begun": time.time()}
        batchlog.note(spark, target, load, "planned", plan)
    feeds = [_until(df, flow, plan["until"]) for df in feeds]
    log = None if done is None else batchlog.read(spark, target, done)
    added = changes_of(flow, feeds[0], feeds[1] if len(feeds) > 1 else None, log, load, since)
    if flow.cluster_by:
        added = added.repartitionByRange(*flow.cluster_by).sortWithinPartitions(*flow.cluster_by)
    counted = Observation(f"load {load}")
    batchlog.write(added.observe(counted, F.count(F.lit(1)).alias("rows")), target, load)
    rows = counted.get["rows"]
    if not rows and done is not None:
        batchlog.drop(spark, target, load)
        batchlog.forget(spark, target, load, "planned")
        return 0
    before_commit()
    note = {"cursor": plan["until"], "rows": rows, "since": since, "flow": asdict(flow)}
    batchlog.note(spark, target, load, "done", note)
    batchlog.merge(spark, target, lambda log: _reduced(flow, log), load)
    batchlog.trim(spark, target, keep_seconds)
    return rows


def ingest(
    spark: SparkSession,
    spec: Mapping[str, object],
    metadata: Mapping[str, Mapping[str, object]],
    read: Reader,
    read_deletes: Reader | None,
    warehouse: str,
) -> dict[str, str]:
    """Load the news of every table of a specification below ``warehouse``; the folder of each, for ``ingested``.

    The loop runs over table names; rows stay on the executors.
    """
    landed = {}
    for item in spec["objects"]:
        entry = item.get("table", item)
        flow = flow_of(entry, metadata.get(entry["source_table"], {}))
        feed = read(spark, flow.source, flow.options)
        deletes = read_deletes(spark, flow.source, flow.options) if flow.with_deletes and read_deletes else None
        target = f"{warehouse}/{flow.destination.replace('`', '').replace('.', '/')}"
        load_table(spark, flow, feed, deletes, target)
        landed[flow.source] = target
    return landed
