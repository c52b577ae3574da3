"""Streams into slowly changing tables, as a log of batches that is merged when read.

A target is a ``batchlog``: writing costs what the batch costs, not what the table costs, batches are merged by levels
while the stream runs, and a batch that is retried overwrites its own folder, so every batch counts exactly once. A
checkpoint counts its batches from the first number that was free in the target when it began, so a new checkpoint
continues the log. One stream at a time may write a target.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedweir.operators.changes import DELETED, row_hash, scd1, scd2
from feedweir.sources import batchlog
from feedweir.sources.sinks import _hadoop, current_version, read_target, write_target

# Seconds that merged folders of a log are kept for readers that planned before the merge.
KEEP_SECONDS = 24 * 3600
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_log(spark: SparkSession, target: str) -> DataFrame:
    """All batches of a target, tombstones included."""
    rows = batchlog.read(spark, target)
    if rows is None:
        raise FileNotFoundError(f"nothing written to {target} yet")
    return rows


def _first_number(spark: SparkSession, target: str, checkpoint: str) -> int:
    """The number of a checkpoint's first batch in the target, kept beside the checkpoint's own files."""
    fs, path = _hadoop(spark, checkpoint)
    kept = path(f"{checkpoint}/first_numbers")
    if fs.exists(kept):
        return int(next(s.getPath().getName() for s in fs.listStatus(kept)))
    newest = batchlog.last_batch(spark, target)
    first = 0 if newest is None else newest + 1
    fs.mkdirs(path(f"{checkpoint}/first_numbers/{first}"))
    return first


def _marked(feed: DataFrame, deletes: DataFrame | None) -> DataFrame:
    rows = feed.withColumn(DELETED, F.lit(False))
    return rows if deletes is None else rows.unionByName(deletes.withColumn(DELETED, F.lit(True)), allowMissingColumns=True)


def _log_stream(rows: DataFrame, target: str, checkpoint: str, reduce: batchlog.Reduce, keep_seconds: float) -> StreamingQuery:
    """Every batch is reduced, written and merged with its neighbours once there are enough of one level."""
    first = _first_number(rows.sparkSession, target, checkpoint)

    def save(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batchlog.write(reduce(batch), target, first + number)
        batchlog.merge(spark, target, reduce)
        batchlog.trim(spark, target, keep_seconds)

    writer = rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stream_scd1(
    feed: DataFrame,
    target: str,
    keys: Sequence[str],
    seq: str,
    checkpoint: str,
    deletes: DataFrame | None = None,
    tiebreak: Sequence[str] = (),
    keep_seconds: float = KEEP_SECONDS,
) -> StreamingQuery:
    """Feed (and delete feed) into a type 1 table; every batch is reduced to one row per key before it is written."""
    return _log_stream(
        _marked(feed, deletes),
        target,
        checkpoint,
        lambda b: scd1(b, keys, seq, tiebreak=tiebreak, keep_deleted=True),
        keep_seconds,
    )


def read_scd1(spark: SparkSession, target: str, keys: Sequence[str], seq: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Current rows of a streamed type 1 table."""
    return scd1(read_log(spark, target), keys, seq, tiebreak=tiebreak)


def stream_scd2(
    feed: DataFrame,
    target: str,
    keys: Sequence[str],
    seq: str,
    checkpoint: str,
    deletes: DataFrame | None = None,
    tiebreak: Sequence[str] = (),
    keep_seconds: float = KEEP_SECONDS,
) -> StreamingQuery:
    """Feed into a type 2 table; a batch keeps one row per key and sequence value, late ones included."""
    return _log_stream(
        _marked(feed, deletes),
        target,
        checkpoint,
        lambda b: scd1(b, [*keys, seq], seq, tiebreak=tiebreak, keep_deleted=True),
        keep_seconds,
    )


def read_scd2(
    spark: SparkSession,
    target: str,
    keys: Sequence[str],
    seq: str,
    track: Sequence[str] | None = None,
    tiebreak: Sequence[str] = (),
    split: Column | None = None,
) -> DataFrame:
    """History of a streamed type 2 table."""
    return scd2(read_log(spark, target), keys, seq, track=track, tiebreak=tiebreak, split=split)


def compact(spark: SparkSession, target: str, keys: Sequence[str], seq: str, tiebreak: Sequence[str] = ()) -> int | None:
    """Merge everything up to the newest batch into one folder and return that batch's number.

    ``keys`` are the table's keys for type 1, keys and sequence for type 2. Tombstones stay, so an older row that
    arrives later still loses to them. A running stream merges by levels by itself; this is for tables at rest.
    """
    batchlog.merge(spark, target, lambda b: scd1(b, keys, seq, tiebreak=tiebreak, keep_deleted=True), whole=True)
    return batchlog.last_batch(spark, target)


def stream_append(feed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rows as they come; the file sink's own log makes a retried batch count once."""
    writer = feed.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def run_to_end(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Wait until everything that was there at the start is processed; errors of the stream are raised."""
    if timeout is not None and not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
    query.awaitTermination()
    return query


def _with_state_store(spark: SparkSession) -> None:
    """State that is kept per key and written as changes needs the store that does so."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class _Watermark(StatefulProcessor):
    """Of the rows of a key, those newer than the key's newest row of earlier batches."""

    def __init__(self, schema: T.StructType, cursor: str) -> None:
        # names that begin with an underscore do not reach the rows
        self.names, self.cursor, self.kind = schema.names, cursor, schema[cursor].dataType

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", T.StructType([T.StructField("cursor", self.kind)]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        since = self.newest.get()[0] if self.newest.exists() else None
        newest = since
        for part in rows:
            batch = part.set_axis(self.names, axis=1)
            known = batch[self.cursor].dropna()
            top = known.max() if len(known) else None
            if top is not None and (newest is None or top > newest):
                newest = top
            yield batch if since is None else batch[batch[self.cursor] > since]
        if newest is not None and newest != since:
            self._keep(newest)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        self._keep(initialState.iloc[0, -1])

    def _keep(self, newest) -> None:
        plain = newest.to_pydatetime() if isinstance(newest, pd.Timestamp) else getattr(newest, "item", lambda: newest)()
        self.newest.update((plain,))

    def close(self) -> None:
        pass


def stream_watermarks(
    feed: DataFrame, out: str, key: str, cursor: str, checkpoint: str, before: DataFrame | None = None, keep_seconds: float = KEEP_SECONDS
) -> StreamingQuery:
    """Rows newer than their own key's newest row of earlier batches, as a log of batches in ``out``.

    The newest cursors are values of a state store: a batch reads and writes the state of its own keys only, and a
    retried batch starts from the state before it. All rows of a key's first batch are delivered, those with a null
    cursor too; later on, rows without a cursor are not newer than anything. A new checkpoint starts from ``before``,
    what ``newest_per_key`` says of the checkpoint it follows.
    """
    _with_state_store(feed.sparkSession)
    known = None if before is None else before.where("cursor is not null").groupBy(key)
    kept = feed.groupBy(key).transformWithStateInPandas(
        _Watermark(feed.schema, cursor), feed.schema, "Append", "None", initialState=known
    )
    return _log_stream(kept, out, checkpoint, lambda b: b, keep_seconds)


def newest_per_key(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows (key columns, cursor) of the state that ``stream_watermarks`` has kept."""
    state = spark.read.format("statestore").option("stateVarName", "newest").load(checkpoint)
    return state.select("key.*", F.col("value.cursor").alias("cursor"))


class _Delivered(StatefulProcessor):
    """One row per content within the delay after the row delivered last; what is older is forgotten.

    What a key has delivered is one value, read once and written once a batch, and a key with such a value has one timer:
    every access to the store is a call out of the worker. Keys come with few rows each, so rows are taken as they are; a
    frame per key would cost more than its rows.
    """

    def __init__(self, names: list[str], delay: int) -> None:
        # names that begin with an underscore do not reach the rows
        self.row, self.delay = Row(*names), delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "digests array<bigint>, untils array<bigint>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        """Rows end with their digest and their time in microseconds."""
        held = self.until.get()
        keep, known = [], dict(zip(*held)) if held is not None else {}
        for row in sorted(rows, key=lambda r: r[-1]):
            digest, at = row[-2:]
            until = known.get(digest)
            if until is None or at >= until:
                keep.append(self.row(*row[:-2]))
                known[digest] = at + self.delay
        if keep:
            self._keep(known, timerValues, timed=held is not None)
        return iter(keep)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        """What was delivered the delay ago, by the watermark, may come again and need not be known."""
        held = self.until.get()
        if held is not None and not self._keep(dict(zip(*held)), timerValues, timed=False):
            self.until.clear()
        return iter(())

    def _keep(self, known: dict[int, int], timerValues, timed: bool) -> bool:  # noqa: N803
        """Write what the watermark has not passed, with a timer for its end unless there is one already."""
        now = 1000 * timerValues.getCurrentWatermarkInMs()
        left = {digest: until for digest, until in known.items() if until > now}
        if left or timed:
            self.until.update((list(left), list(left.values())))
        if left and not timed:
            self.handle.registerTimer(-(-max(left.values()) // 1000))
        return bool(left)

    def close(self) -> None:
        pass


def stream_dedup(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Rows of a stream without those that repeat a delivered row of their key in all columns but ``ts``.

    A row comes again when ``delay`` has passed since it was delivered. Within a batch, rows are taken in order of
    ``ts``; a batch may bring rows up to ``delay`` older than the newest one before. State older than that leaves the
    store by timers, so it holds what one delay delivers, not the stream.
    """
    spark = df.sparkSession
    _with_state_store(spark)
    micros = spark.sql(f"SELECT unix_micros(TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL '{delay}')").first()[0]
    content = [c for c in df.columns if c != ts]
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    # a row without a time comes before all others
    at = F.coalesce(F.unix_micros(F.col(ts)), F.lit(-(2**63)))
    marked = timed.select("*", row_hash(df, content).alias("__digest"), at.alias("__at"))
    return marked.groupBy(*keys).transformWithState(_Delivered(timed.columns, micros), timed.schema, "Append", "EventTime")


def stream_windows(
    df: DataFrame,
    ts: str,
    width: str | None = None,
    slide: str | None = None,
    gap: str | None = None,
    keys: Sequence[str] = (),
    metrics: Sequence[Column] = (),
    delay: str = "0 seconds",
) -> DataFrame:
    """Tumbling, sliding or session windows on event time; works on batches and streams alike."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    timed = timed.withWatermark(ts, delay) if df.isStreaming else timed
    frame = F.session_window(ts, gap) if gap else F.window(ts, width, slide) if slide else F.window(ts, width)
    counted = timed.groupBy(frame.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), *metrics)
    rest = [c for c in counted.columns if c != "w"]
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def stream_snapshot(spark: SparkSession, read, target: str, checkpoint: str, interval: str = "1 minute", once: bool = False) -> StreamingQuery:
    """Read a whole table again at every trigger and keep it as the newest version of ``target``."""

    def save(_: DataFrame, number: int) -> None:
        write_target(read(spark), target, number)

    writer = spark.readStream.format("rate").option("rowsPerSecond", 1).load().writeStream.foreachBatch(save)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.trigger(processingTime=interval).start()


def stop_after_snapshot(running: StreamingQuery, spark: SparkSession, target: str, timeout: float | None = None) -> None:
    """Wait for the first whole version that ``running`` writes, then stop it; errors of the stream are raised.

    New triggers come for as long as the stream runs, so there is no end of what is available to wait for: a read that
    takes longer than the interval would be repeated for ever. A version broken off by the stop is never read.
    """
    before, begin = current_version(spark, target), time.monotonic()
    while running.isActive and current_version(spark, target) == before:
        if timeout is not None and time.monotonic() - begin > timeout:
            running.stop()
            raise TimeoutError(f"no snapshot after {timeout} s")
        running.awaitTermination(0.2)
    running.stop()
    if running.exception() is not None:
        raise running.exception()


def newest_snapshot(spark: SparkSession, target: str) -> DataFrame | None:
    """What the last trigger of ``stream_snapshot`` read."""
    return read_target(spark, target)

