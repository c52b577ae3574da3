"""Streams against their batch forms, retries, compaction, and the ingest loop."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from feedweir.operators import changes as C
from feedweir.operators import joins, reports, timeseries
from feedweir.plans import extensions
from feedweir.plans.ingest import apply_flow, flow_of, ingest, ingested, load_table, undelivered
from feedweir.sources import batchlog, readers, sinks
from feedweir.streaming import tables as Z

FEED = [("a", 1, "x"), ("b", 1, "x"), ("a", 3, "y"), ("a", 2, "late"), ("c", 2, "z"), ("c", 2, "z")]
SCHEMA = "k string, seq bigint, v string"


@pytest.fixture
def files(spark, tmp_path):
    """The feed as three files, so that a stream takes three batches."""
    for i in range(3):
        spark.createDataFrame(FEED[2 * i : 2 * i + 2], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def stream(spark, path):
    return readers.read_stream(spark, path, spark.read.parquet(path).schema, max_files=1)


def test_scd1_stream_equals_batch(spark, rows, files, tmp_path):
    gone_path = str(tmp_path / "gone")
    spark.createDataFrame([("b", 5), ("c", 1)], "k string, seq bigint").write.parquet(gone_path)
    want = rows(C.scd1(spark.read.parquet(files), ["k"], "seq", deletes=spark.read.parquet(gone_path)))
    out = str(tmp_path / "t")
    for _ in range(2):  # the second run finds nothing new
        query = Z.stream_scd1(stream(spark, files), out, ["k"], "seq", out + "-log", deletes=stream(spark, gone_path))
        Z.run_to_end(query, 120)
        assert rows(Z.read_scd1(spark, out, ["k"], "seq").select("k", "seq", "v")) == want
    Z.compact(spark, out, ["k"], "seq")
    assert rows(Z.read_scd1(spark, out, ["k"], "seq").select("k", "seq", "v")) == want
    # An older row that arrives after compaction still loses to the tombstone.
    spark.createDataFrame([("b", 4, "zombie")], SCHEMA).write.mode("append").parquet(files)
    Z.run_to_end(Z.stream_scd1(stream(spark, files), out, ["k"], "seq", out + "-log", deletes=stream(spark, gone_path)), 120)
    assert rows(Z.read_scd1(spark, out, ["k"], "seq").select("k", "seq", "v")) == want


@pytest.mark.parametrize("compacted", [False, True])
def test_new_checkpoint_continues_the_log(spark, rows, files, tmp_path, compacted):
    out, more = str(tmp_path / "t"), str(tmp_path / "more")
    Z.run_to_end(Z.stream_scd1(stream(spark, files), out, ["k"], "seq", out + "-log"), 120)
    if compacted:
        Z.compact(spark, out, ["k"], "seq")
    spark.createDataFrame([("d", 1, "new"), ("a", 9, "newer")], SCHEMA).write.parquet(more)
    want = rows(C.scd1(spark.read.parquet(files, more), ["k"], "seq"))
    for _ in range(2):
        Z.run_to_end(Z.stream_scd1(stream(spark, more), out, ["k"], "seq", out + "-log2"), 120)
        assert rows(Z.read_scd1(spark, out, ["k"], "seq").select("k", "seq", "v")) == want


def test_new_checkpoint_keeps_watermarks(spark, rows, files, tmp_path):
    out, known = str(tmp_path / "w"), None
    for log in ("-log", "-log2"):
        Z.run_to_end(Z.stream_watermarks(stream(spark, files), out, "k", "seq", out + log, before=known), 120)
        known = Z.newest_per_key(spark, out + log)
        assert rows(known) == [("a", 3), ("b", 1), ("c", 2)]
    # the second checkpoint read all files again and delivered nothing
    assert batchlog.last_batch(spark, out) >= 3
    assert rows(Z.read_log(spark, out)) == sorted(FEED)


def test_scd2_stream_equals_batch(spark, rows, files, tmp_path):
    want = rows(C.scd2(spark.read.parquet(files), ["k"], "seq"))
    out = str(tmp_path / "t")
    Z.run_to_end(Z.stream_scd2(stream(spark, files), out, ["k"], "seq", out + "-log"), 120)
    found = Z.read_scd2(spark, out, ["k"], "seq", track=["v"])
    assert rows(found.select("k", "seq", "v", C.START, C.END)) == want


def test_unfinished_batch_is_not_read(spark, tmp_path):
    out = str(tmp_path / "t")
    spark.createDataFrame([("a", 1, "x", False)], SCHEMA + ", _deleted boolean").write.parquet(out + "/log/0-0")
    spark.createDataFrame([("a", 9, "half", False)], SCHEMA + ", _deleted boolean").write.parquet(out + "/log/1-1")
    (tmp_path / "t" / "log" / "1-1" / "_SUCCESS").unlink()
    assert Z.read_scd1(spark, out, ["k"], "seq").first()["v"] == "x"


def test_levels(spark, rows, tmp_path):
    """The folders that are read grow with the logarithm of the batches, and a reader that planned before stays whole."""
    out, kept, planned = str(tmp_path / "t"), {}, []
    for n in range(22):
        batch = [(f"k{(n * i) % 5}", n, f"v{n}", n % 7 == 3) for i in range(3)]
        for k, seq, v, gone in batch:
            kept[k] = (k, seq, v, gone)
        df = spark.createDataFrame(batch, SCHEMA + ", _deleted boolean").dropDuplicates().coalesce(1)
        batchlog.write(df, out, n)
        planned.append((batchlog.read(spark, out), {r for r in kept.values() if not r[3]}))
        holds = batchlog.merge(spark, out, lambda log: C.scd1(log, ["k"], "seq", keep_deleted=True))
        assert len(holds) <= 3 * (1 + n.bit_length() / 2) and holds[-1].last == n
        assert {tuple(r) for r in Z.read_scd1(spark, out, ["k"], "seq").select("k", "seq", "v").collect()} == {
            r[:3] for r in kept.values() if not r[3]
        }
    assert batchlog.trim(spark, out, 3600) == 0
    old, want = planned[14]
    assert {tuple(r) for r in C.scd1(old, ["k"], "seq").select("k", "seq", "v").collect()} == {r[:3] for r in want}
    before = rows(Z.read_scd1(spark, out, ["k"], "seq"))
    assert batchlog.trim(spark, out, 0) == 24 and len(batchlog.folders(spark, out)) == len(holds)
    assert rows(Z.read_scd1(spark, out, ["k"], "seq")) == before
    assert Z.compact(spark, out, ["k"], "seq") == 21 and batchlog.cover(batchlog.folders(spark, out))[0].first == 0
    assert rows(Z.read_scd1(spark, out, ["k"], "seq")) == before


def test_cover():
    folder = batchlog.Folder
    found = [folder(0, 0), folder(0, 3), folder(1, 1), folder(2, 2), folder(3, 3), folder(4, 4), folder(6, 6)]
    assert batchlog.cover(found) == [folder(0, 3), folder(4, 4), folder(6, 6)]
    assert batchlog.cover(found, 2) == [folder(0, 0), folder(1, 1), folder(2, 2)]
    assert [folder(0, n - 1).level for n in (1, 3, 4, 15, 16, 64)] == [0, 0, 1, 1, 2, 3]


def test_dedup_forgets_after_the_delay(spark, rows, tmp_path):
    """A row comes again when the delay has passed since it was delivered, within a batch and between batches."""
    day = dt.datetime(2024, 1, 1)
    batches = [
        [("a", 0, "x"), ("a", 1, "x"), ("a", 1, "y"), ("b", 2, "x")],
        [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "x"), ("a", 4, "x"), ("b", 4, "x"), ("b", 4, "x")],
        [("a", 9, "x"), ("a", 9, "y"), ("a", 11, "x"), ("a", 12, "x")],
        [("c", 30, "x")],
        [("a", 31, "x")],
    ]
    schema = "k string, ts timestamp, v string"
    for batch in batches:
        part = [(k, day + dt.timedelta(days=d), v) for k, d, v in batch]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    found = Z.stream_dedup(stream(spark, str(tmp_path / "in")), ["k"], "ts", "3 days")
    Z.run_to_end(Z.stream_append(found, out, out + "-log"), 240)
    got = sorted((r["k"], (r["ts"] - day).days, r["v"]) for r in spark.read.parquet(out).collect())
    again = [("a", 0, "x"), ("a", 1, "y"), ("a", 3, "x"), ("a", 9, "x"), ("a", 9, "y"), ("a", 12, "x"), ("a", 31, "x")]
    assert got == [*again, ("b", 2, "x"), ("c", 30, "x")]
    left = spark.read.format("statestore").option("stateVarName", "until").load(out + "-log")
    assert {r[0] for r in left.select("key.k").distinct().collect()} <= {"a", "c"}


def test_snapshot_slower_than_its_interval(spark, rows, tmp_path):
    """A read that takes longer than the interval never catches up with its triggers; the first whole version is enough."""
    out = str(tmp_path / "s")

    def read(session):
        time.sleep(1.5)
        return session.range(5)

    running = Z.stream_snapshot(spark, read, out, out + "-log", interval="1 second")
    Z.stop_after_snapshot(running, spark, out, 120)
    assert not running.isActive and rows(Z.newest_snapshot(spark, out)) == [(i,) for i in range(5)]
    failing = Z.stream_snapshot(spark, lambda session: session.range(5).select("nothing"), out + "2", out + "2-log", interval="1 second")
    with pytest.raises(Exception, match="nothing"):
        Z.stop_after_snapshot(failing, spark, out + "2", 120)


def test_append_takes_each_file_once(spark, rows, files, tmp_path):
    out = str(tmp_path / "a")
    for _ in range(2):
        Z.run_to_end(Z.stream_append(stream(spark, files), out, out + "-log"), 120)
    assert rows(spark.read.parquet(out)) == rows(spark.read.parquet(files))


def test_key_watermarks_drop_late_rows(spark, rows, files, tmp_path):
    out = str(tmp_path / "w")
    spark.createDataFrame([("d", None, "undated"), ("a", None, "undated")], SCHEMA).coalesce(1).write.mode("append").parquet(files)
    Z.run_to_end(Z.stream_watermarks(stream(spark, files), out, "k", "seq", out + "-log"), 120)
    assert rows(Z.newest_per_key(spark, out + "-log")) == [("a", 3), ("b", 1), ("c", 2)]
    assert rows(Z.read_log(spark, out)) == sorted([*FEED, ("d", None, "undated")], key=repr)


def test_flow_rules():
    meta = {"primary_keys": ["id"], "cursor_field": "c", "ingestion_type": "snapshot"}
    entry = {"source_table": "t", "destination_catalog": "c", "destination_schema": "s"}
    assert flow_of(entry, meta).destination == "`c`.`s`.`t`" and flow_of(entry, meta).scd_type == "1"
    config = {"primary_keys": "k", "sequence_by": "s", "scd_type": "SCD_TYPE_2", "cluster_by": "a,b", "window": "5"}
    flow = flow_of({"source_table": "t", "table_configuration": config}, {})
    assert (flow.kind, flow.keys, flow.sequence, flow.scd_type, flow.cluster_by, flow.options) == ("cdc", ["k"], "s", "2", ["a", "b"], {"window": "5"})
    assert flow_of({"source_table": "t", "table_configuration": {"scd_type": "append_only"}}, meta).kind == "append"
    with pytest.raises(ValueError):
        flow_of({"source_table": "t"}, {})
    with pytest.raises(ValueError):
        flow_of({"source_table": "t"}, {"ingestion_type": "mirror"})


def test_ingest_loop(spark, rows, tmp_path):
    tables = {
        "cdc": spark.createDataFrame(FEED, SCHEMA),
        "snap": spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"),
        "log": spark.createDataFrame([(1,), (1,)], "n int"),
    }
    metadata = {
        "cdc": {"primary_keys": ["k"], "cursor_field": "seq", "ingestion_type": "cdc_with_deletes"},
        "snap": {"primary_keys": ["id"], "ingestion_type": "snapshot"},
        "log": {"ingestion_type": "append"},
    }
    spec = {"objects": [{"table": {"source_table": n}} for n in tables]}
    spec["objects"][1]["table"]["table_configuration"] = {"scd_type": "SCD_TYPE_2"}

    def read(_, name, __):
        return tables[name]

    def read_deletes(_, __, ___):
        return spark.createDataFrame([("a", 9)], "k string, seq bigint")

    ingest(spark, spec, metadata, read, read_deletes, str(tmp_path))
    tables["snap"] = spark.createDataFrame([(1, "x2")], "id int, v string")
    landed = ingest(spark, spec, metadata, read, read_deletes, str(tmp_path))
    assert rows(ingested(spark, landed["cdc"])) == [("b", 1, "x"), ("c", 2, "z")]
    assert rows(ingested(spark, landed["snap"])) == [(1, "x", 1, 2), (1, "x2", 2, None), (2, "y", 1, 2)]
    assert ingested(spark, landed["log"]).count() == 2


@pytest.mark.parametrize("cursor", ["c", None])
def test_append_delivers_late_tied_and_repeated_rows(spark, rows, tmp_path, cursor):
    feed = [(5, "a"), (5, "a"), (7, "b"), (None, "n")]
    metadata = {"log": {"ingestion_type": "append"} | ({"cursor_field": cursor} if cursor else {})}
    spec = {"objects": [{"table": {"source_table": "log"}}]}

    def load():
        df = spark.createDataFrame(feed, "c int, v string")
        landed = ingest(spark, spec, metadata, lambda *_: df, None, str(tmp_path))
        return rows(ingested(spark, landed["log"]))

    assert load() == sorted(feed, key=repr)
    # tied with the newest, older than it, equal to delivered rows, and null cursors; then nothing new
    feed += [(7, "tied"), (6, "late"), (5, "a"), (7, "b"), (7, "b"), (None, "n"), (None, "m"), (8, "new"), (8, "new")]
    assert load() == sorted(feed, key=repr)
    assert load() == sorted(feed, key=repr)


LOADS = [
    [("a", 1, "x"), ("b", 1, "x"), ("c", None, "undated")],
    [("a", 3, "y"), ("b", 1, "tied"), ("a", 2, "late"), ("d", 3, "p")],
    [("d", 3, "p"), ("e", 4, "q"), ("c", None, "undated"), ("b", 0, "older")],
]


def config_of(kind, scd, lookback):
    entry = {"source_table": "t", "table_configuration": {"scd_type": scd} | ({} if lookback is None else {"lookback": lookback})}
    return flow_of(entry, {"primary_keys": ["k"], "cursor_field": "seq", "ingestion_type": kind})


@pytest.mark.parametrize("scd", ["SCD_TYPE_1", "SCD_TYPE_2", "APPEND_ONLY"])
@pytest.mark.parametrize("lookback", [None, 100])
def test_loads_in_steps_equal_one_load(spark, rows, tmp_path, scd, lookback):
    """Late, tied, repeated and undated rows; a load that breaks off; a load without news."""
    flow = config_of("cdc_with_deletes", scd, lookback)
    gone = spark.createDataFrame([("a", 3), ("zz", 1)], "k string, seq bigint")
    steps, once = str(tmp_path / "steps"), str(tmp_path / "once")

    def feed(upto):
        return spark.createDataFrame([r for load in LOADS[:upto] for r in load], SCHEMA)

    def broken():
        raise InterruptedError

    assert load_table(spark, flow, feed(1), None, steps) == 3
    with pytest.raises(InterruptedError):
        load_table(spark, flow, feed(2), gone, steps, before_commit=broken)
    first = rows(ingested(spark, steps).select("k", "seq", "v"))
    assert first == rows(feed(1))
    assert load_table(spark, flow, feed(2), gone, steps) > 0
    assert load_table(spark, flow, feed(3), gone, steps) > 0
    files = sorted(p for p in (tmp_path / "steps").rglob("*"))
    assert load_table(spark, flow, feed(3), gone, steps) == 0
    assert sorted(p for p in (tmp_path / "steps").rglob("*")) == files
    load_table(spark, flow, feed(3), gone, once)
    assert rows(ingested(spark, steps)) == rows(ingested(spark, once))
    if scd != "APPEND_ONLY":
        batch = C.scd1 if scd == "SCD_TYPE_1" else C.scd2
        assert rows(ingested(spark, steps)) == rows(batch(feed(3), ["k"], "seq", deletes=gone))
    else:
        assert rows(ingested(spark, steps)) == rows(feed(3))


@pytest.mark.parametrize("scd", ["SCD_TYPE_1", "SCD_TYPE_2"])
def test_snapshot_loads(spark, rows, tmp_path, scd):
    flow, out = config_of("snapshot", scd, None), str(tmp_path / "t")
    snaps = [[("a", 1, "x"), ("b", 1, "x")], [("a", 1, "x"), ("b", 1, "x")], [("b", 2, "y"), ("c", 1, None)], [("a", 1, "x"), ("c", 1, None)]]
    counts = [load_table(spark, flow, spark.createDataFrame(s, SCHEMA), None, out) for s in snaps]
    assert counts == [2, 0, 3, 2]
    if scd == "SCD_TYPE_1":
        assert rows(ingested(spark, out)) == rows(spark.createDataFrame(snaps[-1], SCHEMA))
    else:
        assert rows(ingested(spark, out)) == sorted(
            [("a", 1, "x", 1, 2), ("b", 1, "x", 1, 2), ("b", 2, "y", 2, 3), ("c", 1, None, 2, None), ("a", 1, "x", 3, None)], key=repr
        )


def test_many_loads_stay_few_folders(spark, rows, tmp_path):
    flow, out = config_of("cdc", "SCD_TYPE_1", 0), str(tmp_path / "t")
    feed = [(f"k{i % 4}", i, f"v{i}") for i in range(12)]
    for i in range(1, 13):
        load_table(spark, flow, spark.createDataFrame(feed[:i], SCHEMA), None, out, keep_seconds=0)
    assert len(batchlog.folders(spark, out)) <= 6 and rows(ingested(spark, out)) == sorted(feed[8:])


def test_append_with_a_new_column(spark, rows):
    """Copies of a delivered row that differ in a column the target lacks: as many as are missing."""
    target = spark.createDataFrame([(1,), (1,)], "n int")
    feed = spark.createDataFrame([(1, "x"), (1, "y"), (1, "z"), (2, "p"), (2, "p")], "n int, w string")
    got = rows(undelivered(feed, target))
    assert got[1:] == [(2, "p"), (2, "p")] and got[0] in [(1, "x"), (1, "y"), (1, "z")]


def test_snapshot_flow_type_1(spark, rows):
    flow = flow_of({"source_table": "t"}, {"primary_keys": ["id"], "ingestion_type": "snapshot"})
    before = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    after = spark.createDataFrame([(2, "z"), (3, "w")], "id int, v string")
    assert rows(apply_flow(flow, after, target=before)) == rows(after)


def test_operations(spark):
    @extensions.operation("count_rows", {"n": True, "note": False}, "id bigint", "metadata")
    def _(session, n, note=None):
        return session.range(n)

    assert extensions.run_operation(spark, "count_rows", n=3).count() == 3
    with pytest.raises(ValueError):
        extensions.run_operation(spark, "count_rows")
    with pytest.raises(ValueError):
        extensions.run_operation(spark, "no such thing")

    @extensions.operation("wrong", {}, "id string")
    def _(session):
        return session.range(1)

    with pytest.raises(TypeError):
        extensions.run_operation(spark, "wrong")


def test_custom_reader(spark, rows):
    def plan(options):
        return [{"from": i * 10} for i in range(int(options["pieces"]))]

    def read(options, piece):
        for i in range(3):
            yield (piece["from"] + i, options["label"])

    extensions.register_reader(spark, "pieces", "n int, label string", plan, read)
    found = spark.read.format("pieces").option("pieces", "2").option("label", "x").load()
    assert set(rows(found)) == {(n, "x") for n in (0, 1, 2, 10, 11, 12)}


def test_materialize(spark, rows):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id int, v string")
    assert rows(sinks.materialize(df, "feedweir_materialized", "id")) == rows(df)
    spark.sql("DROP TABLE feedweir_materialized")


# ---------------------------------------------------------------- time series and reports


def test_interpolation_outside_and_on_points(spark):
    day = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("t", day, 0.0), ("t", day + dt.timedelta(hours=2), 4.0)], "tag string, ts timestamp_ntz, value double")
    asked = [("t", day + dt.timedelta(hours=h)) for h in (-1, 0, 1, 2, 3)] + [("other", day)]
    times = spark.createDataFrame(asked, "tag string, query_time timestamp_ntz")
    found = timeseries.value_at(df, times).orderBy("tag", "query_time").collect()
    assert [r["value"] for r in found] == [None, None, 0.0, 2.0, 4.0, None]


def test_grid_of_a_year_by_the_second(spark):
    """No array holds more than a block of steps, and the steps of one tag come from many tasks."""
    tags, start = spark.createDataFrame([("t",)], "tag string"), dt.datetime(2024, 1, 1)
    found = timeseries.grid(tags, start, start + dt.timedelta(days=366), 1)
    times = F.approx_count_distinct("query_time").alias("d")
    r = found.agg(F.count("*").alias("n"), F.min("query_time").alias("a"), F.max("query_time").alias("b"), times).first()
    assert (r["n"], r["a"], r["b"]) == (366 * 86400 + 1, start, start + dt.timedelta(days=366)) and abs(r["d"] / r["n"] - 1) < 0.1
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert timeseries.grid(tags, start, start - dt.timedelta(days=1), 1).count() == 0
    few = timeseries.grid(tags, start, start + dt.timedelta(seconds=10), 3).collect()
    assert sorted(x["query_time"].second for x in few) == [0, 3, 6, 9]


def test_time_weighted_bins_carry_values(spark, rows):
    day = dt.datetime(2024, 1, 1)
    data = [("t", day - dt.timedelta(hours=5), 2.0), ("t", day + dt.timedelta(minutes=30), 4.0)]
    df = spark.createDataFrame(data, "tag string, ts timestamp_ntz, value double")
    found = timeseries.summary(df, day, day + dt.timedelta(hours=2), ["Average", "Total", "Count"]).orderBy("ts", "summary_type")
    assert [(r["ts"].hour, r["summary_type"], r["value"]) for r in found.collect()] == [
        (0, "Average", 3.0), (0, "Count", 1.0), (0, "Total", 10800.0), (1, "Average", 4.0), (1, "Count", 0.0), (1, "Total", 14400.0)
    ]
    with pytest.raises(ValueError):
        timeseries.summary(df, day, day, ["Median"])


def test_relative_times():
    now = dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc)
    parse = timeseries.parse_relative_time
    assert parse("*", now) == parse(None, now) == parse("*-xm", now) == parse("soon", now) == now
    assert parse("*-10m", now) == now - dt.timedelta(minutes=10) and parse("*-7d", now) == now - dt.timedelta(days=7)
    assert parse("2024-01-01T02:00:00+02:00", now) == dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    start, end = timeseries.time_range(None, {"lookback_minutes": "30"}, now)
    assert (start, end) == (now - dt.timedelta(minutes=30), now)
    start, end = timeseries.time_range(now, {}, now, now - dt.timedelta(hours=1))
    assert start == end == now - dt.timedelta(hours=1)


def test_asof_prefers_equal_time(spark, rows):
    day = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, "k", day), (2, "k", day - dt.timedelta(days=1)), (3, None, day)], "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame([("k", day, 1.0), ("k", day - dt.timedelta(hours=1), 2.0)], "k string, t timestamp_ntz, v double")
    assert rows(joins.asof(left, right, "t", ["k"], ["v"]).select("id", "v")) == [(1, 1.0), (2, None), (3, None)]


def test_report_limits(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="unknown dimensions"):
        reports.report(df, ["a", "zz"], {"n": F.count(F.lit(1))}, available_dims=["a", "b"])
    many = {f"d{i}": F.col("a") for i in range(10)}
    assert reports.report(df, many, {"n": F.count(F.lit(1))}).count() == 1
    with pytest.raises(ValueError, match="at most 9 dimensions"):
        reports.report(df, many, {"n": F.count(F.lit(1))}, max_dimensions=9)


def test_batch_session_window(spark, rows):
    day = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("u", day), ("u", day + dt.timedelta(minutes=5)), ("u", day + dt.timedelta(hours=3))], "user string, ts timestamp_ntz")
    assert [r["n"] for r in Z.stream_windows(df, "ts", gap="30 minutes", keys=["user"]).orderBy("window_start").collect()] == [2, 1]
    assert rows(reports.sessions(df, "user", "ts", 1800)) == [("u", day, day + dt.timedelta(minutes=5)), ("u", day + dt.timedelta(hours=3), day + dt.timedelta(hours=3))]
