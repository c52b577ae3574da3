"""Queries on incremental slicing, over the events, orders, lineitem and part tables."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweir.functions import cursors as K
from feedweir.functions.literals import literal
from feedweir.operators import reports as R
from feedweir.operators import slicing as S
from feedweir.operators.checks import with_future_rows
from feedweir.plans.registry import query, table
from feedweir.session import checkpoint_dir

SINCE = dt.datetime(2024, 1, 10)
RUN_START = dt.datetime(2024, 1, 20)
HOUR = "date_trunc('hour', ts)"
EVENTS = ["event_id", "ts", "user_id", "event_type", "value"]


def events(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return table(spark, d, "events").select(*(columns or EVENTS))


def hourly(spark: SparkSession, d: str) -> DataFrame:
    """Events with an hour as cursor, so that cursors tie."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("hour")
    return table(spark, d, "events").select("event_id", hour, "user_id")


HOURLY = "hourly AS (SELECT event_id, date_trunc('hour', ts) AS hour, user_id FROM events)"


# ---------------------------------------------------------------- plain bounds


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("slice_after", "O-114", sql="SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts > TIMESTAMP '2024-01-10'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.slice_after(events(spark, d), "ts", SINCE)


@query("slice_first_run", "O-114", sql="SELECT event_id, ts, user_id, event_type, value FROM events")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.slice_after(events(spark, d), "ts")


@query("slice_exclusive", "O-115", sql="SELECT event_id, hour, user_id FROM (SELECT event_id, date_trunc('hour', ts) AS hour, user_id FROM events) WHERE hour > TIMESTAMP '2024-01-10 05:00:00'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.exclusive_of(hourly(spark, d), "hour", dt.datetime(2024, 1, 10, 5))


@query("slice_from_revision", "O-115", sql="SELECT count(*) AS n, max(event_id) + 1 AS cursor FROM events WHERE event_id >= 400")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows, state = S.slice_from_revision(events(spark, d, "event_id"), "event_id", 400)
    return rows.agg(F.count(F.lit(1)).alias("n")).select("n", state.scalar().alias("cursor"))


@query(
    "run_start_ceiling",
    "O-116",
    sql="""
SELECT event_id, ts, least(TIMESTAMP '2024-01-20', (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '2024-01-20')) AS cursor
FROM events WHERE ts <= TIMESTAMP '2024-01-20'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows, state = S.cap_at_run_start(events(spark, d, "event_id", "ts"), "ts", RUN_START)
    return rows.withColumn("cursor", state.scalar())


@query(
    "watermark_never_back",
    "O-117",
    sql="SELECT greatest(max(ts), TIMESTAMP '2024-03-01') AS cursor FROM events WHERE ts > TIMESTAMP '2024-01-10'",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = S.slice_after(events(spark, d, "ts"), "ts", SINCE)
    return S.watermark(rows, "ts", dt.datetime(2024, 3, 1))


@query("lookback", "O-118", sql="SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-10' - INTERVAL 7200 SECOND")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.slice_after(events(spark, d, "event_id", "ts"), "ts", S.with_lookback(SINCE, 7200))


# Every day of events is a finished run; its duration is the average value of the day.
RUNS_SQL = "runs AS (SELECT ts::DATE AS run, avg(value) AS seconds FROM events GROUP BY 1)"


@query(
    "auto_lookback",
    "O-119",
    sql=f"""
WITH {RUNS_SQL}, recent AS (SELECT * FROM runs ORDER BY run DESC LIMIT 5)
SELECT round(coalesce(least(max(seconds) * 1.5, 3600.0), 0.0), 6) AS seconds FROM recent WHERE seconds > 0
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    runs = events(spark, d, "ts", "value").groupBy(F.col("ts").cast("date").alias("run")).agg(F.avg("value").alias("seconds"))
    return S.auto_lookback(runs).select(F.round("seconds", 6).alias("seconds"))


# The first half of January was delivered, but error rows have changed since then.
DELIVERED = "event_type <> 'error' AND ts < TIMESTAMP '2024-01-15'"


@query(
    "drop_delivered",
    "O-120", "O-162", "O-165",
    sql=f"SELECT event_id, ts, user_id, event_type, value FROM events WHERE NOT ({DELIVERED})",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d)
    before = rows.filter("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'").withColumn(
        "value", F.when(F.col("event_type") == "error", F.col("value") + 1).otherwise(F.col("value"))
    )
    seen = before.select(
        S.composite_key(F.col("event_id")).alias("row_key"), S.row_hash(before).alias("digest"), F.col("ts").alias("cursor")
    )
    return S.drop_delivered(rows, seen, ["event_id"], "ts")[0]


@query(
    "delivered_entries_cap",
    "O-120",
    sql="""SELECT '["' || event_id || '"]' AS row_key, ts AS cursor FROM events ORDER BY ts DESC LIMIT 50""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.drop_delivered(events(spark, d), None, ["event_id"], "ts", cap=50)[1].select("row_key", "cursor")


@query(
    "exclude_seen",
    "O-85",
    sql="SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    finished = rows.filter("o_orderstatus = 'F'")
    stale = rows.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    delivered = finished.unionByName(stale)
    seen = delivered.select(S.composite_key(F.col("o_orderkey")).alias("row_key"), S.row_hash(delivered).alias("digest"))
    return S.exclude_seen(rows, seen, ["o_orderkey"])


# ---------------------------------------------------------------- caps

CAP = 5000
_FIRST = f"""
WITH minutes AS (SELECT event_id, date_trunc('minute', ts) AS minute, user_id FROM events),
firsts AS (SELECT minute FROM minutes ORDER BY minute LIMIT {CAP}),
edge AS (SELECT max(minute) AS last, (SELECT count(*) FROM events) > {CAP} AS more FROM firsts)
"""


def by_minute(spark: SparkSession, d: str) -> DataFrame:
    """Events with a minute as cursor: it ties, but no minute outgrows the cap."""
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("minute")
    return table(spark, d, "events").select("event_id", minute, "user_id")


@query("batch_trim", "O-121", sql=f"{_FIRST} SELECT event_id, minute, user_id FROM minutes, edge WHERE minute < last OR NOT more")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.batch_trim(by_minute(spark, d), "minute", CAP)[0]


@query("batch_trim_state", "O-121", sql=f"{_FIRST} SELECT max(minute) AS cursor FROM minutes, edge WHERE minute < last OR NOT more")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.batch_trim(by_minute(spark, d), "minute", CAP)[1]


@query("batch_soft", "O-122", sql=f"{_FIRST} SELECT event_id, minute, user_id FROM minutes, edge WHERE minute <= last")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.batch_soft(by_minute(spark, d), "minute", CAP)[0]


@query("batch_unsorted", "O-124", sql=f"WITH {HOURLY} SELECT event_id, hour, user_id FROM hourly")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.batch_soft(hourly(spark, d), "hour", CAP, is_sorted=False)[0]


_LINES = """
WITH counts AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
running AS (SELECT *, sum(n) OVER (ORDER BY l_orderkey) - n AS before FROM counts),
taken AS (SELECT l_orderkey FROM running WHERE before < 1000)
"""


@query(
    "batch_whole_messages",
    "O-123",
    sql=f"{_LINES} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey IN (FROM taken)",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return S.batch_groups(rows, "l_orderkey", 1000)[0]


@query(
    "batch_keyset",
    "O-125",
    sql=f"""
WITH {HOURLY}
SELECT event_id, hour, user_id FROM hourly
WHERE hour > TIMESTAMP '2024-01-10 05:00:00' OR (hour = TIMESTAMP '2024-01-10 05:00:00' AND event_id > 100)
ORDER BY hour, event_id LIMIT 250
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.batch_keyset(hourly(spark, d), "hour", "event_id", 250, (dt.datetime(2024, 1, 10, 5), 100))[0]


@query(
    "early_exit",
    "O-126",
    sql="SELECT max(ts) >= TIMESTAMP '2024-06-01' AS has_news FROM events",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.has_news(events(spark, d, "ts"), "ts", dt.datetime(2024, 6, 1))


# ---------------------------------------------------------------- windows


@query(
    "slice_window",
    "O-127",
    sql="""
SELECT event_id, ts, TIMESTAMP '2024-01-11' AS cursor FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-11'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows, state = S.slice_window(events(spark, d, "event_id", "ts"), "ts", SINCE, 86_400, RUN_START)
    return rows.withColumn("cursor", state.scalar())


@query(
    "slice_window_capped",
    "O-127",
    sql="""
WITH inside AS (SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-18'),
firsts AS (SELECT * FROM inside ORDER BY ts LIMIT 150)
SELECT event_id, ts, (SELECT max(ts) FROM firsts) AS cursor FROM firsts
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows, state = S.slice_window(events(spark, d, "event_id", "ts"), "ts", SINCE, 8 * 86_400, RUN_START, cap=150)
    return rows.withColumn("cursor", state.scalar())


@query(
    "window_rules",
    "O-128",
    sql="""
SELECT count(*) FILTER (ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11 01:00:00') AS hourly,
       count(*) FILTER (ts::DATE BETWEEN DATE '2024-01-08' AND DATE '2024-01-16') AS daily FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    hours = S.hourly_bounds(SINCE, RUN_START)
    days = S.daily_bounds(SINCE.date(), RUN_START.date(), lookback_days=2)
    day = F.col("ts").cast("date")
    in_hours = (F.col("ts") >= literal(hours.start)) & (F.col("ts") < literal(hours.following))
    return events(spark, d, "ts").agg(
        F.count_if(in_hours).alias("hourly"), F.count_if(day.between(F.lit(days.start), F.lit(days.end))).alias("daily")
    )


@query(
    "windows_of_range",
    "O-129",
    sql="""
WITH w AS (
  SELECT TIMESTAMP '2024-01-03' + to_seconds(259200 * i) AS since,
         least(TIMESTAMP '2024-01-03' + to_seconds(259200 * (i + 1)), TIMESTAMP '2024-01-25') AS until
  FROM range(0, 8) t(i))
SELECT since, until, count(ts) AS n FROM w JOIN events ON ts > since AND ts <= until GROUP BY 1, 2
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    start, end, width = dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 25), dt.timedelta(days=3)
    rows = S.in_windows(events(spark, d, "ts"), "ts", start, end, width).groupBy("since", "until").agg(F.count("ts").alias("n"))
    return S.windows(spark, start, end, width).join(rows, ["since", "until"])


@query(
    "compact_windows",
    "O-194",
    sql="""
WITH w AS (
  SELECT event_id, ts, floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-10')) / 3600000000) AS n FROM events
  WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'),
c AS (SELECT n, count(*) AS k, sum(count(*)) OVER (ORDER BY n) AS through FROM w GROUP BY n),
taken AS (SELECT max(n) AS last FROM c WHERE through - k < 200)
SELECT event_id, ts, least(TIMESTAMP '2024-01-10' + to_hours((last + 1)::INT), TIMESTAMP '2024-01-20') AS cursor
FROM w, taken WHERE n <= last
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows, state = S.compact_windows(events(spark, d, "event_id", "ts"), "ts", SINCE, 3600, 200, RUN_START)
    return rows.withColumn("cursor", state.scalar())


@query(
    "batch_by_group",
    "O-195",
    sql="""
WITH counts AS (SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey > 3 GROUP BY 1),
running AS (SELECT *, sum(n) OVER (ORDER BY l_suppkey) - n AS before FROM counts)
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM lineitem
WHERE l_suppkey IN (SELECT l_suppkey FROM running WHERE before < 1500)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return S.batch_by_group(rows, "l_suppkey", 1500, after=3)[0]


@query(
    "day_chunks",
    "O-141",
    sql="""
WITH c AS (SELECT event_id, ts, floor(datediff('day', DATE '2024-01-02', ts::DATE) / 7) AS chunk FROM events
           WHERE ts >= TIMESTAMP '2024-01-02'),
n AS (SELECT chunk, count(*) AS k, sum(count(*)) OVER (ORDER BY chunk) AS through FROM c GROUP BY chunk),
taken AS (SELECT max(chunk) AS last FROM n WHERE through - k < 300)
SELECT event_id, ts, DATE '2024-01-02' + ((last + 1) * 7)::INT AS start_date FROM c, taken WHERE chunk <= last
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows, state = S.day_chunks(events(spark, d, "event_id", "ts"), "ts", dt.date(2024, 1, 2), 300)
    return rows.withColumn("start_date", state.scalar())


@query(
    "date_watermark",
    "O-139",
    sql="SELECT least(greatest(max(ts)::DATE, DATE '2024-01-15'), DATE '2024-01-28') AS cursor FROM events",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.date_watermark(events(spark, d, "ts"), "ts", dt.date(2024, 1, 15), dt.date(2024, 1, 28))


@query(
    "start_resolution",
    "O-140",
    sql="""
SELECT event_id, ts FROM events
WHERE ts > (SELECT date_trunc('second', min(ts)) - INTERVAL 1 SECOND FROM events) AND ts <= TIMESTAMP '2024-01-03'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d, "event_id", "ts")
    oldest = R.cursor_bounds(rows, "ts").first()["oldest"]
    begin = S.start_of(None, None, oldest, RUN_START)
    return S.slice_range(rows, "ts", begin, dt.datetime(2024, 1, 3))


# ---------------------------------------------------------------- per key, null cursors


@query(
    "slice_per_key",
    "O-132",
    sql="""
WITH state AS (SELECT user_id, max(ts) AS since FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type = 'click' GROUP BY 1)
SELECT e.event_id, e.ts, e.user_id FROM events e LEFT JOIN state s USING (user_id) WHERE since IS NULL OR ts > since
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    seen = rows.filter("event_type = 'click' AND ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    state = S.slice_per_key(seen, "user_id", "ts")[1]
    return S.slice_per_key(rows.drop("event_type"), "user_id", "ts", state)[0]


@query(
    "watermarks_per_key",
    "O-132",
    sql="SELECT user_id, greatest(max(ts), TIMESTAMP '2024-01-29') AS cursor FROM events GROUP BY user_id",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d, "user_id", "ts")
    state = rows.select("user_id").distinct().withColumn("cursor", literal(dt.datetime(2024, 1, 29)))
    return S.slice_per_key(rows, "user_id", "ts", state)[1]


def _gaps(spark: SparkSession, d: str) -> DataFrame:
    """Events whose cursor is missing on sign-up rows."""
    ts = F.when(F.col("event_type") != "signup", F.col("ts")).alias("ts")
    return table(spark, d, "events").select("event_id", "user_id", "event_type", ts)


_NULLED = "SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'signup' THEN ts END AS ts FROM events"


@query(
    "null_cursor_floor",
    "O-133", "O-134",
    sql=f"""
SELECT event_id, coalesce(ts, TIMESTAMP '2000-01-01' + to_microseconds(
  (('0x' || substr(sha1(event_id::VARCHAR), 1, 8))::BIGINT) % 1000000)) AS ts FROM ({_NULLED})
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.null_cursor(_gaps(spark, d), "ts", ["event_id"]).select("event_id", "ts")


@query("null_cursor_ignored", "O-133", sql=f"SELECT event_id, ts FROM ({_NULLED}) WHERE ts IS NOT NULL")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.null_cursor(_gaps(spark, d), "ts", policy="ignore").select("event_id", "ts")


@query(
    "unknown_cursor_kept",
    "O-138",
    sql=f"""
SELECT event_id, ts, (SELECT max(ts) FROM events WHERE event_type <> 'signup') AS cursor FROM ({_NULLED})
WHERE ts IS NULL OR ts > TIMESTAMP '2024-01-10'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows, state = S.slice_keep_unknown(_gaps(spark, d), F.col("ts"), SINCE)
    return rows.select("event_id", "ts").withColumn("cursor", state.scalar())


@query(
    "pk_ordinal",
    "O-134",
    sql="""
SELECT l_orderkey, l_linenumber, l_partkey,
       (('0x' || substr(sha1(concat_ws(chr(31), l_orderkey, l_linenumber)), 1, 8))::BIGINT) % 1000000 AS ordinal FROM lineitem
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return rows.withColumn("ordinal", K.pk_ordinal(F.col("l_orderkey"), F.col("l_linenumber")))


# The cursor is written differently by event type: with and without fraction, with an offset, or as a number.
_WRITTEN = """
written AS (
  SELECT event_id, ts, event_type,
    CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
                    WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
                    WHEN 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '00+00:00'
                    ELSE event_id::VARCHAR END AS cursor FROM events)
"""


def written(spark: SparkSession, d: str) -> DataFrame:
    """Events with their cursor as text in several writings."""
    kind, ts = F.col("event_type"), F.col("ts")
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(kind == "click", F.concat(micros, F.lit("Z")))
        .when(kind == "view", F.concat(seconds, F.lit("Z")))
        .when(kind == "error", F.concat(micros, F.lit("00+00:00")))
        .otherwise(F.col("event_id").cast("string"))
    )
    return table(spark, d, "events").select("event_id", "ts", "event_type", text.alias("cursor"))


@query(
    "cursor_order",
    "O-135",
    sql=f"""
WITH {_WRITTEN}
SELECT event_id, CASE WHEN event_type IN ('click', 'error') THEN epoch_us(ts)
                      WHEN event_type = 'view' THEN epoch_us(date_trunc('second', ts)) END AS micros,
       CASE WHEN event_type IN ('purchase', 'signup') THEN event_id::DOUBLE END AS number FROM written
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    key = K.cursor_key(F.col("cursor"))
    return written(spark, d).select("event_id", key["micros"].alias("micros"), key["number"].cast("double").alias("number"))


@query(
    "same_instant",
    "O-136",
    sql=f"""
WITH {_WRITTEN}
SELECT event_type, count(*) AS n, count(*) FILTER (event_type IN ('click', 'error') OR
   (event_type = 'view' AND ts = date_trunc('second', ts))) AS same FROM written GROUP BY 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    same = F.count_if(K.same_instant(F.col("cursor"), plain)).alias("same")
    return written(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), same)


@query(
    "mixed_families_kept",
    "O-136",
    sql=f"""
WITH {_WRITTEN}
SELECT event_id FROM written WHERE event_type IN ('purchase', 'signup')
   OR (CASE event_type WHEN 'view' THEN date_trunc('second', ts) ELSE ts END) > TIMESTAMP '2024-01-10'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    old = K.at_or_before(F.col("cursor"), F.lit("2024-01-10T00:00:00Z"))
    return written(spark, d).filter(~F.coalesce(old, F.lit(False))).select("event_id")


@query(
    "filter_honoured",
    "O-137",
    sql="""
SELECT count(ts) AS dated, count(*) FILTER (ts > TIMESTAMP '2024-06-01') AS newer,
       count(ts) = 0 OR count(*) FILTER (ts > TIMESTAMP '2024-06-01') > 0 AS honoured FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.filter_check(events(spark, d, "ts"), F.col("ts"), dt.datetime(2024, 6, 1))


# ---------------------------------------------------------------- splitting and order


@query(
    "split_even",
    "O-130",
    sql="SELECT o_orderkey, ntile(7) OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS part FROM orders",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return S.split_even(rows, 7, ["o_orderdate", "o_orderkey"]).select("o_orderkey", F.col("part").cast("bigint").alias("part"))


@query(
    "weighted_bins",
    "O-131",
    sql="""
WITH w AS (SELECT l_orderkey, count(*) AS weight FROM lineitem GROUP BY 1),
t AS (SELECT *, sum(weight) OVER (ORDER BY l_orderkey) AS through, sum(weight) OVER () AS total FROM w)
SELECT l_orderkey, weight, least(floor((through - weight / 2.0) * 6 / total), 5)::INT AS bin FROM t
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    weights = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("weight"))
    return S.pack(weights, "weight", 6, ["l_orderkey"])


@query(
    "least_loaded_bins",
    "O-131",
    sql="""
WITH RECURSIVE w AS (
    SELECT o_custkey, count(*) AS weight, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS place FROM orders GROUP BY 1
), placed AS (
    SELECT 0::BIGINT AS place, [0, 0, 0, 0, 0]::BIGINT[] AS loads, NULL::BIGINT AS o_custkey, NULL::BIGINT AS weight, -1::BIGINT AS bin
    UNION ALL
    SELECT w.place, [loads[i] + CASE WHEN i = list_position(loads, list_min(loads)) THEN w.weight ELSE 0 END FOR i IN [1, 2, 3, 4, 5]],
        w.o_custkey, w.weight, list_position(loads, list_min(loads)) - 1
    FROM placed p JOIN w ON w.place = p.place + 1
)
SELECT o_custkey, weight, bin::INT AS bin FROM placed WHERE place > 0
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """Customers by their number of orders, the largest first, each into the bin that holds least so far."""
    weights = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("weight"))
    return S.pack_least_loaded(weights, "weight", 5, ["o_custkey"])


@query(
    "page_loop",
    "O-145",
    "O-193",
    sql="""
SELECT event_id, ts, (row_number() OVER (ORDER BY ts, event_id) - 1) // 150 AS page, true AS few_files
FROM events WHERE ts <= TIMESTAMP '2024-01-20'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """All pages of a pinned range in one scan; each opens only the files that hold its rows."""
    span = S.slice_range(events(spark, d, "event_id", "ts"), "ts", None, RUN_START)
    held = S.sorted_files(span, ["ts", "event_id"], _folder(spark, "pages"))
    pages = held.pages(spark, 150)
    if pages is None:
        return span.limit(0).select("event_id", "ts", F.lit(0).cast("bigint").alias("page"), F.lit(True).alias("few_files"))
    # pages that share a file at their border open it both
    opened = pages.select("page", "file").distinct()
    few = opened.agg((F.count("*") <= F.max("page") + len(held.files)).alias("few")).scalar()
    return pages.withColumn("few_files", few).select("event_id", "ts", "page", "few_files")


@query(
    "batch_sequence",
    "O-142",
    sql="SELECT doc_id, row_number() OVER (ORDER BY doc_id) + (3::BIGINT << 40) AS _sequence FROM documents",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.with_sequence(table(spark, d, "documents").select("doc_id"), ["doc_id"], batch_id=3)


@query(
    "page_pinned",
    "O-193",
    sql="""
SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-20' ORDER BY ts, event_id LIMIT 200 OFFSET 100
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    state = {"until": RUN_START, "page": 2}
    return S.page_pinned(events(spark, d, "event_id", "ts"), "ts", "event_id", state, RUN_START, limit=100, cap=150)[0]


@query("page", "O-145", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 40 OFFSET 120")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.page(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 120, 40)


@query("snapshot_read_once", "O-143", sql="SELECT n_nationkey, n_name FROM nation WHERE false")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation").select("n_nationkey", "n_name")
    return S.once(rows, S.once(rows, None)[1])[0]


@query("progress_view", "O-144", sql="SELECT user_id, 1::BIGINT AS entries FROM events")
def _(spark: SparkSession, d: str) -> DataFrame:
    state = F.create_map(F.lit("cursor"), F.col("ts").cast("string"), F.lit("lb_history"), F.lit("[]"))
    kept = F.size(S.progress_map(state)).cast("bigint")
    return events(spark, d, "user_id", "ts").select("user_id", kept.alias("entries"))


@query("top_recent", "O-146", sql="SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 10")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.top_n(events(spark, d, "event_id", "ts", "event_type"), [F.col("ts").desc(), F.col("event_id")], 10)


@query("sort_nulls_last", "O-147", sql=f"SELECT event_id, ts FROM ({_NULLED}) ORDER BY ts ASC NULLS LAST, event_id")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.sort_nulls(_gaps(spark, d).select("event_id", "ts"), "ts", "asc", ["event_id"])


@query("sort_nulls_first", "O-147", sql=f"SELECT event_id, ts FROM ({_NULLED}) ORDER BY ts DESC NULLS FIRST, event_id")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.sort_nulls(_gaps(spark, d).select("event_id", "ts"), "ts", "desc", ["event_id"])


@query("total_order", "O-148", sql="SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.total_order(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", ["o_orderkey"])


@query(
    "future_rows",
    "O-186",
    sql="""
SELECT o_orderkey, o_orderdate FROM orders UNION ALL
(SELECT o_orderkey, TIMESTAMP '2024-01-20 01:00:00' FROM orders ORDER BY o_orderkey LIMIT 5)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return with_future_rows(rows, "o_orderdate", RUN_START, ["o_orderkey"], 5)


# ---------------------------------------------------------------- ties, nulls and loops


def by_day(spark: SparkSession, d: str) -> DataFrame:
    """Events with a day as cursor: every tie outgrows a cap of 10."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("day")
    return table(spark, d, "events").select("event_id", day)


_DAYS = "WITH days AS (SELECT event_id, date_trunc('day', ts) AS day FROM events)"


@query(
    "batch_trim_large_tie",
    "O-121",
    sql=f"{_DAYS} SELECT event_id, day, day AS cursor FROM days WHERE day = (SELECT min(day) FROM days)",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows, state = S.batch_trim(by_day(spark, d), "day", 10)
    return rows.withColumn("cursor", state.scalar())


@query(
    "slice_window_tie_at_start",
    "O-127",
    sql=f"{_DAYS} SELECT event_id, day, day AS cursor FROM days WHERE day = (SELECT min(day) FROM days WHERE day > TIMESTAMP '2024-01-10')",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows, state = S.slice_window(by_day(spark, d), "day", SINCE, 8 * 86_400, RUN_START, cap=10, closed=False)
    return rows.withColumn("cursor", state.scalar())


@query(
    "batch_null_group",
    "O-123",
    sql="""
WITH g AS (SELECT event_id, CASE WHEN user_id % 5 <> 0 THEN user_id END AS grp FROM events),
counts AS (SELECT grp, count(*) AS n FROM g WHERE grp IS NOT NULL GROUP BY 1),
running AS (SELECT grp, sum(n) OVER (ORDER BY grp) - n AS before FROM counts)
SELECT event_id, grp FROM g WHERE grp IS NULL OR grp IN (SELECT grp FROM running WHERE before < 100)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").selectExpr("event_id", "CASE WHEN user_id % 5 <> 0 THEN user_id END AS grp")
    return S.batch_groups(rows, "grp", 100)[0]


@query("batch_by_group_loop", "O-195", sql="SELECT s_nationkey, s_suppkey FROM supplier")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "supplier").select("s_nationkey", "s_suppkey")
    cap = max(1, rows.count() // 4)
    out, after = [], None
    while True:
        part, state = S.batch_by_group(rows, "s_nationkey", cap, after)
        reached = state.first()["cursor"]
        if reached is None:
            return reduce(DataFrame.unionByName, out)
        out.append(part)
        after = reached
