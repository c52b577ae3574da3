"""Queries on joins, reports and time series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweir.functions.literals import literal
from feedweir.operators import joins as J
from feedweir.operators import reports as R
from feedweir.operators import timeseries as S
from feedweir.operators.ordering import block_of
from feedweir.plans.registry import query, table

START, END = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20)
RANGE = "ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'"


# ---------------------------------------------------------------- joins


@query(
    "messages_per_channel",
    "O-75",
    sql="""
SELECT n_name AS team_name, c_name AS channel_name, count(o_orderkey) AS message_count, max(o_orderdate) AS latest_message,
       min(o_orderdate) AS oldest_message
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON o_custkey = n_nationkey
GROUP BY 1, 2
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").withColumn("team_id", F.col("o_custkey").cast("int"))
    teams = table(spark, d, "nation").select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("name"))
    channels = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return J.channel_summary(orders, teams, channels, "team_id", "o_custkey", "o_orderdate", "o_orderdate")


@query(
    "messages_with_replies",
    "O-76",
    sql="""
SELECT m.conv_id, left(m.text, 80) AS message_content, count(*) AS reply_count, max(r.turn) AS latest_reply
FROM conversations m JOIN conversations r ON m.conv_id = r.conv_id AND r.turn > 0 WHERE m.turn = 0 GROUP BY m.conv_id, m.text
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    talks = table(spark, d, "conversations")
    messages = talks.filter("turn = 0").select("conv_id", F.left("text", F.lit(80)).alias("message_content"))
    return J.thread_summary(messages, talks.filter("turn > 0"), "conv_id", "turn")


@query(
    "children_of_changed",
    "O-77",
    sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
WHERE l_shipdate > TIMESTAMP '1998-01-01' AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    parents = table(spark, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    children = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return J.children_of_changed(parents, children, "l_orderkey", "o_orderdate", dt.datetime(1998, 1, 1), "l_shipdate")


@query(
    "dirty_parents",
    "O-78",
    sql="SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate > TIMESTAMP '2001-06-01')",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    children = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    parents = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return J.dirty_parents(parents, children, "o_orderkey", "l_shipdate", dt.datetime(2001, 6, 1))


@query(
    "children_of_parents",
    "O-79",
    sql="SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    parents = table(spark, d, "customer").select("c_custkey", "c_name")
    children = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return J.children_of(parents, children, "c_custkey")


@query(
    "fetch_discovered_ids",
    "O-80",
    sql="SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "lineitem").filter("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey"))
    return J.fetch_by_ids(table(spark, d, "part").select("p_partkey", "p_name"), ids, "p_partkey")


@query(
    "cohort_members",
    "O-81",
    sql="""
SELECT DISTINCT o_orderkey AS cohort, c_custkey, c_mktsegment
FROM (SELECT o_orderkey, unnest([o_custkey, o_custkey + 1, o_custkey]) AS c_custkey FROM orders) JOIN customer USING (c_custkey)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    ids = F.array("o_custkey", F.col("o_custkey") + 1, "o_custkey", F.lit(None).cast("bigint"))
    cohorts = table(spark, d, "orders").select(F.col("o_orderkey").alias("cohort"), ids.alias("ids"))
    return J.members(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), cohorts, "c_custkey", "ids", "cohort")


def _frames(spark: SparkSession, d: str) -> DataFrame:
    """Lineitems as intervals from order to shipping; returned ones are still open."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    rows = table(spark, d, "lineitem").join(orders, "l_orderkey")
    end = F.when(F.col("l_returnflag") != "R", F.greatest("l_shipdate", "o_orderdate"))
    return rows.select("l_orderkey", "l_linenumber", F.col("o_orderdate").alias("start"), end.alias("end"))


@query(
    "overlapping_intervals",
    "O-82",
    sql="""
WITH f AS (SELECT l_orderkey, l_linenumber, o_orderdate AS start,
   CASE WHEN l_returnflag <> 'R' THEN greatest(l_shipdate, o_orderdate) END AS "end" FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT * FROM f WHERE start <= TIMESTAMP '1997-02-01' AND ("end" IS NULL OR "end" >= TIMESTAMP '1997-01-01')
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return J.overlapping(_frames(spark, d), "start", "end", dt.datetime(1997, 1, 1), dt.datetime(1997, 2, 1))


@query(
    "frame_elements",
    "O-83",
    sql="""
SELECT o_orderkey, o_custkey AS element, 'primary' AS role FROM orders
UNION ALL SELECT o_orderkey, o_custkey + 1, 'referenced' FROM orders
UNION ALL SELECT o_orderkey, o_orderkey, 'referenced' FROM orders WHERE o_orderkey NOT IN (o_custkey, o_custkey + 1)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    refs = F.array("o_custkey", F.col("o_custkey") + 1, "o_orderkey")
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("main"), refs.alias("refs"))
    return J.frame_elements(rows, "o_orderkey", "main", "refs")


@query(
    "asof_join",
    "O-84",
    sql="""
SELECT p.event_id, p.user_id, p.ts, c.ts AS _matched_at, c.value AS price
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') c ON p.user_id = c.user_id AND p.ts >= c.ts
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    left = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = events.filter("event_type = 'view'").select("user_id", "ts", F.col("value").alias("price"))
    return J.asof(left, right, "ts", ["user_id"], ["price"], split=block_of(left, "ts", "day"))


@query(
    "attach_metadata",
    "O-189",
    sql="SELECT doc_id, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return J.attach(table(spark, d, "documents").select("doc_id", "n_chars"), table(spark, d, "labels"), ["doc_id"])


# ---------------------------------------------------------------- reports


@query(
    "table_counts",
    "O-86",
    sql="""
SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'events', count(*) FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.count_tables({n: table(spark, d, n) for n in ("customer", "lineitem", "orders", "events")})


@query(
    "type_catalog",
    "O-87",
    sql="SELECT split_part(trim(p_name), ' ', 1) AS point_type, p_type AS unit, count(*) AS n FROM part GROUP BY 1, 2",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.type_catalog(table(spark, d, "part"), "p_name", "p_type")


@query(
    "events_report",
    "O-88", "O-44",
    sql="""
SELECT ts::DATE AS date, event_type, count(*) AS events, round(sum(value), 2) AS revenue FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND (event_type IN ('click', 'purchase') OR NOT event_type <> 'view')
GROUP BY 1, 2 HAVING count(*) > 5 AND round(sum(value), 2) < 100000
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.report(
        table(spark, d, "events"),
        {"date": F.col("ts").cast("date"), "event_type": F.col("event_type")},
        {"events": F.count(F.lit(1)), "revenue": F.round(F.sum("value"), 2)},
        "ts",
        START.date(),
        (END - dt.timedelta(days=1)).date(),
        dim_filter={"or": [("event_type", "in", "click,purchase"), {"not": ("event_type", "ne", "view")}]},
        metric_filter={"and": [("events", "gt", 5), ("revenue", "lt", 100000)]},
    )


@query(
    "active_users",
    "O-89",
    sql="SELECT ts::DATE AS date, event_type AS segment, count(DISTINCT user_id) AS count FROM events GROUP BY 1, 2",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.active_users(table(spark, d, "events"), "user_id", "ts", "day", "event_type")


_SESSIONS = """
marks AS (SELECT user_id, ts, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) > 21600000000, true)::INT AS first FROM events
          WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM marks),
found AS (SELECT user_id, min(ts) AS session_start, max(ts) AS session_end FROM numbered GROUP BY user_id, n),
timed AS (SELECT *, (epoch_us(session_end) - epoch_us(session_start)) / 1e6 AS seconds FROM found)
"""


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    return R.sessions(events, "user_id", "ts", 6 * 3600, split=block_of(events, "ts", "day"))


@query("user_sessions", "O-90", sql=f"WITH {_SESSIONS} SELECT user_id, session_start, session_end FROM found")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _sessions(spark, d)


@query("session_length", "O-90", sql=f"WITH {_SESSIONS} SELECT session_start::DATE AS date, round(avg(seconds), 6) AS length FROM timed GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.session_length(_sessions(spark, d))


@query(
    "session_histogram",
    "O-90",
    sql=f"""
WITH {_SESSIONS}
SELECT CASE WHEN seconds < 60 THEN '0s-60s' WHEN seconds < 300 THEN '60s-300s' WHEN seconds < 900 THEN '300s-900s'
            WHEN seconds < 3600 THEN '900s-3600s' ELSE '3600s+' END AS bucket, count(*) AS count FROM timed GROUP BY 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.session_histogram(_sessions(spark, d))


@query(
    "sessions_per_user",
    "O-90",
    sql=f"WITH {_SESSIONS} SELECT date, round(avg(n), 6) AS avg_sessions FROM (SELECT session_start::DATE AS date, user_id, count(*) AS n FROM found GROUP BY 1, 2) GROUP BY 1",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.sessions_per_user(_sessions(spark, d), "user_id")


@query("cursor_bounds", "O-91", sql="SELECT min(ts) AS oldest, max(ts) AS newest FROM events")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.cursor_bounds(table(spark, d, "events"), "ts")


@query(
    "answer_rollups",
    "O-92",
    sql="SELECT event_type AS question, (props->>'k') AS choice, count(*) AS answers FROM events GROUP BY 1, 2",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("choice", F.get_json_object("props", "$.k"))
    return R.rollup_answers(rows, "event_type", "choice")


@query("group_bounds", "O-93", sql="SELECT o_orderstatus, count(*) AS n, min(o_orderdate) AS oldest, max(o_orderdate) AS newest FROM orders GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.group_bounds(table(spark, d, "orders"), ["o_orderstatus"], "o_orderdate")


# ---------------------------------------------------------------- time series


def series(spark: SparkSession, d: str) -> DataFrame:
    """Events as one series per type; large values are flagged as not good."""
    return table(spark, d, "events").select(
        F.col("event_type").alias("tag"), "ts", "value", (F.col("value") < 100).alias("good")
    )


def asked(spark: SparkSession, d: str) -> DataFrame:
    """Times to look values up at: every order day of the month that orders and events share by position."""
    hours = F.make_dt_interval(hours=F.lit(7) * F.col("n_nationkey") + 5)
    times = table(spark, d, "nation").select((literal(dt.datetime(2024, 1, 1)) + hours).alias("query_time"), "n_nationkey")
    tags = table(spark, d, "events").select(F.col("event_type").alias("tag")).distinct()
    return tags.select("tag", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("n_nationkey")).join(times, "n_nationkey").select("tag", "query_time")


_ASKED = """
asked AS (SELECT tag, TIMESTAMP '2024-01-01' + to_hours((7 * n_nationkey + 5)::INT) AS query_time FROM nation,
          (SELECT DISTINCT event_type AS tag FROM events)),
s AS (SELECT event_type AS tag, ts, value, value < 100 AS good FROM events)
"""


@query(
    "recorded_values",
    "O-94",
    sql="SELECT event_type AS tag, ts, value, value < 100 AS good FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-07'",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.recorded(series(spark, d), START, END, window_seconds=2 * 86_400)


_LINE = """
SELECT q.tag, query_time, round(CASE WHEN n.ts = p.ts THEN p.value
  ELSE p.value + (n.value - p.value) * ((epoch_us(query_time) - epoch_us(p.ts))::DOUBLE / (epoch_us(n.ts) - epoch_us(p.ts))) END, 6) AS value
FROM asked q ASOF LEFT JOIN s p ON q.tag = p.tag AND q.query_time >= p.ts ASOF LEFT JOIN s n ON q.tag = n.tag AND q.query_time <= n.ts
"""


@query("value_at_time", "O-95", sql=f"WITH {_ASKED} {_LINE}")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.value_at(series(spark, d), asked(spark, d)).withColumn("value", F.round("value", 6))


@query(
    "recorded_at_time",
    "O-96",
    sql=f"WITH {_ASKED} SELECT q.tag, query_time, p.ts, p.value FROM asked q ASOF LEFT JOIN s p ON q.tag = p.tag AND q.query_time >= p.ts",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.recorded_at(series(spark, d), asked(spark, d))


@query(
    "interpolated_grid",
    "O-97",
    sql=f"""
WITH s AS (SELECT event_type AS tag, ts, value FROM events),
asked AS (SELECT tag, unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-20', INTERVAL 6 HOUR)) AS query_time
          FROM (SELECT DISTINCT event_type AS tag FROM events))
{_LINE}
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.interpolated(series(spark, d), START, END, 6 * 3600).withColumn("value", F.round("value", 6))


@query(
    "plot_points",
    "O-98",
    sql="""
WITH b AS (SELECT event_type AS tag, ts, value,
  least(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-05')) * 40 / (15 * 86400000000)), 39)::INT AS bin FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'),
r AS (SELECT *, row_number() OVER (PARTITION BY tag, bin ORDER BY ts) AS a, row_number() OVER (PARTITION BY tag, bin ORDER BY ts DESC) AS z,
  row_number() OVER (PARTITION BY tag, bin ORDER BY value, ts) AS lo, row_number() OVER (PARTITION BY tag, bin ORDER BY value DESC, ts) AS hi FROM b)
SELECT tag, bin, ts, value FROM r WHERE a = 1 OR z = 1 OR lo = 1 OR hi = 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.plot(series(spark, d), START, END, intervals=40)


_DAILY = f"""
s AS (SELECT event_type AS tag, ts, value, value < 100 AS good FROM events),
c AS (SELECT tag, date_trunc('day', ts) AS ts, count(value)::DOUBLE AS "Count", count(*) FILTER (good) * 100.0 / count(*) AS "PercentGood",
  sum(value) AS "Total", avg(value) AS "Average", min(value) AS "Minimum", max(value) AS "Maximum", stddev_pop(value) AS "StdDev",
  max(value) - min(value) AS "Range" FROM s WHERE {RANGE} GROUP BY 1, 2)
"""


@query(
    "summary_by_events",
    "O-99",
    sql=f"""
WITH {_DAILY}
SELECT tag, ts, summary_type, round(value, 8) AS value FROM (
  UNPIVOT c ON "Total", "Average", "Minimum", "Maximum", "Range", "StdDev", "Count", "PercentGood" INTO NAME summary_type VALUE value)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    found = S.summary(series(spark, d), START, END, S.SUMMARY_KINDS, duration=86_400, basis="EventWeighted")
    return found.withColumn("value", F.round("value", 8))


# Stretches over which a value holds, cut at midnight and to the range.
_HELD = f"""
s AS (SELECT event_type AS tag, ts, value FROM events),
h AS (SELECT tag, value, greatest(ts, TIMESTAMP '2024-01-05') AS b,
  least(coalesce(lead(ts) OVER (PARTITION BY tag ORDER BY ts), TIMESTAMP '2024-01-20'), TIMESTAMP '2024-01-20') AS e FROM s),
days AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-19', INTERVAL 1 DAY)) AS day),
p AS (SELECT tag, day AS ts, value, (epoch_us(least(e, day + INTERVAL 1 DAY)) - epoch_us(greatest(b, day))) / 1e6 AS held
      FROM h JOIN days ON b < day + INTERVAL 1 DAY AND e > day WHERE b < e),
w AS (SELECT tag, ts, sum(value * held) AS "Total", sum(value * held) / sum(held) AS "Average", min(value) AS "Minimum",
  max(value) AS "Maximum", sqrt(greatest(sum(value * value * held) / sum(held) - (sum(value * held) / sum(held)) ** 2, 0)) AS "StdDev" FROM p GROUP BY 1, 2)
"""


@query(
    "summary_by_time",
    "O-99",
    sql=f"""
WITH {_HELD}
SELECT tag, ts, summary_type, round(value, 2) AS value FROM (
  UNPIVOT w ON "Total", "Average", "Minimum", "Maximum", "StdDev" INTO NAME summary_type VALUE value)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    kinds = ["Total", "Average", "Minimum", "Maximum", "StdDev"]
    return S.summary(series(spark, d), START, END, kinds, duration=86_400).withColumn("value", F.round("value", 2))


@query(
    "calculated_values",
    "O-99b",
    sql=f"""WITH {_HELD} SELECT tag, ts, 'Average' AS calculation_type, round("Average", 6) AS value FROM w""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.calculated(series(spark, d), START, END, 86_400).withColumn("value", F.round("value", 6))


@query(
    "latest_values",
    "O-99c",
    sql="""
SELECT event_type AS tag, max(ts) AS ts, arg_max(value, ts) AS value, arg_max(value < 100, ts) AS good FROM events GROUP BY 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.latest_per_tag(series(spark, d))


@query(
    "relative_time_range",
    "O-99d", "O-99e",
    sql="SELECT event_type AS tag, ts, value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-13' AND TIMESTAMP '2024-01-14 12:00:00'",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    now = dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)
    start, end = S.time_range(None, {"start_time": "*-7d", "window_seconds": "129600"}, now, now)
    return S.recorded(series(spark, d).drop("good"), start, end)


@query(
    "quality_columns",
    "O-94", "O-46",
    sql="SELECT event_type AS tag, ts, value, value < 100 AS good, false AS questionable, false AS substituted, false AS annotated, 'EUR' AS units FROM events",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.with_quality(series(spark, d), "EUR").drop("ingestion_timestamp")


# ---------------------------------------------------------------- event-time windows


@query(
    "tumbling_windows",
    "O-173",
    sql="""
SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, event_type,
       count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    from feedweir.streaming.tables import stream_windows

    total = F.round(F.sum("value"), 2).alias("total")
    rows = stream_windows(table(spark, d, "events"), "ts", "6 hours", keys=["event_type"], metrics=[total])
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query(
    "sliding_windows",
    "O-173",
    sql="""
SELECT w AS window_start, w + INTERVAL 12 HOUR AS window_end, event_type, count(*) AS n
FROM (SELECT event_type, time_bucket(INTERVAL 4 HOUR, ts) - to_hours(4 * i::INT) AS w FROM events, range(0, 3) r(i)) GROUP BY ALL
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    from feedweir.streaming.tables import stream_windows

    rows = stream_windows(table(spark, d, "events"), "ts", "12 hours", "4 hours", keys=["event_type"])
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})
