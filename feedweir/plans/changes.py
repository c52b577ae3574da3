"""Queries on change application, over feeds derived from the orders, customer and events tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweir.operators import changes as C
from feedweir.operators import reports as R
from feedweir.operators import slicing as S
from feedweir.operators.checks import slices_equal_table
from feedweir.operators.ordering import block_of
from feedweir.plans.ingest import apply_flow, flow_of
from feedweir.plans.registry import query, table
from feedweir.session import checkpoint_dir
from feedweir.sources import sinks

# Orders as a feed: every order is created; those finished or pending change a week later; urgent ones have a late
# copy from the day before. Pending low ones are deleted after a month, some finished ones too early to matter.
ORDERS_SQL = """
feed AS (
  SELECT o_orderkey AS order_key, o_custkey AS cust_key, 'O' AS status, o_totalprice AS total, o_orderdate AS changed_at
  FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + INTERVAL 7 DAY FROM orders
  WHERE o_orderstatus <> 'O'
  UNION ALL
  SELECT o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate - INTERVAL 1 DAY FROM orders
  WHERE o_orderpriority = '1-URGENT'),
deletes AS (
  SELECT o_orderkey AS order_key, o_orderdate + INTERVAL 30 DAY AS changed_at FROM orders
  WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
  UNION ALL
  SELECT o_orderkey, o_orderdate + INTERVAL 3 DAY FROM orders
  WHERE o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED'),
merged AS (
  SELECT *, false AS gone FROM feed
  UNION ALL
  SELECT order_key, NULL, NULL, NULL, changed_at, true FROM deletes)
"""


def _days(n: int):
    return F.col("o_orderdate") + F.make_dt_interval(days=F.lit(n))


def orders_feed(spark: SparkSession, d: str) -> DataFrame:
    """The upsert feed, made in one scan of orders."""

    def version(status, at):
        return F.struct(
            F.col("o_orderkey").alias("order_key"),
            F.col("o_custkey").alias("cust_key"),
            status.alias("status"),
            F.col("o_totalprice").alias("total"),
            at.alias("changed_at"),
        )

    created = version(F.lit("O"), F.col("o_orderdate"))
    moved = F.when(F.col("o_orderstatus") != "O", version(F.col("o_orderstatus"), _days(7)))
    late = F.when(F.col("o_orderpriority") == "1-URGENT", version(F.lit("N"), _days(-1)))
    return table(spark, d, "orders").select(F.inline(F.array_compact(F.array(created, moved, late))))


def orders_deletes(spark: SparkSession, d: str) -> DataFrame:
    """The delete feed: keys and sequence only."""
    pending = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    early = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")
    at = F.when(pending, _days(30)).when(early, _days(3))
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("order_key"), at.alias("changed_at"))
    return rows.filter("changed_at IS NOT NULL")


KEYS, SEQ = ["order_key"], "changed_at"


@query(
    "order_report_from_feed",
    "O-36", "O-114", "O-03", "O-75",
    sql=f"""
WITH {ORDERS_SQL},
sliced AS (SELECT * FROM merged WHERE changed_at > TIMESTAMP '1996-01-01'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY changed_at DESC, gone DESC) AS r FROM sliced),
current AS (SELECT * FROM ranked WHERE r = 1 AND NOT gone)
SELECT n.n_name AS nation, c.c_mktsegment AS segment, count(*) AS orders, round(sum(o.total), 2) AS total,
       max(o.changed_at) AS newest
FROM current o LEFT JOIN customer c ON o.cust_key = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY ALL
""",
)
def _flagship(spark: SparkSession, d: str) -> DataFrame:
    since = dt.datetime(1996, 1, 1)
    feed = S.slice_after(orders_feed(spark, d), SEQ, since)
    gone = S.slice_after(orders_deletes(spark, d), SEQ, since)
    current = C.scd1(feed, KEYS, SEQ, deletes=gone)
    customer = table(spark, d, "customer").select(F.col("c_custkey").alias("cust_key"), "c_nationkey", "c_mktsegment")
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # One row per customer goes into the joins instead of one per order.
    per_customer = current.groupBy("cust_key").agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("t"), F.max(SEQ).alias("m"))
    joined = per_customer.join(customer, "cust_key", "left").join(nation, "c_nationkey", "left")
    return joined.groupBy(F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment")).agg(
        F.sum("n").alias("orders"), F.round(F.sum("t"), 2).alias("total"), F.max("m").alias("newest")
    )


@query(
    "scd1_upsert",
    "O-01",
    sql=f"""
WITH {ORDERS_SQL}
SELECT order_key, cust_key, status, total, changed_at FROM feed
QUALIFY row_number() OVER (PARTITION BY order_key ORDER BY changed_at DESC) = 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.scd1(orders_feed(spark, d), KEYS, SEQ)


@query(
    "scd1_hot_keys",
    "O-01",
    sql="""
SELECT user_id, ts, event_type, value, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    feed = table(spark, d, "events").select("user_id", "ts", "event_type", "value", "event_id")
    return C.scd1(feed, ["user_id"], "ts", tiebreak=["event_id"])


_HISTORY = """
states AS (
  SELECT *, lag(digest) OVER w AS was, lag(gone) OVER w AS was_gone FROM versions
  WINDOW w AS (PARTITION BY order_key ORDER BY changed_at)),
changes AS (
  SELECT * FROM states
  WHERE CASE WHEN gone THEN NOT coalesce(was_gone, true) ELSE was_gone IS NULL OR was_gone OR was <> digest END),
ended AS (
  SELECT *, lead(changed_at) OVER (PARTITION BY order_key ORDER BY changed_at) AS until FROM changes)
SELECT order_key, cust_key, status, total, changed_at, changed_at AS "__START_AT", until AS "__END_AT"
FROM ended WHERE NOT gone
"""


@query(
    "scd2_history",
    "O-02",
    sql=f"""
WITH {ORDERS_SQL},
versions AS (SELECT *, concat_ws('|', cust_key, status, total) AS digest FROM merged WHERE NOT gone),
{_HISTORY}
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    feed = orders_feed(spark, d)
    return C.scd2(feed, KEYS, SEQ, split=block_of(feed, SEQ, "year"))


@query(
    "scd2_hot_keys",
    "O-02",
    sql="""
WITH states AS (
  SELECT user_id, ts, event_type, lag(event_type) OVER w AS was FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
changes AS (SELECT * FROM states WHERE was IS NULL OR was <> event_type)
SELECT user_id, ts, event_type, ts AS "__START_AT", lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT"
FROM changes
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    feed = table(spark, d, "events").select("user_id", "ts", "event_type")
    return C.scd2(feed, ["user_id"], "ts", split=block_of(feed, "ts", "day"))


@query(
    "scd1_delete_feed",
    "O-03",
    sql=f"""
WITH {ORDERS_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY changed_at DESC, gone DESC) AS r FROM merged)
SELECT order_key, cust_key, status, total, changed_at FROM ranked WHERE r = 1 AND NOT gone
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.scd1(orders_feed(spark, d), KEYS, SEQ, deletes=orders_deletes(spark, d))


@query(
    "scd2_delete_feed",
    "O-04",
    sql=f"""
WITH {ORDERS_SQL},
versions AS (SELECT *, concat_ws('|', cust_key, status, total) AS digest FROM merged),
{_HISTORY}
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    feed = orders_feed(spark, d)
    return C.scd2(feed, KEYS, SEQ, deletes=orders_deletes(spark, d), split=block_of(feed, SEQ, "year"))


# Two customer snapshots: each lacks one market segment, and the second one has corrected negative balances.
SNAPSHOTS_SQL = """
a AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'),
b AS (
  SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal
  FROM customer WHERE c_mktsegment <> 'MACHINERY')
"""


def snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The two snapshots."""
    customer = table(spark, d, "customer")
    a = customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_acctbal")
    corrected = F.when(F.col("c_acctbal") < 0, 0.0).otherwise(F.col("c_acctbal")).alias("c_acctbal")
    return a, customer.filter("c_mktsegment <> 'MACHINERY'").select("c_custkey", "c_name", corrected)


@query(
    "snapshot_apply",
    "O-05",
    sql=f"""
WITH {SNAPSHOTS_SQL}
SELECT b.c_custkey, b.c_name, b.c_acctbal,
       CASE WHEN a.c_custkey IS NULL THEN 'insert' WHEN a.c_acctbal = b.c_acctbal THEN 'unchanged' ELSE 'update' END AS _change
FROM b LEFT JOIN a USING (c_custkey)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    a, b = snapshots(spark, d)
    return C.apply_snapshot(a, b, ["c_custkey"])


@query(
    "snapshot_history",
    "O-06",
    sql=f"""
WITH {SNAPSHOTS_SQL},
stacked AS (SELECT *, 1 AS v FROM a UNION ALL SELECT *, 2 FROM b UNION ALL SELECT *, 3 FROM a),
marked AS (
  SELECT *, coalesce(lag(v) OVER w <> v - 1 OR lag(c_acctbal) OVER w <> c_acctbal, true) AS opens FROM stacked
  WINDOW w AS (PARTITION BY c_custkey ORDER BY v)),
runs AS (SELECT *, sum(opens::INT) OVER (PARTITION BY c_custkey ORDER BY v) AS run FROM marked)
SELECT c_custkey, min(c_name) AS c_name, min(c_acctbal) AS c_acctbal, min(v) * 10 AS "__START_AT",
       CASE WHEN max(v) < 3 THEN (max(v) + 1) * 10 END AS "__END_AT"
FROM runs GROUP BY c_custkey, run
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    a, b = snapshots(spark, d)
    return C.apply_snapshots_scd2([(10, a), (20, b), (30, a)], ["c_custkey"])


@query(
    "snapshot_history_step",
    "O-06",
    sql=f"""
WITH {SNAPSHOTS_SQL}
SELECT a.c_custkey, a.c_name, a.c_acctbal, 1 AS "__START_AT",
       CASE WHEN b.c_custkey IS NULL OR b.c_acctbal <> a.c_acctbal THEN 2 END AS "__END_AT"
FROM a LEFT JOIN b USING (c_custkey)
UNION ALL
SELECT b.c_custkey, b.c_name, b.c_acctbal, 2, NULL FROM b LEFT JOIN a USING (c_custkey)
WHERE a.c_custkey IS NULL OR b.c_acctbal <> a.c_acctbal
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    a, b = snapshots(spark, d)
    history = a.withColumns({C.START: F.lit(1), C.END: F.lit(None).cast("int")})
    return C.extend_history(history, b, ["c_custkey"], 2)


@query(
    "snapshot_diff",
    "O-07",
    sql=f"""
WITH {SNAPSHOTS_SQL}
SELECT c_custkey, coalesce(b.c_name, a.c_name) AS c_name,
       CASE WHEN b.c_custkey IS NULL THEN a.c_acctbal ELSE b.c_acctbal END AS c_acctbal,
       CASE WHEN a.c_custkey IS NULL THEN 'insert' WHEN b.c_custkey IS NULL THEN 'delete'
            WHEN a.c_acctbal = b.c_acctbal THEN 'unchanged' ELSE 'update' END AS _change
FROM a FULL JOIN b USING (c_custkey)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    a, b = snapshots(spark, d)
    return C.snapshot_diff(a, b, ["c_custkey"])


@query(
    "flow_choice",
    "O-09",
    sql=f"""
WITH {ORDERS_SQL}
SELECT status, count(*) AS n FROM feed GROUP BY status
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    entry = {"source_table": "orders", "table_configuration": {"scd_type": "APPEND_ONLY"}}
    flow = flow_of(entry, {"primary_keys": KEYS, "cursor_field": SEQ, "ingestion_type": "cdc"})
    return apply_flow(flow, orders_feed(spark, d)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# Events as rows that carry their own deletion flag: an error row deletes the user's state.
TOMBSTONES_SQL = """
SELECT user_id, ts, event_type, value, event_type = 'error' AS deleted FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
"""


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "user_id", "ts", "event_type", "value", (F.col("event_type") == "error").alias("deleted")
    )


@query("in_feed_tombstones", "O-10", sql=f"SELECT * FROM ({TOMBSTONES_SQL}) WHERE NOT deleted")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.apply_tombstones(_flagged(spark, d), ["user_id"], "ts", "deleted")


@query("in_feed_tombstones_shown", "O-10", sql=TOMBSTONES_SQL)
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.apply_tombstones(_flagged(spark, d), ["user_id"], "ts", "deleted", show_deleted=True)


@query(
    "archived_as_delete",
    "O-11",
    sql="""
SELECT o_orderkey, o_orderdate + INTERVAL 90 DAY AS archived_at, o_orderdate + INTERVAL 90 DAY AS updated_at
FROM orders WHERE o_orderstatus = 'F'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    archived = F.when(F.col("o_orderstatus") == "F", _days(90)).alias("archived_at")
    rows = table(spark, d, "orders").select("o_orderkey", archived, F.col("o_orderdate").alias("updated_at"))
    return C.archived_as_delete(rows, "archived_at", "updated_at")


def _mail_history(spark: SparkSession, d: str) -> DataFrame:
    """Lineitems as a deletion history: an order is a record, its parts the deleted messages of supplier threads."""
    entry = F.struct(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("thread_id"))
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("history_id"),
        F.struct(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")).alias("position"),
        F.array(entry).alias("deleted"),
    )
    return rows


@query(
    "distinct_deletes_messages",
    "O-12",
    sql="""
SELECT l_partkey AS id, l_suppkey AS thread_id, l_orderkey AS history_id FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) = 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.distinct_deletes(_mail_history(spark, d), "messages")


@query(
    "distinct_deletes_threads",
    "O-12",
    sql="""
SELECT l_suppkey AS id, l_orderkey AS history_id FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) = 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.distinct_deletes(_mail_history(spark, d), "threads")


@query(
    "scd1_composite_keys",
    "O-13",
    sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC) = 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    return C.scd1(rows, ["l_orderkey", "l_linenumber"], "l_shipdate", tiebreak=["l_extendedprice", "l_partkey"])


@query("clustered_write", "O-14", "O-34", sql="SELECT c_nationkey, c_custkey, c_acctbal FROM customer")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = _scratch(spark, "clustered")
    rows = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    sinks.write(rows, path, cluster_by='["c_nationkey", "c_custkey"]')
    return spark.read.parquet(path)


def _scratch(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "tombstone_keys_checked",
    "O-15",
    sql="SELECT event_type = 'error' AS deleted, count(*) AS n FROM events GROUP BY 1",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    checked = C.require_tombstone_keys(_flagged(spark, d), ["user_id"], "deleted")
    return checked.groupBy("deleted").agg(F.count(F.lit(1)).alias("n"))


@query("dedup_rows", "O-149", sql="SELECT DISTINCT text FROM documents")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.dedup_rows(table(spark, d, "documents").select("text"))


@query(
    "union_upserts_deletes",
    "O-150",
    sql=f"WITH {ORDERS_SQL} SELECT order_key, cust_key, status, total, changed_at, gone AS deleted FROM merged",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    upserts = orders_feed(spark, d).withColumn("deleted", F.lit(False))
    return R.union_all(upserts, orders_deletes(spark, d).withColumn("deleted", F.lit(True)))


@query("round_trip_slices", "O-187", sql="SELECT 0::BIGINT AS lost, 0::BIGINT AS added")
def _(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("event_id", "ts", "user_id")
    middle = dt.datetime(2024, 1, 15, 12)
    first = S.slice_range(events, "ts", high=middle)
    return slices_equal_table([first, S.slice_after(events, "ts", middle)], events)
