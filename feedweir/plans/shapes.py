"""Queries on coercion, filters, nested shaping and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.functions import coercion as V
from feedweir.functions import cursors as K
from feedweir.functions import filters as P
from feedweir.functions import nested as N
from feedweir.functions import scalars as L
from feedweir.operators import checks, reports
from feedweir.operators import shaping as H
from feedweir.operators import slicing as S
from feedweir.plans.registry import query, table
from feedweir.sources import catalog, readers


# ---------------------------------------------------------------- coercion


def _loose(spark: SparkSession, d: str) -> DataFrame:
    """Orders as loosely typed text: numbers with points, words for booleans, three date forms."""
    date = F.col("o_orderdate")
    written = (
        F.when(F.col("o_orderstatus") == "O", F.date_format(date, "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "F", F.date_format(date, "MM/dd/yyyy"))
        .otherwise(F.date_format(date, "dd-MM-yyyy"))
    )
    return table(spark, d, "orders").select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("key"),
        F.col("o_totalprice").cast("string").alias("whole"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("exact"),
        F.when(F.col("o_orderstatus") == "O", "Yes").when(F.col("o_orderstatus") == "F", "n").otherwise("maybe").alias("flag"),
        written.alias("day"),
        F.concat(F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("at"),
    )


@query(
    "coerce_records",
    "O-36",
    sql="""
SELECT o_orderkey AS key, trunc(o_totalprice)::BIGINT AS whole, round(o_totalprice, 2) AS exact, o_orderstatus <> 'F' AS flag,
       o_orderdate::DATE AS day, o_orderdate AS at FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    schema = T.StructType.fromDDL("key bigint not null, whole bigint, exact decimal(12,2), flag boolean, day date, at timestamp")
    return V.coerce(_loose(spark, d), schema).withColumn("exact", F.round(F.col("exact").cast("double"), 2))


@query(
    "coerce_permissive",
    "O-36",
    sql="""
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE left(o_orderpriority, 1)::INT END AS rank,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'rank' ELSE '' END AS errors FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    low = F.col("o_orderpriority") == "5-LOW"
    rank = F.when(low, "low").otherwise(F.left("o_orderpriority", F.lit(1)))
    rows = table(spark, d, "orders").select("o_orderkey", rank.alias("rank"))
    typed = V.coerce(rows, T.StructType.fromDDL("o_orderkey bigint, rank int"), mode="permissive")
    return typed.select("o_orderkey", "rank", F.array_join(V.ERRORS, ",").alias("errors"))


@query(
    "project_to_schema",
    "O-37",
    sql="""
SELECT event_id, CASE WHEN event_type <> 'error' THEN (props->>'k')::INT END AS k FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    wrong = F.when(F.col("event_type") == "error", F.lit("[1, 2]")).otherwise(F.col("props"))
    shaped = V.project_to_schema(wrong, T.StructType.fromDDL("k int, missing string"))
    return table(spark, d, "events").select("event_id", shaped["k"].alias("k"))


@query(
    "loose_value_helpers",
    "O-49",
    sql="""
SELECT event_id, value AS number, event_type IN ('click', 'view') AS flag, event_type AS only FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    word = F.when(F.col("event_type").isin("click"), " TRUE ").when(F.col("event_type") == "view", "2").otherwise("off")
    single = V.str_list(F.col("event_type"), T.StringType())
    return table(spark, d, "events").select(
        "event_id", V.num_or_null(F.col("value").cast("string")).alias("number"), V.bool_or(word).alias("flag"), single[0].alias("only")
    )


# ---------------------------------------------------------------- columns and predicates


@query("select_columns", "O-38", sql="SELECT p_partkey, p_brand FROM part")
def _(spark: SparkSession, d: str) -> DataFrame:
    return H.select_columns(table(spark, d, "part"), ["p_partkey", "p_brand"])


@query(
    "predicates",
    "O-39", "O-40",
    sql="""
SELECT p_partkey, p_size, p_type FROM part WHERE p_size >= 10 AND p_size < 40 AND p_type <> 'PROMO' AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    wanted = [("p_size", "gte", "10"), ("p_size", "lt", 40), ("p_type", "ne", "PROMO"), ("p_brand", "in", "Brand#1, Brand#2,Brand#3")]
    return P.apply_predicates(table(spark, d, "part"), wanted).select("p_partkey", "p_size", "p_type")


@query("filter_equals", "O-42", sql="SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    return P.filter_equals(table(spark, d, "customer"), c_mktsegment="BUILDING", c_nationkey="3", c_name=None).select("c_custkey")


@query(
    "search_text",
    "O-188",
    sql="SELECT p_partkey FROM part WHERE contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'brand#1')",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return P.search_text(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type"), "BRAND#1").select("p_partkey")


@query("filter_option", "O-190", sql="SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(spark: SparkSession, d: str) -> DataFrame:
    text = '{"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "2-HIGH"]}'
    return P.apply_predicates(table(spark, d, "orders"), P.parse_filter_option(text, ["limit"])).select("o_orderkey")


@query(
    "valid_identifiers",
    "O-191",
    sql="SELECT event_type, count(*) FILTER (event_type IN ('click', 'view')) AS valid FROM events GROUP BY 1",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    uid = F.when(kind == "click", key).when(kind == "view", F.concat(F.lit("1.2."), key)).when(kind == "error", F.concat(F.lit("1..2."), key))
    uid = uid.otherwise(F.concat(F.lit("../"), key))
    return table(spark, d, "events").groupBy("event_type").agg(F.count_if(P.valid_id(uid)).alias("valid"))


@query("name_wildcard", "O-43", sql="SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%r_ng'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return P.filter_name(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "*R?NG")


@query(
    "range_filter",
    "O-45",
    sql="SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-01-01'",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.slice_range(table(spark, d, "orders"), "o_orderdate", dt.datetime(1996, 1, 1), dt.datetime(1997, 1, 1), True).select("o_orderkey")


@query("lineage_columns", "O-46", sql="SELECT n_nationkey, n_name, 'north' AS shop, 'nation' AS source_table FROM nation")
def _(spark: SparkSession, d: str) -> DataFrame:
    return H.with_lineage(table(spark, d, "nation").select("n_nationkey", "n_name"), shop="north", source_table="nation")


@query("pad_columns", "O-47", sql="SELECT s_suppkey, NULL::VARCHAR AS s_phone, s_name FROM supplier")
def _(spark: SparkSession, d: str) -> DataFrame:
    schema = T.StructType.fromDDL("s_suppkey bigint, s_phone string, s_name string")
    return H.pad_columns(table(spark, d, "supplier").select("s_suppkey", "s_name"), schema, never=["s_suppkey"])


@query("drop_control_keys", "O-48", sql="SELECT event_id, 1::BIGINT AS kept FROM events")
def _(spark: SparkSession, d: str) -> DataFrame:
    extra = F.create_map(F.lit("@etag"), F.col("event_type"), F.lit("__metadata"), F.lit("x"), F.lit("k"), F.col("props"))
    rows = table(spark, d, "events").select(
        "event_id", extra.alias("extra"), F.lit("y").alias("@odata.id"), F.struct(F.lit("u").alias("__deferred")).alias("link")
    )
    clean = H.drop_control_keys(rows)
    return clean.select(*[c for c in clean.columns if c != "extra"], F.size("extra").cast("bigint").alias("kept"))


# ---------------------------------------------------------------- nested


def _places(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation")
    return nation.join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))


def _tree(customers) -> list:
    """Region, nation and customers of one row as nested collections; documents stay as small as a row."""
    nation = F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), customers.alias("customers"))
    return [F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"), F.array(nation).alias("nations")]


def customer_trees(spark: SparkSession, d: str) -> DataFrame:
    """One document per customer, who has an own and a joint account."""

    def account(suffix: str, share: float):
        name = F.concat(F.col("c_name"), F.lit(suffix))
        return F.struct(F.col("c_custkey").alias("key"), name.alias("name"), (F.col("c_acctbal") * share).alias("balance"))

    rows = table(spark, d, "customer").join(_places(spark, d), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(*_tree(F.array(account("", 1.0), account(" joint", 0.5))))


def order_trees(spark: SparkSession, d: str) -> DataFrame:
    """One document per order, four levels deep."""
    order = F.struct(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("total"))
    customer = F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.array(order).alias("orders"))
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.join(_places(spark, d), F.col("c_nationkey") == F.col("n_nationkey")).select(*_tree(F.array(customer)))


TREE = ["region", "nations", "customers"]
_TREE_KEYS = {"region": ["key"], "nations": ["key"], "customers": ["key"]}


@query(
    "filter_per_level",
    "O-41",
    sql="""
SELECT n_regionkey AS region_key, n_nationkey AS nations_key, c_custkey AS key, c_name || suffix AS name, c_acctbal * share AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey,
     (VALUES ('', 1.0::DOUBLE), (' joint', 0.5::DOUBLE)) a(suffix, share)
WHERE r_name <> 'ASIA' AND n_name <> 'NATION_3' AND c_acctbal * share > 1000
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    conditions = {"region": F.col("name") != "ASIA", "nations": F.col("name") != "NATION_3", 2: F.col("balance") > 1000}
    return H.explode_path(customer_trees(spark, d), TREE, _TREE_KEYS, conditions)


@query(
    "nested_four_levels",
    "O-55", "O-56",
    sql="""
SELECT n_regionkey AS region_key, n_nationkey AS nations_key, c_custkey AS customers_key, o_orderkey AS key, o_totalprice AS total,
       r_name AS _parent_cursor
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return H.explode_path(order_trees(spark, d), [*TREE, "orders"], {**_TREE_KEYS, "orders": ["key"]}, cursor=("region", "name"))


@query(
    "two_level_explode",
    "O-53",
    sql="""
SELECT l_orderkey AS survey_id, l_linenumber AS line, page AS pages_id, question AS id,
       CASE question WHEN 'quantity' THEN l_quantity WHEN 'price' THEN l_extendedprice WHEN 'tax' THEN l_tax END AS answer
FROM lineitem, (VALUES ('amounts', 'quantity'), ('amounts', 'price'), ('rates', 'tax')) p(page, question)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    def question(name: str, column: str):
        return F.struct(F.lit(name).alias("id"), F.col(column).alias("answer"))

    pages = F.array(
        F.struct(F.lit("amounts").alias("id"), F.array(question("quantity", "l_quantity"), question("price", "l_extendedprice")).alias("questions")),
        F.struct(F.lit("rates").alias("id"), F.array(question("tax", "l_tax")).alias("questions")),
    )
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), pages.alias("pages"))
    keys = {"survey": ["id", "line"], "pages": ["id"], "questions": ["id"]}
    return H.explode_path(rows, ["survey", "pages", "questions"], keys).withColumnRenamed("survey_line", "line")


@query("ancestor_keys_required", "O-57", sql="SELECT n_regionkey AS region_key, n_nationkey AS key FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = H.explode_path(customer_trees(spark, d), TREE[:2], {"region": ["key"], "nations": ["key"]})
    return H.require_ancestor_keys(rows, ["region_key"]).select("region_key", "key")


@query("dotted_paths", "O-50", sql="SELECT event_id, (props->>'k')::INT AS k, NULL::VARCHAR AS gone FROM events")
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id", N.json_path(F.col("props"), "k").try_cast("int").alias("k"), N.json_path(F.col("props"), "a.b").alias("gone")
    )


def _channel(spark: SparkSession, d: str) -> DataFrame:
    """Customers as nested resources."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(
            F.col("c_name").alias("title"),
            F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("country"),
        ).alias("snippet"),
        F.struct(F.col("c_acctbal").alias("balance")).alias("statistics"),
    )


@query(
    "flatten",
    "O-51",
    sql="""
SELECT c_custkey AS id, c_name AS snippet_title, c_mktsegment AS snippet_country_segment,
       c_nationkey AS snippet_country_nation, c_acctbal AS statistics_balance FROM customer
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return H.flatten(_channel(spark, d))


def order_documents(spark: SparkSession, d: str) -> DataFrame:
    """Orders with child rows: the sale itself, and a return that lacks a status of its own."""

    def child(line: int, part, quantity, kind, status):
        return F.struct(
            F.lit(line).alias("line"), part.alias("part"), quantity.alias("quantity"), kind.alias("kind"), status.alias("status")
        )

    sale = child(1, F.col("o_custkey"), F.col("o_totalprice"), F.col("o_orderstatus"), F.left("o_orderpriority", F.lit(1)))
    back = child(2, F.col("o_orderkey"), F.col("o_totalprice") / 2, F.lit("R"), F.lit(None).cast("string"))
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created"), F.array(sale, back).alias("lines")
    )


_CHILDREN = """
children AS (
  SELECT o_orderkey AS id, o_orderdate AS created, 1 AS line, o_custkey AS part, o_totalprice AS quantity, o_orderstatus AS kind,
         left(o_orderpriority, 1) AS status, o_orderstatus AS parent_status FROM orders
  UNION ALL SELECT o_orderkey, o_orderdate, 2, o_orderkey, o_totalprice / 2, 'R', NULL, o_orderstatus FROM orders)
"""


@query(
    "explode_children",
    "O-52", "O-192",
    sql=f"WITH {_CHILDREN} SELECT id, line, part, quantity, kind, coalesce(status, parent_status) AS status FROM children",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = H.explode_child(order_documents(spark, d), "lines", ["id", F.col("status").alias("parent_status")])
    return H.fill_from_parent(rows, {"status": "parent_status"}).drop("parent_status")


@query(
    "explode_where",
    "O-54",
    sql=f"WITH {_CHILDREN} SELECT id, created, line, part, quantity, kind, status FROM children WHERE kind = 'R'",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return H.explode_where(order_documents(spark, d), "lines", lambda c: c["kind"] == "R", ["id", "status", "created"])


@query(
    "series_matrix",
    "O-58",
    sql="""
SELECT user_id, n::BIGINT AS x, v AS value, label FROM (
  SELECT user_id, [count(*) FILTER (event_type = 'click'), count(*) FILTER (event_type = 'error')] AS a,
         [count(*) FILTER (event_type = 'view')] AS b FROM events GROUP BY 1),
  LATERAL (SELECT 1 AS n, a[1] AS v, 'seen' AS label UNION ALL SELECT 2, a[2], 'seen' UNION ALL SELECT 1, b[1], 'Totals')
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    def n(kind: str):
        return F.count_if(F.col("event_type") == kind)

    rows = table(spark, d, "events").groupBy("user_id").agg(
        F.array(F.lit(1), F.lit(2)).cast("array<bigint>").alias("xValues"),
        F.array(F.array(n("click"), n("error")), F.array(n("view"))).alias("series"),
        F.array(F.lit("seen")).alias("labels"),
    )
    return H.series_to_rows(rows, "xValues", "series", "labels", keep=["user_id"])


@query(
    "header_values",
    "O-59", "O-163",
    sql="SELECT event_id, ts::DATE AS date, user_id AS users, round(value, 2) AS revenue FROM events",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    values = F.array(F.date_format("ts", "yyyy-MM-dd"), F.col("user_id").cast("string"), F.col("value").cast("string"))
    rows = table(spark, d, "events").select("event_id", values.alias("values"))
    typed = H.header_values_to_columns(
        rows, ["date", "users", "revenue"], "values", {"date": "date", "users": "bigint", "revenue": "double"}, ["event_id"]
    )
    return typed.withColumn("revenue", F.round("revenue", 2))


def _properties(spark: SparkSession, d: str) -> DataFrame:
    """Events with a property map built from their columns and JSON."""
    extra = F.from_json("props", "map<string, string>")
    base = F.create_map(
        F.lit("$insert_id"), F.col("event_id").cast("string"), F.lit("$city"), F.col("event_type"), F.lit("time"), F.col("ts").cast("string")
    )
    return table(spark, d, "events").select("event_id", F.map_concat(base, extra).alias("properties"))


@query(
    "split_properties",
    "O-60",
    sql="""
SELECT event_id, event_id::VARCHAR AS insert_id, event_type AS city, props->>'k' AS k, 2::BIGINT AS standard, 2::BIGINT AS custom FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = H.split_properties(_properties(spark, d), "properties", ["time", "$city", "$os"], {"insert_id": "$insert_id"})
    return rows.select(
        "event_id",
        "insert_id",
        F.try_element_at("standard_properties", F.lit("$city")).alias("city"),
        F.try_element_at("custom_properties", F.lit("k")).alias("k"),
        F.size("standard_properties").cast("bigint").alias("standard"),
        F.size("custom_properties").cast("bigint").alias("custom"),
    )


@query(
    "links_to_rows",
    "O-61",
    sql="""
SELECT 'nation' AS entity, n_nationkey AS id, 'Self' AS rel, '/nation/' || n_nationkey AS href FROM nation
UNION ALL SELECT 'nation', n_nationkey, 'Region', '/region/' || n_regionkey FROM nation
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    links = F.create_map(
        F.lit("Self"), F.concat(F.lit("/nation/"), F.col("n_nationkey")),
        F.lit("Region"), F.concat(F.lit("/region/"), F.col("n_regionkey")),
        F.lit("Gone"), F.lit(None).cast("string"),
    )
    return H.links_to_rows(table(spark, d, "nation").select("*", links.alias("links")), F.lit("nation"), F.col("n_nationkey"), "links")


@query("map_to_text", "O-62", sql="SELECT p_partkey, p_size::VARCHAR AS size, '' AS missing FROM part")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = N.map_to_text(F.create_map(F.lit("size"), F.col("p_size"), F.lit("missing"), F.lit(None).cast("int")))
    return table(spark, d, "part").select("p_partkey", cells["size"].alias("size"), cells["missing"].alias("missing"))


@query(
    "association_ids",
    "O-63",
    sql="SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey || ',' || (o_custkey + 1) END AS ids FROM orders",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("o_custkey").cast("string"), (F.col("o_custkey") + 1).cast("string")
    wrapped = F.concat(F.lit('{"results": [{"id": "'), a, F.lit('", "type": "x"}, {"id": '), b, F.lit("}, {}]}"))
    bare = F.concat(F.lit("["), a, F.lit(', "'), b, F.lit('"]'))
    text = F.when(F.col("o_orderstatus") == "F", wrapped).when(F.col("o_orderstatus") == "O", bare)
    return table(spark, d, "orders").select("o_orderkey", F.array_join(N.association_ids(text), ",").alias("ids"))


@query(
    "nested_to_json",
    "O-64",
    sql="""
SELECT c_custkey AS id, '{"title":"' || c_name || '","country":{"segment":"' || c_mktsegment || '","nation":' || c_nationkey || '}}' AS snippet
FROM customer
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return H.nested_to_json(_channel(spark, d), ["snippet"]).select("id", "snippet")


@query(
    "polymorphic_text",
    "O-65",
    sql="""
SELECT event_id, CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN '["a",1]' WHEN 'error' THEN 'plain'
                 WHEN 'signup' THEN event_id::VARCHAR END AS text FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    value = (
        F.when(kind == "click", F.lit("true"))
        .when(kind == "view", F.lit('["a", 1]'))
        .when(kind == "error", F.lit('"plain"'))
        .when(kind == "signup", F.col("event_id").cast("string"))
        .otherwise("null")
    )
    return table(spark, d, "events").select("event_id", N.poly_to_text(value).alias("text"))


@query(
    "reference_struct",
    "O-66",
    sql="""
SELECT c_custkey, CASE WHEN c_nationkey <> 0 THEN c_nationkey::VARCHAR END AS id, CASE WHEN c_nationkey <> 0 THEN 'Nation' END AS type,
       CASE WHEN c_nationkey <> 0 THEN c_mktsegment END AS name FROM customer
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    key = F.when(F.col("c_nationkey") != 0, F.col("c_nationkey").cast("string"))
    document = F.to_json(F.struct(key.alias("id"), F.lit("Nation").alias("resourceType"), F.col("c_mktsegment").alias("name")))
    return table(spark, d, "customer").select("c_custkey", N.ref_struct(document).alias("r")).select("c_custkey", "r.*")


@query(
    "value_with_fallback",
    "O-67",
    sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'top' ELSE o_orderpriority END AS status, 1::BIGINT AS answers FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    entry = F.struct(F.lit(None).cast("string").alias("choiceText"), F.col("o_orderpriority").alias("textEntry"))
    values = F.create_map(F.lit("status"), entry, F.lit("QID1"), entry)
    top = F.when(F.col("o_orderstatus") == "O", "top")
    rest = N.without_keys(values, ["status", "_recordId"])
    return table(spark, d, "orders").select(
        "o_orderkey", N.value_with_fallback(top, values, "status").alias("status"), F.size(rest).cast("bigint").alias("answers")
    )


@query(
    "columns_by_kind",
    "O-68",
    sql="""
SELECT p_partkey, CASE WHEN p_type LIKE '%PROMO%' THEN p_brand END AS campaign, CASE WHEN p_type LIKE '%SMALL%' THEN p_size END AS length,
       CASE WHEN p_type LIKE '%PROMO%' OR p_type LIKE '%SMALL%' THEN p_name END AS label FROM part
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    specs = {
        "PROMO": {"campaign": F.col("p_brand"), "label": F.col("p_name")},
        "SMALL": {"length": F.col("p_size"), "label": F.col("p_name")},
    }
    return H.columns_by_kind(table(spark, d, "part"), F.col("p_type"), specs).select("p_partkey", "campaign", "length", "label")


@query(
    "junction_rows",
    "O-69",
    sql="""
SELECT o_custkey || '_' || o_orderkey AS id, o_custkey AS parent_id, o_orderkey AS child_id, 'Orders' AS module FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return H.junction(table(spark, d, "orders"), F.col("o_custkey"), F.col("o_orderkey"), "Orders")


@query("result_position", "O-70", sql="SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) - 1 AS position FROM part")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", "p_retailprice")
    return H.with_position(rows, [F.col("p_retailprice").desc(), F.col("p_partkey").asc()]).select("p_partkey", "position")


@query(
    "hoist_fields",
    "O-71",
    sql="SELECT c_custkey AS id, c_mktsegment AS segment, '/nation/' || c_nationkey || '/customer/' || c_custkey AS url FROM customer",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    url = F.concat(F.lit("/nation/"), F.col("snippet.country.nation"), F.lit("/customer/"), F.col("id"))
    return H.hoist(_channel(spark, d), {"segment": "snippet.country.segment", "url": url}).select("id", "segment", "url")


@query(
    "empty_to_null",
    "O-72",
    sql="""
SELECT c_custkey, c_mktsegment = 'BUILDING' AS no_text, c_mktsegment = 'BUILDING' AS no_struct, c_mktsegment <> 'MACHINERY' AS no_map FROM customer
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    building, machinery = F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment") == "MACHINERY"
    text = F.when(building, "").otherwise(F.col("c_name"))
    rows = table(spark, d, "customer").select(
        "c_custkey",
        text.alias("text"),
        F.struct(F.struct(text.alias("a")).alias("inner")).alias("struct"),
        F.when(machinery, F.create_map(F.lit("a"), F.lit(1))).otherwise(F.from_json(F.lit("{}"), "map<string,int>")).alias("map"),
    )
    return H.empty_to_null(rows).select(
        "c_custkey", F.isnull("text").alias("no_text"), F.isnull("struct").alias("no_struct"), F.isnull("map").alias("no_map")
    )


@query(
    "hierarchy",
    "O-73",
    sql="""
WITH RECURSIVE edges AS (
  SELECT p_partkey, CASE WHEN p_partkey > 0 THEN p_partkey // 10 END AS parent FROM part),
walk AS (
  SELECT p_partkey, parent, 0 AS depth FROM edges WHERE parent IS NULL
  UNION ALL SELECT e.p_partkey, e.parent, w.depth + 1 FROM edges e JOIN walk w ON e.parent = w.p_partkey)
SELECT p_partkey, parent, depth::BIGINT AS depth FROM walk
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    parent = F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 10).cast("bigint"))
    return H.hierarchy(table(spark, d, "part").select("p_partkey", parent.alias("parent")), "p_partkey", "parent")


@query(
    "hierarchy_cycles",
    "O-73",
    sql="""
WITH RECURSIVE n AS (SELECT max(event_id) AS n FROM events),
edges AS (
  SELECT event_id, CASE WHEN event_id = 0 THEN NULL WHEN event_id = n - 7 THEN n - 5 WHEN event_id = n THEN -5 ELSE event_id - 1 END AS parent
  FROM events, n),
walk AS (
  SELECT event_id, parent, 0 AS depth FROM edges WHERE parent IS NULL
  UNION ALL SELECT e.event_id, e.parent, w.depth + 1 FROM edges e JOIN walk w ON e.parent = w.event_id)
SELECT event_id, e.parent, w.depth::BIGINT AS depth,
  CASE WHEN w.depth IS NOT NULL THEN 'rooted' WHEN event_id = n THEN 'missing parent' WHEN event_id BETWEEN n - 7 AND n - 5 THEN 'cycle' ELSE 'below a cycle' END AS state
FROM edges e LEFT JOIN walk w USING (event_id), n
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """A chain as deep as the table is long, with a cycle of three near its end and one node below nothing."""
    events, last = table(spark, d, "events"), table(spark, d, "events").agg(F.max("event_id").alias("n")).scalar()
    at = F.col("event_id")
    parent = F.when(at == 0, None).when(at == last - 7, last - 5).when(at == last, -5).otherwise(at - 1)
    return H.hierarchy_states(events.select("event_id", parent.cast("bigint").alias("parent")), "event_id", "parent")


@query("tag_access", "O-74", sql="SELECT p_partkey, p_brand AS modality, p_size AS number FROM part")
def _(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(
        F.lit('{"00080060": {"vr": "CS", "Value": ["'), F.col("p_brand"), F.lit('"]}, "00200013": {"vr": "IS", "Value": ['), F.col("p_size"), F.lit("]}}")
    )
    return table(spark, d, "part").select(
        "p_partkey", N.tag_value(text, "00080060").alias("modality"), N.tag_value(text, "00200013", "int").alias("number")
    )


# ---------------------------------------------------------------- names and scalars


@query(
    "snake_case",
    "O-152",
    sql="""
SELECT p_partkey, lower(regexp_replace(regexp_replace(n, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g'), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS name
FROM (SELECT p_partkey, 'partName' || replace(p_brand, '#', 'ID') || upper(p_type) || 'KeyValue' AS n FROM part)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("partName"), F.regexp_replace("p_brand", "#", "ID"), F.upper("p_type"), F.lit("KeyValue"))
    return table(spark, d, "part").select("p_partkey", L.snake_case(name).alias("name"))


@query("snake_keys", "O-152", sql="SELECT c_custkey AS cust_key, c_name AS first_name, c_nationkey AS n FROM customer")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("custKey"),
        F.struct(F.col("c_name").alias("firstName")).alias("userInfo"),
        F.create_map(F.lit("homeNation"), F.col("c_nationkey")).alias("extraData"),
    )
    named = L.snake_keys(rows)
    return named.select("cust_key", F.col("user_info.first_name").alias("first_name"), F.col("extra_data")["home_nation"].alias("n"))


@query(
    "safe_names",
    "O-153",
    sql="""
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN '_col' || p_size
                  ELSE trim(regexp_replace(p_name || '_' || p_brand, '[^a-zA-Z0-9]+', '_', 'g'), '_') END AS name FROM part
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    header = F.when(F.col("p_type") == "PROMO", "  ").otherwise(F.concat(F.lit(" "), "p_name", F.lit("__ ("), "p_brand", F.lit(") ")))
    return table(spark, d, "part").select("p_partkey", L.safe_name(header, F.col("p_size")).alias("name"))


@query(
    "odata_dates",
    "O-154",
    sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS at FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    offset = F.when(F.col("o_orderstatus") == "F", "+0530").otherwise("")
    text = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(F.concat(F.lit("/Date("), millis, offset, F.lit(")/")))
    return table(spark, d, "orders").select("o_orderkey", L.odata_date(text).alias("at"))


@query(
    "epoch_millis",
    "O-155",
    sql="SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS at FROM orders",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")
    text = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(millis)
    return table(spark, d, "orders").select("o_orderkey", L.epoch_ms(text).alias("at"))


@query("compact_dates", "O-156", sql="SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS day FROM orders")
def _(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "(other)").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return table(spark, d, "orders").select("o_orderkey", L.ymd(text).alias("day"))


@query(
    "any_datetime",
    "O-157",
    sql="SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN date_trunc('second', ts) ELSE ts END AS at FROM events",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts")
    text = (
        F.when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "error", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    )
    return table(spark, d, "events").select("event_id", L.any_timestamp(text).cast("timestamp_ntz").alias("at"))


@query(
    "iso_any_fraction",
    "O-158",
    sql="SELECT event_id, CASE WHEN event_type = 'click' THEN date_trunc('millisecond', ts) ELSE ts END AS at FROM events",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(F.col("event_type") == "click", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")))
        .when(F.col("event_type") == "view", F.concat(micros, F.lit("999Z")))
        .otherwise(F.concat(micros, F.lit("+00:00")))
    )
    return table(spark, d, "events").select("event_id", K.iso_any_fraction(text).cast("timestamp_ntz").alias("at"))


@query(
    "canonical_utc",
    "O-159",
    sql="SELECT event_id, strftime(ts - INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%SZ') AS at FROM events",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30"))
    return table(spark, d, "events").select("event_id", L.canonical_utc(text).alias("at"))


@query("content_preview", "O-160", sql="SELECT conv_id, turn, left(text, 100) AS preview FROM conversations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", L.preview(F.col("text")).alias("preview"))


@query("base64_text", "O-161", sql="SELECT doc_id, md5(text) AS digest FROM documents")
def _(spark: SparkSession, d: str) -> DataFrame:
    payload = F.base64(F.encode("text", "UTF-8"))
    return table(spark, d, "documents").select("doc_id", F.md5(L.b64_text(payload)).alias("digest"))


@query(
    "row_digest",
    "O-162",
    sql="""
SELECT n_nationkey, substr(sha1('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}'), 1, 16) AS digest
FROM nation
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return nation.select("n_nationkey", S.row_digest(nation).alias("digest"))


@query(
    "typed_metrics",
    "O-163",
    sql="""
SELECT event_id, CASE WHEN event_type = 'click' THEN user_id END AS whole,
       CASE WHEN event_type = 'purchase' THEN round(value, 2) END AS real, CASE WHEN event_type NOT IN ('click', 'purchase', 'error') THEN 'n/a' END AS text
FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("event_type")
    header = F.when(kind == "click", "TYPE_INTEGER").when(kind == "purchase", "TYPE_CURRENCY").when(kind == "error", "TYPE_FLOAT").otherwise("TYPE_OTHER")
    value = F.when(kind == "click", F.col("user_id").cast("string")).when(kind == "purchase", F.col("value").cast("string")).otherwise("n/a")
    whole, real, text = L.typed_metric(value, header)
    return table(spark, d, "events").select("event_id", whole.alias("whole"), F.round(real, 2).alias("real"), text.alias("text"))


@query(
    "entity_reference_keys",
    "O-164",
    sql="""
SELECT o_orderkey AS at, CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS OrderID,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority || '''s' END AS Lang FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    entity = F.when(F.col("o_orderstatus") == "P", "Suppliers").otherwise("svc.Orders")
    reference = F.concat(
        F.lit("https://host/odata/"), entity, F.lit("(OrderID="), F.col("o_orderkey"), F.lit(",Lang='"), F.col("o_orderpriority"), F.lit("''s')?x=1")
    )
    keys = L.key_from_reference(reference, ["OrderID", "Lang"], {"OrderID": "bigint"}, "Orders")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("at"), *[c.alias(k) for k, c in keys.items()])


@query(
    "composite_key",
    "O-165",
    sql="""SELECT l_orderkey, l_linenumber, '["' || l_orderkey || '","' || l_linenumber || '"]' AS key FROM lineitem""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", S.composite_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("key")
    )


# ---------------------------------------------------------------- sources


@query("table_scan", "O-16", "O-17", sql="SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS total FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = readers.read_table(spark, f"{d}/lineitem.parquet")
    recent = S.slice_range(rows, "l_shipdate", dt.datetime(1997, 1, 1), low_inclusive=True)
    return recent.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query("sample_read", "O-25", sql="SELECT count(*) AS n FROM (FROM documents LIMIT 20)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return readers.sample(table(spark, d, "documents"), 20).agg(F.count(F.lit(1)).alias("n"))


def _namespaces(spark: SparkSession, d: str) -> DataFrame:
    """Customers as tables in region / nation namespaces."""
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(F.array("r_name", "n_name").alias("namespace"), F.col("c_name").alias("name"))


@query(
    "list_namespaces",
    "O-21",
    sql="""
SELECT DISTINCT r_name AS level_1, n_name AS level_2 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    found = catalog.list_namespaces(_namespaces(spark, d), ["ASIA"])
    return found.select(F.get("namespace", F.lit(0)).alias("level_1"), F.get("namespace", F.lit(1)).alias("level_2"))


@query(
    "list_tables",
    "O-22",
    sql="SELECT c_name AS name FROM customer WHERE c_nationkey = 7",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    region = table(spark, d, "nation").filter("n_nationkey = 7").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    first = region.select("r_name", "n_name").first()
    return catalog.list_tables(_namespaces(spark, d), [first["r_name"], first["n_name"]]).select("name")


@query("list_objects", "O-23", sql="SELECT DISTINCT p_name AS name FROM part WHERE regexp_matches(p_name, '(?i)^RED .*g')")
def _(spark: SparkSession, d: str) -> DataFrame:
    return catalog.list_objects(table(spark, d, "part").select(F.col("p_name").alias("name")), "^red .*G")


@query(
    "object_metadata",
    "O-24",
    sql="SELECT p_partkey, 'p_brand' AS key, p_brand AS value FROM part",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return catalog.object_metadata(table(spark, d, "part"), "P_BRAND", keep=["p_partkey"])


def _event_schema() -> T.StructType:
    return T.StructType.fromDDL("id bigint, kind string, k int")


def _event_lines(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON lines per user; error events are cut off in the middle."""
    line = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").cast("int").alias("k")))
    damaged = F.when(F.col("event_type") == "error", F.substring(line, 1, 12)).otherwise(line)
    day = F.col("ts").cast("date").alias("day")
    return table(spark, d, "events").select("user_id", day, F.concat(damaged, F.lit("\n\n")).alias("text"))


@query(
    "json_lines_tolerant",
    "O-28",
    sql="SELECT user_id, event_id AS id, event_type AS kind, (props->>'k')::INT AS k FROM events WHERE event_type <> 'error'",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return readers.parse_json_events(_event_lines(spark, d).drop("day"), "text", _event_schema())[0]


@query(
    "json_lines_counted",
    "O-28",
    sql="SELECT count(*) FILTER (event_type <> 'error') AS good, count(*) FILTER (event_type = 'error') AS bad, 2 * count(*) AS blank FROM events",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return readers.parse_json_events(_event_lines(spark, d), "text", _event_schema())[1]


@query(
    "json_wrapped_arrays",
    "O-26",
    sql=f"WITH {_CHILDREN} SELECT id AS doc, part AS id, kind FROM children WHERE parent_status <> 'P'",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    items = F.to_json(F.transform("lines", lambda x: F.struct(x["part"].alias("id"), x["kind"].alias("kind"))))
    text = (
        F.when(F.col("status") == "O", items)
        .when(F.col("status") == "F", F.concat(F.lit('{"data": '), items, F.lit("}")))
        .otherwise(F.concat(F.lit('{"other": '), items, F.lit("}")))
    )
    rows = order_documents(spark, d).select(F.col("id").alias("doc"), text.alias("text"))
    return readers.unwrap_events(rows, "text", T.StructType.fromDDL("id bigint, kind string"))


@query(
    "csv_report",
    "O-27",
    sql="SELECT c_custkey, c_name AS customer_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS market_segment FROM customer",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    line = F.concat(F.lit('"'), F.col("c_name"), F.lit('",'), segment)
    rows = table(spark, d, "customer").select("c_custkey", line.alias("line"))
    return readers.parse_csv_rows(rows, "line", ["﻿Customer Name", "Market Segment"])


@query(
    "grid_table",
    "O-31",
    sql="""
SELECT (o_orderkey + 2)::VARCHAR AS row_index, o_orderkey::VARCHAR AS order_no, CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderpriority END AS _col1 FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = F.when(F.col("o_orderstatus") == "O", F.array(F.col("o_orderkey").cast("string"))).otherwise(
        F.array(F.col("o_orderkey").cast("string"), "o_orderpriority")
    )
    body = table(spark, d, "orders").select((F.col("o_orderkey") + 2).alias("place"), cells.alias("values"))
    head = spark.range(1).select(F.lit(1).cast("bigint").alias("place"), F.array(F.lit("order no"), F.lit(" ")).alias("values"))
    grid = head.unionByName(body)
    return H.grid_to_table(grid, "values", "place", H.grid_names(grid, "values", "place"))


@query("edm_types", "O-32", sql="SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'decimal(38,' || least(p_size, 38) || ')' WHEN 'SMALL' THEN 'bigint' ELSE 'string' END AS type FROM part")
def _(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("p_type") == "PROMO", "Edm.Decimal").when(F.col("p_type") == "SMALL", "Edm.Int64").otherwise("Edm.Duration")
    return table(spark, d, "part").select("p_partkey", readers.edm_type(kind, F.lit(40), F.col("p_size")).alias("type"))


# ---------------------------------------------------------------- checks


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """Events as documents whose fields differ by type."""
    extra = F.when(F.col("event_type") == "click", F.struct(F.col("value").alias("x"), F.col("user_id").alias("y")))
    body = F.struct(
        F.col("event_id").alias("id"), extra.alias("position"), F.when(F.col("event_type") == "view", F.col("ts").cast("string")).alias("seen")
    )
    return table(spark, d, "events").select(F.to_json(body).alias("document"))


@query("field_paths", "O-179", sql="SELECT unnest(['id', 'position', 'position.x', 'position.y', 'seen']) AS path, count(*) > 0 AS any FROM events GROUP BY 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return checks.field_paths(_documents(spark, d), "document").withColumn("any", F.lit(True))


@query("field_sets", "O-151", sql="SELECT * FROM (VALUES ('id', 'both'), ('position', 'both'), ('gone', 'declared'), ('position.x', 'seen'), ('position.y', 'seen'), ('seen', 'seen')) t(path, place)")
def _(spark: SparkSession, d: str) -> DataFrame:
    declared = checks.schema_paths(spark, T.StructType.fromDDL("id bigint, position map<string, double>, gone string"))
    return checks.field_sets(declared, checks.field_paths(_documents(spark, d), "document"))


@query(
    "path_counts",
    "O-151",
    "O-179",
    "O-180",
    sql="""
SELECT 'id' AS path, count(*) AS n, 'value' AS kind FROM events
UNION ALL SELECT 'by', count(*), 'map' FROM events
UNION ALL SELECT 'by.*', count(*), 'struct' FROM events
UNION ALL SELECT 'by.*.value', count(value), 'value' FROM events
UNION ALL SELECT 'steps', count(*), 'array' FROM events WHERE event_id % 3 = 0
UNION ALL SELECT 'steps.no', 2 * count(*), 'value' FROM events WHERE event_id % 3 = 0
UNION ALL SELECT 'at_' || event_type, count(*), 'struct' FROM events GROUP BY event_type
UNION ALL SELECT 'at_' || event_type || '.user', count(*), 'value' FROM events GROUP BY event_type
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """Documents with an object keyed by an id of its own, one whose name differs by kind, and lists of objects."""
    steps = F.when(F.col("event_id") % 3 == 0, F.array(*[F.struct(F.lit(i).alias("no")) for i in (1, 2)]))
    fields = {
        "id": F.col("event_id"),
        "by": F.create_map(F.concat(F.lit("e"), "event_id"), F.struct("value")),
        "steps": steps,
    }
    document = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    named = F.to_json(F.create_map(F.concat(F.lit("at_"), "event_type"), F.struct(F.col("user_id").alias("user"))))
    both = F.concat(F.substring(document, F.lit(1), F.char_length(document) - 1), F.lit(","), F.substring(named, F.lit(2), F.char_length(named)))
    return checks.path_counts(table(spark, d, "events").select(both.alias("document")), "document", most_keys=100)


@query("schema_drift", "O-180", sql="SELECT 'seen' AS path")
def _(spark: SparkSession, d: str) -> DataFrame:
    schema = T.StructType.fromDDL("id bigint, position map<string, double>, gone string")
    return checks.schema_drift(_documents(spark, d), "document", schema)


@query(
    "column_population",
    "O-181",
    sql="""
SELECT 'o_orderkey' AS "column", count(*) AS filled, false AS never_filled FROM orders
UNION ALL SELECT 'urgent', count(*) FILTER (o_orderpriority = '1-URGENT'), false FROM orders
UNION ALL SELECT 'note', 0, true FROM orders GROUP BY 1 UNION ALL SELECT 'hint', 0, false FROM orders GROUP BY 1
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).alias("urgent")
    empty = F.lit(None).cast("string")
    rows = table(spark, d, "orders").select("o_orderkey", urgent, empty.alias("note"), empty.alias("hint"))
    return checks.column_population(rows, allow=["hint"])


@query(
    "required_nulls",
    "O-182",
    sql="""
SELECT 'urgent' AS "column", count(*) FILTER (o_orderpriority <> '1-URGENT') AS nulls FROM orders
UNION ALL SELECT '*', count(*) FILTER (o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'F') FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).alias("urgent"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("finished"),
    )
    return checks.required_nulls(rows, ["urgent"])


@query(
    "duplicate_keys",
    "O-184",
    sql="SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return checks.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("synthetic_rows", "O-185", sql="SELECT 'order_' || o_orderkey AS \"order\", o_orderkey AS version FROM orders")
def _(spark: SparkSession, d: str) -> DataFrame:
    schema = T.StructType.fromDDL("order string not null, version bigint, note string, amount double, at timestamp, tags array<string>")
    ids = table(spark, d, "orders").select("o_orderkey")
    return checks.synthetic(ids, schema, ["order"], "version", id_column="o_orderkey").select("order", "version")


@query(
    "metadata_contract",
    "O-20", "O-183",
    sql="""
SELECT * FROM (VALUES ('bad', 'unknown ingestion type'), ('orders', 'key not in schema'), ('events', 'no cursor')) t(tableName, problem)
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    configs = {
        "customer": {"primary_keys": ["c_custkey"], "ingestion_type": "snapshot"},
        "orders": {"primary_keys": ["order_key"], "cursor_field": "o_orderdate", "ingestion_type": "cdc"},
        "events": {"primary_keys": ["event_id"], "ingestion_type": "cdc_with_deletes"},
        "bad": {"primary_keys": ["n_nationkey"], "ingestion_type": "mirror"},
    }
    files = {"customer": "customer", "orders": "orders", "events": "events", "bad": "nation"}
    schemas = [(name, table(spark, d, file).schema) for name, file in files.items()]
    return catalog.metadata_problems(catalog.catalog_metadata(spark, list(configs), configs), catalog.schemas_frame(spark, schemas))


@query("count_check", "O-93", sql="SELECT lang, source, count(*) AS n, min(doc_id) AS oldest, max(doc_id) AS newest FROM documents GROUP BY 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return reports.group_bounds(table(spark, d, "documents"), ["lang", "source"], "doc_id")


@query("file_scan", "O-29", sql="SELECT c_custkey, c_name AS value FROM customer")
def _(spark: SparkSession, d: str) -> DataFrame:
    import uuid

    from feedweir.session import checkpoint_dir

    folder = f"{checkpoint_dir(spark)}/scan-{uuid.uuid4().hex}"
    line = F.concat(F.col("c_custkey"), F.lit("|"), F.col("c_name")).alias("value")
    table(spark, d, "customer").select(line).write.text(folder)
    found = readers.scan_files(spark, folder, "*.txt", since=dt.datetime(2000, 1, 1), wholetext="false")
    parts = F.split("value", r"\|")
    return found.select(parts[0].cast("bigint").alias("c_custkey"), parts[1].alias("value"))


@query(
    "skipped_files",
    "O-29",
    "O-26",
    sql="""
SELECT 'whole' AS file, 'read' AS status, count(*) AS rows FROM customer
UNION ALL SELECT 'broken.gz', 'partly', 0
UNION ALL SELECT 'none.gz', 'unread', 0
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """Lines of gzip files, one of which is cut off and one is none at all: rows, and the files that are not all there."""
    import gzip
    import uuid

    from feedweir.session import checkpoint_dir
    from feedweir.sources.sinks import _hadoop

    folder = f"{checkpoint_dir(spark)}/skipped-{uuid.uuid4().hex}"
    line = F.concat(F.col("c_custkey"), F.lit("|"), F.col("c_name")).alias("value")
    table(spark, d, "customer").select(line).write.option("compression", "gzip").text(folder)
    fs, path = _hadoop(spark, folder)
    lines = gzip.compress(b"".join(b"line %d\n" % i for i in range(50_000)))
    for name, content in (("broken.gz", lines[: len(lines) // 2]), ("none.gz", b"no archive at all")):
        out = fs.create(path(f"{folder}/{name}"), True)
        out.write(bytearray(content))
        out.close()
    found = readers.scan_files(spark, folder, "*.gz", wholetext="false")
    skipped = readers.skipped_files(spark, found, folder, "*.gz")
    rows = found.filter("value LIKE '%|%'").agg(F.lit("whole").alias("file"), F.lit("read").alias("status"), F.count("*").alias("rows"))
    names = F.regexp_extract("source_file", "[^/]+$", 0)
    return rows.unionByName(skipped.select(names.alias("file"), "status", F.lit(0).cast("bigint").alias("rows")))


@query("named_operation", "O-177", sql="SELECT DISTINCT p_name AS name FROM part WHERE regexp_matches(p_name, '(?i)widget$')")
def _(spark: SparkSession, d: str) -> DataFrame:
    from feedweir.plans.extensions import operation, run_operation

    @operation("list_objects", {"search": False}, "name string", kind="metadata")
    def objects(session: SparkSession, search: str | None = None) -> DataFrame:
        return catalog.list_objects(table(session, d, "part").select(F.col("p_name").alias("name")), search)

    return run_operation(spark, "list_objects", search="widget$")


@query("custom_reader", "O-178", sql="SELECT event_id, user_id, event_type FROM events")
def _(spark: SparkSession, d: str) -> DataFrame:
    from feedweir.plans.extensions import register_reader

    columns = ["event_id", "user_id", "event_type"]

    def plan(options):
        import pyarrow.parquet as pq

        return list(range(pq.ParquetFile(options["path"]).num_row_groups))

    def read(options, group):
        import pyarrow.parquet as pq

        yield from pq.ParquetFile(options["path"]).iter_batches(row_groups=[group], columns=columns)

    register_reader(spark, "row_groups", "event_id bigint, user_id bigint, event_type string", plan, read)
    return spark.read.format("row_groups").option("path", f"{d}/events.parquet").load()
