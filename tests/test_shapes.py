"""Coercion, nested shaping, names, references, files and checks on hand-written rows."""

import base64
import datetime as dt
import gzip
import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.functions import coercion as V
from feedweir.functions import filters as P
from feedweir.functions import nested as N
from feedweir.functions import scalars as L
from feedweir.operators import checks
from feedweir.operators import shaping as H
from feedweir.domains import hl7
from feedweir.sources import catalog, readers, sinks


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(fn(F.col("x")).alias("y")).first()["y"]


def ddl(text):
    return T.StructType.fromDDL(text)


@pytest.mark.parametrize("text, value", [("7", 7), (" 7 ", 7), ("7.9", 7), ("-7.9", -7), ("1.5e3", 1500), ("7e3", None), ("", None), ("x", None)])
def test_integers(spark, text, value):
    assert one(spark, text, lambda c: V.to_integer(c, T.LongType())) == value


@pytest.mark.parametrize("text, value", [("YES", True), ("t", True), ("0", False), ("N", False), ("other", True), ("", False), (None, None)])
def test_booleans(spark, text, value):
    assert one(spark, text, V.to_boolean) is value


@pytest.mark.parametrize("text", ["2024-03-04", "03/04/2024", "04-03-2024", "2024/03/04", "2024-03-04T23:59:59"])
def test_dates(spark, text):
    assert one(spark, text, V.to_date) == dt.date(2024, 3, 4)


@pytest.mark.parametrize("text", ["2024-03-04T05:06:07Z", "2024-03-04T07:06:07+02:00", "2024-03-04 05:06:07", "2024/03/04 05:06:07"])
def test_timestamps(spark, text):
    assert one(spark, text, lambda c: V.to_timestamp(c).cast("string")) == "2024-03-04 05:06:07"


def test_binary(spark):
    assert one(spark, base64.b64encode(b"hello").decode(), V.to_binary) == b"hello"
    assert one(spark, "not base64 or hex!", V.to_binary) == b"not base64 or hex!"


def test_coerce_fails_or_collects(spark):
    df = spark.createDataFrame([("1", "x"), ("bad", "y")], "a string, b string")
    with pytest.raises(Exception, match="cannot convert 'bad'"):
        V.coerce(df, ddl("a int, b string")).collect()
    found = V.coerce(df, ddl("a int, b string, c double"), "permissive").collect()
    assert [(r["a"], r["c"], r[V.ERRORS]) for r in found] == [(1, None, []), (None, None, ["a"])]
    with pytest.raises(ValueError):
        V.coerce(df, T.StructType([T.StructField("z", T.StringType(), False)]))


def test_coerce_nested_json(spark):
    schema = ddl("s struct<a: int, b: array<double>>, l array<int>, m map<string, boolean>")
    df = spark.createDataFrame([('{"a": "3.7", "b": ["1", 2]}', "5", '{"k": "yes"}')], "s string, l string, m string")
    row = V.coerce(df, schema).first()
    assert row["s"].asDict() == {"a": 3, "b": [1.0, 2.0]} and row["l"] == [5] and row["m"] == {"k": True}
    empty = spark.createDataFrame([("{}", None, None)], "s string, l string, m string")
    with pytest.raises(Exception, match="empty object"):
        V.coerce(empty, schema).collect()


def test_broken_json_is_an_error(spark):
    schema = ddl("s struct<a: int, b: array<double>>, m map<string, int>")
    texts = ['{"a": 1, "b": [2]}', '{"a": 1', "no json", '{"a": "x"}', '{"a": 1, "b": {"c": 1}}', None]
    df = spark.createDataFrame([(t, '{"k": 1}') for t in texts], "s string, m string")
    found = V.coerce(df, schema, "permissive").collect()
    assert [r[V.ERRORS] for r in found] == [[], ["s"], ["s"], ["s"], ["s"], []]
    assert found[0]["s"].asDict() == {"a": 1, "b": [2.0]} and found[5]["s"] is None and found[0]["m"] == {"k": 1}
    good = spark.createDataFrame([(texts[0], None)], "s string, m string")
    assert V.coerce(good, schema).first()["s"].asDict() == {"a": 1, "b": [2.0]}
    for broken in texts[1:5]:
        with pytest.raises(Exception, match="no JSON of the expected shape|cannot convert"):
            V.coerce(spark.createDataFrame([(broken,)], "s string"), ddl("s struct<a: int, b: array<double>>")).collect()
    bad = spark.createDataFrame([("[1, x", '{"k": "y"}')], "l string, m string")
    assert V.coerce(bad, ddl("l array<int>, m map<string, int>"), "permissive").first()[V.ERRORS] == ["l", "m"]


def test_predicates_and_nulls(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "n int, s string")
    assert rows(P.apply_predicates(df, [("s", "ne", "a")])) == [(2, None), (3, "c")]
    assert rows(P.apply_predicates(df, [("s", "eq", "a")])) == [(1, "a")]
    assert rows(P.apply_predicates(df, [("n", "gt", "no number")])) == []
    assert rows(P.apply_predicates(df, [("n", "in", "1, 3"), ("s", "ne", "c")])) == [(1, "a")]
    assert df.filter(P.all_of(None, None)).count() == 3
    spec = {"not": {"or": [("n", "eq", 1), ("s", "eq", "c")]}}
    assert df.filter(F.coalesce(P.condition(df.schema, spec), F.lit(True))).count() == 1
    with pytest.raises(ValueError):
        P.parse_filter_option('{"limit": 1}', ["limit"])


def test_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(ValueError, match="available: a, b"):
        H.select_columns(df, ["a", "zz"])
    with pytest.raises(ValueError):
        H.pad_columns(df, ddl("k int, a int"), never=["k"])
    assert H.ancestor_names(["p", "q", "r"], {"p": ["id"], "q": ["id"]}, ["p_id"]) == {("p", "id"): "_p_id", ("q", "id"): "q_id"}
    assert H.ancestor_names(["p", "q"], {"p": ["id"]}, [], exclude="*") == {}
    with pytest.raises(ValueError):
        H.level_filters(["p"], {"nope": F.lit(True)})
    assert len(H.level_filters(["p", "q"], {"q": F.lit(True), 1: F.lit(False)})) == 1


def test_null_ancestor_key_fails(spark):
    df = spark.createDataFrame([(None, 1)], "p_id int, id int")
    with pytest.raises(Exception, match="null ancestor key"):
        H.require_ancestor_keys(df, ["p_id"]).collect()


def test_hierarchy_any_shape(spark, rows):
    chain = [(i, i - 1 if i else None) for i in range(40)]
    fan = [(100 + i, 3) for i in range(50)]
    lost = [(500, 501), (510, 500), (600, 601), (601, 600), (700, 700)] + [(800 + i, 799 + i if i else 600) for i in range(21)]
    df = spark.createDataFrame(chain + fan + lost, "id bigint, parent bigint")
    found = {r[0]: r[2] for r in rows(H.hierarchy(df, "id", "parent"))}
    assert found == {i: i for i in range(40)} | {100 + i: 4 for i in range(50)}
    states = {r["id"]: r["state"] for r in H.hierarchy_states(df, "id", "parent").filter("depth IS NULL").collect()}
    assert states == {500: H.ORPHAN, 510: H.ORPHAN, 600: H.CYCLE, 601: H.CYCLE, 700: H.CYCLE} | {800 + i: H.BELOW for i in range(21)}
    assert H.hierarchy_states(df.limit(0), "id", "parent").count() == 0


def _walked(edges):
    """State and depth of every node, climbed one by one."""
    parent, found = dict(edges), {}
    for key in parent:
        seen, at = [], key
        while at is not None and at in parent and at not in seen:
            seen.append(at)
            at = parent[at]
        if at is None:
            found[key] = (H.ROOTED, len(seen) - 1)
        elif at not in parent:
            found[key] = (H.ORPHAN, None)
        else:
            found[key] = (H.CYCLE if parent[seen[-1]] == key or key in seen[seen.index(at):] else H.BELOW, None)
    return found


@pytest.fixture(scope="module")
def few_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hierarchy_of_many_nodes_thins_out_first(spark, few_tasks, monkeypatch):
    """A deep chain is not climbed by all its nodes; cycles of any length, trees, orphans and shared keys come out as before."""
    dice = random.Random(5)
    ring = [(2000 + i, 2000 + (i + 1) % 60) for i in range(60)]
    hung = [(3000 + i, dice.choice([2000 + dice.randrange(60), 3000 + dice.randrange(max(i, 1)) if i else 2000])) for i in range(80)]
    chain = [(i, i - 1 if i else None) for i in range(300)]
    bush = [(1000 + i, 1000 + (i - 1) // 5 if i else 250) for i in range(200)]
    lost = [(4000 + i, 3999 + i if i else -1) for i in range(70)]
    edges = chain + ring + hung + bush + lost + [(5000, 5000), (5001, 5000), (5002, 5003), (5003, 5002), (5004, 5003)]
    dice.shuffle(edges)
    climbed, doubled = [], H._doubled
    monkeypatch.setattr(H, "_doubled", lambda climb: climbed.append(climb.count()) or doubled(climb))
    df = spark.createDataFrame(edges, "id string, up string")
    found = H.hierarchy_states(df, "id", "up", few=60).collect()
    assert climbed[0] <= 60
    assert {int(r["id"]): (r["state"], r["depth"]) for r in found} == _walked(edges) and len(found) == len(edges)


def test_hierarchy_keeps_a_row_for_each_way(spark, few_tasks, rows):
    """A key of two rows gives every node below it two; a null key is a node that none hangs below."""
    chain = [(i, i - 1 if i else None) for i in range(60)]
    df = spark.createDataFrame(chain + [(20, 10), (None, 30), (None, None), (40, 39)], "id bigint, up bigint")
    expected = H.hierarchy_states(df, "id", "up")
    assert expected.filter("id = 59").count() == 4 and expected.count() == 60 + 40 + 20 * 2 + 3
    assert rows(H.hierarchy_states(df, "id", "up", few=20)) == rows(expected)


def test_series_tolerates_short_rows(spark, rows):
    df = spark.createDataFrame([(["d1", "d2"], [[1, 2], [3]], ["a"])], "x array<string>, s array<array<int>>, l array<string>")
    assert rows(H.series_to_rows(df, "x", "s", "l")) == [("d1", 1, "a"), ("d1", 3, "Totals"), ("d2", 2, "a")]


def test_empty_values(spark):
    df = spark.createDataFrame([("", {}, ("", None))], "t string, m map<string,int>, s struct<a:string,b:int>")
    assert tuple(H.empty_to_null(df).first()) == (None, None, None)


def test_polymorphic_and_references(spark):
    assert one(spark, "true", N.poly_to_text) == "true"
    assert one(spark, '"x"', N.poly_to_text) == "x"
    assert one(spark, "null", N.poly_to_text) is None
    assert one(spark, '{"a": [1]}', N.poly_to_text) == '{"a":[1]}'
    assert one(spark, '{"name": "n"}', N.ref_struct) is None


@pytest.mark.parametrize("name, snake", [("responseId", "response_id"), ("HTTPServer", "http_server"), ("ipAddress2X", "ip_address2_x"), ("already_snake", "already_snake")])
def test_snake_case(spark, name, snake):
    assert one(spark, name, L.snake_case) == snake == L._snake_name(name)


@pytest.mark.parametrize("raw, name", [(" Order No. ", "Order_No"), ("", "_col3"), ("***", "_col3"), (None, "_col3"), ("a__b", "a_b")])
def test_safe_names(spark, raw, name):
    assert one(spark, raw, lambda c: L.safe_name(c, F.lit(3))) == name


def test_dates_as_text(spark):
    assert one(spark, "/Date(1234567890000+0000)/", L.odata_date) == "2009-02-13T23:31:30Z"
    assert one(spark, "/Date(-1000)/", L.odata_date) == "1969-12-31T23:59:59Z"
    assert one(spark, "2024-01-01", L.odata_date) == "2024-01-01"
    assert one(spark, "20240230", L.ymd) is None
    assert one(spark, "2024-01-01T00:00:00.123", L.any_timestamp) is not None


def test_reference_keys(spark):
    def keys(text, names, types=None, entity=None):
        df = spark.createDataFrame([(text,)], "x string")
        cols = L.key_from_reference(F.col("x"), names, types, entity)
        return tuple(df.select(*[c.alias(k) for k, c in cols.items()]).first())

    assert keys("Customers('ALFKI')", ["ID"]) == ("ALFKI",)
    assert keys("http://h/s/Orders(OrderID=1,Lang='e''n')?x#y", ["OrderID", "Lang"], {"OrderID": "int"}) == (1, "e'n")
    assert keys("Suppliers(77)", ["ID"], {"ID": "int"}, "Customers") == (None,)
    assert keys("Orders(OrderID=1)", ["OrderID", "Lang"]) == (None, None)
    assert keys("Customers('a%2Fb')", ["ID"]) == ("a/b",)
    assert keys("Customers", ["ID"]) == (None,)


def test_json_files(spark, tmp_path, rows):
    lines = '{"id": 1, "kind": "a"}\n\nbroken\n{"id": 2, "kind": "b"}\n'
    (tmp_path / "x.json").write_text(lines)
    with gzip.open(tmp_path / "y.json.gz", "wt") as out:
        out.write(lines)
    schema = ddl("id bigint, kind string")
    assert rows(readers.read_json_events(spark, str(tmp_path), schema)) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]
    assert readers.read_json_events(spark, str(tmp_path), schema, "keep").filter("_corrupt_record IS NOT NULL").count() == 2
    with pytest.raises(Exception):
        readers.read_json_events(spark, str(tmp_path), schema, "fail").collect()


def test_zipped_json(spark, tmp_path, rows):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name in ("a", "b"):
            archive.writestr(f"{name}.json.gz", gzip.compress(json.dumps({"id": 1, "kind": name}).encode() + b"\n{bad\n\n"))
    (tmp_path / "e.zip").write_bytes(buffer.getvalue())
    found = readers.read_zipped_ndjson(spark, str(tmp_path / "e.zip"), ddl("id bigint, kind string"))
    assert rows(found.drop("source_file")) == [(1, "a"), (1, "b")]


def test_csv_report(spark, tmp_path, rows):
    (tmp_path / "r.csv").write_bytes("﻿Event Time,Media Source\n2024-01-01,\n2024-01-02,x\n".encode())
    found = readers.read_csv_report(spark, str(tmp_path / "r.csv"))
    assert found.columns == ["event_time", "media_source"] and rows(found) == [("2024-01-01", None), ("2024-01-02", "x")]


def test_edmx(spark, tmp_path):
    (tmp_path / "m.xml").write_text(
        "<Schema><EntityType Name='Order'><Key><PropertyRef Name='ID'/></Key><Property Name='ID' Type='Edm.Int64' Nullable='false'/>"
        "<Property Name='Total' Type='Edm.Decimal' Precision='40' Scale='2'/></EntityType></Schema>"
    )
    found = readers.read_edmx(spark, str(tmp_path / "m.xml"))
    kinds = found.withColumn("spark", readers.edm_type(F.col("type"), F.col("precision"), F.col("scale"))).orderBy("property").collect()
    assert [(r["property"], r["spark"], r["is_key"], r["nullable"]) for r in kinds] == [("ID", "bigint", True, False), ("Total", "decimal(38,2)", False, True)]


def test_file_scan(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.hl7").write_text("MSH|^~\\&|A\rPID|1\n\nMSH|^~\\&|B\n")
    (tmp_path / "b.txt").write_text("no")
    assert readers.read_hl7(spark, str(tmp_path)).count() == 2
    future = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1)
    assert readers.scan_files(spark, str(tmp_path), "*.hl7", since=future).isEmpty()
    assert readers.scan_files(spark, str(tmp_path), "*.hl7", until=future).count() == 1


@pytest.mark.parametrize("size", ["64b", "100b", "1k", "1m"])
def test_hl7_files_cut_anywhere(spark, tmp_path, size):
    """Parts of a file that begin within a line, at a line end, between messages or before the first one."""
    end = {"a": "\r", "b": "\n", "c": "\r\n"}
    for name, cut in end.items():
        lines = ["FHS|x", "junk", ""]
        for i in range(30):
            lines += [f"{'msh' if i % 7 == 3 else 'MSH'}|^~\\&|{name}{i}", *[f"OBX|{j}|{'x' * (i * j % 23)}" for j in range(i % 4)], "" if i % 5 else "BTS|1"]
        (tmp_path / f"{name}.hl7").write_bytes(cut.join(lines).encode())
    whole = hl7.messages(readers.scan_files(spark, str(tmp_path), "*.hl7").withColumnRenamed("value", "text"))
    want = sorted((r["source_file"], r["message_no"], r["message"]) for r in whole.collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        found = readers.read_hl7(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["source_file"], r["message_no"], r["message"]) for r in found) == want and len(want) == 90


def test_skipped_files(spark, tmp_path):
    import gzip

    whole = gzip.compress(b"".join(b"line %d\n" % i for i in range(20_000)))
    files = {"a.gz": whole, "b.gz": whole[: len(whole) // 2], "c.gz": b"none", "d.txt": b"x\ny\n", "e.txt": b"", "f.gz": whole + whole}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    found = readers.scan_files(spark, str(tmp_path), wholetext="false")
    skipped = {r["source_file"].rsplit("/")[-1]: r["status"] for r in readers.skipped_files(spark, found, str(tmp_path)).collect()}
    assert skipped == {"b.gz": "partly", "c.gz": "unread"}
    with pytest.raises(Exception, match="(?i)eof|gzip|unexpected end|FAILED_READ_FILE"):
        readers.scan_files(spark, str(tmp_path), wholetext="false", strict=True).count()


def test_payload_files(spark, tmp_path, rows):
    df = spark.createDataFrame([("1.2.3", b"abc"), ("../x", b"no"), ("1.4", None)], "uid string, body binary")
    found = rows(sinks.write_payloads(df, str(tmp_path / "out"), "uid", "body", ".dcm"))
    assert [(r[0], r[2]) for r in found] == [("../x", "refused"), ("1.2.3", "written"), ("1.4", "no payload")]
    assert (tmp_path / "out" / "1.2.3.dcm").read_bytes() == b"abc"
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["1.2.3.dcm"]


def test_paths_of_documents_keyed_by_an_id(spark, rows):
    """Maps are told from structs at any depth; lists of lists, nulls, empty objects and texts that are no JSON."""
    texts = [f'{{"byid": {{"k{i}": {{"n": {i}, "deep": {{"d{i}": [[{{"z": 1}}], []]}}}}}}, "s": {{"a": null}}}}' for i in range(300)]
    texts += ["no json", "[]", "{}", '[{"top": 1}]', None, '{"s": 5}']
    found = checks.path_counts(spark.createDataFrame([(t,) for t in texts], "j string"), "j", most_keys=50)
    assert rows(found) == sorted([
        ("byid", 300, "map"), ("byid.*", 300, "struct"), ("byid.*.n", 300, "value"), ("byid.*.deep", 300, "map"),
        ("byid.*.deep.*", 300, "array"), ("byid.*.deep.*.z", 300, "value"), ("s", 301, "struct"), ("s.a", 300, "value"), ("top", 1, "value"),
    ], key=repr)
    assert checks.path_counts(spark.createDataFrame([], "j string"), "j").count() == 0


def test_values_are_not_dealt_out_by_path(spark, monkeypatch):
    """However large the tables are, no exchange sends the values of a path to one task; counts may be exchanged."""
    plans, settle = [], checks.settle

    def noted(df):
        if "v" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df)

    monkeypatch.setattr(checks, "settle", noted)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = [(f'{{"id": {i}, "by": {{"k{i}": {{"text": "x"}}}}}}',) for i in range(200)]
        found = checks.path_counts(spark.createDataFrame(texts, "j string"), "j", most_keys=50).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {r["path"]: r["n"] for r in found} == dict.fromkeys(["id", "by", "by.*", "by.*.text"], 200)
    assert len(plans) >= 3 and not any("SortMergeJoin" in p or "Exchange hashpartitioning" in p for p in plans)


def test_drift_and_population(spark, rows):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": [1], "d": {"e": 2}}}',), ('{"m": {"x": 1}}',), ("not json",)], "j string")
    assert {r[0] for r in rows(checks.field_paths(df, "j"))} == {"a", "b", "b.c", "b.d", "b.d.e", "m", "m.x"}
    schema = ddl("a int, b struct<c: array<int>, d: map<string, int>>, m map<string, int>")
    assert rows(checks.schema_drift(df, "j", schema)) == []
    assert rows(checks.schema_drift(df, "j", ddl("a int, b struct<c: array<int>>"))) == [("b.d",), ("b.d.e",), ("m",), ("m.x",)]


def test_synthetic_rows_repeat(spark, rows):
    schema = ddl("id string not null, version bigint, n double, s struct<a: int, b: string>, t timestamp, l array<int>")
    first = checks.synthetic(spark.range(300), schema, ["id"], "version")
    again = checks.synthetic(spark.range(300).repartition(5), schema, ["id"], "version")
    assert rows(first) == rows(again)
    assert first.select("id").distinct().count() == 300
    nulls = first.filter("n IS NULL").count()
    assert 30 < nulls < 90


def test_catalog_rules(spark, rows):
    assert catalog.table_name("t") == "t" and catalog.table_name("t", "c", "s", "d") == "`c`.`s`.`d`" and catalog.table_name("t", "c") == "t"
    with pytest.raises(ValueError):
        catalog.catalog_metadata(spark, ["nope"], {})
    df = spark.createDataFrame([(["a", "x"], "t1"), (["a", "y"], "t2"), (["b"], "t3"), ([], "t0")], "namespace array<string>, name string")
    assert [r[0] for r in catalog.list_namespaces(df).collect()] == [["a"], ["b"]]
    assert [r[0] for r in catalog.list_namespaces(df, ["a"]).collect()] == [["a", "x"], ["a", "y"]]
    assert rows(catalog.list_tables(df, []).select("name")) == [("t0",)]
