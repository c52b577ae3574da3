"""Clinical and subsurface formats on hand-written documents."""

import json
import re

import pytest
from pyspark.sql import functions as F

from feedweir.domains import dicom, fhir, hl7, osdu
from feedweir.functions import documents

ORU = (
    "MSH|^~\\&|LAB|HOSP|HIS|HIS|20240115140000||ORU^R01^ORU_R01|MSG2|P|2.5.1\r"
    "PID|1||MRN1^^^HOSP&1.2&ISO^MR~X2^^^ALT||Doe^John^M~Roe^Jane||197003|M||A^Asian~~B|||||||S1|AC^^^H|||N||||||||||||||||||||||\r"
    "OBX|0|NM|2951-2^Sodium^LN||138~139|mEq/L^milli\\T\\eq||N|||F|||20240115140000.123-0500\r"
    "OBX|x|ST|||a^b&c|||||||F|^\r"
    "DG1|1|ICD|E11^Diabetes|||||||||^^|10&EUR^UP^1\r"
    "ZAB|one||three"
)


def table(spark, text, segment, **kw):
    df = spark.createDataFrame([("f1", text)], "source string, text string")
    return hl7.segment_table(hl7.segments(hl7.messages(df)), segment, **kw)


def test_hl7_patient(spark):
    row = table(spark, ORU, "pid").first()
    assert (row["message_id"], row["message_timestamp"], row["hl7_version"]) == ("MSG2", "20240115140000", "2.5.1")
    ids = row["patient_id"]
    assert [i["id"] for i in ids] == ["MRN1", "X2"] and ids[0]["assigning_authority_universal_id"] == "1.2" and ids[0]["type_code"] == "MR"
    assert [n["family_name"] for n in row["patient_names"]] == ["Doe", "Roe"]
    assert row["date_of_birth"] == "1970-03-01T00:00:00" and row["administrative_sex"]["code"] == "M"
    assert [r["code"] for r in row["race"]] == ["A", "B"] and row["address"] is None and row["drivers_license"] is None
    assert row["patient_account_number"]["assigning_authority"] == "H" and row["raw_segment"].startswith("PID|1||MRN1^^^HOSP&1.2")


def test_hl7_observations(spark):
    first, second = table(spark, ORU, "OBX").orderBy("value_type").collect()
    assert first["set_id"] == 0 and second["set_id"] == 1
    assert first["observation_value"] == ["138", "139"] and second["observation_value"] == ["a^b&c"]
    assert first["units"]["text"] == "milli&eq"
    assert first["datetime_of_observation"] == "2024-01-15T19:00:00" and second["datetime_of_observation"] is None
    assert second["observation_id"] is None


def test_hl7_empty_and_nested_parts(spark):
    row = table(spark, ORU, "DG1").first()
    assert row["outlier_days"] is None and row["outlier_cost"]["price"] == "10" and row["outlier_cost"]["currency"] == "EUR"
    assert row["diagnosis_code"]["text"] == "Diabetes" and row["outlier_type"] is None
    generic = table(spark, ORU, "ZAB").first()
    assert (generic["field_1"], generic["field_2"], generic["field_3"], generic["segment_type"]) == ("one", None, "three", "ZAB")


def test_hl7_custom_table_is_numbered(spark):
    spec = "1 st control\n2 ei order\n3 eip* pair"
    text = ORU + "\rORC|NW|7^L|a&n^b\rORC|CA|8"
    rows = table(spark, text, "ORC", fields=spec, keep=("source", "message_no")).orderBy("set_id").collect()
    assert [(r["set_id"], r["control"], r["order"]["entity_identifier"]) for r in rows] == [(1, "NW", "7"), (2, "CA", "8")]
    assert rows[0]["pair"][0]["placer_assigned_identifier"]["namespace_id"] == "n" and rows[1]["pair"] is None
    with pytest.raises(ValueError):
        table(spark, text, "ORC", fields=spec)


def test_hl7_every_builtin_segment_plans(spark):
    from feedweir.domains.hl7_fields import SEGMENTS

    for name in SEGMENTS:
        table(spark, ORU + f"\r{name}|1", name, keep=("source",)).collect()


def test_hl7_batches_and_separators(spark, rows):
    text = "junk\nFHS|x\nBHS|y\n\nMSH#*~\\%#A##\nPID#1##I*J\r\nBTS|1\nmsh|^~\\&|B\nPID|2\n"
    df = spark.createDataFrame([(text,), ("nothing here",), ("",)], "text string")
    found = hl7.messages(df)
    assert rows(found.select("message_no", F.substring("message", 1, 8))) == [(0, "MSH#*~\\%"), (1, "msh|^~\\&")]
    seg = hl7.segments(found).filter("segment_type = 'PID'")
    assert rows(seg.select(hl7.field(1), hl7.component(3, 2))) == [("1", "J"), ("2", None)]


@pytest.mark.parametrize(
    "text, iso",
    [
        ("2024", "2024-01-01T00:00:00"),
        ("202402", "2024-02-01T00:00:00"),
        ("20240230", None),
        ("2024021510", "2024-02-15T10:00:00"),
        ("20240215103000+0530", "2024-02-15T05:00:00"),
        ("(20240215)", "2024-02-15T00:00:00"),
        ("202", None),
        ("20240215T10", None),
        ("", None),
    ],
)
def test_hl7_timestamps(spark, text, iso):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(hl7.timestamp_text(F.col("x"))).first()[0] == iso


def test_hl7_unescape_order(spark):
    seps = hl7.separators(F.lit("MSH|^~\\&|"))
    df = spark.createDataFrame([("a\\E\\F\\E\\b \\F\\ \\X41\\",)], "x string")
    # One kind after the other, the escape character last; unknown sequences stay.
    assert df.select(hl7.unescape(F.col("x"), seps)).first()[0] == "a\\E|E\\b | \\X41\\"


SAMPLES = {
    "Patient": ({"active": True, "name": [{"family": "F", "given": ["A"]}]}, lambda r: (r["active"], r["name"][0]["given"]), (True, ["A"])),
    "Observation": ({"valueInteger": 3, "referenceRange": [{"high": {"value": 2.5}}]}, lambda r: (r["value_integer"], r["reference_range"][0]["high_value"]), (3, 2.5)),
    "Condition": ({"onsetString": "old", "clinicalStatus": {"text": "t"}}, lambda r: (r["onset_string"], r["clinical_status"]["text"]), ("old", "t")),
    "AllergyIntolerance": ({"category": ["food"], "reaction": [{"severity": "mild"}]}, lambda r: (r["category"], r["reaction"][0]["severity"]), (["food"], "mild")),
    "Encounter": ({"class": {"code": "AMB"}, "hospitalization": {"origin": {"reference": "L/1"}}}, lambda r: (r["class_coding"]["code"], r["hospitalization"]["origin"]["reference"]), ("AMB", "L/1")),
    "Procedure": ({"performer": [{"onBehalfOf": {"display": "x"}}]}, lambda r: r["performer"][0]["on_behalf_of"]["display"], "x"),
    "DiagnosticReport": ({"conclusion": "ok", "result": [{"reference": "O/1"}]}, lambda r: (r["conclusion"], r["result"][0]["reference"]), ("ok", "O/1")),
    "MedicationRequest": (
        {"substitution": {"allowedBoolean": True}, "dispenseRequest": {"quantity": {"value": 2}}, "dosageInstruction": [{"timing": {"code": {"coding": [{"code": "BID"}]}}}]},
        lambda r: (r["substitution_allowed_boolean"], r["dispense_request"]["quantity_value"], r["dosage_instruction"][0]["timing_code"]),
        (True, 2.0, "BID"),
    ),
    "Immunization": ({"lotNumber": "L", "protocolApplied": [{"doseNumberPositiveInt": 2}]}, lambda r: (r["lot_number"], r["protocol_applied"][0]["dose_number_positive_int"]), ("L", 2)),
    "Coverage": ({"class": [{"value": "v"}], "order": 1}, lambda r: (r["class_coverage"][0]["value"], r["order"]), ("v", 1)),
    "CarePlan": ({"activity": [{"detail": {"status": "done"}}]}, lambda r: r["activity"][0]["detail_status"], "done"),
    "Goal": ({"lifecycleStatus": "active", "target": [{"dueDate": "2024"}]}, lambda r: (r["lifecycle_status"], r["target"][0]["due_date"]), ("active", "2024")),
    "Device": ({"deviceName": [{"name": "n"}], "serialNumber": "s"}, lambda r: (r["device_name"][0]["name"], r["serial_number"]), ("n", "s")),
    "DocumentReference": ({"content": [{"attachment": {"contentType": "a/b"}}], "docStatus": "final"}, lambda r: (r["content"][0]["attachment_content_type"], r["doc_status"]), ("a/b", "final")),
}


@pytest.mark.parametrize("kind", sorted(SAMPLES))
def test_fhir_resources(spark, kind):
    body, pick, want = SAMPLES[kind]
    text = json.dumps({"resourceType": kind, "id": "1", "meta": {"lastUpdated": "2024-01-01T00:00:00Z"}, **body})
    row = fhir.resource_rows(spark.createDataFrame([(text,)], "raw_json string"), kind).first()
    assert row["id"] == "1" and row["lastUpdated"].year == 2024 and row["extension"] == "null"
    assert pick(row) == want
    if "identifier" in row.asDict():
        assert row["identifier"] == []


def test_fhir_profiles(spark):
    assert fhir.profile_chain("uk_core") == ["uk_core", "base_r4"] and fhir.profile_chain("x") == ["x", "uk_core", "base_r4"]
    raw = spark.createDataFrame([('{"id": "7", "status": "s"}',)], "raw_json string")
    assert fhir.resource_rows(raw, "Unheard").columns == ["id", "resourceType", "lastUpdated", "raw_json", "extension"]

    @fhir.register("Unheard", "mine", "status str")
    def _(r):
        return [F.upper(r["status"]).alias("loud")]

    assert fhir.resource_rows(raw, "Unheard", "mine").first()["loud"] == "S"
    with pytest.raises(Exception, match="not a Bundle"):
        fhir.bundle_entries(raw.withColumnRenamed("raw_json", "bundle")).collect()


def test_dicom_values(spark):
    doc = {
        "00100010": {"vr": "PN", "Value": [{"Ideographic": "I"}]},
        "00080061": {"vr": "CS", "Value": ["CT", "MR"]},
        "00201206": {"vr": "IS", "Value": [3]},
        "00201208": {"vr": "DS", "Value": ["4.0"]},
        "00080020": {"vr": "DA", "Value": []},
    }
    row = dicom.rows(spark.createDataFrame([(json.dumps(doc),)], "document string"), "study").first()
    assert (row["patient_name"], row["modalities_in_study"], row["study_date"]) == ("I", ["CT", "MR"], None)
    assert (row["number_of_study_related_series"], row["number_of_study_related_instances"]) == (3, 4)


def test_osdu_kinds(spark):
    doc = {"id": "1", "kind": "o:w:master-data--Sample:1", "version": "12", "legal": {"legaltags": "one"}, "data": {"SampleAcquisition": {"AcquisitionStartDate": "d", "SampleAcquisitionDetail": {"RunNumber": 5, "TopDepth": "x"}}}}
    row = osdu.rows(spark.createDataFrame([(json.dumps(doc),)], "raw_json string")).first()
    assert (row["version"], row["legal_legaltags"], row["RunNumber"], row["TopDepth"], row["AcquisitionStartDate"]) == (12, ["one"], "5", None, "d")
    assert json.loads(row["SampleAcquisition_json"])["AcquisitionStartDate"] == "d" and row["FacilityID"] is None


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_resources_are_parsed_once(spark, rows):
    """A filter on a typed column does not parse the text again, and a resource of a bundle is written once."""
    made = spark.range(3).select(F.format_string('{"id": "%s", "code": {"coding": [{"code": "R%s"}]}}', "id", "id").alias("raw_json"))
    found = fhir.resource_rows(made, "Observation", columns=["code", "component"]).filter("code.coding[0].code = 'R1'").select("id")
    assert rows(found) == [("1",)] and _plan(found).count("from_json(") == 1
    texts = ['{"resourceType": "Bundle", "entry": [{"resource": {"id": "a"}}, {"fullUrl": "x"}, {"resource": {}}, {"resource": {"id": "b"}}]}']
    texts += ['{"resourceType": "Bundle"}', '{"resourceType": "Bundle", "entry": 5}']
    entries = fhir.bundle_entries(spark.createDataFrame([(t,) for t in texts], "bundle string").repartition(2))
    assert _plan(entries).count("StructsToJsonEvaluator") == 1
    assert rows(entries) == [('{"id":"a"}',), ('{"id":"b"}',)]
    for text in ("[]", "no json", '{"resourceType": 5}', '{"resourceType": "Bundle", "entry": ['):
        with pytest.raises(Exception, match="not a Bundle"):
            fhir.bundle_entries(spark.createDataFrame([(text,)], "bundle string")).collect()


def test_parts_of_batch_files_are_bounded(spark, tmp_path, monkeypatch):
    """The parts that batch files are cut into do not get more with every order, and messages are numbered in each file."""
    from feedweir.plans.registry import all_queries
    from feedweir.sources import readers

    orders = "id AS o_orderkey, id % 9 AS o_custkey, substring('OFP', CAST(id % 3 AS int) + 1, 1) AS o_orderstatus, id * 1.5D AS o_totalprice"
    orders += ", TIMESTAMP_NTZ'2024-01-02 03:04:05' AS o_orderdate, '1-URGENT' AS o_orderpriority"
    spark.range(0, 30_000, 1, 3).createOrReplaceTempView("made_ids")
    spark.sql(f"SELECT {orders} FROM made_ids").write.parquet(str(tmp_path / "orders.parquet"))
    parts, read = [], readers.read_hl7

    def noted(session, path, *args, **kw):
        parts.append(session.read.text(path).rdd.getNumPartitions())
        return read(session, path, *args, **kw)

    monkeypatch.setattr(readers, "read_hl7", noted)
    found = all_queries()["hl7_cut_files"].plan(spark, str(tmp_path))
    got = found.groupBy("many_tasks", "numbered").agg(F.count("*"), F.count_distinct("message_id"), F.sum("lines")).collect()
    assert [tuple(r) for r in got] == [(True, True, 40_000, 40_000, 300_000)]
    assert 8 <= parts[0] <= 300


def test_numbered_segments_are_sorted_as_text(spark, rows):
    """Fields survive being packed for the window: escapes, empty fields, other separators and subcomponents."""
    texts = ["MSH|^~\\&|A|||||||M1\rORC|a\\F\\b|x^y&z~w||\rORC||\rORC|\\T\\", "MSH#*~\\%#A#######M2\rORC#\\F\\#x*y%z\rORC"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    made = hl7.segments(hl7.messages(df)).filter("segment_type = 'ORC'")
    want = rows(made.select("k", "line_no", "fields", "decoded"))
    back = hl7._packed(made, ["k"])
    assert dict(back.dtypes)["fields"] == dict(back.dtypes)["decoded"] == "string"
    back = back.withColumns({c: F.expr(hl7._unpacked(c)) for c in ("decoded", "fields")})
    assert rows(back.select("k", "line_no", "fields", "decoded")) == want and len(want) == 5
    found = rows(hl7.segment_table(hl7.segments(hl7.messages(df)), "ORC", "1 st one\n2 ei two", keep=("k",)).select("k", "set_id", "one"))
    assert [r[:2] for r in found] == [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2)]


def test_only_lines_of_the_wanted_segment_are_rewritten(spark, rows):
    """Messages are cut into lines before separators are exchanged, so that a filter on the segment comes first."""
    texts = ["MSH|^~\\&|A|||||||M1\rPID|1|x^y&z~w\rZ^1|a", "MSH#*~\\%#A#######M2\rpid #1#x*y%z", "MSH", "MSH\rPID\rb"]
    made = hl7.segments(spark.createDataFrame(list(enumerate(texts)), "k int, message string"))
    assert not re.search(r"replace\(message#", _plan(made.filter("segment_type = 'PID'")))
    got = rows(made.select("k", "line_no", "segment_type", "message_id", "raw_segment", F.size("fields")))
    assert [r[:2] + r[3:] for r in got] == [
        (0, 0, "M1", "MSH|^~\\&|A|||||||M1", 11),
        (0, 1, "M1", "PID|1|x^y&z~w", 3),
        (0, 2, "M1", "Z^1|a", 2),
        (1, 0, "M2", "MSH#*~\\%#A#######M2", 11),
        (1, 1, "M2", "pid #1#x*y%z", 3),
        (2, 0, None, "MSH", 2),
        (3, 0, None, "MSH\rPID\rb", 4),
    ]
    assert [r[2] for r in got] == ["MSH", "PID", "Z\x1d1", "MSH", "PID", "MSH", "MSH"]


def test_members_are_the_texts_of_variants(spark, rows):
    """Resources of ordinary bundles are cut without variants, in the same letters; what is not sure is left to Spark."""

    def bundle(resource):
        return '{"resourceType": "Bundle", "total": 1.0, "entry": [{"fullUrl": "x"}, {"resource": ' + resource + "}]}"

    deep, names = "[" * 380 + "]" * 380, ", ".join(f'"n{i}": {i}' for i in range(30))
    sure = ['{"b": [1, 2.50, -0.0, 100.0], "a": {"Z": null, "_": true, "é": "ü \U0001f600"}}', '"text"', "7", "[]", "{ }", "null", deep]
    sure += ['{"t": "a\\"b\\\\c\\/d\\n\\t\\u00e9\\ud83d\\ude00"}', "{" + names + "}", "123456789012345678901234567890", '{"x": "' + "y" * 60_000 + '"}']
    texts = [bundle(r) for r in sure]
    texts += ['{"entry": [{"resource": {"a": 1}}, 5, null, [{"resource": 2}]], "resourceType": "Bundle"}', '{"resourceType": "Bundle", "entry": {"resource": {}}}']
    left = ['{"a": 1, "b": 2, "a": 3}', '{"\\u0061": 1, "a": 2}', '{"a": 1e-07}', '{"a": 0.1234567890123456789}', "9" * 39, '"\\ud83d"', '"\\u001b"', "NaN"]
    left += ['{"\U0001f600": 1, "￮": 2}', '{"' + "n" * 50_001 + '": 1}', "[" * 1100 + "]" * 1100, "1} x", "{", '"\t"']
    texts += [bundle(r) for r in left]
    c = F.col("bundle")
    written = F.transform(F.try_variant_get(F.try_parse_json(c), "$.entry", "array<variant>"), lambda e: F.to_json(F.try_variant_get(e, "$.resource", "variant")))
    written = F.filter(written, lambda t: t.isNotNull())
    df = spark.createDataFrame(list(enumerate(texts)), "k int, bundle string").repartition(3)
    found = rows(df.select("k", documents.members(c, "Bundle", "entry", "resource"), written))
    ordinary = len(sure) + 2
    assert [k for k, made, _ in found if made is None] == list(range(ordinary, len(texts)))
    assert [(k, made) for k, made, _ in found if made is not None] == [(k, text or []) for k, made, text in found if made is not None]
    assert found[0][1] == ['{"a":{"Z":null,"_":true,"é":"ü \U0001f600"},"b":[1,2.5,0,100]}']
    other = spark.createDataFrame([(None,), ("{}",), ('{"resourceType": "Patient", "entry": []}',), ("no",)], "bundle string")
    assert other.select(documents.members(c, "Bundle", "entry", "resource").alias("m")).filter("m IS NOT NULL").count() == 0
    broken = spark.sql("""SELECT CAST(concat(encode('{"resourceType":"Bundle","entry":[{"resource":"', 'UTF-8'), X'ff', encode('"}]}', 'UTF-8')) AS STRING) AS bundle""")
    assert rows(broken.select(documents.members(c, "Bundle", "entry", "resource"))) == [(None,)]


def test_bundle_entries_of_all_texts(spark, rows):
    """Bundles cut in Python and bundles cut as variants come out of one table; a repeated name is no bundle to read."""
    texts = ['{"resourceType": "Bundle", "entry": [{"resource": {"b": 1.0, "a": "x"}}]}', '{"resourceType": "Bundle", "entry": [{"resource": {"b": 1e-07, "a": "x"}}]}']
    texts += ['{"resourceType": "Bundle", "entry": [{"resource": {"a": 1, "a": 2}}]}', '{"resourceType": "Bundle", "entry": []} rest', '{"entry": [{}]', None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts[:4])], "k int, bundle string")
    entries = fhir.bundle_entries(df.repartition(2), keep={"k": F.col("k")})
    assert rows(entries) == [(0, '{"a":"x","b":1}'), (1, '{"a":"x","b":1.0E-7}')] and "ArrowEvalPython" in _plan(entries)
    for text in texts[4:]:
        with pytest.raises(Exception, match="not a Bundle: null"):
            fhir.bundle_entries(spark.createDataFrame([(text,)], "bundle string")).collect()


def test_parsed_structs_stay(spark, rows):
    """Structs in which nothing is renamed or converted are not built again; others, and those parsed otherwise, are."""
    raw = spark.createDataFrame([('{"value": 1.5, "unit": "u", "more": 1}',)], "raw_json string").repartition(2)
    made = raw.select(fhir.datatype(F.col("raw_json"), "quantity").alias("q"))
    assert rows(made.select("q.*")) == [(1.5, "u", None, None)] and "CASE WHEN" not in _plan(made)
    wider = raw.select(F.from_json("raw_json", "value double, unit string, system string, code string, more long").alias("q"))
    assert wider.select(fhir.typed(F.col("q"), "quantity").alias("t")).select("t.*").columns == ["value", "unit", "system", "code"]
    text = '{"component": [{"code": {"coding": [{"code": "a"}]}, "valueQuantity": {"value": 2}}, null], "subject": {"reference": "r"}}'
    found = fhir.resource_rows(spark.createDataFrame([(text,)], "raw_json string").repartition(2), "Observation", columns=["component", "subject", "has_member"])
    assert _plan(found).count("transform(") == 1
    row = found.first()
    assert (row["component"][0]["code"]["coding"], row["component"][0]["value_quantity"][0], row["component"][1]) == ([(None, "a", None)], 2.0, None)
    assert row["subject"] == ("r", None) and row["component"][0]["value_codeable_concept"] is None
