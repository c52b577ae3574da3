"""Queries on clinical and subsurface formats, over documents written row by row from the benchmark tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweir.domains import dicom, fhir, hl7, osdu
from feedweir.plans.registry import query, table
from feedweir.session import checkpoint_dir, settle
from feedweir.sources import readers


def _text(*parts: str | Column) -> Column:
    """Texts and columns put together; plain strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# ---------------------------------------------------------------- HL7


def hl7_texts(spark: SparkSession, d: str) -> DataFrame:
    """One batch text per order: a result message, and for finished orders a second one with its own separators.

    Line ends differ by order status; the first message's name needs unescaping.
    """
    key, cust, at = F.col("o_orderkey"), F.col("o_custkey"), F.date_format("o_orderdate", "yyyyMMddHHmmss")
    end = F.when(F.col("o_orderstatus") == "O", "\r").when(F.col("o_orderstatus") == "F", "\n").otherwise("\r\n")
    flag = F.when(F.col("o_totalprice") > 250_000, "H~A").otherwise("N")
    result = [
        _text("MSH|^~\\&|LAB^1.2^ISO|HOSP|HIS|HIS|", at, "||ORU^R01^ORU_R01|M", key, "|P|2.5.1"),
        _text("PID|1||C", cust, "^^^HOSP&9.9&ISO^MR~X", cust, "^^^ALT^PI||Doe\\T\\Co ", cust, "^John^M~Roe^Jane||19700315|M||2028-9^Asian~", key, "^Other"),
        _text("PV1|1|I|MED^101^A^HOSP||||D", cust, "^Smith^Robert~E", key, "^Jones"),
        _text("OBX|1|NM|TOT^Total^L||", F.col("o_totalprice").cast("decimal(12,2)"), "|USD|0-1|", flag, "|||F|||", at, "+0200"),
        _text("OBX||ST|PRI^Priority^L||", F.col("o_orderpriority"), "||||||F"),
        _text("AL1|1|DA|", cust, "^Pollen||rash~itch^Itching"),
        _text("ORC|NW|", key, "^LAB"),
        _text("ORC|CA|", key, "^LAB"),
        _text("ZXX|a|", key, "||d"),
    ]
    admit = [
        _text("MSH#*~\\%#ADT#HOSP###", at, "##ADT*A01#N", key, "#P#2.3"),
        _text("EVN#A01#", at),
        _text("PID#1##C", cust, "***HOSP%9.9%ISO*MR##Poe*Edgar"),
    ]
    first = F.array_join(F.array(*result), "\r")
    both = F.when(F.col("o_orderstatus") == "F", F.concat(first, F.lit("\r\r"), F.array_join(F.array(*admit), "\r"))).otherwise(first)
    batch = F.concat(F.lit("FHS|^~\\&|X\rBHS|^~\\&|X\r"), both, F.lit("\rBTS|1\rFTS|1\r"))
    return table(spark, d, "orders").select("o_orderkey", F.replace(batch, F.lit("\r"), end).alias("text"))


def hl7_segments(spark: SparkSession, d: str) -> DataFrame:
    return hl7.segments(hl7.messages(hl7_texts(spark, d)))


KEEP = ("o_orderkey",)


@query(
    "hl7_messages",
    "O-30", "O-100",
    sql="""
SELECT o_orderkey, 0 AS message_no, 9::BIGINT AS lines FROM orders
UNION ALL SELECT o_orderkey, 1, 3 FROM orders WHERE o_orderstatus = 'F'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = hl7.messages(hl7_texts(spark, d))
    return rows.select("o_orderkey", "message_no", F.size(F.split("message", "\r")).cast("bigint").alias("lines"))


@query(
    "hl7_cut_files",
    "O-30", "O-100",
    sql="""
SELECT 'M' || o_orderkey AS message_id, 9::BIGINT AS lines, true AS many_tasks, true AS numbered FROM orders
UNION ALL SELECT 'N' || o_orderkey, 3, true, true FROM orders WHERE o_orderstatus = 'F'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    """All orders' messages in batch files, which are cut anywhere and read by many tasks."""
    folder, size = f"{checkpoint_dir(spark)}/hl7-{uuid.uuid4().hex}", spark.conf.get("spark.sql.files.maxPartitionBytes")
    hl7_texts(spark, d).select("text").write.option("lineSep", "\n").text(folder)
    # some 256 parts, so that small tables are cut as well; parts of large ones are not made larger than usual
    written = readers.list_files(spark, folder, "*.txt").agg(F.sum("length").alias("n")).first()["n"] or 0
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(128 << 20, max(32 << 10, written // 256))))
    try:
        rows = readers.read_hl7(spark, folder, "*.txt")
        parts = spark.read.text(folder).rdd.getNumPartitions()
        rows = settle(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    # messages are numbered within their file
    files = rows.groupBy("source_file").agg((F.count_distinct("message_no") == F.max("message_no") + 1).alias("ok"))
    numbers = files.agg(F.every("ok").alias("ok")).scalar()
    mark = F.split(F.substring("message", 4, 1), "")[0]
    head = F.split_part(F.split("message", "\r")[0], mark, F.lit(10))
    return rows.select(
        head.alias("message_id"),
        F.size(F.split("message", "\r")).cast("bigint").alias("lines"),
        F.lit(parts >= 8).alias("many_tasks"),
        numbers.alias("numbered"),
    )


@query(
    "hl7_segments",
    "O-101",
    sql="""
SELECT o_orderkey, 'M' || o_orderkey AS message_id, unnest(['MSH', 'PID', 'PV1', 'OBX', 'OBX', 'AL1', 'ORC', 'ORC', 'ZXX']) AS segment_type,
       unnest([12, 10, 7, 14, 11, 5, 2, 2, 4]) AS field_count, '|' AS separator FROM orders
UNION ALL
SELECT o_orderkey, 'N' || o_orderkey, unnest(['MSH', 'EVN', 'PID']), unnest([12, 2, 5]), '#' FROM orders WHERE o_orderstatus = 'F'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = hl7_segments(spark, d)
    return rows.select("o_orderkey", "message_id", "segment_type", (F.size("fields") - 1).alias("field_count"), F.col("seps.field").alias("separator"))


@query(
    "hl7_field_access",
    "O-102", "O-103",
    sql="""
SELECT o_orderkey, 'M' || o_orderkey AS message_id, 'C' || o_custkey AS id, '9.9' AS universal_id, 'X' || o_custkey AS second_id,
       'Doe&Co ' || o_custkey AS family, NULL::VARCHAR AS beyond FROM orders
UNION ALL SELECT o_orderkey, 'N' || o_orderkey, 'C' || o_custkey, '9.9', NULL, 'Poe', NULL FROM orders WHERE o_orderstatus = 'F'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return hl7_segments(spark, d).filter("segment_type = 'PID'").select(
        "o_orderkey",
        "message_id",
        hl7.component(3, 1, 1).alias("id"),
        hl7.subcomponent(3, 4, 2, 1).alias("universal_id"),
        hl7.component(3, 1, 2).alias("second_id"),
        hl7.component(5, 1, 1).alias("family"),
        hl7.field(40).alias("beyond"),
    )


@query(
    "hl7_unescape",
    "O-103",
    sql="""SELECT o_orderkey, '|' || o_orderkey || '^&~\\E' AS text FROM orders""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    seps = hl7.separators(F.lit("MSH|^~\\&|x"))
    raw = _text("\\F\\\\H\\", F.col("o_orderkey"), "\\N\\\\S\\\\T\\\\R\\\\E\\E")
    return table(spark, d, "orders").select("o_orderkey", hl7.unescape(raw, seps).alias("text"))


@query(
    "hl7_observations",
    "O-104", "O-107", "O-108",
    sql="""
SELECT o_orderkey, 'M' || o_orderkey AS message_id, '2.5.1' AS hl7_version, 1::BIGINT AS set_id, 'NM' AS value_type, 'TOT' AS code,
       round(o_totalprice, 2) AS amount, 'USD' AS units, CASE WHEN o_totalprice > 250000 THEN 'A' END AS second_flag,
       strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') AS observed FROM orders
UNION ALL
SELECT o_orderkey, 'M' || o_orderkey, '2.5.1', 1, 'ST', 'PRI', NULL, NULL, NULL, NULL FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = hl7.segment_table(hl7_segments(spark, d), "obx", keep=KEEP)
    return rows.select(
        "o_orderkey",
        "message_id",
        "hl7_version",
        "set_id",
        "value_type",
        F.col("observation_id.code").alias("code"),
        F.round(F.get("observation_value", F.lit(0)).try_cast("double"), 2).alias("amount"),
        F.col("units.code").alias("units"),
        F.get("interpretation_codes", F.lit(1))["code"].alias("second_flag"),
        F.col("datetime_of_observation").alias("observed"),
    )


@query(
    "hl7_message_headers",
    "O-104",
    sql="""
SELECT o_orderkey, 'LAB' AS sending_application, '1.2' AS application_id, 'ORU' AS message_code, 'R01' AS trigger_event, 'M' || o_orderkey AS control_id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS sent, 'P' AS processing, '2.5.1' AS version, '^~\\&' AS encoding FROM orders
UNION ALL
SELECT o_orderkey, 'ADT', NULL, 'ADT', 'A01', 'N' || o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), 'P', '2.3', '*~\\%'
FROM orders WHERE o_orderstatus = 'F'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = hl7.segment_table(hl7_segments(spark, d), "MSH", keep=KEEP)
    return rows.select(
        "o_orderkey",
        "sending_application",
        F.col("sending_application_universal_id").alias("application_id"),
        "message_code",
        "trigger_event",
        F.col("message_control_id").alias("control_id"),
        F.col("message_datetime").alias("sent"),
        F.col("processing_id.id").alias("processing"),
        F.col("version_id.id").alias("version"),
        F.col("encoding_characters").alias("encoding"),
    )


@query(
    "hl7_composites",
    "O-105",
    sql="""
SELECT o_orderkey, 'M' || o_orderkey AS message_id, 2::BIGINT AS ids, 'HOSP' AS authority, 'ISO' AS authority_type, 'Jane' AS second_given,
       'M' AS sex, '1970-03-15T00:00:00' AS born, o_orderkey::VARCHAR AS second_race, NULL::VARCHAR AS license FROM orders
UNION ALL
SELECT o_orderkey, 'N' || o_orderkey, 1, 'HOSP', 'ISO', NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderstatus = 'F'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = hl7.segment_table(hl7_segments(spark, d), "PID", keep=KEEP)
    first = F.get("patient_id", F.lit(0))
    return rows.select(
        "o_orderkey",
        "message_id",
        F.size("patient_id").cast("bigint").alias("ids"),
        first["assigning_authority"].alias("authority"),
        first["assigning_authority_universal_id_type"].alias("authority_type"),
        F.get("patient_names", F.lit(1))["given_name"].alias("second_given"),
        F.col("administrative_sex.code").alias("sex"),
        F.col("date_of_birth").alias("born"),
        F.get("race", F.lit(1))["code"].alias("second_race"),
        F.col("drivers_license.number").alias("license"),
    )


@query(
    "hl7_generic_segment",
    "O-106",
    sql="SELECT o_orderkey, 'ZXX' AS segment_type, 'a' AS field_1, o_orderkey::VARCHAR AS field_2, NULL::VARCHAR AS field_3, 'd' AS field_4, NULL::VARCHAR AS field_25, 4::BIGINT AS places FROM orders",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = hl7.segment_table(hl7_segments(spark, d), "ZXX", keep=KEEP)
    places = F.size("all_fields").cast("bigint").alias("places")
    return rows.select("o_orderkey", "segment_type", "field_1", "field_2", "field_3", "field_4", "field_25", places)


@query(
    "hl7_numbered_segments",
    "O-104", "O-107",
    sql="SELECT o_orderkey, unnest(['NW', 'CA']) AS order_control, o_orderkey::VARCHAR AS placer, 'LAB' AS namespace, unnest([1, 2])::BIGINT AS set_id FROM orders",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    fields = "1 st order_control\n2 ei placer_order_number"
    rows = hl7.segment_table(hl7_segments(spark, d), "ORC", fields, keep=("o_orderkey", "message_no"))
    placer = F.col("placer_order_number")
    return rows.select("o_orderkey", "order_control", placer["entity_identifier"].alias("placer"), placer["namespace_id"].alias("namespace"), "set_id")


def _hl7_orders(spark: SparkSession, d: str) -> DataFrame:
    """One message per order with the segments of orders, specimens, relatives, visits and billing."""
    key, cust, at = F.col("o_orderkey"), F.col("o_custkey"), F.date_format("o_orderdate", "yyyyMMdd")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    lines = [
        _text("MSH|^~\\&|LAB|HOSP|HIS|HIS|", at, "||ORM^O01|M", key, "|P|2.5.1"),
        _text("PD1|A~B|||P", cust, "^Gray^Ann~Q"),
        _text("PV2|W1^", cust, "^2||R", key, "^Reason||ring~watch|safe|||||", key),
        _text("MRG|O", cust, "^^^HOSP~P", cust),
        _text("NK1|1|Doe^Jane~Roe^Jim|SPO^Spouse|||||", "|", at, "||||E", cust, "^^^ACME"),
        _text("IAM|3|DA|", cust, "^Pollen||rash~itch|||", "why"),
        _text("PR1||C4|", key, "^Graft||", at, "||", cust, "|S1^One~S2^Two"),
        _text("ORC|NW|", key, "^LAB|F", key, "|||||a&n^b&m"),
        _text("ORC|CA|", key, "^LAB", "|" * 34, at, "^", at),
        _text("OBR|2|", key, "^LAB|F", key, "|GLU^Glucose^LN||", "|", at, "||9^ml|", "|" * 15, "F"),
        _text("SPM|1|a&n^b&m||BLD^Blood|||||||||4|note~more|||", at, "^", at),
        _text("IN1|1|PLAN^Gold|C1~C2|||||G", cust, "||||", at, "||A", key, "^", at, "|", "|" * 22, price, "&USD^UP"),
        _text("GT1|1|G", cust, "|Doe^Jane||||", "|", at, "|||||||", cust),
        _text("FT1|1|T", key, "||", at, "^", at, "||CG|X1|||", cust, "|", price, "&USD"),
        _text("RXA|0|1|", at, "||", "CVX^Shot||||||||||L1~L2|", at, "~", at),
        _text("SCH|", key, "^S||", cust),
        _text("TXA||DS^Summary|AP|", at, "||||", at, "~", at, "||||D", key),
    ]
    text = F.array_join(F.array(*lines), "\r").alias("text")
    return hl7.segments(hl7.messages(table(spark, d, "orders").select("o_orderkey", text)))


DAY = "strftime(o_orderdate, '%Y-%m-%dT00:00:00')"


def _segment_query(segment: str, columns: dict[str, str], sql: str) -> None:
    """A query on one segment of the order messages: names with the expression over the segment's table."""

    @query(f"hl7_segment_{segment.lower()}", "O-104", "O-105", "O-107", sql=f"SELECT o_orderkey, {sql} FROM orders")
    def _(spark: SparkSession, d: str) -> DataFrame:
        rows = hl7.segment_table(_hl7_orders(spark, d), segment, keep=KEEP)
        return rows.selectExpr("o_orderkey", *[f"{value} AS {name}" for name, value in columns.items()])


_segment_query(
    "PD1",
    {"dependencies": "size(living_dependency)", "doctor": "patient_primary_care_provider.id", "bill": "separate_bill"},
    "2 AS dependencies, 'P' || o_custkey AS doctor, NULL::VARCHAR AS bill",
)
_segment_query(
    "PV2",
    {"place": "prior_pending_location.point_of_care", "reason": "admit_reason.code", "valuables": "array_join(patient_valuables, ',')",
     "kept": "patient_valuables_location", "stay": "actual_length_of_inpatient_stay"},
    "'W1' AS place, 'R' || o_orderkey AS reason, 'ring,watch' AS valuables, 'safe' AS kept, o_orderkey::BIGINT AS stay",
)
_segment_query(
    "MRG",
    {"old_id": "prior_patient_id[0].id", "second_id": "prior_patient_id[1].id", "names": "prior_patient_names"},
    "'O' || o_custkey AS old_id, 'P' || o_custkey AS second_id, NULL::VARCHAR AS names",
)
_segment_query(
    "NK1",
    {"set_id": "set_id", "family": "names[1].family_name", "relation": "relationship.text", "ends": "end_date", "employee": "employee_number.id"},
    f"1::BIGINT AS set_id, 'Roe' AS family, 'Spouse' AS relation, {DAY} AS ends, NULL::VARCHAR AS employee",
)
_segment_query(
    "IAM",
    {"set_id": "set_id", "allergen": "allergen_code.code", "reactions": "size(allergy_reaction)", "reason": "action_reason"},
    "3::BIGINT AS set_id, o_custkey::VARCHAR AS allergen, 2 AS reactions, 'why' AS reason",
)
_segment_query(
    "PR1",
    {"set_id": "set_id", "code": "procedure_code.code", "done": "procedure_datetime", "minutes": "procedure_minutes", "second": "anesthesiologist[1].family_name"},
    f"1::BIGINT AS set_id, o_orderkey::VARCHAR AS code, {DAY} AS done, o_custkey::BIGINT AS minutes, 'Two' AS second",
)
_segment_query(
    "ORC",
    {"set_id": "set_id", "control": "order_control", "placer": "placer_order_number.entity_identifier",
     "filler_parent": "parent_order[0].filler_assigned_identifier.namespace_id", "starts": "order_status_date_range_start", "ends": "order_status_date_range_end"},
    f"""unnest([1, 2])::BIGINT AS set_id, unnest(['NW', 'CA']) AS control, o_orderkey::VARCHAR AS placer, unnest(['m', NULL]) AS filler_parent,
    unnest([NULL, {DAY}]) AS starts, unnest([NULL, {DAY}]) AS ends""",
)
_segment_query(
    "OBR",
    {"set_id": "set_id", "filler": "filler_order_number.entity_identifier", "service": "service.text", "seen": "observation_datetime", "status": "result_status"},
    f"2::BIGINT AS set_id, 'F' || o_orderkey AS filler, 'Glucose' AS service, {DAY} AS seen, 'F' AS status",
)
_segment_query(
    "SPM",
    {"placer": "specimen_id.placer_assigned_identifier.entity_identifier", "kind": "specimen_type.text", "n": "grouped_specimen_count",
     "notes": "array_join(specimen_description, ',')", "starts": "specimen_collection_datetime_start", "ends": "specimen_collection_datetime_end"},
    f"'a' AS placer, 'Blood' AS kind, 4::BIGINT AS n, 'note,more' AS notes, {DAY} AS starts, {DAY} AS ends",
)
_segment_query(
    "IN1",
    {"plan": "insurance_plan.text", "companies": "size(insurance_company)", "grp": "group_number", "since": "plan_effective_date",
     "permit": "authorization_information.number", "deductible": "policy_deductible.price", "currency": "policy_deductible.currency"},
    f"""'Gold' AS plan, 2 AS companies, 'G' || o_custkey AS grp, {DAY} AS since, 'A' || o_orderkey AS permit,
    o_totalprice::DECIMAL(12,2)::VARCHAR AS deductible, 'USD' AS currency""",
)
_segment_query(
    "GT1",
    {"number": "guarantor_number[0].id", "family": "guarantor_names[0].family_name", "born": "guarantor_date_of_birth", "priority": "guarantor_priority"},
    f"'G' || o_custkey AS number, 'Doe' AS family, {DAY} AS born, o_custkey::BIGINT AS priority",
)
_segment_query(
    "FT1",
    {"id": "transaction_id.id", "starts": "transaction_date_start", "kind": "transaction_type.code", "code": "transaction_code.code",
     "quantity": "transaction_quantity", "price": "transaction_amount_extended.price"},
    f"'T' || o_orderkey AS id, {DAY} AS starts, 'CG' AS kind, 'X1' AS code, o_custkey::BIGINT AS quantity, o_totalprice::DECIMAL(12,2)::VARCHAR AS price",
)
_segment_query(
    "RXA",
    {"set_id": "set_id", "starts": "datetime_start_of_administration", "code": "administered_code.code",
     "lots": "array_join(substance_lot_number, ',')", "expiries": "size(substance_expiration_date)"},
    f"0::BIGINT AS set_id, {DAY} AS starts, 'CVX' AS code, 'L1,L2' AS lots, 2 AS expiries",
)
_segment_query(
    "SCH",
    {"id": "placer_appointment_id.entity_identifier", "filler": "filler_appointment_id", "n": "occurrence_number"},
    "o_orderkey::VARCHAR AS id, NULL::VARCHAR AS filler, o_custkey::BIGINT AS n",
)
_segment_query(
    "TXA",
    {"set_id": "set_id", "kind": "document_type.text", "shown": "document_content_presentation", "edits": "size(edit_datetime)",
     "document": "unique_document_number.entity_identifier"},
    "1::BIGINT AS set_id, 'Summary' AS kind, 'AP' AS shown, 2 AS edits, 'D' || o_orderkey AS document",
)


@query(
    "hl7_timestamps",
    "O-108",
    sql="""
SELECT event_id, CASE event_type WHEN 'click' THEN strftime(date_trunc('year', ts), '%Y-%m-%dT%H:%M:%S')
  WHEN 'view' THEN strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S') WHEN 'error' THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S')
  WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS at FROM events
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts")
    text = (
        F.when(kind == "click", F.date_format(ts, "yyyy"))
        .when(kind == "view", F.date_format(ts, "yyyyMMdd"))
        .when(kind == "error", F.concat(F.date_format(ts, "yyyyMMddHHmmss"), F.lit("-0530")))
        .when(kind == "signup", F.concat(F.lit("("), F.date_format(ts, "yyyyMMddHHmmss.SSS"), F.lit(")")))
        .otherwise("20241399")
    )
    return table(spark, d, "events").select("event_id", hl7.timestamp_text(text).alias("at"))


@query(
    "hl7_consumer_patients",
    "O-112",
    sql="""
SELECT 'M' || o_orderkey AS message_id, '2028-9' AS race_code, 'Asian' AS race_text, 'C' || o_custkey AS mrn, 'MR' AS id_type, true AS is_asian FROM orders
UNION ALL SELECT 'N' || o_orderkey, NULL, NULL, 'C' || o_custkey, 'MR', false FROM orders WHERE o_orderstatus = 'F'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    return hl7.segment_table(hl7_segments(spark, d), "PID").selectExpr(
        "message_id",
        "race[0].code AS race_code",
        "race[0].text AS race_text",
        "patient_id[0].id AS mrn",
        "patient_id[0].type_code AS id_type",
        "coalesce(exists(race, r -> r.code = '2028-9'), false) AS is_asian",
    )


@query(
    "hl7_consumer_reactions",
    "O-112",
    sql="SELECT 'M' || o_orderkey AS message_id, unnest(['rash', 'itch']) AS code, unnest([NULL, 'Itching']) AS text FROM orders",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = hl7.segment_table(hl7_segments(spark, d), "AL1")
    return rows.select("message_id", F.explode("allergy_reaction").alias("reaction")).select("message_id", "reaction.code", "reaction.text")


@query(
    "hl7_consumer_doctors",
    "O-112",
    sql="SELECT 'M' || o_orderkey AS message_id, unnest(['D' || o_custkey, 'E' || o_orderkey]) AS id, unnest(['Smith', 'Jones']) AS family_name, 'MED' AS ward FROM orders",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = hl7.segment_table(hl7_segments(spark, d), "PV1")
    each = rows.select("message_id", F.explode("attending_doctor").alias("doctor"), F.col("assigned_patient_location.point_of_care").alias("ward"))
    return each.select("message_id", "doctor.id", "doctor.family_name", "ward")


# ---------------------------------------------------------------- FHIR


def _coded(code: Column, display: str) -> Column:
    coding = F.struct(F.lit("urn:codes").alias("system"), code.alias("code"), F.lit(display).alias("display"))
    return F.struct(F.array(coding).alias("coding"), F.lit(display).alias("text"))


def patients(spark: SparkSession, d: str) -> DataFrame:
    """Customers as FHIR patients with identifiers and national extensions."""
    key = F.col("c_custkey").cast("string")

    def identifier(system: str, prefix: str) -> Column:
        return F.struct(F.lit(system).alias("system"), F.concat(F.lit(prefix), key).alias("value"))

    coded = _coded(F.col("c_mktsegment"), "Segment")
    death = F.array(F.struct(F.lit("deathNotificationStatus").alias("url"), _coded(F.lit("2"), "Formal").alias("valueCodeableConcept")))
    none = F.lit(None)

    def ext(url: str, concept: Column | None = None, flag: Column | None = None, inner: Column | None = None) -> Column:
        return F.struct(
            F.lit(url).alias("url"),
            (none.cast(_type(coded, spark, d)) if concept is None else concept).alias("valueCodeableConcept"),
            (none.cast("boolean") if flag is None else flag).alias("valueBoolean"),
            (none.cast(_type(death, spark, d)) if inner is None else inner).alias("extension"),
        )

    extensions = F.array(
        ext(fhir.UK_EXTENSION + "EthnicCategory", coded),
        ext(fhir.INTERPRETER, flag=F.col("c_acctbal") < 0),
        ext(fhir.UK_EXTENSION + "DeathNotificationStatus", inner=death),
    )
    body = F.struct(
        F.lit("Patient").alias("resourceType"),
        key.alias("id"),
        F.struct(F.lit("2024-02-03T04:05:06Z").alias("lastUpdated")).alias("meta"),
        F.array(identifier("urn:mrn", "M"), identifier(fhir.NHS_NUMBER, "9")).alias("identifier"),
        (F.col("c_acctbal") >= 0).alias("active"),
        F.array(F.struct(F.col("c_name").alias("family"), F.array(F.lit("Ann"), F.lit("Bea")).alias("given"))).alias("name"),
        F.lit("1980-01-02").alias("birthDate"),
        coded.alias("maritalStatus"),
        F.struct(F.concat(F.lit("Organization/"), F.col("c_nationkey")).alias("reference")).alias("managingOrganization"),
        F.lit("2020-05-06T07:08:09+02:00").alias("deceasedDateTime"),
        extensions.alias("extension"),
    )
    return table(spark, d, "customer").select(F.to_json(body).alias("raw_json"))


def _type(c: Column, spark: SparkSession, d: str):
    return table(spark, d, "customer").select(c.alias("x")).schema["x"].dataType


@query(
    "fhir_patients",
    "O-109", "O-110a", "O-110b",
    sql="""
SELECT c_custkey::VARCHAR AS id, 'Patient' AS "resourceType", TIMESTAMP '2024-02-03 04:05:06' AS updated, c_acctbal >= 0 AS active, c_name AS family,
       'Bea' AS second_given, '1980-01-02' AS "birthDate", TIMESTAMP '2020-05-06 05:08:09' AS died, c_mktsegment AS marital,
       'Organization/' || c_nationkey AS organization, 0::BIGINT AS addresses FROM customer
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = fhir.resource_rows(patients(spark, d), "Patient", "base_r4")
    return rows.select(
        "id",
        "resourceType",
        F.col("lastUpdated").cast("timestamp_ntz").alias("updated"),
        "active",
        F.get("name", F.lit(0))["family"].alias("family"),
        F.get(F.get("name", F.lit(0))["given"], F.lit(1)).alias("second_given"),
        "birthDate",
        F.col("deceased_datetime").cast("timestamp_ntz").alias("died"),
        F.get(F.col("maritalStatus")["coding"], F.lit(0))["code"].alias("marital"),
        F.col("managingOrganization.reference").alias("organization"),
        F.size("address").cast("bigint").alias("addresses"),
    )


@query(
    "fhir_national_patients",
    "O-110c", "O-110d", "O-176",
    sql="""
SELECT c_custkey::VARCHAR AS id, '9' || c_custkey AS nhs_number, c_mktsegment AS ethnic, NULL::VARCHAR AS birth_sex, c_acctbal < 0 AS interpreter,
       '2' AS death FROM customer
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = fhir.resource_rows(patients(spark, d), "Patient", "uk_core")

    def code(column: str) -> Column:
        return F.get(F.col(column)["coding"], F.lit(0))["code"]

    return rows.select(
        "id",
        "nhs_number",
        code("ethnic_category").alias("ethnic"),
        code("birth_sex").alias("birth_sex"),
        F.col("interpreter_required").alias("interpreter"),
        code("death_notification_status").alias("death"),
    )


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Lineitems as FHIR observations with two components."""

    def part(code: str, column: str) -> Column:
        quantity = F.struct(F.col(column).alias("value"), F.lit("u").alias("unit"))
        return F.struct(_coded(F.lit(code), code).alias("code"), quantity.alias("valueQuantity"))

    body = F.struct(
        F.lit("Observation").alias("resourceType"),
        _text(F.col("l_orderkey"), "-", F.col("l_linenumber"), "-", F.col("l_partkey")).alias("id"),
        F.when(F.col("l_linestatus") == "F", "final").otherwise("preliminary").alias("status"),
        _coded(F.col("l_returnflag"), "Flag").alias("code"),
        F.struct(_text("Patient/", F.col("l_suppkey")).alias("reference")).alias("subject"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effectiveDateTime"),
        F.struct(F.col("l_quantity").alias("value"), F.lit("kg").alias("unit")).alias("valueQuantity"),
        F.array(part("price", "l_extendedprice"), part("tax", "l_tax")).alias("component"),
        F.array(F.struct(F.struct(F.col("l_discount").alias("value")).alias("low"), F.lit("usual").alias("text"))).alias("referenceRange"),
    )
    return table(spark, d, "lineitem").select(F.to_json(body).alias("raw_json"))


_OBSERVED = """
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, CASE WHEN l_linestatus = 'F' THEN 'final' ELSE 'preliminary' END AS status,
       l_returnflag AS code, 'Patient/' || l_suppkey AS subject, l_shipdate AS effective, l_quantity AS quantity, l_extendedprice AS price,
       l_tax AS tax, l_discount AS low FROM lineitem
"""


OBSERVED = ["status", "code", "subject", "effective_datetime", "value_quantity", "component", "reference_range"]


def _observed(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id",
        "status",
        F.get(F.col("code")["coding"], F.lit(0))["code"].alias("code"),
        F.col("subject.reference").alias("subject"),
        F.col("effective_datetime").cast("timestamp_ntz").alias("effective"),
        F.col("value_quantity.value").alias("quantity"),
        F.get("component", F.lit(0))["value_quantity"]["value"].alias("price"),
        F.get("component", F.lit(1))["value_quantity"]["value"].alias("tax"),
        F.get("reference_range", F.lit(0))["low_value"].alias("low"),
    )


@query("fhir_observations", "O-110b", sql=_OBSERVED)
def _(spark: SparkSession, d: str) -> DataFrame:
    return _observed(fhir.resource_rows(observations(spark, d), "Observation", columns=OBSERVED))


@query("fhir_bundles", "O-110e", sql=_OBSERVED)
def _(spark: SparkSession, d: str) -> DataFrame:
    bundle = _text('{"resourceType": "Bundle", "entry": [{"fullUrl": "x"}, {"resource": ', F.col("raw_json"), "}]}")
    entries = fhir.bundle_entries(observations(spark, d).select(bundle.alias("bundle")))
    return _observed(fhir.resource_rows(entries, "Observation", columns=OBSERVED))


@query(
    "fhir_datatypes",
    "O-110a",
    sql="""
SELECT o_orderkey, o_orderstatus AS code, 'Order/' || o_custkey AS reference, o_totalprice AS amount, o_orderdate AS start, o_orderpriority AS city,
       2::BIGINT AS lines, o_totalprice AS dose, o_orderpriority AS note FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    total, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    concept = F.to_json(_coded(F.col("o_orderstatus"), "Status"))
    reference = F.to_json(F.struct(_text("Order/", F.col("o_custkey")).alias("reference")))
    quantity = F.to_json(F.struct(total.alias("value"), F.lit("EUR").alias("unit")))
    period = F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("start")))
    address = F.to_json(F.struct(priority.alias("city"), F.array(F.lit("a"), F.lit("b")).alias("line")))
    dosage = F.to_json(F.struct(F.array(F.struct(F.struct(total.alias("value")).alias("doseQuantity"))).alias("doseAndRate")))
    note = F.to_json(F.struct(priority.alias("text")))
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.get(fhir.datatype(concept, "cc")["coding"], F.lit(0))["code"].alias("code"),
        fhir.datatype(reference, "ref")["reference"].alias("reference"),
        fhir.datatype(quantity, "quantity")["value"].alias("amount"),
        fhir.datatype(period, "period")["start"].cast("timestamp_ntz").alias("start"),
        fhir.datatype(address, "address")["city"].alias("city"),
        F.size(fhir.datatype(address, "address")["line"]).cast("bigint").alias("lines"),
        fhir.datatype(dosage, "dosage")["dose_value"].alias("dose"),
        fhir.datatype(note, "note")["text"].alias("note"),
    )


@query(
    "fhir_consumer",
    "O-112",
    sql="""
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS id, l_extendedprice AS systolic, l_tax AS diastolic FROM lineitem WHERE l_returnflag = 'R'
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = fhir.resource_rows(observations(spark, d), "Observation", columns=["code", "component"])
    return rows.filter("code.coding[0].code = 'R'").selectExpr(
        "id", "component[0].value_quantity.value AS systolic", "component[1].value_quantity.value AS diastolic"
    )


@query(
    "fhir_encounters",
    "O-110b",
    sql="""
SELECT o_orderkey::VARCHAR AS id, o_orderstatus AS status, o_orderpriority AS class, o_orderdate AS start, 'Patient/' || o_custkey AS subject,
       o_custkey AS rank FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    body = F.struct(
        F.lit("Encounter").alias("resourceType"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.struct(F.col("o_orderpriority").alias("code")).alias("class"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start")).alias("period"),
        F.struct(_text("Patient/", F.col("o_custkey")).alias("reference")).alias("subject"),
        F.array(F.struct(F.col("o_custkey").alias("rank"))).alias("diagnosis"),
    )
    rows = fhir.resource_rows(table(spark, d, "orders").select(F.to_json(body).alias("raw_json")), "Encounter")
    return rows.select(
        "id",
        "status",
        F.col("class_coding.code").alias("class"),
        F.col("period.start").cast("timestamp_ntz").alias("start"),
        F.col("subject.reference").alias("subject"),
        F.get("diagnosis", F.lit(0))["rank"].alias("rank"),
    )

# What the elements of the resources below hold, out of an order, and the same read back: (element, column, SQL).
_AT = "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
_ELEMENTS = {
    "text": ("o_orderstatus", "{}", "o_orderstatus"),
    "texts": ("array(o_orderstatus, 'x')", "{}[0]", "o_orderstatus"),
    "flag": ("o_orderkey % 2 = 0", "{}", "o_orderkey % 2 = 0"),
    "count": ("o_custkey", "{}", "o_custkey"),
    "at": (_AT, "CAST({} AS timestamp_ntz)", "o_orderdate"),
    "ref": ("named_struct('reference', concat('Patient/', o_custkey))", "{}.reference", "'Patient/' || o_custkey"),
    "cc": ("named_struct('coding', array(named_struct('code', o_orderpriority)))", "{}.coding[0].code", "o_orderpriority"),
    "period": (f"named_struct('start', {_AT})", "CAST({}.start AS timestamp_ntz)", "o_orderdate"),
    "note": ("named_struct('text', concat('note ', o_orderkey))", "{}.text", "'note ' || o_orderkey"),
    "quantity": ("named_struct('value', o_totalprice, 'unit', 'EUR')", "{}.value", "o_totalprice"),
}
# Elements of a resource, as they are written (a struct within braces, an array within brackets) and read.
_RESOURCES = {
    "Condition": "clinicalStatus cc clinical_status; bodySite [cc] body_site[0]; subject ref subject; onsetDateTime at onset_datetime; "
    "note [note] note[0]",
    "AllergyIntolerance": "type text type; category texts category; patient ref patient; lastOccurrence at last_occurrence; "
    "reaction [{substance cc,severity text}] reaction[0].substance,reaction[0].severity",
    "Procedure": "status text status; code cc code; performedPeriod period performed_period; performer [{actor ref}] performer[0].actor; "
    "outcome cc outcome",
    "DiagnosticReport": "status text status; code cc code; effectiveDateTime at effective_datetime; result [ref] result[0]; conclusion text conclusion",
    "MedicationRequest": "intent text intent; medicationCodeableConcept cc medication_codeable_concept; "
    "dispenseRequest {validityPeriod period,numberOfRepeatsAllowed count} dispense_request.validity_period,dispense_request.number_of_repeats_allowed; "
    "substitution {allowedBoolean flag} substitution_allowed_boolean",
    "Immunization": "vaccineCode cc vaccine_code; occurrenceDateTime at occurrence_datetime; primarySource flag primary_source; "
    "doseQuantity quantity dose_quantity; protocolApplied [{authority ref,doseNumberPositiveInt count}] "
    "protocol_applied[0].authority,protocol_applied[0].dose_number_positive_int",
    "Coverage": "subscriberId text subscriber_id; payor [ref] payor[0]; class [{type cc,value text}] class_coverage[0].type,class_coverage[0].value; "
    "order count order; period period period; subrogation flag subrogation",
    "CarePlan": "title text title; goal [ref] goal[0]; period period period; "
    "activity [{reference ref,detail {status text,code cc}}] activity[0].reference,activity[0].detail_status,activity[0].detail_code",
    "Goal": "lifecycleStatus text lifecycle_status; description cc description; startDate text start_date; "
    "target [{measure cc,detailQuantity quantity,detailBoolean flag}] target[0].measure,target[0].detail_quantity,target[0].detail_boolean",
    "Device": "manufacturer text manufacturer; deviceName [{name text}] device_name[0].name; type cc type; safety [cc] safety[0]; patient ref patient",
    "DocumentReference": "date at date; relatesTo [{code text,target ref}] relates_to[0].code,relates_to[0].target; "
    "content [{attachment {url text,title text},format {code text}}] content[0].attachment_url,content[0].attachment_title,content[0].format_code; "
    "context {event [cc],period period} context.event[0],context.period",
}


def _parts(text: str, mark: str) -> list[str]:
    """``text`` cut at the marks outside braces and brackets."""
    out, depth = [""], 0
    for c in text:
        depth += (c in "[{") - (c in "]}")
        if c == mark and not depth:
            out.append("")
        else:
            out[-1] += c
    return [p.strip() for p in out]


def _written(kind: str) -> tuple[str, list[str]]:
    """The SQL that writes an element, and the kinds of the values in it."""
    if kind.startswith("["):
        inner, kinds = _written(kind[1:-1])
        return f"array({inner})", kinds
    if not kind.startswith("{"):
        return _ELEMENTS[kind][0], [kind]
    fields, kinds = [], []
    for part in _parts(kind[1:-1], ","):
        name, inner = part.split(" ", 1)
        value, more = _written(inner)
        fields.append(f"'{name}', {value}")
        kinds += more
    return f"named_struct({', '.join(fields)})", kinds


def _resource_query(name: str, spec: str) -> None:
    body, reads, wants = [], [], []
    for line in spec.split(";"):
        element, kind, paths = _parts(line.strip(), " ")
        value, kinds = _written(kind)
        body.append(f"'{element}', {value}")
        for path, each in zip(paths.split(","), kinds, strict=True):
            label = f"v{len(reads)}"
            reads.append(f"{_ELEMENTS[each][1].format(path)} AS {label}")
            wants.append(f"{_ELEMENTS[each][2]} AS {label}")
    json = f"to_json(named_struct('resourceType', '{name}', 'id', CAST(o_orderkey AS string), {', '.join(body)})) AS raw_json"

    @query(f"fhir_{fhir._snake(name)}", "O-110b", sql=f"SELECT o_orderkey::VARCHAR AS id, {', '.join(wants)} FROM orders")
    def _(spark: SparkSession, d: str) -> DataFrame:
        rows = fhir.resource_rows(table(spark, d, "orders").selectExpr(json), name)
        return rows.selectExpr("id", *reads)


for _name, _spec in _RESOURCES.items():
    _resource_query(_name, _spec)



# ---------------------------------------------------------------- DICOM


def _tag(tag: str, vr: str, value: Column, quoted: bool = True) -> Column:
    mark = '"' if quoted else ""
    return _text(f'"{tag}": {{"vr": "{vr}", "Value": [{mark}', value, f"{mark}]}}")


def _object(*tags: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(", ", *tags), F.lit("}"))


@query(
    "dicom_studies",
    "O-111",
    sql="""
SELECT '1.2.' || o_orderkey AS study_instance_uid, strftime(o_orderdate, '%Y%m%d') AS study_date, 'Name ' || o_custkey AS patient_name,
       2::BIGINT AS modalities, o_orderpriority AS second_modality, o_custkey AS series, NULL::VARCHAR AS accession_number FROM orders
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    document = _object(
        _tag("0020000D", "UI", _text("1.2.", F.col("o_orderkey"))),
        _tag("00080020", "DA", F.date_format("o_orderdate", "yyyyMMdd")),
        _text('"00100010": {"vr": "PN", "Value": [{"Ideographic": "x", "Alphabetic": "Name ', F.col("o_custkey"), '"}]}'),
        _text('"00080061": {"vr": "CS", "Value": ["CT", "', F.col("o_orderpriority"), '"]}'),
        _tag("00201206", "IS", F.col("o_custkey"), quoted=False),
        F.lit('"00080050": {"vr": "SH"}'),
    )
    rows = dicom.rows(table(spark, d, "orders").select(document.alias("document")), "study")
    return rows.select(
        "study_instance_uid",
        "study_date",
        "patient_name",
        F.size("modalities_in_study").cast("bigint").alias("modalities"),
        F.get("modalities_in_study", F.lit(1)).alias("second_modality"),
        F.col("number_of_study_related_series").alias("series"),
        "accession_number",
    )


@query(
    "dicom_series",
    "O-111",
    sql="""
SELECT '1.3.' || p_partkey AS series_instance_uid, p_size::BIGINT AS series_number, p_brand AS modality, p_name AS series_description,
       NULL::VARCHAR AS body_part_examined FROM part
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    document = _object(
        _tag("0020000E", "UI", _text("1.3.", F.col("p_partkey"))),
        _tag("00200011", "IS", F.col("p_size")),
        _tag("00080060", "CS", F.col("p_brand")),
        _tag("0008103e", "LO", F.col("p_name")),
    )
    rows = dicom.rows(table(spark, d, "part").select(document.alias("document")), "series")
    return rows.select("series_instance_uid", "series_number", "modality", "series_description", "body_part_examined")


@query(
    "dicom_instances",
    "O-111", "O-189",
    sql="""
SELECT l_orderkey AS pinned, '1.4.' || l_orderkey AS sop_instance_uid, l_linenumber::BIGINT AS instance_number, strftime(l_shipdate, '%Y%m%d') AS content_date FROM lineitem
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    document = _object(
        _tag("00080018", "UI", _text("1.4.", F.col("l_orderkey"))),
        _tag("00200013", "IS", F.col("l_linenumber"), quoted=False),
        _tag("00080023", "DA", F.date_format("l_shipdate", "yyyyMMdd")),
    )
    source = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("pinned"), document.alias("document"))
    return dicom.rows(source, "instance", keep=("pinned",)).select("pinned", "sop_instance_uid", "instance_number", "content_date")


# ---------------------------------------------------------------- OSDU


@query(
    "osdu_records",
    "O-113", "O-68",
    sql="""
SELECT p_partkey::VARCHAR AS id, 7::BIGINT AS version, '2024-01-01' AS "modifyTime", 'data.' || p_brand AS owner, 1::BIGINT AS viewers,
       '{"a":' || p_size || '}' AS tags_json, CASE WHEN p_type = 'PROMO' THEN p_name END AS "FacilityName",
       CASE WHEN p_type = 'PROMO' THEN '["n",1]' END AS "FacilityNameAliases_json", CASE WHEN p_type = 'SMALL' THEN p_retailprice END AS "DepthTopMD",
       CASE WHEN p_type = 'LARGE' THEN p_size::DOUBLE END AS "FormationPressure" FROM part
""",
)
def _(spark: SparkSession, d: str) -> DataFrame:
    kind = (
        F.when(F.col("p_type") == "PROMO", "a:b:master-data--Wellbore:1.0.0")
        .when(F.col("p_type") == "SMALL", "a:b:master-data--Reservoir:1.0.0")
        .when(F.col("p_type") == "LARGE", "a:b:master-data--Sample:1.0.0")
        .otherwise("a:b:work-product:1.0.0")
    )
    document = _text(
        '{"id": "', F.col("p_partkey"), '", "kind": "', kind, '", "version": "7", "createTime": "2024-01-01", "acl": {"owners": ["data.', F.col("p_brand"),
        '"], "viewers": "v"}, "tags": {"a":', F.col("p_size"), '}, "data": {"FacilityName": "', F.col("p_name"),
        '", "FacilityNameAliases": ["n",1], "DepthTopMD": ', F.col("p_retailprice"),
        ', "SampleAcquisition": {"SampleAcquisitionDetail": {"FormationCondition": {"Pressure": ', F.col("p_size"), "}}}}}",
    )
    rows = osdu.rows(table(spark, d, "part").select(document.alias("raw_json")))
    return rows.select(
        "id",
        "version",
        "modifyTime",
        F.get("acl_owners", F.lit(0)).alias("owner"),
        F.size("acl_viewers").cast("bigint").alias("viewers"),
        "tags_json",
        "FacilityName",
        "FacilityNameAliases_json",
        "DepthTopMD",
        "FormationPressure",
    )
