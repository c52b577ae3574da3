"""DICOM JSON objects (keyed by tag) as study, series and instance rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.functions.nested import once

# Tags of each level, in output order.
STUDY = {
    "0020000D": "study_instance_uid",
    "00080020": "study_date",
    "00080030": "study_time",
    "00080050": "accession_number",
    "00100010": "patient_name",
    "00100020": "patient_id",
    "00081030": "study_description",
    "00080061": "modalities_in_study",
    "00201206": "number_of_study_related_series",
    "00201208": "number_of_study_related_instances",
}
SERIES = {
    "0020000E": "series_instance_uid",
    "0020000D": "study_instance_uid",
    "00080020": "study_date",
    "00200011": "series_number",
    "0008103E": "series_description",
    "00080060": "modality",
    "00180015": "body_part_examined",
    "00080021": "series_date",
}
INSTANCE = {
    "00080018": "sop_instance_uid",
    "0020000E": "series_instance_uid",
    "0020000D": "study_instance_uid",
    "00080016": "sop_class_uid",
    "00200013": "instance_number",
    "00080020": "study_date",
    "00080023": "content_date",
    "00080033": "content_time",
}
LEVELS = {"study": STUDY, "series": SERIES, "instance": INSTANCE}

# Value representations that hold whole numbers.
WHOLE_VRS = ("IS", "US", "UL", "SS", "SL")

NUMBERS = ("number_of_study_related_series", "number_of_study_related_instances", "series_number", "instance_number")
MANY = ("modalities_in_study",)
TAGS = "map<string, struct<vr: string, Value: array<string>>>"


def _name(text: Column) -> Column:
    """Person name: the first of its three writings that is given; a bare text stands for itself."""
    forms = [F.get_json_object(text, f"$.{form}") for form in ("Alphabetic", "Ideographic", "Phonetic")]
    given = F.coalesce(*[F.when(f != "", f) for f in forms])
    return F.when(text.startswith("{"), given).otherwise(text)


def _value(entry: Column, column: str) -> Column:
    values = F.when(F.size(entry["Value"]) > 0, entry["Value"])
    if column in MANY:
        return values
    first = F.get(values, F.lit(0))
    if column in NUMBERS:
        whole = entry["vr"].isin(*WHOLE_VRS)
        return F.when(whole, first.try_cast("bigint")).otherwise(first.try_cast("double").try_cast("bigint"))
    return F.when(entry["vr"] == "PN", _name(first)).otherwise(first)


def rows(df: DataFrame, level: str, document: str = "document", keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed row per object; a missing tag is null. ``keep`` names columns to carry along."""
    parsed = df.select(*keep, F.from_json(document, TAGS).alias("__tags"))

    def entry(tag: str) -> Column:
        return F.coalesce(F.try_element_at("__tags", F.lit(tag)), F.try_element_at("__tags", F.lit(tag.lower())))

    def column(tag: str, name: str) -> Column:
        return once(entry(tag), lambda e: _value(e, name)).alias(name)

    return parsed.select(*keep, *[column(tag, name) for tag, name in LEVELS[level].items()])
