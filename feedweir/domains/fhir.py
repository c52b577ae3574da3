"""FHIR R4 resources in JSON as typed rows.

A type is a list of lines ``path kind [column]``. The column name defaults to the last path step in snake_case; a kind
with ``*`` is an array, empty rather than null when the element is missing. From these lists come both the schema the
JSON is parsed with, so only the listed elements are materialised, and the projection.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.functions import documents
from feedweir.functions.coercion import to_timestamp
from feedweir.functions.nested import once

_PRIMITIVE = {"str": T.StringType(), "bool": T.BooleanType(), "long": T.LongType(), "double": T.DoubleType(), "ts": T.StringType()}

# Datatypes and repeated parts of resources.
TYPES = {
    "coding": "system str, code str, display str",
    "cc": "coding coding*, text str",
    "ref": "reference str, display str",
    "period": "start ts, end ts",
    "identifier": "system str, value str, use str",
    "name": "family str, given str*, text str, use str",
    "address": "use str, line str*, city str, district str, postalCode str postalCode, country str",
    "contact": "system str, value str, use str",
    "quantity": "value double, unit str, system str, code str",
    "note": "text str, time ts",
    "dosage": "text str, timing.code.coding[0].code str timing_code, doseAndRate[0].doseQuantity.value double dose_value, "
    "doseAndRate[0].doseQuantity.unit str dose_unit, route cc, site cc",
    "obs_range": "low.value double low_value, low.unit str low_unit, high.value double high_value, "
    "high.unit str high_unit, type cc, text str",
    "obs_component": "code cc, valueQuantity quantity, valueString str, valueCodeableConcept cc, valueBoolean bool, "
    "valueInteger long, dataAbsentReason cc",
    "reaction": "substance cc, manifestation cc*, description str, onset ts, severity str, exposureRoute cc",
    "participant": "type cc*, period period, individual ref",
    "enc_diagnosis": "condition ref, use cc, rank long",
    "hospitalization": "admitSource cc, reAdmission cc, dischargeDisposition cc, origin ref, destination ref",
    "enc_location": "location ref, status str, physicalType cc, period period",
    "proc_performer": "function cc, actor ref, onBehalfOf ref",
    "dispense": "validityPeriod period, numberOfRepeatsAllowed long, quantity.value double quantity_value, "
    "quantity.unit str quantity_unit, expectedSupplyDuration.value double expected_supply_duration_value, "
    "expectedSupplyDuration.unit str expected_supply_duration_unit",
    "imm_performer": "function cc, actor ref",
    "protocol": "series str, authority ref, targetDisease cc*, doseNumberPositiveInt long, doseNumberString str, "
    "seriesDosesPositiveInt long, seriesDosesString str",
    "cov_class": "type cc, value str, name str",
    "activity": "reference ref, detail.status str detail_status, detail.code cc detail_code, "
    "detail.description str detail_description",
    "goal_target": "measure cc, detailQuantity quantity, detailString str, detailBoolean bool, dueDate str",
    "device_name": "name str, type str",
    "relates_to": "code str, target ref",
    "doc_content": "attachment.url str attachment_url, attachment.title str attachment_title, "
    "attachment.contentType str attachment_content_type, format.code str format_code, format.system str format_system",
    "sub_extension": "url str, valueCodeableConcept cc",
    "extension": "url str, valueCodeableConcept cc, valueBoolean bool, extension sub_extension*",
    "doc_context": "encounter ref*, event cc*, period period, facilityType cc, practiceSetting cc",
}

# Base R4 resources.
RESOURCES = {
    "Patient": "identifier identifier*, active bool, name name*, telecom contact*, gender str, birthDate str birthDate, "
    "deceasedBoolean bool, deceasedDateTime ts, address address*, maritalStatus cc maritalStatus, "
    "generalPractitioner ref* generalPractitioner, managingOrganization ref managingOrganization",
    "Observation": "status str, category cc*, code cc, subject ref, encounter ref, effectiveDateTime ts, "
    "effectivePeriod period, issued ts, performer ref*, valueQuantity quantity, valueCodeableConcept cc, "
    "valueString str, valueBoolean bool, valueInteger long, dataAbsentReason cc, interpretation cc*, bodySite cc, "
    "method cc, specimen ref, device ref, referenceRange obs_range*, hasMember ref*, derivedFrom ref*, "
    "component obs_component*",
    "Condition": "identifier identifier*, clinicalStatus cc, verificationStatus cc, category cc*, severity cc, code cc, "
    "bodySite cc*, subject ref, encounter ref, onsetDateTime ts, onsetPeriod period, onsetString str, "
    "abatementDateTime ts, abatementString str, recordedDate str, recorder ref, asserter ref, note note*",
    "AllergyIntolerance": "identifier identifier*, clinicalStatus cc, verificationStatus cc, type str, category str*, "
    "criticality str, code cc, patient ref, encounter ref, onsetDateTime ts, onsetString str, recordedDate str, "
    "recorder ref, asserter ref, lastOccurrence ts, note note*, reaction reaction*",
    "Encounter": "identifier identifier*, status str, class coding class_coding, type cc*, serviceType cc, priority cc, "
    "subject ref, episodeOfCare ref*, participant participant*, appointment ref*, period period, reasonCode cc*, "
    "reasonReference ref*, diagnosis enc_diagnosis*, hospitalization hospitalization, location enc_location*, "
    "serviceProvider ref, partOf ref",
    "Procedure": "identifier identifier*, status str, statusReason cc, category cc, code cc, subject ref, encounter ref, "
    "performedDateTime ts, performedPeriod period, recorder ref, asserter ref, performer proc_performer*, location ref, "
    "reasonCode cc*, reasonReference ref*, bodySite cc*, outcome cc, report ref*, complication cc*, followUp cc*, "
    "note note*",
    "DiagnosticReport": "identifier identifier*, basedOn ref*, status str, category cc*, code cc, subject ref, "
    "encounter ref, effectiveDateTime ts, effectivePeriod period, issued ts, performer ref*, resultsInterpreter ref*, "
    "specimen ref*, result ref*, conclusion str, conclusionCode cc*",
    "MedicationRequest": "identifier identifier*, status str, statusReason cc, intent str, category cc*, priority str, "
    "medicationCodeableConcept cc, medicationReference ref, subject ref, encounter ref, authoredOn str, requester ref, "
    "reasonCode cc*, reasonReference ref*, note note*, dosageInstruction dosage*, dispenseRequest dispense, "
    "substitution.allowedBoolean bool substitution_allowed_boolean",
    "Immunization": "identifier identifier*, status str, statusReason cc, vaccineCode cc, patient ref, encounter ref, "
    "occurrenceDateTime ts, occurrenceString str, recorded str, primarySource bool, manufacturer ref, lotNumber str, "
    "expirationDate str, site cc, route cc, doseQuantity quantity, performer imm_performer*, reasonCode cc*, "
    "reasonReference ref*, isSubpotent bool, programEligibility cc*, fundingSource cc, protocolApplied protocol*",
    "Coverage": "identifier identifier*, status str, type cc, policyHolder ref, subscriber ref, subscriberId str, "
    "beneficiary ref, dependent str, relationship cc, period period, payor ref*, class cov_class* class_coverage, "
    "order long, network str, subrogation bool",
    "CarePlan": "identifier identifier*, status str, intent str, category cc*, title str, description str, subject ref, "
    "encounter ref, period period, created str, author ref, careTeam ref*, addresses ref*, goal ref*, "
    "activity activity*, note note*",
    "Goal": "identifier identifier*, lifecycleStatus str, achievementStatus cc, category cc*, priority cc, "
    "description cc, subject ref, startDate str, startCodeableConcept cc, target goal_target*, statusDate str, "
    "statusReason str, expressedBy ref, addresses ref*, note note*",
    "Device": "identifier identifier*, status str, statusReason cc*, manufacturer str, manufactureDate str, "
    "expirationDate str, lotNumber str, serialNumber str, deviceName device_name*, modelNumber str, type cc, "
    "patient ref, owner ref, contact contact*, note note*, safety cc*",
    "DocumentReference": "identifier identifier*, status str, docStatus str, type cc, category cc*, subject ref, date ts, "
    "author ref*, authenticator ref, custodian ref, relatesTo relates_to*, description str, securityLabel cc*, "
    "content doc_content*, context doc_context",
}

# Elements every resource has.
COMMON = "id str, resourceType str, meta.lastUpdated ts"

# National extensions of the patient.
UK_EXTENSION = "https://fhir.hl7.org.uk/StructureDefinition/Extension-UKCore-"
INTERPRETER = "http://hl7.org/fhir/StructureDefinition/patient-interpreterRequired"
NHS_NUMBER = "https://fhir.nhs.uk/Id/nhs-number"

# Profiles in the order they are tried.
PROFILES = ("uk_core", "base_r4")


# ---------------------------------------------------------------- types to schema and columns


def _snake(name: str) -> str:
    words = re.sub("([a-z0-9])([A-Z])", r"\1_\2", name.replace("DateTime", "Datetime"))
    return words.lower()


def _lines(spec: str) -> list[tuple[list[tuple[str, int | None]], str, str]]:
    """``(path steps with an optional index, kind, column)`` of each line."""
    out = []
    for line in spec.split(","):
        path, kind, *label = line.split()
        steps = []
        for step in path.split("."):
            name, _, index = step.partition("[")
            steps.append((name, int(index[:-1]) if index else None))
        out.append((steps, kind, label[0] if label else _snake(steps[-1][0])))
    return out


def _kind_schema(kind: str) -> T.DataType:
    bare = kind.removesuffix("*")
    inner = _PRIMITIVE[bare] if bare in _PRIMITIVE else json_schema(TYPES[bare])
    return T.ArrayType(inner) if kind.endswith("*") else inner


def json_schema(spec: str) -> T.StructType:
    """Schema that parses exactly the elements a type list names."""
    tree: dict = {}
    for steps, kind, _ in _lines(spec):
        node = tree
        for name, index in steps[:-1]:
            node = node.setdefault((name, index is not None), {})
        node[(steps[-1][0], False)] = _kind_schema(kind)

    def build(node: dict) -> T.StructType:
        fields = []
        for (name, many), value in node.items():
            kind = build(value) if isinstance(value, dict) else value
            fields.append(T.StructField(name, T.ArrayType(kind) if many else kind))
        return T.StructType(fields)

    return build(tree)


def _walk(c: Column, steps: list[tuple[str, int | None]]) -> Column:
    for name, index in steps:
        c = c[name] if index is None else F.get(c[name], F.lit(index))
    return c


def _as_parsed(kind: str) -> bool:
    """Whether the column of a kind is what ``json_schema`` parses: nothing in it is renamed, moved or converted."""
    if kind in _PRIMITIVE or kind.endswith("*"):
        return kind in _PRIMITIVE and kind != "ts"
    return all(steps == [(label, None)] and _as_parsed(inner) for steps, inner, label in _lines(TYPES[kind]))


def typed(c: Column, kind: str, exact: bool = False) -> Column:
    """A parsed element as its typed column.

    ``exact`` says that it was parsed with the schema of its kind, so that a struct that stays as it is need not be rebuilt.
    """

    def stays(bare: str) -> bool:
        return _as_parsed(bare) if exact else bare in _PRIMITIVE and bare != "ts"

    if kind.endswith("*"):
        bare = kind[:-1]
        each = c if stays(bare) else F.transform(c, lambda v: typed(v, bare, exact))
        return F.coalesce(each, F.array())
    if kind == "ts":
        return to_timestamp(c)
    if stays(kind):
        return c
    return F.when(c.isNotNull(), F.struct(*columns_of(c, TYPES[kind], exact)))


def columns_of(c: Column, spec: str, exact: bool = False) -> list[Column]:
    """All columns of a type list, read from a parsed struct."""
    return [typed(_walk(c, steps), kind, exact).alias(label) for steps, kind, label in _lines(spec)]


def datatype(c: Column, kind: str) -> Column:
    """One datatype (``coding``, ``cc``, ``ref``, ``period``, … a key of ``TYPES``) out of JSON text."""
    return once(F.from_json(c, _kind_schema(kind)), lambda v: typed(v, kind, exact=True))


# ---------------------------------------------------------------- profiles


@dataclass(frozen=True)
class Profile:
    """What to parse of a resource and how to turn the parsed struct into columns."""

    spec: str
    columns: Callable[[Column], list[Column]]


_REGISTRY: dict[tuple[str, str], Profile] = {}


def register(resource_type: str, profile: str, spec: str):
    """Register a function from the parsed struct to columns; ``spec`` lists the elements it reads."""

    def keep(fn: Callable[[Column], list[Column]]) -> Callable[[Column], list[Column]]:
        _REGISTRY[(resource_type, profile)] = Profile(spec, fn)
        return fn

    return keep


def profile_chain(profile: str) -> list[str]:
    """The profile and those it falls back to; an unknown profile falls back to all of them."""
    return list(PROFILES[PROFILES.index(profile) :]) if profile in PROFILES else [profile, *PROFILES]


def find_profile(resource_type: str, profile: str = "uk_core") -> Profile | None:
    """The nearest profile that knows the type; without one a resource has only the common columns."""
    for name in profile_chain(profile):
        if (resource_type, name) in _REGISTRY:
            return _REGISTRY[(resource_type, name)]
    return None


for _type, _spec in RESOURCES.items():
    register(_type, "base_r4", _spec)(lambda r, spec=_spec: columns_of(r, spec, exact=True))


def extension(array: Column, url: str) -> Column:
    """First extension with the url."""
    return F.get(F.filter(array, lambda e: e["url"] == url), F.lit(0))


def identifier_value(identifiers: Column, system: str) -> Column:
    """Value of the first identifier of a system."""
    return F.get(F.filter(identifiers, lambda i: i["system"] == system), F.lit(0))["value"]


@register("Patient", "uk_core", RESOURCES["Patient"] + ", extension extension*")
def _national_patient(r: Column) -> list[Column]:
    def coded(found: Column) -> Column:
        return once(found["valueCodeableConcept"], lambda c: typed(c, "cc", exact=True))

    def uk(name: str) -> Column:
        return extension(r["extension"], UK_EXTENSION + name)

    death = extension(uk("DeathNotificationStatus")["extension"], "deathNotificationStatus")
    return [
        *columns_of(r, RESOURCES["Patient"], exact=True),
        identifier_value(r["identifier"], NHS_NUMBER).alias("nhs_number"),
        coded(uk("EthnicCategory")).alias("ethnic_category"),
        coded(uk("BirthSex")).alias("birth_sex"),
        coded(death).alias("death_notification_status"),
        extension(r["extension"], INTERPRETER)["valueBoolean"].alias("interpreter_required"),
        coded(uk("ResidentialStatus")).alias("residential_status"),
    ]


# ---------------------------------------------------------------- rows


def _only(spec: str, names: Sequence[str]) -> str:
    """The lines of a type list that give the named columns."""
    kept = [line for line in spec.split(",") if _lines(line)[0][2] in names]
    return ",".join(kept)


def resource_rows(
    df: DataFrame,
    resource_type: str,
    profile: str = "uk_core",
    raw: str = "raw_json",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Typed rows of one resource type with the raw JSON and the extension JSON kept as text; parsed once.

    ``columns`` limits the typed columns, and the parser to the elements they need. Every row is taken for the given
    type: filter mixed input on its resource type before.
    """
    found = find_profile(resource_type, profile)
    if found and columns is not None and found.spec == RESOURCES.get(resource_type):
        narrow = _only(found.spec, columns)
        found = Profile(narrow, lambda r: columns_of(r, narrow, exact=True)) if narrow else None
    spec = COMMON + (", " + found.spec if found else "")
    r = F.col("__r")
    # a generator's output is made once: filters on typed columns stay above it instead of parsing the text again
    parsed = F.explode(F.array(F.from_json("raw_json", json_schema(spec)))).alias("__r")
    rows = df.select(F.col(raw).alias("raw_json")).select("raw_json", parsed).select(
        r["id"].alias("id"),
        F.coalesce(r["resourceType"], F.lit(resource_type)).alias("resourceType"),
        to_timestamp(r["meta"]["lastUpdated"]).alias("lastUpdated"),
        "raw_json",
        F.coalesce(F.get_json_object("raw_json", "$.extension"), F.lit("null")).alias("extension"),
        *(found.columns(r) if found else []),
    )
    common = ("id", "resourceType", "lastUpdated", "raw_json", "extension")
    return rows if columns is None else rows.select(*common, *[c for c in columns if c not in common])


def bundle_entries(df: DataFrame, bundle: str = "bundle", keep: Mapping[str, Column] | None = None) -> DataFrame:
    """Resources of bundles as JSON text, one per row; entries without a resource are skipped, other documents fail."""
    c = F.col(bundle)

    def entries(parsed: Column) -> Column:
        # texts that are no JSON as a whole may still begin like a bundle
        kind = F.when(parsed.isNotNull(), F.try_variant_get(parsed, "$.resourceType", "string")).otherwise(F.get_json_object(c, "$.resourceType"))
        return once(kind, lambda k: F.when(k.eqNullSafe("Bundle"), found(parsed)).otherwise(wrong(k)))

    def found(parsed: Column) -> Column:
        # texts are chosen inside the array, so that each is written once
        each = F.try_variant_get(parsed, "$.entry", "array<variant>")
        return F.transform(each, lambda e: F.to_json(F.try_variant_get(e, "$.resource", "variant")))

    def wrong(kind: Column) -> Column:
        return F.raise_error(F.concat(F.lit("not a Bundle: "), F.coalesce(kind, F.lit("null")))).cast("array<string>")

    kept = [column.alias(name) for name, column in (keep or {}).items()]
    # the plain texts are cut in Python, a tenth of the time of a variant's writing; the others as variants
    texts = F.coalesce(documents.members(c, "Bundle", "entry", "resource"), once(F.try_parse_json(c), entries))
    return df.select(*kept, F.explode(F.filter(texts, lambda t: t != "{}")).alias("raw_json"))
