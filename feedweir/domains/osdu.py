"""OSDU records: the envelope as columns, plus the columns of three kinds of master data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.operators.shaping import columns_by_kind

# Kinds and the columns they add. ``:d`` is a number, ``:j`` JSON text in a column named ``<name>_json``.
KINDS = {
    "master-data--Wellbore": "FacilityID FacilityName FacilityTypeID WellID KickOffWellboreID StatusSummary "
    "TargetFormation FacilityNameAliases:j FacilityOperators:j VerticalMeasurements:j SpatialLocation:j GeoContexts:j "
    "DrillingReasons:j InitialCompletion:j ExtensionProperties:j",
    "master-data--Reservoir": "ReservoirID ReservoirName ReservoirType ReservoirDescription FieldID BasinID FormationID "
    "FluidTypeID DepthTopMD:d DepthBaseMD:d DepthTopTVD:d DepthBaseTVD:d GrossThickness:d NetPayThickness:d "
    "PorosityAverage:d WaterSaturationAverage:d PermeabilityHorizontal:d PermeabilityVertical:d "
    "InitialReservoirPressure:d ReservoirTemperature:d GeoContexts:j NameAliases:j ExtensionProperties:j",
    "master-data--Sample": "SampleAcquisition.SampleAcquisitionJobID SampleAcquisition.SampleAcquisitionTypeID "
    "SampleAcquisition.SampleAcquisitionContainerID SampleAcquisition.AcquisitionStartDate "
    "SampleAcquisition.AcquisitionEndDate SampleAcquisition.CollectionServiceCompanyID "
    "SampleAcquisition.HandlingServiceCompanyID SampleAcquisition.SampleAcquisitionDetail.WellboreID "
    "SampleAcquisition.SampleAcquisitionDetail.ToolKind SampleAcquisition.SampleAcquisitionDetail.RunNumber "
    "SampleAcquisition.SampleAcquisitionDetail.TopDepth:d SampleAcquisition.SampleAcquisitionDetail.BaseDepth:d "
    "SampleAcquisition.SampleAcquisitionDetail.FormationCondition.Pressure=FormationPressure:d "
    "SampleAcquisition.SampleAcquisitionDetail.FormationCondition.Temperature=FormationTemperature:d "
    "SampleAcquisition:j ExtensionProperties:j",
}


# Envelope elements; lists of texts end in ``*``.
ENVELOPE = "id kind version createTime createUser modifyTime modifyUser acl.owners* acl.viewers* legal.legaltags* " \
    "legal.status legal.otherRelevantDataCountries* tags meta data"


def _schema(paths: list[str]) -> T.StructType:
    """Schema with every named path as text; an object or list read as text keeps its JSON."""
    tree: dict = {}
    for path in paths:
        node = tree
        *above, leaf = path.split(".")
        for step in above:
            node = node.setdefault(step, {})
        node.setdefault(leaf, None)

    def build(node: dict) -> T.StructType:
        return T.StructType([T.StructField(n, build(v) if isinstance(v, dict) else T.StringType()) for n, v in node.items()])

    return build(tree)


def _texts(value: Column) -> Column:
    """A list of texts; a single value stands for a list of one."""
    listed = F.from_json(value, "array<string>")
    return F.when(value.startswith("["), listed).when(value.isNotNull(), F.array(value))


def _columns_of_kind(spec: str) -> list[tuple[str, str, str]]:
    """``(path, column, type)`` of the columns a kind adds."""
    out = []
    for item in spec.split():
        path, _, kind = item.partition(":")
        path, _, label = path.partition("=")
        name = label or path.rsplit(".", 1)[-1]
        out.append((path, f"{name}_json" if kind == "j" else name, kind))
    return out


def rows(df: DataFrame, raw: str = "raw_json", by_kind: bool = True) -> DataFrame:
    """One row per record; an update time that was never set is the creation time.

    The record is parsed once, its ``data`` once more for the columns of its kind.
    """
    paths = ENVELOPE.split()
    parsed = df.select(F.from_json(raw, _schema([p.rstrip("*") for p in paths])).alias("r"))
    columns = []
    for path in paths:
        value = F.col(f"r.{path.rstrip('*')}")
        name = path.rstrip("*").replace(".", "_")
        if path.endswith("*"):
            value = _texts(value)
        elif name in ("tags", "meta", "data"):
            name = f"{name}_json"
        columns.append(value.alias(name))
    base = parsed.select(*columns).withColumns(
        {
            "version": F.col("version").try_cast("bigint"),
            "modifyTime": F.when(F.col("modifyTime") != "", F.col("modifyTime")).otherwise(F.col("createTime")),
            "data_json": F.coalesce("data_json", F.lit("{}")),
        }
    )
    if not by_kind:
        return base
    added = {fragment: _columns_of_kind(spec) for fragment, spec in KINDS.items()}
    # A path read as JSON text may also lead to deeper ones; those come from the text in a parse of their own.
    whole = sorted({p for columns in added.values() for p, _, kind in columns if kind == "j"})
    deep = sorted({p for columns in added.values() for p, _, kind in columns if kind != "j"})
    base = base.withColumns(
        {"__whole": F.from_json("data_json", _schema(whole)), "__deep": F.from_json("data_json", _schema(deep))}
    )

    def value_of(path: str, kind: str) -> Column:
        if kind == "j":
            return F.col(f"__whole.{path}")
        c = F.col(f"__deep.{path}")
        return c.try_cast("double") if kind == "d" else c

    specs = {fragment: {name: value_of(p, kind) for p, name, kind in columns} for fragment, columns in added.items()}
    return columns_by_kind(base, F.coalesce("kind", F.lit("")), specs).drop("__whole", "__deep")
