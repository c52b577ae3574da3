"""Reading tables, files and loose formats; all of them split and pruned by Spark's own file sources."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.functions.literals import literal
from feedweir.functions.scalars import safe_name

CORRUPT = "_corrupt_record"


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """A batch scan. Partitions are file splits; a scan that cannot be planned fails instead of going serial."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int | None = None, **options: str
) -> DataFrame:
    """The same files as a stream; batch size is set here by files, never guessed by the engine."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def sample(df: DataFrame, n: int) -> DataFrame:
    """A few rows to look at; stops reading once it has them."""
    return df.limit(n)


# ---------------------------------------------------------------- JSON


def read_json_events(spark: SparkSession, path: str, schema: T.StructType, mode: str = "skip") -> DataFrame:
    """One JSON object per line, gzip or plain. Bad lines are dropped (``skip``), kept in ``_corrupt_record``
    (``keep``) or stop the job (``fail``)."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    if mode == "fail":
        return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = lines.select(F.from_json("value", with_bad, options).alias("r")).select("r.*")
    return rows if mode == "keep" else rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def parse_json_events(df: DataFrame, text: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Lines of a text column as rows, and one row with how many were good, bad and blank."""
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    others = [c for c in df.columns if c != text]
    lines = df.select(*others, F.explode(F.split(text, "\r?\n")).alias("__line"))
    blank = F.trim("__line") == ""
    parsed = lines.withColumn("__row", F.when(~blank, F.from_json("__line", with_bad, options)))
    bad = F.col(f"__row.{CORRUPT}").isNotNull()
    counts = parsed.agg(
        F.count_if(~blank & ~bad).alias("good"), F.count_if(~blank & bad).alias("bad"), F.count_if(blank).alias("blank")
    )
    rows = parsed.filter(~blank & ~bad).select(*others, *[F.col(f"__row.{f}") for f in schema.names])
    return rows, counts


def unwrap_events(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Documents that are an array of records, or an object holding one under events, data or records."""
    whole = F.try_parse_json(text)
    wrapped = [F.try_variant_get(whole, f"$.{name}", "array<variant>") for name in ("events", "data", "records")]
    each = F.coalesce(whole.try_cast("array<variant>"), *wrapped)
    others = [c for c in df.columns if c != text]
    rows = df.select(*others, F.explode(each).alias("__v"))
    return rows.select(*others, F.from_json(F.to_json("__v"), schema).alias("__r")).select(*others, "__r.*")


def read_zipped_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """ZIP archives of gzipped line files. One task opens one archive at a time and yields its lines in batches."""

    def unpack(batches):
        import gzip
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        with archive.open(member) as raw, gzip.open(raw, "rt", encoding="utf-8") as lines:
                            chunk = []
                            for line in lines:
                                if line.strip():
                                    chunk.append(line.strip())
                                if len(chunk) >= 10_000:
                                    yield pd.DataFrame({"source_file": name, "line": chunk})
                                    chunk = []
                            if chunk:
                                yield pd.DataFrame({"source_file": name, "line": chunk})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    lines = files.mapInPandas(unpack, "source_file string, line string")
    lines = lines.filter(F.get_json_object("line", "$").isNotNull())
    return lines.select("source_file", F.from_json("line", schema).alias("r")).select("source_file", "r.*")


# ---------------------------------------------------------------- CSV, XML, text


def csv_names(headers: list[str]) -> list[str]:
    """Report headers in lower case, blanks as ``_``, without a byte order mark."""
    return [h.lstrip("﻿").strip().lower().replace(" ", "_") for h in headers]


def read_csv_report(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """CSV with a header and all columns as text; empty cells are null."""
    rows = spark.read.options(header="true", nullValue="", emptyValue="", encoding="UTF-8", **options).csv(path)
    return rows.toDF(*csv_names(rows.columns))


def parse_csv_rows(df: DataFrame, text: str, headers: list[str]) -> DataFrame:
    """Lines of a text column as the columns of a report; empty cells are null."""
    names = csv_names(headers)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    others = [c for c in df.columns if c != text]
    row = F.from_csv(text, schema.simpleString()[len("struct<") : -1].replace(":", " "), {"nullValue": "", "emptyValue": ""})
    return df.select(*others, row.alias("__r")).select(*others, "__r.*")


def read_edmx(spark: SparkSession, path: str) -> DataFrame:
    """Entity properties of metadata documents: one row per entity type and property, with facets."""
    schema = T.StructType(
        [
            T.StructField("_Name", T.StringType()),
            T.StructField("Key", T.StructType([T.StructField("PropertyRef", T.ArrayType(T.StructType([T.StructField("_Name", T.StringType())])))])),
            T.StructField(
                "Property",
                T.ArrayType(
                    T.StructType(
                        [T.StructField(f"_{n}", T.StringType()) for n in ("Name", "Type", "Nullable", "MaxLength", "Precision", "Scale")]
                    )
                ),
            ),
        ]
    )
    types = spark.read.format("xml").options(rowTag="EntityType").schema(schema).load(path)
    rows = types.select(F.col("_Name").alias("entity"), F.col("Key.PropertyRef._Name").alias("keys"), F.explode("Property").alias("p"))
    return rows.select(
        "entity",
        F.col("p._Name").alias("property"),
        F.col("p._Type").alias("type"),
        F.coalesce(F.col("p._Nullable") != "false", F.lit(True)).alias("nullable"),
        F.col("p._MaxLength").try_cast("int").alias("max_length"),
        F.col("p._Precision").try_cast("int").alias("precision"),
        F.col("p._Scale").try_cast("int").alias("scale"),
        F.coalesce(F.array_contains("keys", F.col("p._Name")), F.lit(False)).alias("is_key"),
    )


# EDM primitive types and their Spark types; other types are text.
EDM_TYPES = {
    "Edm.String": "string",
    "Edm.Boolean": "boolean",
    "Edm.Byte": "int",
    "Edm.SByte": "int",
    "Edm.Int16": "int",
    "Edm.Int32": "int",
    "Edm.Int64": "bigint",
    "Edm.Single": "float",
    "Edm.Double": "double",
    "Edm.Date": "date",
    "Edm.DateTime": "timestamp",
    "Edm.DateTimeOffset": "timestamp",
    "Edm.Binary": "binary",
}


def edm_type(kind: Column, precision: Column, scale: Column) -> Column:
    """Spark type name of an EDM property; decimals keep their facets within 38 digits."""
    digits = F.least(F.coalesce(precision, F.lit(38)), F.lit(38))
    places = F.least(F.coalesce(scale, F.lit(0)), digits)
    known = F.create_map(*[F.lit(v) for pair in EDM_TYPES.items() for v in pair])
    decimal = F.concat(F.lit("decimal("), digits.cast("string"), F.lit(","), places.cast("string"), F.lit(")"))
    return F.when(kind == "Edm.Decimal", decimal).otherwise(F.coalesce(F.try_element_at(known, kind), F.lit("string")))


def scan_files(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    fmt: str = "text",
    strict: bool = False,
    **options: str,
) -> DataFrame:
    """Files of a folder and below, changed in ``(since, until]``, with ``source_file`` and ``create_time``.

    Files that vanish or cannot be read are skipped, which ``skipped_files`` tells, or stop the job if ``strict``. Only
    the chosen files are opened: the time is file metadata.
    """
    if fmt == "text":
        options = {"wholetext": "true", **options}
    lenient = "false" if strict else "true"
    rows = (
        spark.read.format(fmt)
        .options(pathGlobFilter=glob, recursiveFileLookup="true", ignoreMissingFiles=lenient, ignoreCorruptFiles=lenient)
        .options(**options)
        .load(path)
    )
    changed = F.col("_metadata.file_modification_time")
    # File bounds are pruned on the file's own metadata before any file is opened.
    if since is not None:
        rows = rows.filter(changed > literal(since, "timestamp"))
    if until is not None:
        rows = rows.filter(changed <= literal(until, "timestamp"))
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"), changed.alias("create_time"))


def list_files(
    spark: SparkSession, path: str, glob: str = "*", since: dt.datetime | None = None, until: dt.datetime | None = None
) -> DataFrame:
    """Names, lengths and times of the files that ``scan_files`` chooses, without opening one."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=glob, recursiveFileLookup="true").load(path)
    if since is not None:
        files = files.filter(F.col("modificationTime") > literal(since, "timestamp"))
    if until is not None:
        files = files.filter(F.col("modificationTime") <= literal(until, "timestamp"))
    return files.select(F.col("path").alias("source_file"), "length", F.col("modificationTime").alias("create_time"))


def _unpacked(batches):
    """Bytes that a gzip file holds up to its end or to the first fault, and whether there is a fault."""
    import io
    import zlib

    import pandas as pd

    for batch in batches:
        rows = []
        for name, content in zip(batch["source_file"], batch["content"]):
            stream, size, whole = io.BytesIO(content), 0, False
            try:
                part = zlib.decompressobj(31)
                while chunk := stream.read(1 << 20):
                    while chunk:
                        size += len(part.decompress(chunk))
                        whole, chunk = part.eof, part.unused_data
                        if whole and chunk:
                            part = zlib.decompressobj(31)
            except zlib.error:
                whole = False
            rows.append((name, size, whole))
        yield pd.DataFrame(rows, columns=["source_file", "unpacked", "whole"])


def skipped_files(
    spark: SparkSession, rows: DataFrame, path: str, glob: str = "*", since: dt.datetime | None = None, until: dt.datetime | None = None
) -> DataFrame:
    """Files of a ``scan_files`` of texts that are missing in its ``rows`` or only half there: one row per such file.

    Rows (source_file, length, bytes_read, status): ``unread`` if nothing came of a file that is not empty, ``partly``
    if less came than the listing has. Line ends, which lines come without, count as one byte each. Gzip files are
    measured unpacked, and one that breaks off or fails its check sum is ``partly`` whatever was read of it.
    """
    listed = list_files(spark, path, glob, since, until)
    size = F.octet_length("value") + 1
    came = rows.groupBy("source_file").agg(F.sum(size).alias("bytes_read"))
    # names of one file differ in how many slashes follow the scheme
    plain = F.regexp_replace("source_file", "^file:/+", "file:/")
    zipped = spark.read.format("binaryFile").options(pathGlobFilter=glob, recursiveFileLookup="true").load(path)
    zipped = zipped.filter(F.col("path").endswith(".gz")).select(F.col("path").alias("source_file"), "content")
    inside = zipped.mapInPandas(_unpacked, "source_file string, unpacked long, whole boolean")
    found = listed.withColumn("__file", plain).join(came.withColumn("__file", plain).drop("source_file"), "__file", "left")
    found = found.join(inside.withColumn("__file", plain).drop("source_file"), "__file", "left")
    expected = F.coalesce("unpacked", "length")
    whole, read = F.coalesce("whole", F.lit(True)), F.coalesce("bytes_read", F.lit(0))
    lacking = ~whole | (read < expected)
    status = F.when(lacking, F.when(F.col("bytes_read").isNull(), "unread").otherwise("partly"))
    found = found.withColumn("status", status).filter(F.col("status").isNotNull())
    return found.select("source_file", "length", F.coalesce("bytes_read", F.lit(0)).alias("bytes_read"), "status")


def cut_messages(lines: DataFrame, starts: Column, skip: Column) -> DataFrame:
    """Messages out of the lines of text files that several tasks read: (source_file, create_time, message_no, message).

    ``lines`` is a scan by lines with ``value``, ``source_file``, ``create_time``, and ``block``, where the task's part
    of the file begins. A line that ``starts`` opens a message, which may go on in later parts; lines before the first one
    and lines to ``skip`` are none's. Lines are numbered within their part, and one count per part carries the number
    of the open message over to the next, so that no task holds a file.
    """
    kept = lines.filter(~skip).withColumn("__line", F.monotonically_increasing_id()).withColumn("__opens", starts)
    part = ["source_file", "block"]
    opened = kept.groupBy(*part).agg(F.count_if("__opens").alias("__n"))
    # one row per part of a file
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = opened.select(*part, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    here = Window.partitionBy(*part).orderBy("__line").rowsBetween(Window.unboundedPreceding, 0)
    numbered = kept.withColumn("__here", F.count_if("__opens").over(here)).join(opened, part)
    numbered = numbered.withColumn("message_no", (F.col("__before") + F.col("__here") - 1).cast("int"))
    text = F.sort_array(F.collect_list(F.struct("block", "__line", "value")))
    whole = numbered.filter("message_no >= 0").groupBy("source_file", "message_no").agg(F.min("create_time").alias("create_time"), text.alias("__t"))
    return whole.select("source_file", "create_time", "message_no", F.array_join("__t.value", "\r").alias("message"))


def read_hl7(spark: SparkSession, path: str, glob: str = "*.hl7", **bounds) -> DataFrame:
    """Messages of HL7 files, which may hold any number: a large file is read by as many tasks as it has parts.

    A message is what ``domains.hl7.messages`` makes of the whole text of the file, with the same ``message_no``.
    """
    from feedweir.domains import hl7

    lines = scan_files(spark, path, glob, wholetext="false", **bounds)
    lines = lines.select("*", F.col("_metadata.file_block_start").alias("block"))
    return cut_messages(lines, hl7.opens_message(F.col("value")), hl7.no_line(F.col("value")))


def grid_header(df: DataFrame, values: str) -> Column:
    """Header cells of a spreadsheet row as column names."""
    return F.transform(values, lambda v, i: safe_name(v.cast("string"), i))


def reader_options(options: Mapping[str, str], reserved: tuple[str, ...]) -> dict[str, str]:
    """Options without those that steer the load itself."""
    return {k: v for k, v in options.items() if k not in reserved}
