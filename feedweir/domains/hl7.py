"""HL7 v2 text as tables: messages, segments, fields, composites.

Separators are read from each message's MSH and exchanged for control characters while a line is split, so all patterns
are constants; values get their own separators back. Segment rows hold every field twice: as written (``fields``) and
with escapes decoded (``decoded``). Column expressions are generated as SQL text, because a wide segment table has
hundreds of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweir.domains.hl7_fields import COMPOSITES, ENVELOPE_SEGMENTS, SEGMENTS, SINGLE_SEGMENTS
from feedweir.functions.nested import once

GENERIC_FIELDS = 25
# Control characters that stand for the field, component, repetition and subcomponent separators.
FIELD, COMP, REP, SUB = "\x1c", "\x1d", "\x1e", "\x1f"

# MSH fields carried onto every row, by place after the segment name.
METADATA_PLACES = {"message_id": 9, "message_timestamp": 6, "hl7_version": 11}
METADATA = tuple(METADATA_PLACES)


# ---------------------------------------------------------------- text functions


def separators(message: Column) -> Column:
    """The five separators a message declares in its MSH."""
    msh = F.substring_index(message, "\r", 1)
    enc = F.when(F.length(msh) >= 8, F.substring(message, 5, 4)).otherwise(F.lit("^~\\&"))
    parts = {"field": F.substring(message, 4, 1)}
    parts |= {name: F.substring(enc, place, 1) for place, name in enumerate(("comp", "rep", "esc", "sub"), start=1)}
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def unescape(c: Column, seps: Column) -> Column:
    """Escape sequences F S T R H N E decoded; E comes last, so its result is not read again."""
    plain = {"F": seps["field"], "S": seps["comp"], "T": seps["sub"], "R": seps["rep"], "H": F.lit(""), "N": F.lit("")}

    def decode(v: Column) -> Column:
        out = v
        for letter, text in {**plain, "E": seps["esc"]}.items():
            out = F.replace(out, F.concat(seps["esc"], F.lit(letter), seps["esc"]), text)
        return F.when(v.contains(seps["esc"]), out).otherwise(v)

    return once(c, decode)


def _iso(c: Column) -> Column:
    pattern = r"^(\d{4}(?:\d{2}){0,5})(?:\.\d+)?([+-]\d{4})?$"
    digits, offset = F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 2)
    # Missing parts are the first month and day, and midnight.
    full = F.concat(digits, F.substring(F.lit("00000101000000"), F.length(digits) + 1, F.lit(14)))
    local = F.when(digits != "", F.try_to_timestamp(full, F.lit("yyyyMMddHHmmss")))
    minutes = F.substring(offset, 2, 2).try_cast("bigint") * 60 + F.substring(offset, 4, 2).try_cast("bigint")
    shift = F.when(offset == "", F.lit(0).cast("bigint")).when(offset.startswith("-"), -minutes).otherwise(minutes)
    utc = F.timestamp_micros(F.unix_micros(local) - shift * 60_000_000)
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")


def timestamp_text(c: Column) -> Column:
    """DTM text of any precision, with or without offset, as ISO text in UTC; null when it is none.

    Impossible dates are null too.
    """
    return once(F.regexp_replace(F.trim(c), r"^[()]+|[()]+$", ""), _iso)


# ---------------------------------------------------------------- SQL text for columns


def _dtm(sql: str) -> str:
    """``timestamp_text`` as SQL."""
    digits = r"regexp_extract(t, r'^(\d{4}(?:\d{2}){0,5})(?:\.\d+)?([+-]\d{4})?$', 1)"
    offset = r"regexp_extract(t, r'^(\d{4}(?:\d{2}){0,5})(?:\.\d+)?([+-]\d{4})?$', 2)"
    full = "concat(p.d, substring('00000101000000', length(p.d) + 1))"
    minutes = "(try_cast(substring(p.o, 2, 2) AS BIGINT) * 60 + try_cast(substring(p.o, 4, 2) AS BIGINT))"
    shift = f"CASE WHEN p.o = '' THEN 0L WHEN p.o LIKE '-%' THEN -{minutes} ELSE {minutes} END"
    utc = f"timestamp_micros(unix_micros(try_to_timestamp({full}, 'yyyyMMddHHmmss')) - ({shift}) * 60000000)"
    iso = f"CASE WHEN p.d <> '' THEN date_format({utc}, \"yyyy-MM-dd'T'HH:mm:ss\") END"
    parts = f"named_struct('d', {digits}, 'o', {offset})"
    clean = f"regexp_replace(trim({sql}), '^[()]+|[()]+$', '')"
    return f"get(transform(transform(array({clean}), t -> {parts}), p -> {iso}), 0)"


_SHOWN = {COMP: "seps.comp", REP: "seps.rep", SUB: "seps.sub"}


def _shown(sql: str, hidden: str = COMP + REP + SUB) -> str:
    """The separators named in ``hidden`` written as the sender wrote them."""
    for mark in hidden:
        sql = f"replace({sql}, '{mark}', {_SHOWN[mark]})"
    return sql


def _hide(c: Column, seps: Column) -> Column:
    for mark, name in ((FIELD, "field"), (COMP, "comp"), (REP, "rep"), (SUB, "sub")):
        c = F.replace(c, seps[name], F.lit(mark))
    return c


def _some(sql: str) -> str:
    return f"get(filter(array({sql}), w -> w <> ''), 0)"


def _raw(n: int, decoded: bool = False) -> str:
    return f"get({'decoded' if decoded else 'fields'}, {n})"


def _repetition(n: int, r: int, decoded: bool = False) -> str:
    return _some(f"get(split({_raw(n, decoded)}, '{REP}', -1), {r - 1})")


def _whole(n: int, r: int | None, decoded: bool = False) -> str:
    return _raw(n, decoded) if r is None else _repetition(n, r, decoded)


def _int(sql: str) -> str:
    return f"get(transform(array(trim({sql})), w -> CASE WHEN w RLIKE '^[+-]?[0-9]+$' THEN try_cast(w AS BIGINT) END), 0)"


def _set_id() -> str:
    return f"coalesce({_int(_shown(_raw(1)))}, 1L)"


def field(n: int) -> Column:
    """Field ``n`` (1-based) of a segment row, null when empty or out of range."""
    return F.expr(_shown(_raw(n)))


def repetition(n: int, r: int = 1) -> Column:
    """Repetition ``r`` of a field."""
    return F.expr(_shown(_repetition(n, r)))


def component(n: int, c: int, r: int | None = None) -> Column:
    """Component ``c`` of a field, or of its repetition ``r``, with escapes decoded."""
    return F.expr(_component(n, c, r))


def _component(n: int, c: int, r: int | None = None) -> str:
    return _shown(_some(f"get(split({_whole(n, r, True)}, '{COMP}', -1), {c - 1})"))


def subcomponent(n: int, c: int, s: int, r: int | None = None) -> Column:
    """Subcomponent ``s`` of a component."""
    comp = f"get(split({_whole(n, r, True)}, '{COMP}', -1), {c - 1})"
    return F.expr(_shown(_some(f"get(split({comp}, '{SUB}', -1), {s - 1})")))


def set_id() -> Column:
    """Field 1 as a number, 1 when it is none; a literal 0 stays 0."""
    return F.expr(_set_id())


# ---------------------------------------------------------------- composites


@dataclass(frozen=True)
class _Part:
    name: str
    component: int
    sub: int | None
    fallback: int | None
    is_date: bool


def _parts_of(kind: str) -> list[_Part]:
    parts = []
    for line in COMPOSITES[kind].strip().splitlines():
        name, at, *rest = line.split()
        comp, _, sub = at.partition(".")
        fallback = int(rest[rest.index("or") + 1]) if "or" in rest else None
        parts.append(_Part(name, int(comp), int(sub) if sub else None, fallback, "date" in rest))
    return parts


def _occurrence(sql: str) -> str:
    """One occurrence as an array of components, each with its whole text and its subcomponents."""
    subs = f"transform(split(c, '{SUB}', -1), s -> CASE WHEN s <> '' THEN {_shown('s', REP)} END)"
    pair = f"named_struct('whole', CASE WHEN c <> '' THEN {_shown('c', REP + SUB)} END, 'subs', {subs})"
    return f"transform(split({sql}, '{COMP}', -1), c -> {pair})"


def _struct_of(kind: str) -> str:
    """A composite out of an occurrence called ``o``."""

    def whole(n: int) -> str:
        return f"get(o, {n - 1}).whole"

    def sub(n: int, s: int) -> str:
        return f"get(get(o, {n - 1}).subs, {s - 1})"

    if kind == "eip":
        names = [p.name for p in _parts_of("ei")]

        def identifier(n: int) -> str:
            parts = ", ".join(f"'{name}', {sub(n, i + 1)}" for i, name in enumerate(names))
            return f"CASE WHEN {whole(n)} IS NOT NULL THEN named_struct({parts}) END"

        return (
            f"named_struct('placer_assigned_identifier', {identifier(1)}, 'filler_assigned_identifier', {identifier(2)})"
        )

    def one(part: _Part) -> str:
        value = whole(part.component) if part.sub is None else sub(part.component, part.sub)
        if part.fallback is not None:
            value = f"coalesce({value}, {whole(part.fallback)})"
        return _dtm(value) if part.is_date else value

    return "named_struct(" + ", ".join(f"'{p.name}', {one(p)}" for p in _parts_of(kind)) + ")"


def _names_of(kind: str) -> list[str]:
    if kind == "eip":
        return ["placer_assigned_identifier", "filler_assigned_identifier"]
    return [p.name for p in _parts_of(kind)]


def _composite(n: int, kind: str, first: bool = False) -> str:
    raw = _whole(n, 1 if first else None, decoded=True)
    structs = f"transform(transform(filter(array({raw}), r -> r IS NOT NULL), r -> {_occurrence('r')}), o -> {_struct_of(kind)})"
    # A coded value or designator that is present stays a struct even when every part is empty.
    if kind not in ("cwe", "hd"):
        some = " OR ".join(f"z.{name} IS NOT NULL" for name in _names_of(kind))
        structs = f"filter({structs}, z -> {some})"
    return f"get({structs}, 0)"


def composite(n: int, kind: str, first: bool = False) -> Column:
    """A composite field as a struct; null when the field is empty, or when all its parts are."""
    return F.expr(_composite(n, kind, first))


def _repeated(n: int, kind: str) -> str:
    found = f"filter(split({_raw(n)}, '{REP}', -1), r -> r <> '')"
    if kind == "s":
        values = f"transform({found}, r -> {_shown('r')})"
    elif kind == "id":
        values = f"filter(transform({found}, r -> {_shown(f'''get(split(r, '{COMP}', -1), 0)''')}), v -> v <> '')"
    elif kind == "dtm":
        values = f"filter(transform({found}, r -> {_dtm('r')}), v -> v IS NOT NULL)"
    else:
        values = f"transform(transform({found}, r -> {_occurrence('r')}), o -> {_struct_of(kind)})"
    return f"get(filter(array({values}), a -> size(a) > 0), 0)"


def repeated(n: int, kind: str) -> Column:
    """All repetitions of a field as an array: structs for composites, texts for ``s``, ``id`` and ``dtm``.

    Escapes stay as they are written here.
    """
    return F.expr(_repeated(n, kind))


# ---------------------------------------------------------------- rows


def no_line(line: Column) -> Column:
    """Blank lines and batch envelopes, which belong to no message."""
    return (F.trim(line) == "") | F.upper(F.substring(line, 1, 3)).isin(*ENVELOPE_SEGMENTS)


def opens_message(line: Column) -> Column:
    """Whether a line is a message's first."""
    return F.upper(F.substring(line, 1, 3)) == "MSH"


def messages(df: DataFrame, text: str = "text", into: str = "message") -> DataFrame:
    """One row per message of each text: batch envelopes are dropped, line ends become CR, text before the first
    MSH is no message. ``message_no`` counts from 0 within a text."""
    ends = F.replace(F.replace(F.col(text), F.lit("\r\n"), F.lit("\r")), F.lit("\n"), F.lit("\r"))
    lines = F.split(ends, "\r")
    kept = F.filter(lines, lambda line: ~no_line(line))
    pieces = F.split(F.array_join(kept, "\r"), r"\r(?=[Mm][Ss][Hh])")
    found = F.filter(pieces, opens_message)
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(found).alias("message_no", into))


def _cells(line: str) -> str:
    """Fields of a hidden line; in MSH the field separator itself is field 1, as the standard counts."""
    cut = f"transform(split({line}, '{FIELD}', -1), f -> CASE WHEN f <> '' THEN f END)"
    shifted = f"transform(array({cut}), p -> concat(slice(p, 1, 1), array('{FIELD}'), slice(p, 2, greatest(size(p), 1))))"
    return f"CASE WHEN segment_type = 'MSH' THEN get({shifted}, 0) ELSE {cut} END"


def segments(df: DataFrame, message: str = "message") -> DataFrame:
    """One row per segment of the messages that ``messages`` returns.

    Adds ``segment_type``, ``line_no``, ``raw_segment``, ``fields``, ``decoded``, the separators and the MSH metadata.
    """
    others = [c for c in df.columns if c != message]
    rows = df.select(*others, F.col(message), separators(F.col(message)).alias("seps"))
    seps = F.col("seps")
    # Lines are cut out as they stand, so that those of segments nobody asks for are not rewritten.
    lines = F.when(seps["field"] == "\r", F.array(message)).otherwise(F.split(message, "\r"))
    rows = rows.select(*others, "seps", lines.alias("__lines"))
    rows = rows.withColumn("__head", F.split(_hide(F.get("__lines", F.lit(0)), seps), FIELD, -1))
    carried = [F.expr(_shown(_some(f"get(__head, {at})"))).alias(name) for name, at in METADATA_PLACES.items()]
    rows = rows.select(*others, "seps", *carried, F.posexplode("__lines").alias("line_no", "__raw"))
    start = F.expr("CASE WHEN seps.field = '' THEN __raw ELSE substring_index(__raw, seps.field, 1) END")
    kind = F.upper(F.trim(F.substring_index(_hide(start, seps), FIELD, 1)))
    rows = rows.withColumn("__line", _hide(F.col("__raw"), seps))
    raw = F.expr(f"replace({_shown('__line')}, '{FIELD}', seps.field)")
    rows = rows.select("*", raw.alias("raw_segment"), kind.alias("segment_type")).filter("segment_type <> ''")
    rows = rows.withColumn("__decoded", unescape(F.col("__line"), F.col("seps")))
    cells = {"fields": F.expr(_cells("__line")), "decoded": F.expr(_cells("__decoded"))}
    return rows.withColumns(cells).drop("__raw", "__line", "__decoded")


def _column(at: str, kind: str) -> str:
    place, _, comp = at.partition(".")
    n = int(place)
    if kind.endswith("*"):
        return _repeated(n, kind[:-1])
    if comp:
        value = _component(n, int(comp))
        return _dtm(value) if kind == "dtm" else value
    simple = {
        "st": lambda: _shown(_raw(n)),
        "st1": lambda: _shown(_repetition(n, 1)),
        "int": lambda: _int(_shown(_raw(n))),
        "set": _set_id,
        "dtm": lambda: _dtm(_shown(_raw(n))),
        "dtm1": lambda: _dtm(_shown(_repetition(n, 1))),
    }
    return simple[kind]() if kind in simple else _composite(n, kind.removesuffix("1"), first=kind.endswith("1"))


def _packed(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Segment rows as they are sorted: fields as one text, and those with escapes decoded only where they differ.

    Arrays of mostly empty fields take many times the room of their text.
    """
    fields, decoded = [F.array_join(c, FIELD, "") for c in ("fields", "decoded")]
    rows = rows.select(*keep, *METADATA, "seps", "raw_segment", "line_no", fields.alias("fields"), decoded.alias("decoded"))
    return rows.withColumn("decoded", F.nullif("decoded", "fields"))


def _unpacked(name: str) -> str:
    text = "coalesce(decoded, fields)" if name == "decoded" else name
    return f"transform(split({text}, '{FIELD}', -1), f -> CASE WHEN f <> '' THEN f END)"


def segment_table(df: DataFrame, segment: str, fields: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed row per segment of a kind, with the message's metadata.

    ``df`` comes from ``segments``. ``fields`` is the table's field list in the notation of ``hl7_fields``; without
    one the built-in list is used, or the generic ``field_1`` … ``field_25``. A segment that can repeat and has no
    set id of its own is numbered within its message, told apart by the columns in ``keep``.
    """
    name = segment.upper()
    spec = fields if fields is not None else SEGMENTS.get(name)
    if spec is None:
        return generic_table(df, name, keep)
    rows = df.filter(F.col("segment_type") == name)
    columns = []
    for line in spec.strip().splitlines():
        at, kind, label = line.split()
        columns.append(f"{_column(at, kind)} AS {label}")
    labels = [line.split()[2] for line in spec.strip().splitlines()]
    if name not in SINGLE_SEGMENTS and "set_id" not in labels:
        if not keep:
            raise ValueError(f"{name} is numbered within its message: name the message's key columns in keep")
        # A window holds the segments of one message, which was one row before.
        order = Window.partitionBy(*keep).orderBy("line_no")
        rows = _packed(rows, keep).withColumn("set_id", F.row_number().over(order).cast("bigint"))
        rows = rows.withColumns({c: F.expr(_unpacked(c)) for c in ("decoded", "fields")})
        columns.append("set_id")
    return rows.selectExpr(*keep, *METADATA, *columns, "raw_segment")


def generic_table(df: DataFrame, segment: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Segments without a field list: ``field_1`` … ``field_25`` as they stand, and all fields in ``all_fields``."""
    rows = df.filter(F.col("segment_type") == segment.upper())
    numbered = [field(i).alias(f"field_{i}") for i in range(1, GENERIC_FIELDS + 1)]
    every = F.expr(f"transform(slice(decoded, 2, greatest(size(decoded) - 1, 0)), f -> {_shown('f')})").alias("all_fields")
    return rows.select(*keep, *METADATA, "segment_type", *numbered, every, "raw_segment")
