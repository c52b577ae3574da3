"""Reshaping records: flattening, exploding, lineage columns, padding, properties, hierarchies."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.functions import nested
from feedweir.operators.ordering import with_ordinal
from feedweir.session import stored

# ---------------------------------------------------------------- columns


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the named columns; unknown names are an error that lists them and what there is."""
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns {', '.join(unknown)}; available: {', '.join(sorted(df.columns))}")
    return df.select(*names)


def with_lineage(df: DataFrame, ingested_as: str | None = None, **constants: object) -> DataFrame:
    """Constant columns that say where rows come from, and optionally when they were read."""
    added = df.withColumns({name: F.lit(value) for name, value in constants.items()})
    return added.withColumn(ingested_as, F.current_timestamp()) if ingested_as else added


def pad_columns(df: DataFrame, schema: T.StructType, never: Sequence[str] = ()) -> DataFrame:
    """Columns of ``schema`` that are missing come in as null; a missing key is an error."""
    lost = [k for k in never if k not in df.columns]
    if lost:
        raise ValueError(f"key columns missing from the input: {', '.join(lost)}")
    absent = [f for f in schema.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}).select(
        *[f.name for f in schema.fields], *[c for c in df.columns if c not in schema.names]
    )


def drop_control_keys(df: DataFrame, pattern: str = r"^(@|__)|@odata\.|^odata\.") -> DataFrame:
    """Without the columns, and the keys of map columns, that only steer the protocol.

    Deferred links (a struct whose only field is ``__deferred``) go as well.
    """
    kept = []
    for field in df.schema.fields:
        kind = field.dataType
        deferred = isinstance(kind, T.StructType) and kind.names == ["__deferred"]
        if re.search(pattern, field.name) or deferred:
            continue
        c = F.col(f"`{field.name}`")
        if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            c = F.map_filter(c, lambda k, _: ~k.rlike(pattern))
        kept.append(c.alias(field.name))
    return df.select(*kept)


def hoist(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """New top-level columns from nested paths or expressions (a URL put together from parts, say)."""
    return df.withColumns({n: F.expr(e) if isinstance(e, str) else e for n, e in columns.items()})


def empty_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty texts, maps and structs as null, in all columns or the named ones."""
    chosen = set(columns or df.columns)
    return df.select(
        *[
            nested.null_if_empty(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if f.name in chosen else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def nested_to_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Struct, array and map columns as JSON text: all of them, or the named ones."""
    out = []
    for f in df.schema.fields:
        wanted = nested.is_nested(f.dataType) and (columns is None or f.name in columns)
        c = F.col(f"`{f.name}`")
        out.append(F.to_json(c, {"ignoreNullFields": "false"}).alias(f.name) if wanted else c)
    return df.select(*out)


def _leaves(kind: T.StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
    found = []
    for field in kind.fields:
        here = (*path, field.name)
        found += _leaves(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
    return found


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every struct leaf as a column named after its path; arrays and maps stay whole."""
    return df.select(
        *[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in _leaves(df.schema, ())]
    )


def columns_by_kind(
    df: DataFrame, kind: Column, specs: Mapping[str, Mapping[str, Column]]
) -> DataFrame:
    """Columns that exist only for rows whose kind contains a given text."""
    merged: dict[str, Column] = {}
    for fragment, columns in specs.items():
        for name, value in columns.items():
            here = F.when(kind.contains(fragment), value)
            merged[name] = F.coalesce(merged[name], here) if name in merged else here
    return df.withColumns(merged)


# ---------------------------------------------------------------- children


def explode_child(df: DataFrame, array: str, parent_columns: Sequence[str | Column], outer: bool = False) -> DataFrame:
    """One row per array element with the named parent columns copied onto it."""
    step = F.explode_outer if outer else F.explode
    rows = df.select(*parent_columns, step(array).alias("__child"))
    return rows.select(*[c for c in rows.columns if c != "__child"], "__child.*")


def fill_from_parent(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Missing child values taken from the parent: ``{child column: parent column}``."""
    return df.withColumns({child: F.coalesce(F.col(child), F.col(parent)) for child, parent in columns.items()})


def explode_where(
    df: DataFrame, array: str, test: Callable[[Column], Column], parent_columns: Sequence[str]
) -> DataFrame:
    """One row per element that passes; child fields replace parent columns of the same name."""
    fields = df.schema[array].dataType.elementType.names
    kept = [c for c in parent_columns if c not in fields]
    return df.select(*kept, F.inline(F.filter(array, test)))


def ancestor_names(
    path: Sequence[str], keys: Mapping[str, Sequence[str]], taken: Sequence[str], exclude: Sequence[str] = ()
) -> dict[tuple[str, str], str]:
    """Column names for ancestor keys: ``<level>_<key>``, with ``_`` in front until it is free; ``*`` excludes all."""
    used, names = set(taken), {}
    for level in path[:-1]:
        for key in keys.get(level, ()):
            name = f"{level}_{key}"
            while name in used:
                name = "_" + name
            used.add(name)
            names[(level, key)] = name
    if "*" in exclude:
        return {}
    return {at: name for at, name in names.items() if name not in exclude}


def level_filters(path: Sequence[str], filters: Mapping[str | int, Column]) -> dict[int, Column]:
    """Filters per level, given by name or place; a place wins over a name, an unknown level is an error."""
    resolved: dict[int, Column] = {}
    for at, cond in filters.items():
        if isinstance(at, str):
            if at not in path:
                raise ValueError(f"unknown level {at}; levels are {', '.join(path)}")
            resolved.setdefault(list(path).index(at), cond)
    for at, cond in filters.items():
        if isinstance(at, int):
            if not 0 <= at < len(path):
                raise ValueError(f"level {at} is out of range; there are {len(path)} levels")
            resolved[at] = cond
    return resolved


def explode_path(
    df: DataFrame,
    path: Sequence[str],
    keys: Mapping[str, Sequence[str]],
    filters: Mapping[str | int, Column] | None = None,
    cursor: tuple[str, str] | None = None,
    exclude: Sequence[str] = (),
) -> DataFrame:
    """Walk nested collections from the top rows (``path[0]``) down to ``path[-1]``.

    ``keys`` names the key fields of each level; they are stamped on the leaf rows. A filter for a level is applied
    right after that level is exploded, before the next one multiplies rows. ``cursor`` is ``(level, field)`` of an
    ancestor cursor to stamp as ``_parent_cursor``.
    """
    conditions = level_filters(path, filters or {})
    kind: T.DataType = df.schema
    for level in path[1:]:
        kind = kind[level].dataType.elementType
    leaf_fields = [f.name for f in kind.fields]
    names = ancestor_names(path, keys, leaf_fields, exclude)
    rows = df.filter(conditions[0]) if 0 in conditions else df
    rows = rows.select(F.struct("*").alias("__row"))
    carried: list[str] = []
    for depth, level in enumerate(path):
        if depth:
            rows = rows.select(*carried, F.explode(F.col("__row")[level]).alias("__row"))
            if depth in conditions:
                inner = rows.select(*carried, "__row", "__row.*").filter(conditions[depth])
                rows = inner.select(*carried, "__row")
        if depth < len(path) - 1:
            stamped = {names[(level, k)]: F.col("__row")[k] for k in keys.get(level, ()) if (level, k) in names}
            if cursor and cursor[0] == level:
                stamped["_parent_cursor"] = F.col("__row")[cursor[1]]
            rows = rows.withColumns(stamped)
            carried += list(stamped)
    return rows.select(*carried, "__row.*")


def require_ancestor_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail when a child row lacks an ancestor key: it could never be merged."""

    def checked(name: str) -> Column:
        return F.when(F.col(name).isNull(), F.raise_error(F.lit(f"null ancestor key {name}")).cast(df.schema[name].dataType))

    return df.withColumns({n: checked(n).otherwise(F.col(n)) for n in columns})


def links_to_rows(df: DataFrame, entity: Column, key: Column, links: str) -> DataFrame:
    """A map of links as rows ``entity, id, rel, href``; links without a target are dropped."""
    rows = df.select(entity.alias("entity"), key.alias("id"), F.explode(F.map_entries(links)).alias("link"))
    return rows.select("entity", "id", F.col("link.key").alias("rel"), F.col("link.value").alias("href")).filter(
        "href IS NOT NULL"
    )


def junction(df: DataFrame, parent: Column, child: Column, module: str) -> DataFrame:
    """Junction rows of a parent/child pair: ``id`` is both ids joined by ``_``."""
    return df.select(
        F.concat_ws("_", parent.cast("string"), child.cast("string")).alias("id"),
        parent.alias("parent_id"),
        child.alias("child_id"),
        F.lit(module).alias("module"),
    )


def with_position(df: DataFrame, order_by: Sequence[str | Column], into: str = "position", start: int = 0) -> DataFrame:
    """Result position as a column, counted along a total order over all rows."""
    return with_ordinal(df, order_by, into, start)


# ---------------------------------------------------------------- matrices and properties


def series_to_rows(
    df: DataFrame, x: str, series: str, labels: str, default: str = "Totals", keep: Sequence[str] = ()
) -> DataFrame:
    """A series matrix as rows ``x, value, label``: short series and missing labels are tolerated."""
    each = df.select(*keep, x, labels, F.posexplode(series).alias("__s", "__values"))
    cells = F.arrays_zip(F.slice(F.col(x), 1, F.size("__values")).alias("x"), F.col("__values").alias("v"))
    label = F.coalesce(F.get(labels, F.col("__s")), F.lit(default))
    rows = each.select(*keep, label.alias("label"), F.posexplode(cells).alias("__at", "__cell"), F.size(x).alias("__n"))
    return rows.filter("__at < __n").select(*keep, F.col("__cell.x").alias("x"), F.col("__cell.v").alias("value"), "label")


def header_values_to_columns(
    df: DataFrame, headers: Sequence[str], values: str, types: Mapping[str, str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Parallel header and value arrays as named, typed columns; a bad or missing value is null."""
    types = types or {}
    return df.select(
        *keep,
        *[F.get(values, F.lit(i)).try_cast(types.get(name, "string")).alias(name) for i, name in enumerate(headers)],
    )


def split_properties(
    df: DataFrame, properties: str, standard: Sequence[str], lift: Mapping[str, str] | None = None
) -> DataFrame:
    """A property map split into ``standard_properties`` and ``custom_properties``; ``lift`` copies keys to columns."""
    known = F.col(properties)
    lifted = {column: F.try_element_at(known, F.lit(key)) for column, key in (lift or {}).items()}
    return df.withColumns(
        {
            **lifted,
            "standard_properties": F.map_filter(known, lambda k, _: k.isin(*standard)),
            "custom_properties": F.map_filter(known, lambda k, _: ~k.isin(*standard)),
        }
    ).drop(properties)


# ---------------------------------------------------------------- grids


def grid_to_table(df: DataFrame, values: str, place: str, names: Sequence[str] | None) -> DataFrame:
    """Spreadsheet rows as a table.

    ``place`` is the 1-based row number. With ``names`` the first row is the header: rows start at 2 and short ones
    are padded with empty text. Without, every row keeps its values as an array.
    """
    index = F.col(place).cast("string").alias("row_index")
    texts = F.transform(values, lambda v: F.coalesce(v.cast("string"), F.lit("")))
    if names is None:
        return df.select(index, texts.alias("values"))
    cells = [F.coalesce(F.get(texts, F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(names)]
    return df.filter(F.col(place) > 1).select(index, *cells)


def grid_names(df: DataFrame, values: str, place: str) -> list[str]:
    """Column names out of the first row, the only one that is collected."""
    from feedweir.functions.scalars import safe_name

    headers = F.transform(values, lambda v, i: safe_name(v.cast("string"), i))
    first = df.filter(F.col(place) == 1).select(headers.alias("names")).first()
    return list(first["names"]) if first else []


# ---------------------------------------------------------------- hierarchy


ROOTED, ORPHAN, BELOW, CYCLE = "rooted", "missing parent", "below a cycle", "cycle"
# More nodes than these are made fewer before the rest is climbed by doubling.
FEW_NODES = 250_000


def _first_steps(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Nodes one step up: ``up`` is the ancestor reached so far, null once the way has ended, and ``steps`` how far away
    it is. ``state`` says where the way ended; ``many`` and ``up_many`` whether several rows share the key.
    """
    nodes = df.select(F.col(key).alias("key"), F.col(parent).alias("parent"))
    held = stored(nodes.filter("key IS NOT NULL").groupBy(F.col("key").alias("__key")).agg((F.count("*") > 1).alias("__many")))
    nodes = nodes.join(held, F.col("parent") == F.col("__key"), "left")
    nodes = nodes.withColumnsRenamed({"__key": "up", "__many": "up_many"})
    repeated = held.filter("__many")
    if repeated.isEmpty():
        nodes = nodes.withColumn("many", F.lit(False))
    else:
        nodes = nodes.join(repeated, F.col("key") == F.col("__key"), "left").drop("__key").withColumnRenamed("__many", "many")
    steps = F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint")
    state = F.when(F.col("parent").isNull(), ROOTED).when(F.col("up").isNull(), ORPHAN)
    many, up_many = [F.coalesce(c, F.lit(False)).alias(c) for c in ("many", "up_many")]
    return stored(_closed(nodes.select("key", "parent", "up", steps.alias("steps"), state.alias("state"), many, up_many)))


def _closed(climb: DataFrame) -> DataFrame:
    """A node that has come back to itself has ended its way: it stands for its cycle."""
    back = (F.col("up") == F.col("key")) & ~F.col("many")
    return climb.withColumn("state", F.when(back, CYCLE).otherwise(F.col("state"))).withColumn("up", F.when(~F.coalesce(back, F.lit(False)), F.col("up")))


def _beyond(climb: DataFrame, above: DataFrame, how: str) -> DataFrame:
    """Nodes that have gone on to where the node they stood on stands; with ``how`` left, those that found it."""
    names = ("key", "up", "steps", "state", "up_many")
    above = above.select(*[F.col(c).alias(f"__{c}") for c in names])
    found = F.col("__key").isNotNull()
    state = F.when(F.col("__state") == CYCLE, BELOW).otherwise(F.col("__state"))
    moved = {
        "up": F.when(found, F.col("__up")).otherwise(F.col("up")),
        "steps": F.col("steps") + F.coalesce("__steps", F.lit(0)),
        "state": F.when(found, state).otherwise(F.col("state")),
        "up_many": F.coalesce("__up_many", "up_many"),
    }
    return climb.join(above, F.col("up") == F.col("__key"), how).withColumns(moved).select(*climb.columns)


def _without_leaves(climb: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes that others stand on, and the others."""
    stood_on = climb.filter("up IS NOT NULL").select(F.col("up").alias("__on")).distinct()
    marked = stored(climb.join(stood_on, F.col("key") == F.col("__on"), "left").withColumn("__on", F.col("__on").isNotNull()))
    return marked.filter("__on").drop("__on"), marked.filter("NOT __on").drop("__on")


def _heads(node: str, turn: int) -> Column:
    return F.xxhash64(F.col(node), F.lit(turn)).bitwiseAND(1) == 1


def _thinned(climb: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """The nodes without one in four, and those. Every key has a coin, which who stands on it knows as well.

    A node leaves on tails if the one it stands on has heads, and so stays; who stood on it takes over its way. Nodes
    that share their key stay, as they have several ways.
    """
    leaves = ~F.col("many") & ~_heads("key", turn) & (F.col("up").isNull() | F.col("up_many") | _heads("up", turn))
    left, stays = climb.filter(leaves), climb.filter(~leaves)
    asks = F.col("up").isNotNull() & ~F.col("up_many") & ~_heads("up", turn)
    moved = _closed(_beyond(stays.filter(asks), left, "left"))
    return stored(stays.filter(~asks).unionByName(moved)), left


def _doubled(climb: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All ways climbed to their ends, and the nodes on cycles.

    Each round doubles the distance every node has climbed, so depth d takes log2(d) joins. While a node is on its way
    to a root, every round ends the way of some node; so once a round ends none, all that still climb do so on cycles.
    And once the nodes that they stand on do not get fewer either, those are the cycles.
    """
    on_the_way, standing = None, None
    while True:
        counts = climb.agg(F.count("up").alias("open"), F.count_distinct("up").alias("standing")).first()
        if not counts["open"] or (counts["open"], counts["standing"]) == (on_the_way, standing):
            break
        on_the_way, standing = counts["open"], counts["standing"]
        moved = _beyond(climb.filter("up IS NOT NULL"), climb, "inner")
        climb = stored(climb.filter("up IS NULL").unionByName(moved))
    on_cycle = climb.filter("up IS NOT NULL").select("up").union(climb.filter(F.col("state") == CYCLE).select("key"))
    return climb.withColumn("state", F.coalesce("state", F.lit(BELOW))), on_cycle.distinct().toDF("__on")


def hierarchy_states(df: DataFrame, key: str, parent: str, few: int = FEW_NODES) -> DataFrame:
    """``key, parent, depth, state`` of every node: below a root (a node without parent), a missing parent or a cycle.

    ``depth`` is null unless the state is ``rooted``. Round by round nodes leave, the leaves where they are the most and
    else one in four, until ``few`` are left, and those climb by doubling. Then the others look up, last first, the
    node on which they stood when they left. So all rounds together join some multiple of the nodes, however deep they
    are. Every round is written to the checkpoint folder.
    """
    climb, rounds, cycles = _first_steps(df, key, parent), [], 0

    def counted(nodes: DataFrame) -> Row:
        back = F.count_if(F.col("state") == CYCLE)
        return nodes.agg(F.count("*").alias("n"), F.approx_count_distinct("up").alias("standing"), back.alias("cycles")).first()

    now = counted(climb)
    while now["n"] > few:
        turn = None if 2 * now["standing"] < now["n"] else len(rounds)
        fewer, left = _without_leaves(climb) if turn is None else _thinned(climb, turn)
        then = counted(fewer)
        if then["n"] > 0.95 * now["n"]:  # most share their keys
            break
        rounds.append((climb, left, turn))
        cycles += now["cycles"]
        climb, now = fewer, then
    first, on_cycle = _doubled(climb)
    names = ("key", "parent", "steps", "state", "many")
    ended, on_cycle = [stored(first.select(*names))], stored(on_cycle)
    cycles += on_cycle.count()
    for climb, left, turn in reversed(rounds):
        known = reduce(DataFrame.unionByName, ended)
        known = known if turn is None else known.filter(F.col("many") | _heads("key", turn))
        known = known.select(*[F.col(c).alias(f"__{c}") for c in ("key", "steps", "state")])
        state = F.when(F.col("__state") == CYCLE, BELOW).otherwise(F.col("__state")).alias("state")
        late = left.filter("up IS NOT NULL").join(known, F.col("up") == F.col("__key"))
        late = late.select("key", "parent", (F.col("steps") + F.col("__steps")).alias("steps"), state, "many")
        ended.append(stored(left.filter("up IS NULL").select(*names).unionByName(late)))
        if cycles:
            # Who left a cycle left it to a node that stayed on it.
            passed = climb.join(on_cycle, F.col("key") == F.col("__on")).filter("up IS NOT NULL").select("up")
            own = climb.filter(F.col("state") == CYCLE).select("key")
            on_cycle = stored(on_cycle.union(passed).union(own).distinct())
    nodes = reduce(DataFrame.unionByName, ended)
    stuck = F.col("state").isin(BELOW, CYCLE)
    fine = nodes.filter(~stuck).select("key", "parent", F.when(F.col("state") == ROOTED, F.col("steps")).alias("depth"), "state")
    state = F.when(F.col("__on").isNotNull(), CYCLE).otherwise(BELOW).alias("state")
    caught = nodes.filter(stuck).join(on_cycle, F.col("key") == F.col("__on"), "left")
    caught = caught.select("key", "parent", F.lit(None).cast("bigint").alias("depth"), state)
    return fine.unionByName(caught).withColumnsRenamed({"key": key, "parent": parent})


def hierarchy(df: DataFrame, key: str, parent: str) -> DataFrame:
    """``key, parent, depth`` of every node that hangs below a root, however deep; ``hierarchy_states`` has the others."""
    return hierarchy_states(df, key, parent).filter(F.col("state") == ROOTED).drop("state")
