"""Applying change feeds and snapshots: slowly changing dimensions, deletes, tombstones."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.operators.ordering import opening_rows

DELETED = "_deleted"
START, END = "__START_AT", "__END_AT"


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """64-bit hash of the named columns (all by default); maps go in as sorted entries."""
    names = sorted(columns if columns is not None else df.columns)
    parts = []
    for name in names:
        if isinstance(df.schema[name].dataType, T.MapType):
            parts.append(F.array_sort(F.map_entries(name)))
        else:
            parts.append(F.col(name))
    # Null flags go in first: the hash itself skips nulls, and (null, 1) must differ from (1, null).
    return F.xxhash64(*[F.col(n).isNull() for n in names], *parts)


def _with_deletes(feed: DataFrame, deletes: DataFrame | None) -> DataFrame:
    marked = feed if DELETED in feed.columns else feed.withColumn(DELETED, F.lit(False))
    if deletes is None:
        return marked
    return marked.unionByName(deletes.withColumn(DELETED, F.lit(True)), allowMissingColumns=True)


def _newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key. Spark turns ``row_number() = 1`` into a per-task group limit before the shuffle, so a hot
    key leaves each task as a single row."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")


def _tie_order(df: DataFrame, tiebreak: Sequence[str]) -> list[Column]:
    if tiebreak:
        return [F.col(c).desc_nulls_last() for c in tiebreak]
    return [row_hash(df, [c for c in df.columns if c != DELETED]).desc()]


def scd1(
    feed: DataFrame,
    keys: Sequence[str],
    seq: str,
    deletes: DataFrame | None = None,
    tiebreak: Sequence[str] = (),
    keep_deleted: bool = False,
) -> DataFrame:
    """Current row per key: the greatest ``seq`` wins, a delete wins a tie, late rows lose."""
    merged = _with_deletes(feed, deletes)
    order = [F.col(seq).desc_nulls_last(), F.col(DELETED).desc(), *_tie_order(merged, tiebreak)]
    current = _newest(merged, keys, order)
    return current if keep_deleted else current.filter(~F.col(DELETED)).drop(DELETED)


def scd2(
    feed: DataFrame,
    keys: Sequence[str],
    seq: str,
    track: Sequence[str] | None = None,
    deletes: DataFrame | None = None,
    tiebreak: Sequence[str] = (),
    split: Column | None = None,
) -> DataFrame:
    """Row history with ``__START_AT`` and ``__END_AT``.

    Rows that repeat the tracked columns of the version before them open nothing; deletes only close. ``split``
    spreads the versions of one key over several tasks (see ``ordering``).
    """
    merged = _with_deletes(feed, deletes)
    order = [F.col(DELETED).desc(), *_tie_order(merged, tiebreak)]
    versions = _newest(merged, [*keys, seq], order)
    tracked = track or [c for c in feed.columns if c not in {*keys, seq, DELETED}]
    state = F.struct(F.col(seq).alias("at"), F.col(DELETED).alias("gone"), row_hash(merged, tracked).alias("digest"))

    def opens(was: Column, now: Column) -> Column:
        # A delete counts only when something is there to close.
        changed = was.isNull() | was["gone"] | (was["digest"] != now["digest"])
        return F.when(now["gone"], F.coalesce(~was["gone"], F.lit(False))).otherwise(changed)

    changes = opening_rows(versions, keys, [seq], state, opens, split)
    return (
        changes.filter(~F.col(DELETED))
        .withColumn(START, F.col(seq))
        .withColumn(END, F.col("__next.value.at"))
        .drop("__next", "__final", DELETED)
    )


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both snapshots as a change feed: ``_change`` is insert, update, delete or unchanged.

    Value columns come from ``after``, or from ``before`` for deletes. Nulls compare as equal.
    """
    values = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("__old"))
    new = after.select(*keys, F.struct(*values).alias("__new"))
    change = (
        F.when(F.col("__old").isNull(), "insert")
        .when(F.col("__new").isNull(), "delete")
        .when(F.col("__old").eqNullSafe(F.col("__new")), "unchanged")
        .otherwise("update")
    )
    chosen = F.coalesce("__new", "__old")
    return old.join(new, list(keys), "full_outer").select(
        *keys, *[chosen[c].alias(c) for c in values], change.alias("_change")
    )


def apply_snapshot(target: DataFrame, snap: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after a full snapshot: keys that left are gone, ``_change`` says what each kept row went through."""
    return snapshot_diff(target, snap, keys).filter("_change <> 'delete'")


def apply_snapshots_scd2(snapshots: Sequence[tuple[object, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """History from snapshots in order: a missing key closes its row, a changed key closes and opens.

    A key has at most one row per snapshot, so a window per key holds at most ``len(snapshots)`` rows.
    """
    labels = [label for label, _ in snapshots]
    stacked = None
    for place, (_, snap) in enumerate(snapshots):
        rows = snap.withColumn("__place", F.lit(place))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    values = [c for c in stacked.columns if c not in {*keys, "__place"}]
    along = Window.partitionBy(*keys).orderBy("__place")
    hashed = stacked.withColumn("__digest", row_hash(stacked, values))
    opens = F.coalesce(
        (F.lag("__place").over(along) != F.col("__place") - 1) | (F.lag("__digest").over(along) != F.col("__digest")),
        F.lit(True),
    )
    runs = hashed.withColumn("__opens", opens).withColumn("__run", F.sum(F.col("__opens").cast("int")).over(along))
    merged = runs.groupBy(*keys, "__run").agg(
        F.min_by(F.struct(*values), "__place").alias("__row"),
        F.min("__place").alias("__first"),
        F.max("__place").alias("__last"),
    )
    label_of = F.array(*[F.lit(v) for v in labels])
    return merged.select(
        *keys,
        *[F.col("__row")[c].alias(c) for c in values],
        F.get(label_of, F.col("__first")).alias(START),
        F.get(label_of, F.col("__last") + 1).alias(END),
    )


def extend_history(history: DataFrame, snap: DataFrame, keys: Sequence[str], version: object) -> DataFrame:
    """One more snapshot on an existing history: open rows that left or changed close, new and changed rows open."""
    values = [c for c in snap.columns if c not in keys]
    kind = history.schema[START].dataType
    now = F.lit(version).cast(kind)
    closed = history.filter(F.col(END).isNotNull())
    opened = history.filter(F.col(END).isNull()).select(*keys, F.struct(*values).alias("__old"), F.col(START).alias("__since"))
    both = opened.join(snap.select(*keys, F.struct(*values).alias("__new")), list(keys), "full_outer")
    same = F.col("__old").eqNullSafe(F.col("__new"))
    old = F.when(F.col("__old").isNotNull(), F.struct("__old.*", F.col("__since").alias(START), F.when(~same, now).alias(END)))
    new = F.when(F.col("__new").isNotNull() & ~same, F.struct("__new.*", now.alias(START), F.lit(None).cast(kind).alias(END)))
    rows = both.select(*keys, F.inline(F.array_compact(F.array(old, new))))
    return closed.unionByName(rows)


def require_tombstone_keys(feed: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Fail the job when a tombstone lacks a key: it would delete nothing and hide a lost delete."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    problem = F.concat(F.lit("tombstone without key: "), F.to_json(F.struct(*[F.col(c) for c in feed.columns])))
    checked = F.when(F.coalesce(F.col(flag), F.lit(False)) & missing, F.raise_error(problem).cast("boolean"))
    return feed.withColumn(flag, checked.otherwise(F.col(flag)))


def apply_tombstones(
    feed: DataFrame,
    keys: Sequence[str],
    seq: str,
    flag: str,
    show_deleted: bool = False,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Current row per key of a feed whose rows carry their own deletion flag."""
    checked = require_tombstone_keys(feed, keys, flag)
    marked = checked.withColumn(DELETED, F.coalesce(F.col(flag).cast("boolean"), F.lit(False)))
    current = scd1(marked, keys, seq, tiebreak=tiebreak, keep_deleted=True)
    return current.drop(DELETED) if show_deleted else current.filter(~F.col(DELETED)).drop(DELETED)


def archived_as_delete(df: DataFrame, archived_at: str, cursor: str) -> DataFrame:
    """Archived rows as a delete feed: the archive time becomes the cursor, so it sequences with updates."""
    return df.filter(F.col(archived_at).isNotNull()).withColumn(cursor, F.col(archived_at))


def distinct_deletes(history: DataFrame, level: str = "messages") -> DataFrame:
    """First deletion per message, or per thread.

    ``history`` has ``history_id``, ``position`` (order of the records) and ``deleted``, an array of
    ``{id, thread_id}``. Entries without an id are skipped.
    """
    each = history.select("history_id", "position", F.posexplode("deleted").alias("place", "entry"))
    each = each.filter(F.col("entry.id").isNotNull())
    entity = "entry.id" if level == "messages" else "entry.thread_id"
    first = each.filter(F.col(entity).isNotNull()).groupBy(F.col(entity).alias("id")).agg(
        F.min_by(F.struct("history_id", "entry.thread_id"), F.struct("position", "place")).alias("first")
    )
    extra = [F.col("first.thread_id").alias("thread_id")] if level == "messages" else []
    return first.select("id", *extra, F.col("first.history_id").alias("history_id"))


def cluster_columns(value: object) -> list[str] | None:
    """Cluster columns from a list, a JSON list, a comma list or a single name; blank means none."""
    if value is None:
        return None
    if isinstance(value, (list, tuple)):
        return [str(v) for v in value]
    text = str(value).strip()
    if text.startswith("["):
        return [str(v) for v in json.loads(text)]
    names = [part.strip() for part in text.split(",") if part.strip()]
    return names or None
