"""Ordered computations that stay distributed when one key holds a large share of the rows.

A window partitioned by key alone sends a hot key to one task. The helpers below take ``split``, a Column that
never decreases along the row order (an hour, a day, a block of sequence numbers). Rows are windowed per
``(key, split)``; only one edge row per block is windowed per key.

Rows are dealt out by ``(key, split)`` once, and both the windows and the edges are made from that one exchange. Rows go
through it as one struct each and edges are picked as whole rows: were single columns picked, the two plans would read
different columns of it and Spark would make it twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.session import settle

_GROUP, _BLOCK, _VALUE, _EDGE, _ROW = "__group", "__block", "__value", "__edge", "__row"
# monotonically_increasing_id keeps the partition number above this bit and the row number below it.
_ROW_BITS = 33


def block_of(df: DataFrame, column: str, width: str | int | None = None) -> Column:
    """A ``split`` for ``column``: whole hours or days for times, blocks of ``width`` values for numbers."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc(str(width or "day"), F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.trunc(column, str(width or "month"))
    if isinstance(kind, T.NumericType):
        return F.floor(F.col(column) / F.lit(int(width or 1_000_000)))
    return F.substring(F.col(column).cast("string"), 1, int(width or 10))


def _blocked(df: DataFrame, keys: Sequence[str], split: Column, value: Column) -> DataFrame:
    """Rows as structs, with their ``_VALUE`` inside, dealt out by group and block."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns], value.alias(_VALUE))
    return df.select(row.alias(_ROW), F.struct(*keys).alias(_GROUP), split.alias(_BLOCK)).repartition(_GROUP, _BLOCK)


def _at(order: Sequence[str]) -> Column:
    """Where a packed row stands."""
    return F.struct(*[F.col(_ROW)[c].alias(c) for c in order])


def _sorted(order: Sequence[str], backward: bool = False) -> list[Column]:
    return [F.col(_ROW)[c].desc() if backward else F.col(_ROW)[c].asc() for c in order]


def _joined(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows with what their block knows of the others. Blocks may be null, which is a block of its own."""
    blocks = blocks.withColumnsRenamed({_GROUP: "__g", _BLOCK: "__b"})
    same = F.col(_GROUP).eqNullSafe(F.col("__g")) & F.col(_BLOCK).eqNullSafe(F.col("__b"))
    return rows.join(blocks, same).drop("__g", "__b")


def _unpacked(rows: DataFrame, names: Sequence[str], *others: str) -> DataFrame:
    return rows.select(*[F.col(_ROW)[c].alias(c) for c in names], *others)


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    into: str,
    ahead: bool = False,
    split: Column | None = None,
) -> DataFrame:
    """Add ``into``: ``value`` (a struct, so never null) of the row before, or after, this one in its key."""
    step = F.lead if ahead else F.lag
    if split is None:
        return df.withColumn(into, step(value).over(Window.partitionBy(*keys).orderBy(*order)))
    rows = _blocked(df, keys, split, value)
    pick = F.min_by if ahead else F.max_by
    edges = rows.groupBy(_GROUP, _BLOCK).agg(pick(_ROW, _at(order)).alias(_EDGE))
    along = Window.partitionBy(_GROUP).orderBy(_BLOCK)
    edges = edges.select(_GROUP, _BLOCK, step(F.col(_EDGE)[_VALUE]).over(along).alias(_EDGE))
    inside = Window.partitionBy(_GROUP, _BLOCK).orderBy(*_sorted(order))
    found = _joined(rows, edges).withColumn(into, F.coalesce(step(F.col(_ROW)[_VALUE]).over(inside), F.col(_EDGE)))
    return _unpacked(found, df.columns, into)


def with_nearest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    into: str,
    ahead: bool = False,
    split: Column | None = None,
) -> DataFrame:
    """Add ``into``: the latest non-null ``value`` at or before this row (at or after it with ``ahead``)."""

    def sort_keys(names: Sequence[str]) -> list[Column]:
        return [F.col(n).desc() if ahead else F.col(n).asc() for n in names]

    def up_to_here(parts: Sequence[str], names: Sequence[str], last: int) -> Column:
        frame = Window.partitionBy(*parts).orderBy(*sort_keys(names))
        return frame.rowsBetween(Window.unboundedPreceding, last)

    if split is None:
        return df.withColumn(into, F.last(value, ignorenulls=True).over(up_to_here(keys, order, 0)))
    rows = _blocked(df, keys, split, value)
    pick = F.min_by if ahead else F.max_by
    edges = rows.groupBy(_GROUP, _BLOCK).agg(pick(_ROW, F.when(F.col(_ROW)[_VALUE].isNotNull(), _at(order))).alias(_EDGE))
    edges = edges.select(_GROUP, _BLOCK, F.col(_EDGE)[_VALUE].alias(_EDGE))
    carried = F.last(_EDGE, ignorenulls=True).over(up_to_here([_GROUP], [_BLOCK], -1))
    edges = edges.select(_GROUP, _BLOCK, carried.alias(_EDGE))
    frame = Window.partitionBy(_GROUP, _BLOCK).orderBy(*_sorted(order, ahead)).rowsBetween(Window.unboundedPreceding, 0)
    inside = F.last(F.col(_ROW)[_VALUE], ignorenulls=True).over(frame)
    return _unpacked(_joined(rows, edges).withColumn(into, F.coalesce(inside, F.col(_EDGE))), df.columns, into)


def with_bracket(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    before: str,
    after: str,
    split: Column,
) -> DataFrame:
    """Add the latest non-null ``value`` at or before this row and the first one at or after it, in one pass."""
    rows = _blocked(df, keys, split, value)
    known = F.when(F.col(_ROW)[_VALUE].isNotNull(), _at(order))
    blocks = rows.groupBy(_GROUP, _BLOCK).agg(F.min_by(_ROW, known).alias("__lo"), F.max_by(_ROW, known).alias("__hi"))
    blocks = blocks.select(_GROUP, _BLOCK, F.col("__lo")[_VALUE].alias("__lo"), F.col("__hi")[_VALUE].alias("__hi"))

    def latest(value: Column, parts: Sequence[str], sort: Sequence[Column], end: int) -> Column:
        frame = Window.partitionBy(*parts).orderBy(*sort).rowsBetween(Window.unboundedPreceding, end)
        return F.last(value, ignorenulls=True).over(frame)

    blocks = blocks.select(
        _GROUP,
        _BLOCK,
        latest(F.col("__hi"), [_GROUP], [F.col(_BLOCK).asc()], -1).alias("__earlier"),
        latest(F.col("__lo"), [_GROUP], [F.col(_BLOCK).desc()], -1).alias("__later"),
    )
    inside, here = [_GROUP, _BLOCK], F.col(_ROW)[_VALUE]
    found = (
        _joined(rows, blocks)
        .withColumn(before, F.coalesce(latest(here, inside, _sorted(order), 0), F.col("__earlier")))
        .withColumn(after, F.coalesce(latest(here, inside, _sorted(order, True), 0), F.col("__later")))
    )
    return _unpacked(found, df.columns, before, after)


def opening_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    opens: Callable[[Column, Column], Column],
    split: Column | None = None,
) -> DataFrame:
    """Rows that start a run of their key, where ``opens(previous value, value)`` holds.

    ``opens`` gets a null previous value for the first row of a key and must return true or false. Each row carries
    ``__next``, the opening row after it (its ``value`` and the ``before`` value that ends this run), null for the last
    run, and ``__final``, the value of the key's last row. Everything comes from one pass over the ordered rows; with
    ``split`` only one summary row per block takes part in the pass per key.
    """
    marked = df.withColumn(_VALUE, value)
    if split is None:
        along = Window.partitionBy(*keys).orderBy(*order)
        final = F.first(_VALUE).over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]))
        found = marked.withColumn("__prev", F.lag(_VALUE).over(along)).withColumn("__final", final)
        found = found.filter(opens(F.col("__prev"), F.col(_VALUE)))
        following = F.lead(F.struct(F.col(_VALUE).alias("value"), F.col("__prev").alias("before"))).over(along)
        return found.withColumn("__next", following).drop(_VALUE, "__prev")
    rows = _blocked(df, keys, split, value)
    inside, here = Window.partitionBy(_GROUP, _BLOCK).orderBy(*_sorted(order)), F.col(_ROW)[_VALUE]
    rows = rows.withColumn("__prev", F.lag(here).over(inside))
    opening = F.struct(here.alias("value"), F.col("__prev").alias("before"))
    opens_inside = F.col("__prev").isNotNull() & opens(F.col("__prev"), here)
    blocks = rows.groupBy(_GROUP, _BLOCK).agg(
        F.min_by(_ROW, _at(order)).alias("__lo"),
        F.max_by(_ROW, _at(order)).alias("__hi"),
        F.min_by(opening, F.when(opens_inside, _at(order))).alias("__inner"),
    )
    blocks = blocks.withColumns({"__lo": F.col("__lo")[_VALUE], "__hi": F.col("__hi")[_VALUE]})
    forward = Window.partitionBy(_GROUP).orderBy(_BLOCK)
    backward = Window.partitionBy(_GROUP).orderBy(F.col(_BLOCK).desc())
    later = backward.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.lag("__hi").over(forward))
    first = F.struct(F.col("__lo").alias("value"), F.col("__before").alias("before"))
    blocks = blocks.withColumn("__head", F.when(opens(F.col("__before"), F.col("__lo")), first).otherwise(F.col("__inner")))
    blocks = blocks.select(
        _GROUP,
        _BLOCK,
        "__before",
        F.last("__head", ignorenulls=True).over(later).alias("__later"),
        F.first("__hi").over(backward).alias("__final"),
    )
    found = _joined(rows, blocks).withColumn("__prev", F.coalesce("__prev", "__before"))
    found = found.filter(opens(F.col("__prev"), here))
    following = F.coalesce(F.lead(opening).over(inside), F.col("__later"))
    return _unpacked(found.withColumn("__next", following), df.columns, "__final", "__next")


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in global order with their slot (partition number and row number) fixed on shared storage.

    The slot must not change between the two passes that use it, so it is checkpointed, not recomputed.
    """
    return settle(df.orderBy(*order).withColumn("__slot", F.monotonically_increasing_id())).withColumn(
        "__part", F.shiftright("__slot", _ROW_BITS)
    )


def _before_part(per_part: DataFrame, amount: str) -> DataFrame:
    """Total of ``amount`` in all earlier partitions; one row per partition goes in, so one task is enough."""
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("__part", F.coalesce(F.sum(amount).over(earlier), F.lit(0)).alias("__before"))


def with_ordinal(df: DataFrame, order: Sequence[str | Column], into: str, start: int = 1) -> DataFrame:
    """Number all rows along a total order without moving them into one task."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = _placed(df, columns)
    before = _before_part(placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")), "__n")
    row_number = F.col("__slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per partition, whatever the table size: safe to broadcast.
    return (
        placed.join(F.broadcast(before), "__part")
        .withColumn(into, row_number + F.col("__before") + F.lit(start))
        .drop("__slot", "__part", "__before")
    )


def with_running_total(df: DataFrame, order: Sequence[str], amount: str, into: str) -> DataFrame:
    """Running total of ``amount`` along a total order, this row included, without one global window."""
    placed = _placed(df, [F.col(c) for c in order])
    before = _before_part(placed.groupBy("__part").agg(F.sum(amount).alias("__sum")), "__sum")
    inside = Window.partitionBy("__part").orderBy("__slot").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("__here", F.sum(amount).over(inside))
        .join(F.broadcast(before), "__part")
        .withColumn(into, F.col("__here") + F.col("__before"))
        .drop("__slot", "__part", "__here", "__before")
    )


def leading_groups(df: DataFrame, group: str, cap: int) -> DataFrame:
    """The first groups in group order that start before ``cap`` rows are reached, with running counts.

    Each group holds at least one row, so the first ``cap`` groups always contain the answer; the single-task
    window below never sees more than ``cap`` pre-aggregated rows.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("rows")).orderBy(group).limit(cap)
    running = F.sum("rows").over(Window.orderBy(group).rowsBetween(Window.unboundedPreceding, 0))
    return (
        counts.withColumn("rows_through", running)
        .withColumn("rows_before", F.col("rows_through") - F.col("rows"))
        .filter(F.col("rows_before") < cap)
    )
