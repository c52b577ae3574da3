"""Best-fit packing of token sequences into bins of several permitted lengths.

A piece goes into the open bin that it leaves least room in. If it fits in none, a bin of the size that costs least
per token is opened; at the end every bin shrinks to the smallest permitted length that holds its contents. Which sizes
may be opened is chosen by trying every range of them and taking the plan of least cost.

Pieces of equal length are alike, so the plan is made on the counts per length: a run of equal bins is filled by a run
of equal pieces in one step. The plan depends on the permitted lengths, not on the number of documents; the pieces then
find their bins by their number among the pieces of their length. Rows that come in an order, such as a mix, are packed
range by range: each range has a plan and bins of its own, numbered after those of the ranges before it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweir.llm.common import free_name, settle
from feedweir.llm.ranking import running

# Permitted lengths, and the cost of a bin: a fixed part, its tokens, and attention, which is quadratic in its length.
SIZES = (512, 1024, 2048, 4096)
FIXED_COST = 32
ATTENTION_SPAN = 16384
# Ranges whose bins are numbered in one task.
RANGES = 1024


def cost(size: int) -> float:
    """What a bin of ``size`` costs."""
    return FIXED_COST + size + size * size / ATTENTION_SPAN


@dataclass(frozen=True)
class Step:
    """Pieces ``first`` to ``last`` of a length go into the bins from ``bin`` on, one each, at ``offset``."""

    length: int
    first: int
    last: int
    bin: int
    offset: int


@dataclass
class Bins:
    """A run of equal bins with consecutive numbers."""

    first: int
    count: int
    size: int
    used: int


@dataclass
class Plan:
    steps: list[Step] = field(default_factory=list)
    bins: list[Bins] = field(default_factory=list)
    cost: float = 0.0


def plan_with(counts: dict[int, int], sizes: tuple[int, ...], least: int, largest: int) -> Plan:
    """Best fit, longest pieces first; sizes outside ``least`` to ``largest`` are opened only for pieces that need them."""
    plan, made = Plan(), 0
    open_bins: dict[tuple[int, int], list[Bins]] = {}  # by room left and size
    rooms: list[tuple[int, int]] = []

    def put(b: Bins) -> None:
        room = (b.size - b.used, b.size)
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append(b)

    for length in sorted(counts, reverse=True):
        placed, total = 0, counts[length]
        while placed < total:
            i = bisect_left(rooms, (length, 0))
            if i < len(rooms):
                room = rooms[i]
                run = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[i]
            else:
                fitting = [s for s in sizes if s >= length]
                allowed = [s for s in fitting if least <= s <= largest] or fitting[:1]
                size = min(allowed, key=lambda s: (cost(s) / s, s))
                run = Bins(made, max(1, (total - placed) // (size // length)), size, 0)
                made += run.count
            # as many bins as the rest of the pieces fill, or else one: best fit fills them one after the other
            taken = min(run.count, max(1, (total - placed) // ((run.size - run.used) // length)))
            if taken < run.count:
                put(Bins(run.first + taken, run.count - taken, run.size, run.used))
            plan.steps.append(Step(length, placed, placed + taken - 1, run.first, run.used))
            put(Bins(run.first, taken, run.size, run.used + length))
            placed += taken
    for runs in open_bins.values():
        for b in runs:
            small = next(s for s in sizes if s >= b.used)
            plan.bins.append(Bins(b.first, b.count, small, b.used))
            plan.cost += b.count * cost(small)
    return plan


def best_plan(counts: dict[int, int], sizes: tuple[int, ...] = SIZES) -> Plan:
    """The plan of least cost over all ranges of sizes to open."""
    sizes = tuple(sorted(sizes))
    ranges = [(a, b) for a in sizes for b in sizes if a <= b]
    return min((plan_with(counts, sizes, a, b) for a, b in ranges), key=lambda p: p.cost)


def sized_steps(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """The steps as (length, first, last, bin, offset, final size of the bin), cut where the final size changes."""
    runs = sorted(plan.bins, key=lambda b: b.first)
    starts = [b.first for b in runs]
    out = []
    for s in plan.steps:
        at, end = s.bin, s.bin + s.last - s.first
        i = bisect_right(starts, at) - 1
        while at <= end:
            stop = min(end, runs[i].first + runs[i].count - 1)
            out.append((s.length, s.first + at - s.bin, s.first + stop - s.bin, at, s.offset, runs[i].size))
            at, i = stop + 1, i + 1
    return out


def _planned(counts: DataFrame, sizes: tuple[int, ...], names: tuple[str, ...]) -> DataFrame:
    """The sized steps of every range in ``counts`` (range, length, n), bins numbered through all ranges in order."""
    range_, length, first, last, bin_, offset, size = names
    fields = f"{range_} long, {length} int, {first} long, {last} long, {bin_} long, {offset} int, {size} int, bins long"

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        best = best_plan({int(x): int(n) for x, n in zip(rows["length"], rows["n"], strict=True)}, sizes)
        made = sum(b.count for b in best.bins)
        number = int(rows["range"].iloc[0])
        return pd.DataFrame(
            [(number, *step, made) for step in sized_steps(best)],
            columns=[range_, length, first, last, bin_, offset, size, "bins"],
        )

    steps = settle(counts.groupBy("range").applyInPandas(plan, fields))
    # one row per range, dealt by stretches of ranges; one row per stretch is summed in one task
    made = steps.groupBy(range_).agg(F.first("bins").alias("bins")).withColumn("stretch", F.floor(F.col(range_) / RANGES))
    earlier = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = made.groupBy("stretch").agg(F.sum("bins").alias("all"))
    sums = sums.select("stretch", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("stretch").orderBy(range_).rowsBetween(Window.unboundedPreceding, -1)
    made = made.withColumn("inside", F.coalesce(F.sum("bins").over(within), F.lit(0))).join(sums, "stretch")
    base = made.select(range_, (F.col("before") + F.col("inside")).alias("base"))
    return steps.join(base, range_).withColumn(bin_, F.col(bin_) + F.col("base")).select(*names)


def pack(
    df: DataFrame,
    length: Column,
    sizes: tuple[int, ...] = SIZES,
    key: tuple[str, ...] = ("doc_id",),
    within: Column | None = None,
) -> DataFrame:
    """One row per piece of every row of ``df``: its columns, piece, start, length, bin_id, bin_size, offset.

    A document longer than the largest size is cut into pieces of that size and a rest; piece counts them from 0,
    start is the piece's first token. offset is its place in the bin. Documents of null, zero or negative length have
    one row of length 0 without a bin. Rows with equal ``key`` are packed as separate documents. Columns of these
    names in ``df`` are replaced.

    ``within`` numbers ranges of rows (long, not negative; null counts as 0): a bin holds pieces of one range, and the
    bins of a range have lower numbers than those of the next. Ranges are planned where they lie; one should hold
    enough tokens for many bins, since the last bins of each are not full, and fit a task.
    """
    spark = df.sparkSession
    most = max(sizes)
    new = ["piece", "start", "length", "bin_id", "bin_size", "offset"]
    whole = free_name(df, "_tokens")
    # the length first, since it may be computed from a column that is replaced
    rows = df.withColumn(whole, F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).cast("long"))
    part = free_name(df, "_range")
    if within is not None:
        rows = rows.withColumn(part, F.coalesce(within.cast("long"), F.lit(0).cast("long")))
    rows = rows.drop(*new)
    kept = [c for c in rows.columns if c not in (whole, part)]
    cuts = F.sequence(F.lit(0).cast("long"), F.floor((F.col(whole) - 1) / most).cast("long"))
    pieces = rows.where(F.col(whole) > 0).withColumn("piece", F.explode(cuts))
    pieces = pieces.withColumn("start", F.col("piece") * most)
    pieces = pieces.withColumn("length", F.least(F.lit(most), F.col(whole) - F.col("start")).cast("int")).drop(whole)
    pieces = settle(pieces)  # read three times, and the length may be dear to compute
    empty = rows.where(F.col(whole) == 0).drop(whole)
    for name in new:
        kind = "int" if name in ("length", "bin_size", "offset") else "long"
        empty = empty.withColumn(name, F.lit(0 if name in ("piece", "start", "length") else None).cast(kind))
    order = [*[F.col(k) for k in key], F.col("piece")]
    names = ("length", "first", "last", "bin", "offset", "size", "rank")
    length_, first, last, bin_, offset, size, rank = (free_name(df, f"_plan_{x}") for x in names)
    fits = (F.col("length") == F.col(length_)) & F.col(rank).between(F.col(first), F.col(last))
    if within is None:
        # at most one row per length up to the largest size
        counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
        if not counts:
            return empty.select(*kept, *new)
        fields = f"{length_} int, {first} long, {last} long, {bin_} long, {offset} int, {size} int"
        # its size depends on the permitted lengths alone
        steps = F.broadcast(spark.createDataFrame(sized_steps(best_plan(counts, sizes)), fields))
        ranked = running(pieces, ["length"], order, F.lit(1), rank, sum(counts.values()))
    else:
        counts = settle(pieces.groupBy(F.col(part).alias("range"), "length").agg(F.count("*").alias("n")))
        largest = counts.groupBy("range").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
        if largest is None:
            return empty.select(*kept, *new)
        range_ = free_name(df, "_plan_range")
        steps = _planned(counts, sizes, (range_, length_, first, last, bin_, offset, size))
        ranked = running(pieces, [part, "length"], order, F.lit(1), rank, largest)
        fits = (F.col(part) == F.col(range_)) & fits
    out = ranked.join(steps, fits).withColumn("bin_id", F.col(bin_) + F.col(rank) - F.col(first))
    out = out.withColumns({"bin_size": F.col(size), "offset": F.col(offset)})
    return out.select(*kept, *new).unionByName(empty.select(*kept, *new))
