"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of equal size. Block j of a source with share w of the mix is released at slot
floor(j / w) and due at slot ceil((j + 1) / w); each slot takes the released block with the earliest deadline. The
shares add up to one, so every deadline is met, and after any number of slots every source is less than one block away
from its share. When a source has run out, the others go on with their weights scaled up to the whole. What each of them
was ahead or behind moves its windows from there on, so that what is owed is not forgotten: over the whole mix, however
many sources run out, a source stays less than two blocks away.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from math import ceil, floor, gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.llm.common import free_name
from feedweir.llm.ranking import running

OTHER = None


@dataclass(frozen=True)
class Stretch:
    """Slots over which the schedule repeats: the blocks that one source has in them.

    Block j, for first <= j < end, has slot start + (j - first) // len(slots) * period + slots[(j - first) % len(slots)].
    """

    source: int
    first: int
    end: int
    start: int
    period: int
    slots: list[int]


class _Windows:
    """Earliest deadline first between two sources running out; ``ahead`` moves each source's windows by its lag."""

    def __init__(self, weights: dict[int, int], lag: dict[int, Fraction]) -> None:
        self.weights, self.lag, self.total = weights, lag, sum(weights.values())
        self.served, self.now = dict.fromkeys(weights, 0), 0

    def window(self, s: int) -> tuple[int, int]:
        """Release and deadline of the source's next block."""
        j, step = self.served[s] - self.lag[s], Fraction(self.total, self.weights[s])
        return floor(j * step), ceil((j + 1) * step)

    def take(self) -> int:
        """The source of the next slot."""
        windows = {s: self.window(s) for s in self.weights}
        released = [s for s, (first, _) in windows.items() if first <= self.now]
        chosen = min(released or windows, key=lambda s: (windows[s][1], s))
        self.served[chosen] += 1
        self.now += 1
        return chosen

    def lags(self) -> dict[int, Fraction]:
        """How many blocks each source is behind its share now."""
        return {s: self.lag[s] + Fraction(self.now * w, self.total) - self.served[s] for s, w in self.weights.items()}


def schedule(weights: dict[int, int], blocks: dict[int, int]) -> list[Stretch]:
    """Slots of all blocks. Its size depends on the number of sources and their weights alone, not on the blocks.

    Slots are chosen one by one for a period, as many as the weights add up to. A period that gives every source its
    weight leaves the lags as they were, so it is repeated until a source is about to run out.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done, lag = dict.fromkeys(left, 0), dict.fromkeys(left, Fraction(0))
    start, out = 0, []
    while left:
        shared = gcd(*[weights[s] for s in left])
        run = _Windows({s: weights[s] // shared for s in left}, {s: lag[s] for s in left})
        while all(left.values()):
            slots: dict[int, list[int]] = {s: [] for s in left}
            length = 0
            while length < run.total and all(left[s] > len(slots[s]) for s in left):
                slots[run.take()].append(length)
                length += 1
            steady = length == run.total and all(len(slots[s]) == w for s, w in run.weights.items())
            # the last blocks of a source are always placed one by one, to see when it runs out
            times = max(1, min((left[s] - 1) // w for s, w in run.weights.items())) if steady else 1
            for s, mine in slots.items():
                if mine:
                    out.append(Stretch(s, done[s], done[s] + times * len(mine), start, run.total, mine))
                done[s] += times * len(mine)
                left[s] -= times * len(mine)
                run.served[s] += (times - 1) * len(mine)
            run.now += (times - 1) * length
            start += times * length
        behind = run.lags()
        over = sum(behind[s] for s in left if not left[s])
        left = {s: n for s, n in left.items() if n}
        rest = sum(weights[s] for s in left)
        lag = {s: behind[s] + over * Fraction(weights[s], rest) for s in left}
    return out


def mix(
    df: DataFrame,
    weights: dict[str | None, int],
    size: Column,
    block_size: int,
    source: str = "source",
    key: tuple[str, ...] = ("doc_id", "text"),
) -> DataFrame:
    """``df`` with block, slot and at (long): the place of every row in the mix, ordered by (slot, at).

    ``weights`` are whole numbers of 1 or more per source; ``None`` is the weight of all sources that are not listed
    and of null, which are mixed as one. A source's rows are in the order of a hash of ``key``; ``at`` is the size of
    those before a row, and its block is ``at`` over ``block_size``. No row is dropped or repeated. Null and negative
    sizes count as 0; a row larger than a block takes the slots of the blocks that it covers. Equal rows get places
    next to each other. Columns block, slot and at in ``df`` are replaced.
    """
    if any(not isinstance(w, int) or w < 1 for w in weights.values()):
        raise ValueError("weights are whole numbers of 1 or more")
    spark = df.sparkSession
    named = [s for s in weights if s is not None]
    group, part = free_name(df, "_source"), free_name(df, "_size")
    number = F.lit(len(named))
    for i, s in enumerate(named):
        number = F.when(F.col(source) == s, F.lit(i)).otherwise(number)
    rows = df.drop("block", "slot", "at").withColumn(group, number)
    rows = rows.withColumn(part, F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).cast("long"))
    # one row per listed source, and one for the rest
    totals = rows.groupBy(group).agg(F.sum(part).alias("size"), F.count("*").alias("rows")).collect()
    blocks = {r[group]: max(1, -(-r["size"] // block_size)) for r in totals}
    by_number = {i: weights[s] for i, s in enumerate(named)} | {len(named): weights.get(None, 1)}
    stretches = schedule(by_number, blocks)
    last = {r[group]: blocks[r[group]] - 1 for r in totals}
    names = ("source", "first", "end", "start", "period", "slots", "last")
    source_, first, end, start, period, slots, last_ = (free_name(df, f"_plan_{x}") for x in names)
    fields = f"{source_} int, {first} long, {end} long, {start} long, {period} long, {slots} array<long>, {last_} long"
    rows_of_plan = [(s.source, s.first, s.end, s.start, s.period, s.slots, last[s.source]) for s in stretches]
    # some rows per source each time that one runs out, and as many slots as the weights add up to in each
    plan = F.broadcast(spark.createDataFrame(rows_of_plan, fields))
    order = [F.col(k) for k in key]
    placed = running(rows, [group], order, F.col(part), "at", sum(r["rows"] for r in totals))
    block = F.floor(F.col("at") / block_size).cast("long")
    number = F.least(block, F.col(last_))
    inside = (F.col(group) == F.col(source_)) & (number >= F.col(first)) & (number < F.col(end))
    out = placed.join(plan, inside).withColumn("block", number)
    step = F.col("block") - F.col(first)
    turn = F.floor(step / F.size(slots)).cast("long")
    slot = F.col(start) + turn * F.col(period) + F.element_at(slots, (step % F.size(slots) + 1).cast("int"))
    return out.withColumn("slot", slot).select(*rows.drop(group, part).columns, "block", "slot", "at")


def in_order(mixed: DataFrame, partitions: int) -> DataFrame:
    """The rows of the mix sorted into ``partitions`` files by slot."""
    return mixed.repartitionByRange(partitions, "slot", "at").sortWithinPartitions("slot", "at")
