"""Hard negatives by filtering on segment summaries.

A vector is cut into segments, and of every segment the mean and the deviation are kept. Over one segment, an inner
product lies within length * (product of the means plus or minus product of the deviations), so summaries bound a score
from both sides without the vector. Coarse segments are tried first, finer ones on what is left, and only what no level
rules out is scored exactly.

Anchors are the stated queries; they meet all rows in blocks (block of rows, block of anchors), each of bounded size.
Blocks of rows are visited in rounds of growing numbers, and a round knows how good the best rows of the earlier ones
are, so that later rounds return few candidates.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweir.llm.common import settle

# Segments per level, coarse to fine.
SEGMENTS = (1, 4, 16)
# Components of a block of rows, and of a block of anchors. Rows are sent once per block of anchors and anchors once per
# block of rows: larger blocks send less.
BLOCK_VALUES = 1 << 20
# The blocks that a round visits are this many times those of all rounds before.
GROWTH = 8
# Longs beyond this have no exact products in doubles.
EXACT = 1 << 53
LARGEST = (1 << 63) - 1


def summaries(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level the means and the deviations of all segments, both times the root of the segment's length."""
    out = []
    width = x.shape[1]
    for parts in SEGMENTS:
        if parts > width:
            break
        cuts = np.linspace(0, width, parts + 1).astype(int)
        size = np.diff(cuts)
        mean = np.add.reduceat(x, cuts[:-1], axis=1) / size
        off = x - np.repeat(mean, size, axis=1)
        deviation = np.sqrt(np.add.reduceat(off * off, cuts[:-1], axis=1) / size)
        out.append((mean * np.sqrt(size), deviation * np.sqrt(size)))
    return out


class Shard:
    """A block of rows with the summaries of their vectors, sorted by label and id."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["label", "vec_id"]).reset_index(drop=True)
        self.ids = rows["vec_id"].to_numpy()
        self.labels = rows["label"].to_numpy()
        self.x = np.stack([np.asarray(v, np.int64) for v in rows["x"]])
        self.floats = self.x.astype(float)
        self.largest = float(np.abs(self.floats).max()) if self.x.size else 0.0
        self.levels = summaries(self.floats)
        self.norms = np.linalg.norm(self.floats, axis=1)

    def exact(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Scores as whole numbers: doubles while they hold them exactly, Python's integers beyond."""
        size = float(np.abs(anchor.astype(float)).max()) if len(anchor) else 0.0
        if self.largest * size * max(1, len(anchor)) < EXACT:
            return (self.floats[at] @ anchor.astype(float)).astype(np.int64)
        whole = self.x[at].astype(object) @ anchor.astype(object) if len(at) else np.zeros(0, object)
        return np.clip(whole, -LARGEST, LARGEST).astype(np.int64)

    def within(self, at: np.ndarray, anchor: np.ndarray, mine: list, least: float, most: float, seeds: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the rows among ``at`` whose score lies between ``least`` and ``most``.

        With ``seeds``, the best so many rows are wanted and ``least`` rises to the score of the last one of a few that
        look best.
        """
        a = anchor.astype(float)
        slack = 1e-9 * (1 + np.linalg.norm(a) * (self.norms.max() if len(self.norms) else 0.0))
        for level, ((mean, deviation), (a_mean, a_deviation)) in enumerate(zip(self.levels, mine, strict=True)):
            middle, spread = mean[at] @ a_mean, deviation[at] @ a_deviation + slack
            if seeds and level == 0 and len(at) > 4 * seeds:
                likely = at[np.argpartition(-(middle + spread), 4 * seeds)[: 4 * seeds]]
                least = max(least, float(np.sort(self.exact(likely, anchor))[-seeds]))
            # scores stop at the ends of the longs, and so do their bounds
            keep = (np.maximum(middle + spread, -float(LARGEST)) >= least) & (np.minimum(middle - spread, float(LARGEST)) <= most)
            at = at[keep]
        scores = self.exact(at, anchor)
        keep = (scores >= least) & (scores <= most)
        return at[keep], scores[keep]


def _first(ids: np.ndarray, scores: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, ties by smaller id."""
    if len(ids) > count:
        edge = np.partition(scores, -count)[-count]
        at = np.nonzero(scores >= edge)[0]
    else:
        at = np.arange(len(ids))
    return at[np.lexsort((ids[at], -scores[at]))][:count]


_POSITIVES = "anchor_id long, positive_id long, positive_score long"


def _find_positives(count: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int]] = []
        if len(rows) and len(asked):
            shard, asked = Shard(rows), asked.rename(columns=lambda c: c.removeprefix("q_"))
            anchors = np.stack([np.asarray(v, np.int64) for v in asked["x"]])
            levels = summaries(anchors.astype(float))
            floors = asked["floor"].astype(float).fillna(-np.inf).to_numpy()
            for i, (anchor_id, label) in enumerate(zip(asked["vec_id"], asked["label"], strict=True)):
                lo, hi = np.searchsorted(shard.labels, [label, label + 1])
                at = np.arange(lo, hi)
                at = at[shard.ids[at] != anchor_id]
                mine = [(m[i], s[i]) for m, s in levels]
                at, scores = shard.within(at, anchors[i], mine, floors[i], np.inf, count)
                best = _first(shard.ids[at], scores, count)
                out += [(anchor_id, int(shard.ids[at[b]]), int(scores[b])) for b in best]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"])

    return run


_NEGATIVES = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def _find_negatives(count: int):
    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int, int]] = []
        if len(rows) and len(asked):
            shard, asked = Shard(rows), asked.rename(columns=lambda c: c.removeprefix("q_"))
            anchors = np.stack([np.asarray(v, np.int64) for v in asked["x"]])
            levels = summaries(anchors.astype(float))
            for i, (anchor_id, label, wanted) in enumerate(zip(asked["vec_id"], asked["label"], asked["wanted"], strict=True)):
                lo, hi = np.searchsorted(shard.labels, [label, label + 1])
                at = np.concatenate([np.arange(lo), np.arange(hi, len(shard.ids))])
                least, most = min(w["least"] for w in wanted), max(w["positive_score"] for w in wanted)
                mine = [(m[i], s[i]) for m, s in levels]
                # longs beyond the doubles' exact range are compared as longs below
                at, scores = shard.within(at, anchors[i], mine, float(least) * (1 - 1e-9) - 1, float(most) * (1 + 1e-9) + 1)
                ids = shard.ids[at]
                for w in wanted:
                    inside = np.nonzero((scores >= w["least"]) & (scores <= w["positive_score"]))[0]
                    best = inside[_first(ids[inside], scores[inside], count)]
                    out += [(anchor_id, w["positive_id"], int(ids[b]), w["positive_score"], int(scores[b])) for b in best]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    return run


def _visit(rows: DataFrame, asked: DataFrame, shards: range, sides: int, find, schema: str) -> DataFrame:
    """What ``find`` makes of every pair of a block of ``rows`` in ``shards`` and a block of ``asked``."""
    here = rows.where(F.col("shard").between(shards.start, shards.stop - 1))
    here = here.withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
    there = asked.withColumn("side", F.pmod(F.xxhash64("vec_id", F.lit("side")), F.lit(sides)).cast("int"))
    there = there.withColumn("shard", F.explode(F.sequence(F.lit(shards.start), F.lit(shards.stop - 1))))
    # both come from one table, so one side's columns need names of their own
    there = there.toDF(*[f"q_{c}" for c in there.columns])
    keys = ["dim", "shard", "side"]
    return here.groupBy(*keys).cogroup(there.groupBy(*[f"q_{c}" for c in keys])).applyInPandas(find, schema)


def _rounds(shards: int):
    start, stop = 0, 1
    while start < shards:
        yield range(start, min(stop, shards))
        start, stop = stop, stop * GROWTH


def _best(found: DataFrame, group: list[str], score: str, ident: str, count: int) -> DataFrame:
    """The first ``count`` rows of every group by falling score, with their place ``rank``."""
    order = Window.partitionBy(*group).orderBy(F.col(score).desc(), F.col(ident))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """Hard negatives for the rows of ``rows`` (vec_id long, label, dim int, x array<long>) that ``anchor`` holds for.

    An anchor's positives are the ``positives`` other rows of its label with the highest inner products; for each of
    them, the result has the ``negatives`` best rows of other labels whose score is at most the positive's and at least
    ``least_percent`` of it: anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Ties go to the
    smaller vec_id. Positives of negative score have no such rows.

    Rows with a null vec_id, label or vector take no part. Rows that share a vec_id are one vector, the smallest by
    label and components. Vectors of other lengths than the anchor's are not compared with it, and scores beyond the
    longs count as the nearest long. Other columns are ignored.
    """
    same = F.min(F.struct("label", "dim", "x")).alias("m")
    whole = rows.where("vec_id is not null and label is not null and x is not null").groupBy("vec_id").agg(same)
    whole = settle(whole.select("vec_id", F.col("m.label").cast("long").alias("label"), "m.dim", "m.x"))
    total, width = whole.agg(F.count("*"), F.max("dim")).first()
    chosen = whole.where(anchor)
    shards = max(1, -(-total * max(width or 1, 1) // block_values))
    sides = max(1, -(-chosen.count() * max(width or 1, 1) // block_values))
    whole = whole.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))

    best = None
    for blocks in _rounds(shards):
        asked = chosen
        if best is None:
            asked = asked.withColumn("floor", F.lit(None).cast("long"))
        else:
            full = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("positive_score").alias("floor"))
            asked = asked.join(full.where(F.col("n") == positives).drop("n"), "vec_id", "left")
        found = _visit(whole, asked, blocks, sides, _find_positives(positives), _POSITIVES)
        found = found if best is None else found.unionByName(best)
        best = settle(_best(found, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank"))

    # floor of a negative's score: the ceiling of least_percent of the positive's
    lowest = -F.floor(-F.col("positive_score").cast("decimal(38,0)") * least_percent / 100).cast("long")
    slots = best.where("positive_score >= 0").withColumn("lowest", lowest)
    best = None
    for blocks in _rounds(shards):
        wanted = slots.withColumn("least", F.col("lowest"))
        if best is not None:
            full = best.groupBy("anchor_id", "positive_id").agg(F.count("*").alias("n"), F.min("negative_score").alias("floor"))
            wanted = slots.join(full.where(F.col("n") == negatives).drop("n"), ["anchor_id", "positive_id"], "left")
            wanted = wanted.withColumn("least", F.greatest("lowest", "floor"))
        wanted = wanted.groupBy(F.col("anchor_id").alias("vec_id")).agg(
            F.collect_list(F.struct("positive_id", "positive_score", "least")).alias("wanted")
        )
        asked = chosen.join(wanted, "vec_id")
        found = _visit(whole, asked, blocks, sides, _find_negatives(negatives), _NEGATIVES)
        found = found if best is None else found.unionByName(best)
        best = settle(_best(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).drop("rank"))
    out = _best(best, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")

