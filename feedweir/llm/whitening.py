"""Whitening of embeddings by a bidiagonal qd solver.

Every block of rows is centred and reduced to a triangle by QR; triangles are stacked and reduced again until one is
left, whose singular values and vectors (Householder bidiagonalisation, dqds, twisted factorisations: ``bidiagonal``)
are those of all centred rows. What leaves a task are sums and triangles of the vectors' width.

Vectors of different lengths have no common covariance: each length is fitted and whitened on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.llm.bidiagonal import right_singular
from feedweir.llm.common import settle

COMPONENTS = 32
# Values of the triangles that are stacked in one task.
STACKED = 1 << 23
LONG = 1 << 63

_ROWS = "vec_id long, dim int, x array<long>"
_SUMS = "dim int, at int, n long, high long, low long, largest long"
_TRIANGLE = "dim int, block long, r array<double>"
_OUT = "vec_id long, deviation long, whitened array<double>"


@dataclass(frozen=True)
class Fit:
    """What whitens vectors of one length: count, sums, eigenvalues and eigenvectors (as columns) of the covariance."""

    n: int
    sums: list[int]
    largest: int
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def usable(v: Column) -> Column:
    """Whether a vector is not null and all its entries are finite numbers."""
    return F.coalesce(F.forall(v, lambda c: F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))), F.lit(False))


def prepared(df: DataFrame, scale: int, shift: int, *others: Column) -> DataFrame:
    """Rows (vec_id, dim, x, others) with x = floor(scale * entry) + shift, of the rows of ``df`` with a usable vector.

    Entries beyond the longs, some 10 to the 17th at a scale of 64, become the nearest long.
    """
    vector = F.col("embedding").cast("array<double>")
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("v"), *others).where(usable(F.col("v")))
    most = float(1 << 62)
    whole = F.transform("v", lambda c: F.floor(F.least(F.greatest(scale * c, F.lit(-most)), F.lit(most))) + F.lit(shift).cast("long"))
    return rows.withColumns({"dim": F.size("v"), "x": whole}).drop("v")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(length, places of the rows, matrix, batch) for the lengths within each batch."""
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            at = np.nonzero(dims == dim)[0]
            rows = batch if len(at) == len(dims) else batch.take(pa.array(at))
            flat = rows.column("x").flatten().to_numpy(zero_copy_only=False)
            yield int(dim), at, flat.reshape(len(at), int(dim)), batch


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])


def _typed(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = _arrow(schema)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], schema=fields)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, length and place: count, sum as high * 2^32 + low, and the largest absolute value."""
    total: dict[int, list] = {}
    for dim, _, x, _ in _matrices(batches):
        part = [len(x), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), np.abs(x).max(axis=0)]
        old = total.get(dim)
        total[dim] = part if old is None else [old[0] + part[0], old[1] + part[1], old[2] + part[2], np.maximum(old[3], part[3])]
    rows = [(dim, i, n, int(h[i]), int(w[i]), int(b[i])) for dim, (n, h, w, b) in total.items() for i in range(dim)]
    yield _typed(rows, _SUMS)


def _scaled(x: np.ndarray, n: int, sums: list[int], largest: int) -> np.ndarray:
    """n * x - sums, exactly; Python's integers where longs are too small."""
    if 2 * n * largest < LONG:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _triangle(stack: np.ndarray) -> np.ndarray:
    """The square triangle R of a QR factorisation, filled with zero rows if there are fewer rows than columns."""
    r = np.linalg.qr(stack, mode="r")
    return np.vstack([r, np.zeros((stack.shape[1] - len(r), stack.shape[1]))])


def _reducer(sums: dict[int, tuple[int, list[int], int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        done: dict[int, np.ndarray] = {}
        for dim, _, x, _ in _matrices(batches):
            if dim:
                n = sums[dim][0]
                centred = _scaled(x, *sums[dim]).astype(float) / n
                done[dim] = _triangle(centred if dim not in done else np.vstack([done[dim], centred]))
        block = TaskContext.get().partitionId()
        yield _typed([(dim, block, r.ravel()) for dim, r in done.items()], _TRIANGLE)

    return run


def _stack(part: pd.DataFrame) -> pd.DataFrame:
    dim = int(part["dim"].iloc[0])
    rows = part.sort_values("block")
    r = _triangle(np.vstack([np.asarray(x).reshape(dim, dim) for x in rows["r"]]))
    return pd.DataFrame({"dim": [dim], "block": [rows["block"].iloc[0]], "r": [r.ravel()]})


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of every length of ``rows`` (``prepared``), over all of them.

    The driver sees one row of sums per place and one triangle per length. Triangles meet in a tree, so that no task
    stacks more than ``STACKED`` values of them, or two.
    """
    parts = rows.mapInArrow(_sums, _SUMS).groupBy("dim", "at").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")],
        F.max("largest").alias("largest"),
    )
    sums: dict[int, tuple[int, list[int], int]] = {}
    for r in parts.orderBy("dim", "at").collect():
        n, before, largest = sums.get(r["dim"], (r["n"], [], 0))
        sums[r["dim"]] = (n, [*before, int(r["high"]) * (1 << 32) + int(r["low"])], max(largest, r["largest"]))
    if not sums:
        return {}
    state = settle(rows.mapInArrow(_reducer(sums), _TRIANGLE))
    fan = max(2, STACKED // max(sums) ** 2)
    left = state.agg(F.max("block")).first()[0]
    while left:
        state = settle(state.withColumn("block", F.floor(F.col("block") / fan)).groupBy("dim", "block").applyInPandas(_stack, _TRIANGLE))
        left //= fan
    out = {}
    for row in state.collect():
        dim = row["dim"]
        n, total, largest = sums[dim]
        r = np.array(row["r"]).reshape(dim, dim)
        squares, vectors = right_singular(r, components)
        out[dim] = Fit(n, total, largest, squares / n, vectors, float((r * r).sum()) / n)
    return out


def _whitener(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, at, x, batch in _matrices(batches):
            if dim not in fits:
                continue
            f = fits[dim]
            off = _scaled(x, f.n, f.sums, f.largest)
            whitened = (off.astype(float) / f.n) @ f.vectors / np.sqrt(f.values)
            if dim * (2 * f.n * f.largest) ** 2 >= LONG:
                exact = [sum(int(c) ** 2 for c in row) for row in off]
                deviation = pa.array([s if s < LONG else None for s in exact], pa.int64())
            else:
                deviation = pa.array((off * off).sum(axis=1))
            ids = batch.column("vec_id").take(pa.array(at))
            lists = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * len(f.values), whitened.ravel())
            yield pa.RecordBatch.from_arrays([ids, deviation, lists], schema=_arrow(_OUT))

    return run


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and length: count, means and centred products, merged batch by batch."""
    total: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for width, _, y, _ in _matrices(batches):
        if width:
            mean = y.mean(axis=0)
            total[width] = _merged(total.get(width), (len(y), mean, (y - mean).T @ (y - mean)))
    rows = [(k, n, mean, products.ravel()) for k, (n, mean, products) in total.items()]
    yield _typed(rows, "dim int, n long, mean array<double>, products array<double>")


def _merged(a: tuple | None, b: tuple) -> tuple:
    if a is None:
        return b
    n, step = a[0] + b[0], b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def _merge_all(part: pd.DataFrame) -> pd.DataFrame:
    k, total = int(part["dim"].iloc[0]), None
    for n, mean, products in zip(part["n"], part["mean"], part["products"], strict=True):
        total = _merged(total, (n, np.asarray(mean), np.asarray(products).reshape(k, k)))
    worst = float(np.abs(total[2] / total[0] - np.eye(k)).max())
    return pd.DataFrame({"length": [part["length"].iloc[0]], "identity_error": [worst]})


def identity_errors(whitened: DataFrame) -> dict[int, float]:
    """Per length of ``whitened`` (length, x, dim): the largest entry of its covariance less the identity."""
    parts = []
    for length in [r[0] for r in whitened.select("length").distinct().collect()]:
        rows = whitened.where(F.col("length") == length).select("dim", "x")
        moments = rows.mapInArrow(_moments, "dim int, n long, mean array<double>, products array<double>")
        parts.append(moments.withColumn("length", F.lit(length)))
    out = {}
    for moments in parts:
        for r in moments.groupBy("dim").applyInPandas(_merge_all, "length int, identity_error double").collect():
            out[r["length"]] = r["identity_error"]
    return out


def whiten(df: DataFrame, components: int = COMPONENTS, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """Per row of ``df`` (vec_id long, embedding) and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null or non-finite entry are left out. The rest is the fit list, repeated rows
    and null ids included. Each length of vectors has its own fit and ``n``; empty vectors, equal vectors and a single
    vector have no component and so no row, and there are never more components than the covariance has positive
    eigenvalues. ``deviation`` is null where it exceeds a long. Other columns are ignored.
    """
    rows = settle(prepared(df, scale, shift))
    fits = {dim: f for dim, f in fit(rows, components).items() if len(f.values)}
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not fits:
        return df.sparkSession.createDataFrame([], schema)
    done = []
    for dim, f in fits.items():
        part = rows.where(F.col("dim") == dim).mapInArrow(_whitener({dim: f}), _OUT)
        done.append(part.withColumn("length", F.lit(dim)))
    together = done[0]
    for part in done[1:]:
        together = together.unionByName(part)
    together = settle(together)
    errors = identity_errors(together.select("length", F.col("whitened").alias("x"), F.size("whitened").alias("dim")))
    out = together.select("vec_id", "length", "deviation", F.posexplode("whitened").alias("at", "whitened"))

    def by_length(value, kind: str) -> Column:
        found = F.lit(None).cast(kind)
        for dim, f in fits.items():
            found = F.when(F.col("length") == dim, value(dim, f)).otherwise(found)
        return found.cast(kind)

    return out.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        by_length(lambda dim, f: F.lit(f.n).cast("long"), "long").alias("n"),
        "deviation",
        "whitened",
        by_length(lambda dim, f: F.get(F.array(*[F.lit(float(e / f.trace)) for e in f.values]), F.col("at")), "double").alias("explained"),
        by_length(lambda dim, f: F.lit(errors[dim]), "double").alias("identity_error"),
    )
