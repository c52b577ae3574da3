"""Whitening, line bitmaps and hard negatives against numpy and plain Python."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedweir.llm import bidiagonal, linededup, negatives, queries, whitening
from tests.compare import difference, oracle

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def spectrum(values, seed=0):
    rng = np.random.default_rng(seed)
    n = len(values)
    u, _ = np.linalg.qr(rng.standard_normal((n, n)))
    v, _ = np.linalg.qr(rng.standard_normal((n, n)))
    return u * np.asarray(values, float) @ v.T


CASES = {
    "one": np.array([[3.0]]),
    "random": np.triu(np.random.default_rng(1).standard_normal((64, 64))),
    "equal": np.eye(20),
    "nearly equal": np.eye(20) + 1e-9 * np.triu(np.random.default_rng(2).standard_normal((20, 20))),
    "triples": spectrum(np.repeat([5.0, 3.0, 1.0], 8)),
    "graded": spectrum(np.logspace(0, -9, 40)),
    "close": spectrum(np.linspace(1, 1.0001, 30)),
    "half of the rank": spectrum(np.r_[np.linspace(1, 2, 10), np.zeros(10)]),
    "constant columns": np.triu(np.random.default_rng(3).standard_normal((30, 30))) * (np.arange(30) % 3 > 0),
    "zero": np.zeros((5, 5)),
    "all ones": np.ones((6, 6)),
}


@pytest.mark.parametrize("name", CASES)
def test_singular_values_and_vectors(name):
    r = CASES[name]
    squares, vectors = bidiagonal.right_singular(r, 32)
    true = np.linalg.svd(r, compute_uv=False)
    rank = int((true > 1e-10 * true[0]).sum()) if true[0] else 0
    assert len(squares) == min(32, rank)
    k = len(squares)
    assert np.allclose(np.sqrt(squares), true[:k], rtol=0, atol=1e-13 * max(true[0], 1))
    assert np.abs(vectors.T @ vectors - np.eye(k)).max(initial=0) < 1e-10
    assert np.abs(r.T @ (r @ vectors) - vectors * squares).max(initial=0) < 1e-9 * max(true[0] ** 2, 1)


def test_bidiagonal_form():
    r = np.random.default_rng(5).standard_normal((12, 12))
    a, b, v = bidiagonal.bidiagonalise(r)
    inner = np.diag(a) + np.diag(b, 1)
    assert np.allclose(v @ inner.T @ inner @ v.T, r.T @ r)


def whitened_by_numpy(vectors):
    x = np.floor(64 * np.asarray(vectors, float)) + 1_000_000
    centred = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(x))
    values, directions = values[::-1], directions[:, ::-1]
    keep = values[: whitening.COMPONENTS] > 1e-9 * values[0]
    return values, centred @ directions[:, : len(keep)][:, keep] / np.sqrt(values[: len(keep)][keep]), x.astype(object)


def check_whitening(rows, ids, vectors):
    values, want, x = whitened_by_numpy(vectors)
    got = defaultdict(dict)
    for r in rows:
        got[r["component"]][r["vec_id"]] = r
    assert sorted(got) == list(range(1, want.shape[1] + 1))
    sums, n = x.sum(axis=0), len(x)
    for c, mine in got.items():
        y = np.array([mine[i]["whitened"] for i in ids])
        assert min(np.abs(y - want[:, c - 1]).max(), np.abs(y + want[:, c - 1]).max()) < 1e-7
        assert abs(mine[ids[0]]["explained"] - values[c - 1] / values.sum()) < 1e-9
        assert all(r["identity_error"] < 1e-8 and r["n"] == n for r in mine.values())
        assert all(mine[i]["deviation"] == ((n * x[k] - sums) ** 2).sum() for k, i in enumerate(ids))


def test_whitening(spark):
    given = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    table = sorted(given.collect())
    out = queries.op11_qd_whitening(spark, SMALL)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(out.collect(), [r["vec_id"] for r in table], [r["embedding"] for r in table])


def test_whitening_in_many_blocks(spark, monkeypatch):
    """Triangles meet two by two over several levels."""
    monkeypatch.setattr(whitening, "STACKED", 1)
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((300, 5)) @ rng.standard_normal((5, 5)) + 3
    rows = [(i, [float(np.float32(c)) for c in v], 1) for i, v in enumerate(vectors)]
    out = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(13)).collect()
    check_whitening(out, list(range(300)), [r[1] for r in rows])


def test_whitening_of_odd_tables(spark):
    """Nulls and non-finite entries go; ranks, lengths, repeated rows, null ids, huge entries and clashing columns."""
    nan, inf = float("nan"), float("inf")
    plane = [(i, [float(i % 7), float(i % 3), 2.0], 1) for i in range(40)]
    odd = [(100, None, 1), (101, [1.0, None, 2.0], 1), (102, [nan, 1.0, 1.0], 1), (103, [1.0, -inf, 1.0], 1), (104, [], 1)]
    other = [(200, [1.0, 2.0], None), (201, [3.0, 1.0], 2), (202, [0.0, 9.0], 2), (202, [0.0, 9.0], 2), (None, [4.0, 4.0], 2)]
    alone = [(300, [5.0] * 4, 1), (301, [7.0] * 5, 1), (302, [7.0] * 5, 1)]
    df = spark.createDataFrame(plane + odd + other + alone, VECTORS)
    df = df.withColumns({c: F.lit("x") for c in ("component", "n", "dim", "x", "v", "whitened", "length")})
    out = whitening.whiten(df).collect()
    check_whitening([r for r in out if r["vec_id"] is not None and r["vec_id"] < 100], list(range(40)), [r[1] for r in plane])
    assert sorted({r["component"] for r in out if r["vec_id"] == 0}) == [1, 2]
    assert sorted((r["vec_id"] or -1, r["component"]) for r in out if r["n"] == 5) == sorted(
        (i, c) for i in (200, 201, 202, 202, -1) for c in (1, 2)
    )
    assert {r["n"] for r in out} == {40, 5}
    assert whitening.whiten(df.limit(0)).collect() == []
    huge = [(i, [1e30 * (i % 2), float(i)], 1) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(huge, VECTORS)).collect()
    assert {r["component"] for r in got} == {1} and all(r["deviation"] is None for r in got)


BLANK = " \t\n\x0b\x0c\r"


def by_hand(rows, least_docs, least_chars=1):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))

    holders = defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(d)
    gone = {k for k, ds in holders.items() if len(k) >= least_chars and len(ds) >= least_docs}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in gone]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


ODD = [
    (1, None),
    (2, ""),
    (3, "\n\n"),
    (4, " Shared\tLINE \r\nown\nshared\tline\n\x0bSHARED\tline"),
    (5, "shared\tline"),
    (6, "Übung É\nshared\tline\nübung É"),
    (7, "Übung É\nshared\tline\n\xa0shared\tline"),
    (None, "shared\tline\nüBUNG É"),
    (None, "üBUNG É\nlast"),
    (8, "x" * 200_000 + "\nshared\tline\n" + "y\n" * 30_000),
    (8, "one doc_id, two texts\nshared\tline"),
    (9, "twice the same row\ny"),
    (9, "twice the same row\ny"),
]


@pytest.mark.parametrize(("least_docs", "least_chars"), [(2, 1), (3, 1), (4, 5), (2, 0), (50, 1)])
def test_line_bitmaps(docs, least_docs, least_chars):
    df = docs(ODD).withColumns({c: F.lit(1) for c in ("n_lines", "keep", "h", "block", "_runs", "_doc", "_here", "at")})
    out = linededup.deduplicate(df, least_docs=least_docs, least_chars=least_chars)
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(by_hand(ODD, least_docs, least_chars), key=repr)


def test_bitmaps_are_runs(docs):
    rows = [(i, f"head\nbody {i}\nmore {i}\nfoot\nfoot") for i in range(4)] + [(9, "head\nfoot"), (10, "alone")]
    out = {r["doc_id"]: [tuple(x) for x in r["keep"]] for r in linededup.keep_bitmaps(docs(rows), least_docs=4).collect()}
    assert out == {0: [(1, 2)], 1: [(1, 2)], 2: [(1, 2)], 3: [(1, 2)], 9: [], 10: [(0, 0)]}
    assert linededup.keep_bitmaps(docs([])).count() == 0


def test_line_rule_is_native(docs):
    """No code leaves the JVM."""
    df = linededup.dropped_runs(docs(ODD), least_docs=2)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_line_query(spark):
    assert difference(queries.op12_line_bitmaps(spark, SMALL), oracle(SMALL), queries.OP12_SQL) is None
    some = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in by_hand([tuple(r) for r in some], 10)}
    assert {r["doc_id"]: tuple(r)[1:] for r in queries.op12_line_bitmaps(spark, SMALL).collect()} == want


def mined(rows, anchor, positives=5, best=5, percent=80):
    """(anchor, positive, rank, negative, positive score, negative score) from all pairs of (vec_id, label, x)."""
    out = []
    for a, label, x in rows:
        if anchor(a):
            scores = [(-sum(p * q for p, q in zip(x, y, strict=True)), b, other) for b, other, y in rows if b != a and len(y) == len(x)]
            scores.sort()
            for score, p, _ in [s for s in scores if s[2] == label][:positives]:
                fits = [s for s in scores if s[2] != label and percent * -score <= 100 * -s[0] <= 100 * -score][:best]
                out += [(a, p, i + 1, s[1], -score, -s[0]) for i, s in enumerate(fits)]
    return sorted(out)


def test_negatives_query(spark):
    assert difference(queries.op13_segment_negatives(spark, SMALL), oracle(SMALL), queries.OP13_SQL) is None


@pytest.mark.parametrize("block_values", [64, 400, 1 << 20])
def test_negatives(spark, block_values):
    """Ties, groups of copies and negative products, in one block and in many rounds of blocks."""
    rng = np.random.default_rng(block_values)
    x = rng.integers(-3, 4, (150, 6)) * 40
    x[60:110] = x[60]
    rows = [(int(i), int(i) % 3, [int(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, y, 6, v) for i, y, v in rows], "vec_id long, label int, dim int, x array<long>")
    out = negatives.mine(df, F.col("vec_id") % 10 == 0, positives=4, negatives=3, block_values=block_values)
    assert sorted(tuple(r) for r in out.collect()) == mined(rows, lambda a: a % 10 == 0, 4, 3)


def test_negatives_of_odd_tables(spark):
    nan = float("nan")
    given = [
        (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.9], 2), (2, [1.0, 1.9], 2), (3, [0.9, 2.0], 3), (4, [1.0, 2.0], None),
        (5, None, 2), (6, [nan, 1.0], 2), (7, [1.0, None], 2), (None, [1.0, 2.0], 2), (8, [1.0, 2.0, 3.0], 2), (9, [], 2), (10, [], 1),
        (11, [0.0, 0.0], 2), (20, [-1.0, 0.5], 4), (21, [1.0, 0.0], 4),
    ]
    df = spark.createDataFrame(given, VECTORS).withColumns({"x": F.lit(1), "dim": F.lit("d"), "v": F.lit(2)})
    rows = whitening.prepared(df, 256, 0, F.col("label"))
    out = sorted(tuple(r) for r in negatives.mine(rows, F.col("vec_id") % 10 == 0).collect())
    plain = [
        (i, y, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v, y in dict.fromkeys((i, tuple(v), y) for i, v, y in given if v is not None and None not in v and nan not in v)
        if i is not None and y is not None
    ]
    assert out == mined(plain, lambda a: a % 10 == 0)
    assert negatives.mine(rows.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    huge = [(0, [3e18], 1), (1, [3e18], 1), (2, [1.0], 2), (3, [2.9e18], 2)]
    far = whitening.prepared(spark.createDataFrame(huge, VECTORS), 1, 0, F.col("label"))
    assert [r["negative_id"] for r in negatives.mine(far, F.col("vec_id") == 0).collect()] == [3]


def test_summaries_bound_the_scores():
    rng = np.random.default_rng(8)
    x, y = rng.integers(-99, 99, (50, 37)).astype(float), rng.integers(-99, 99, (20, 37)).astype(float)
    exact, before = x @ y.T, np.inf
    for (mean, deviation), (other_mean, other_deviation) in zip(negatives.summaries(x), negatives.summaries(y), strict=True):
        middle, spread = mean @ other_mean.T, deviation @ other_deviation.T
        assert (middle + spread >= exact - 1e-6).all() and (middle - spread <= exact + 1e-6).all()
        assert spread.sum() < before
        before = spread.sum()
