"""Near duplicates, vectors, substring removal and components against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from feedweir.llm import fmindex, sketches, substrings, vectors
from feedweir.llm.common import components


def connected(nodes, links):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], changed = low, True
    return label


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(50)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    links = [x for x in links if x[0] != x[1]]
    assert got == connected({n for x in links for n in x}, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    ws = (text or "").encode().lower().split()
    return {tuple(ws)} if len(ws) == 1 else set(zip(ws, ws[1:]))


def brute_groups(rows):
    sets = {d: shingles(t) for d, t in rows}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    label = connected(sets, links)
    return sorted((d, len(sets[d]), label[d], label[d] == d) for d in sets)


def test_a_document_with_several_texts_loses_no_link(docs):
    """Rows that share a doc_id are one document: what is like any of their texts is linked to it."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(200)) for x in "abc")
    rows = [(4, a), (4, b), (4, a), (5, b + " more"), (6, a + " more"), (7, c), (8, c), (9, None), (9, ""), (10, None), (None, a)]
    got = sorted((tuple(r) for r in sketches.link(docs(rows)).collect()), key=repr)
    want = [(4, 199, 4, True)] * 3 + [(5, 200, 4, False), (6, 200, 4, False), (7, 199, 7, True), (8, 199, 7, False)]
    assert got == sorted([*want, (9, 0, 9, True), (9, 0, 9, True), (10, 0, 10, True), (None, 199, None, True)], key=repr)


def edited(words, share, rng):
    return [rng.choice("abcdefgh") * rng.randrange(3, 9) if rng.random() < share else w for w in words]


def test_near_duplicates(docs, sample):
    """The tables' own documents, a chain of edits, a hub whose copies are less alike, and copies that differ in case."""
    rng = random.Random(1)
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    words = [f"w{i}" for i in range(400)]
    chain = words
    for i in range(12):
        rows.append((5000 - i, " ".join(chain)))
        chain = edited(chain, 0.04, rng)
    hub = [f"h{i}" for i in range(300)]
    rows += [(6000 + i, " ".join(edited(hub, 0.06, rng))) for i in range(40)] + [(7000, " ".join(hub))]
    rows += [(8000, "Same TEXT here"), (8001, "same text  HERE"), (8002, "one"), (8003, "ONE"), (8004, "É é"), (8005, "é é")]
    got = sorted(tuple(r) for r in sketches.link(docs(rows)).collect())
    assert got == brute_groups(rows)


def brute_links(rows, width):
    """Linked pairs by sets of shingles of ``width`` words."""
    sets = {}
    for d, t in rows:
        ws = t.lower().split()
        sets[d] = {tuple(ws[i : i + width]) for i in range(max(1, len(ws) - width + 1))}
    return {
        (a, b) for a, b in itertools.combinations(sorted(sets), 2)
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }


def test_near_duplicates_of_five_words(spark, docs):
    """Texts linked by two words and not by five, of which the pipeline's stage keeps both; and short texts."""
    rng = random.Random(7)
    rows = []
    for g in range(30):
        base = [f"g{g}w{i}" for i in range(200)]
        rows += [(10 * g + i, " ".join(edited(base, 0.008 * i, rng))) for i in range(5)]
    rows += [(900, "One two three"), (901, "one TWO three"), (902, "one two"), (903, "one"), (904, "one two three four five")]
    two, five = brute_links(rows, 2), brute_links(rows, 5)
    assert five < two and len(two - five) > 10
    for width, links in ((2, two), (5, five)):
        label = connected([d for d, _ in rows], links)
        got = {r["doc_id"]: r["component_id"] for r in sketches.link(docs(rows), width).collect()}
        assert got == label
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs(rows), "").collect()}
    assert kept == {d for d, c in label.items() if d == c}


def test_near_duplicates_on_odd_tables(docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (4, "a b"), (None, "a b"), (5, "a b"), (6, "x y " * 50000)]
    out = sketches.link(docs(rows).withColumnRenamed("lang", "rep")).collect()
    got = sorted((tuple(r) for r in out), key=str)
    assert got == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (None, 1, None, True),
         (5, 1, 4, False), (6, 2, 6, True)], key=str,
    )
    kept = sorted((r["doc_id"] for r in sketches.keep_one(docs(rows)).collect()), key=str)
    assert kept == sorted([1, 2, 3, 4, None, 6], key=str)
    assert sketches.link(docs([])).count() == 0 and sketches.keep_one(docs([])).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 40, 3000):
        items = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        assert (sketches.sketch(items) < np.iinfo(np.uint64).max).all()
        assert (sketches.sketch(items[::-1]) == sketches.sketch(items)).all()
    shares = []
    for _ in range(200):
        a = rng.integers(0, 2**63, 90).astype(np.uint64)
        b = np.concatenate([a[:80], rng.integers(0, 2**63, 10).astype(np.uint64)])
        shares.append((sketches.sketch(a) == sketches.sketch(b)).mean())
    assert abs(np.mean(shares) - 0.8) < 0.01 and np.std(shares) < 0.035


def brute_vectors(rows):
    good = {}
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, float)
    links = [
        (a, b) for a, b in itertools.combinations(good, 2)
        if rows[a][2] == rows[b][2] and len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.98
    ]
    label = connected([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    n = Counter(x for link in links for x in link)
    return sorted((r[0], n[i], label[r[0]], label[r[0]] == r[0]) for i, r in enumerate(rows))


def test_marks_never_rule_out_a_link(spark):
    rng = np.random.default_rng(5)
    rows = []
    for size in (3, 40, 400, 9000):
        for share in (0.0, 0.5, 0.8, 1.0):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            b = np.concatenate([a[: int(size * share)], rng.integers(0, 2**63, size, dtype=np.uint64)])
            marks = [sketches.marks(x).tolist() for x in (a, b)]
            rows.append((*marks, len(np.setdiff1d(a, b)), size, share))
    df = spark.createDataFrame(rows, "x array<long>, y array<long>, lacking long, size long, share double")
    df = df.withColumn("seen", sketches._only_left(df["x"], df["y"]))
    assert df.where("seen > lacking").count() == 0
    # sets that are small against the marks are told apart almost exactly
    assert df.where("size <= 400 and share < 1 and seen < 0.6 * lacking").count() == 0


def test_vectors(spark, monkeypatch):
    """Small shards and few vectors per centroid, so that all steps run: several centroids, sub-shards, blocks."""
    monkeypatch.setattr(vectors, "SHARD", 60)
    monkeypatch.setattr(vectors, "PER_CENTROID", 100)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((150, 16))
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(base)]
    for i in range(150, 400):
        rows.append((i, [float(x) for x in base[i % 8] + rng.standard_normal(16) * 0.08], (i % 8) % 2))
    rows += [(400 + i, rows[3][1], 1) for i in range(5)] + [(410, [2 * x for x in rows[3][1]], 1), (411, rows[3][1], None)]
    rows += [(420, None, 1), (421, [], 1), (422, [0.0] * 16, 1), (423, [float("nan")] * 16, 1), (424, [None] * 16, 1)]
    rows += [(430, [1.0, 2.0], 1), (431, [1.0, 2.0], 1), (432, [2.0, 4.1], 1), (433, [float("inf")] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    expected = brute_vectors(rows)
    got = sorted(tuple(r) for r in vectors.link(df).collect())
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in expected)
    assert [(r[0], r[2]) for r in got] == [(r[0], r[2]) for r in expected]
    assert all(a[1] <= b[1] for a, b in zip(got, expected, strict=True))


def test_vectors_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", "label").collect()]
    assert sorted(tuple(r) for r in vectors.link(df).collect()) == brute_vectors(rows)


def test_vectors_on_odd_tables(spark):
    kind = "vec_id long, embedding array<float>, label string, rep string, weight int"
    rows = [(None, [1.0, 0.0], "a", "x", 1), (1, [1.0, 0.0], "a", "x", 1), (1, [1.0, 0.0], "a", "x", 1)]
    got = sorted((tuple(r) for r in vectors.link(spark.createDataFrame(rows, kind)).collect()), key=str)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]
    assert vectors.link(spark.createDataFrame([], kind)).count() == 0


def test_index_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(25):
        parts = [rng.integers(1, rng.integers(2, 6), rng.integers(1, 14)) for _ in range(rng.integers(1, 12))]
        weights = rng.integers(1, 3, len(parts))
        text = np.concatenate([np.append(p, 0) for p in parts])
        lengths = np.array([len(p) for p in parts])
        ends = np.cumsum(lengths + 1) - 1
        got = fmindex.Index(text, np.repeat(weights, lengths + 1)).matching(text, ends, lengths, 2)
        count = Counter()
        for p, w in zip(parts, weights, strict=True):
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    count[tuple(p[i:j])] += w
        for p, end in zip(parts, ends, strict=True):
            for i in range(len(p)):
                longest = max((k for k in range(1, len(p) - i + 1) if count[tuple(p[i : i + k])] > 1), default=0)
                assert got[end - len(p) + i] == longest


def brute_removals(rows, window=35):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        left = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [2000, 1])
def test_removals(docs, sample, monkeypatch, hot):
    """With ``hot`` = 1 every minimizer is dealt out window by window; shards are small in both cases."""
    monkeypatch.setattr(substrings, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 2000)
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(60)]
    rows = [(r["doc_id"], r["text"]) for r in sample.collect()]
    for i in range(30):
        mine = [f"m{i}_{j}" for j in range(rng.randrange(0, 90))]
        cut = rng.randrange(0, 20)
        rows.append((9000 + i, " ".join(mine[:40] + passage[cut : cut + 38 + i % 5] + mine[40:])))
    rows += [(9100, "and " * 300), (9101, " ".join(passage[:34])), (9102, None), (9103, ""), (9103, "x " * 34)]
    rows += [(9104, " ".join(f"u{i}" for i in range(80))), (9104, " ".join(f"u{i}" for i in range(80)))]
    rows += [(9105, " ".join(["loop"] + [f"c{i}" for i in range(40)] * 3)), (None, " ".join(passage))]
    got = sorted((tuple(r) for r in substrings.removals(docs(rows)).collect()), key=str)
    assert got == brute_removals(rows)


def test_removals_on_odd_tables(docs):
    assert substrings.removals(docs([])).count() == 0
    df = docs([(1, None), (2, "a b")]).withColumnsRenamed({"lang": "ka", "source": "key"})
    assert sorted(r["n_words"] for r in substrings.removals(df).collect()) == [0, 2]


def test_texts_without_repeats(docs):
    shared = " ".join(f"s{i}" for i in range(40))
    df = docs([(1, f"a  b {shared}"), (2, f"{shared}\nc"), (3, "d  e"), (4, None)]).withColumnRenamed("lang", "kept")
    out = {r["doc_id"]: r["text"] for r in substrings.without_repeats(df).collect()}
    assert out == {1: "a b", 2: "c", 3: "d  e", 4: None}
