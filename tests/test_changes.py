"""Change application on hand-written feeds: ties, late rows, repeats, deletes, nulls, hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from feedweir.operators import changes as C
from feedweir.operators.ordering import block_of, opening_rows, with_nearest, with_neighbour, with_ordinal, with_running_total


def feed(spark, data):
    return spark.createDataFrame(data, "k string, seq bigint, v string")


def test_scd1_ties_late_and_deletes(spark, rows):
    up = feed(spark, [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "late"), ("b", 1, "x"), ("c", 5, "x"), (None, 1, "n")])
    gone = spark.createDataFrame([("b", 1), ("c", 4)], "k string, seq bigint")
    assert rows(C.scd1(up, ["k"], "seq", deletes=gone)) == [("a", 3, "y"), ("c", 5, "x"), (None, 1, "n")]


def test_scd1_same_sequence_is_deterministic(spark, rows):
    data = [("a", 1, v) for v in "pqrs"]
    first = rows(C.scd1(feed(spark, data), ["k"], "seq"))
    assert first == rows(C.scd1(feed(spark, data[::-1]).repartition(3), ["k"], "seq"))
    assert rows(C.scd1(feed(spark, data), ["k"], "seq", tiebreak=["v"])) == [("a", 1, "s")]


def expected_history(data, gone):
    out = []
    events = {}
    for k, seq, v in data:
        events[(k, seq)] = v
    for k, seq in gone:
        events[(k, seq)] = None
    for key in {k for k, _ in events}:
        current, start = None, None
        for seq, v in sorted((s, v) for (k, s), v in events.items() if k == key):
            if v == current:
                continue
            if current is not None:
                out.append((key, current, start, seq))
            current, start = v, seq
        if current is not None:
            out.append((key, current, start, None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_scd2_equals_sequential_replay(spark, width):
    rng = random.Random(width or 0)
    # One key holds most rows, so its versions spread over many blocks.
    data = list({("hot" if rng.random() < 0.7 else rng.choice("abc"), s): rng.choice("xyz") for s in rng.choices(range(200), k=300)}.items())
    data = [(k, s, v) for (k, s), v in data]
    used = {(k, s) for k, s, _ in data}
    gone = [(k, s) for k in ("hot", "a") for s in range(0, 210, 9) if (k, s) not in used]
    up, deletes = feed(spark, data), spark.createDataFrame(gone, "k string, seq bigint")
    split = None if width is None else block_of(up, "seq", width)
    found = C.scd2(up, ["k"], "seq", deletes=deletes, split=split).select("k", "v", C.START, C.END)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected_history(data, gone)


def test_scd2_tracks_only_named_columns(spark, rows):
    df = spark.createDataFrame([("a", 1, "x", 1), ("a", 2, "x", 2), ("a", 3, "y", 3)], "k string, seq int, v string, n int")
    found = C.scd2(df, ["k"], "seq", track=["v"]).select("v", "n", C.START, C.END)
    assert rows(found) == [("x", 1, 1, 3), ("y", 3, 3, None)]


def test_delete_before_anything_opens_nothing(spark, rows):
    gone = spark.createDataFrame([("a", 1), ("a", 5), ("a", 6)], "k string, seq bigint")
    found = C.scd2(feed(spark, [("a", 2, "x")]), ["k"], "seq", deletes=gone).select(C.START, C.END)
    assert rows(found) == [(2, 5)]


def test_snapshot_diff_and_history(spark, rows):
    def snap(data):
        return spark.createDataFrame(data, "k int, v string")

    a, b, c = snap([(1, "x"), (2, None), (3, "z")]), snap([(1, "x"), (2, "n"), (4, "w")]), snap([(1, "x"), (2, "n"), (3, "z")])
    assert rows(C.snapshot_diff(a, b, ["k"])) == [(1, "x", "unchanged"), (2, "n", "update"), (3, "z", "delete"), (4, "w", "insert")]
    assert rows(C.apply_snapshot(a, b, ["k"]).drop("_change")) == rows(b)
    history = rows(C.apply_snapshots_scd2([(10, a), (20, b), (30, c)], ["k"]))
    assert history == sorted(
        [(1, "x", 10, None), (2, None, 10, 20), (2, "n", 20, None), (3, "z", 10, 20), (3, "z", 30, None), (4, "w", 20, 30)], key=repr
    )
    step = a.withColumns({C.START: F.lit(10), C.END: F.lit(None).cast("int")})
    for version, snapshot in ((20, b), (30, c)):
        step = C.extend_history(step, snapshot, ["k"], version)
    assert rows(step) == history


def test_keyless_tombstone_fails(spark):
    df = spark.createDataFrame([("a", 1, False), (None, 2, True)], "k string, seq int, gone boolean")
    with pytest.raises(Exception, match="tombstone without key"):
        C.apply_tombstones(df, ["k"], "seq", "gone").collect()


def test_distinct_deletes(spark, rows):
    data = [(7, 1, [("m1", "t1"), (None, "t9")]), (8, 2, [("m1", "t1"), ("m2", "t1")])]
    df = spark.createDataFrame(data, "history_id int, position int, deleted array<struct<id:string,thread_id:string>>")
    assert rows(C.distinct_deletes(df, "messages")) == [("m1", "t1", 7), ("m2", "t1", 8)]
    assert rows(C.distinct_deletes(df, "threads")) == [("t1", 7)]


def test_cluster_columns():
    assert C.cluster_columns(["a"]) == ["a"]
    assert C.cluster_columns('["a", "b"]') == ["a", "b"]
    assert C.cluster_columns("a, b") == ["a", "b"]
    assert C.cluster_columns("a") == ["a"]
    assert C.cluster_columns(" ") is None and C.cluster_columns(None) is None


# ---------------------------------------------------------------- ordered helpers


@pytest.mark.parametrize("ahead", [False, True])
def test_split_gives_the_same_as_one_window(spark, rows, ahead):
    rng = random.Random(3)
    data = [(rng.choice(["hot"] * 6 + ["a", None]), i, rng.choice([None, 1.0, 2.0])) for i in range(120)]
    df = spark.createDataFrame(data, "k string, t bigint, v double")
    split, value = block_of(df, "t", 11), F.struct("t", "v")
    one = with_neighbour(df, ["k"], ["t"], value, "n", ahead)
    many = with_neighbour(df, ["k"], ["t"], value, "n", ahead, split)
    assert rows(one) == rows(many)
    some = F.when(F.col("v").isNotNull(), value)
    assert rows(with_nearest(df, ["k"], ["t"], some, "n", ahead)) == rows(with_nearest(df, ["k"], ["t"], some, "n", ahead, split))


def test_opening_rows_split(spark, rows):
    rng = random.Random(5)
    df = spark.createDataFrame([(rng.choice(["hot", "hot", None]), i, rng.randint(0, 2)) for i in range(150)] + [("hot", None, 7)], "k string, t bigint, v int")

    def opens(was, now):
        return was.isNull() | (was["v"] != now["v"])

    value = F.struct("t", "v")
    assert rows(opening_rows(df, ["k"], ["t"], value, opens)) == rows(
        opening_rows(df, ["k"], ["t"], value, opens, block_of(df, "t", 4))
    )


def test_ordinal_and_running_total(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("x")).repartition(7)
    numbered = with_ordinal(df, ["x"], "n").collect()
    assert all(r["n"] == r["x"] + 1 for r in numbered) and len(numbered) == 500
    total = with_running_total(df, ["x"], "x", "s").collect()
    assert all(r["s"] == r["x"] * (r["x"] + 1) / 2 for r in total)
