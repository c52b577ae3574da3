"""Incremental slices: no loss, no repeat, tie groups whole, state that settles."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedweir.functions import cursors as K
from feedweir.operators import slicing as S
from feedweir.operators.checks import slices_equal_table


def ticks(spark, n=200, spread=40, seed=1):
    rng = random.Random(seed)
    return spark.createDataFrame([(i, rng.randint(0, spread)) for i in range(n)], "id bigint, c bigint")


def run_until_stable(step):
    state, parts = None, []
    for _ in range(200):
        part, after = step(state)
        if part.isEmpty():
            return parts
        parts.append(part)
        assert after != state
        state = after
    raise AssertionError("never settles")


def balance(parts, df):
    found = slices_equal_table(parts, df).first()
    return found["lost"], found["added"]


def test_trim_loop_loses_nothing(spark):
    df = ticks(spark)

    def step(since):
        part, state = S.batch_trim(S.slice_after(df, "c", since), "c", 30)
        return part, state.first()["cursor"]

    assert balance(run_until_stable(step), df) == (0, 0)


def test_soft_loop_loses_nothing(spark):
    df = ticks(spark)

    def step(since):
        part, state = S.batch_soft(S.slice_after(df, "c", since), "c", 30)
        return part, state.first()["cursor"]

    assert balance(run_until_stable(step), df) == (0, 0)


def test_keyset_loop_loses_nothing(spark):
    df = ticks(spark)

    def step(after):
        part, state = S.batch_keyset(df, "c", "id", 37, after)
        last = state.first()
        return part, (last["cursor"], last["tiebreak"])

    assert balance(run_until_stable(step), df) == (0, 0)


def test_trim_takes_a_large_tie_group_whole(spark):
    df = spark.range(20).select("id", F.when(F.col("id") < 15, 1).otherwise(2).alias("c"))
    assert S.batch_trim(df, "c", 20)[0].count() == 20
    rows, state = S.batch_trim(df, "c", 10)
    assert rows.count() == 15 and state.first()["cursor"] == 1
    assert S.batch_trim(S.slice_after(df, "c", 1), "c", 10)[0].count() == 5


def test_capped_window_passes_a_tie_at_its_start(spark):
    day = dt.datetime(2024, 1, 1)
    data = [(i, day) for i in range(10)] + [(10, day + dt.timedelta(hours=1))]
    df = spark.createDataFrame(data, "id int, ts timestamp_ntz")
    end = day + dt.timedelta(days=2)
    rows, state = S.slice_window(df, "ts", day, 86_400, end, cap=5)
    assert rows.count() == 10 and state.first()["cursor"] == day
    rows, state = S.slice_window(df, "ts", day, 86_400, end, cap=5, closed=False)
    assert [r["id"] for r in rows.collect()] == [10] and state.first()["cursor"] == day + dt.timedelta(days=1)


def test_null_groups_and_whole_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4), (2, 5)], "g int, id int")
    rows, state = S.batch_groups(df, "g", 1)
    assert sorted(r["id"] for r in rows.collect()) == [1, 2, 3, 4] and state.first()["cursor"] == 1
    rows, state = S.batch_by_group(df, "g", 1, after=1)
    assert [r["id"] for r in rows.collect()] == [5] and state.first()["cursor"] == 2
    assert S.batch_by_group(df, "g", 1, after=2)[1].first()["cursor"] is None


def test_empty_day_chunk_keeps_its_start(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz")
    assert S.day_chunks(df, "ts", dt.date(2024, 1, 2), 10)[1].first()["start_date"] == dt.date(2024, 1, 2)


def test_keyset_null_tiebreak_fails(spark):
    df = spark.createDataFrame([(None, 1)], "id bigint, c bigint")
    with pytest.raises(Exception, match="cannot be resumed"):
        S.batch_keyset(df, "c", "id", 5)[0].collect()
    with pytest.raises(ValueError):
        S.batch_keyset(df, "c", "", 5)


def test_pinned_pages_loop(spark):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, start + dt.timedelta(minutes=i // 3)) for i in range(100)], "id bigint, ts timestamp_ntz")
    run_start, state, parts = start + dt.timedelta(hours=2), {}, []
    for _ in range(20):
        part, after = S.page_pinned(df, "ts", "id", state, run_start, limit=10, cap=25)
        if after == state:
            break
        parts.append(part)
        state = after
    assert state == {"cursor": run_start} and balance(parts, df) == (0, 0)


def test_groups_and_windows_loop(spark):
    start = dt.datetime(2024, 1, 1)
    rng = random.Random(2)
    data = [(i, start + dt.timedelta(minutes=rng.randint(0, 3000))) for i in range(120)]
    df = spark.createDataFrame(data, "id bigint, ts timestamp_ntz")
    end = start + dt.timedelta(minutes=3001)
    at, parts = start, []
    while at < end:
        part, state = S.compact_windows(df, "ts", at, 3600, 15, end)
        parts.append(part)
        at = state.first()["cursor"]
    assert balance(parts, df) == (0, 0)


def test_window_slice_moves_over_empty_windows(spark):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, start + dt.timedelta(days=3))], "id int, ts timestamp_ntz")
    part, state = S.slice_window(df, "ts", start, 86_400, start + dt.timedelta(days=9))
    assert part.isEmpty() and state.first()["cursor"] == start + dt.timedelta(days=1)


def test_bounds():
    noon = dt.datetime(2024, 1, 2, 12)
    hours = S.hourly_bounds(dt.datetime(2024, 1, 1), noon, 24)
    assert (hours.end, hours.following) == (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 1))
    assert S.hourly_bounds(noon, noon) is None
    day = dt.date(2024, 1, 10)
    assert S.daily_bounds(dt.date(2024, 1, 1), day, 7).end == dt.date(2024, 1, 7)
    last = S.daily_bounds(dt.date(2024, 1, 8), day, 7)
    assert (last.end, last.following) == (day, day)
    assert S.daily_bounds(day, day) is None and S.daily_bounds(day, day, forward_days=3).end == dt.date(2024, 1, 13)


def test_windows_partition_the_range(spark):
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8)
    found = [tuple(r) for r in S.windows(spark, start, end, dt.timedelta(days=3)).orderBy("since").collect()]
    assert found[0][0] == start and found[-1][1] == end and all(a[1] == b[0] for a, b in zip(found, found[1:]))
    assert S.windows(spark, None, end, dt.timedelta(days=3)).first()["since"] is None
    assert S.windows(spark, end, end, dt.timedelta(days=3)).isEmpty()


def test_auto_lookback(spark):
    def seconds(values):
        df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "run int, seconds double")
        return S.auto_lookback(df).first()["seconds"]

    assert seconds([]) == 0.0
    assert seconds([99.0, 1, 2, 3, 4, 0.2]) == 6.0
    assert seconds([float("nan"), -5.0, float("inf")]) == 0.0
    assert seconds([9000.0]) == 3600.0


def test_run_start_ceiling_without_rows(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 1),)], "c timestamp_ntz")
    assert S.cap_at_run_start(df, "c", dt.datetime(2024, 1, 1))[1].first()["cursor"] is None
    before = dt.datetime(2023, 1, 1)
    assert S.cap_at_run_start(df, "c", dt.datetime(2024, 1, 1), before)[1].first()["cursor"] == before


def test_lookback_dedup(spark, rows):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, v string, c int")
    _, seen = S.drop_delivered(old, None, ["id"], "c")
    new = spark.createDataFrame([(1, "a", 1), (2, "changed", 2), (3, "c", 3)], "id int, v string, c int")
    fresh, after = S.drop_delivered(new, seen, ["id"], "c", cap=2)
    assert rows(fresh) == [(2, "changed", 2), (3, "c", 3)]
    assert rows(after.select("row_key")) == [('["2"]',), ('["3"]',)]


def test_null_cursor_policies(spark):
    df = spark.createDataFrame([(1, None), (2, dt.datetime(2024, 1, 1))], "id int, c timestamp_ntz")
    floored = S.null_cursor(df, "c", ["id"]).orderBy("id").collect()
    assert floored[0]["c"].year == 2000 and floored[0]["c"] < dt.datetime(2000, 1, 1, 0, 0, 1)
    assert S.null_cursor(df, "c", policy="ignore").count() == 1
    with pytest.raises(Exception, match="null cursor"):
        S.null_cursor(df, "c", policy="error").collect()
    with pytest.raises(ValueError):
        S.null_cursor(df.withColumn("c", F.lit(True)), "c", ["id"])


def test_cursor_order(spark):
    texts = ["2024-01-01T00:00:00.5Z", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.1234567Z", "2024-01-01T00:00:00.1234561Z",
             "2024-01-01T01:00:00+02:00", "1000", "999", "9007199254740993", "9007199254740992"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ordered = [r["t"] for r in df.orderBy(K.cursor_key(F.col("t"))).collect()]
    assert ordered == ["2024-01-01T01:00:00+02:00", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.1234561Z", "2024-01-01T00:00:00.1234567Z",
                       "2024-01-01T00:00:00.5Z", "999", "1000", "9007199254740992", "9007199254740993"]


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("2024-01-01T00:00:00Z", "2024-01-01T00:00:00.000+00:00", True),
        ("2024-01-01T00:00:00.1234567Z", "2024-01-01T00:00:00.1234561Z", False),
        ("5000", "5000.0", True),
        ("abc", "abc", True),
        ("20240101", "2024-01-01", False),
    ],
)
def test_same_instant(spark, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(K.same_instant(F.col("a"), F.col("b")).alias("s")).first()["s"] is same


def test_filter_ignored_is_an_error(spark):
    df = ticks(spark)
    assert S.assert_filter_honored(df, F.col("c"), 1).count() == df.count()
    with pytest.raises(Exception, match="200 rows came back but none is newer than 1000"):
        S.assert_filter_honored(df, F.col("c"), 1000).count()


def test_state_rules(spark):
    assert S.progress_view({"cursor": 1, "lb_seen": 2}) == {"cursor": 1}
    start, day = dt.datetime(2024, 1, 1, 0, 0, 0, 5), dt.timedelta(days=1)
    assert S.start_of(None, None, start, start) == dt.datetime(2023, 12, 31, 23, 59, 59)
    assert S.start_of(start, None, None, start) == start
    assert S.start_of(None, None, None, start, 2) == start - 2 * day
    assert S.start_of(None, None, None, start) is None


def test_split_and_pack(spark):
    df = spark.range(9)
    parts = [r["part"] for r in S.split_even(df, 4, ["id"]).orderBy("id").collect()]
    assert parts == [0, 0, 0, 1, 1, 2, 2, 3, 3]
    assert S.split_even(spark.range(2), 5, ["id"]).agg(F.max("part")).first()[0] == 1
    bins = S.pack(spark.range(100).withColumn("w", F.col("id") % 7), "w", 5, ["id"])
    loads = [r["s"] for r in bins.groupBy("bin").agg(F.sum(F.greatest("w", F.lit(1))).alias("s")).collect()]
    assert len(loads) == 5 and max(loads) - min(loads) <= 12


@pytest.mark.parametrize("seed", range(5))
def test_least_loaded_plan_equals_one_by_one(seed):
    rng = random.Random(seed)
    n = rng.randint(1, 7)
    weights = [rng.choice([1, 2, 3, 5, 8, 50, 1000, rng.randint(1, 400)]) for _ in range(300)]
    counts = {w: weights.count(w) for w in weights}
    loads, want = [0] * n, []
    for w in sorted(weights, reverse=True):
        best = min(range(n), key=lambda b: (loads[b], b))
        loads[best] += w
        want.append((w, best))
    got = []
    for w, first, past, bins in S.least_loaded_plan(list(counts.items()), n):
        got += [(w, bins[i % len(bins)]) for i in range(past - first)]
    assert got == want


def test_pack_least_loaded(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate([7, None, 3, 3, 0, 9, -2, 3, 123_456, 99_999])], "id int, w int")
    found = {r["id"]: r["bin"] for r in S.pack_least_loaded(df, "w", 3, ["id"]).collect()}
    assert found == {8: 0, 9: 1, 5: 2, 0: 2, 2: 2, 3: 2, 7: 2, 1: 2, 4: 2, 6: 2}
    rounded = df.select("id", S.rounded_weight(F.col("w"), 2).alias("w"))
    assert {r["id"]: r["w"] for r in rounded.collect()}[8] == 130_000
    assert S.pack_least_loaded(df.limit(0), "w", 3, ["id"]).count() == 0


def test_sorted_pages(spark, tmp_path):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("n"), "id")
    held = S.sorted_files(df.repartition(4), ["n", "id"], str(tmp_path / "p"))
    assert held.total == 1000
    for offset, limit in ((0, 10), (995, 10), (333, 400), (-5, 3)):
        got = [r["n"] for r in held.page(spark, offset, limit).collect()]
        assert got == list(range(1000))[max(offset, 0) : max(offset, 0) + limit]
    assert held.page(spark, 1000, 5) is None and held.page(spark, 3, 0) is None
    start = dt.datetime(2024, 1, 1)
    timed = df.select("id", F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.col("n") % 28 + 1).cast("int"), F.lit(0), F.lit(0), F.lit(0)).alias("ts"))
    parts = list(S.drain_pinned(timed, "ts", "id", start + dt.timedelta(days=9), start + dt.timedelta(days=2), 70, str(tmp_path / "q")))
    want = timed.filter("ts between '2024-01-03' and '2024-01-10'")
    assert all(p.count() == 70 for p in parts[:-1]) and balance(parts, want) == (0, 0)


def test_all_pages_in_one_scan(spark, tmp_path):
    """Every page as ``page`` reads it, empty files and equal rows among them, and one plan for any number of pages."""
    df = spark.range(900).select((F.col("id") * 7919 % 300).alias("n"), (F.col("id") % 7).alias("k"))
    held = S.sorted_files(df.repartition(5), ["n", "k"], str(tmp_path / "p"))
    for size in (1, 7, 900, 5000):
        found = held.pages(spark, size)
        got = sorted((r["page"], r["n"], r["k"]) for r in found.collect())
        want = sorted((r["n"], r["k"]) for r in df.collect())
        assert got == [(i // size, *row) for i, row in enumerate(want)]
    assert {f for f, _ in held.files} == {r["file"] for r in found.select("file").distinct().collect()}
    one = held.pages(spark, 7).where("page = 3").select("n", "k")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, held.page(spark, 21, 7).collect()))
    assert S.sorted_files(df.limit(0), ["n", "k"], str(tmp_path / "q")).pages(spark, 7) is None
