"""Packing, mixing, running sums and the pipeline against brute force."""

import itertools
import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedweir.llm import mixing, packing, sketches
from feedweir.llm.ranking import running

SIZES = (8, 16, 32)


def test_running_sums(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id % 5 as string) end as g", "id % 7 as s")
    got = running(df, ["g"], [F.col("id")], F.col("s"), "before", rows=200_000).orderBy("g", "before", "id").collect()
    total = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["g"], r["before"], r["s"] > 0)):
        assert r["before"] == total[r["g"]]
        total[r["g"]] += r["s"]
    assert len(got) == 3000


def one_by_one(lengths, sizes, least, largest):
    """Best fit with one bin at a time: contents of every bin."""
    bins = []
    for x in sorted(lengths, reverse=True):
        fitting = [b for b in bins if b[0] - sum(b[1]) >= x]
        if fitting:
            best = min(fitting, key=lambda b: (b[0] - sum(b[1]), b[0]))
        else:
            fits = [s for s in sizes if s >= x]
            allowed = [s for s in fits if least <= s <= largest] or fits[:1]
            best = (min(allowed, key=lambda s: (packing.cost(s) / s, s)), [])
            bins.append(best)
        best[1].append(x)
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_one_bin_at_a_time(seed):
    counts = {i: (i * 7919 + seed * 31) % 9 for i in range(1, 33)}
    counts = {k: v for k, v in counts.items() if v}
    lengths = [k for k, v in counts.items() for _ in range(v)]
    for least, largest in itertools.combinations_with_replacement(SIZES, 2):
        plan = packing.plan_with(counts, SIZES, least, largest)
        bins = one_by_one(lengths, SIZES, least, largest)
        assert sum(b.count for b in plan.bins) == len(bins)
        assert sorted(b.used for b in plan.bins for _ in range(b.count)) == sorted(sum(b[1]) for b in bins)
        small = [next(s for s in SIZES if s >= sum(b[1])) for b in bins]
        assert abs(plan.cost - sum(map(packing.cost, small))) < 1e-6
    assert packing.best_plan(counts, SIZES).cost <= packing.plan_with(counts, SIZES, 32, 32).cost


def test_pack(docs):
    rows = [(i, "w " * (i * 13 % 45)) for i in range(200)] + [(500, "w " * 333), (501, None), (502, ""), (7, "w " * 5), (None, "w")]
    df = docs(rows).withColumn("tokens", F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), " "), "")))
    df = df.withColumns({"offset": F.lit("x"), "_plan_bin": F.lit(1), "_rank": F.lit(2)})
    out = packing.pack(df, F.col("tokens"), SIZES).collect()
    tokens = Counter()
    for r in out:
        tokens[r["doc_id"]] += r["length"]
        assert r["start"] == r["piece"] * 32 and r["_plan_bin"] == 1
    expected = Counter()
    for d, t in rows:
        expected[d] += len((t or "").split())
    assert +tokens == +expected and set(tokens) == set(expected)
    bins = defaultdict(list)
    for r in out:
        if r["length"]:
            bins[r["bin_id"]].append(r)
        else:
            assert r["bin_id"] is None and r["bin_size"] is None
    for inside in bins.values():
        inside.sort(key=lambda r: r["offset"])
        at = 0
        for r in inside:
            assert r["offset"] == at
            at += r["length"]
        assert {r["bin_size"] for r in inside} == {next(s for s in SIZES if s >= at)}
    assert packing.pack(docs([]).withColumn("tokens", F.lit(1)), F.col("tokens")).count() == 0


def slots_of(stretches):
    slot = {}
    for s in stretches:
        for j in range(s.first, s.end):
            turn, k = divmod(j - s.first, len(s.slots))
            assert slot.setdefault(s.start + turn * s.period + s.slots[k], (s.source, j))[1] == j
    return slot


def test_schedule_is_less_than_a_block_off():
    """Every block has one slot; less than one block off until a source runs out, less than two over the whole mix."""
    rng = random.Random(6)
    mixes = [({0: 12, 1: 4, 2: 7, 3: 1}, b) for b in ({0: 40, 1: 40, 2: 5, 3: 9}, {0: 1, 1: 0, 2: 300, 3: 2}, {2: 4})]
    for _ in range(150):
        n = rng.randint(1, 12)
        mixes.append(({s: rng.randint(1, 9) for s in range(n)}, {s: rng.randint(0, 60) for s in range(n)}))
    for weights, blocks in mixes:
        slot = slots_of(mixing.schedule(weights, blocks))
        assert sorted(slot) == list(range(sum(blocks.values())))
        assert Counter(s for s, _ in slot.values()) == Counter({s: n for s, n in blocks.items() if n})
        left, share, given, ran_out = {s: n for s, n in blocks.items() if n}, Counter(), Counter(), False
        for t in range(len(slot)):
            total = sum(weights[s] for s in left)
            for s in left:
                share[s] += Fraction(weights[s], total)
            s = slot[t][0]
            given[s] += 1
            for other in left:
                assert abs(share[other] - given[other]) < (2 if ran_out else 1)
            left[s] -= 1
            if not left[s]:
                # what the source leaves is shared out by weight
                over, ran_out = share[s] - given[s], True
                del left[s]
                for other in left:
                    share[other] += over * Fraction(weights[other], sum(weights[o] for o in left))


def test_schedule_does_not_grow_with_the_blocks():
    weights = {s: s % 4 + 1 for s in range(12)}
    sizes = [len(mixing.schedule(weights, {s: n * (s + 3) for s in weights})) for n in (100, 1_000_000)]
    assert sizes[1] <= 1.2 * sizes[0]


def test_mix(docs):
    rows = [(i, "x" * (i % 50), "en", ["a", "b", None, "zz"][min(3, i % 6)], 1) for i in range(600)]
    rows += [(1000, "y" * 900, "en", "b", 1), (1001, None, "en", "a", 1), (1001, None, "en", "a", 1)]
    df = docs(rows).withColumns({"slot": F.lit("s"), "_plan_end": F.lit(1), "_source": F.lit(2)})
    out = mixing.mix(df, {"a": 3, "b": 2, None: 1}, F.char_length("text"), 100).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows) and all(r["_source"] == 2 for r in out)
    for part in ("a", "b", None):
        mine = sorted((r for r in out if (r["source"] if r["source"] in ("a", "b") else None) == part), key=lambda r: r["at"])
        sizes = sum(len(r["text"] or "") for r in mine)
        last = max(1, -(-sizes // 100)) - 1
        assert all(r["block"] == min(r["at"] // 100, last) for r in mine)
        assert [r["slot"] for r in mine] == sorted(r["slot"] for r in mine)
    owner = defaultdict(set)
    for r in out:
        owner[r["slot"]].add(r["source"] if r["source"] in ("a", "b") else None)
    assert all(len(x) == 1 for x in owner.values())
    assert mixing.mix(docs([]), {None: 1}, F.char_length("text"), 100).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df, {"a": 0}, F.lit(1), 1)


def test_pipeline(spark, tmp_path, sample):
    extra = [(900, None, "en", "src1", 0), (901, "12 34", "en", "src1", 5), (902, "mail Ann.Lee99@mail6.example.com now", "en", None, 36)]
    docs = sample.unionByName(spark.createDataFrame(extra, sample.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    before, now = {}, spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before[name] = now
        now = stage(spark, now, str(tmp_path))
        if name != "packing":
            assert now.columns == docs.columns
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
    gone = before["language_id"].select("doc_id").subtract(before["near_duplicates"].select("doc_id"))
    assert {r[0] for r in gone.collect()} == {900, 901}
    kept = sketches.link(before["near_duplicates"], corpus_pipeline.SHINGLE).where("kept").select("doc_id")
    assert sorted(kept.collect()) == sorted(before["personal_data"].select("doc_id").collect())
    texts = {r["doc_id"]: r for r in before["mixture"].collect()}
    assert "Ann.Lee99" not in texts[902]["text"] and all(r["n_chars"] == len(r["text"]) for r in texts.values())
    same = before["packing"].exceptAll(before["mixture"]).count() + before["mixture"].exceptAll(before["packing"]).count()
    assert same == 0
    tokens = {r["doc_id"]: r["n"] for r in now.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert tokens == {d: len(r["text"].encode().split()) for d, r in texts.items()}
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == now.columns and result.select("doc_id").distinct().count() == len(texts)


def test_pipeline_of_nothing(spark, tmp_path, sample):
    sample.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pack_within_ranges(docs):
    """Every range is packed as if it were alone, and its bins come after those of the ranges before it."""
    rows = [(i, "w " * (i * 13 % 45)) for i in range(200)] + [(500, "w " * 333), (501, None), (None, "w")]
    df = docs(rows).withColumn("tokens", F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), " "), "")))
    df = df.withColumns({"g": F.col("doc_id") % 5 * 1000, "_range": F.lit("x")})
    out = packing.pack(df, F.col("tokens"), SIZES, within=F.col("g")).collect()
    assert all(r["_range"] == "x" for r in out)
    tokens, bins = Counter(), defaultdict(list)
    for r in out:
        tokens[r["doc_id"]] += r["length"]
        if r["length"]:
            bins[r["bin_id"]].append(r)
    assert tokens == Counter({d: len((t or "").split()) for d, t in rows}) and sorted(bins) == list(range(len(bins)))
    for b, inside in bins.items():
        inside.sort(key=lambda r: r["offset"])
        ends = list(itertools.accumulate(r["length"] for r in inside))
        assert [r["offset"] for r in inside] == [0, *ends[:-1]]
        assert {r["bin_size"] for r in inside} == {next(s for s in SIZES if s >= ends[-1])}
    owners = [{r["g"] or 0 for r in bins[b]} for b in sorted(bins)]
    assert all(len(x) == 1 for x in owners)
    order = [x.pop() for x in owners]
    assert order == sorted(order)
    for g, count in Counter(order).items():
        lengths = Counter(r["length"] for r in out if (r["g"] or 0) == g and r["length"])
        assert count == sum(b.count for b in packing.best_plan(lengths, SIZES).bins)


def test_bins_follow_the_mix(spark, docs, tmp_path, monkeypatch):
    """Source shares of every prefix of bins, and the bins of ``run`` against a plain mix of the documents."""
    weights, block, span = {"a": 3, "b": 1, None: 1}, 200, 5
    monkeypatch.setattr(corpus_pipeline, "MIX_WEIGHTS", weights)
    monkeypatch.setattr(corpus_pipeline, "MIX_BLOCK", block)
    monkeypatch.setattr(corpus_pipeline, "MIX_RANGE", span)
    keep = [s for s in corpus_pipeline.STAGES if s[0] in ("mixture", "packing")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", keep)
    # a third of the rows each, so that the mix is far from the table; "c" documents are the longest
    rows = [(i, "w " * (5 + i % 7 + 20 * (i % 3 == 2)), "en", "abc"[i % 3], 1) for i in range(900)]
    df = docs(rows)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter({r["doc_id"]: r["length"] for r in out}) == Counter({d: len(t.split()) for d, t, *_ in rows})

    hashes = {r[0]: r[1] for r in df.select("doc_id", F.xxhash64("doc_id", F.xxhash64("text"))).collect()}
    blocks = {}
    for k, source in enumerate("abc"):
        at, mine = 0, sorted((r for r in rows if r[3] == source), key=lambda r: hashes[r[0]])
        for d, t, *_ in mine:
            blocks[d] = (k, at // block)
            at += len(t)
    last = Counter()
    for k, j in blocks.values():
        last[k] = max(last[k], j + 1)
    slot = {}
    for s in mixing.schedule({0: 3, 1: 1, 2: 1}, dict(last)):
        for j in range(s.first, s.end):
            turn, i = divmod(j - s.first, len(s.slots))
            slot[s.source, j] = s.start + turn * s.period + s.slots[i]
    bins = defaultdict(set)
    for r in out:
        bins[r["bin_id"]].add(slot[blocks[r["doc_id"]]] // span)
    assert all(len(x) == 1 for x in bins.values())
    order = [bins[b].pop() for b in sorted(bins)]
    assert order == sorted(order) and len(set(order)) > 5

    # until the first source runs out, a prefix is off by the blocks of one range and the documents across its edge
    chars, got, until = {d: len(t) for d, t, *_ in rows}, Counter(), min(max(s for (k, _), s in slot.items() if k == x) for x in range(3))
    for r in sorted(out, key=lambda r: r["bin_id"]):
        if slot[blocks[r["doc_id"]]] // span >= until // span:
            break
        got[r["source"]] += chars[r["doc_id"]]
        for source, w in (("a", 3), ("b", 1), ("c", 1)):
            assert abs(got[source] - sum(got.values()) * w / 5) <= span * block + 100
    assert got["a"] > 2000
