"""Near-duplicate vectors by robust-pruned flat graphs on overlapping cluster shards.

Vectors are dealt to their nearest centroids, two each, so shards overlap. Every shard builds a flat graph; the lists
that a vector gets in its shards are united. Every vector then searches the graphs of its shards: a greedy search from
the medoids and from its own node, and from what lies in range outwards over the united lists. Cosines are confirmed in
double precision, and recall is audited against brute force.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweir.llm.common import components, settle

LEAST_COSINE = 0.98
# Bound of the fit: vectors that the centroids are fitted on, and centroids. Vectors per centroid that is aimed at.
SAMPLE = 8000
CENTROIDS = 1024
PER_CENTROID = 4000
OVERLAP = 2
# Vectors of a graph; a larger shard is dealt into several by hash, and its vectors search all of them.
SHARD = 3000
# Near and random neighbours of a node, candidates that are pruned to the near ones, and the pruning's slack.
NEAR, FAR, CANDIDATES, SLACK = 24, 8, 64, 1.2
BEAM = 32
# Cosine down to which a search goes on from what it has found.
RANGE = 0.97
# Queries of the audit, as many more until they have so many true links, at most so many; the recall below which the
# search is repeated with more effort, and the one below which there is no result.
AUDIT, AUDIT_LINKS, AUDIT_MOST = 128, 200, 2048
TARGET, LEAST_RECALL = 0.95, 0.9
# Values that a task gathers at once.
GATHERED = 1 << 22


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(r, np.float64) for r in rows])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centroids(x: np.ndarray, k: int, seed: int = 3) -> np.ndarray:
    """Spherical k-means on unit vectors."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(8):
        near = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.maximum(size, 1e-12), c)
    return c


def flat_graph(x: np.ndarray, seed: int = 5) -> list[np.ndarray]:
    """Neighbour lists of unit vectors: robust-pruned near ones, random ones, and who has chosen the node."""
    n = len(x)
    if n == 1:
        return [np.empty(0, np.int64)]
    rng = np.random.default_rng(seed)
    sims = (x @ x.T).astype(np.float32)
    np.fill_diagonal(sims, -2)
    width = min(CANDIDATES, n - 1)
    cand = np.argpartition(-sims, width - 1, axis=1)[:, :width]
    cand = np.take_along_axis(cand, np.argsort(-np.take_along_axis(sims, cand, axis=1), axis=1, kind="stable"), axis=1)
    far = 1 - np.take_along_axis(sims, cand, axis=1)
    alive = np.ones_like(cand, bool)
    rows = np.arange(n)
    picked = []
    for _ in range(min(NEAR, width)):
        first = np.argmax(alive, axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        node = np.where(some, cand[rows, first], -1)
        picked.append(node)
        # a candidate goes if the picked neighbour is clearly nearer to it than the node is
        between = 1 - sims[np.maximum(node, 0)[:, None], cand]
        alive &= ~((SLACK * between <= far) & some[:, None])
        alive[rows, first] = False
    near = np.stack(picked, axis=1)
    random = rng.integers(0, n, (n, min(FAR, n - 1)))
    a = np.repeat(rows, near.shape[1] + random.shape[1])
    b = np.concatenate([near, random], axis=1).ravel()
    real = (b >= 0) & (a != b)
    a, b = a[real], b[real]
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    owner, other = pairs // n, pairs % n
    return np.split(other, np.searchsorted(owner, np.arange(1, n)))


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    width = max(1, max(len(x) for x in lists))
    out = np.full((len(lists), width), -1, np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _dots(x: np.ndarray, y: np.ndarray, xi: np.ndarray, yi: np.ndarray) -> np.ndarray:
    """Inner products of the named pairs of rows, a bounded number of values at a time."""
    out = np.empty(len(xi))
    step = max(1, GATHERED // max(1, x.shape[1]))
    for at in range(0, len(xi), step):
        out[at : at + step] = np.einsum("ij,ij->i", x[xi[at : at + step]], y[yi[at : at + step]])
    return out


def search(x: np.ndarray, lists: list[np.ndarray], queries: np.ndarray, own: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, node) in range: greedy from the medoids and the query's own node (or -1), then outwards."""
    n, table = len(x), _padded(lists)
    mean = x.mean(axis=0)
    medoids = np.argsort(-(x @ mean))[: min(3, n)]
    seen = np.zeros((len(queries), n + 1), bool)  # the last column stands for no node
    beam = min(beam, n)
    q = np.arange(len(queries))
    ids = np.full((len(queries), beam + len(medoids) + 1), n, np.int64)
    ids[:, : len(medoids)] = medoids
    fresh = (own >= 0) & ~np.isin(own, medoids)
    ids[fresh, len(medoids)] = own[fresh]
    scores = np.where(ids < n, np.einsum("qd,qkd->qk", queries, x[np.minimum(ids, n - 1)]), -9.0)
    done = ids == n
    np.put_along_axis(seen, ids, True, axis=1)
    found_q, found_n = [], []

    def keep(qi: np.ndarray, ni: np.ndarray, s: np.ndarray) -> None:
        inside = s >= RANGE
        found_q.append(qi[inside])
        found_n.append(ni[inside])

    real = ids < n
    keep(np.broadcast_to(q[:, None], ids.shape)[real], ids[real], scores[real])
    active = q
    while len(active):
        open_scores = np.where(done[active], -9.0, scores[active])
        best = open_scores.argmax(axis=1)
        going = open_scores[np.arange(len(active)), best] > -9.0
        active, best = active[going], best[going]
        if not len(active):
            break
        done[active, best] = True
        near = table[ids[active, best]]
        near = np.where(near < 0, n, near)
        new = ~seen[active[:, None], near] & (near < n)
        seen[active[:, None], near] = True
        s = np.full(near.shape, -9.0)
        qi, ki = np.nonzero(new)
        s[qi, ki] = _dots(queries, x, active[qi], near[qi, ki])
        keep(active[qi], near[qi, ki], s[qi, ki])
        all_ids = np.concatenate([ids[active], np.where(new, near, n)], axis=1)
        all_scores = np.concatenate([scores[active], s], axis=1)
        all_done = np.concatenate([done[active], ~new], axis=1)
        top = np.argsort(-all_scores, axis=1, kind="stable")[:, : ids.shape[1]]
        top_scores = np.take_along_axis(all_scores, top, axis=1)
        ids[active] = np.take_along_axis(all_ids, top, axis=1)
        scores[active] = top_scores
        late = np.arange(ids.shape[1])[None, :] >= beam
        done[active] = np.take_along_axis(all_done, top, axis=1) | late | (top_scores <= -9.0)
    # outwards from everything in range, until nothing in range is new
    qi, ni = np.concatenate(found_q), np.concatenate(found_n)
    out_q, out_n = [qi], [ni]
    while len(qi):
        next_q, next_n = [], []
        step = max(1, GATHERED // table.shape[1])
        for part in range(0, len(qi), step):
            a, b = qi[part : part + step], ni[part : part + step]
            near = table[b]
            pair_q = np.broadcast_to(a[:, None], near.shape)[near >= 0]
            pair_n = near[near >= 0]
            new = ~seen[pair_q, pair_n]
            pairs = np.unique(pair_q[new] * n + pair_n[new])
            pair_q, pair_n = pairs // n, pairs % n
            seen[pair_q, pair_n] = True
            s = _dots(queries, x, pair_q, pair_n)
            next_q.append(pair_q[s >= RANGE])
            next_n.append(pair_n[s >= RANGE])
        qi, ni = np.concatenate(next_q), np.concatenate(next_n)
        out_q.append(qi)
        out_n.append(ni)
    return np.concatenate(out_q), np.concatenate(out_n)


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("rep").reset_index(drop=True)
    reps = shard["rep"].to_numpy()
    lists = flat_graph(_unit(shard["embedding"]))
    return pd.DataFrame({"rep": reps, "near": [reps[x] for x in lists]})


_FOUND = "rep long, n long, root long"


def _searcher(beam: int):
    def run(nodes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if nodes.empty or asked.empty:
            return pd.DataFrame({"rep": [], "n": [], "root": []}).astype("int64")
        asked = asked.rename(columns=lambda c: c.removeprefix("q_"))
        nodes = nodes.sort_values("rep").reset_index(drop=True)
        reps = nodes["rep"].to_numpy()
        place = pd.Series(np.arange(len(reps)), index=reps)
        x, y = _unit(nodes["embedding"]), _unit(asked["embedding"])
        lists = [place.reindex(near).dropna().to_numpy(np.int64) for near in nodes["near"]]
        own = place.reindex(asked["rep"]).fillna(-1).to_numpy(np.int64)
        qi, ni = search(x, lists, y, own, beam)
        a, b = np.stack(nodes["embedding"].to_numpy()).astype(np.float64), np.stack(asked["embedding"].to_numpy()).astype(np.float64)
        ask = asked["rep"].to_numpy()
        other = ask[qi] != reps[ni]
        qi, ni = qi[other], ni[other]
        dots = _dots(b, a, qi, ni)
        norms = np.linalg.norm(b, axis=1)[qi] * np.linalg.norm(a, axis=1)[ni]
        linked = dots / norms >= LEAST_COSINE
        qi, ni = qi[linked], ni[linked]
        # where the block searches itself, a pair that either side has found counts for both
        if len(ask) == len(reps) and np.array_equal(np.sort(ask), reps):
            at, back = np.searchsorted(reps, ask), np.argsort(ask)
            pairs = np.unique(np.concatenate([qi * len(reps) + ni, back[ni] * len(reps) + at[qi]]))
            qi, ni = pairs // len(reps), pairs % len(reps)
        # a pair is counted in the first of the query's clusters that the node is in too
        cluster = int(nodes["cluster"].iloc[0])
        mine = np.stack(asked["clusters"].to_numpy())
        theirs = np.stack(nodes["clusters"].to_numpy())
        order = (mine == cluster).argmax(axis=1)
        counted = np.ones(len(qi), bool)
        for earlier in range(mine.shape[1] - 1):
            shared = (theirs[ni] == mine[qi, earlier][:, None]).any(axis=1)
            counted &= ~((order[qi] > earlier) & shared)
        n = np.bincount(qi, weights=nodes["weight"].to_numpy()[ni] * counted, minlength=len(ask))
        # smallest vector that the links of this shard reach
        everyone = np.unique(np.concatenate([ask, reps]))
        ia, ib = np.searchsorted(everyone, ask[qi]), np.searchsorted(everyone, reps[ni])
        label = np.arange(len(everyone))
        while True:
            before = label.copy()
            np.minimum.at(label, ia, label[ib])
            np.minimum.at(label, ib, label[ia])
            label = label[label]
            if (label == before).all():
                break
        roots = everyone[label[np.searchsorted(everyone, ask)]]
        return pd.DataFrame({"rep": ask, "n": n.astype(np.int64), "root": roots})

    return run


def _dealt(classes: DataFrame, centre: np.ndarray | None, overlap: int) -> DataFrame:
    """Classes with the numbers of their nearest centroids."""
    if centre is None:
        return classes.withColumn("clusters", F.array(F.lit(0)))
    width = min(overlap, len(centre))

    @F.pandas_udf("array<int>")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = np.zeros((len(batch), width), np.int32)
            fits = np.array([len(v) == centre.shape[1] for v in batch], bool)
            if fits.any():
                s = _unit(batch[fits]) @ centre.T
                out[fits] = np.argsort(-s, axis=1, kind="stable")[:, :width]
            # vectors of another length are never compared with these: one cluster of their own
            out[~fits] = np.arange(width)
            yield pd.Series(list(out))

    return classes.withColumn("clusters", nearest("embedding"))


def _search_all(classes: DataFrame, centre: np.ndarray | None, overlap: int, beam: int) -> DataFrame:
    """Rows (rep, n, root): per class and shard the weight of its links and the smallest class that they reach."""
    shard = ["label", "dim", "cluster"]
    placed = settle(_dealt(classes, centre, overlap).withColumn("cluster", F.explode("clusters")))
    sizes = placed.groupBy(*shard).agg(F.ceil(F.count("*") / SHARD).cast("int").alias("subs"))
    placed = placed.join(sizes, shard).withColumn("sub", F.pmod(F.xxhash64("rep"), F.col("subs")).cast("int"))
    built = placed.groupBy(*shard, "sub").applyInPandas(_build, "rep long, near array<long>")
    united = settle(built.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    every = F.sequence(F.lit(0), F.col("subs") - 1)
    nodes = placed.join(united, "rep").withColumn("block", F.explode(every))
    asked = placed.withColumnRenamed("sub", "block").withColumn("sub", F.explode(every))
    keys = [*shard, "sub", "block"]
    nodes = nodes.select(*keys, "rep", "embedding", "near", "weight", "clusters")
    asked = asked.select(*[F.col(c).alias(f"q_{c}") for c in (*keys, "rep", "embedding", "clusters")])
    both = nodes.groupBy(*keys).cogroup(asked.groupBy(*[f"q_{c}" for c in keys]))
    return both.applyInPandas(_searcher(beam), _FOUND)


def audit(classes: DataFrame, found: DataFrame, queries: int = AUDIT) -> DataFrame:
    """For the ``queries`` classes with the smallest hashes: (rep, true_links, found_links).

    The true links come from comparing the queries, a stated and bounded set, with every class in blocks.
    """
    asked = classes.orderBy(F.xxhash64("rep"), "rep").limit(queries).select("rep", "label", "dim", "embedding").collect()

    def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, part in batch.groupby(["label", "dim"]):
                mine = [r for r in asked if (r["label"], r["dim"]) == key]
                if mine:
                    x = _unit(part["embedding"])
                    y = _unit(pd.Series([r["embedding"] for r in mine]))
                    near = (y @ x.T >= LEAST_COSINE) & (np.array([r["rep"] for r in mine])[:, None] != part["rep"].to_numpy())
                    counts = near @ part["weight"].to_numpy()
                    rows += [(r["rep"], int(c)) for r, c in zip(mine, counts, strict=True)]
            yield pd.DataFrame(rows, columns=["rep", "n"]).astype("int64")

    true = classes.mapInPandas(block, "rep long, n long").groupBy("rep").agg(F.sum("n").alias("true_links"))
    got = found.groupBy("rep").agg(F.sum("n").alias("found_links"))
    return true.join(got, "rep", "left").select("rep", "true_links", F.coalesce("found_links", F.lit(0)).alias("found_links"))


def link(df: DataFrame) -> DataFrame:
    """Per row of ``df`` (vec_id long, embedding, label): vec_id, n_links, component_id, kept.

    Vectors of equal label and length with a cosine of 0.98 or more are linked; n_links counts the other rows linked
    directly, copies included. Equal vectors are one class with a weight. Rows whose vector or label is null, or whose
    vector is empty, zero or holds null or non-finite components, are linked with nothing. Rows with a null vec_id are
    linked with nothing, have no component and are kept. The search is repeated with wider beams and more overlap until
    the audited recall reaches ``TARGET``, at most twice; below ``LEAST_RECALL`` it is an error. Other columns are ignored.
    """
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    size = F.aggregate("embedding", F.lit(0.0), lambda acc, v: acc + v * v)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    usable = usable & F.coalesce(finite, F.lit(False)) & (F.coalesce(size, F.lit(0.0)) > 0)
    key = F.when(usable, F.struct("label", F.xxhash64("embedding").alias("a"), F.xxhash64("embedding", F.lit(1)).alias("b")))
    rows = rows.withColumn("key", key)
    first = F.min(F.struct("vec_id", "embedding")).alias("m")
    classes = rows.where("key is not null").groupBy("key").agg(first, F.count("*").alias("weight"))
    classes = settle(
        classes.select(
            "key", "key.label", F.col("m.vec_id").alias("rep"), "m.embedding", F.size("m.embedding").alias("dim"), "weight"
        )
    )
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE if total > PER_CENTROID else 0).select("embedding")
    vectors = [r[0] for r in sample.collect()]
    centre = None
    if vectors:
        widths = pd.Series([len(v) for v in vectors])
        common = int(widths.mode()[0])
        x = _unit(pd.Series([v for v in vectors if len(v) == common]))
        centre = centroids(x, min(CENTROIDS, max(OVERLAP + 1, total // PER_CENTROID)))
    recall, asked = 0.0, AUDIT
    for effort in (1, 2, 4):
        found = settle(_search_all(classes.drop("key"), centre, OVERLAP + effort - 1, BEAM * effort))
        while True:
            check = audit(classes, found, asked).agg(F.sum("true_links"), F.sum(F.least("true_links", "found_links"))).first()
            if (check[0] or 0) >= AUDIT_LINKS or asked >= min(total, AUDIT_MOST):
                break
            asked *= 4
        recall = check[1] / check[0] if check[0] else 1.0
        if recall >= TARGET:
            break
    if recall < LEAST_RECALL:
        raise RuntimeError(f"the search found {recall:.3f} of the links of {asked} audited vectors, less than {LEAST_RECALL}")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    parts = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = classes.select("key", "rep", "weight").join(counts, "rep", "left")
    known = known.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select(
        F.col("key").alias("class"),
        (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"),
        F.coalesce("component", "rep").alias("smallest"),
    )
    out = rows.select("vec_id", "key").join(known, rows["key"] == known["class"], "left")
    out = out.select(
        "vec_id",
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("smallest", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
