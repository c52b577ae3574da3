"""Removal of word windows that stand elsewhere too, by sharded compressed indexes.

Windows are dealt out by their minimizer, the least hash among their 8-word runs: equal windows have the same one, so
only windows with the same minimizer need to meet. Consecutive windows with one minimizer travel as one segment, and
segments whose minimizer occurs once in the corpus stay behind. Each shard indexes its different segments and streams
them through backward search; the matching statistics tell which windows occur twice or more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedweir.llm.common import free_name, settle, text_key
from feedweir.llm.fmindex import Index
from feedweir.llm.sketches import _mix
from feedweir.llm.wordhash import word_hashes

WINDOW = 35
RUN = 8
# Words of a shard, and different segments of one minimizer above which its windows are dealt out by their own hash.
SHARD_WORDS = 600_000
HOT_SEGMENTS = 2000
# Segments, and words of documents, that a task makes before it hands them on.
OUT_ROWS, OUT_WORDS = 4096, 500_000

_U = np.uint64


def minimizers_of(docs: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per document (hashes of its words): first windows of the runs of windows with one minimizer, and the minimizers.

    All documents lie in one row; windows that reach from one into the next are left out.
    """
    none = (np.empty(0, np.int32), np.empty(0, np.int64))
    h = np.concatenate([*docs, np.empty(0, _U)])
    n = len(h)
    if n < WINDOW:
        return [none] * len(docs)
    runs = h[: n - RUN + 1]
    for j in range(1, RUN):
        runs = _mix(runs * _U(0x9E3779B97F4A7C15) ^ h[j : n - RUN + 1 + j])
    # leftmost least run of each window, over spans of 2, 4, 8, 16 and then all of them
    span, wide = WINDOW - RUN + 1, 1
    at = np.arange(len(runs))
    while wide * 2 <= span:
        a, b = at[:-wide], at[wide:]
        at = np.where(runs[a] <= runs[b], a, b)
        wide *= 2
    if wide < span:
        a, b = at[: n - WINDOW + 1], at[span - wide :]
        at = np.where(runs[a] <= runs[b], a, b)
    change = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    ends = np.cumsum([len(d) for d in docs])
    out = []
    for begin, end in zip(ends - [len(d) for d in docs], ends, strict=True):
        if end - begin < WINDOW:
            out.append(none)
            continue
        lo, hi = np.searchsorted(change, [begin + 1, end - WINDOW + 1])
        first = np.concatenate([[begin], change[lo:hi]])
        out.append(((first - begin).astype(np.int32), runs[at[first]].view(np.int64)))
    return out


def minimizers(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``minimizers_of`` one document."""
    return minimizers_of(list(word_hashes([b" ".join(words)])))[0]


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


_DOCS = "doc_id long, ka long, kb long, n_words long, whole string, starts array<int>, keys array<long>"


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["doc_id", "ka", "kb", "n_words", "whole", "starts", "keys"]

    def frame(rows: list[tuple], hashes: list[np.ndarray]) -> pd.DataFrame:
        whole = [(*r, *found) for r, found in zip(rows, minimizers_of(hashes), strict=True)]
        return pd.DataFrame(whole, columns=columns).astype({"doc_id": "Int64"})

    for batch in batches:
        rows, hashes, words = [], [], 0
        texts = [(t or "").encode() for t in batch["text"]]
        for doc, ka, kb, text, found in zip(batch["doc_id"], batch["ka"], batch["kb"], texts, word_hashes(texts), strict=True):
            ws = text.split()
            rows.append((None if pd.isna(doc) else int(doc), ka, kb, len(ws), _digest(ws)))
            hashes.append(found)
            words += len(ws)
            if words >= OUT_WORDS:
                yield frame(rows, hashes)
                rows, hashes, words = [], [], 0
        yield frame(rows, hashes)


_SEGMENTS = "ka long, kb long, weight long, start int, key long, sa long, sb long, segment string"


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["ka", "kb", "weight", "start", "key", "sa", "sb", "segment"]
    for batch in batches:
        rows = []
        for ka, kb, weight, text, refs in zip(batch["ka"], batch["kb"], batch["weight"], batch["text"], batch["refs"], strict=True):
            ws = text.encode().split()
            for ref in refs:
                segment = b" ".join(ws[ref["start"] : ref["end"] + WINDOW - 1])
                sa, sb = np.frombuffer(xxhash.xxh3_128_digest(segment), np.int64)
                rows.append((ka, kb, weight, ref["start"], ref["key"], sa, sb, segment.decode()))
                # a batch of texts has many times its rows in segments: never all of them at once
                if len(rows) >= OUT_ROWS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
        yield pd.DataFrame(rows, columns=columns)


_FOUND = "sa long, sb long, hits array<int>"


def repeated(shard: pd.DataFrame) -> pd.DataFrame:
    """Windows of a shard's segments that occur twice or more in it: (sa, sb, hits = their offsets).

    A segment of weight 2 or more is its own second occurrence, so it is indexed but not searched for; one that shares
    its minimizer with no other segment needs no index either.
    """
    shard = shard.sort_values(["sa", "sb", "base"])
    pieces = [s.split(" ") for s in shard["segment"]]
    size = np.array([len(p) for p in pieces], np.int64)
    weight = shard["weight"].to_numpy(np.int64)
    company = shard.groupby("deal")["deal"].transform("size").to_numpy() > 1
    hits: list[np.ndarray] = [np.arange(n - WINDOW + 1) if w > 1 else np.empty(0, int) for n, w in zip(size, weight, strict=True)]
    if (company & (weight == 1)).any():
        indexed = np.flatnonzero(company)
        codes: dict[str, int] = {}
        text = []
        for i in indexed:
            text.extend(codes.setdefault(w, len(codes) + 1) for w in pieces[i])
            text.append(0)
        text = np.array(text, np.int64)
        lengths = size[indexed]
        ends = np.cumsum(lengths + 1) - 1
        index = Index(text, np.repeat(weight[indexed], lengths + 1))
        asked = np.flatnonzero(weight[indexed] == 1)
        long = index.matching(text, ends[asked], lengths[asked], 2)
        for k in asked:
            hits[indexed[k]] = np.flatnonzero(long[ends[k] - lengths[k] : ends[k]] >= WINDOW)
    rows = [
        (sa, sb, (h + base).astype(np.int32))
        for sa, sb, base, h in zip(shard["sa"], shard["sb"], shard["base"], hits, strict=True)
        if len(h)
    ]
    return pd.DataFrame(rows, columns=["sa", "sb", "hits"])


_KEPT = "ka long, kb long, n_removed long, kept_sha256 string"
_KEPT_TEXT = "ka long, kb long, kept string"


def _left(text: str, found: list) -> tuple[list[bytes], int]:
    """The words outside all found windows, and how many are inside."""
    ws = text.encode().split()
    at = np.concatenate([f["start"] + np.asarray(f["hits"], np.int64) for f in found])
    edge = np.bincount(at, minlength=len(ws) + 1) - np.bincount(at + WINDOW, minlength=len(ws) + 1)
    gone = np.cumsum(edge[:-1]) > 0
    return list(compress(ws, ~gone)), int(gone.sum())


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for ka, kb, text, found in zip(batch["ka"], batch["kb"], batch["text"], batch["found"], strict=True):
            left, gone = _left(text, found)
            rows.append((ka, kb, gone, _digest(left)))
        yield pd.DataFrame(rows, columns=["ka", "kb", "n_removed", "kept_sha256"])


def _kept_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        left = [b" ".join(_left(t, f)[0]).decode() for t, f in zip(batch["text"], batch["found"], strict=True)]
        yield batch[["ka", "kb"]].assign(kept=left)


def _removals(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, ka, kb, n_words, whole), and of the different texts that lose words the windows found."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key(F.col("text")).alias("k"))
    docs = docs.select("doc_id", F.col("k.a").alias("ka"), F.col("k.b").alias("kb"), "text")
    known = settle(docs.mapInPandas(_documents, _DOCS))
    # equal texts are one from here on, with a weight
    first = F.min(F.struct("starts", "keys", "n_words")).alias("m")
    texts = known.where(f"n_words >= {WINDOW}").groupBy("ka", "kb").agg(first, F.count("*").alias("weight"))
    nth = F.transform(
        F.arrays_zip("m.starts", "m.keys"),
        lambda z, i: F.struct(
            z["starts"].alias("start"),
            F.coalesce(F.get(F.col("m.starts"), i + 1), (F.col("m.n_words") - WINDOW + 1).cast("int")).alias("end"),
            z["keys"].alias("key"),
        ),
    )
    refs = settle(texts.select("ka", "kb", "weight", nth.alias("refs")))
    each = refs.select("ka", "kb", "weight", F.inline("refs"))
    often = each.groupBy("key").agg(F.sum("weight").alias("n")).where("n > 1").select("key")
    shared = each.join(often, "key").groupBy("ka", "kb").agg(
        F.min("weight").alias("weight"), F.collect_list(F.struct("start", "end", "key")).alias("refs")
    )
    bodies = docs.select("ka", "kb", "text").join(shared.select("ka", "kb"), ["ka", "kb"], "left_semi")
    bodies = bodies.groupBy("ka", "kb").agg(F.min("text").alias("text")).join(shared, ["ka", "kb"])
    bodies = settle(bodies)
    segments = settle(bodies.mapInPandas(_segments, _SEGMENTS))

    # different segments; those of a minimizer with very many are cut into windows, dealt out by their own hash
    different = segments.groupBy("key", "sa", "sb").agg(F.sum("weight").alias("weight"), F.min("segment").alias("segment"))
    different = settle(different)
    hot = different.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_SEGMENTS)
    parts = different.join(hot.select("key", F.lit(True).alias("hot")), "key", "left")
    ws = F.split("segment", " ")
    cut = parts.where("hot").select("sa", "sb", "weight", F.explode(F.sequence(F.lit(0), F.size(ws) - WINDOW)).alias("base"), ws.alias("w"))
    cut = cut.select("sa", "sb", "weight", "base", F.array_join(F.slice("w", F.col("base") + 1, WINDOW), " ").alias("segment"))
    cut = cut.withColumn("deal", F.xxhash64("segment"))
    plain = parts.where("hot is null").select("sa", "sb", "weight", F.lit(0).alias("base"), "segment", F.xxhash64("key").alias("deal"))
    pieces = settle(plain.unionByName(cut))
    size = pieces.agg(F.sum(F.size(F.split("segment", " ")))).first()[0] or 0
    shards = max(1, size // SHARD_WORDS)
    dealt = pieces.withColumn("shard", F.pmod("deal", F.lit(shards)))
    found = dealt.groupBy("shard").applyInPandas(repeated, _FOUND)
    found = found.groupBy("sa", "sb").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"))

    marks = segments.select("ka", "kb", "start", "sa", "sb").join(found, ["sa", "sb"])
    marks = marks.groupBy("ka", "kb").agg(F.collect_list(F.struct("start", "hits")).alias("found"))
    found = bodies.select("ka", "kb", "text").join(marks, ["ka", "kb"])
    return known.select("doc_id", "ka", "kb", "n_words", "whole"), found


def removals(df: DataFrame) -> DataFrame:
    """Per row of ``df`` (doc_id long, text): doc_id, n_words, n_removed, kept_sha256.

    A word goes if it is in a window of ``WINDOW`` words that starts anywhere else too, in this or another row. Words
    are compared by the bytes between ASCII spaces. Null, empty and short texts lose nothing, except that nothing is
    left of the second copy or of the first where whole texts of a window or more are equal. Other columns are ignored.
    """
    docs, found = _removals(df)
    out = docs.join(found.mapInPandas(_kept, _KEPT), ["ka", "kb"], "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def without_repeats(df: DataFrame) -> DataFrame:
    """``df`` with ``text`` reduced to the words that ``removals`` keeps, joined by one space, where any go."""
    _, found = _removals(df)
    k, cut, ka, kb = (free_name(df, x) for x in ("_k", "kept", "ka", "kb"))
    left = found.mapInPandas(_kept_text, _KEPT_TEXT).toDF(ka, kb, cut)
    out = df.withColumn(k, text_key(F.col("text")))
    out = out.join(left, (F.col(f"{k}.a") == F.col(ka)) & (F.col(f"{k}.b") == F.col(kb)), "left")
    return out.withColumn("text", F.coalesce(cut, "text")).select(*df.columns)
