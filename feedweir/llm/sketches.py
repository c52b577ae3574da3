"""Near-duplicate documents by fast similarity sketches, banding, and a check of whole shingle sets.

The sketch fills its coordinates in rounds. A round throws every shingle of a set into one coordinate by a hash and
keeps the least value there; later rounds have larger values, so they only fill what is still empty, and the last
rounds, one per coordinate, leave none empty. Every coordinate is a minimum over the whole set, and the share of equal
coordinates of two sets is concentrated around their similarity as that of independent samples is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.llm.common import components, settle, text_key

# Coordinates, and rows per band. A pair at similarity 0.8 shares no band with probability (1 - 0.8^6)^42 = 3e-6.
SIZE = 256
BAND = 6
BANDS = SIZE // BAND
# Least share of equal sketch bits of a pair that is checked. At similarity 0.8 the share is 0.9 on average, with a
# deviation of 0.019 over 256 bits; 0.78 is more than six deviations lower.
LEAST_BITS = int(0.78 * SIZE)

# Bits of the marks of a set: the more, the fewer shingles of different sets fall on the same mark.
MARKS = 2048

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, width: int = 2) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles of ``width`` words; of the whole sequence if it is shorter."""
    if not text:
        return np.empty(0, _U)
    ws = text.encode().lower().split()
    if not ws:
        return np.empty(0, _U)
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in ws), _U, len(ws))
    long = min(width, len(ws))
    out = h[long - 1 :]
    for i in range(long - 2, -1, -1):
        out = _mix(h[i : i + len(out)] ^ _mix(out + _U(0x9E3779B97F4A7C15)))
    return np.unique(out if len(ws) >= width > 1 else _mix(out + _U(1)))


_ROUND = _mix(np.arange(1, 2 * SIZE + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))


def sketch(items: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit hashes that is not empty."""
    out = np.full(SIZE, np.iinfo(np.uint64).max, _U)
    done = 0
    while done < SIZE:
        # so many rounds at once as fill all coordinates in most cases
        rounds = np.arange(done, min(SIZE, done + 1 + 1600 // len(items)))
        h = _mix(items[None, :] ^ _ROUND[rounds][:, None])
        values = (rounds.astype(_U) << _U(55))[:, None] | (h >> _U(9))
        np.minimum.at(out, (h & _U(SIZE - 1)).ravel().astype(np.intp), values.ravel())
        done = rounds[-1] + 1
        if out.max() < np.iinfo(np.uint64).max:
            return out
    for i in np.flatnonzero(out == np.iinfo(np.uint64).max):
        out[i] = (_U(SIZE + i) << _U(55)) | (_mix(items ^ _ROUND[SIZE + i]).min() >> _U(9))
    return out


_MIX = _mix(np.arange(1, BAND + 1, dtype=_U)) | _U(1)
_BAND_SEED = _mix(np.arange(1, BANDS + 1, dtype=_U) << _U(20))


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One key per band: equal for equal coordinates of the same band."""
    bands = coordinates[: BANDS * BAND].reshape(BANDS, BAND)
    return _mix(_mix((_mix(bands) * _MIX).sum(axis=1, dtype=_U)) ^ _BAND_SEED).view(np.int64)


def bits(coordinates: np.ndarray) -> np.ndarray:
    """One bit per coordinate, packed into four numbers."""
    return np.packbits((_mix(coordinates) & _U(1)).astype(np.uint8)).view(np.int64)


_SKETCHES = "doc_id long, n_shingles long, digest binary, bands array<long>, bits array<long>"


def _sketches(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
            doc = None if pd.isna(doc) else int(doc)
            items = shingle_set(text, width)
            if len(items):
                s = sketch(items)
                digest = xxhash.xxh3_128_digest(items.tobytes())
                rows.append((doc, len(items), digest, band_keys(s), bits(s)))
            else:
                rows.append((doc, 0, None, None, None))
        frame = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "bands", "bits"])
        yield frame.astype({"doc_id": "Int64"})


def _overlaps(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = []
        centre, centre_set = None, None
        for a, b in zip(batch["ta"], batch["tb"], strict=True):
            if b is not centre and b != centre:
                centre, centre_set = b, shingle_set(b, width)
            mine = shingle_set(a, width)
            both = len(np.intersect1d(mine, centre_set, assume_unique=True))
            keep.append(100 * both >= 80 * (len(mine) + len(centre_set) - both))
        yield batch.loc[keep, ["a", "b"]]


def _equal_bits(x: Column, y: Column) -> Column:
    differ = [F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(SIZE // 64)]
    return F.lit(SIZE) - sum(differ[1:], differ[0])


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Pairs (a, b) of classes that are linked by their full sets."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(lambda x: _overlaps(x, width), "a long, b long")


def _apart(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (band, rep, bits, star, main) of the buckets whose classes are in more than one component (star).

    main is the component with the most classes of the bucket.
    """
    parts = parts.withColumnsRenamed({"node": "rep", "component": "star"})
    placed = members.join(parts, "rep", "left").withColumn("star", F.coalesce("star", "rep"))
    groups = placed.groupBy("band", "star").agg(F.count("*").alias("n"))
    split = groups.groupBy("band").agg(F.max(F.struct("n", "star")).alias("m"), F.count("*").alias("stars"))
    return settle(placed.join(split.where("stars > 1").select("band", F.col("m.star").alias("main")), "band"))


def _shingle_rows(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for rep, text in zip(batch["rep"], batch["text"], strict=True):
            items = shingle_set(text, width).view(np.int64)
            yield pd.DataFrame({"rep": np.full(len(items), rep), "n": np.full(len(items), len(items)), "item": items})


def marks(items: np.ndarray) -> np.ndarray:
    """A bit for every value of the last bits of a set's hashes, packed: a mark that is not set rules a shingle out."""
    out = np.zeros(MARKS, np.uint8)
    out[(items & _U(MARKS - 1)).astype(np.intp)] = 1
    return np.packbits(out).view(np.int64)


def _marks(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"rep": batch["rep"], "marks": [marks(shingle_set(text, width)) for text in batch["text"]]})


def _only_left(x: Column, y: Column) -> Column:
    """How many marks of ``x`` are not set in ``y``: no more than the shingles that the second set lacks."""
    lacking = [
        F.bit_count(F.get(x, F.lit(i)).bitwiseAND(F.bitwise_not(F.get(y, F.lit(i))))) for i in range(MARKS // 64)
    ]
    return sum(lacking[1:], lacking[0])


def _linkable(loose: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Rows (rep, n, shared, marks) of the classes that may still have a link: set size, how much of it others hold
    too, and the set's marks.

    A link needs four fifths of a set in the other one. A class with more than a fifth of its shingles in no other
    class that is left has none, and without it more shingles are alone; a second pass looks again.
    """
    left = texts.join(loose.select("rep").distinct(), "rep", "left_semi")
    items = settle(left.mapInPandas(lambda x: _shingle_rows(x, width), "rep long, n long, item long"))
    sizes = items.select("rep", "n").distinct()
    out = None
    for _ in range(2):
        here = items if out is None else items.join(out.select("rep"), "rep", "left_semi")
        alone = here.groupBy("item").agg(F.count("*").alias("times"), F.min("rep").alias("rep")).where("times = 1")
        alone = alone.groupBy("rep").agg(F.count("*").alias("alone"))
        out = sizes.join(alone, "rep", "left").selectExpr("rep", "n", "n - coalesce(alone, 0) as shared")
        out = settle(out.where("100 * shared >= 80 * n"))
    return out.join(left.mapInPandas(lambda x: _marks(x, width), "rep long, marks array<long>"), "rep")


def link(df: DataFrame, width: int = 2) -> DataFrame:
    """Near-duplicate groups of ``df`` (doc_id long, text): rows (doc_id, n_shingles, component_id, kept), one per row.

    Documents whose sets of shingles of ``width`` words have 100 x intersection >= 80 x union are linked; a component
    is all that links reach. Texts with equal sets are one class, joined to its smallest doc_id without pairs. Every class is
    compared with the smallest class of a bucket that it shares most bands with; classes that a bucket still holds in
    different components afterwards are all compared with each other by sketch bits, by the parts of their sets that no
    other class holds, and by marks that bound the intersection of two sets from above; what these rule out is no
    link, so no bucket is cut and no candidate is dropped. Every link is confirmed on the sets of the whole texts.

    Null, empty and blank texts have n_shingles 0 and are linked with nothing. Rows with a null doc_id are linked with
    nothing, have no component and are kept. Rows that share a doc_id are one document; where their texts differ, each
    text is compared on its own and what it is linked to is linked to the document. An empty table gives an empty
    table; other columns are ignored.
    """
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = docs.where("doc_id is not null").select("doc_id", text_key(F.col("text")).alias("k"))
    first = keyed.groupBy("doc_id").agg(F.min("k").alias("k0"), F.max("k").alias("k1")).where("k0 <> k1").select("doc_id", "k0")
    others = keyed.join(first, "doc_id").where("k <> k0").select("doc_id", "k").distinct()
    others = settle(others)
    if others.isEmpty():
        return _link(docs, width, None)
    # every further text of a document is a node of its own, numbered above all documents and linked to its document
    top = docs.agg(F.max("doc_id")).first()[0]
    others = settle(others.withColumn("node", F.lit(top + 1) + F.monotonically_increasing_id()))
    here, there = docs.withColumn("k", text_key(F.col("text"))), others.withColumnRenamed("doc_id", "of")
    split = here.join(there, (here["doc_id"] == there["of"]) & (here["k"] == there["k"]), "left")
    split = settle(split.select(F.coalesce("node", "doc_id").alias("doc_id"), "text"))
    out = _link(split, width, others.select(F.col("node").alias("a"), F.col("doc_id").alias("b")))
    back = others.select(F.col("doc_id").alias("of"), "node")
    out = out.join(back, out["doc_id"] == back["node"], "left")
    out = out.select(F.coalesce("of", "doc_id").alias("doc_id"), "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _link(docs: DataFrame, width: int, known_links: DataFrame | None) -> DataFrame:
    """``link`` for documents of one text each; ``known_links`` (a, b) are joined to those that are found."""
    rows = settle(docs.mapInPandas(lambda x: _sketches(x, width), _SKETCHES))
    known = rows.where("doc_id is not null and n_shingles > 0")
    first = known.groupBy("digest").agg(F.min(F.struct("doc_id", "bands", "bits")).alias("m"))
    classes = settle(first.select("digest", F.col("m.doc_id").alias("rep"), "m.bands", "m.bits"))
    copies = known.join(classes.select("digest", "rep"), "digest").where("doc_id <> rep")
    copies = copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    buckets = classes.select("rep", F.explode("bands").alias("band"))
    heads = buckets.groupBy("band").agg(F.min("rep").alias("head"), F.max("rep").alias("last"))
    members = settle(buckets.join(heads.where("head < last").select("band", "head"), "band"))
    votes = members.where("rep <> head").groupBy("rep", "head").agg(F.count("*").alias("n"))
    best = votes.groupBy("rep").agg(F.max(F.struct("n", (-F.col("head")).alias("head"))).alias("m"))
    pairs = best.select(F.col("rep").alias("a"), (-F.col("m.head")).alias("b"))
    sketches = classes.select("rep", "bits")
    pairs = pairs.join(sketches.select(F.col("rep").alias("a"), F.col("bits").alias("x")), "a")
    pairs = pairs.join(sketches.select(F.col("rep").alias("b"), F.col("bits").alias("y")), "b")
    pairs = pairs.where(_equal_bits(F.col("x"), F.col("y")) >= LEAST_BITS).select("a", "b")

    wanted = members.select("rep").distinct()
    texts = docs.join(wanted, docs["doc_id"] == wanted["rep"], "left_semi")
    texts = settle(texts.groupBy(F.col("doc_id").alias("rep")).agg(F.min("text").alias("text")))
    links = settle(_confirmed(pairs, texts, width))

    # What the stars have not joined: every pair of a bucket's classes that are still in different components, if its
    # sketch bits and its sets leave room for a link.
    loose = _apart(members.select("band", "rep").join(sketches, "rep"), components(links))
    loose = settle(loose.join(_linkable(loose, texts, width), "rep"))
    others = loose.where("star <> main").selectExpr("band", "rep as a", "star as sa", "bits as x", "n as na", "shared as pa", "marks as ma")
    everyone = loose.selectExpr("band", "rep as b", "star as sb", "main", "bits as y", "n as nb", "shared as pb", "marks as mb")

    def room(most: Column) -> Column:
        return 100 * most >= 80 * (F.col("na") + F.col("nb") - most)

    crossing = (F.col("sa") != F.col("sb")) & ((F.col("sb") == F.col("main")) | (F.col("a") < F.col("b")))
    close = _equal_bits(F.col("x"), F.col("y")) >= LEAST_BITS
    met = F.least(F.col("na") - _only_left(F.col("ma"), F.col("mb")), F.col("nb") - _only_left(F.col("mb"), F.col("ma")))
    same = others["band"] == everyone["band"]
    more = others.join(everyone, same & crossing & room(F.least("pa", "pb")) & close & room(met))
    more = _confirmed(more.select("a", "b").distinct(), texts, width)

    every = links.unionByName(more).unionByName(copies)
    found = components(every if known_links is None else every.unionByName(known_links))
    out = rows.select("doc_id", "n_shingles")
    out = out.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(df: DataFrame, width: int = 2) -> DataFrame:
    """The rows of ``df`` that ``link`` keeps, one of each group; a row that is there several times stays once."""
    judged = link(df, width).where("kept")
    ids = judged.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows"))
    once = ids.where("rows = 1").select("doc_id")
    often = ids.where("rows > 1").select("doc_id")
    single = df.join(once, "doc_id", "left_semi")
    repeated = df.join(often, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(repeated).unionByName(df.where("doc_id is null")).select(*df.columns)
