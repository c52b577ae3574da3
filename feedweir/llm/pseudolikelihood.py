"""Document scores by masked pseudo-likelihood.

A bidirectional window network predicts every token from the two before it and the two after it, without seeing it;
the sum of the log-probabilities scores a document. The vocabulary is counted over the whole corpus. Every partition
of the corpus trains a copy of the network, in numpy, on all of its documents; the copies are averaged by a grouping.

The network knows the most frequent words by number and the others by bucket. The counts of all words stay in a table,
and a word's share of its bucket, looked up per shard of texts, makes the probability of a bucket that of a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.llm.common import SPACES, free_name, settle
from feedweir.llm.wordhash import Places, hashes_in_rows, split_rows, word_hashes

# Tokens are numbered 0 .. DIGIT * DIGIT - 1: 0 stands outside the text, then the most frequent words, then buckets
# that all other words are hashed into. A token is predicted as two digits, the second given the first.
DIGIT = 32
TOKENS = DIGIT * DIGIT
FREQUENT = 767
REACH = 2
OFFSETS = (-2, -1, 1, 2)
HIDDEN = 16
# Tokens that go through the network at a time, so that what is computed of them stays in a processor's cache.
BLOCK = 1024
# Tokens of a step; documents and characters of each that the common start is trained on, a bounded sample; its steps.
BATCH = 8192
START_TEXTS, START_CHARS, START_STEPS = 400, 2000, 120
RATE = 0.01
# Values of a row that carries a part of a network.
CHUNK = 4096
# Characters of the texts that are scored together.
SHARD_CHARS = 1 << 24

_F = np.float32
_SHAPES = [(len(OFFSETS), TOKENS, HIDDEN), (HIDDEN,), (HIDDEN, 2 * DIGIT), (2 * DIGIT,), (DIGIT, DIGIT)]


def start(seed: int = 11) -> list[np.ndarray]:
    """Untrained weights: token tables per offset, hidden bias, output layer and bias, second digit given the first."""
    rng = np.random.default_rng(seed)
    scale = [0.1, 0, HIDDEN**-0.5, 0, 0]
    return [(rng.standard_normal(s) * k).astype(_F) for s, k in zip(_SHAPES, scale, strict=True)]


class Codes:
    """The words of a vocabulary by their hashes."""

    def __init__(self, vocabulary: dict[bytes, int]) -> None:
        found = np.array([h[0] for h in word_hashes(vocabulary)], np.uint64)
        order = np.argsort(found)
        self.places = Places(found[order])
        # the last entry of the places is no word: its key is the hash
        self.numbers = np.array([*vocabulary.values(), -1], np.int64)[np.append(order, len(order))]

    def keys(self, h: np.ndarray) -> np.ndarray:
        """The number of a word of the vocabulary, or else the word's hash."""
        at = self.places.of(h)
        return np.where(self.places.hashes[at] == h, self.numbers[at], h.view(np.int64))


def keys(texts: Iterable[str | None], codes: Codes) -> Iterator[np.ndarray]:
    """Per text, the ``codes.keys`` of all its words, lower-cased."""
    for h, lengths in hashes_in_rows((t or "").lower().encode() for t in texts):
        yield from split_rows(codes.keys(h), lengths)


def tokens(found: np.ndarray) -> np.ndarray:
    """Token numbers of ``keys``: hashes become buckets."""
    return np.where((found > 0) & (found <= FREQUENT), found, FREQUENT + 1 + found % (TOKENS - FREQUENT - 1))


def numbers(text: str | None, vocabulary: dict[bytes, int] | Codes) -> np.ndarray:
    """Token numbers of the whole text."""
    return tokens(next(keys([text], vocabulary if isinstance(vocabulary, Codes) else Codes(vocabulary))))


def _laid_out(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All documents in one row with ``REACH`` empty places around each, and the places of the tokens."""
    return _spread(np.concatenate([*docs, np.empty(0, np.int64)]), np.array([len(d) for d in docs], np.int64))


def _spread(found: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_laid_out`` of documents that stand one after the other, by their lengths."""
    places = np.arange(len(found)) + np.repeat(REACH * np.arange(1, len(lengths) + 1), lengths)
    row = np.zeros(len(found) + REACH * (len(lengths) + 1), np.int64)
    row[places] = found
    return row, places


_ONES = np.ones(DIGIT, _F)


def _blocks(size: int) -> Iterator[slice]:
    """The places of the blocks of every batch; what is less than a block goes with the block before."""
    for begin in range(0, size, BATCH):
        end = min(begin + BATCH, size)
        edges = [*range(begin, max(end - BLOCK, begin) + 1, BLOCK), end]
        yield from map(slice, edges[:-1], edges[1:])


def _forward(
    net: list[np.ndarray], row: np.ndarray, at: np.ndarray, h: np.ndarray, scores: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hidden layer ``h`` at the places ``at``, and of both digits the exponentials of the ``scores``.

    Returns the sums of these per digit, and the places of the tokens' own digits in the flat scores.
    """
    tables, bias, out, out_bias, given = net
    # "clip" only for writing into ``h``: all tokens are in the tables
    np.take(tables[0], row[at + OFFSETS[0]], axis=0, out=h, mode="clip")
    for k, o in enumerate(OFFSETS[1:], 1):
        h += np.take(tables[k], row[at + o], axis=0)
    h += bias
    np.tanh(h, out=h)
    np.matmul(h, out, out=scores)
    scores += out_bias
    digit, rest = np.divmod(row[at], DIGIT)
    # whole rows, with nothing to add to the first digit, are faster than halves of them
    scores += np.take(np.hstack([np.zeros_like(given), given]), digit, axis=0)
    # far from any score that training reaches; keeps the sums finite
    np.clip(scores, -40, 40, out=scores)
    np.exp(scores, out=scores)
    begin = np.arange(0, scores.size, 2 * DIGIT)
    return scores[:, :DIGIT] @ _ONES, scores[:, DIGIT:] @ _ONES, begin + digit, begin + DIGIT + rest


def log_probabilities(net: list[np.ndarray], row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of every token at ``at``, given its neighbours only."""
    out = np.empty(len(at), np.float64)
    all_h, all_e = np.empty((2 * BLOCK, HIDDEN), _F), np.empty((2 * BLOCK, 2 * DIGIT), _F)
    for block in _blocks(len(at)):
        part = at[block]
        h, e = all_h[: len(part)], all_e[: len(part)]
        first, second, digit, rest = _forward(net, row, part, h, e)
        out[block] = np.log(np.take(e, digit) / first * (np.take(e, rest) / second) + 1e-30)
    return out


def _scattered(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    codes = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    out = np.zeros((size, values.shape[1]), values.dtype)
    out[codes[starts]] = np.add.reduceat(np.take(values, order, axis=0), starts, axis=0)
    return out


def gradients(net: list[np.ndarray], row: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean negative log-probability over the places ``at``."""
    out, token = net[2], row[at]
    all_h, all_dh, all_ds = (np.empty((len(at), k), _F) for k in (HIDDEN, HIDDEN, 2 * DIGIT))
    for block in _blocks(len(at)):
        part, h, dh, ds = (x[block] for x in (at, all_h, all_dh, all_ds))
        first, second, digit, rest = _forward(net, row, part, h, ds)
        both, flat = ds.reshape(-1, 2, DIGIT), ds.reshape(-1)
        both /= np.stack([first, second], axis=1)[:, :, None]
        flat[digit] -= 1
        flat[rest] -= 1
        ds *= _F(1 / len(at))
        np.matmul(ds, out.T, out=dh)
        dh *= 1 - h * h
    h, dh, ds = all_h, all_dh, all_ds
    dt = np.stack([_scattered(row[at + o], dh, TOKENS) for o in OFFSETS])
    return [dt, dh.sum(axis=0), h.T @ ds, ds.sum(axis=0), _scattered(token // DIGIT, ds[:, DIGIT:], DIGIT)]


class Trainer:
    """Adam on a copy of a network."""

    def __init__(self, net: list[np.ndarray]) -> None:
        self.net = [p.copy() for p in net]
        self.first, self.second = ([np.zeros_like(p) for p in net] for _ in range(2))
        self.steps = 0

    def step(self, row: np.ndarray, at: np.ndarray) -> None:
        """One step on the tokens at ``at``."""
        self.steps += 1
        rate = RATE * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for p, g, m, v in zip(self.net, gradients(self.net, row, at), self.first, self.second, strict=True):
            m += _F(0.1) * (g - m)
            v += _F(0.01) * (g * g - v)
            p -= _F(rate) * m / (np.sqrt(v) + _F(1e-8))


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows (w, n) of all words of all texts, lower-cased, as a written table."""
    cut = df.select(F.explode(F.split(F.lower(text), SPACES, -1)).alias("w")).where("w <> ''")
    return settle(cut.groupBy("w").agg(F.count("*").alias("n")))


def vocabulary_of(df: DataFrame, text: str = "text", counts: DataFrame | None = None) -> dict[bytes, int]:
    """The most frequent words of all texts, numbered from 1, by their ``counts``."""
    counts = word_counts(df, text) if counts is None else counts
    top = counts.orderBy(F.desc("n"), "w").limit(FREQUENT).collect()
    return {r["w"].encode(): i + 1 for i, r in enumerate(top)}


def _common_start(df: DataFrame, vocabulary: dict[bytes, int], text: str) -> list[np.ndarray]:
    """A network trained on a bounded sample: pieces of the texts with the smallest hashes."""
    hashed = df.where(F.col(text) != "").select(F.xxhash64(text).alias("h")).distinct().orderBy("h").limit(START_TEXTS)
    cut = hashed.agg(F.max("h")).first()[0]
    trainer = Trainer(start())
    if cut is None:
        return trainer.net
    sample = df.where((F.col(text) != "") & (F.xxhash64(text) <= cut))
    # the piece begins at a hashed place, so that ends of texts are met as often as beginnings
    places = F.greatest(F.char_length(text) - START_CHARS + 1, F.lit(1))
    begin = (F.pmod(F.xxhash64(text, F.lit("piece")), places) + 1).cast("int")
    piece = F.substring(F.col(text), begin, F.lit(START_CHARS))
    sample = sample.groupBy(F.xxhash64(text).alias("h")).agg(F.min(piece).alias("t"))
    row, at = _laid_out([numbers(r["t"], vocabulary) for r in sample.orderBy("h").limit(START_TEXTS).collect()])
    rng = np.random.default_rng(2)
    for _ in range(START_STEPS if len(at) else 0):
        trainer.step(row, rng.choice(at, min(BATCH // 2, len(at))))
    return trainer.net


def _flat(net: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in net])


def _shaped(flat: np.ndarray) -> list[np.ndarray]:
    sizes = np.cumsum([int(np.prod(s)) for s in _SHAPES])[:-1]
    return [p.reshape(s).astype(_F) for p, s in zip(np.split(flat, sizes), _SHAPES, strict=True)]


_PARTS = "chunk int, deal int, weight double, v array<double>"


def _local_training(net: list[np.ndarray], vocabulary: dict[bytes, int], text: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trainer, seen, codes = Trainer(net), 0, Codes(vocabulary)
        for batch in batches:
            docs, size = [], 0
            for i, found in enumerate(keys(batch[text], codes)):
                docs.append(found)
                size += len(docs[-1])
                # a few steps' worth of tokens at once, mixed
                if size >= 8 * BATCH or i + 1 == len(batch):
                    row, at = _spread(tokens(np.concatenate(docs)), np.array([len(d) for d in docs]))
                    at = np.random.default_rng(seen).permutation(at)
                    for j in range(0, len(at), BATCH):
                        trainer.step(row, at[j : j + BATCH])
                    seen += len(at)
                    docs, size = [], 0
        if seen:
            flat, deal = _flat(trainer.net).astype(np.float64), TaskContext.get().partitionId() % 256
            parts = [(i, deal, float(seen), flat[j : j + CHUNK]) for i, j in enumerate(range(0, len(flat), CHUNK))]
            yield pd.DataFrame(parts, columns=["chunk", "deal", "weight", "v"])

    return run


def _mean(parts: pd.DataFrame) -> pd.DataFrame:
    weight = parts["weight"].to_numpy()
    total = np.zeros(len(parts["v"].iloc[0]))
    for w, v in zip(weight, parts["v"], strict=True):
        total += w * np.asarray(v)
    return pd.DataFrame({
        "chunk": [int(parts["chunk"].iloc[0])], "deal": [0], "weight": [weight.sum()], "v": [total / weight.sum()],
    })


def fit(df: DataFrame, text: str = "text", counts: DataFrame | None = None) -> tuple[list[np.ndarray], dict[bytes, int]]:
    """Network and vocabulary from all texts of ``df``.

    The copies of the partitions are averaged in two steps, so that no group holds more than a 256th of them; only the
    mean, whose size is fixed, comes to the driver. ``counts`` are the ``word_counts`` of ``df``, if known. A table without words gives an untrained network.
    """
    vocabulary = vocabulary_of(df, text, counts)
    net = _common_start(df, vocabulary, text)
    parts = df.select(text).mapInPandas(_local_training(net, vocabulary, text), _PARTS)
    half = parts.groupBy("chunk", "deal").applyInPandas(_mean, _PARTS)
    rows = half.groupBy("chunk").applyInPandas(_mean, _PARTS).orderBy("chunk").collect()
    return (_shaped(np.concatenate([r["v"] for r in rows])) if rows else net), vocabulary


def _scores(net: list[np.ndarray], texts: Iterable[str | None], codes: Codes, share=None) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and summed log-probabilities of every text; ``share`` adds something to each token's, by its key."""
    counts, sums = [], []

    def add(docs: list[np.ndarray]) -> None:
        found = np.concatenate(docs)
        lengths = np.array([len(d) for d in docs], np.int64)
        each = log_probabilities(net, *_spread(tokens(found), lengths))
        values = np.concatenate([[0.0], np.cumsum(each if share is None else each + share(found))])
        ends = np.cumsum(lengths)
        counts.extend(lengths)
        sums.extend(values[ends] - values[ends - lengths])

    docs, size = [], 0
    for found in keys(texts, codes):
        docs.append(found)
        size += len(docs[-1])
        if size >= 16 * BATCH or len(docs) == 64:
            add(docs)
            docs, size = [], 0
    if docs:
        add(docs)
    return np.array(counts, np.int64), np.array(sums, np.float64)


def score(df: DataFrame, net: list[np.ndarray], vocabulary: dict[bytes, int], text: str = "text") -> DataFrame:
    """``df`` with n_tokens, log_prob (sum over all tokens) and score (its mean); columns of these names are replaced.

    Null, empty and blank texts have n_tokens 0, log_prob 0 and no score. A document is scored alone, whole.
    """

    @F.pandas_udf("n_tokens long, log_prob double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codes = Codes(vocabulary)
        for texts in batches:
            counts, sums = _scores(net, texts, codes)
            yield pd.DataFrame({"n_tokens": counts, "log_prob": sums})

    name = "_scored"
    while name in df.columns:
        name = f"_{name}"
    out = df.withColumn(name, scored(F.col(text)))
    out = out.withColumns({"n_tokens": F.col(name)["n_tokens"], "log_prob": F.col(name)["log_prob"]})
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return out.withColumn("score", mean).drop(name)


@F.pandas_udf(T.LongType())
def _word_key(words: pd.Series) -> pd.Series:
    """The hash of a word, as ``keys`` has it."""
    return pd.Series(next(word_hashes([" ".join(words).encode()])).view(np.int64))


def _bucket(key: Column) -> Column:
    """The bucket of a word's hash."""
    return F.pmod(key, F.lit(TOKENS - FREQUENT - 1)).cast("int")


def _sharder(vocabulary: dict[bytes, int], text: int):
    """Rows as they are, with the number of their shard, and on a shard's last row its rare words' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, shard, size, met = Codes(vocabulary), TaskContext.get().partitionId() << 32, 0, []

        def packed() -> bytes:
            found = np.sort(np.concatenate([*met, np.empty(0, np.int64)]))
            return found[np.diff(found, prepend=found[:1] - 1) != 0].tobytes()

        for batch in batches:
            shards, words = [], []
            texts = batch.column(text).to_pylist()
            for t, found in zip(texts, keys(texts, codes), strict=True):
                if size >= SHARD_CHARS:
                    shard, size, met = shard + 1, 0, []
                size += len(t or "") + 1
                met.append(found[(found <= 0) | (found > FREQUENT)])
                shards.append(shard)
                full = size >= SHARD_CHARS
                words.append(packed() if full else None)
            # a shard that is still open ends with each batch, too: what it had so far need not be told again
            if words and words[-1] is None:
                words[-1], met = packed(), []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shards, pa.int64()), pa.array(words, pa.binary())], names=[*batch.schema.names, "shard", "words"]
            )

    return run


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for shard, words in zip(batch["shard"], batch["words"], strict=True):
            yield pd.DataFrame({"shard": shard, "h": np.frombuffer(words, np.int64)})


def score_words(
    df: DataFrame, net: list[np.ndarray], vocabulary: dict[bytes, int], counts: DataFrame, text: str = "text"
) -> DataFrame:
    """``score`` with the probabilities of words instead of buckets: log_prob and score include every word's share.

    A word that is not in the vocabulary has the share (n + 1) / (N + V + 1) of its bucket, where n is its count, N the
    sum and V the number of the counted words of the bucket; 1 / (N + V + 1) is left for the words never seen.

    Texts are dealt into shards of bounded size. A shard asks for the counts of its different rare words, by their
    hashes, and gets them back as a table of its own, so a word travels once per shard and not once per document.
    """
    frequent = [w.decode() for w in vocabulary]
    rare = counts.where(~F.col("w").isin(frequent)) if frequent else counts
    rare = settle(rare.select(_word_key("w").alias("h"), "n"))
    # one row per bucket
    sums = rare.groupBy(_bucket(F.col("h")).alias("bucket")).agg((F.sum("n") + F.count("*") + 1).alias("whole")).collect()
    whole = np.zeros(TOKENS - FREQUENT - 1)
    for r in sums:
        whole[r["bucket"]] = np.log(r["whole"])

    plain = df.drop("n_tokens", "log_prob", "score")
    shard, words = free_name(df, "_shard"), free_name(df, "_words")
    kept = T.StructType([*plain.schema.fields, T.StructField(shard, T.LongType()), T.StructField(words, T.BinaryType())])
    dealt = settle(plain.mapInArrow(_sharder(vocabulary, plain.columns.index(text)), kept))
    asked = dealt.where(F.col(words).isNotNull()).select(F.col(shard).alias("shard"), F.col(words).alias("words"))
    asked = asked.mapInPandas(_unpacked, "shard long, h long").join(rare, "h")

    def scored(mine: pa.Table, known: pa.Table) -> pa.Table:
        h, n = known.column("h").to_numpy().view(np.uint64), known.column("n").to_numpy()
        order = np.argsort(h)
        places, n = Places(h[order]), np.append(np.log(n[order] + 1.0), 0.0)

        def share(found: np.ndarray) -> np.ndarray:
            out, at_rare = np.zeros(len(found)), np.flatnonzero((found <= 0) | (found > FREQUENT))
            found = found[at_rare]
            at = places.of(found.view(np.uint64))
            out[at_rare] = np.where(places.hashes[at] == found.view(np.uint64), n[at], 0.0) - whole[found % len(whole)]
            return out

        n_tokens, log_prob = _scores(net, mine.column(text).to_pylist(), Codes(vocabulary), share)
        mine = mine.drop_columns([shard, words])
        return mine.append_column("n_tokens", pa.array(n_tokens)).append_column("log_prob", pa.array(log_prob))

    schema = T.StructType([*plain.schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType())])
    out = dealt.groupBy(shard).cogroup(asked.groupBy("shard")).applyInArrow(scored, schema)
    return out.withColumn("score", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
