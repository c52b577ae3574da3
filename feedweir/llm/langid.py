"""Language of documents by a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time; it labels every byte position of a text, and
the mean of the position probabilities labels the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedweir.llm.common import free_name

# Bound of the fit: rows per language and in all, and characters of each row, at a place that its hash chooses.
ROWS_PER_CLASS = 250
ROWS = 4000
SLICE = 768

# Positions per window (both directions start afresh in each), width of a direction, training steps and windows each.
WINDOW = 96
HIDDEN = 8
STEPS = 300
BATCH = 192
UNKNOWN = "und"

_F = np.float32


@dataclass
class Network:
    """Weights of both directions (index 0 reads forward, 1 backward) and of the output layer.

    Arrays are laid out with the windows last, so that each operation runs over long rows.
    """

    classes: list[str]
    x: np.ndarray  # 2, 3H, 256: what a byte adds to the gates (update, reset, candidate)
    u: np.ndarray  # 2, 3H, H: what the state adds
    c: np.ndarray  # 2, H, 1: bias of the state's part of the candidate
    w: np.ndarray  # 2, L, H
    b: np.ndarray  # L, 1


def _step(net: Network, d: int, given: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One position of direction ``d``: the next state, and what backpropagation needs."""
    n = HIDDEN
    s = net.u[d] @ h
    gates = given[: 2 * n]
    gates += s[: 2 * n]
    gates *= _F(0.5)
    np.tanh(gates, out=gates)
    gates *= _F(0.5)
    gates += _F(0.5)
    z, r = gates[:n], gates[n:]
    inner = s[2 * n :]
    inner += net.c[d]
    new = r * inner
    new += given[2 * n :]
    np.tanh(new, out=new)
    out = h - new
    out *= z
    out += new
    return out, z, r, inner, new


def _states(net: Network, d: int, windows: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
    """States after every position, as (position, H, window); with ``keep`` what backpropagation needs too."""
    count, length = windows.shape
    h = np.zeros((HIDDEN, count), _F)
    by_position = np.ascontiguousarray(windows.T).astype(np.intp)
    states, kept = np.empty((length, HIDDEN, count), _F), []
    for t in range(length) if d == 0 else range(length - 1, -1, -1):
        before = h
        h, *rest = _step(net, d, np.take(net.x[d], by_position[t], axis=1), h)
        states[t] = h
        if keep:
            kept.append((t, before, *rest))
    return states, kept


def _probabilities(net: Network, states: list[np.ndarray]) -> np.ndarray:
    """Probabilities as (position, language, window)."""
    scores = net.w[0] @ states[0]
    scores += net.w[1] @ states[1]
    scores += net.b
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of all texts cut into windows: (windows, owner of each, filled length of each)."""
    counts = [-(-len(t) // WINDOW) for t in texts]
    flat = np.zeros(sum(counts) * WINDOW, np.uint8)
    lengths = np.full(sum(counts), WINDOW, np.int32)
    at = 0
    for t, n in zip(texts, counts, strict=True):
        if n:
            flat[at * WINDOW : at * WINDOW + len(t)] = np.frombuffer(t, np.uint8)
            lengths[at + n - 1] = len(t) - (n - 1) * WINDOW
        at += n
    return flat.reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), counts), lengths


def label_positions(net: Network, text: str) -> np.ndarray:
    """Probabilities of the languages at every byte of a text, as (byte, language)."""
    windows, _, lengths = windows_of([text.encode()])
    out = _probabilities(net, [_states(net, d, windows)[0] for d in (0, 1)])
    return np.concatenate([out[:n, :, i] for i, n in enumerate(lengths)] or [np.zeros((0, len(net.classes)), _F)])


def pooled(net: Network, texts: list[bytes], at_once: int = 2048) -> np.ndarray:
    """Mean position probabilities of each text; zeros for empty texts. ``at_once`` windows bound the memory."""
    windows, owner, lengths = windows_of(texts)
    total = np.zeros((len(texts), len(net.classes)))
    for i in range(0, len(windows), at_once):
        part, filled = windows[i : i + at_once], lengths[i : i + at_once]
        out = _probabilities(net, [_states(net, d, part)[0] for d in (0, 1)])
        for j in np.flatnonzero(filled < WINDOW):
            out[filled[j] :, :, j] = 0
        np.add.at(total, owner[i : i + at_once], out.sum(axis=0).T.astype(np.float64))
    return total / np.maximum([len(t) for t in texts], 1)[:, None]


def _gradients(net: Network, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, list]:
    """Mean loss over the positions of a batch, and its gradients (x, u, c, w, b), through time in both directions."""
    n = HIDDEN
    runs = [_states(net, d, windows, keep=True) for d in (0, 1)]
    p = _probabilities(net, [s for s, _ in runs])
    real = (np.arange(WINDOW)[:, None] < lengths[None, :]).astype(_F) / _F(lengths.sum())
    at = np.broadcast_to(labels[None, None, :], (WINDOW, 1, len(labels)))
    picked = np.take_along_axis(p, at, axis=1)[:, 0]
    loss = -(np.log(picked + 1e-12) * real).sum()
    ds = p * real[:, None]
    np.put_along_axis(ds, at, ((picked - 1) * real)[:, None], 1)
    gx, gu = np.zeros_like(net.x), np.zeros_like(net.u)
    gc, gw = np.zeros_like(net.c), np.zeros_like(net.w)
    gb = ds.sum(axis=(0, 2))[:, None]
    for d, (states, kept) in enumerate(runs):
        gw[d] = np.tensordot(ds, states, axes=([0, 2], [0, 2]))
        to_state = net.w[d].T @ ds
        dh = np.zeros((n, windows.shape[0]), _F)
        for t, before, z, r, inner, new in reversed(kept):
            dh = dh + to_state[t]
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (before - new) * z * (1 - z)
            dr = dn * inner * r * (1 - r)
            di = dn * r
            state = np.concatenate([dz, dr, di])
            one_hot = (windows[:, t][:, None] == np.arange(256)).astype(_F)
            gx[d] += np.concatenate([dz, dr, dn]) @ one_hot
            gu[d] += state @ before.T
            gc[d] += di.sum(axis=1, keepdims=True)
            dh = dh * z + net.u[d].T @ state
    return float(loss), [gx, gu, gc, gw, gb]


def train(texts: list[str], langs: list[str], steps: int = STEPS, seed: int = 7) -> Network | None:
    """A network from labelled texts, by Adam on random windows, each language drawn equally often; None without any."""
    if not texts:
        return None
    classes = sorted(set(langs))
    rng = np.random.default_rng(seed)
    n, k = HIDDEN, len(classes)

    def small(*shape: int, by: float) -> np.ndarray:
        return (rng.standard_normal(shape) * by).astype(_F)

    net = Network(
        classes, small(2, 3 * n, 256, by=0.3), small(2, 3 * n, n, by=n**-0.5), np.zeros((2, n, 1), _F),
        small(2, k, n, by=n**-0.5), np.zeros((k, 1), _F),
    )
    windows, owner, lengths = windows_of([t.encode() for t in texts])
    labels = np.array([classes.index(x) for x in langs])[owner]
    places = [np.flatnonzero(labels == i) for i in range(k)]
    places = [p for p in places if len(p)]
    if not places:
        return None
    params = [net.x, net.u, net.c, net.w, net.b]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(p, max(1, BATCH // len(places))) for p in places])
        _, grads = _gradients(net, windows[pick], lengths[pick], labels[pick])
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            g = g / max(1.0, norm)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(_F)
    return net


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: crc32 of the id as text, modulo 5, is 0; also without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network from a bounded sample of the rows that may be learned from and have a text and a language.

    The sample holds up to ``ROWS_PER_CLASS`` different texts of each language, those with the smallest hashes, and
    ``SLICE`` characters of each, at a place chosen by the hash. None if there is no such row.
    """
    t = F.col(text)
    usable = df.where(~held_out(F.col(doc_id)) & t.isNotNull() & F.col(lang).isNotNull() & t.rlike(r"\p{L}"))
    hashed = usable.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(t).alias("h")).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = hashed.withColumn("rank", rank).where(F.col("rank") <= ROWS_PER_CLASS)
    chosen = chosen.orderBy("rank", "h").limit(ROWS).select("lang", "h").collect()
    if not chosen:
        return None
    wanted = usable.where(F.xxhash64(t).isin([r["h"] for r in chosen]))
    room = F.greatest(F.char_length(t) - SLICE, F.lit(0)) + 1
    place = F.pmod(F.xxhash64(t, F.lit("place")), room.cast("long")).cast("int") + 1
    wanted = wanted.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(t).alias("h"), F.substring(t, place, F.lit(SLICE)).alias("t"))
    rows = wanted.groupBy("lang", "h").agg(F.min("t").alias("t")).orderBy("lang", "h").limit(ROWS).collect()
    return train([r["t"] for r in rows], [r["lang"] for r in rows])


def predictor(net: Network | None):
    """A column function of the text: struct (lang_pred, score)."""
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if net is not None:
                known = [i for i, t in enumerate(texts) if t]
                begin = 0
                while begin < len(known):
                    # so many texts at once as have a few million bytes
                    part, size = [], 0
                    while begin < len(known) and size < 4_000_000:
                        part.append(texts.iloc[known[begin]].encode())
                        size += len(part[-1])
                        begin += 1
                    p = pooled(net, part)
                    for i, row in zip(known[begin - len(part) : begin], p, strict=True):
                        langs[i], scores[i] = net.classes[int(row.argmax())], min(1.0, float(row.max()))
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return predict


def identify(df: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score (0 to 1); columns of these names are replaced.

    A text that is null, empty or without a letter is ``und`` with score 0, and so is every text without a network.
    Only the text is an input, whole and of any length; equal texts get equal answers.
    """
    name = free_name(df, "_answer")
    seen = F.when(F.col(text).rlike(r"\p{L}"), F.col(text))
    out = df.withColumn(name, predictor(net)(seen))
    out = out.withColumns({"lang_pred": F.col(name)["lang_pred"], "score": F.col(name)["score"]})
    return out.drop(name)
