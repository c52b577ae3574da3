"""Language identification, document scores: gradients, held-out accuracy, brute force and odd tables."""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from feedweir.llm import langid, pseudolikelihood, wordhash


def test_language_gradients(monkeypatch):
    monkeypatch.setattr(langid, "WINDOW", 10)
    monkeypatch.setattr(langid, "_F", np.float64)
    rng, n = np.random.default_rng(0), langid.HIDDEN
    shapes = [(2, 3 * n, 256), (2, 3 * n, n), (2, n, 1), (2, 3, n), (3, 1)]
    net = langid.Network(["a", "b", "c"], *[rng.standard_normal(s) * 0.4 for s in shapes])
    windows, owner, lengths = langid.windows_of([b"hello world this", b"abc", b"something else"])
    labels = np.array([0, 1, 2])[owner]
    _, grads = langid._gradients(net, windows, lengths, labels)
    for p, g in zip([net.x, net.u, net.c, net.w, net.b], grads, strict=True):
        i, e = np.argmax(abs(g)), 1e-6
        v = p.flat[i]
        p.flat[i] = v + e
        up = langid._gradients(net, windows, lengths, labels)[0]
        p.flat[i] = v - e
        down = langid._gradients(net, windows, lengths, labels)[0]
        p.flat[i] = v
        assert abs(g.flat[i] - (up - down) / (2 * e)) < 1e-5


def test_language_of_held_out_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = langid.fit(df)
    rows = langid.identify(df, net).withColumn("h", langid.held_out(F.col("doc_id"))).collect()
    test = [r for r in rows if r["h"]]
    assert {r["doc_id"] for r in test} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert sum(r["lang"] == r["lang_pred"] for r in test) >= 0.97 * len(test)
    assert all(0 <= r["score"] <= 1 for r in rows)
    # every position is labelled, and the document is their mean, whatever is processed together
    text = "".join(r["text"] for r in rows[:3])
    by_position = langid.label_positions(net, text)
    assert by_position.shape == (len(text.encode()), len(net.classes))
    pooled = langid.pooled(net, [text.encode(), b"x"], at_once=7)[0]
    assert np.allclose(by_position.mean(axis=0), pooled, atol=1e-4)


def test_language_on_odd_tables(docs):
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "abc"), (4, "abc"), (None, "é" * 40000), (6, "z" * 200000)]
    df = docs(rows).withColumns({"score": F.lit("x"), "_answer": F.lit(3)})
    out = langid.identify(df, langid.train(["abc abc", "xyz xyz"], ["p", "q"], steps=5)).collect()
    assert len(out) == len(rows) and all(r["_answer"] == 3 for r in out)
    assert [(r["lang_pred"], r["score"]) for r in out[:3]] == [("und", 0.0)] * 3
    assert out[3]["score"] == out[4]["score"] and {r["lang_pred"] for r in out[3:]} <= {"p", "q"}
    assert langid.fit(docs([])) is None
    assert langid.identify(docs([]), None).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs(rows), None).collect()} == {"und"}
    unlabelled = docs([(i, "some text", None, "s", 1) for i in range(20)])
    assert langid.fit(unlabelled) is None


def brute_log_probability(net, token_ids):
    """One token at a time, with a dictionary of all digits."""
    tables, bias, out, out_bias, given = [p.astype(float) for p in net]
    total, d = 0.0, pseudolikelihood.DIGIT
    for i, t in enumerate(token_ids):
        h = bias.copy()
        for k, o in enumerate(pseudolikelihood.OFFSETS):
            j = i + o
            h += tables[k][token_ids[j] if 0 <= j < len(token_ids) else 0]
        s = np.tanh(h) @ out + out_bias
        first = np.exp(s[:d]) / np.exp(s[:d]).sum()
        second = np.exp(s[d:] + given[t // d])
        total += np.log(first[t // d]) + np.log(second[t % d] / second.sum())
    return total


def test_scores(spark, sample):
    net, vocabulary = pseudolikelihood.fit(sample)
    rows = pseudolikelihood.score(sample, net, vocabulary).collect()
    assert len(rows) == sample.count()
    for r in rows[:40]:
        ids = pseudolikelihood.numbers(r["text"], vocabulary)
        assert r["n_tokens"] == len(ids)
        expected = brute_log_probability(net, ids)
        assert abs(r["log_prob"] - expected) < 1e-3 * max(1, abs(expected))
    # the trained network beats the untrained one, and shuffled words score less than the text
    row, at = pseudolikelihood._laid_out([pseudolikelihood.numbers(r["text"], vocabulary) for r in rows])
    trained = pseudolikelihood.log_probabilities(net, row, at).mean()
    assert trained > pseudolikelihood.log_probabilities(pseudolikelihood.start(), row, at).mean() + 0.2
    mixed = row.copy()
    mixed[at] = np.random.default_rng(0).permutation(row[at])
    assert trained > pseudolikelihood.log_probabilities(net, mixed, at).mean()


def test_vocabulary_counts_all(docs):
    df = docs([(1, "b A a"), (2, None), (3, "a\tb c")])
    assert pseudolikelihood.vocabulary_of(df) == {b"a": 1, b"b": 2, b"c": 3}


def test_scores_on_odd_tables(docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "w"), (4, "w"), (None, "u v " * 60000)]
    df = docs(rows).withColumns({"score": F.lit("x"), "_scored": F.lit(1)})
    out = pseudolikelihood.score(df, *pseudolikelihood.fit(df)).collect()
    assert [(r["n_tokens"], r["log_prob"], r["score"]) for r in out[:3]] == [(0, 0.0, None)] * 3
    assert out[3]["score"] == out[4]["score"] and out[5]["n_tokens"] == 120000 and out[5]["_scored"] == 1
    net, vocabulary = pseudolikelihood.fit(docs([]))
    assert vocabulary == {} and pseudolikelihood.score(docs([]), net, vocabulary).count() == 0


def test_scores_tell_words_of_a_bucket_apart(docs, monkeypatch):
    """Every word's share of its bucket against plain Python; a word never seen scores less than known ones."""
    monkeypatch.setattr(pseudolikelihood, "START_STEPS", 2)
    corpus = [(i, " ".join(f"w{j}" for j in range(3000) if i % (j % 7 + 1) == 0)) for i in range(12)]
    df = docs(corpus)
    counts = pseudolikelihood.word_counts(df)
    net, vocabulary = pseudolikelihood.fit(df, counts=counts)
    known = {r["w"]: r["n"] for r in counts.collect()}
    buckets = {}
    for w, n in known.items():
        if w.encode() not in vocabulary:
            b = buckets.setdefault(int(pseudolikelihood.numbers(w, vocabulary)[0]), [0, {}])
            b[0] += n + 1
            b[1][w] = n
    word = max(buckets.items(), key=lambda x: len(x[1][1]))[0]
    junk = next(f"junk{i}" for i in range(10**6) if pseudolikelihood.numbers(f"junk{i}", vocabulary)[0] == word)
    real = min(buckets[word][1])
    asked = [*corpus, (100, real), (101, junk), (101, junk), (102, None), (103, f"W1 {junk}  {real} {real}")]
    plain = pseudolikelihood.score(docs(asked), net, vocabulary).collect()
    got = pseudolikelihood.score_words(docs(asked), net, vocabulary, counts).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in asked)
    base, result = {r["doc_id"]: r["log_prob"] for r in plain}, {r["doc_id"]: r for r in got}
    for d, t in asked:
        expected = base[d]
        for w in (t or "").lower().split():
            if w.encode() not in vocabulary:
                whole, inside = buckets[int(pseudolikelihood.numbers(w, vocabulary)[0])]
                expected += np.log((inside.get(w, 0) + 1) / (whole + 1))
        assert abs(result[d]["log_prob"] - expected) < 1e-6 * max(1, abs(expected))
    assert base[100] == base[101] and result[100]["score"] > result[101]["score"]
    assert result[102]["score"] is None and result[102]["log_prob"] == 0


def test_word_hashes():
    """Equal for equal words, wherever they stand; different for all others; the words are those of bytes.split."""
    rng = np.random.default_rng(9)
    texts = [b"", b" \t\n", b"a", b" a b  a\x0bb\x0c\r", "é ß\u2003x é".encode(), b"ab ba aab aba baa \x00 \x00\x00", b"y" * 700_000 + b" a"]
    texts += [b" ".join(rng.bytes(int(n)).translate(None, b" \t\n\x0b\x0c\r") for n in rng.integers(1, 9, 3000)) for _ in range(60)]
    texts += [b"a b " * 400_000 + b"c", b"x" * 600_000]
    found, seen = list(wordhash.word_hashes(texts)), {}
    for text, hashes in zip(texts, found, strict=True):
        words = text.split()
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes.tolist(), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen) > 100_000


def test_places_of_hashes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 700, 100_000):
        hashes = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        hashes = np.sort(np.concatenate([hashes, hashes[:2], np.arange(n % 9, dtype=np.uint64)]))
        ends = np.array([0, 1, (1 << 63) - 1, 1 << 63, (1 << 64) - 1], np.uint64)
        asked = np.concatenate([hashes, hashes + np.uint64(1), ends, rng.integers(0, 1 << 64, 5000, dtype=np.uint64)])
        places = wordhash.Places(hashes)
        assert np.array_equal(places.of(asked), np.searchsorted(places.hashes, asked))


def test_scores_and_gradients_in_blocks(monkeypatch):
    """Few tokens and bytes at a time, whatever comes together; gradients are those of all tokens in double precision."""
    sizes, bytes_at_once, d = [], [], pseudolikelihood.DIGIT
    forward, hashed = pseudolikelihood._forward, wordhash._hashed
    monkeypatch.setattr(pseudolikelihood, "_forward", lambda net, row, at, *x: sizes.append(len(at)) or forward(net, row, at, *x))
    monkeypatch.setattr(wordhash, "_hashed", lambda b: bytes_at_once.append(len(b)) or hashed(b))
    rng, net = np.random.default_rng(4), pseudolikelihood.start()
    net[1:] = [rng.standard_normal(p.shape).astype(np.float32) * np.float32(0.3) for p in net[1:]]
    tables, bias, out, out_bias, given = (p.astype(float) for p in net)
    row = rng.integers(0, pseudolikelihood.TOKENS, 20_000)
    for size in (0, 1, 1024, 1025, 2047, 8191, 8192, 8193, 10_000):
        at = rng.permutation(np.arange(2, 19_000))[:size]
        h = np.tanh(sum(tables[k][row[at + o]] for k, o in enumerate(pseudolikelihood.OFFSETS)) + bias)
        scores = np.exp((h @ out + out_bias).reshape(-1, 2, d) + np.stack([np.zeros((size, d)), given[row[at] // d]], axis=1))
        scores /= scores.sum(axis=2, keepdims=True)
        n, first, second = np.arange(size), row[at] // d, row[at] % d
        expected = np.log(scores[n, 0, first]) + np.log(scores[n, 1, second])
        assert np.allclose(pseudolikelihood.log_probabilities(net, row, at), expected, atol=1e-4)
        if not size:
            continue
        scores[n, 0, first] -= 1
        scores[n, 1, second] -= 1
        ds = scores.reshape(size, -1) / size
        dh = ds @ out.T * (1 - h * h)
        dt, dg = np.zeros_like(tables), np.zeros_like(given)
        for k, o in enumerate(pseudolikelihood.OFFSETS):
            np.add.at(dt[k], row[at + o], dh)
        np.add.at(dg, first, ds[:, d:])
        for got, want in zip(pseudolikelihood.gradients(net, row, at), [dt, dh.sum(0), h.T @ ds, ds.sum(0), dg], strict=True):
            assert np.allclose(got, want, atol=1e-6)
    list(wordhash.word_hashes([b"some words " * 50] * 2000))
    assert max(sizes) < 2 * pseudolikelihood.BLOCK and max(bytes_at_once) <= 1 << 17


def test_word_counts_and_keys_of_odd_words(docs):
    """Words of all six spaces and no others; the keys of many words, one longer than a buffer, are those of each alone."""
    text = " \tA b\x0bb\n\nc d\rc D\x0cé\x1fé x" + "y" * 200_000 + " "
    got = {r["w"]: r["n"] for r in pseudolikelihood.word_counts(docs([(1, text), (2, None), (3, ""), (4, " \n"), (4, "b")])).collect()}
    assert got == {"a": 1, "b": 3, "c d": 2, "é\x1fé": 1, "x" + "y" * 200_000: 1}
    words = [*got, *(f"w{i}" for i in range(30_000))]
    codes = pseudolikelihood.Codes({b"b": 7, b"w5": 8})
    alone = np.concatenate(list(pseudolikelihood.keys(words, codes)))
    hashes = pseudolikelihood._word_key.func(pd.Series(words)).to_numpy()
    known = np.array([w in ("b", "w5") for w in words])
    assert np.array_equal(alone[~known], hashes[~known]) and alone[known].tolist() == [7, 8]
    assert np.array_equal(next(pseudolikelihood.keys([" ".join(words)], codes)), alone)
