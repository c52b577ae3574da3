"""Secrets in texts: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Only SQL functions: each text is searched in its own row, the models are counted by a grouping.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.llm.common import bound, free_name, running

# The base patterns. access and hex name their least lengths: a match of the open-ended pattern is the
# rest of its run, so the matches that are long enough are the same ones.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

# What the models judge: a run of identifier characters of this length or more.
TOKEN_LEAST = 16
RUN = r"[A-Za-z0-9+/_-]"
# Texts that the models are fitted on, and the least mean (per pair) and total log ratio of a secret.
SAMPLE_TEXTS = 2000
LEAST_MEAN = 0.5
# Share of the uniform distribution in the model of random strings: keys of alphabets that no label shows.
UNIFORM = 0.5
# Weight of the single characters' distribution, as so many pairs after each character.
BACK_OFF = 8
LEAST_TOTAL = 12.0

# The run characters lie between '+' and 'z'.
_FIRST, _WIDTH = ord("+"), ord("z") - ord("+") + 1
_SPANS = "array<struct<start:int,end:int>>"
_LOCATED = "array<struct<start:int,end:int,hit:string>>"


def located(text: Column, pattern: str, least: int | None = None, group: int = 0) -> Column:
    """The leftmost matches of ``pattern`` as (start, end, hit), in code points, end exclusive.

    With ``least``, a match whose ``group`` is shorter is dropped after the search. Null and empty texts have none.
    Positions are running sums of lengths, so a text is gone through once, however many matches it has.
    """

    def placed(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        lengths = F.zip_with(gaps, found, lambda gap, hit: F.char_length(gap) + F.char_length(hit))
        ends = running(lengths, lambda x, y: x + y)
        return F.zip_with(
            ends, found, lambda end, hit: F.struct((end - F.char_length(hit)).alias("start"), end.alias("end"), hit.alias("hit"))
        )

    spans = bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    if least is not None:
        parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        both = F.zip_with(spans, parts, lambda s, g: F.struct(s.alias("s"), (F.char_length(g) >= least).alias("ok")))
        spans = F.transform(F.filter(both, lambda x: x["ok"]), lambda x: x["s"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_LOCATED))


def matches(text: Column, pattern: str, least: int | None = None, group: int = 0) -> Column:
    """``located`` without the matches themselves."""
    return F.transform(located(text, pattern, least, group), lambda s: F.struct(s["start"], s["end"]))


def clear_of(spans: Column, taken: Column) -> Column:
    """The ``spans`` that overlap none of ``taken``, in order; both are arrays of (start, end).

    All are sorted together. A span is clear if nothing taken before it reaches beyond its start and the next one taken
    starts at its end or later.
    """

    def kind(of: Column, k: int) -> Column:
        return F.transform(of, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))

    def free(both: Column) -> Column:
        ends = running(F.transform(both, lambda s: F.when(s["kind"] == 0, s["end"]).otherwise(-1)), F.greatest)
        starts = F.reverse(F.transform(both, lambda s: F.when(s["kind"] == 0, s["start"]).otherwise(2**31 - 1)))
        ahead = F.reverse(running(starts, F.least))

        def judged(reach: Column) -> Column:
            def with_ahead(after: Column) -> Column:
                return F.filter(
                    both, lambda s, i: (s["kind"] == 1) & (F.get(reach, i) <= s["start"]) & (F.get(after, i) >= s["end"])
                )

            return bound(ahead, with_ahead)

        return F.transform(bound(ends, judged), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    some = (F.size(spans) > 0) & (F.size(taken) > 0)
    return F.when(some, bound(F.sort_array(F.concat(kind(taken, 0), kind(spans, 1))), free)).otherwise(spans)


def _may_assign(text: Column) -> Column:
    """A plain search for what every assignment holds; far cheaper than the pattern."""
    return text.contains("=") | text.contains(":")


def base_spans(text: Column) -> list[Column]:
    """Spans of the fixed patterns, one column per kind in the order of ``KINDS``."""
    none = F.array().cast(_SPANS)
    return [
        F.when(_may_assign(text), matches(text, ASSIGN, ASSIGN_LEAST, 2)).otherwise(none),
        F.when(text.contains("AKIA"), matches(text, ACCESS)).otherwise(none),
        matches(text, HEX),
    ]


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.ascii(c) - _FIRST)


def fit(df: DataFrame, text: str = "text", sample_texts: int = SAMPLE_TEXTS) -> list[float] | None:
    """Log ratio of every pair of neighbouring characters, random string against ordinary identifier.

    The labels are those of the base patterns: what they match is random (the value of an assignment, the key, the
    digits), every other run of identifier characters in the same texts is ordinary. The sample is bounded: the
    ``sample_texts`` different texts with a base match that have the smallest hashes. Each label has a first-order
    Markov chain that backs off to single characters, the random one mixed with the uniform distribution. None if no text has a base match; the method then adds nothing.
    """
    t = F.col(text)
    any_base = (_may_assign(t) & t.rlike(ASSIGN)) | (t.contains("AKIA") & t.rlike(ACCESS)) | t.rlike(HEX)
    hashed = df.where(any_base).select(F.xxhash64(t).alias("h"))
    cut = hashed.distinct().orderBy("h").limit(sample_texts).agg(F.max("h")).first()[0]
    if cut is None:
        return None
    texts = df.where(t.isNotNull() & (F.xxhash64(t) <= F.lit(cut))).where(any_base)
    texts = texts.groupBy(F.xxhash64(t).alias("h")).agg(F.min(t).alias("t"))
    t = F.col("t")
    value = F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2))
    value = F.filter(value, lambda v: F.char_length(v) >= ASSIGN_LEAST)
    runs = [F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in (ACCESS, HEX)]
    random = F.concat(value, *runs)
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = F.regexp_extract_all(rest, F.lit(RUN + "{2,}"), F.lit(0))
    tokens = texts.select(F.explode(random).alias("token"), F.lit(1).alias("label")).unionByName(
        texts.select(F.explode(ordinary).alias("token"), F.lit(0).alias("label"))
    )
    tokens = tokens.groupBy("label", "token").agg(F.count("*").alias("n"))
    codes = tokens.select("label", "n", _codes(F.col("token")).alias("c"))
    pairs = codes.select(
        "label",
        "n",
        F.explode(
            F.zip_with(
                F.slice(F.col("c"), F.lit(1), F.size("c") - 1),
                F.slice(F.col("c"), F.lit(2), F.size("c") - 1),
                lambda a, b: F.struct(a.alias("a"), b.alias("b")),
            )
        ).alias("p"),
    )
    # at most two counts for each of the 80 x 80 pairs
    counts = pairs.where(f"p.a between 0 and {_WIDTH - 1} and p.b between 0 and {_WIDTH - 1}")
    rows = counts.groupBy("label", "p.a", "p.b").agg(F.sum("n").alias("n")).collect()
    seen = {(r["label"], r["a"], r["b"]): r["n"] for r in rows}
    after, alone, every = Counter(), Counter(), Counter()
    for (label, a, b), n in seen.items():
        after[label, a] += n
        alone[label, b] += n
        every[label] += n

    def log_p(label: int, a: int, b: int) -> float:
        single = (alone[label, b] + 1) / (every[label] + _WIDTH)
        p = (seen.get((label, a, b), 0) + BACK_OFF * single) / (after[label, a] + BACK_OFF)
        return math.log((1 - UNIFORM) * p + UNIFORM / _WIDTH if label else p)

    return [log_p(1, a, b) - log_p(0, a, b) for a in range(_WIDTH) for b in range(_WIDTH)]


def log_ratio(token: Column, table: Column) -> Column:
    """Sum of the log ratios of the neighbouring characters of ``token``."""

    def total(codes: Column) -> Column:
        ratios = F.zip_with(
            F.slice(codes, F.lit(1), F.size(codes) - 1),
            F.slice(codes, F.lit(2), F.size(codes) - 1),
            lambda a, b: F.element_at(table, (a * _WIDTH + b + 1).cast("int")),
        )
        return F.aggregate(ratios, F.lit(0.0), lambda acc, r: acc + r)

    return F.element_at(F.transform(F.array(_codes(token)), total), 1)


def model_spans(text: Column, ratios: list[float] | None) -> Column:
    """Spans of the runs of identifier characters that look random; none without a model."""
    if ratios is None:
        return F.array().cast(_SPANS)
    table = F.split(F.lit(",".join(f"{r:.5f}" for r in ratios)), ",").cast("array<double>")
    runs = located(text, RUN + f"{{{TOKEN_LEAST},}}")

    def random(span: Column) -> Column:
        pairs = span["end"] - span["start"] - 1
        return bound(log_ratio(span["hit"], table), lambda s: (s >= LEAST_TOTAL) & (s >= LEAST_MEAN * pairs))

    return F.transform(F.filter(runs, random), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def scan(df: DataFrame, text: str = "text", sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """``df`` with one column more, ``secrets``: array of (kind, start, end), by start and then by kind.

    Base spans are always kept; a run that the models call random is added unless it overlaps a base span. Null and
    empty texts have none; rows are judged alone, so copies get the same spans. If ``df`` has a column ``secrets``
    already, the new one is called ``_secrets``.
    """
    ratios = fit(df, text, sample_texts)
    name = free_name(df, "secrets")
    t = F.col(text)
    kinds = [free_name(df, f"_{k}") for k in KINDS]
    found = df.withColumns(dict(zip(kinds[:3], base_spans(t), strict=True)))
    base = F.concat(*[F.col(k) for k in kinds[:3]])

    found = found.withColumn(kinds[3], clear_of(model_spans(t, ratios), base))

    def tagged(column: str, kind: int) -> Column:
        return F.transform(F.col(column), lambda s: F.struct(s["start"], F.lit(kind).alias("kind"), s["end"]))

    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.transform(
        F.sort_array(F.concat(*[tagged(c, i) for i, c in enumerate(kinds)])),
        lambda s: F.struct(F.element_at(names, s["kind"] + 1).alias("kind"), s["start"], s["end"]),
    )
    return found.withColumn(name, ordered).drop(*kinds)


def of_kind(spans: Column, kind: str) -> Column:
    """The spans of one kind."""
    return F.filter(spans, lambda s: s["kind"] == kind)


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
