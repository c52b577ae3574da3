"""Quality rules over documents: counts in a text, and how many documents of a host share its lines.

Only SQL functions. Counting needs no shuffle; the line rule shuffles one small row per different line of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.llm.common import free_name, settle, words

SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
# A line is boilerplate if more documents of the host hold it than this share of them, and than this many; so a
# document is judged alike on hosts of any size, and lines that a few documents share are never boilerplate. A document
# is depleted if less than LEAST_LEFT of its words is left without such lines.
MOST_SHARE, MOST_DOCS = 0.002, 20
LEAST_LEFT = 0.3
# Copies of each boilerplate line that the join deals out, so that a line of every document of a host is no hot key.
# A boilerplate line is in more than MOST_DOCS documents, so the copies are fewer than the lines that they meet.
SALTS = 16


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.element_at(F.transform(F.array(lines), lambda a: F.size(a) - F.size(F.array_distinct(a))), 1)


def repeat_words(ws: Column) -> Column:
    """Words inside three-word windows that the array of words holds twice or more, the first one included.

    Windows are sorted by a 64-bit hash, equal neighbours marked, and the union of the marked windows is measured in
    order of position: n log n for any text.
    """
    n = F.size(ws)
    grams = F.transform(
        F.sequence(F.lit(1), n - 2),
        lambda i: F.struct(
            F.xxhash64(F.element_at(ws, i), F.element_at(ws, i + 1), F.element_at(ws, i + 2)).alias("h"),
            i.alias("i"),
        ),
    )

    def marked(g: Column) -> Column:
        return F.filter(
            g,
            lambda x, k: (F.coalesce(F.get(g, k - 1)["h"] == x["h"], F.lit(False)))
            | (F.coalesce(F.get(g, k + 1)["h"] == x["h"], F.lit(False))),
        )

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda acc, s: acc + s)

    starts = F.transform(F.array(F.sort_array(grams)), lambda g: F.transform(marked(g), lambda x: x["i"]))
    starts = F.element_at(starts, 1)
    count = F.element_at(F.transform(F.array(F.sort_array(starts)), covered), 1)
    return F.when(n >= 4, count).otherwise(F.lit(0))


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed.

    Null and empty texts count as zero everywhere and fail. Columns of these names in ``df`` are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    ws = free_name(df, "_words")
    out = df.withColumn(ws, words(F.col(text)))
    counts = {
        "n_words": F.size(ws),
        "word_chars": F.char_length(F.array_join(ws, "")),
        "n_symbols": F.size(F.split(t, SYMBOLS, -1)) - 1,
        "n_dup_lines": dup_lines(t),
        "n_repeat_words": repeat_words(F.col(ws)),
    }
    out = out.withColumns({k: v.cast("long") for k, v in counts.items()}).drop(ws)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def normal_line(line: Column) -> Column:
    """A line without case, digits, punctuation and repeated spaces."""
    plain = F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " ")
    return F.trim(F.regexp_replace(plain, r"\p{N}+", "0"))


def line_counts(df: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Lines of the documents as hashes: rows (host, line, doc, n), n = words of the document in such lines, times copies.

    A line is a 64-bit hash of host and normal form, a document a 128-bit hash of host and text. Equal texts of a host
    are one document here: copies are no sign of boilerplate. Null hosts are one host; null texts have no lines. The rows
    are written once, since the limits and the removal both read them.
    """
    key = F.coalesce(F.concat(F.lit("h:"), F.col(host).cast("string")), F.lit("n"))
    docs = df.select(key.alias("host"), F.col(text).alias("text")).where("text is not null")
    lines = docs.select(
        "host",
        F.struct(F.xxhash64("host", "text").alias("a"), F.xxhash64("text", "host").alias("b")).alias("doc"),
        F.explode(F.split("text", "\n", -1)).alias("line"),
    )
    lines = lines.select("host", "doc", normal_line(F.col("line")).alias("normal"), F.size(words(F.col("line"))).alias("n"))
    lines = lines.where("normal <> ''").select(F.xxhash64("host").alias("host"), F.xxhash64("host", "normal").alias("line"), "doc", "n")
    return settle(lines.groupBy("host", "line", "doc").agg(F.sum("n").alias("n")))


def boilerplate(df: DataFrame, found: DataFrame, text: str, host: str, most_docs: int, most_share: float) -> DataFrame:
    """The lines (line, salt) of ``found`` above the limits, ``SALTS`` copies of each.

    Documents per line and per host are counted before anything is joined; only lines above ``most_docs`` meet the
    sizes of their hosts.
    """
    key = F.coalesce(F.concat(F.lit("h:"), F.col(host).cast("string")), F.lit("n"))
    docs = df.select(key.alias("host"), F.col(text).alias("text")).where("text is not null")
    docs = docs.select(F.xxhash64("host").alias("host"), F.xxhash64("host", "text").alias("a"), F.xxhash64("text", "host").alias("b"))
    sizes = docs.distinct().groupBy("host").agg(F.count("*").alias("size"))
    often = found.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > most_docs)
    above = often.join(sizes, "host").where(F.col("docs") > most_share * F.col("size")).select("line")
    return above.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def judge(
    df: DataFrame,
    text: str = "text",
    host: str = "source",
    most_docs: int = MOST_DOCS,
    least_left: float = LEAST_LEFT,
    most_share: float = MOST_SHARE,
) -> DataFrame:
    """``df`` with the counts, n_shared_words (words in lines above the limit) and kept.

    kept is false if base_failed, or if less than ``least_left`` of the words are left without the shared lines.
    Every row is judged, copies alike; a document's own repeats of a line count once.
    """
    out = with_counts(df, text)
    key = F.coalesce(F.concat(F.lit("h:"), F.col(host).cast("string")), F.lit("n"))
    doc, match = free_name(out, "_doc"), free_name(out, "_key")
    body = F.col(text)
    ident = F.when(
        body.isNotNull(), F.struct(F.xxhash64(key, body).alias("a"), F.xxhash64(body, key).alias("b"))
    )
    out = out.withColumn(doc, ident)
    found = line_counts(df, text, host)
    above = boilerplate(df, found, text, host, most_docs, most_share)
    salted = found.withColumn("salt", F.pmod(F.col("doc.a"), F.lit(SALTS)).cast("int"))
    shared = salted.join(above, ["line", "salt"]).groupBy("doc").agg(F.sum("n").alias("n"))
    copies = out.where(F.col(doc).isNotNull()).groupBy(F.col(doc).alias("doc")).agg(F.count("*").alias("copies"))
    shared = shared.join(copies, "doc").select(
        F.col("doc").alias(match), (F.col("n") / F.col("copies")).cast("long").alias("n_shared_words")
    )
    out = out.drop("n_shared_words", "kept").join(shared, F.col(doc) == F.col(match), "left").drop(doc, match)
    out = out.withColumn("n_shared_words", F.coalesce("n_shared_words", F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("n_shared_words")
    return out.withColumn("kept", ~F.col("base_failed") & (left >= least_left * F.col("n_words")))


def without_shared(
    df: DataFrame, text: str = "text", host: str = "source", most_docs: int = MOST_DOCS, most_share: float = MOST_SHARE
) -> DataFrame:
    """``df`` with the lines above the limit taken out of ``text``; other rows and lines are unchanged.

    The shared lines of a document travel as hashes, so a text moves only with its own row.
    """
    key = F.coalesce(F.concat(F.lit("h:"), F.col(host).cast("string")), F.lit("n"))
    doc, gone, match = free_name(df, "_doc"), free_name(df, "_gone"), free_name(df, "_key")
    found = line_counts(df, text, host)
    above = boilerplate(df, found, text, host, most_docs, most_share)
    salted = found.withColumn("salt", F.pmod(F.col("doc.a"), F.lit(SALTS)).cast("int"))
    lines = salted.join(above, ["line", "salt"]).groupBy("doc").agg(F.collect_set("line").alias(gone))
    lines = lines.withColumnRenamed("doc", match)
    body = F.col(text)
    ident = F.struct(F.xxhash64(key, body).alias("a"), F.xxhash64(body, key).alias("b"))
    out = df.withColumn(doc, F.when(body.isNotNull(), ident)).join(lines, F.col(doc) == F.col(match), "left")
    kept = F.filter(
        F.split(body, "\n", -1), lambda x: ~F.array_contains(F.col(gone), F.xxhash64(key, normal_line(x)))
    )
    cut = F.when(F.col(gone).isNull(), body).otherwise(F.array_join(kept, "\n"))
    return out.withColumn(text, cut).select(*df.columns)
