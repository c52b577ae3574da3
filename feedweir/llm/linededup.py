"""Lines that many documents share, by range-partitioned line hashes.

Every line goes out as a small row (hash of its key, document, position). The rows are range-partitioned by hash and
sorted by document and position within; streaming over them, the first occurrence of a line in a document differs from
the row before it. First occurrences are counted per line. What comes back is not text but one compressed bitmap per
document: the runs of lines that go.

Only SQL functions. A line that a third of all documents hold is no hot key: its rows are dealt into blocks by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweir.llm.common import free_name, settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = " \t\n\x0b\x0c\r"
# Rows of lines for which there is one block more; a block holds a share of the documents of every line.
BLOCK_ROWS = 1_000_000
LEAST_BLOCKS = 16


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def lowered(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_rows(df: DataFrame, text: str, ident: str, least_chars: int) -> DataFrame:
    """Rows (h, g, doc, content, at): a 96-bit hash of every line's key, its document, the hash of its text, its position.

    Keys of fewer than ``least_chars`` code points have no row. The rows are written, since they are read three times.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(ident).alias("doc"), F.xxhash64(body).alias("content"), F.posexplode(split_lines(lowered(body))).alias("at", "line")
    )
    key = F.btrim("line", F.lit(BLANK))
    rows = rows.select("doc", "content", "at", key.alias("key")).where(F.char_length("key") >= least_chars)
    return settle(rows.select(F.xxhash64("key").alias("h"), F.hash("key").alias("g"), "doc", "content", "at"))


def dropped_runs(
    df: DataFrame, text: str = "text", ident: str = "doc_id", least_docs: int = 10, least_chars: int = 1
) -> DataFrame:
    """Rows (doc, content, runs): per document that loses lines, the runs (first, last) of their positions, from 0.

    A document is what shares ``ident``, null too; rows of one document may hold different texts, whose hash is
    ``content``. A line goes if its key has ``least_chars`` code points and is in ``least_docs`` documents.
    """
    rows = line_rows(df, text, ident, least_chars)
    blocks = max(LEAST_BLOCKS, rows.count() // BLOCK_ROWS)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc"), F.lit(blocks)).cast("int"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.drop("content").repartitionByRange(parts, "h", "g", "block")
    ranged = ranged.sortWithinPartitions("h", "g", "block", "doc", "at")
    # the window needs neither an exchange nor a sort: rows lie as the lines above left them
    order = Window.partitionBy("h", "g", "block").orderBy("doc", "at")
    first = (F.row_number().over(order) == 1) | ~F.lag("doc").over(order).eqNullSafe(F.col("doc"))
    counted = ranged.withColumn("first", first).groupBy("h", "g", "block").agg(F.count_if("first").alias("docs"))
    total = F.sum("docs").over(Window.partitionBy("h", "g"))
    common = settle(counted.withColumn("total", total).where(F.col("total") >= least_docs).select("h", "g", "block"))
    gone = rows.join(common, ["h", "g", "block"]).groupBy("doc", "content").agg(F.sort_array(F.collect_set("at")).alias("p"))
    return gone.select("doc", "content", runs(F.col("p")).alias("runs"))


def runs(p: Column) -> Column:
    """Rising positions as runs (first, last)."""

    def of(a: Column) -> Column:
        first = F.filter(a, lambda x, i: ~F.coalesce(F.get(a, i - 1) == x - 1, F.lit(False)))
        last = F.filter(a, lambda x, i: ~F.coalesce(F.get(a, i + 1) == x + 1, F.lit(False)))
        return F.zip_with(first, last, lambda x, y: F.struct(x.alias("first"), y.alias("last")))

    return F.element_at(F.transform(F.array(p), of), 1)


def keep_bitmaps(
    df: DataFrame, text: str = "text", ident: str = "doc_id", least_docs: int = 10, least_chars: int = 1
) -> DataFrame:
    """``df`` with n_lines, n_dropped and keep, the compressed bitmap of the lines that stay; columns so named are replaced.

    ``keep`` is run-length coded: the runs (first, last) of the positions that stay, from 0. A text without lost lines
    has one run, one that loses all of them none. Null and empty texts are one empty line, which stays unless
    ``least_chars`` is 0. Rows that share ``ident`` are one document in the counts, and each has its own bitmap; equal
    rows have equal results. An empty table gives an empty one.
    """
    gone = dropped_runs(df, text, ident, least_docs, least_chars)
    match, content, found = (free_name(df, f"_{x}") for x in ("doc", "content", "runs"))
    gone = gone.select(F.col("doc").alias(match), F.col("content").alias(content), F.col("runs").alias(found))
    here = free_name(df, "_here")
    out = df.withColumn(here, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = F.col(ident).eqNullSafe(F.col(match)) & (F.col(here) == F.col(content))
    out = out.join(gone, same, "left").drop(here, match, content)
    cuts = F.coalesce(F.col(found), F.array().cast("array<struct<first:int,last:int>>"))
    out = out.withColumn(found, cuts).withColumn("n_lines", F.size(split_lines(F.col(text))).cast("long"))
    lost = F.aggregate(found, F.lit(0).cast("long"), lambda total, r: total + r["last"] - r["first"] + 1)

    def staying(r: Column) -> Column:
        def run(j: Column) -> Column:
            first = F.when(j == 0, F.lit(0)).otherwise(F.get(r, j - 1)["last"] + 1)
            last = F.when(j == F.size(r), F.col("n_lines").cast("int") - 1).otherwise(F.get(r, j)["first"] - 1)
            return F.struct(first.alias("first"), last.alias("last"))

        every = F.transform(F.sequence(F.lit(0), F.size(r)), run)
        return F.filter(every, lambda x: x["first"] <= x["last"])

    keep = F.element_at(F.transform(F.array(F.col(found)), staying), 1)
    return out.withColumn("n_dropped", lost).withColumn("keep", keep).drop(found)


def kept_text(text: Column, keep: Column) -> Column:
    """The lines that stay by ``keep``, joined by \\n."""

    def joined(lines: Column) -> Column:
        return F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["first"] + 1, r["last"] - r["first"] + 1))), "\n")

    return F.element_at(F.transform(F.array(split_lines(text)), joined), 1)


def deduplicate(df: DataFrame, text: str = "text", ident: str = "doc_id", least_docs: int = 10, least_chars: int = 1) -> DataFrame:
    """``df`` with n_lines, n_dropped, keep and the text without the lines that go (never null)."""
    out = keep_bitmaps(df, text, ident, least_docs, least_chars)
    return out.withColumn(text, kept_text(F.col(text), F.col("keep")))
