"""The registered queries of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweir.llm import (
    langid,
    linededup,
    lines,
    mixing,
    negatives,
    packing,
    pseudolikelihood,
    pseudonyms,
    secrets,
    sketches,
    substrings,
    vectors,
    whitening,
)
from feedweir.llm.common import Query, table, words
from feedweir.session import configure

# The key of the pseudonyms; a real run brings its own.
PII_KEY = "example-key"
# Target shares of the mix, in parts; the last one is for all other sources together.
MIX_WEIGHTS = {"src0": 12, **{f"src{i}": 4 for i in range(1, 20)}, None: 4}
MIX_BLOCK = 1 << 16


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    counted = docs.select("doc_id", F.size(words(F.col("text"))).alias("tokens"))
    return packing.pack(counted, F.col("tokens"))


def op2_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_masked_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents").select("doc_id", "text")
    counts = pseudolikelihood.word_counts(docs)
    net, vocabulary = pseudolikelihood.fit(docs, counts=counts)
    return pseudolikelihood.score_words(docs, net, vocabulary, counts).select("doc_id", "n_tokens", "log_prob", "score")


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = lines.judge(table(configure(spark), sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *counts, "n_shared_words")


def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    sized = docs.select("doc_id", "source", F.xxhash64("text").alias("content"), F.char_length("text").alias("chars"))
    mixed = mixing.mix(sized, MIX_WEIGHTS, F.col("chars"), MIX_BLOCK, key=("doc_id", "content"))
    return mixed.select("doc_id", "source", "block", "slot", "at")


def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymize(table(configure(spark), sf_dir, "documents"), PII_KEY)


def op7_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.link(table(configure(spark), sf_dir, "documents"))


def op8_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link(table(configure(spark), sf_dir, "embeddings"))


def op9_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removals(table(configure(spark), sf_dir, "documents"))


def op10_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(configure(spark), sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "markov")
    count = {k: F.size(secrets.of_kind(F.col("secrets"), k)) for k in secrets.KINDS}
    return found.select(
        "doc_id",
        *[count[k].cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("secrets")).alias("spans"),
        count["markov"].cast("long").alias("n_markov"),
    )


def op11_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(configure(spark), sf_dir, "embeddings"))


def op12_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents").select("doc_id", "text")
    found = linededup.keep_bitmaps(docs)
    kept = F.sha2(linededup.kept_text(F.col("text"), F.col("keep")), 256)
    return found.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


OP12_SQL = """
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM line
), gone AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(gone.key) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE gone.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN gone USING (key)
GROUP BY doc_id
"""


def op13_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(configure(spark), sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = whitening.prepared(vectors, 256, 0, moved.alias("label"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * c::DOUBLE) FOR c IN embedding] AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_inner_product(a.x, b.x)::BIGINT AS score
    FROM rows a, rows b
    WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER best)::INTEGER AS rank, other_id AS negative_id, positive_score,
    score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER best <= 5
"""


QUERIES = {
    "op1_best_fit_packing": Query(op1_best_fit_packing),
    "op2_byte_language": Query(op2_byte_language),
    "op3_masked_likelihood": Query(op3_masked_likelihood),
    "op4_line_frequency": Query(op4_line_frequency),
    "op5_pfair_mix": Query(op5_pfair_mix),
    "op6_feistel_pseudonyms": Query(op6_feistel_pseudonyms),
    "op7_similarity_sketch": Query(op7_similarity_sketch),
    "op8_flat_graph": Query(op8_flat_graph),
    "op9_fm_index": Query(op9_fm_index),
    "op10_markov_secrets": Query(op10_markov_secrets),
    "op11_qd_whitening": Query(op11_qd_whitening),
    "op12_line_bitmaps": Query(op12_line_bitmaps, OP12_SQL),
    "op13_segment_negatives": Query(op13_segment_negatives, OP13_SQL),
}
