"""Documents to packed training sequences: language, near duplicates, personal data, mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet and gives the
reread rows to the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweir.llm import langid, mixing, packing, pseudonyms, sketches
from feedweir.llm.common import table, words
from feedweir.llm.queries import MIX_BLOCK, MIX_WEIGHTS, PII_KEY
from feedweir.session import checkpoint_dir, configure

# A document stays if its language is known and no less likely than this; with four languages 0.25 is no knowledge.
LEAST_SCORE = 0.3
# Words of a shingle of the near-duplicate stage; the op7 query has two.
SHINGLE = 5
# Slots of the mix that are packed together: its shortest stretch with every source's exact share, some 1.5 million
# characters.
MIX_RANGE = sum(MIX_WEIGHTS.values()) // gcd(*MIX_WEIGHTS.values())


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; texts that are null or have no letter go."""
    judged = langid.identify(docs, langid.fit(docs))
    sure = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return judged.where(sure).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every group of near duplicates: texts alike in four fifths of their five-word shingles."""
    return sketches.keep_one(docs, SHINGLE)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data and n_chars of the new text."""
    out = pseudonyms.pseudonymize(docs, PII_KEY, counts=False)
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*docs.columns)


def _mixed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, content, chars) with their places in the mix, the same whenever it is made."""
    return mixing.mix(docs, MIX_WEIGHTS, F.col("chars"), MIX_BLOCK, key=("doc_id", "content"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files that hold them in the order of the mix."""
    mixed = _mixed(docs.withColumns({"content": F.xxhash64("text"), "chars": F.char_length("text")}))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixing.in_order(mixed, files).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of every document lie in the packed sequences, which are numbered in the order of the mix.

    Rows read again have no order, so the places in the mix are made again; every ``MIX_RANGE`` slots are packed alone.
    """
    tokens = F.size(words(F.col("text"))).alias("tokens")
    content = [F.xxhash64("text").alias("content"), F.char_length("text").alias("chars")]
    counted = _mixed(docs.select("doc_id", "lang", "source", tokens, *content))
    packed = packing.pack(counted, F.col("tokens"), within=F.floor(F.col("slot") / MIX_RANGE))
    return packed.drop("content", "chars", "block", "slot", "at")


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packing", sequences),
]

# No stage but the mixture and the packing could be said in SQL; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
