"""What the operators of this folder share: word rules, row keys, written intermediate tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweir.session import checkpoint_dir

# Words are what stands between these six characters.
SPACES = r"[\x20\x09-\x0D]+"

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    """A registered query, and the same in SQL where SQL can say it."""

    plan: Plan
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and go on from the written rows.

    The lineage ends there: a lost executor costs its own tasks, not the work before. Parquet keeps the files small.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, in order; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda w: w != "")


def text_key(text: Column) -> Column:
    """Two 64-bit hashes of the whole text: equal for equal texts, and for no others in practice (128 bits)."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit("second")).alias("b"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Per place of an array, ``join`` (a sum, a maximum) over all places up to it: n log n steps for n entries.

    Every round joins each entry with the one twice as far back as the round before did.
    """

    def all_rounds(first: Column) -> Column:
        steps = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda s: s < F.size(first))

        def one(now: Column, step: Column) -> Column:
            return F.transform(now, lambda x, i: F.when(i >= step, join(x, F.get(now, i - step))).otherwise(x))

        return F.aggregate(steps, first, one)

    return bound(values, all_rounds)


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a long, b long): rows (node, component), component = smallest node.

    Alternates two steps until nothing changes: hang every larger neighbour on a node's smallest one, then every
    smaller neighbour too. Each step is a grouping and a join over the links, of which there are never more than at the
    start; a star of any size is done in one round and a chain in a logarithmic number. Only a count and a checksum
    come to the driver.
    """
    state = settle(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(
            F.explode(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        state = settle(small.select("e.u", "e.v").where("u <> v").distinct())
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # every node now hangs directly on the smallest of its component
    nodes = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
