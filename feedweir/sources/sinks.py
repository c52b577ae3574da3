"""Writing tables, payload files and versioned targets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweir.functions.filters import valid_id
from feedweir.operators.changes import cluster_columns


def write(df: DataFrame, path: str, cluster_by: object = None, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Write parquet clustered by columns: ranges of them end up in the same files, so file statistics prune reads."""
    names = cluster_columns(cluster_by)
    if names:
        df = df.repartitionByRange(*names).sortWithinPartitions(*names)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def append(feed: DataFrame, path: str, checkpoint: str | None = None):
    """Append rows as they come, without looking for duplicates; a stream returns its query."""
    if not feed.isStreaming:
        feed.write.mode("append").parquet(path)
        return None
    return feed.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").start()


def materialize(df: DataFrame, name: str, cluster_by: object = None) -> DataFrame:
    """Keep a query's result as a table and read it back."""
    names = cluster_columns(cluster_by)
    if names:
        df = df.repartitionByRange(*names).sortWithinPartitions(*names)
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def write_payloads(df: DataFrame, folder: str, key: str, payload: str, suffix: str) -> DataFrame:
    """Binary payloads to one file per row; returns the keys with ``file_path`` and ``status``.

    Keys that are not plain identifiers could leave the folder, so they are refused, not written. Files are written
    under a temporary name and renamed, so a task that runs twice leaves one whole file. ``folder`` must be mounted
    on every executor.
    """

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        for batch in batches:
            paths, states = [], []
            for name, content, good in zip(batch["key"], batch["payload"], batch["good"]):
                if not good or content is None:
                    paths.append(None)
                    states.append("refused" if not good else "no payload")
                    continue
                target = os.path.join(folder, f"{name}{suffix}")
                part = f"{target}.{uuid.uuid4().hex}"
                with open(part, "wb") as out:
                    out.write(content)
                os.replace(part, target)
                paths.append(target)
                states.append("written")
            yield pd.DataFrame({"key": batch["key"], "file_path": paths, "status": states})

    rows = df.select(
        F.col(key).cast("string").alias("key"),
        F.col(payload).cast("binary").alias("payload"),
        F.coalesce(valid_id(F.col(key).cast("string")), F.lit(False)).alias("good"),
    )
    return rows.mapInPandas(save, "key string, file_path string, status string").withColumnRenamed("key", key)


# ---------------------------------------------------------------- versioned targets


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def current_version(spark: SparkSession, target: str) -> int | None:
    """Newest complete version of a target: the highest number with a success marker."""
    fs, path = _hadoop(spark, target)
    if not fs.exists(path(target)):
        return None
    found = []
    for status in fs.listStatus(path(target)):
        name = status.getPath().getName()
        if name.startswith("v=") and fs.exists(path(f"{target}/{name}/_SUCCESS")):
            found.append(int(name[2:]))
    return max(found) if found else None


def read_target(spark: SparkSession, target: str) -> DataFrame | None:
    """Newest complete version of a target, None before the first."""
    version = current_version(spark, target)
    return None if version is None else spark.read.parquet(f"{target}/v={version}")


def write_target(df: DataFrame, target: str, version: int, partition_by: Sequence[str] = ()) -> None:
    """Write a version. The success marker comes last, so readers never see half of it; a retry overwrites it whole."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{target}/v={version}")
