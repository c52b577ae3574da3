"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. None of them is needed for right results except the time zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings every operator assumes, and give Python workers this package."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    _ship(spark)
    return spark


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send the package's own files to the executors, once per application, wherever the driver was started.

    An installed package is shadowed by the same files.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="feedweir-"), "feedweir.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder checkpoints go to: the cluster's ``spark.checkpoint.dir``.

    Only a local session that names none (tests, a laptop) gets a local scratch folder; on a cluster no executor would
    see it, so that is an error.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedweir-checkpoint-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the written copy."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``settle``, but as a table, of which columns can be read alone."""
    folder = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
