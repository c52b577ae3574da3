"""Places of rows within groups of any size: running counts and sums without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweir.llm.common import free_name


def running(df: DataFrame, group: list[str], order: list[Column], size: Column, total: str, rows: int) -> DataFrame:
    """``df`` with ``total``: the sum of ``size`` over the rows of the same group that come before this one.

    Rows of a group are ordered by the hash of ``order``, then by ``order``. Groups are dealt into buckets by ranges of
    that hash, so many that a bucket has some ten thousand rows even if the group holds all ``rows`` of the table. A
    bucket is summed in one task; what the buckets before it hold is added from their sums. Rows that are equal in
    group and order may swap places.
    """
    buckets = max(1, rows // 20_000)
    h, bucket, s, before = (free_name(df, f"_{x}") for x in ("hash", "bucket", "size", "before"))
    out = df.withColumn(h, F.xxhash64(*order))
    # the bucket is a range of the hash's upper 31 bits, so that the order of buckets is the order of hashes
    part = F.shiftrightunsigned(F.col(h), 33) * F.lit(buckets) / F.lit(2**31)
    out = out.withColumn(bucket, F.floor(part).cast("int")).withColumn(s, size.cast("long"))
    sums = out.groupBy(*group, bucket).agg(F.sum(s).alias(before))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    within = Window.partitionBy(*group, bucket).orderBy(h, *order).rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn(total, F.coalesce(F.sum(s).over(within), F.lit(0)))
    out = out.join(sums, [*group, bucket]).withColumn(total, F.col(total) + F.col(before))
    return out.drop(h, bucket, s, before)
