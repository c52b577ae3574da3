"""Joins between parents and children, members, intervals and times.

No side is ever marked for broadcast here: Spark decides from sizes it knows, and adaptive execution splits skewed
partitions of the sort-merge joins. Sides that are only counted are aggregated before they are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.functions.literals import literal
from feedweir.operators.ordering import with_nearest


def channel_summary(
    messages: DataFrame,
    teams: DataFrame,
    channels: DataFrame,
    team_key: str,
    channel_key: str,
    created: str,
    modified: str,
) -> DataFrame:
    """Messages per channel with both names; unknown teams and channels stay, with null names.

    ``teams`` and ``channels`` have their key under the same name and a ``name``. Messages are counted per key pair
    first, so the joins move one row per pair.
    """
    counted = messages.groupBy(team_key, channel_key).agg(
        F.count(F.lit(1)).alias("n"), F.max(modified).alias("hi"), F.min(created).alias("lo")
    )
    named = counted.join(teams.select(team_key, F.col("name").alias("team_name")), team_key, "left").join(
        channels.select(channel_key, F.col("name").alias("channel_name")), channel_key, "left"
    )
    return named.groupBy("team_name", "channel_name").agg(
        F.sum("n").alias("message_count"), F.max("hi").alias("latest_message"), F.min("lo").alias("oldest_message")
    )


def thread_summary(messages: DataFrame, replies: DataFrame, on: str, replied: str) -> DataFrame:
    """Messages that have replies, with their number and the latest; replies are counted before the join."""
    counted = replies.groupBy(on).agg(F.count(F.lit(1)).alias("reply_count"), F.max(replied).alias("latest_reply"))
    return messages.join(counted, on)


def children_of(parents: DataFrame, children: DataFrame, on: str) -> DataFrame:
    """Every child of every given parent, with the parent's columns."""
    return parents.join(children, on)


def children_of_changed(
    parents: DataFrame, children: DataFrame, on: str, updated: str, since: object, cursor: str
) -> DataFrame:
    """Children of parents updated since the watermark that are themselves newer than it."""
    changed = parents.filter(F.col(updated) >= literal(since, parents.schema[updated].dataType)).select(on)
    return children.filter(F.col(cursor) > literal(since, children.schema[cursor].dataType)).join(changed, on, "left_semi")


def dirty_parents(parents: DataFrame, children: DataFrame, on: str, cursor: str, since: object) -> DataFrame:
    """Parents with at least one child newer than ``since``."""
    newer = children.filter(F.col(cursor) > literal(since, children.schema[cursor].dataType)).select(on).distinct()
    return parents.join(newer, on, "left_semi")


def fetch_by_ids(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Full rows for ids found by another query; an id listed twice is fetched once."""
    return df.join(ids.select(on), on, "left_semi")


def members(profiles: DataFrame, cohorts: DataFrame, profile_key: str, member_ids: str, cohort_key: str) -> DataFrame:
    """Cohort and member pairs that exist as profiles; empty ids are dropped."""
    listed = cohorts.select(cohort_key, F.explode(member_ids).alias(profile_key))
    listed = listed.filter(F.col(profile_key).isNotNull() & (F.col(profile_key).cast("string") != ""))
    return listed.distinct().join(profiles, profile_key)


def overlapping(df: DataFrame, start: str, end: str, low: object, high: object) -> DataFrame:
    """Intervals that overlap ``[low, high]``; an interval without end is still open."""
    return df.filter((F.col(start) <= literal(high, df.schema[start].dataType)) & (F.col(end).isNull() | (F.col(end) >= literal(low, df.schema[end].dataType))))


def frame_elements(frames: DataFrame, key: str, primary: str, referenced: str) -> DataFrame:
    """Elements of each interval: the ``primary`` one and the ``referenced`` ones, the primary not repeated."""
    first = frames.filter(F.col(primary).isNotNull()).select(key, F.col(primary).alias("element"), F.lit("primary").alias("role"))
    others = F.filter(referenced, lambda e: e.isNotNull() & ~e.eqNullSafe(F.col(primary)))
    rest = frames.select(key, F.explode(F.array_distinct(others)).alias("element"), F.lit("referenced").alias("role"))
    return first.unionByName(rest)


def attach(df: DataFrame, meta: DataFrame, on: Sequence[str]) -> DataFrame:
    """Metadata by key, null when there is none; ``meta`` must have one row per key."""
    return df.join(meta, list(on), "left")


def asof(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str],
    values: Sequence[str],
    split: Column | None = None,
    ahead: bool = False,
) -> DataFrame:
    """Left rows with ``values`` of the last right row at or before them (first at or after with ``ahead``).

    Both sides are stacked and read along time, so nothing is multiplied; ``split`` (a Column over ``on``) keeps a
    hot ``by`` key on many tasks. ``_matched_at`` is the time of the right row, null when there is none.
    """
    payload = F.struct(F.col(on).alias("at"), *values)
    seen = right.select(*by, on, payload.alias("__right"), F.lit(None).alias("__left"), F.lit(1 if ahead else 0).alias("__side"))
    asked = left.select(
        *by, on, F.lit(None).alias("__right"), F.struct(*left.columns).alias("__left"), F.lit(0 if ahead else 1).alias("__side")
    )
    stacked = seen.unionByName(asked)
    found = with_nearest(stacked, by, [on, "__side", "__right"], F.col("__right"), "__hit", ahead=ahead, split=split)
    return found.filter("__left IS NOT NULL").select(
        "__left.*", F.col("__hit.at").alias("_matched_at"), *[F.col("__hit")[v].alias(v) for v in values]
    )
