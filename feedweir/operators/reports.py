"""Counts, reports and sessions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.functions.filters import condition
from feedweir.functions.literals import literal
from feedweir.operators.ordering import opening_rows

# Upper bounds in seconds of the session length histogram.
SESSION_BUCKETS = ((60, "0s-60s"), (300, "60s-300s"), (900, "300s-900s"), (3600, "900s-3600s"))
SESSION_REST = "3600s+"


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of many tables, in one plan, ordered by name."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def type_catalog(df: DataFrame, text: str, unit: str) -> DataFrame:
    """Types in use: the first word of ``text`` (``Unknown`` when blank) by unit, most frequent first."""
    word = F.split(F.trim(F.coalesce(text, F.lit(""))), " ")[0]
    kind = F.when(word == "", "Unknown").otherwise(word)
    counted = df.groupBy(kind.alias("point_type"), F.coalesce(unit, F.lit("")).alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), "point_type", "unit")


def report(
    df: DataFrame,
    dims: Mapping[str, Column] | Sequence[str],
    metrics: Mapping[str, Column],
    ts: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    available_dims: Sequence[str] | None = None,
    dim_filter: Mapping | Sequence | None = None,
    metric_filter: Mapping | Sequence | None = None,
    max_dimensions: int | None = None,
    max_metrics: int | None = None,
) -> DataFrame:
    """Metrics by dimensions over a range of whole days; filters on dimensions act before, on metrics after.

    ``max_dimensions`` and ``max_metrics`` refuse larger reports, as a server does; there is no limit by default.
    """
    named = dims if isinstance(dims, Mapping) else {d: F.col(d) for d in dims}
    for kind, given, most in (("dimensions", named, max_dimensions), ("metrics", metrics, max_metrics)):
        if most is not None and len(given) > most:
            raise ValueError(f"at most {most} {kind}")
    known = set(available_dims if available_dims is not None else named)
    unknown = sorted(set(named) - known)
    if unknown:
        raise ValueError(f"unknown dimensions {', '.join(unknown)}; available: {', '.join(sorted(known))}")
    rows = df
    if start is not None:
        rows = rows.filter(F.col(ts) >= literal(start, df.schema[ts].dataType))
    if end is not None:
        rows = rows.filter(F.col(ts) < literal(end + dt.timedelta(days=1), df.schema[ts].dataType))
    with_dims = rows.withColumns({f"__d_{n}": c for n, c in named.items()})
    if dim_filter is not None:
        shape = with_dims.select(*[F.col(f"__d_{n}").alias(n) for n in named]).schema
        renamed = with_dims.select(F.struct("*").alias("r"), *[F.col(f"__d_{n}").alias(n) for n in named])
        with_dims = renamed.filter(condition(shape, dim_filter)).select("r.*")
    grouped = with_dims.groupBy(*[F.col(f"__d_{n}").alias(n) for n in named])
    totals = grouped.agg(*[c.alias(n) for n, c in metrics.items()])
    return totals if metric_filter is None else totals.filter(condition(totals.schema, metric_filter))


def active_users(
    df: DataFrame, user: str, ts: str, grain: str = "day", segment: str | None = None, approx: bool = False
) -> DataFrame:
    """Distinct users per period and segment. Exact counts go through one row per user and period, so no task holds
    all users of a period; ``approx`` needs no such step."""
    period = F.date_trunc(grain, F.col(ts).cast("timestamp")).cast("date").alias("date")
    label = (F.col(segment) if segment else F.lit("Totals")).alias("segment")
    rows = df.select(period, label, F.col(user).alias("u"))
    if approx:
        return rows.groupBy("date", "segment").agg(F.approx_count_distinct("u").alias("count"))
    return rows.filter("u IS NOT NULL").distinct().groupBy("date", "segment").agg(F.count(F.lit(1)).alias("count"))


def sessions(df: DataFrame, user: str, ts: str, gap_seconds: int, order: Sequence[str] = (), split: Column | None = None) -> DataFrame:
    """Sessions per user: a pause longer than the gap starts a new one.

    A session ends with the row before the next session's first row, or with the user's last row.
    """

    def micros(c: Column) -> Column:
        return F.unix_micros(c["at"].cast("timestamp"))

    def opens(was: Column, now: Column) -> Column:
        return was.isNull() | (micros(now) - micros(was) > gap_seconds * 1_000_000)

    along = [ts, *order]
    found = opening_rows(df.select(user, *along), [user], along, F.struct(F.col(ts).alias("at")), opens, split)
    end = F.coalesce(F.col("__next.before.at"), F.col("__final.at"))
    return found.select(user, F.col(ts).alias("session_start"), end.alias("session_end"))


def session_seconds() -> Column:
    """Length of a session row in seconds."""
    end, start = F.col("session_end").cast("timestamp"), F.col("session_start").cast("timestamp")
    return (F.unix_micros(end) - F.unix_micros(start)) / 1e6


def session_length(found: DataFrame) -> DataFrame:
    """Average session length per day."""
    day = F.col("session_start").cast("date").alias("date")
    return found.groupBy(day).agg(F.round(F.avg(session_seconds()), 6).alias("length"))


def session_histogram(found: DataFrame) -> DataFrame:
    """Sessions per length bucket."""
    bucket = reduce(
        lambda acc, step: acc.when(session_seconds() < step[0], step[1]),
        SESSION_BUCKETS[1:],
        F.when(session_seconds() < SESSION_BUCKETS[0][0], SESSION_BUCKETS[0][1]),
    ).otherwise(SESSION_REST)
    return found.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("count"))


def sessions_per_user(found: DataFrame, user: str) -> DataFrame:
    """Average sessions per active user and day; users are counted before days."""
    day = F.col("session_start").cast("date").alias("date")
    each = found.groupBy(day, user).agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("date").agg(F.round(F.avg("n"), 6).alias("avg_sessions"))


def cursor_bounds(df: DataFrame, cursor: str) -> DataFrame:
    """Oldest and newest cursor in one pass."""
    return df.agg(F.min(cursor).alias("oldest"), F.max(cursor).alias("newest"))


def rollup_answers(df: DataFrame, question: str, choice: str) -> DataFrame:
    """Answers per question and choice; skipped answers count as null."""
    return df.groupBy(F.col(question).alias("question"), F.col(choice).alias("choice")).agg(F.count(F.lit(1)).alias("answers"))


def group_bounds(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Count, first and last time per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("oldest"), F.max(ts).alias("newest"))


def top_n(df: DataFrame, order_by: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps ``n`` rows before they are merged."""
    return df.orderBy(*order_by).limit(n)


def sort_nulls(df: DataFrame, column: str, direction: str = "asc", keys: Sequence[str] = ()) -> DataFrame:
    """Order by a (dotted) field with missing values last going up and first going down; ``keys`` settle ties."""
    c = F.col(column)
    return df.orderBy(c.desc_nulls_first() if direction.lower() == "desc" else c.asc_nulls_last(), *keys)


def total_order(df: DataFrame, cursor: str, keys: Sequence[str]) -> DataFrame:
    """Cursor first, then the keys."""
    return df.orderBy(cursor, *keys)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Each distinct row once; nulls are equal."""
    return df.dropDuplicates()


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
