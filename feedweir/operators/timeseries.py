"""Tagged time series: recorded, interpolated, downsampled and summarised values.

Series have ``tag``, ``ts`` and ``value``. A tag may hold a third of all rows: neighbours are found per block of time
(see ``ordering``), bins are pre-aggregated, and nothing is collected per tag.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.functions.literals import literal
from feedweir.operators.joins import asof
from feedweir.operators.ordering import with_bracket, with_neighbour

TAG, TS, VALUE = "tag", "ts", "value"
QUALITY = ("good", "questionable", "substituted", "annotated")

# Summary kinds and their defaults.
SUMMARY_KINDS = ("Total", "Average", "Minimum", "Maximum", "Range", "StdDev", "Count", "PercentGood")
DEFAULT_KIND, DEFAULT_BASIS, DEFAULT_DURATION = "Total", "TimeWeighted", 3600
DEFAULT_PLOT_INTERVALS = 300

# Steps or bins that one array holds while a range is filled.
GRID_BLOCK = 10_000


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _at(df: DataFrame, moment: dt.datetime) -> Column:
    return literal(moment, df.schema[TS].dataType)


def _from_micros(c: Column) -> Column:
    return F.timestamp_micros(c.cast("bigint")).cast("timestamp_ntz")


def _block(width: str = "hour") -> Column:
    return F.date_trunc(width, F.col(TS).cast("timestamp"))


def with_quality(df: DataFrame, units: str | None = None) -> DataFrame:
    """Series in the full output shape: quality flags, units and the time of ingestion."""
    flags = {"good": True, "questionable": False, "substituted": False, "annotated": False}
    missing = {n: F.lit(v) for n, v in flags.items() if n not in df.columns}
    full = df.withColumns({**missing, "units": F.lit(units), "ingestion_timestamp": F.current_timestamp()})
    return full.select(TAG, TS, VALUE, *QUALITY, "units", "ingestion_timestamp")


def recorded(
    df: DataFrame, start: dt.datetime, end: dt.datetime, window_seconds: int = 0
) -> DataFrame:
    """Values in ``[start, end]``; a window length caps the end."""
    if window_seconds > 0:
        end = min(end, start + dt.timedelta(seconds=window_seconds))
    return df.filter((F.col(TS) >= _at(df, start)) & (F.col(TS) <= _at(df, end)))


def recorded_at(df: DataFrame, times: DataFrame) -> DataFrame:
    """Last recorded value at or before each asked time; ``times`` has ``tag`` and ``query_time``."""
    asked = times.select(TAG, F.col("query_time").alias(TS))
    hits = asof(asked, df, TS, [TAG], [VALUE], split=_block())
    return hits.select(TAG, F.col(TS).alias("query_time"), F.col("_matched_at").alias(TS), VALUE)


def value_at(df: DataFrame, times: DataFrame, interpolate: bool = True) -> DataFrame:
    """Value at each asked time, on the straight line between the values around it; null outside the data."""
    if not interpolate:
        return recorded_at(df, times)
    point = F.struct(F.col(TS).alias("at"), F.col(VALUE).alias("v"))
    seen = df.select(TAG, TS, F.lit(0).alias("side"), point.alias("point"))
    asked = times.select(TAG, F.col("query_time").alias(TS), F.lit(1).alias("side"), F.lit(None).alias("point"))
    # A value at the very time asked for sorts before the question, so it is found as the lower end.
    order = [TS, "side", "point"]
    found = with_bracket(seen.unionByName(asked), [TAG], order, F.col("point"), "lo", "hi", _block()).filter("side = 1")
    share = (_micros(F.col(TS)) - _micros(F.col("lo.at"))) / (_micros(F.col("hi.at")) - _micros(F.col("lo.at")))
    line = F.col("lo.v") + (F.col("hi.v") - F.col("lo.v")) * share
    exact = F.col("lo.at") == F.col(TS)
    result = F.when(exact, F.col("lo.v")).when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), line)
    return found.select(TAG, F.col(TS).alias("query_time"), result.alias(VALUE))


def _each_number(df: DataFrame, first: Column, last: Column, into: str, deal: Sequence[str] = ()) -> DataFrame:
    """One row of ``df`` for every whole number from ``first`` to ``last``, in two steps: blocks, then their numbers.

    So no array is longer than a block, however long the range is. With ``deal`` the blocks are dealt out before they are
    filled, so that a few rows with long ranges fill many tasks.
    """
    lo, hi = F.floor(first / GRID_BLOCK), F.floor(last / GRID_BLOCK)
    out = df.withColumns({"__first": first, "__last": last}).withColumn("__block", F.explode(F.sequence(lo, hi)))
    if deal:
        # a number of its own, or else the few small rows would be put together again
        out = out.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *deal, "__block")
    inside = F.sequence(
        F.greatest(F.col("__first"), F.col("__block") * GRID_BLOCK), F.least(F.col("__last"), F.col("__block") * GRID_BLOCK + GRID_BLOCK - 1)
    )
    return out.withColumn(into, F.explode(inside)).drop("__first", "__last", "__block")


def grid(tags: DataFrame, start: dt.datetime, end: dt.datetime, step_seconds: int) -> DataFrame:
    """Every tag at every step of the range."""
    last = (end - start) // dt.timedelta(seconds=step_seconds)
    if last < 0:
        return tags.select(TAG, literal(start).alias("query_time")).limit(0)
    steps = _each_number(tags.select(TAG), F.lit(0).cast("bigint"), F.lit(last).cast("bigint"), "__step", [TAG])
    passed = F.make_dt_interval(secs=(F.col("__step") * step_seconds).cast("decimal(18,6)"))
    return steps.select(TAG, (literal(start) + passed).alias("query_time"))


def interpolated(df: DataFrame, start: dt.datetime, end: dt.datetime, step_seconds: int) -> DataFrame:
    """Interpolated values of all tags on a regular grid."""
    return value_at(df, grid(df.select(TAG).distinct(), start, end, step_seconds))


def plot(df: DataFrame, start: dt.datetime, end: dt.datetime, intervals: int = DEFAULT_PLOT_INTERVALS) -> DataFrame:
    """First, last, lowest and highest value of each of ``intervals`` equal bins, each point once."""
    span = (end - start) // dt.timedelta(microseconds=1)
    low = literal(start)
    offset = _micros(F.col(TS)) - _micros(low)
    number = F.least(F.floor(offset * intervals / span), F.lit(intervals - 1)).cast("int")
    inside = recorded(df, start, end).select(TAG, TS, VALUE, number.alias("bin"))
    point = F.struct(TS, VALUE)
    picked = inside.groupBy(TAG, "bin").agg(
        F.min(point).alias("first"),
        F.max(point).alias("last"),
        F.min_by(point, F.struct(VALUE, TS)).alias("lowest"),
        F.max_by(point, F.struct(F.col(VALUE), -_micros(F.col(TS)))).alias("highest"),
    )
    points = F.array_distinct(F.array("first", "last", "lowest", "highest"))
    return picked.select(TAG, "bin", F.inline(points))


def _segments(df: DataFrame, start: dt.datetime, end: dt.datetime, duration: int) -> DataFrame:
    """Stretches over which the last value holds, cut at bin edges and to the range."""
    width = duration * 1_000_000
    low, high = _micros(literal(start)), _micros(literal(end))
    # Before the range only the newest value of each tag matters: one row per tag leaves every task.
    carried = df.filter(F.col(TS) < _at(df, start)).groupBy(TAG).agg(F.max(F.struct(TS, VALUE)).alias("r"))
    inside = df.filter((F.col(TS) >= _at(df, start)) & (F.col(TS) < _at(df, end)))
    # Several values at one instant: the greatest stands, so a stretch never has length zero in between.
    one = inside.groupBy(TAG, TS).agg(F.max(VALUE).alias(VALUE)).unionByName(carried.select(TAG, "r.*"))
    held = with_neighbour(one, [TAG], [TS], F.struct(F.col(TS).alias("at")), "__next", ahead=True, split=_block())
    begin = F.greatest(_micros(F.col(TS)), low)
    stop = F.least(F.coalesce(_micros(F.col("__next.at")), high), high)
    cut = held.select(TAG, VALUE, begin.alias("b"), stop.alias("e")).filter("b < e")
    first, last = F.floor((F.col("b") - low) / width), F.floor((F.col("e") - 1 - low) / width)
    pieces = _each_number(cut, first, last, "bin").withColumn("lo", low)
    held_for = F.least(F.col("e"), F.col("lo") + (F.col("bin") + 1) * width) - F.greatest(
        F.col("b"), F.col("lo") + F.col("bin") * width
    )
    return pieces.select(TAG, VALUE, F.col("bin").cast("bigint").alias("bin"), (held_for / 1e6).alias("held"))


def _good(df: DataFrame) -> Column:
    return F.col("good") if "good" in df.columns else F.lit(True)


def summary(
    df: DataFrame,
    start: dt.datetime,
    end: dt.datetime,
    types: Sequence[str] = (DEFAULT_KIND,),
    duration: int = DEFAULT_DURATION,
    basis: str = DEFAULT_BASIS,
) -> DataFrame:
    """One row per tag, bin and summary type over ``[start, end)``.

    Event-weighted: every value counts once. Time-weighted: every value counts for as long as it holds, the first
    stretch of a bin carrying the value before it; ``Total`` is then value times seconds. Count and PercentGood are
    about recorded values on either basis; minima and maxima of a time-weighted bin include the value carried in.
    """
    unknown = sorted(set(types) - set(SUMMARY_KINDS))
    if unknown:
        raise ValueError(f"unknown summary types {', '.join(unknown)}; available: {', '.join(SUMMARY_KINDS)}")
    width = duration * 1_000_000
    low = _micros(literal(start))
    bin_number = F.floor((_micros(F.col(TS)) - low) / width).cast("bigint").alias("bin")
    inside = df.filter((F.col(TS) >= _at(df, start)) & (F.col(TS) < _at(df, end)))
    counted = inside.select(TAG, VALUE, bin_number, _good(df).alias("good")).groupBy(TAG, "bin").agg(
        F.count(VALUE).alias("Count"),
        (F.count_if("good") * 100.0 / F.count(F.lit(1))).alias("PercentGood"),
        F.sum(VALUE).alias("Total"),
        F.avg(VALUE).alias("Average"),
        F.min(VALUE).alias("Minimum"),
        F.max(VALUE).alias("Maximum"),
        F.stddev_pop(VALUE).alias("StdDev"),
    )
    if basis == "TimeWeighted":
        weighted = _segments(df, start, end, duration).groupBy(TAG, "bin").agg(
            F.sum(F.col(VALUE) * F.col("held")).alias("Total"),
            F.sum("held").alias("__time"),
            F.sum(F.col(VALUE) * F.col(VALUE) * F.col("held")).alias("__square"),
            F.min(VALUE).alias("Minimum"),
            F.max(VALUE).alias("Maximum"),
        )
        mean = F.col("Total") / F.col("__time")
        spread = F.sqrt(F.greatest(F.col("__square") / F.col("__time") - mean * mean, F.lit(0.0)))
        bins = weighted.join(counted.select(TAG, "bin", "Count", "PercentGood"), [TAG, "bin"], "left").select(
            TAG, "bin", "Total", "Minimum", "Maximum", mean.alias("Average"), spread.alias("StdDev"),
            F.coalesce("Count", F.lit(0)).alias("Count"), "PercentGood",
        )
    else:
        bins = counted
    bins = bins.withColumn("Range", F.col("Maximum") - F.col("Minimum"))
    pairs = F.array(*[F.struct(F.lit(t).alias("summary_type"), F.col(t).cast("double").alias(VALUE)) for t in types])
    return bins.select(TAG, _from_micros(low + F.col("bin") * width).alias(TS), F.inline(pairs))


def calculated(
    df: DataFrame, start: dt.datetime, end: dt.datetime, step_seconds: int = DEFAULT_DURATION, kind: str = "Average"
) -> DataFrame:
    """One calculated value per interval, with the calculation's name."""
    return summary(df, start, end, [kind], step_seconds).withColumnRenamed("summary_type", "calculation_type")


def latest_per_tag(df: DataFrame) -> DataFrame:
    """Newest value of each tag; one row per tag leaves every task."""
    rest = [c for c in df.columns if c not in (TAG, TS)]
    newest = df.groupBy(TAG).agg(F.max(F.struct(TS, *rest)).alias("row"))
    return newest.select(TAG, "row.*")


def parse_relative_time(text: str | None, now: dt.datetime) -> dt.datetime:
    """``*`` is now, ``*-10m``, ``*-2h``, ``*-7d`` are before it, ISO is itself; anything else is now."""
    value = (text or "").strip()
    relative = re.fullmatch(r"\*-(\d+)([mhd])", value)
    if relative:
        unit = {"m": "minutes", "h": "hours", "d": "days"}[relative[2]]
        return now - dt.timedelta(**{unit: int(relative[1])})
    try:
        parsed = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    except ValueError:
        return now
    return parsed.astimezone(dt.timezone.utc) if parsed.tzinfo else parsed.replace(tzinfo=dt.timezone.utc)


def time_range(
    state: dt.datetime | None,
    options: Mapping[str, str],
    now: dt.datetime,
    run_start: dt.datetime | None = None,
) -> tuple[dt.datetime, dt.datetime]:
    """Range to read: from the stored state, else the start option, else a lookback before the end.

    The end is capped by the window length, then both ends by the moment the run began.
    """
    end = parse_relative_time(options.get("end_time", "*"), now)
    if state is not None:
        start = state
    elif options.get("start_time"):
        start = parse_relative_time(options["start_time"], end)
    else:
        start = end - dt.timedelta(minutes=int(options.get("lookback_minutes", 60)))
    width = int(options.get("window_seconds", 0) or 0)
    if width > 0:
        end = min(end, start + dt.timedelta(seconds=width))
    if run_start is not None:
        start, end = min(start, run_start), min(end, run_start)
    return start, end
