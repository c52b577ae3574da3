"""Incremental slices: which rows to take now and where the next run starts.

Every slice is a lazy DataFrame. State is a one-row DataFrame (one row per key for ``slice_per_key``); feed a value of
it back as a literal, or as ``state.select(...).scalar()`` to stay lazy. Bounds found by a top-k are at most ``cap``
rows wide, so they never pull a table into one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedweir.functions.cursors import pk_ordinal
from feedweir.functions.literals import literal
from feedweir.operators.ordering import leading_groups, with_ordinal, with_running_total


def _bound(df: DataFrame, cursor: str, value: object) -> Column:
    return literal(value, df.schema[cursor].dataType)


# ---------------------------------------------------------------- plain bounds


def slice_after(df: DataFrame, cursor: str, since: object = None) -> DataFrame:
    """Rows strictly after ``since``; everything on the first run."""
    return df if since is None else df.filter(F.col(cursor) > _bound(df, cursor, since))


def slice_range(
    df: DataFrame, cursor: str, low: object = None, high: object = None, low_inclusive: bool = False
) -> DataFrame:
    """Rows up to ``high``, from ``low`` on (included or not); an open bound is None."""
    if low is not None:
        bound = _bound(df, cursor, low)
        df = df.filter(F.col(cursor) >= bound) if low_inclusive else df.filter(F.col(cursor) > bound)
    return df if high is None else df.filter(F.col(cursor) <= _bound(df, cursor, high))


def slice_from_revision(df: DataFrame, revision: str, start: object = None) -> tuple[DataFrame, DataFrame]:
    """Rows with ``revision >= start``; the next start is the greatest revision plus one."""
    rows = df if start is None else df.filter(F.col(revision) >= _bound(df, revision, start))
    following = F.max(revision) + 1
    return rows, rows.agg(F.coalesce(following, _bound(df, revision, start)).alias("cursor"))


def exclusive_of(df: DataFrame, cursor: str, since: object) -> DataFrame:
    """Strict bound applied to rows a source returned with ``>=``."""
    return slice_range(df, cursor, since, low_inclusive=True).filter(F.col(cursor) != _bound(df, cursor, since))


def advance(previous: object, seen: Column) -> Column:
    """The watermark never moves back; nulls lose."""
    return F.greatest(literal(previous), seen)


def watermark(df: DataFrame, cursor: str, previous: object = None) -> DataFrame:
    """One-row state after delivering ``df``."""
    top = F.max(cursor)
    return df.agg((top if previous is None else advance(_bound(df, cursor, previous), top)).alias("cursor"))


def cap_at_run_start(
    df: DataFrame, cursor: str, run_start: object, previous: object = None
) -> tuple[DataFrame, DataFrame]:
    """Neither the rows nor the stored cursor pass the moment the run began."""
    ceiling = _bound(df, cursor, run_start)
    rows = df.filter(F.col(cursor) <= ceiling)
    top = F.max(cursor) if previous is None else advance(_bound(df, cursor, previous), F.max(cursor))
    return rows, rows.agg(F.when(top.isNotNull(), F.least(top, ceiling)).alias("cursor"))


def with_lookback(since: object, seconds: object) -> Column:
    """Lower bound used for reading only; the stored cursor stays as it is."""
    return literal(since) - F.make_dt_interval(secs=literal(seconds).cast("decimal(18,6)"))


def auto_lookback(
    history: DataFrame, factor: float = 1.5, ceiling: float = 3600.0, keep: int = 5
) -> DataFrame:
    """Seconds to look back, from the durations of the last runs (columns ``run``, ``seconds``).

    Zero until a run has been measured; negative, infinite and missing durations do not count.
    """
    recent = history.orderBy(F.col("run").desc()).limit(keep)
    good = recent.filter((F.col("seconds") > 0) & ~F.isnan("seconds") & (F.col("seconds") < float("inf")))
    longest = F.round(F.max("seconds") * factor, 9)
    # least() skips nulls, so "nothing measured" has to be told apart before it.
    return good.agg(F.when(longest.isNull(), F.lit(0.0)).otherwise(F.least(longest, F.lit(float(ceiling)))).alias("seconds"))


def slice_keep_unknown(
    df: DataFrame, cursor: Column, since: object = None
) -> tuple[DataFrame, DataFrame]:
    """Rows after ``since`` plus rows without a readable cursor, which never move the watermark."""
    rows = df if since is None else df.filter(cursor.isNull() | (cursor > literal(since)))
    top = F.max(cursor) if since is None else advance(since, F.max(cursor))
    return rows, rows.agg(top.alias("cursor"))


# ---------------------------------------------------------------- null cursors


def null_cursor(
    df: DataFrame,
    cursor: str,
    keys: Sequence[str] = (),
    policy: str = "coalesce",
    floor_year: int = 2000,
    into: str | None = None,
) -> DataFrame:
    """What to do with rows lacking a cursor: give them a floor, leave them out, or fail."""
    into = into or cursor
    value = F.col(cursor)
    if policy == "ignore":
        return df.filter(value.isNotNull()).withColumn(into, value)
    kind = df.schema[cursor].dataType
    if policy == "error":
        problem = F.raise_error(F.lit(f"null cursor in {cursor}")).cast(kind)
        return df.withColumn(into, F.when(value.isNull(), problem).otherwise(value))
    if policy != "coalesce":
        raise ValueError(f"unknown policy {policy!r}: use coalesce, ignore or error")
    name = kind.typeName()
    if name in ("timestamp", "timestamp_ntz"):
        start = F.lit(f"{floor_year:04d}-01-01 00:00:00").cast(kind)
        floor = start + F.make_dt_interval(secs=(pk_ordinal(*[F.col(k) for k in keys]) / 1e6).cast("decimal(18,6)"))
    elif name == "date":
        floor = F.lit(f"{floor_year:04d}-01-01").cast("date")
    elif name in ("integer", "long"):
        floor = F.lit(-(2 ** (63 if name == "long" else 31))).cast(kind)
    elif name in ("float", "double"):
        floor = F.lit(-1.0e308).cast(kind)
    elif name == "decimal":
        floor = F.lit("-" + "9" * (kind.precision - kind.scale)).cast(kind)
    elif name == "string":
        floor = F.lit("")
    else:
        raise ValueError(f"no floor for a {name} cursor: use ignore or error")
    return df.withColumn(into, F.coalesce(value, floor))


# ---------------------------------------------------------------- caps


def _head(df: DataFrame, cursor: str, cap: int) -> DataFrame:
    """The first ``cap + 1`` cursors ``c`` with their place ``n``; every task contributes at most that many."""
    head = df.filter(F.col(cursor).isNotNull()).select(F.col(cursor).alias("c")).orderBy("c").limit(cap + 1)
    return head.withColumn("n", F.row_number().over(Window.orderBy("c")))


def _up_to(df: DataFrame, cursor: str, stop: DataFrame) -> DataFrame:
    """Rows up to the one value of ``stop``, a plain comparison the scan can use; rows without a cursor stay."""
    return df.filter((F.col(cursor) <= stop.scalar()) | F.col(cursor).isNull())


def batch_trim(df: DataFrame, cursor: str, cap: int) -> tuple[DataFrame, DataFrame]:
    """At most ``cap`` rows with a cursor, cut between two cursor values so a strict ``>`` resumes without loss.

    When more rows wait, the whole last tie group is left for the next run. A first tie group larger than the cap
    cannot be cut and is taken whole.
    """
    head = _head(df, cursor, cap)
    last = F.max(F.when(F.col("n") <= cap, F.col("c"))).over(Window.partitionBy())
    before = F.max(F.when(F.col("c") < F.col("last"), F.col("c")))
    stop = F.when(F.count("c") <= cap, F.max("c")).otherwise(F.coalesce(before, F.max("last")))
    state = head.withColumn("last", last).agg(stop.alias("cursor"))
    return _up_to(df, cursor, state), state


def batch_soft(df: DataFrame, cursor: str, cap: int, is_sorted: bool = True) -> tuple[DataFrame, DataFrame]:
    """The first ``cap`` rows and everything tied with the last of them.

    A source that does not come in cursor order cannot be cut safely, so ``is_sorted=False`` takes everything.
    """
    if not is_sorted:
        return df, df.agg(F.max(cursor).alias("cursor"))
    state = _head(df, cursor, cap).filter(F.col("n") <= cap).agg(F.max("c").alias("cursor"))
    return _up_to(df, cursor, state), state


def batch_groups(df: DataFrame, group: str, cap: int) -> tuple[DataFrame, DataFrame]:
    """Whole groups (a message and its parts), in group order, until ``cap`` rows are reached.

    Rows without a group cannot be resumed behind; they are all taken and do not count.
    """
    last = leading_groups(df.filter(F.col(group).isNotNull()), group, cap).agg(F.max(group).alias("last"))
    rows = df.filter((F.col(group) <= last.scalar()) | F.col(group).isNull())
    return rows, last.withColumnRenamed("last", "cursor")


def batch_by_group(
    df: DataFrame, group: str, cap: int, after: object = None
) -> tuple[DataFrame, DataFrame]:
    """As ``batch_groups``, resuming after the last group of the run before, which was taken whole.

    Rows without a group come with the first run only.
    """
    rest = df if after is None else df.filter(F.col(group) > _bound(df, group, after))
    return batch_groups(rest, group, cap)


def batch_keyset(
    df: DataFrame, cursor: str, tiebreak: str, n: int, after: tuple[object, object] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The next ``n`` rows in ``(cursor, tiebreak)`` order after the pair ``after``."""
    if not tiebreak:
        raise ValueError("a capped read needs a tie-break column")
    broken = F.raise_error(F.lit(f"null {tiebreak}: the position cannot be resumed")).cast("boolean")
    rows = df.filter(F.when(F.col(tiebreak).isNull(), broken).otherwise(F.lit(True)))
    if after is not None:
        at, place = _bound(df, cursor, after[0]), _bound(df, tiebreak, after[1])
        rows = rows.filter((F.col(cursor) >= at) & ((F.col(cursor) > at) | (F.col(tiebreak) > place)))
    rows = rows.orderBy(cursor, tiebreak).limit(n)
    last = F.max(F.struct(F.col(cursor).alias("cursor"), F.col(tiebreak).alias("tiebreak")))
    return rows, rows.agg(last.alias("last")).select("last.*")


def page(df: DataFrame, order_by: Sequence[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in order; out of range is empty, a negative offset is zero."""
    if limit <= 0:
        return df.limit(0)
    return df.orderBy(*order_by).offset(max(offset, 0)).limit(limit)


@dataclass(frozen=True)
class SortedFiles:
    """Rows written in a total order: the files in that order and how many rows each holds."""

    files: tuple[tuple[str, int], ...]
    order: tuple[str, ...]

    @property
    def total(self) -> int:
        """Rows of all files."""
        return sum(rows for _, rows in self.files)

    def page(self, spark: SparkSession, offset: int, limit: int) -> DataFrame | None:
        """Rows ``offset`` to ``offset + limit``; opens only the files that hold some of them. None out of range."""
        offset = max(offset, 0)
        chosen, first, at = [], None, 0
        for name, rows in self.files:
            if at < offset + limit and at + rows > offset:
                first = at if first is None else first
                chosen.append(name)
            at += rows
        if first is None or limit <= 0:
            return None
        return spark.read.parquet(*chosen).orderBy(*self.order).offset(offset - first).limit(limit)

    def pages(self, spark: SparkSession, size: int) -> DataFrame | None:
        """All pages of ``size`` rows in one scan: every row with its ``page``, from 0, and the ``file`` that holds it.

        A file's rows lie in order, so a row's place is its place in the file after the rows of the files before; none is
        sorted again, and the plan is the same for any number of pages. None without rows.
        """
        if not self.files:
            return None
        before = list(accumulate((rows for _, rows in self.files), initial=0))[:-1]
        # one row per file
        starts = spark.createDataFrame(list(zip((name for name, _ in self.files), before)), "__file string, __before bigint")
        held = spark.read.parquet(*[name for name, _ in self.files])
        rows = held.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("__row"))
        rows = rows.join(F.broadcast(starts), F.col("file") == F.col("__file"))
        place = F.col("__before") + F.col("__row")
        return rows.select(*held.columns, F.floor(place / size).cast("bigint").alias("page"), "file")


def sorted_files(df: DataFrame, order_by: Sequence[str], folder: str) -> SortedFiles:
    """Write ``df`` in ranges of ``order_by``, a total order, and say how many rows each file holds.

    One shuffle for any number of pages: a page then costs its own files, wherever it lies.
    """
    df.orderBy(*order_by).write.parquet(folder)
    spark = df.sparkSession
    # one row per file; files are named in the order of their ranges
    counts = spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    found = sorted((r["f"], r["n"]) for r in counts.collect())
    return SortedFiles(tuple(found), tuple(order_by))


def has_news(df: DataFrame, cursor: str, since: object) -> DataFrame:
    """One row ``has_news``: false when the greatest cursor is behind ``since`` and a read can be skipped."""
    return df.agg(F.coalesce(F.max(cursor) >= _bound(df, cursor, since), F.lit(False)).alias("has_news"))


# ---------------------------------------------------------------- windows


def slice_window(
    df: DataFrame,
    cursor: str,
    since: object,
    seconds: int,
    run_start: object,
    cap: int | None = None,
    closed: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rows in ``[since, since + seconds]``, never past ``run_start``.

    A drained window moves the cursor to its end, so empty windows still make progress; a capped one to its last row,
    with all rows tied with it. The run after a capped one passes ``closed=False`` and starts behind ``since``, or it
    would read the same tie for ever.
    """
    low = _bound(df, cursor, since)
    end = F.least(low + F.make_dt_interval(secs=F.lit(seconds)), _bound(df, cursor, run_start))
    begin = F.col(cursor) >= low if closed else F.col(cursor) > low
    inside = df.filter(begin & (F.col(cursor) <= end))
    if cap is None:
        return inside, df.sparkSession.range(1).select(end.alias("cursor"))
    last = F.max(F.when(F.col("n") <= cap, F.col("c")))
    found = _head(inside, cursor, cap).agg(last.alias("last"), F.count("c").alias("found"))
    rows = inside.filter(F.col(cursor) <= found.select("last").scalar())
    return rows, found.select(F.when(F.col("found") > cap, F.col("last")).otherwise(end).alias("cursor"))


@dataclass(frozen=True)
class Bounds:
    """What to read now and the cursor to store afterwards."""

    start: dt.datetime
    end: dt.datetime
    following: dt.datetime


def hourly_bounds(since: dt.datetime, run_start: dt.datetime, width_hours: int = 24, behind_hours: int = 2) -> Bounds | None:
    """Hour windows whose end is included, and that stay ``behind_hours`` behind: the next starts an hour later."""
    ceiling = run_start - dt.timedelta(hours=behind_hours)
    if since >= ceiling:
        return None
    end = min(since + dt.timedelta(hours=width_hours), ceiling)
    return Bounds(since, end, end + dt.timedelta(hours=1))


def daily_bounds(
    cursor: dt.date, today: dt.date, width_days: int = 7, lookback_days: int = 0, forward_days: int = 0
) -> Bounds | None:
    """Day windows with both ends included: one day short unless it is the last window; may reach into the future."""
    upper = today + dt.timedelta(days=forward_days)
    if cursor >= upper:
        return None
    low = cursor - dt.timedelta(days=lookback_days)
    end = min(cursor + dt.timedelta(days=max(width_days, 1)), upper)
    last = end if end == upper else max(end - dt.timedelta(days=1), low)
    return Bounds(low, last, end)


def windows(
    spark: SparkSession,
    start: dt.datetime | None,
    end: dt.datetime,
    width: dt.timedelta,
    lookback: dt.timedelta = dt.timedelta(0),
) -> DataFrame:
    """Disjoint windows ``(since, until]`` covering the range; without a start, one window open below."""
    if start is None:
        return spark.range(1).select(
            F.lit(None).cast("timestamp_ntz").alias("since"), literal(end).alias("until")
        )
    low = start - lookback
    if low >= end:
        return spark.range(0).select(
            F.lit(None).cast("timestamp_ntz").alias("since"), F.lit(None).cast("timestamp_ntz").alias("until")
        )
    count = -(-(end - low) // width)
    step = F.make_dt_interval(secs=F.lit(int(width.total_seconds())))
    since = literal(low) + step * F.col("id")
    return spark.range(count).select(
        since.alias("since"), F.least(since + step, literal(end)).alias("until")
    )


def in_windows(
    df: DataFrame, cursor: str, start: dt.datetime, end: dt.datetime, width: dt.timedelta
) -> DataFrame:
    """Rows of ``(start, end]`` with the window they fall in, found by arithmetic instead of a range join."""
    ts = F.col(cursor).cast("timestamp_ntz")
    seconds = int(width.total_seconds())
    base = literal(start)
    # A row exactly on a boundary belongs to the window that ends there.
    micros = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(base.cast("timestamp"))
    number = F.floor((micros - 1) / F.lit(seconds * 1_000_000)).cast("bigint")
    step = F.make_dt_interval(secs=F.lit(seconds))
    since = base + step * number
    top = literal(end)
    return df.filter((ts > base) & (ts <= top)).select(
        "*", since.alias("since"), F.least(since + step, top).alias("until")
    )


def compact_windows(
    df: DataFrame, cursor: str, since: dt.datetime, seconds: int, cap: int, run_start: dt.datetime
) -> tuple[DataFrame, DataFrame]:
    """Consecutive windows from ``since`` put together until ``cap`` rows are reached; empty ones are skipped.

    The window that reaches the cap is taken whole, and the cursor moves to its end.
    """
    ts, base = F.col(cursor).cast("timestamp"), literal(since, "timestamp")
    width = seconds * 1_000_000
    number = F.floor((F.unix_micros(ts) - F.unix_micros(base)) / F.lit(width)).cast("bigint")
    inside = df.filter((ts >= base) & (ts < literal(run_start, "timestamp"))).withColumn("__window", number)
    taken = leading_groups(inside, "__window", cap).agg(
        F.max("__window").alias("last"), F.max("rows_through").alias("found")
    )
    rows = inside.filter(F.col("__window") <= taken.select("last").scalar()).drop("__window")
    end = F.timestamp_micros(F.unix_micros(base) + (F.col("last") + 1) * width)
    top = literal(run_start, "timestamp")
    reached = F.when(F.col("found") >= cap, F.least(end, top)).otherwise(top)
    return rows, taken.select(reached.cast("timestamp_ntz").alias("cursor"))


def day_chunks(
    df: DataFrame, ts: str, start: dt.date, cap: int, days: int = 7
) -> tuple[DataFrame, DataFrame]:
    """Whole chunks of ``days`` days from ``start`` until ``cap`` rows are reached; the state is the next first day.

    A read without rows leaves ``start`` as it is.
    """
    day = F.col(ts).cast("date")
    chunk = F.floor(F.datediff(day, F.lit(start)) / days).cast("int")
    rest = df.filter(day >= F.lit(start)).withColumn("__chunk", chunk)
    last = leading_groups(rest, "__chunk", cap).agg(F.max("__chunk").alias("last"))
    rows = rest.filter(F.col("__chunk") <= last.scalar()).drop("__chunk")
    return rows, last.select(F.date_add(F.lit(start), F.coalesce((F.col("last") + 1) * days, F.lit(0))).alias("start_date"))


def date_watermark(df: DataFrame, ts: str, queried_end: dt.date, run_start: dt.date) -> DataFrame:
    """Date to resume from: the newest row's day, at least the queried end, at most the day the run began."""
    newest = F.greatest(F.max(ts).cast("date"), F.lit(queried_end))
    return df.agg(F.least(newest, F.lit(run_start)).alias("cursor"))


def start_of(
    state: dt.datetime | None,
    option: dt.datetime | None,
    oldest: dt.datetime | None,
    run_start: dt.datetime,
    days_back: int | None = None,
) -> dt.datetime | None:
    """Where to begin: stored state, else the option, else just before the oldest row, else ``days_back`` days ago."""
    if state is not None:
        return state
    if option is not None:
        return option
    if oldest is not None:
        return oldest.replace(microsecond=0) - dt.timedelta(seconds=1)
    return None if days_back is None else run_start - dt.timedelta(days=days_back)


# ---------------------------------------------------------------- per key


def slice_per_key(
    df: DataFrame, key: str, cursor: str, state: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """A watermark per key: rows after their key's own cursor, all rows of unknown keys."""
    seen = df.groupBy(key).agg(F.max(cursor).alias("cursor"))
    if state is None:
        return df, seen
    known = state.select(key, F.col("cursor").alias("__since"))
    rows = df.join(known, key, "left").filter(F.col("__since").isNull() | (F.col(cursor) > F.col("__since")))
    merged = seen.join(known, key, "full_outer")
    return rows.drop("__since"), merged.select(key, F.greatest("cursor", "__since").alias("cursor"))


# ---------------------------------------------------------------- already delivered


def composite_key(*columns: Column) -> Column:
    """One text per key tuple: a JSON array, with nulls kept in place."""
    return F.to_json(F.array(*[c.cast("string") for c in columns]), {"ignoreNullFields": "false"})


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-1 over the whole row, with names sorted and nulls written out."""
    names = sorted(columns or df.columns)
    return F.sha1(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The first 16 hex digits of ``row_hash``, to show; rows are compared by the whole hash."""
    return F.substring(row_hash(df, columns), 1, 16)


def drop_delivered(
    df: DataFrame, seen: DataFrame | None, keys: Sequence[str], cursor: str, cap: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of an overlapping read that are new or changed since they were delivered.

    ``seen`` has ``row_key``, ``digest`` (``row_hash``), ``cursor``. All entries of this read are kept for the next
    run, as many as the lookback holds; a ``cap`` keeps the newest, and forgets that others were delivered.
    """
    names = df.columns
    tagged = df.withColumn("row_key", composite_key(*[F.col(k) for k in keys])).withColumn(
        "digest", row_hash(df, names)
    )
    fresh = tagged if seen is None else tagged.join(seen.select("row_key", "digest"), ["row_key", "digest"], "left_anti")
    entries = tagged.select("row_key", "digest", F.col(cursor).alias("cursor"))
    if cap is not None:
        entries = entries.orderBy(F.col("cursor").desc(), "row_key", "digest").limit(cap)
    return fresh.select(*names), entries


def exclude_seen(df: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key and content are not in ``seen``."""
    return drop_delivered(df, seen, keys, keys[0])[0]


# ---------------------------------------------------------------- splitting


def split_even(df: DataFrame, n: int, order_by: Sequence[str], into: str = "part") -> DataFrame:
    """``n`` contiguous parts along a total order, the first ones a row longer when the count does not divide."""
    numbered = with_ordinal(df, order_by, "__at", start=0)
    total = numbered.agg(F.count(F.lit(1)).alias("n")).scalar()
    parts = F.least(total, F.lit(n))
    base, extra = F.floor(total / parts), total % parts
    head = extra * (base + 1)
    part = F.when(F.col("__at") < head, F.floor(F.col("__at") / (base + 1))).otherwise(
        extra + F.floor((F.col("__at") - head) / F.greatest(base, F.lit(1)))
    )
    return numbered.withColumn(into, part.cast("int")).drop("__at")


def pack(df: DataFrame, weight: str, n: int, order_by: Sequence[str], into: str = "bin") -> DataFrame:
    """Put items into at most ``n`` bins of near-equal weight.

    Bins are stretches of the running weight, so no task or driver sees all items. No bin outweighs the average by
    more than one item. Items without a positive weight count as one.
    """
    load = F.when(F.col(weight) > 0, F.col(weight)).otherwise(F.lit(1)).cast("double")
    running = with_running_total(df.withColumn("__load", load), order_by, "__load", "__through")
    total = running.agg(F.sum("__load").alias("t")).scalar()
    middle = F.col("__through") - F.col("__load") / 2
    bin_number = F.least(F.floor(middle * n / total), F.lit(n - 1)).cast("int")
    return running.withColumn(into, bin_number).drop("__load", "__through")


def rounded_weight(weight: Column, digits: int = 4) -> Column:
    """A whole weight of at least 1 with so many significant digits that few different ones are left."""
    whole = F.greatest(F.coalesce(F.ceil(weight), F.lit(1)), F.lit(1)).cast("bigint")
    unit = F.pow(F.lit(10), F.greatest(F.floor(F.log10(whole)) - (digits - 1), F.lit(0))).cast("bigint")
    return F.when(whole < 10**digits, whole).otherwise(F.ceil(whole / unit).cast("bigint") * unit)


def least_loaded_plan(counts: Sequence[tuple[int, int]], n: int) -> list[tuple[int, int, int, list[int]]]:
    """Where longest-first into the least-loaded bin puts items: rows (weight, first, past, bins).

    ``counts`` says how many items there are of each weight. Of the items of a weight, numbered from 0, those from
    ``first`` to ``past`` go to ``bins`` in turn. Equal items fill the bins level by level, a level being as high as an
    item, so a run needs one row for every time that a higher bin joins in, at most ``n``, however many items it has.
    """
    loads, plan = [0] * n, []
    for weight, count in sorted(counts, reverse=True):
        level = [load // weight for load in loads]
        steps, runs = sorted(set(level)), []
        at = 0
        for i, low in enumerate(steps):
            bins = sorted((b for b in range(n) if level[b] <= low), key=lambda b: (loads[b] % weight, b))
            room = count - at if i + 1 == len(steps) else min(count - at, len(bins) * (steps[i + 1] - low))
            if room > 0:
                runs.append((weight, at, at + room, bins))
                at += room
        plan += runs
        for _, first, past, bins in runs:
            whole, rest = divmod(past - first, len(bins))
            for place, b in enumerate(bins):
                loads[b] += weight * (whole + (place < rest))
    return plan


def pack_least_loaded(
    df: DataFrame, weight: str, n: int, order_by: Sequence[str], into: str = "bin", digits: int = 4
) -> DataFrame:
    """Put items into ``n`` bins, the longest first, each into the least-loaded bin (of equal ones, the first).

    Items of one weight go in the order of ``order_by``. Weights are compared with ``digits`` significant digits, which
    bounds how many different ones there are (some 9,000 per power of ten): the driver plans on how many items each
    weight has, and no task holds all items or those of a weight. Items without a positive weight count as one.
    """
    items = df.withColumn("__weight", rounded_weight(F.col(weight), digits))
    counts = [(r["__weight"], r["n"]) for r in items.groupBy("__weight").agg(F.count("*").alias("n")).collect()]
    if not counts:
        return df.withColumn(into, F.lit(None).cast("int"))
    plan = least_loaded_plan(counts, n)
    starts, at = [], 0
    for w, count in sorted(counts, reverse=True):
        starts.append((w, at))
        at += count
    start_of = dict(starts)
    rows = [(w, start_of[w] + first, start_of[w] + past, bins) for w, first, past, bins in plan]
    found = df.sparkSession.createDataFrame(rows, "__w bigint, __first bigint, __past bigint, __bins array<int>")
    placed = with_ordinal(items, [F.col("__weight").desc(), *order_by], "__at", start=0)
    here = (F.col("__weight") == F.col("__w")) & (F.col("__at") >= F.col("__first")) & (F.col("__at") < F.col("__past"))
    turn = ((F.col("__at") - F.col("__first")) % F.size("__bins")).cast("int")
    return placed.join(found, here).withColumn(into, F.get("__bins", turn)).select(*df.columns, into)


def with_sequence(df: DataFrame, order_by: Sequence[str], batch_id: int = 0, into: str = "_sequence") -> DataFrame:
    """Sequence for feeds without a cursor: grows along ``order_by`` in a batch and from batch to batch."""
    return with_ordinal(df, order_by, into, start=(batch_id << 40) + 1)


# ---------------------------------------------------------------- state rules


def once(df: DataFrame, state: dict | None) -> tuple[DataFrame, dict]:
    """A snapshot is read once per state: the second read of the same state is empty."""
    return (df.limit(0), state) if state and state.get("done") else (df, {"done": True})


def progress_view(state: dict) -> dict:
    """The part of a state that counts as progress; bookkeeping keys start with ``lb_``."""
    return {k: v for k, v in state.items() if not k.startswith("lb_")}


def progress_map(c: Column) -> Column:
    """``progress_view`` of a state kept as a map column."""
    return F.map_filter(c, lambda k, _: ~k.startswith("lb_"))


def filter_check(df: DataFrame, cursor: Column, since: object) -> DataFrame:
    """One row: how many rows have a readable cursor, how many are newer, and whether the filter was honoured."""
    dated, newer = F.count(cursor), F.count_if(cursor > literal(since))
    return df.agg(dated.alias("dated"), newer.alias("newer"), ((dated == 0) | (newer > 0)).alias("honoured"))


def assert_filter_honored(df: DataFrame, cursor: Column, since: object) -> DataFrame:
    """Fail the job that reads the rows when a source ignored the cursor filter: rows came back but none is newer."""
    check = filter_check(df, cursor, since)
    message = F.concat(F.col("dated").cast("string"), F.lit(f" rows came back but none is newer than {since}"))
    problem = check.select(F.when(~F.col("honoured"), message).alias("problem")).scalar()
    return df.filter(F.when(problem.isNull(), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean")))


def page_pinned(
    df: DataFrame,
    cursor: str,
    key: str,
    state: dict,
    run_start: dt.datetime,
    limit: int,
    cap: int,
    lookback_seconds: int = 0,
) -> tuple[DataFrame, dict]:
    """Pages of a range whose bounds stay fixed until it is drained; then the cursor is its upper bound."""
    if state.get("until"):
        since, until, first = state.get("since"), state["until"], int(state.get("page", 1))
    else:
        at = state.get("cursor")
        if at is not None and at >= run_start:
            return df.limit(0), state
        since = None if at is None else at - dt.timedelta(seconds=lookback_seconds)
        until, first = run_start, 1
    pages = max(1, -(-cap // limit))
    span = slice_range(df, cursor, since, until, low_inclusive=True)
    # a page without a last row is not full, so the range is drained; the page itself is not counted
    start = (first - 1) * limit
    rows = page(span, [cursor, key], start, pages * limit)
    if page(span.select(cursor, key), [cursor, key], start + pages * limit - 1, 1).isEmpty():
        return rows, {"cursor": until}
    following = {"until": until, "page": first + pages}
    return rows, following if since is None else {**following, "since": since}


def drain_pinned(
    df: DataFrame, cursor: str, key: str, until: object, since: object, cap: int, folder: str
) -> Iterator[DataFrame]:
    """All pages of a pinned range, ``cap`` rows each, out of one sorted copy: every row of the range once.

    The bounds are fixed when the copy is written, so rows that come meanwhile are for the next range. A page reads the
    files that hold it, and none is counted or sorted as a whole.
    """
    held = sorted_files(slice_range(df, cursor, since, until, low_inclusive=True), [cursor, key], folder)
    for offset in range(0, held.total, cap):
        yield held.page(df.sparkSession, offset, cap)
