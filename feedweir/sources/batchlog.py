"""Tables kept as numbered batches that are only ever added, merged by levels, and read as one.

A table folder holds ``log/<first>-<last>`` folders of Parquet: batch n is written as ``n-n``, and ``FAN`` neighbours of
one level are merged into a folder of the next level, so that n batches are read from some log(n) folders and a row is
rewritten log(n) times. A folder counts when its success marker is there; a batch that is retried overwrites its own
folder. Merged folders stay until ``trim`` finds the folder that replaced them old enough, so a reader that planned
before the merge still finds its files. One writer at a time may add to a table.

Beside the batches, ``progress/<n>.planned`` and ``progress/<n>.done`` are small JSON notes: what a load is going to
read, written before it, and what it has read, written after it. A load without its second note did not happen.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from feedweir.sources.sinks import _hadoop

# Neighbouring folders of one level that are merged into one of the next.
FAN = 4

Reduce = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True, order=True)
class Folder:
    """The batches ``first`` to ``last``, complete since ``since`` (milliseconds)."""

    first: int
    last: int
    since: int = 0

    @property
    def level(self) -> int:
        """How often batches were merged to make this folder."""
        size, level = self.last - self.first + 1, 0
        while size >= FAN:
            size, level = size // FAN, level + 1
        return level


def folders(spark: SparkSession, target: str) -> list[Folder]:
    """All complete folders of a table."""
    fs, path = _hadoop(spark, target)
    if not fs.exists(path(f"{target}/log")):
        return []
    found = []
    for status in fs.listStatus(path(f"{target}/log")):
        first, _, last = status.getPath().getName().partition("-")
        marker = path(f"{target}/log/{first}-{last}/_SUCCESS")
        if first.isdigit() and last.isdigit() and fs.exists(marker):
            found.append(Folder(int(first), int(last), fs.getFileStatus(marker).getModificationTime()))
    return sorted(found)


def cover(found: list[Folder], upto: int | None = None) -> list[Folder]:
    """The fewest folders that hold every batch once, up to batch ``upto``."""
    chosen: list[Folder] = []
    inside = [f for f in found if upto is None or f.last <= upto]
    for folder in sorted(inside, key=lambda f: (f.first, -f.last)):
        if not chosen or folder.first > chosen[-1].last:
            chosen.append(folder)
    return chosen


def last_batch(spark: SparkSession, target: str) -> int | None:
    """Number of the newest batch."""
    return max((f.last for f in folders(spark, target)), default=None)


def _name(target: str, folder: Folder) -> str:
    return f"{target}/log/{folder.first}-{folder.last}"


def _load(spark: SparkSession, target: str, chosen: list[Folder]) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(*[_name(target, f) for f in chosen])


def read(spark: SparkSession, target: str, upto: int | None = None) -> DataFrame | None:
    """All rows of all batches up to ``upto``; None if there are none. Columns that came later are null before."""
    chosen = cover(folders(spark, target), upto)
    return _load(spark, target, chosen) if chosen else None


def write(df: DataFrame, target: str, number: int) -> None:
    """Write batch ``number``; the success marker comes last, a retry overwrites all of it."""
    df.write.mode("overwrite").parquet(f"{target}/log/{number}-{number}")


def drop(spark: SparkSession, target: str, number: int) -> None:
    """Take back a batch that turned out to be empty."""
    fs, path = _hadoop(spark, target)
    fs.delete(path(f"{target}/log/{number}-{number}"), True)


def merge(spark: SparkSession, target: str, reduce: Reduce, upto: int | None = None, whole: bool = False) -> list[Folder]:
    """Merge the newest folders while ``FAN`` neighbours have one level; with ``whole``, all folders into one.

    ``reduce`` makes fewer rows of the rows of several batches without changing what the table means. Returns the
    folders that hold the table now.
    """
    while True:
        chosen = cover(folders(spark, target), upto)
        tail = chosen if whole else chosen[-FAN:]
        if len(tail) < 2 or not whole and (len(tail) < FAN or len({f.level for f in tail}) > 1):
            return chosen
        joined = Folder(tail[0].first, tail[-1].last)
        reduce(_load(spark, target, tail)).write.mode("overwrite").parquet(_name(target, joined))


def trim(spark: SparkSession, target: str, keep_seconds: float) -> int:
    """Delete folders whose batches have been in a larger folder for ``keep_seconds``; returns how many.

    That time is the longest a reader may take from planning to its last file.
    """
    fs, path = _hadoop(spark, target)
    now = int(spark._jvm.java.lang.System.currentTimeMillis())
    found = folders(spark, target)
    old = [
        f for f in found
        if any(g.first <= f.first and f.last <= g.last and g.last - g.first > f.last - f.first and g.since + 1000 * keep_seconds <= now for g in found)
    ]
    for folder in old:
        fs.delete(path(_name(target, folder)), True)
    return len(old)


# ---------------------------------------------------------------- progress


def note(spark: SparkSession, target: str, number: int, kind: str, content: dict) -> None:
    """Write a note under another name first and rename it, so that it is there whole or not at all."""
    fs, path = _hadoop(spark, target)
    fs.mkdirs(path(f"{target}/progress"))
    draft, final = path(f"{target}/progress/.{number}.{kind}"), path(f"{target}/progress/{number}.{kind}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(content), "utf-8"))
    out.close()
    fs.delete(final, False)
    if not fs.rename(draft, final):
        raise OSError(f"could not write {final}")


def noted(spark: SparkSession, target: str, number: int, kind: str) -> dict | None:
    """A note, None if it is not there."""
    fs, path = _hadoop(spark, target)
    where = path(f"{target}/progress/{number}.{kind}")
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def forget(spark: SparkSession, target: str, number: int, kind: str) -> None:
    """Take back a note."""
    fs, path = _hadoop(spark, target)
    fs.delete(path(f"{target}/progress/{number}.{kind}"), False)


def last_done(spark: SparkSession, target: str) -> int | None:
    """Number of the newest load that has finished."""
    fs, path = _hadoop(spark, target)
    if not fs.exists(path(f"{target}/progress")):
        return None
    names = [status.getPath().getName() for status in fs.listStatus(path(f"{target}/progress"))]
    return max((int(n[:-5]) for n in names if n.endswith(".done") and n[:-5].isdigit()), default=None)
