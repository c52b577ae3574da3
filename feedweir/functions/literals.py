"""Python values as literals of a column's type, so comparisons need no cast on the column and stay pushable."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal(value: object, kind: T.DataType | str | None = None) -> Column:
    """``value`` as a Column of ``kind``. Times without a zone are UTC, whatever the machine's zone is."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        plain = value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value
        column = F.lit(plain.isoformat(sep=" ")).cast("timestamp_ntz")
        return column if kind is None else column.cast(kind)
    return F.lit(value) if kind is None else F.lit(value).cast(kind)
