"""Comparing cursor values by what they mean rather than by how they are written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FRACTION = r"\.(\d+)"


def fraction_digits(c: Column) -> Column:
    """Digits of the fractional second, empty when there are none."""
    return F.coalesce(F.regexp_extract(c, _FRACTION, 1), F.lit(""))


def iso_any_fraction(c: Column) -> Column:
    """ISO text with any number of fraction digits as a timestamp; digits past the sixth are cut."""
    digits = fraction_digits(c)
    six = F.rpad(F.substring(digits, 1, 6), 6, "0")
    fixed = F.when(digits == "", c).otherwise(F.regexp_replace(c, F.lit(_FRACTION), F.concat(F.lit("."), six)))
    return F.try_to_timestamp(fixed)


def is_iso(c: Column) -> Column:
    """Text in extended ISO form, which starts with YYYY-MM-DD."""
    return c.rlike(r"^.{4}-.{2}-.{2}") & iso_any_fraction(c).isNotNull()


def exact_number(c: Column) -> Column:
    """Numeric text as an exact decimal, null otherwise."""
    return F.trim(c).try_cast("decimal(38,9)")


def cursor_key(c: Column) -> Column:
    """Sort struct of a cursor written as text: times in time order, numbers exactly, the rest as text."""
    iso = is_iso(c)
    number = F.when(~iso, exact_number(c))
    family = F.when(iso, F.lit(1)).when(number.isNotNull(), F.lit(2)).otherwise(F.lit(3))
    beyond_micros = F.when(iso, F.rpad(F.substring(fraction_digits(c), 7, 18), 18, "0"))
    return F.when(
        c.isNotNull(),
        F.struct(
            family.alias("family"),
            F.when(iso, F.unix_micros(iso_any_fraction(c))).alias("micros"),
            number.alias("number"),
            beyond_micros.alias("rest"),
            F.when(family == 3, c).alias("text"),
        ),
    )


def same_instant(a: Column, b: Column) -> Column:
    """True when two texts stand for the same time or number, whatever their writing."""
    return (a == b) | (cursor_key(a) == cursor_key(b))


def at_or_before(a: Column, b: Column) -> Column:
    """True only when ``a`` is provably not newer than ``b``; values of different families are never dropped."""
    left, right = cursor_key(a), cursor_key(b)
    return (left["family"] == right["family"]) & (left <= right)


def pk_ordinal(*keys: Column) -> Column:
    """Number in 0..999999 that depends only on the key, to spread rows over the microseconds of one second."""
    texts = [F.coalesce(k.cast("string"), F.lit("None")) for k in keys]
    digest = F.sha1(F.concat_ws("\x1f", *texts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(1_000_000)
