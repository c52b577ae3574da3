r"""Personal data in texts becomes a keyed pseudonym of the same format.

Numbers and dates are found by pattern, validated, and permuted by a Feistel network within the set of valid values of
their kind, so that a value is replaced by the same other value wherever it stands, and no two values by the same one.
Only SQL functions; every text is rewritten in its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweir.llm.common import free_name

ROUNDS = 8

# What may be personal data. A pattern starts and ends where no letter or digit of a longer run goes on, and each run
# is tried once, so a text of any length costs one pass.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ADDRESS = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
ISO_DATE = r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w]|-\d)"
DAY_DATE = r"(?<![\w./])\d{1,2}[./]\d{1,2}[./]\d{4}(?![\w]|[./]\d)"
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d)"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
LOCAL_PHONE = r"(?<![\w+(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)|(?<![\w+-])\d{3}-\d{3}-\d{4}(?![\w]|-\d)"
CARD = r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?![\w]|-\d)"
ANY = "|".join([EMAIL, ISO_DATE, SOCIAL, PHONE, LOCAL_PHONE, CARD, ADDRESS, DAY_DATE])

# Days 1900-01-01 to 2099-12-31: 73049 = 17 x 4297, so the two halves of a day number fill the range exactly.
_FIRST_DAY, _DAYS = "1900-01-01", (17, 4297)
# Areas 001-665 and 667-899, groups 01-99, serials 0001-9999.
_SOCIAL = (898 * 99, 9999)


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _noise(key: str, kind: str, half: Column, round_: Column) -> Column:
    """64 hexadecimal digits that depend on the key, the kind, the round and the other half."""
    return F.sha2(F.concat_ws("|", F.lit(f"{key}|{kind}"), round_.cast("string"), half.cast("string")), 256)


def _number(key: str, kind: str, half: Column, round_: Column) -> Column:
    return F.conv(F.substring(_noise(key, kind, half, round_), 1, 12), 16, 10).cast("long")


def permute_pair(value: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """Keyed permutation of 0 .. a*b-1: halves in Z_a and Z_b, each shifted in turn by a function of the other."""
    a, b = sizes

    def step(s: Column, r: Column) -> Column:
        left = F.pmod(s["l"] + _number(key, kind, s["r"], r), F.lit(a))
        right = F.pmod(s["r"] + _number(key, kind, s["l"], r), F.lit(b))
        even = r % 2 == 0
        return F.struct(F.when(even, left).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(right).alias("r"))

    start = F.struct(F.floor(value / b).cast("long").alias("l"), (value % b).cast("long").alias("r"))
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, step, lambda s: s["l"] * b + s["r"])


def _shift(half: Column, noise: Column) -> Column:
    """Every letter and digit of ``half`` moved within its class by its share of ``noise``."""

    def one(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(noise, (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        code = F.ascii(c)

        def move(first: str, size: int) -> Column:
            return F.char(F.lit(ord(first)) + F.pmod(code - ord(first) + by, F.lit(size)))

        return (
            F.when(c.between("0", "9"), move("0", 10))
            .when(c.between("a", "z"), move("a", 26))
            .when(c.between("A", "Z"), move("A", 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(half, ""), one), "")


def permute_text(value: Column, key: str, kind: str) -> Column:
    """Keyed permutation of texts that keeps the class of every character: digit, small or capital letter, other."""
    cut = F.ceil(F.char_length(value) / 2).cast("int")

    def step(s: Column, r: Column) -> Column:
        even = r % 2 == 0
        noise = _noise(key, kind, F.when(even, s["r"]).otherwise(s["l"]), r)
        moved = _shift(F.when(even, s["l"]).otherwise(s["r"]), noise)
        return F.struct(F.when(even, moved).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(moved).alias("r"))

    start = F.struct(
        F.substring(value, F.lit(1), cut).alias("l"),
        F.substring(value, cut + 1, F.char_length(value)).alias("r"),
    )
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, start, step, lambda s: F.concat(s["l"], s["r"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def luhn_sum(digits: Column) -> Column:
    """Check sum over the digits, the last one counted as it is and every second one before it doubled."""
    doubled = F.transform(
        F.reverse(F.split(digits, "")),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda acc, x: acc + x)


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order by ``digits``."""
    gaps = F.split(shape, r"\d", -1)
    return F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.substring(digits, i + 1, F.lit(1)))), "")


def _card(value: Column, key: str) -> Column:
    def filled(d: Column) -> Column:
        body = permute_text(F.substring(d, F.lit(1), F.char_length(d) - 1), key, "card")
        return _bind(
            body,
            lambda p: F.concat(p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")),
        )

    return _bind(_digits(value), lambda d: F.when(luhn_sum(d) % 10 == 0, _refill(value, filled(d))).otherwise(value))


def _social(value: Column, key: str) -> Column:
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    fits = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = (area - 1 - (area > 666).cast("long")) * 99 + group - 1
    number = rank * 9999 + serial - 1

    def written(n: Column) -> Column:
        a = F.floor(n / (99 * 9999)).cast("long") + 1
        a = a + (a >= 666).cast("long")
        return F.format_string("%03d-%02d-%04d", a, F.floor(n / 9999).cast("long") % 99 + 1, n % 9999 + 1)

    return F.when(fits, _bind(permute_pair(number, _SOCIAL, key, "social"), written)).otherwise(value)


def _address(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))

    def number(p: Column) -> Column:
        return F.aggregate(p, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x)

    def written(n: Column) -> Column:
        return F.concat_ws(".", *[F.floor(n / 256**i).cast("long") % 256 for i in (3, 2, 1, 0)])

    def use(p: Column) -> Column:
        new = permute_pair(number(p), (65536, 65536), key, "address")
        return F.when(F.forall(p, lambda x: x < 256), _bind(new, written)).otherwise(value)

    return _bind(parts, use)


def _moved_day(day: Column, key: str) -> Column:
    first = F.to_date(F.lit(_FIRST_DAY))
    number = F.datediff(day, first).cast("long")
    new = F.date_add(first, permute_pair(number, _DAYS, key, "date").cast("int"))
    return F.when(number.between(0, _DAYS[0] * _DAYS[1] - 1), new)


def _iso_date(value: Column, key: str) -> Column:
    new = _moved_day(F.try_to_timestamp(value, F.lit("yyyy-MM-dd")).cast("date"), key)
    return F.coalesce(F.date_format(new, "yyyy-MM-dd"), value)


def _day_date(value: Column, key: str) -> Column:
    """Day first, or month first where only that gives a date; separator, padding and order stay."""
    p = F.split(value, "[./]")
    mark = F.regexp_extract(value, "[./]", 0)
    padded = F.transform(p, lambda x: F.lpad(x, 2, "0"))
    year = F.element_at(p, 3)
    day_first = F.try_to_timestamp(
        F.concat(year, F.element_at(padded, 2), F.element_at(padded, 1)), F.lit("yyyyMMdd")
    ).cast("date")
    month_first = F.try_to_timestamp(
        F.concat(year, F.element_at(padded, 1), F.element_at(padded, 2)), F.lit("yyyyMMdd")
    ).cast("date")
    wide = F.char_length(value) == 10

    def written(day: Column, pattern: tuple[str, str]) -> Column:
        long, short = pattern
        parts = F.when(wide, F.date_format(day, long)).otherwise(F.date_format(day, short))
        return F.concat(F.regexp_replace(parts, "/", mark))

    by_day = written(_moved_day(day_first, key), ("dd/MM/yyyy", "d/M/yyyy"))
    by_month = written(_moved_day(month_first, key), ("MM/dd/yyyy", "M/d/yyyy"))
    return F.coalesce(F.when(day_first.isNotNull(), by_day).otherwise(by_month), value)


def _phone(value: Column, key: str) -> Column:
    """The country code before a separator stays, or else the first digit."""
    code = F.regexp_extract(value, r"^\+(?:\d{1,3}(?=[ .(-])|\d)", 0)
    rest = F.substring(value, F.char_length(code) + 1, F.char_length(value))
    return F.concat(code, _refill(rest, permute_text(_digits(rest), key, "phone")))


def _email(value: Column, key: str) -> Column:
    """Everything before the top-level domain is permuted; case is kept, so spellings that differ in it are values."""
    top = F.regexp_extract(value, r"\.[A-Za-z0-9-]+$", 0)
    front = F.substring(value, F.lit(1), F.char_length(value) - F.char_length(top))
    return F.concat(permute_text(front, key, "email"), top)


def pseudonym(value: Column, key: str) -> Column:
    """The replacement of one match of ``ANY``; a match that is not valid stays."""
    whole = [
        (EMAIL, _email), (ISO_DATE, _iso_date), (SOCIAL, _social), (ADDRESS, _address),
        (DAY_DATE, _day_date), (LOCAL_PHONE, _phone), (CARD, _card),
    ]
    out = F.when(value.startswith("+"), _phone(value, key))
    for pattern, use in whole:
        out = out.when(value.rlike(f"^(?:{pattern})$"), use(value, key))
    return out.otherwise(value)


def pseudonymize(df: DataFrame, key: str, text: str = "text", counts: bool = True) -> DataFrame:
    """``df`` with the personal data in ``text`` replaced, and n_pii (long): how many matches changed.

    Null stays null, empty stays empty. Rows are rewritten one by one, so copies stay copies and repeated values stay
    linked across documents. Other columns are untouched; ``n_pii`` is renamed if taken.
    """
    t = F.col(text)
    found, new = free_name(df, "_found"), free_name(df, "_new")
    none = F.array().cast("array<string>")
    out = df.withColumn(found, F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).otherwise(none))
    out = out.withColumn(new, F.transform(F.col(found), lambda v: pseudonym(v, key)))
    gaps = F.split(t, ANY, -1)
    pieces = F.zip_with(gaps, F.col(new), lambda g, n: F.concat(g, F.coalesce(n, F.lit(""))))
    rewritten = F.when(F.size(found) > 0, F.array_join(pieces, "")).otherwise(t)
    changed = F.size(F.filter(F.zip_with(F.col(found), F.col(new), lambda a, b: a != b), lambda x: x))
    if counts:
        out = out.withColumn(free_name(df, "n_pii"), changed.cast("long"))
    return out.withColumn(text, rewritten).drop(found, new)
