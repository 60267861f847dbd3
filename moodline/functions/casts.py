"""Guarded casts and NULL rules.

Spark's ``try_cast`` is more permissive than the source system's parsers
(it takes ``'2024'``, ``'10:00:00'``, ``'1d'``, ``'yes'`` ...). Each helper
first checks the trimmed text against the forms the source accepts and only
then casts, so a value is either parsed exactly as the source would or
becomes NULL. Everything stays a JVM Column expression (whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, StringType, TimestampType

# The usual timestamp forms (ISO date, optional time with
# optional fraction and zone), which a plain cast reads.
ISO_TIMESTAMP_GUARD = r"^(?!0000)\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-](0\d|1[0-7]):?[0-5]\d)?)?$"
# Date-times with unpadded parts, taken from the text as it stands (no outer blanks).
UNPADDED_GUARD = (r"^(?!0000)\d{4}-(1[0-2]|0?[1-9])-([12]\d|3[01]|0?[1-9])([Tt]|\s+)(2[0-3]|[01]?\d)"
                  r":[0-5]?\d:[0-5]?\d(\.\d{1,6})?$")
# White space around a timestamp.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"
# All other ISO 8601 forms that the source reads, "Z" written as +00:00: calendar and week dates, extended and
# basic; any one character before the time; a fraction (comma or point) of the second after any part; offsets to the
# microsecond; one character before an offset, but not after a fraction of 1 to 5 digits. Groups: 1-3, 4-6 calendar
# date, 7-9, 10-12 week date, 13 hour, 14-15, 16-17 minute and second (extended, basic), 18 fraction, 19 sign,
# 20 hour, 21-22, 23-24 minute and second, 25 fraction of the offset.
_CLOCK = r"(?:(?::({n})(?::({n}))?)|(?:({n})({n})?))?(?:[.,](\d+))?"
ISO_ANY_GUARD = (
    r"^(?s)(?!0000)(?:(\d{4})-(\d\d)-(\d\d)|(\d{4})(\d\d)(\d\d)|(\d{4})-W(\d\d)(?:-(\d)(?!\d))?"
    r"|(\d{4})W(\d\d)(?:(\d)(?=(?:\d\d)*\d(?:\D|$)|\D|$))?)"
    r"(?:.([01]\d|2[0-3])" + _CLOCK.replace("{n}", r"[0-5]\d") + r"(?:(?:(?<![.,]\d{1,5})[^+-])?([+-])([01]\d|2[0-3])"
    + _CLOCK.replace("{n}", r"\d\d") + r")?)?$")
WEEK_GUARD = r"^\d{4}-?W"
# Decimal / scientific / nan / inf text, no type suffix, no '_'.
DOUBLE_GUARD = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|nan|inf|infinity)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _any_iso(text: Column) -> Column:
    """Instant of a text in any ISO form; NULL for a day, week or offset there is none of."""
    def part(replacement: str) -> Column:
        return F.regexp_replace(text, ISO_ANY_GUARD, replacement)

    def micros(hour: str, minute: str, second: str, fraction: str) -> Column:
        """Microseconds of a time or an offset; parts there are none of are 0."""
        seconds = (part(f"0{hour}").cast("long") * 60 + part(f"0{minute}").cast("int")) * 60 + part(f"0{second}").cast("int")
        return seconds * 1_000_000 + F.rpad(F.substring(part(fraction), 1, 6), 6, "0").cast("int")

    # The week of 4 January is the year's first; a week belongs to the year of its Thursday.
    year, week, day = part("0$7$10").cast("int"), part("0$8$11").cast("int"), F.coalesce(F.nullif(part("$9$12"), F.lit("")), F.lit("1")).cast("int")
    thursday = F.date_add(F.trunc(part("$7$10-01-04").try_cast(DateType()), "week"), week * 7 - 4)
    in_week = F.when((week > 0) & day.between(1, 7) & (F.year(thursday) == year), F.date_add(thursday, day - 4))
    date = F.when(text.rlike(WEEK_GUARD), in_week).otherwise(part("$1$4-$2$5-$3$6").try_cast(DateType()))
    offset = micros("$20", "$21$23", "$22$24", "$25")
    at = (F.unix_date(date).cast("long") * 86_400_000_000 + micros("$13", "$14$16", "$15$17", "$18")
          - F.when(part("$19") == "-", -1).otherwise(1) * offset)
    return F.when((offset < 86_400_000_000) & F.year(F.timestamp_micros(at)).between(1, 9999), F.timestamp_micros(at))


_DOUBLE_SQL = (
    "CASE WHEN lower(trim(CAST({c} AS STRING))) RLIKE r'" + DOUBLE_GUARD + "' "
    "THEN try_cast(trim(CAST({c} AS STRING)) AS DOUBLE) END"
)


def safe_timestamp(c: Column | str) -> Column:
    """Text -> UTC timestamp, NULL when the text is not an accepted form.

    Zone-less text is read as UTC (the session zone is UTC). Only texts in
    unusual forms reach the last, expensive branch.
    """
    raw = _col(c).cast(StringType())
    zoned = F.replace(F.trim(raw, F.lit(BLANKS)), F.lit("Z"), F.lit("+00:00"))
    return (F.when(raw.rlike(ISO_TIMESTAMP_GUARD), raw.try_cast(TimestampType()))
            .when(raw.rlike(UNPADDED_GUARD), F.regexp_replace(F.upper(raw), r"\s+", " ").try_cast(TimestampType()))
            # A lambda's body is interpreted: inlined into generated code, this branch would make it too large to compile.
            .when(zoned.rlike(ISO_ANY_GUARD), F.transform(F.array(zoned), _any_iso)[0]))


def safe_double(c: Column | str) -> Column:
    """Text -> double, NULL unless plain decimal/scientific/nan/inf text."""
    if isinstance(c, str):
        return F.expr(_DOUBLE_SQL.replace("{c}", _sql_name(c)))
    t = F.trim(_col(c).cast(StringType()))
    return F.when(F.lower(t).rlike(DOUBLE_GUARD), t.try_cast(DoubleType()))


def safe_bool(c: Column | str) -> Column:
    """Text -> boolean; only 'true' / 'false' (any case, outer blanks) pass."""
    t = F.lower(F.trim(_col(c).cast(StringType())))
    return F.when(t.isin("true", "false"), t == F.lit("true"))


def as_type(df: DataFrame | DataType, name: str, target: DataType) -> Column:
    """Guarded cast of column ``name`` to ``target``; typed input passes through.

    ``df`` may be the frame or, to avoid re-reading its schema per column,
    the column's current type.
    """
    current = df if isinstance(df, DataType) else df.schema[name].dataType
    c = F.col(name)
    if current == target:
        return c
    if isinstance(target, TimestampType):
        if current.typeName() in ("timestamp_ntz", "date"):
            return c.cast(TimestampType())
        return safe_timestamp(name)
    if isinstance(target, DoubleType):
        if current.typeName() in ("integer", "long", "short", "byte", "float", "decimal"):
            return c.cast(DoubleType())
        return safe_double(name)
    if isinstance(target, BooleanType):
        return safe_bool(c)
    return c.cast(target)


def blank_to(c: Column | str, default: str) -> Column:
    """``COALESCE(NULLIF(CAST(c AS STRING), ''), default)``; blanks stay."""
    s = _col(c).cast(StringType())
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(default))


def least_strict(c: Column | str, bound: float) -> Column:
    """``LEAST(c, bound)`` that returns NULL for a NULL input.

    Spark's ``least`` skips NULLs; the source warehouse propagates them.
    """
    x = _col(c)
    return F.when(x.isNotNull(), F.least(x, F.lit(bound)))


def is_missing(c: Column | str) -> Column:
    """Required-field test: absent, NULL or empty text (blanks pass)."""
    x = _col(c)
    return x.isNull() | (x.cast(StringType()) == F.lit(""))
