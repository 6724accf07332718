"""Safe text-to-time casts and JSON value helpers, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Extended ISO 8601: a date, optionally a time (hours, minutes, seconds, fraction) and a UTC
# offset. Spark's own cast is wider ('2025', '10:15'), so text is checked before it is parsed.
ISO_TIMESTAMP = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?)?\z"
)
ISO_DATE = r"^(?!0000)\d{4}-\d{2}-\d{2}\z"


# Basic forms: no dashes, no colons, ISO weeks; any one character between date and time.
_BASIC_DATE = r"^(\d{4})(\d{2})(\d{2})(?=\D|\z)"
_WEEK_DATE = r"^(\d{4})(?:-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?)(?=\D|\z)"
_BASIC_SECONDS = r"^(.{11}\d{2})(\d{2})(\d{2})(?=[.,Z+-]|\z)"
_BASIC_MINUTES = r"^(.{11}\d{2})(\d{2})(?=[Z+-]|\z)"


def _week_day(text: Column) -> Column:
    """The day an ISO week form begins with, as ``YYYY-MM-DD``; NULL when there is no such week."""

    def part(*groups: int) -> Column:
        return F.coalesce(*[F.nullif(F.regexp_extract(text, _WEEK_DATE, g), F.lit("")) for g in groups])

    week, day = part(2, 4).try_cast("int"), F.coalesce(part(3, 5).try_cast("int"), F.lit(1))
    first = F.date_trunc("week", F.concat(part(1), F.lit("-01-04")).try_cast("date")).cast("date")
    found = F.date_add(first, (week - 1) * 7 + day - 1)
    real = day.between(1, 7) & (F.weekofyear(F.date_add(first, (week - 1) * 7)) == week)
    return F.when(real, F.date_format(found, "yyyy-MM-dd"))


def _extended(text: Column) -> Column:
    """Basic ISO forms rewritten to extended ones; other text comes back as it is."""
    day = F.when(
        text.rlike(_WEEK_DATE), F.concat(_week_day(text), F.regexp_replace(text, _WEEK_DATE, ""))
    ).otherwise(F.regexp_replace(text, _BASIC_DATE, "$1-$2-$3"))
    out = F.regexp_replace(day, r"^(.{10})[^T](?=\d)", "$1T")
    out = F.regexp_replace(out, _BASIC_SECONDS, "$1:$2:$3")
    return F.regexp_replace(out, _BASIC_MINUTES, "$1:$2")


def _rewritten(text: Column, parse) -> Column:
    """``parse`` of the extended form of odd text, which is worked out once and bound to a name."""
    one = F.transform(F.array(F.when(_could_be_basic(text), text)), _extended)
    return F.get(F.transform(one, parse), F.lit(0))


def _could_be_basic(text: Column) -> Column:
    """Whether text could be a basic or week form at all: a cheap test before any rewriting."""
    return text.rlike(r"^\d{4}[-W]?[\dW]")


def iso_timestamp(text: Column) -> Column:
    """ISO text to TIMESTAMP; no offset means UTC (the session zone), bad text gives NULL.

    Extended forms, which nearly all texts have, are told by one pattern; only others are
    rewritten from the basic and week forms first.
    """
    return F.when(text.rlike(ISO_TIMESTAMP), _extended_timestamp(text)).otherwise(
        _rewritten(text, lambda t: F.when(t.rlike(ISO_TIMESTAMP), _extended_timestamp(t)))
    )


def _extended_timestamp(text: Column) -> Column:
    # Rarely needed: Spark wants a point before the fraction, and minutes and seconds before an offset.
    padded = F.translate(text, ",", ".")
    for width in (13, 16):
        padded = F.regexp_replace(padded, rf"^(.{{{width}}})(Z|[+-].*)$", "$1:00$2")
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(padded))


def iso_date(text: Column) -> Column:
    """ISO text to DATE: ``YYYY-MM-DD``, without dashes, or by week; anything else gives NULL."""
    return F.when(text.rlike(ISO_DATE), text.try_cast("date")).otherwise(
        _rewritten(text, lambda t: F.when(t.rlike(ISO_DATE), t.try_cast("date")))
    )


def plain_text(ts: Column) -> Column:
    """TIMESTAMP to ``YYYY-MM-DD HH:MM:SS[.ffffff]``; a zero fraction is left out."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), _fraction(ts))


def iso_utc_text(ts: Column) -> Column:
    """TIMESTAMP to ISO text ending in Z; a zero fraction is left out."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), _fraction(ts), F.lit("Z"))


def _fraction(ts: Column) -> Column:
    return F.when(F.date_format(ts, "SSSSSS") == "000000", F.lit("")).otherwise(
        F.date_format(ts, ".SSSSSS")
    )


def to_millis(ts: Column) -> Column:
    """Cut (not round) to milliseconds, the stored precision."""
    return F.date_trunc("millisecond", ts)


def as_timestamp(column: Column, dtype: T.DataType) -> Column:
    """Safe cast to TIMESTAMP by declared type, NULL for what cannot be cast."""
    if isinstance(dtype, T.TimestampType):
        return column
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return iso_timestamp(column)
    return iso_timestamp(column.cast("string"))


def as_date(column: Column, dtype: T.DataType) -> Column:
    """Safe cast to DATE by declared type; of timestamp text the day part counts."""
    if isinstance(dtype, T.DateType):
        return column
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return column.cast("date")
    text = column.cast("string")
    return F.coalesce(iso_date(text), iso_timestamp(text).cast("date"))


# JSON text of what counts as empty: null, "", zero, false, an empty list or object.
_FALSY_JSON = r'^(null|""|-?0(\.0*)?([eE][+-]?\d+)?|false|\[\]|\{\})\z'


def json_at(document: str, path: str) -> Column:
    """JSON text at a path of a variant column, quotes included; NULL when it is not there."""
    return F.expr(f"to_json(try_variant_get({document}, '{path}', 'variant'))")


def json_truthy(document: str, path: str) -> Column:
    """False for what is absent and for null, "", 0, false, [] and {}."""
    return ~F.coalesce(json_at(document, path), F.lit("null")).rlike(_FALSY_JSON)


def maybe_falsy(text: Column) -> Column:
    """Whether text taken from JSON could be the rendering of 0, false, [] or {}."""
    return F.substring(text, 1, 1).isin("0", "-", "f", "[", "{") & text.rlike(_FALSY_JSON)
