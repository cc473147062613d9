"""Scalar conversions that give null (or a stated default) instead of failing under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_DATE = "yyyy-MM-dd"


def clock_part(text: str | Column, start: int) -> Column:
    """Two characters of an HH:MM:SS text as int; null when they are no number."""
    return F.substring(text, start, 2).try_cast("int")


def duration_seconds(text: str | Column) -> Column:
    """HH:MM:SS text (anything after the eighth character is ignored) as whole seconds."""
    return clock_part(text, 1) * 3600 + clock_part(text, 4) * 60 + clock_part(text, 7)


def safe_convert(value: str | Column, data_type: T.DataType | str, date_format: str = ISO_DATE) -> Column:
    """Cast, or null when the value does not fit; dates are parsed with `date_format`.

    The default date form goes through a cast behind a shape test: unlike a pattern parser it raises
    nothing inside for a bad date, which is many times faster on dirty columns. Timestamps are cast as they are.
    """
    value = F.col(value) if isinstance(value, str) else value
    if data_type != "date" and not isinstance(data_type, T.DateType):
        return value.try_cast(data_type)
    if date_format == ISO_DATE:
        shaped = value.cast("string").rlike(r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$")
        return F.when((F.typeof(value) != "string") | shaped, value.try_cast("date"))
    return F.try_to_date(value, date_format)


def scaled_text(value: str | Column, scale: int) -> Column:
    """Number as text with `scale` decimals; null or unparsable input gives the empty string.

    Rounds the exact binary value half-even, so 6.55 (stored slightly below) becomes 6.5 at scale 1.
    """
    value = F.col(value) if isinstance(value, str) else value
    number = value.try_cast("double")
    pattern = "0." + "0" * scale if scale > 0 else "0"
    return (F.when(number.isNull(), "")
            .when(F.isnan(number), "nan")
            .when(number == float("inf"), "inf")
            .when(number == float("-inf"), "-inf")
            .otherwise(F.call_function("format_number", number, F.lit(pattern))))


def text_or_empty(value: str | Column, data_type: T.DataType | None = None, date_format: str = ISO_DATE) -> Column:
    """Text form of any value, dates by `date_format`, null as the empty string."""
    value = F.col(value) if isinstance(value, str) else value
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(value, date_format)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def or_default(value: Column, default) -> Column:
    """Default in place of null; pair it with a `try_` expression to survive bad input too."""
    return F.coalesce(value, F.lit(default))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Division that is null when the denominator is zero or null."""
    return F.try_divide(numerator, denominator)


def first_item(items: str | Column) -> Column:
    return F.get(items, F.lit(0))


def last_item(items: str | Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def item_count(items: str | Column) -> Column:
    """Number of entries of an array or map; a null container counts as empty."""
    return F.coalesce(F.size(items), F.lit(0))
