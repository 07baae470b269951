"""Scalar expressions: tolerant casts, decimal shift, text clean-up, event-time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AMOUNT_DIGITS = 27
AMOUNT = T.DecimalType(AMOUNT_DIGITS, 9)


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def tolerant(value: Column | str, to: str) -> Column:
    """Cast that yields NULL for text that does not parse (plain casts raise under ANSI mode)."""
    return as_col(value).try_cast(to)


def shift_decimal(amount: Column | str, decimals: Column | str) -> Column:
    """Integer text scaled down by ``decimals`` places, as DECIMAL(27, 9).

    The text is zero-padded to 27 digits and split ``decimals`` from the right; longer texts, anything that
    does not fit the type, and NULL on either side, become NULL.
    """
    digits = F.when(F.length(as_col(amount)) <= AMOUNT_DIGITS, F.lpad(as_col(amount), AMOUNT_DIGITS, "0"))
    places = as_col(decimals)
    whole = F.substring(digits, F.lit(1), F.lit(AMOUNT_DIGITS) - places)
    fraction = F.substring(digits, F.lit(AMOUNT_DIGITS + 1) - places, places)
    return F.concat(whole, F.lit("."), fraction).try_cast(AMOUNT)


def shout(text: Column | str) -> Column:
    """Upper-cased text without white space of any kind around it, for comparing commands typed by people."""
    return F.upper(F.regexp_replace(as_col(text), r"^[\s\u00a0\ufeff]+|[\s\u00a0\ufeff]+$", ""))


def fill_template(template: str, **fields: Column | str) -> Column:
    """Replace every ``{name}`` in a literal template by the column given for that name."""
    text = F.lit(template)
    for name, value in fields.items():
        text = F.replace(text, F.lit("{" + name + "}"), as_col(value))
    return text


def strip_nul(text: Column | str) -> Column:
    """Text without its NUL padding."""
    return F.replace(as_col(text), F.lit("\u0000"), F.lit(""))


def or_default(value: Column | str, default) -> Column:
    """``value`` unless it is NULL, zero or empty, else ``default`` (all of them, as in JavaScript's ``||``)."""
    column = as_col(value)
    fallback = default if isinstance(default, Column) else F.lit(default)
    falsy = "" if isinstance(default, str) else 0
    return F.coalesce(F.nullif(column, F.lit(falsy)), fallback)


def seconds_to_time(seconds: Column | str) -> Column:
    """Epoch seconds to TIMESTAMP; missing seconds count as the epoch."""
    return F.timestamp_seconds(F.coalesce(as_col(seconds), F.lit(0)))


def seconds_to_millis(seconds: Column | str) -> Column:
    return F.coalesce(as_col(seconds), F.lit(0)).cast("bigint") * 1000


def utf8_size(text: Column | str) -> Column:
    return F.octet_length(as_col(text))


def record_json(*columns: Column | str) -> Column:
    """The given columns as one JSON object text, NULL fields kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def floor_div(value: Column, width: int) -> Column:
    """Integer division rounding down, also below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since 1970 for a time column; integers are read as epoch seconds already.

    Zone-less timestamps are taken apart by calendar field, so the session time zone plays no part.
    """
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(column)
    if isinstance(kind, T.TimestampNTZType):
        days = F.unix_date(F.to_date(column)).cast("bigint")
        return days * 86_400 + F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
    raise TypeError(f"{name} is {kind.simpleString()}, not a time")
