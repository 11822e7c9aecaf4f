"""Lenient but exact value coercion for untrusted text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings.
DECIMAL_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
DIGITS = r"^-?\d+$"
ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?(Z|[+-]\d{2}:\d{2}(:\d{2})?)?)?$"
)
HAS_OFFSET = r"(Z|.{11,}[+-]\d{2}:\d{2}(:\d{2})?)$"
BLANKS = " \t\n\r\x0b\x0c"


def stripped(text: Column) -> Column:
    """Trim every kind of blank, not the space character alone."""
    return F.btrim(text, F.lit(BLANKS))


def decimal_or_infinite(text: Column) -> Column:
    """Decimal text to a double; the cast trims blanks, the pattern keeps ``0x1`` and ``1d`` out."""
    return F.when(text.rlike(DECIMAL_NUMBER), text.try_cast("double"))


def is_finite(number: Column) -> Column:
    return F.abs(number) < F.lit(float("inf"))


def ascii_number(text: Column) -> Column:
    """Decimal text to a finite double, else NULL."""
    number = decimal_or_infinite(text)
    return F.when(is_finite(number), number)


def batch_number(json_type: Column, text: Column) -> Column:
    """A JSON scalar to a whole batch number: ``5``, ``5.0`` and ``"5"`` but not ``5.5``."""
    clean = stripped(text)
    digits = F.when(clean.rlike(DIGITS), clean.try_cast("bigint"))
    # Beyond 2**53 a double no longer names one whole number, and 9.3e18 leaves BIGINT.
    number = ascii_number(text)
    integral = F.when((number == F.floor(number)) & (F.abs(number) < F.lit(9.2e18)), number.cast("bigint"))
    return F.when(json_type == "string", digits).when(json_type == "number", F.coalesce(digits, integral))


def utc_timestamp(text: Column) -> Column:
    """ISO-8601 text to a timestamp; no offset means UTC, anything else is NULL."""
    clean = F.upper(stripped(text))
    has_seconds = (F.substring(clean, 14, 1) == ":") & (F.substring(clean, 17, 1) == ":")
    filled = F.regexp_replace(clean, r"^(.{10})$", "$1T00")
    filled = F.regexp_replace(filled, r"^(.{10}[T ]\d{2})(?=[Z+-]|$)", "$1:00")
    filled = F.regexp_replace(filled, r"^(.{10}[T ]\d{2}:\d{2})(?=[Z+-]|$)", "$1:00")
    full = F.when(has_seconds, clean).otherwise(filled)
    zoned = F.when(clean.rlike(HAS_OFFSET), full).otherwise(F.concat(full, F.lit("Z")))
    return F.when(clean.rlike(ISO_TIMESTAMP), zoned.try_cast("timestamp"))
