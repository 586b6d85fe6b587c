"""Text to typed value, as Column -> Column functions.

Every function takes a string Column and returns a Column built from Spark
built-ins, so it runs inside whole-stage code generation. A value that cannot
be converted becomes NULL here; `tagloom.operators.typed` turns such NULLs
into violations.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed values.
# Characters that count as surrounding space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Words read as true, after trimming and lower-casing.
TRUE_WORDS = ("true", "1", "yes", "y", "t")
# Shape of a date-time value: YYYY-MM-DD HH:MM.
DATETIME_SHAPE = r"^(\d{4}-\d{1,2}-\d{1,2})\s+(\d{1,2}:\d{1,2})$"
# Shape of a floating-point value.
FLOAT_SHAPE = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"
# End of fixed values.

_INT_SHAPE = r"^[+-]?[0-9]+$"


def strip(value: Column) -> Column:
    """Drop surrounding white space, Unicode spaces and line ends included."""
    return F.trim(value, F.lit(WHITESPACE))


def integer(value: Column) -> Column:
    """32-bit integer; NULL for blank, malformed or out-of-range text."""
    return strip(value).try_cast("int")


def integer_or_zero(value: Column) -> Column:
    """Like `integer`, but absent or blank text is 0."""
    text = strip(value)
    return F.when(value.isNull() | (text == ""), F.lit(0)).otherwise(text.try_cast("int"))


def optional_integer(value: Column) -> Column:
    """Like `integer`; absent or blank text is a legitimate NULL."""
    return F.nullif(strip(value), F.lit("")).try_cast("int")


def long_integer(value: Column) -> Column:
    """64-bit integer; NULL for blank, malformed or out-of-range text."""
    return strip(value).try_cast("bigint")


def boolean(value: Column) -> Column:
    """True for the known words in any case; anything else, absent included, is false."""
    return F.coalesce(is_true_word(strip(value)), F.lit(False))


def is_true_word(trimmed: Column) -> Column:
    return F.lower(trimmed).isin(*TRUE_WORDS)


def strict_boolean(value: Column) -> Column:
    """True only for the exact text ``true``."""
    return F.coalesce(value == "true", F.lit(False))


def folded_boolean(value: Column) -> Column:
    """True for ``true`` in any case and with spaces around it; absent stays NULL."""
    return F.lower(strip(value)) == "true"


def text(value: Column) -> Column:
    """Trimmed text; empty stays empty."""
    return strip(value)


def text_or_empty(value: Column) -> Column:
    """Untrimmed text; absent becomes empty."""
    return F.coalesce(value, F.lit(""))


def optional_text(value: Column) -> Column:
    """Trimmed text; absent or empty is NULL (text of spaces only gives empty text)."""
    return F.when(value != "", strip(value))


def optional_trimmed(value: Column) -> Column:
    """Trimmed text; absent or blank is NULL."""
    return F.nullif(strip(value), F.lit(""))


def uuid(value: Column) -> Column:
    """Canonical lower-case UUID text; blank or malformed text is NULL.

    Braces around the value, upper case, and hyphens at any place or none are
    accepted.
    """
    return uuid_of(strip(value))


def uuid_of(trimmed: Column) -> Column:
    digits = F.lower(F.replace(trimmed, F.lit("-"), F.lit("")))
    groups = r"([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})"
    return F.when(
        digits.rlike(r"^([0-9a-f]{32}|\{[0-9a-f]{32}\})\z"),
        F.regexp_replace(digits, rf"^\{{?{groups}\}}?\z", "$1-$2-$3-$4-$5"),
    )


def floating(value: Column) -> Column:
    """Double; only decimal notation, ``inf`` and ``nan`` are read."""
    plain = strip(value)
    return F.when(plain.rlike(FLOAT_SHAPE), plain.try_cast("double"))


def date_time(value: Column) -> Column:
    """``YYYY-MM-DD HH:MM`` as a timestamp without time zone; single digits are accepted."""
    iso = F.regexp_replace(value, DATETIME_SHAPE, "$1 $2")
    return F.when(value.rlike(DATETIME_SHAPE), iso.try_cast("timestamp_ntz"))


def convert(value: Column, data_type: T.DataType) -> Column:
    """Convert text to `data_type`; NULL stays NULL for every type."""
    by_type = {
        T.StringType: lambda v: v,
        T.IntegerType: integer,
        T.LongType: long_integer,
        T.DoubleType: floating,
        T.BooleanType: folded_boolean,
        T.TimestampNTZType: date_time,
        T.TimestampType: lambda v: date_time(v).cast("timestamp"),
        T.DateType: lambda v: strip(v).try_cast("date"),
    }
    return by_type[type(data_type)](value)


def is_int_text(value: Column) -> Column:
    """Is the text a whole number of any size?"""
    return strip(value).rlike(_INT_SHAPE)
