"""Casts that keep bad input countable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings the JVM parses as numbers but data files do not mean as such: 12d, 1.5f, 0x1p3.
_JVM_ONLY_NUMBER = r"[xX]|[dD]\s*$|(?<![iI][nN])[fF]\s*$"
_JVM_ONLY_LETTERS = "dDfFxX"
# A date with one separator throughout, and a time of hours and minutes at least if there is one.
_STAMP = r"^(-?\d{4,6})([-/ \\])(\d{1,2})\2(\d{1,2})(?:(?:T| +)(\d{1,2}:\d.*))?$"
# The usual spelling, which needs no rewriting.
_PLAIN_STAMP = r"^\d{4}-\d\d-\d\d[ T](?:[01]\d|2[0-3]):\d\d(?::\d\d)?$"
_MIDNIGHT = r" 24:00(?=$|:00(?:\.0*)?(?![0-9.:]))"


def _parsed(value: Column) -> Column:
    """``value`` as double, null where it is not one. The guard applies to text; numbers pass it.

    Plain numbers hold none of the letters, which is a quick check; only others meet the pattern.
    """
    text = value.cast("string")
    suspect = F.lit(False)
    for letter in _JVM_ONLY_LETTERS:
        suspect = suspect | text.contains(letter)
    return F.when(~(suspect & text.rlike(_JVM_ONLY_NUMBER)), value.try_cast("double"))


def to_double(value: Column, numeric: bool = False) -> Column:
    """Double or null. NaN becomes null, since Spark would sort it above every number.

    ``numeric`` says that the input already is a number, which skips the text guard.
    """
    number = value.cast("double") if numeric else _parsed(value)
    return F.nullif(number, F.lit(float("nan")))


def is_uncastable(value: Column) -> Column:
    """True where a value is present but is not a number."""
    return value.isNotNull() & _parsed(value).isNull()


def to_timestamp(value: Column, mode: str = "coerce", typed: bool = False) -> Column:
    """Zone-less timestamp. ``coerce`` turns bad text into null, ``strict`` fails the job on it.

    One grammar for cleaning, audit and month folders, that of a database's TRY_CAST: a whole date, parted by hyphens, slashes,
    blanks or backslashes, alone or with hours and minutes at least; 24:00 is the next day's midnight; a zone is
    ignored. A year, a month or a bare hour is no timestamp, and neither is a year of less than four digits. ``typed`` says that the
    input already is a date or timestamp.
    """
    if mode not in ("coerce", "strict"):
        raise ValueError(f"mode must be 'coerce' or 'strict', not {mode!r}")
    if typed:
        return value.cast("timestamp_ntz")
    text = value.cast("string")
    spelled = F.regexp_replace(text, _STAMP, "$1-$3-$4 $5")
    moment = F.regexp_replace(spelled, _MIDNIGHT, " 00:00").try_cast("timestamp_ntz")
    moment = F.when(spelled.rlike(_MIDNIGHT), moment + F.expr("INTERVAL 1 DAY")).otherwise(moment)
    moment = F.when(text.rlike(_PLAIN_STAMP), text.try_cast("timestamp_ntz")).when(text.rlike(_STAMP), moment)
    if mode == "coerce":
        return moment
    refused = F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp_ntz")
    return F.when(moment.isNull() & text.isNotNull(), refused).otherwise(moment)


def timestamp_column(df: DataFrame, name: str, mode: str = "coerce") -> Column:
    """``to_timestamp`` of a column, whose type says whether there is text to read."""
    return to_timestamp(F.col(name), mode, typed=df.schema[name].dataType.typeName() != "string")


def is_bad_timestamp(value: Column) -> Column:
    """True where a value is missing or is not a timestamp by the grammar of ``to_timestamp``."""
    return to_timestamp(value).isNull()
