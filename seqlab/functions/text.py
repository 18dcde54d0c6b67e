"""Small text and number expressions used by the sheet and statistics operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def is_blank(value) -> Column:
    """True for NULL and for the empty string; CSV files do not tell the two apart."""
    return F.coalesce(_col(value), F.lit("")) == ""


def zfill(value, width: int) -> Column:
    """Left-pad with zeros; unlike ``lpad`` a longer value is kept whole."""
    text = _col(value).cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def basename(path) -> Column:
    """Text after the last slash."""
    return F.regexp_extract(_col(path), "[^/]*$", 0)


def strip(value) -> Column:
    """Remove all leading and trailing white space, tabs and carriage returns included."""
    return F.regexp_replace(_col(value), r"^\s+|\s+$", "")


def count_chars(value, chars: str) -> Column:
    """How many characters of ``value`` are among the given letters: what is left when runs of others are cut."""
    return F.length(F.regexp_replace(_col(value), f"[^{chars}]+", "")).cast("bigint")


def percent_2dp(part, whole) -> Column:
    """100 * part / whole, rounded half to even at two places in exact integer arithmetic; 0 for an empty whole."""
    part = _col(part).cast("bigint")
    whole = F.nullif(_col(whole).cast("bigint"), F.lit(0).cast("bigint"))
    scaled = part * F.lit(10000)
    rest = scaled % whole
    floor = div(scaled, whole)
    up = (rest * 2 > whole) | ((rest * 2 == whole) & (floor % 2 == 1))
    return F.coalesce((floor + up.cast("bigint")) / F.lit(100.0), F.lit(0.0))


def div(a, b) -> Column:
    """Integer division of two bigint expressions."""
    return F.call_function("div", a, b)
