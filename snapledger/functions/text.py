"""Small text and time functions shared by models and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(name: Column) -> Column:
    """Names are compared upper-cased and without spaces at the ends."""
    return F.upper(F.trim(name))


def surrogate_key(*parts: Column) -> Column:
    """md5 of the parts joined by a bar; null if any part is."""
    joined = parts[0].cast("string")
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("|"), part.cast("string"))
    return F.md5(joined)


def unescape(text: Column) -> Column:
    """The two HTML entities that names come with, in this order."""
    return F.replace(F.replace(text, F.lit("&#039;"), F.lit("'")), F.lit("&amp;"), F.lit("&"))


def blank_to_null(text: Column, *also: str) -> Column:
    out = F.nullif(text, F.lit(""))
    for value in also:
        out = F.nullif(out, F.lit(value))
    return out


def http_date(text: Column) -> Column:
    """An IMF-fixdate such as ``Sun, 06 Nov 1994 08:49:37 GMT``; null if it isn't one."""
    return F.try_to_timestamp(F.substring(text, 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))


def or_null(array: Column) -> Column:
    """An empty array is null."""
    return F.when(F.size(array) > 0, array)


def trimmed(array: Column) -> Column:
    return or_null(F.transform(array, lambda x: F.trim(x)))


def weekday(day: Column) -> Column:
    """Sunday is 0."""
    return (F.dayofweek(day) - 1).cast("long")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), digits).cast("double")
