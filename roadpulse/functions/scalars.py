"""Scalar expressions on columns; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# Texts that mean "missing" in input files, and identifiers that mean "none".
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
NO_GID = ["", "nan", "None", "-1"]


def null_token(text: Column) -> Column:
    return F.when(~text.isin(*NULL_TOKENS), text)


def safe_double(text: Column) -> Column:
    """Number or null: no error, no NaN, and no type suffixes such as '1d'."""
    value = F.when(~text.rlike(r"[0-9.]\s*[dDfF]\s*$"), text).try_cast("double")
    return F.when(~F.isnan(value), value)


#: Tried where a time isn't in ISO form.
TIME_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "M/d/yyyy")


def safe_timestamp(text: Column, *formats: str) -> Column:
    """Wall-clock time or null; an offset at the end is dropped. ``formats`` (TIME_FORMATS if none are given) are tried where the text isn't ISO."""
    local = F.regexp_replace(F.trim(text), r"(Z|[+-]\d{2}:?\d{2})$", "")
    other = [F.try_to_timestamp(F.trim(text), F.lit(f)).cast("timestamp_ntz") for f in formats or TIME_FORMATS]
    return F.coalesce(F.when(local.rlike(r"\d{4}-"), local).try_cast("timestamp_ntz"), *other)


def micros(time: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), time)


def elapsed_micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def time_bin(time: Column, minutes: int) -> Column:
    return F.timestamp_add("MICROSECOND", -F.pmod(micros(time), F.lit(minutes * 60_000_000)), time)


def normalize_gid(gid: Column) -> Column:
    text = F.regexp_replace(F.trim(gid.cast("string")), r"\.0$", "")
    return F.when(~text.isin(*NO_GID), text)


def heading_difference(a: Column, b: Column) -> Column:
    """Angle between two headings, 0 to 180 degrees."""
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def link_family(key: Column) -> Column:
    return F.substring_index(key, "_", 2)


def maps_url(lat: Column, lon: Column) -> Column:
    url = F.concat(F.lit("https://www.google.com/maps/search/?api=1&query="), lat.cast("string"), F.lit(","), lon.cast("string"))
    return F.coalesce(url, F.lit(""))


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is positive, else null."""
    return F.when(b > 0, a / b)


def exact(value: Column) -> Column:
    """As a decimal, so that sums don't depend on the order of rows; null for infinities and numbers from a milliard on, whose sums could overflow."""
    return F.when(F.abs(value) < 1e9, value).try_cast("decimal(19,10)")


def inexact(value: Column) -> Column:
    """The numbers that ``exact`` can't hold; null for all others."""
    return F.when(exact(value).isNull(), value)


def total(sum_exact: Column, sum_inexact: Column) -> Column:
    return sum_exact.cast("double") + F.coalesce(sum_inexact, F.lit(0.0))


def clip_percent(value: Column) -> Column:
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(100.0))


def clock(time: Column) -> Column:
    return F.date_format(time, "HH:mm")
