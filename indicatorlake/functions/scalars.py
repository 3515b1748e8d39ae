"""Column expressions shared by the views.  All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms of a decimal number and of a coded integer.
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
DOT_ZERO_PATTERN = r"^\s*(-?\d+)\.0+\s*$"
M49_WIDTH = 3
# Date layouts publishers use besides ISO ones, each with or without a time of day.
# The month comes first when in doubt: 13/02/2024 fits the day-first layout only.
DATE_LAYOUTS = ["yyyy/M/d", "yyyy.M.d", "yyyy-M-d", "M/d/yyyy", "d/M/yyyy", "M/d/yy", "d/M/yy", "d.M.yyyy", "M-d-yyyy", "d-M-yyyy", "yyyyMMdd",
                "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "d-MMM-yyyy", "d-MMM-yy", "MMMM yyyy", "MMM yyyy"]
TIME_OF_DAY = "[ H:mm[:ss]]"


def strip_quote(text: Column) -> Column:
    """Drop the apostrophe spreadsheets put before a code."""
    return F.regexp_replace(text, "^'", "")


def pad_m49(code: Column) -> Column:
    """Zero-fill short area codes; longer ones stay whole (a bare lpad would cut them)."""
    return F.when(F.length(code) < M49_WIDTH, F.lpad(code, M49_WIDTH, "0")).otherwise(code)


def m49_key(raw: Column) -> Column:
    return pad_m49(strip_quote(raw.cast("string")))


def strip_dot_zero(text: Column) -> Column:
    """``2005.0`` becomes ``2005``; ``12.5`` and words stay as they are."""
    return F.regexp_replace(text, DOT_ZERO_PATTERN, "$1")


def safe_int(text: Column) -> Column:
    return text.try_cast("bigint")


def safe_double(text: Column) -> Column:
    """A double, or NULL for text that is no plain decimal number.

    The pattern keeps out forms only Java reads as numbers (``1d``, ``0x1p3``).
    """
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def na_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit("NA"))


def extract(text: Column, pattern: str) -> Column:
    """First group of the first match, NULL when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def strict_timestamp(text: Column) -> Column:
    """Cast that fails the query on bad text whatever the session's ANSI setting is."""
    parsed = text.try_cast("timestamp")
    bad = text.isNotNull() & parsed.isNull()
    message = F.concat(F.lit("not a timestamp: "), text)
    return F.when(bad, F.raise_error(message).cast("timestamp")).otherwise(parsed)


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_blank(text: Column) -> Column:
    """True for NULL and for text made of white space only."""
    return ~F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))


def publish_date(published: Column) -> Column:
    """When a source says it was published; NULL where there is no date or none of a known layout."""
    text = strip(published)
    iso = F.when(~text.rlike(r"^\d{8}$"), text.try_cast("timestamp"))
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(layout + TIME_OF_DAY)) for layout in DATE_LAYOUTS])


def source_version(published: Column, fallback: str) -> Column:
    """Publish date as yyyyMMdd; the run's own stamp where there is no usable date."""
    return F.coalesce(F.date_format(publish_date(published), "yyyyMMdd"), F.lit(fallback))


def text_out(column: Column) -> Column:
    """Cell text for a sheet: NULL becomes an empty string."""
    return F.coalesce(column.cast("string"), F.lit(""))
