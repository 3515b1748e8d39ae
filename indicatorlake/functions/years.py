"""The ways a source writes its year, each giving ``afs_year`` as BIGINT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import extract, safe_int

# Where the four digits of the year sit.
LAST_YEAR_PATTERN = r"(\d{4})\s*$"
FIRST_YEAR_PATTERN = r"^(\d{4})"


def plain(year: Column) -> Column:
    return safe_int(year)


def last_four(code: Column) -> Column:
    """Range code ``20002002`` or survey code ``004_2020``."""
    return safe_int(F.right(code, F.lit(4)))


def range_end(text: Column) -> Column:
    """``1990-2000`` counts for 2000."""
    return safe_int(extract(text, LAST_YEAR_PATTERN))


def leading(text: Column) -> Column:
    """``2019Q1`` and ``2019M01`` count for 2019."""
    return safe_int(extract(text, FIRST_YEAR_PATTERN))


def end_or_start(end: Column, start: Column) -> Column:
    return F.coalesce(safe_int(end), safe_int(start))


def census(code: Column) -> Column:
    """Four characters are the year; ``199900`` spans 1999 to 2000 and counts for 2000.

    The last two digits are the end year within its century.  When they are
    below the two digits before them the census crossed into the next century.
    """
    width = F.length(code)
    end = F.substring(code, F.greatest(width - 1, F.lit(1)), F.lit(2))
    begin = F.substring(code, F.greatest(width - 3, F.lit(1)), F.lit(2))
    century = safe_int(F.left(code, F.lit(2)))
    crossed = safe_int(end) < safe_int(begin)
    spanned = F.concat(F.when(crossed, century + 1).otherwise(century).cast("string"), end)
    return F.when(width == 4, safe_int(code)).otherwise(safe_int(spanned))


YEAR_RULES = {
    "plain": plain,
    "last_four": last_four,
    "range_end": range_end,
    "leading": leading,
    "end_or_start": end_or_start,
    "census": census,
}


def afs_year(rule: str, *columns: Column) -> Column:
    return YEAR_RULES[rule](*columns)
