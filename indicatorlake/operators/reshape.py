"""Wide to long, column renames and unions of differing column sets."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank, strip

YEAR_COLUMN = re.compile(r"\d{4}")


def quoted(name: str) -> str:
    """Back-quoted column name, so dots and spaces in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename all at once, so a chain such as a to b and b to c cannot collide."""
    if not names:
        return df
    return df.select([F.col(quoted(c)).alias(names.get(c, c)) for c in df.columns])


def columns_to_rows(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Unpivot; NULL cells are kept."""
    return df.unpivot([quoted(c) for c in ids], [quoted(c) for c in values], name, value)


def rows_per_measure(df: DataFrame, measures: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per non-NULL measure column."""
    ids = [c for c in df.columns if c not in measures]
    return columns_to_rows(df, ids, measures, name, value).where(F.col(value).isNotNull())


def year_columns(columns: Iterable[str]) -> list[str]:
    """Columns whose trimmed name is a four digit year."""
    return [c for c in columns if YEAR_COLUMN.fullmatch(c.strip())]


def years_to_rows(df: DataFrame, year: str, value: str, keep_blank: bool = False) -> DataFrame:
    """Unpivot the year columns found by name; blank cells drop unless kept."""
    years = year_columns(df.columns)
    if not years:
        raise ValueError(f"no four digit year column among {df.columns}")
    ids = [c for c in df.columns if c not in years]
    rows = columns_to_rows(df, ids, years, year, value).withColumn(year, strip(F.col(year)))
    return rows if keep_blank else rows.where(~is_blank(F.col(value)))


def diagonal_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
