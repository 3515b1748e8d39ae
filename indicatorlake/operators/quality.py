"""Checks on configuration rows, tables and table pairs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank
from .reshape import quoted

# Life cycle of an indicator.
IGNORED_STATUSES = ("INACTIVE", "DELETED")
RUNNABLE_STATUSES = ("DRAFT", "REVIEW", "ACTIVE")
PUBLISHED_STATUSES = ("REVIEW", "ACTIVE")


def live_rows(config: DataFrame) -> DataFrame:
    """Config rows to check; a NULL status stays so that it can be reported."""
    return config.where(F.col("status").isNull() | ~F.col("status").isin(*IGNORED_STATUSES))


def with_reasons(config: DataFrame, views: DataFrame) -> DataFrame:
    """Live config rows plus ``reasons``, the list of what is wrong with each.

    ``views`` holds the source codes that have a view (afs_source_code).  Copies
    of a uid are counted before the join, so one uid repeated without end meets
    a single row.
    """
    live = live_rows(config)
    copies = live.groupBy("afs_uid").agg(F.count(F.lit(1)).alias("_copies"))
    known = views.select("afs_source_code").distinct().withColumn("_view", F.lit(True))
    checked = live.join(copies.where("_copies > 1"), "afs_uid", "left").join(known, "afs_source_code", "left")
    no_uid, no_source = is_blank(F.col("afs_uid")), is_blank(F.col("afs_source_code"))
    checks = {
        "bad status": ~F.coalesce(F.col("status").isin(*RUNNABLE_STATUSES), F.lit(False)),
        "blank afs_uid": no_uid,
        "blank afs_source_code": no_source,
        "blank filter_string": is_blank(F.col("filter_string")),
        "duplicate afs_uid": F.col("_copies").isNotNull() & ~no_uid,
        "missing view": F.col("_view").isNull() & ~no_source,
    }
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for reason, bad in checks.items()]))
    return checked.select(*[F.col(quoted(c)) for c in config.columns], reasons.alias("reasons"))


def valid_rows(config: DataFrame, views: DataFrame) -> DataFrame:
    """Config rows that can run."""
    return with_reasons(config, views).where(F.size("reasons") == 0).drop("reasons")


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n_rows"))


def table_issues(df: DataFrame, name: str) -> list[str]:
    """Hard problems of a table: no rows, blank or repeated column names."""
    if df.isEmpty():
        return [f"{name} is empty"]
    issues = []
    blank = [i for i, c in enumerate(df.columns) if not c.strip()]
    if blank:
        issues.append(f"{name} has blank column names at {blank}")
    repeated = sorted(c for c, n in Counter(df.columns).items() if n > 1)
    if repeated:
        issues.append(f"{name} repeats column names {repeated}")
    return issues


def blank_cells(df: DataFrame) -> DataFrame:
    """(column_name, n_blank): how many cells of each column are NULL or white space; one pass over the table."""
    counts = [F.struct(F.lit(c).alias("column_name"), F.count_if(is_blank(F.col(quoted(c)).cast("string"))).alias("n_blank")) for c in df.columns]
    return df.agg(F.array(*counts).alias("all")).select(F.explode("all").alias("c")).select("c.*")


def column_diff(left: DataFrame, right: DataFrame) -> tuple[list[str], list[str]]:
    """Column names only in the left table, and only in the right."""
    return sorted(set(left.columns) - set(right.columns)), sorted(set(right.columns) - set(left.columns))


def missing_from(expected: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Distinct expected names with no counterpart; both sides collapse to names before they travel."""
    return expected.select(key).distinct().join(existing.select(key).distinct(), key, "left_anti")


def present_in(expected: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Distinct expected names that exist."""
    return expected.select(key).distinct().join(existing.select(key).distinct(), key, "left_semi")


def source_codes(config: DataFrame) -> DataFrame:
    """Distinct source codes of all config rows, whatever their status."""
    return config.where(F.col("afs_source_code").isNotNull()).select("afs_source_code").distinct()


def runnable(config: DataFrame, statuses: Iterable[str], codes: Sequence[str] | None = None) -> DataFrame:
    """Slice of checked config rows by status and, if given, by source code."""
    rows = config.where(F.col("status").isin(*statuses))
    return rows if codes is None else rows.where(F.col("afs_source_code").isin(*codes))


def orphan_rows(stage: DataFrame, config: DataFrame) -> DataFrame:
    """Stage rows no runnable indicator feeds, counted per source.

    Counted per (source, uid) first, so only those few counts are joined.
    """
    counts = stage.groupBy("afs_source_code", "afs_uid").agg(F.count(F.lit(1)).alias("n"))
    live = config.where(F.col("status").isin(*RUNNABLE_STATUSES)).select("afs_uid").distinct()
    return (
        counts.join(live, "afs_uid", "left_anti")
        .groupBy("afs_source_code")
        .agg(F.sum("n").alias("n_rows"))
        .orderBy("afs_source_code")
    )
