"""De-duplicated lookups and the left joins that attach them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reshape import quoted


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Keep the row with the smallest ``order`` for each key and drop ``order``.

    An aggregate instead of a window: every task reduces its copies of a key
    to one row before the shuffle, so a key with very many copies is no hot spot.
    """
    rest = [c for c in df.columns if c not in (*keys, order)]
    grouped = df.groupBy([F.col(quoted(k)) for k in keys])
    if not rest:
        return grouped.agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    kept = F.min_by(F.struct([F.col(quoted(c)) for c in rest]), F.col(order)).alias("_kept")
    first = grouped.agg(kept)
    return first.select(
        [F.col(quoted(k)) for k in keys] + [F.col("_kept")[c].alias(c) for c in rest]
    ).select([F.col(quoted(c)) for c in df.columns if c != order])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    counts = df.groupBy([F.col(quoted(k)) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where("n_rows > 1")


def lookup_join(main: DataFrame, lookup: DataFrame, on: dict[str, str]) -> DataFrame:
    """Left join a lookup that is unique on its keys: no row is added or lost.

    ``on`` maps main columns to lookup columns.  Lookup keys and lookup columns
    the main side already has are dropped.  No size hint: a small lookup is
    broadcast by Spark's own size check, a large one is shuffled and hot keys of
    the main side are split by the adaptive skew join.
    """
    new = [c for c in lookup.columns if c not in main.columns and c not in on.values()]
    right = lookup.select(
        [F.col(quoted(r)).alias(f"_key{i}") for i, r in enumerate(on.values())]
        + [F.col(quoted(c)) for c in new]
    )
    condition = [F.col(quoted(left)) == F.col(f"_key{i}") for i, left in enumerate(on)]
    return main.join(right, condition, "left").drop(*[f"_key{i}" for i in range(len(on))])
