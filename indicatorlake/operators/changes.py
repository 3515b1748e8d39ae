"""What changed between two tables: sums of row hashes tell which buckets to compare, the others stay where they are."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import written
from .reshape import quoted

BUCKETS = 1 << 16
_HALF = 0xFFFFFFFF


def _hash(columns: Sequence[Column], seed: int) -> Column:
    """A hash of the values; a NULL counts, wherever it stands."""
    return F.xxhash64(F.lit(seed), *[part for c in columns for part in (c, c.isNull())])


def _bucket(columns: Sequence[Column]) -> Column:
    return F.pmod(_hash(columns, 0), F.lit(BUCKETS)).cast("int")


def sums_of(columns: Sequence[Column]) -> Column:
    """How many rows there are and the sums of two hashes of them, as an aggregate whatever their order.

    Sums of half hashes, which stay within a long for two thousand million rows.
    """
    return _summed(halves(columns))


def halves(columns: Sequence[Column]) -> list[Column]:
    """The halves of two hashes of the values, which ``sums_of`` sums."""
    return [half for h in (_hash(columns, seed) for seed in (1, 2)) for half in (h.bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned(h, 32))]


def _summed(parts: Sequence[Column]) -> Column:
    return F.struct(F.count(F.lit(1)).alias("rows"), *[F.sum(part).alias(f"s{k}") for k, part in enumerate(parts)])


def sums_within(df: DataFrame, columns: Sequence[str], groups: Callable[[DataFrame], DataFrame], by: str) -> dict[str, Row]:
    """The sums of the rows (of ``columns``) that ``groups`` puts in each group, by the group's name.

    Rows are hashed once, before they are put in groups, and only their hashes go on.
    ``groups`` returns the rows it is given with the column ``by``, maybe several times.
    """
    names = [f"_h{k}" for k in range(4)]
    hashed = df.select("*", *[h.alias(name) for h, name in zip(halves([F.col(quoted(c)) for c in columns]), names)])
    return {r[0]: r[1] for r in groups(hashed).groupBy(by).agg(_summed([F.col(name) for name in names]).alias("s")).collect()}


def bucket_sums(df: DataFrame, columns: Sequence[Column], side: str) -> DataFrame:
    """(_bucket, side): the sums of every bucket's rows."""
    return df.groupBy(_bucket(columns).alias("_bucket")).agg(sums_of(columns).alias(side))


def differing_buckets(left: DataFrame, right: DataFrame, by_left: Sequence[Column], by_right: Sequence[Column]) -> DataFrame:
    """(_bucket) of the buckets whose rows differ, written out; at most BUCKETS rows, none for equal tables."""
    sums = bucket_sums(left, by_left, "_left").join(bucket_sums(right, by_right, "_right"), "_bucket", "full_outer")
    return written(sums.where("NOT (_left <=> _right)").select("_bucket"), "differing")


def key_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys (as text) that only one of two tables holds, with the side that holds them.

    Both sides are first summed up by bucket of keys; where the sums agree (128 bits of
    hash, and the count) the keys do, so equal tables cost one aggregation.  Only keys
    of other buckets are tagged, unioned and reduced, partially before they travel.
    """
    text = F.col(quoted(key)).cast("string").alias("key")
    sides = [df.select(text) for df in (left, right)]
    columns = [F.col("key")]
    differ = differing_buckets(*sides, columns, columns)
    tagged = [df.withColumn("_bucket", _bucket(columns)).join(differ, "_bucket", "left_semi").select("key", F.lit(is_left).alias("is_left"))
              for df, is_left in zip(sides, (True, False))]
    found = tagged[0].unionByName(tagged[1]).groupBy("key").agg(F.bool_or("is_left").alias("in_left"), F.bool_or(~F.col("is_left")).alias("in_right"))
    return found.where("NOT (in_left AND in_right)").select("key", F.when(F.col("in_left"), F.lit("left")).otherwise(F.lit("right")).alias("only_in"))


def row_changes(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows (of ``columns``) that one table holds more often than the other, with n_before and n_after.

    Rows are compared as a multiset.  Only rows of buckets whose sums differ are
    grouped, by their values and not their hashes; NULL equals NULL.
    """
    values = [F.col(quoted(c)) for c in columns]
    differ = differing_buckets(before, after, values, values)
    counted = []
    for df, n in ((before, (1, 0)), (after, (0, 1))):
        rows = df.select(*values, _bucket(values).alias("_bucket")).join(differ, "_bucket", "left_semi")
        counted.append(rows.select(*values, F.lit(n[0]).cast("long").alias("_before"), F.lit(n[1]).cast("long").alias("_after")))
    grouped = counted[0].unionByName(counted[1]).groupBy(*values).agg(F.sum("_before").alias("n_before"), F.sum("_after").alias("n_after"))
    return grouped.where("n_before <> n_after")
