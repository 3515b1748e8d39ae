"""Global order without one task holding all rows of a hot key."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from ..session import scratch_folder, stored_bytes
from .reshape import quoted

TIE, REACHED = "_tie", "_reached"
#: Of every task's rows the first so many are sampled, and of each doubling after them an eighth of that.
SAMPLED_ROWS = 128
#: Tasks that are all sampled; of each doubling after them as many as an eighth of that.
SAMPLED_TASKS = 2048
#: Rows of a range, where the session's shuffle partitions would hold more.
RANGE_ROWS = 500_000


def globally_ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows sorted by ``keys`` across partitions, NULLs first.

    A plain orderBy ranges on the keys alone, so all rows of one key land in one
    task.  Here the range also covers a number of the row: equal keys, and even equal
    rows, spread over neighbouring ranges while the order by ``keys`` still holds
    from partition to partition.  Ranges are found by a pass over the input; give it
    stored rows (``stored_and_ordered``) where computing them is dear.
    """
    ranged = df.withColumn(TIE, F.monotonically_increasing_id()).repartitionByRange(*keys, TIE)
    return ranged.sortWithinPartitions(*keys).drop(TIE)


def _thinned(place: Column, full: int) -> tuple[Column, Column]:
    """Whether the row at a place is sampled, and for how many it stands: all of the first ``full``, then ever fewer."""
    octave = F.floor(F.log2(F.greatest(place, F.lit(full)) / full))
    step = F.when(place < full, F.lit(1).cast("long")).otherwise((8 * F.pow(F.lit(2.0), octave)).cast("long"))
    return place % step == 0, step


def _size(df: DataFrame) -> Column:
    """About how many bytes a row takes: the length of its values as text."""
    parts = [F.coalesce(F.octet_length(F.col(quoted(c)).cast("string")), F.lit(0)) for c in df.columns]
    return reduce(lambda a, b: a + b, parts, F.lit(len(parts))).cast("long")


def _sample(keys: Sequence[str], size: Column) -> Column:
    """A sample of the order keys with their weights: a mergeable aggregate that grows with the logarithm of the rows."""
    row, row_weight = _thinned(F.col(TIE).bitwiseAND(F.lit((1 << 33) - 1)), SAMPLED_ROWS)
    task, task_weight = _thinned(F.shiftright(TIE, 33), SAMPLED_TASKS)
    return F.collect_list(F.when(row & task, F.struct(*keys, TIE, (row_weight * task_weight * size).alias("_weight"))))


def _rank(value) -> tuple:
    """Spark's order for Python's sort: NULL first, NaN last."""
    if value is None:
        return (0, 0)
    return (2, 0) if isinstance(value, float) and math.isnan(value) else (1, value)


def _bounds(sample: list[Row], ranges: int) -> list[Row]:
    """The sampled rows at which ``ranges`` - 1 of the ranges begin, at equal weights."""
    ordered = sorted(sample, key=lambda r: [_rank(v) for v in r[:-1]])
    total, seen, out = sum(r[-1] for r in ordered), 0, []
    for r in ordered:
        if seen * ranges >= total * (len(out) + 1):
            out.append(r)
        seen += r[-1]
    return out


def stored_and_ordered(df: DataFrame, *keys: str, range_bytes: int | None = None) -> DataFrame:
    """As ``globally_ordered``, but the rows are computed once, into the shared folder, and ordered from there.

    While they are stored a small sample of their keys is gathered as a metric of the
    same job; it gives the ranges, so no job samples the rows again.  A row's place is
    part of its key, so a hot key is cut into ranges like others.

    With ``range_bytes`` the ranges hold about equal bytes, as the stored files take
    them, whatever the width of their rows; a range is one task and one file.
    """
    spark = df.sparkSession
    folder, seen = scratch_folder(spark, "unordered"), Observation(f"order-{uuid.uuid4().hex}")
    placed = df.withColumn(TIE, F.monotonically_increasing_id())
    size = _size(df) if range_bytes else F.lit(1).cast("long")
    placed.observe(seen, F.count(F.lit(1)).alias("n"), _sample(keys, size).alias("sample")).write.parquet(folder)
    stored = spark.read.schema(placed.schema).parquet(folder)
    found = seen.get
    if range_bytes:
        ranges = max(1, math.ceil(stored_bytes(spark, folder) / range_bytes))
    else:
        ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(found["n"] / RANGE_ROWS))
    bounds = _bounds(found["sample"] or [], ranges)
    order = [*keys, TIE]
    if bounds:
        kinds = [placed.schema[k].dataType for k in order]
        listed = F.array(*[F.struct(*[F.lit(v).cast(kind).alias(k) for k, v, kind in zip(order, r, kinds)]) for r in bounds])
        # how many bounds a row reaches, by halving steps: a column each, which Spark compiles and a function over an array it does not
        at = F.lit(0)
        for step in (1 << k for k in reversed(range(len(bounds).bit_length()))):
            further = (at + step <= len(bounds)) & (F.get(listed, at + step - 1) <= F.struct(*order))
            stored, at = stored.withColumn(REACHED, F.when(further, at + step).otherwise(at)), F.col(REACHED)
        stored = stored.repartitionById(len(bounds) + 1, at)
    return stored.sortWithinPartitions(*keys).drop(TIE, REACHED)
