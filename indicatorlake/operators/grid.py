"""The area x indicator x year grid and the gap-filled table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key and taxonomy columns of the published table.
KEYS = ("afs_m49_code", "afs_uid", "afs_year")
TAXONOMY = [
    "afs_id",
    *[f"afs_{level}_{part}"
      for level in ("outcome", "theme", "subtheme", "indicator", "subindicator")
      for part in ("code", "name")],
]
CELLS_PER_TASK = 2_000_000


def all_pairs(scope: DataFrame, uids: DataFrame, years: int) -> DataFrame:
    """Every area with every uid: a cross join, and meant as one, since the grid is this product.

    Both sides are dimension tables; Spark chooses how they meet by their sizes.
    The pairs come in as many partitions as their cells over the years need, so no
    task makes more than about CELLS_PER_TASK of them.  They are dealt by a hash of
    the uid: dealt by the uid itself, as rows without repeats often come, Spark would
    leave the dealing out and put few small rows into one task.
    """
    tasks = 1 + scope.count() * uids.count() * max(1, years) // CELLS_PER_TASK
    tasks = max(tasks, int(uids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return uids.repartition(tasks, F.xxhash64("afs_uid")).crossJoin(scope)


def _scope(areas: DataFrame) -> DataFrame:
    return areas.select(F.col("m49_code").cast("string").alias("afs_m49_code"), F.col("area_name").cast("string").alias("afs_area_name"))


def _years(start_year: int, end_year: int | None) -> tuple[Column, Column, int]:
    """The last year, the array of all years (NULL when the range is empty), and about how many there are."""
    last = F.year(F.current_date()) if end_year is None else F.lit(end_year)
    years = F.sequence(F.lit(start_year).cast("bigint"), last.cast("bigint"))
    return last, F.when(last >= start_year, years), (end_year or datetime.now(timezone.utc).year) - start_year + 1


def reference_grid(areas: DataFrame, uids: DataFrame, start_year: int, end_year: int | None = None) -> DataFrame:
    """Every area with every uid and every year up to ``end_year`` (default: this year).

    ``areas`` has m49_code and area_name, ``uids`` has afs_uid.
    """
    _, years, count = _years(start_year, end_year)
    cells = all_pairs(_scope(areas), uids.select("afs_uid").distinct(), count)
    return cells.select("afs_m49_code", "afs_area_name", "afs_uid", F.explode(years).alias("afs_year"))


def gap_fill(
    stage: DataFrame, areas: DataFrame, uids: DataFrame, start_year: int, end_year: int | None = None
) -> DataFrame:
    """Grid and stage rows together: all stage rows, and every grid cell that has none.

    A stage row lies on the grid exactly when its area, its uid and its year are
    each in scope, so facts only meet the two small dimension tables and are never
    shuffled, however many of them share a key.  Off-grid rows keep a NULL area
    name.  For the empty cells every (area, uid) pair meets the set of its years
    that have rows, reduced on the map side first, and only the other years are
    exploded: neither the grid nor a key per cell is ever shuffled.
    """
    last, years, count = _years(start_year, end_year)
    live = uids.select("afs_uid").where("afs_uid IS NOT NULL").distinct()
    scope = areas.select(
        F.col("m49_code").cast("string").alias("_m49"), F.col("area_name").cast("string").alias("afs_area_name")
    )
    facts = stage.where(F.col("afs_year") >= start_year)
    rest = [c for c in stage.columns if c not in KEYS]

    marked = facts.join(live.withColumn("_live", F.lit(True)), "afs_uid", "left")
    on_grid = (
        (F.col("afs_m49_code") == F.col("_m49"))
        & F.col("_live")
        & (F.col("afs_year") <= last)
    )
    placed = marked.join(scope, on_grid, "left").select(*KEYS, "afs_area_name", *rest)

    held = facts.where(F.col("afs_m49_code").isNotNull() & F.col("afs_uid").isNotNull()).groupBy("afs_m49_code", "afs_uid").agg(
        F.collect_set(F.col("afs_year").cast("bigint")).alias("_held"))
    pairs = all_pairs(_scope(areas), uids.select("afs_uid").distinct(), count).join(held, ["afs_m49_code", "afs_uid"], "left")
    open_years = F.when(F.col("_held").isNull(), years).otherwise(F.array_except(years, F.col("_held")))
    nulls = [F.lit(None).cast(stage.schema[c].dataType).alias(c) for c in rest]
    empty = pairs.select("afs_m49_code", "afs_uid", F.explode(open_years).alias("afs_year"), "afs_area_name")
    year = F.col("afs_year").cast(stage.schema["afs_year"].dataType).alias("afs_year")
    return placed.unionByName(empty.select("afs_m49_code", "afs_uid", year, "afs_area_name", *nulls))


def taxonomy(config: DataFrame, statuses: tuple[str, ...]) -> DataFrame:
    """Distinct taxonomy rows of the published indicators."""
    return config.where(F.col("status").isin(*statuses)).select("afs_uid", *TAXONOMY).distinct()


def with_taxonomy(rows: DataFrame, config: DataFrame, statuses: tuple[str, ...]) -> DataFrame:
    """Attach the taxonomy by uid; a uid with two distinct taxonomy rows fans out."""
    return rows.join(taxonomy(config, statuses), "afs_uid", "left").select(*rows.columns, *TAXONOMY)
