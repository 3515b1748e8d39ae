"""Configuration tables: reading them, updating fields, promoting statuses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text_out
from ..operators.reshape import quoted
from .csv import read_csv


def config_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """A config sheet dropped as CSV; every cell stays text, so 007 keeps its zeros."""
    return read_csv(spark, path)


def keyed_rows(config: DataFrame, key: str) -> DataFrame:
    """Rows that have a key."""
    return config.where(F.col(key).isNotNull() & (F.col(key) != ""))


def update_fields(config: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Overwrite the fields ``updates`` carries (as text) in the rows it names by ``key``.

    A NULL there leaves the field as it is.  Two rows for one key contradict each
    other, so they fail the query; no config row is ever doubled.
    """
    fields = [c for c in updates.columns if c != key]
    right = updates.select(F.col(key).alias("_key"), F.struct(*[F.col(f).cast("string").alias(f"_{f}") for f in fields]).alias("_new"))
    once = right.groupBy("_key").agg(F.max("_new").alias("_new"), F.count(F.lit(1)).alias("_rows"))
    message = F.concat(F.lit("several updates for "), F.coalesce(F.col("_key").cast("string"), F.lit("NULL")))
    checked = F.when(F.col("_rows") > 1, F.raise_error(message).cast("string")).otherwise(F.col("_key").cast("string"))
    right = once.select(checked.alias("_key"), "_new.*")
    joined = config.join(right, F.col(key).cast("string") == F.col("_key"), "left")
    return joined.select(
        [
            F.coalesce(F.col(f"_{c}"), F.col(quoted(c)).cast("string")).alias(c) if c in fields
            else F.col(quoted(c))
            for c in config.columns
        ]
    )


def promote(config: DataFrame, uids: Sequence[str]) -> DataFrame:
    """DRAFT rows of the given uids become REVIEW; all other rows stay."""
    done = (F.col("status") == "DRAFT") & F.col("afs_uid").isin(*uids)
    return config.withColumn("status", F.when(done, F.lit("REVIEW")).otherwise(F.col("status")))


def sheet_rows(table: DataFrame) -> DataFrame:
    """A table as text cells for a sheet, NULL as an empty string."""
    return table.select([text_out(F.col(quoted(c))).alias(c) for c in table.columns])
