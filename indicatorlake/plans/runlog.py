"""Append-only logs, one row per unit of work."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..sources.tables import Lake

MAX_ERROR_TEXT = 2000


def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


_TEXT, _TEXTS, _COUNT, _TIME = T.StringType(), T.ArrayType(T.StringType()), T.LongType(), T.TimestampType()

# Columns of the four logs.
STAGE_LOG = _schema(
    run_id=_TEXT, run_type=_TEXT, stg_view=_TEXT, stg_tbl=_TEXT, afs_uid_list=_TEXTS, job_status=_TEXT,
    error_message=_TEXT, rows_affected=_COUNT, created_at=_TIME,
)
EXPORT_LOG = _schema(
    run_id=_TEXT, step=_TEXT, object_name=_TEXT, job_status=_TEXT, error_message=_TEXT,
    rows_affected=_COUNT, source_stg_tbls=_TEXTS, created_at=_TIME,
)
SOURCE_LOG = _schema(
    execution_time=_TEXT, afs_source_code=_TEXT, afs_source_updated_at=_TEXT, afs_source_ingested_at=_TEXT,
    uri=_TEXT, table_name=_TEXT, status=_TEXT, message=_TEXT,
)
SYNC_LOG = _schema(
    execution_time=_TEXT, direction=_TEXT, sheet_name=_TEXT, cfg_table=_TEXT, status=_TEXT, detail=_TEXT,
)


def now() -> datetime:
    return datetime.now(timezone.utc)


def new_run_id() -> str:
    return now().strftime("%Y%m%d-%H%M%S")


def error_text(error: BaseException, most: int = MAX_ERROR_TEXT) -> str:
    """An error in at most ``most`` characters; where it is longer, how much is left out."""
    text = str(error)
    return text if len(text) <= most else f"{text[:most]} ({len(text) - most} more characters)"


def write_log(lake: Lake, table: str, schema: T.StructType, rows: list[dict]) -> None:
    """Append log rows; fields a row lacks are NULL."""
    if rows:
        lake.append(table, log_frame(lake.spark, schema, rows))


def log_frame(spark: SparkSession, schema: T.StructType, rows: list[dict]):
    return spark.createDataFrame([[row.get(name) for name in schema.names] for row in rows], schema)
