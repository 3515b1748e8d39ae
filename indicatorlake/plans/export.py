"""The two published tables: the raw union and the gap-filled grid."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.grid import KEYS, gap_fill, reference_grid, with_taxonomy
from ..operators.ordering import stored_and_ordered
from ..operators.quality import PUBLISHED_STATUSES, source_codes
from ..session import discard
from ..sources.tables import Lake, export_files, remove_others
from . import runlog
from .harmonise import assert_observation
from .stage import CONFIG, table_name, view_name

START_YEAR = 2010
# Names of the published tables and of the steps in their log.
SOURCE_TABLE = "exp_src_long_tbl"
STAGE_TABLE = "exp_stg_long_tbl"
LOG = "log_export_tbl"
GRID_TABLE = "exp_ref_area_indicator_year"
CHECK_STEP = "CHECK_INPUTS"


def union_from(frames: dict[str, DataFrame], start_year: int) -> DataFrame:
    """Union by name of frames of the canonical columns, from ``start_year`` on."""
    if not frames:
        raise ValueError("nothing to union")
    checked = [assert_observation(df, name) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, checked).where(F.col("afs_year") >= start_year)


RAW_ORDER = ("afs_m49_code", "afs_source_code", "afs_year")
FILLED_ORDER = ("afs_m49_code", "afs_id", "afs_year")


def raw_export(views: dict[str, DataFrame], start_year: int = START_YEAR, file_bytes: int | None = None) -> DataFrame:
    """All harmonised views as one ordered table, in files of about ``file_bytes`` if that is given."""
    return stored_and_ordered(union_from(views, start_year), *RAW_ORDER, range_bytes=file_bytes)


def published_uids(config: DataFrame) -> DataFrame:
    return config.where(F.col("status").isin(*PUBLISHED_STATUSES)).select("afs_uid").distinct()


def gap_filled_export(
    stage: DataFrame, areas: DataFrame, config: DataFrame, start_year: int = START_YEAR, end_year: int | None = None,
    file_bytes: int | None = None,
) -> DataFrame:
    """Grid, stage rows and indicator taxonomy as one ordered table of 30 columns, in files of about ``file_bytes`` if that is given."""
    filled = gap_fill(stage, areas, published_uids(config), start_year, end_year)
    full = with_taxonomy(filled, config, PUBLISHED_STATUSES)
    return stored_and_ordered(full, *FILLED_ORDER, range_bytes=file_bytes)


def existing_sources(config: DataFrame, existing: Sequence[str]) -> tuple[list[str], list[str]]:
    """Configured source codes with and without an existing view or table; an error if none has one."""
    wanted = sorted(r[0] for r in source_codes(config).collect())
    found = [c for c in wanted if c in existing]
    if not found:
        raise ValueError("none of the configured sources exists")
    return found, [c for c in wanted if c not in existing]


def _logged(lake: Lake, steps: list[tuple[str, str, Callable[[], int]]], inputs: list[str], missing: list[str], run_id: str) -> DataFrame:
    """Run the steps in turn, log each and the inputs that were not there; stops at the first step that fails."""
    rows = [{"run_id": run_id, "step": CHECK_STEP, "object_name": name, "job_status": "SKIPPED", "error_message": "configured, but not there",
             "source_stg_tbls": inputs, "created_at": runlog.now()} for name in missing]
    for step, target, work in steps:
        row = {"run_id": run_id, "step": step, "object_name": target, "job_status": "SUCCESS",
               "source_stg_tbls": inputs, "created_at": runlog.now()}
        try:
            row["rows_affected"] = work()
        except Exception as error:  # logged, and the run ends here
            row.update(job_status="FAILED", error_message=runlog.error_text(error))
        rows.append(row)
        if row["job_status"] == "FAILED":
            break
    runlog.write_log(lake, LOG, runlog.EXPORT_LOG, rows)
    return runlog.log_frame(lake.spark, runlog.EXPORT_LOG, rows)


def _published(lake: Lake, table: str, make: Callable[[], DataFrame], folder: str, **options) -> list[tuple[str, str, Callable[[], int]]]:
    """Steps that write the ordered rows once, let the table stand for these files, and clear the files of earlier runs.

    The files of a run lie in a folder of their own below ``folder``, so the table
    changes over in one step; files in order of their names are in order.
    """
    kind = "SRC" if table == SOURCE_TABLE else "STG"
    place = f"{folder}/{uuid.uuid4().hex}"
    written: dict[str, int] = {}

    def build() -> int:
        rows = make()
        written["n"] = export_files(rows, place, **options)
        discard(rows)
        if options.get("fmt", "parquet") == "parquet":
            lake.publish(table, place)
        else:
            lake.write(table, lake.spark.read.format(options["fmt"]).load(place))
        return written["n"]

    def clear() -> int:
        remove_others(lake.spark, folder, place)
        return written["n"]

    return [(f"BUILD_{kind}_TABLE", table, build), (f"EXPORT_{kind}_FILES", folder, clear)]


def run_raw_export(
    lake: Lake, views: dict[str, DataFrame], folder: str, start_year: int = START_YEAR,
    run_id: str | None = None, file_bytes: int | None = None, **options,
) -> DataFrame:
    found, missing = existing_sources(lake.read(CONFIG), list(views))
    steps = _published(lake, SOURCE_TABLE, lambda: raw_export({c: views[c] for c in found}, start_year, file_bytes),
                       f"{folder.rstrip('/')}/{SOURCE_TABLE}", **options)
    return _logged(lake, steps, found, [view_name(c) for c in missing], run_id or runlog.new_run_id())


def build_grid(lake: Lake, areas: DataFrame, start_year: int = START_YEAR, end_year: int | None = None) -> int:
    """Store the area x indicator x year grid, ordered, as a table of its own; returns its rows."""
    grid = reference_grid(areas, published_uids(lake.read(CONFIG)), start_year, end_year)
    ordered = stored_and_ordered(grid, *KEYS)
    n = lake.write(GRID_TABLE, ordered)
    discard(ordered)
    return n


def run_gap_filled_export(
    lake: Lake, areas: DataFrame, folder: str, start_year: int = START_YEAR, end_year: int | None = None,
    run_id: str | None = None, file_bytes: int | None = None, grid_table: bool = True, **options,
) -> DataFrame:
    """Grid table, published table and files.  The published rows need no grid table; it is there to be looked at, unless ``grid_table`` is off."""
    config = lake.read(CONFIG)
    codes = [r[0] for r in source_codes(config).collect()]
    found, missing = existing_sources(config, [c for c in codes if lake.exists(table_name(c))])

    def filled() -> DataFrame:
        stage = union_from({c: stage_rows(lake, c) for c in found}, start_year)
        return gap_filled_export(stage, areas, config, start_year, end_year, file_bytes)

    grid = [("BUILD_REF_TABLE", GRID_TABLE, lambda: build_grid(lake, areas, start_year, end_year))] if grid_table else []
    steps = [*grid, *_published(lake, STAGE_TABLE, filled, f"{folder.rstrip('/')}/{STAGE_TABLE}", **options)]
    return _logged(lake, steps, found, [table_name(c) for c in missing], run_id or runlog.new_run_id())


def stage_rows(lake: Lake, code: str) -> DataFrame:
    """A stage table with afs_uid in front (the catalog keeps partition columns last)."""
    table = lake.read(table_name(code))
    return table.select("afs_uid", *[c for c in table.columns if c != "afs_uid"])
