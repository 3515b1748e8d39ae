"""Keeping a config table and the sheet people edit in step."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.changes import key_diff
from ..operators.quality import column_diff, table_issues
from ..sources.config import config_from_csv, sheet_rows
from ..sources.tables import Lake
from . import runlog

LOG = "log_sync_tbl"


def compare(sheet: DataFrame, table: DataFrame, key: str) -> tuple[list[str], tuple[list[str], list[str]], DataFrame | None]:
    """Hard problems, column differences, and keys only one side holds (None without a common key)."""
    issues = table_issues(sheet, "sheet") + table_issues(table, "config table")
    columns = column_diff(sheet, table)
    shared = key in sheet.columns and key in table.columns
    return issues, columns, key_diff(sheet, table, key) if shared and not issues else None


def _logged(lake: Lake, direction: str, sheet: str, table: str, status: str, detail: str) -> None:
    runlog.write_log(lake, LOG, runlog.SYNC_LOG, [{
        "execution_time": runlog.now().strftime("%Y-%m-%d %H:%M:%S"), "direction": direction,
        "sheet_name": sheet, "cfg_table": table, "status": status, "detail": detail}])


def _stop_on_issues(lake: Lake, direction: str, path: str, table: str, sheet: DataFrame, key: str) -> None:
    existing = lake.read(table) if lake.exists(table) else sheet
    issues, _, _ = compare(sheet, existing, key)
    if issues:
        _logged(lake, direction, path, table, "FAILED", "; ".join(issues))
        raise ValueError(f"{direction} of {table}: {issues}")


def push(lake: Lake, path: str, table: str, key: str, force: bool = False) -> int:
    """Sheet (as CSV) to config table, replaced whole with the sheet's columns; returns its rows."""
    sheet = config_from_csv(lake.spark, path)
    if not force:
        _stop_on_issues(lake, "push", path, table, sheet, key)
    try:
        n = lake.write(table, sheet)
    except Exception as error:  # logged, and passed on
        _logged(lake, "push", path, table, "FAILED", runlog.error_text(error))
        raise
    _logged(lake, "push", path, table, "SUCCESS", f"{n} rows")
    return n


def pull(lake: Lake, table: str, path: str) -> DataFrame:
    """Config table to sheet cells, written as CSV."""
    rows = sheet_rows(lake.read(table))
    rows.write.mode("overwrite").options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    _logged(lake, "pull", path, table, "SUCCESS", "")
    return rows
