"""Harmonised views, registered source by source."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..sources.tables import Lake, register_view
from . import runlog
from .harmonise import harmonise
from .ingest import source_view_name
from .specs import SPECS
from .stage import view_name

# Fixed value: what a source code may look like.
CODE = re.compile(r"[a-z0-9_]+")


def _problem(areas: DataFrame, code: str, lake: Lake | None) -> str:
    if not CODE.fullmatch(code or ""):
        return f"not a source code: {code!r}"
    table = source_view_name(code)
    if not (lake.exists(table) if lake else areas.sparkSession.catalog.tableExists(table)):
        return f"no table {table}"
    return "" if code in SPECS else f"no view definition for {code}"


def register_views(
    areas: DataFrame, codes: Iterable[str] | None = None, replace: bool = True, lake: Lake | None = None
) -> tuple[dict[str, DataFrame], list[dict]]:
    """Create or replace the view of each source whose table is there.

    Source tables are the lake's, which outlive the session, so a new session has
    all views again after this call; without a lake they are the session's own.
    Returns the views by source code and one row per code: action CREATE or
    REPLACE, status SUCCESS, SKIPPED or FAILED.  Without ``replace`` only new
    views are made; a failing source does not stop the others.
    """
    spark = areas.sparkSession
    views, rows = {}, []
    for code in sorted(SPECS) if codes is None else dict.fromkeys(codes):
        row = {"afs_source_code": code, "target_view": "", "action": "", "status": "SKIPPED",
               "message": _problem(areas, code, lake)}
        rows.append(row)
        if row["message"]:
            continue
        target = view_name(code)
        there = spark.catalog.tableExists(target)
        row.update(target_view=target, action="REPLACE" if there else "CREATE")
        if there and not replace:
            row["message"] = "the view is there and replace is off"
            continue
        try:
            source = lake.read(source_view_name(code)) if lake else spark.table(source_view_name(code))
            views[code] = register_view(harmonise(source, areas, code), target)
            row["status"] = "SUCCESS"
        except Exception as error:  # reported per view
            row.update(status="FAILED", message=runlog.error_text(error))
    return views, rows


def previous_views(areas: DataFrame, codes: Iterable[str], lake: Lake) -> dict[str, DataFrame]:
    """The views of the versions that the present ones took the place of; sources of one version only are left out."""
    found = {code: lake.before(source_view_name(code)) for code in codes}
    return {code: harmonise(source, areas, code) for code, source in found.items() if source is not None}
