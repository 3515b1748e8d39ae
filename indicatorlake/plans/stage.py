"""Stage tables: the rows of each source's indicators, kept by indicator uid."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import RUNNABLE_STATUSES, runnable, source_codes, valid_rows, with_reasons
from ..operators.changes import sums_within
from ..operators.selection import Indicator, indicators, select_indicators, selected
from ..session import compiled_in_parts
from ..sources.config import promote
from ..sources.tables import Lake
from . import runlog
from .harmonise import assert_observation

CONFIG = "cfg_stage_tbl"
LOG = "log_stage_tbl"
MAX_CONCURRENCY = 10
#: When a version was published and stored, the same for all its rows.
STAMPS = ("afs_source_updated_at", "afs_source_ingested_at")
FILE_ORDER = ("afs_year", "afs_m49_code")


def view_name(code: str) -> str:
    return f"src_{code}_vw"


def table_name(code: str) -> str:
    return f"stg_{code}_tbl"


def plan_groups(config: DataFrame, views: dict[str, DataFrame]) -> list[dict]:
    """One group per source: its stage frame and the uids it covers.

    ``config`` holds checked rows.  Building a frame analyses its predicates and
    queries, so a wrong one shows here, in ``error``, before anything is written.
    """
    groups = []
    for code, wanted in indicators(config).items():
        group = {"code": code, "stg_view": view_name(code), "stg_tbl": table_name(code),
                 "afs_uid_list": sorted(i.uid for i in wanted), "frame": None, "error": None}
        try:
            group["frame"] = select_indicators(assert_observation(views[code], view_name(code)), wanted)
        except Exception as error:  # reported per group
            group["error"] = runlog.error_text(error)
        groups.append(group)
    return groups


def _known(lake: Lake, views: dict[str, DataFrame]) -> DataFrame:
    return lake.spark.createDataFrame(pa.table({"afs_source_code": pa.array(list(views), pa.string())}))


def checked_config(lake: Lake, views: dict[str, DataFrame]) -> DataFrame:
    """Config rows that passed every check."""
    return valid_rows(lake.read(CONFIG), _known(lake, views))


def left_out(lake: Lake, views: dict[str, DataFrame], statuses: Iterable[str], codes: list[str] | None) -> list[dict]:
    """Log fields of what a run does not build: config rows with their reasons, and asked sources without a config row.

    Rows of a usable status count by the asked statuses; those whose status itself
    is wrong always do.  Control data: as many rows as the config has faults.
    """
    faulty = with_reasons(lake.read(CONFIG), _known(lake, views)).where(F.size("reasons") > 0)
    chosen = faulty.where(F.col("status").isin(*statuses) | F.array_contains("reasons", "bad status"))
    if codes is not None:
        chosen = chosen.where(F.col("afs_source_code").isin(*codes))
    rows = chosen.select("afs_uid", "afs_source_code", F.array_join("reasons", ", ").alias("why")).collect()
    out = [{"stg_view": view_name(r.afs_source_code) if r.afs_source_code else None, "stg_tbl": table_name(r.afs_source_code) if r.afs_source_code else None,
            "afs_uid_list": [r.afs_uid], "error_message": r.why} for r in sorted(rows, key=str)]
    if codes is not None:
        known = {r[0] for r in source_codes(lake.read(CONFIG)).collect()}
        out += [{"stg_view": view_name(c), "stg_tbl": table_name(c), "afs_uid_list": [], "error_message": "no config row"} for c in codes if c not in known]
    return out


def _run(lake: Lake, groups: list[dict], skipped: list[dict], run_type: str, rebuild: bool, max_concurrency: int, run_id: str) -> DataFrame:
    """Write the groups (several Spark jobs at a time), log each and what was left out, promote what succeeded."""
    noted = [{"run_id": run_id, "run_type": run_type, "job_status": "SKIPPED", "created_at": runlog.now(), **s} for s in skipped]

    def write(group: dict) -> dict:
        row = {"run_id": run_id, "run_type": run_type, "stg_view": group["stg_view"],
               "stg_tbl": group["stg_tbl"], "afs_uid_list": group["afs_uid_list"], "job_status": "FAILED",
               "error_message": group["error"], "created_at": runlog.now()}
        if group["error"]:
            return row
        try:
            if rebuild or not lake.exists(group["stg_tbl"]):
                n = lake.write(group["stg_tbl"], group["frame"], "afs_uid", replace=rebuild, sort_by=FILE_ORDER)
            else:
                n = lake.replace_keys(group["stg_tbl"], group["frame"], "afs_uid", group["afs_uid_list"], sort_by=FILE_ORDER)
            return {**row, "job_status": "SUCCESS", "rows_affected": n}
        except Exception as error:  # one bad group must not stop the others
            return {**row, "error_message": runlog.error_text(error)}

    with ThreadPoolExecutor(max_workers=max(1, max_concurrency)) as pool:
        results = list(pool.map(write, groups))
    runlog.write_log(lake, LOG, runlog.STAGE_LOG, results + noted)
    uids = [u for r in results if r["job_status"] == "SUCCESS" for u in r["afs_uid_list"]]
    if uids:
        lake.write(CONFIG, promote(lake.read(CONFIG), uids))
        lake.drop_old_versions(CONFIG)
    return runlog.log_frame(lake.spark, runlog.STAGE_LOG, results + noted)


def update(
    lake: Lake, views: dict[str, DataFrame], max_concurrency: int = MAX_CONCURRENCY, run_id: str | None = None
) -> DataFrame:
    """Write the rows of all DRAFT indicators, replacing what they had; returns the log rows, SKIPPED ones among them."""
    groups = plan_groups(runnable(checked_config(lake, views), ["DRAFT"]), views)
    return _run(lake, groups, left_out(lake, views, ["DRAFT"], None), "UPDATE", False, max_concurrency, run_id or runlog.new_run_id())


def reconstruct(
    lake: Lake,
    views: dict[str, DataFrame],
    codes: Iterable[str] | None = None,
    max_concurrency: int = MAX_CONCURRENCY,
    run_id: str | None = None,
) -> DataFrame:
    """Rebuild whole stage tables from all runnable indicators, of the given sources only."""
    chosen = None if codes is None else list(dict.fromkeys(codes))
    groups = plan_groups(runnable(checked_config(lake, views), RUNNABLE_STATUSES, chosen), views)
    skipped = left_out(lake, views, RUNNABLE_STATUSES, chosen)
    return _run(lake, groups, skipped, "RECONSTRUCT", True, max_concurrency, run_id or runlog.new_run_id())


def changed_uids(before: DataFrame, after: DataFrame, wanted: Iterable[Indicator]) -> list[str]:
    """Indicators that select a row which came, went or changed between two versions of a view.

    When a version was published and stored does not count as a change; indicators
    that ask for it are always named.  Every version is read once: the sums of the row
    hashes of an indicator's rows (128 bits, and the count) tell whether it selects the
    same rows of both, as they tell buckets apart in ``row_changes``.
    """
    wanted = list(wanted)
    always = {i.uid for i in wanted if any(c in f"{i.condition} {i.query}" for c in STAMPS)}
    rest = [i for i in wanted if i.uid not in always]
    if not rest:
        return sorted(always)
    columns = [c for c in after.columns if c not in STAMPS]
    with compiled_in_parts(after.sparkSession):
        old, new = [sums_within(df, columns, lambda rows: selected(rows, rest), "afs_uid") for df in (before, after)]
    return sorted(always | {i.uid for i in rest if old.get(i.uid) != new.get(i.uid)})


def refresh(
    lake: Lake, before: dict[str, DataFrame], views: dict[str, DataFrame], max_concurrency: int = MAX_CONCURRENCY, run_id: str | None = None
) -> DataFrame:
    """After new versions of sources: stage the runnable indicators whose rows changed, and leave the others as they are.

    ``before`` has the views of the versions that stage tables were made from; a source
    that is not among them, or has no stage table yet, is staged whole.  A source
    without a changed row is logged as SKIPPED.
    """
    config = runnable(checked_config(lake, views), RUNNABLE_STATUSES)
    names: dict[str, list[str]] = {}
    skipped = left_out(lake, views, RUNNABLE_STATUSES, None)
    for code, wanted in indicators(config).items():
        known = code in before and lake.exists(table_name(code))
        names[code] = changed_uids(before[code], views[code], wanted) if known else [i.uid for i in wanted]
        if not names[code]:
            skipped.append({"stg_view": view_name(code), "stg_tbl": table_name(code), "afs_uid_list": sorted(i.uid for i in wanted),
                            "error_message": "no row changed"})
    chosen = [(code, uid) for code, uids in names.items() for uid in uids]
    asked = config.where(F.concat_ws("\x01", "afs_source_code", "afs_uid").isin([f"{code}\x01{uid}" for code, uid in chosen]))
    return _run(lake, plan_groups(asked, views), skipped, "REFRESH", False, max_concurrency, run_id or runlog.new_run_id())


def unused_tables(lake: Lake, views: dict[str, DataFrame]) -> DataFrame:
    """Stage tables that no checked config row feeds, with their number of rows, by name."""
    used = checked_config(lake, views).select(
        F.concat(F.lit("stg_"), F.col("afs_source_code"), F.lit("_tbl")).alias("table_name")
    )
    names = lake.table_names().where("table_name LIKE 'stg\\_%\\_tbl'").join(used, "table_name", "left_anti")
    found = [r[0] for r in names.orderBy("table_name").collect()]
    rows = [[name, name[len("stg_") : -len("_tbl")], lake.read(name).count()] for name in found]
    return lake.spark.createDataFrame(rows, "stg_tbl string, afs_source_code string, num_rows bigint")
