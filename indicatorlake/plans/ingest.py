"""Files of a source to its Parquet table, version by version."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_blank, publish_date, source_version
from ..session import written
from ..sources.config import keyed_rows, update_fields
from ..sources.naming import LINEAGE, source_table
from ..sources.recipes import AreaNames, lost_names, names_without_code, passed_over, recipe_for, repeated_lookup_keys
from ..sources.tables import Lake, parquet_exists, version_path
from . import runlog

SOURCE_CONFIG = "cfg_source_tbl"
SOURCE_LOG = "log_source_tbl"
DEFAULT_AGENCY = "default"
LOST_NAMES = "log_lost_names_tbl"


def source_view_name(code: str) -> str:
    return f"src_{code}_exttbl"


def versions(config: DataFrame, stamp: str) -> DataFrame:
    """Config rows that have a key, the version each source would be stored under, and whether its date could not be read."""
    published = F.col("afs_source_updated_at")
    return keyed_rows(config, "afs_source_code").withColumns(
        {"version": source_version(published, stamp), "unread_date": ~is_blank(published) & publish_date(published).isNull()}
    )


def ingest_source(lake: Lake, row: dict, folder: str, names: AreaNames | None, force: bool = False) -> dict:
    """Land one source; skipped when this version is stored and ``force`` is off.

    Its table lives in the lake's catalog and stands for the version's files; a
    skipped source without a table gets one.  A forced run writes beside the stored
    version and the table changes over last, so a failure leaves the old rows.
    Returns the log row.  A failure is caught and reported in it, and so are files
    the recipe passes over and a publish date that could not be read.
    """
    started = runlog.now().strftime("%Y-%m-%d %H:%M:%S")
    code, updated = row["afs_source_code"], row.get("afs_source_updated_at") or ""
    path = version_path(lake.root, row.get("agency") or DEFAULT_AGENCY, code, row["version"])
    table = source_view_name(code)
    entry = {"execution_time": started, "afs_source_code": code, "afs_source_updated_at": updated,
             "afs_source_ingested_at": "", "uri": "", "table_name": "", "message": ""}
    notes = [f"publish date not understood: {updated}"] if row.get("unread_date") else []
    try:
        stored = parquet_exists(lake.spark, path)
        if stored and not force:
            if not lake.exists(table):
                lake.publish(table, path)
            notes.append(f"version is stored: {path}")
            return {**entry, "status": "SKIPPED", "uri": lake.folder(table), "table_name": table, "message": "; ".join(notes)}
        notes += passed_over(lake.spark, code, folder) + repeated_lookup_keys(lake.spark, code, folder)
        lineage = dict(zip(LINEAGE, (code, updated, started)))
        rows = source_table(recipe_for(code)(lake.spark, folder, names), lineage)
        target = path if not stored else path.removesuffix(".parquet") + f"-{uuid.uuid4().hex}.parquet"
        rows.write.mode("errorifexists" if stored else "overwrite").parquet(target)
        lake.publish(table, target)
        lost = lost_names(lake.read(table), code)
        if lost is not None:
            named = lost.select(F.lit(started).alias("execution_time"), F.lit(code).alias("afs_source_code"), "name")
            lake.append(LOST_NAMES, written(named, "lost-names"))  # all of them; the log has the first
            notes += names_without_code(lost)
        return {**entry, "status": "SUCCESS", "afs_source_ingested_at": started, "uri": target, "table_name": table,
                "message": "; ".join(notes)}
    except Exception as error:  # one bad source must not stop the others
        return {**entry, "status": "FAILED", "message": "; ".join([*notes, runlog.error_text(error)])}


def ingest(
    lake: Lake,
    folders: dict[str, str],
    names: AreaNames | None,
    codes: Iterable[str] | None = None,
    force: bool = False,
) -> DataFrame:
    """Land several sources; the log and the config are written source by source.

    ``folders`` maps source codes to where their files were landed.  Unknown
    codes and codes without a folder are reported as FAILED.
    """
    stamp = runlog.now().strftime("%Y%m%d%H%M%S")
    rows = {r["afs_source_code"]: r.asDict() for r in versions(lake.read(SOURCE_CONFIG), stamp).collect()}
    runs = []
    for code in list(rows) if codes is None else list(dict.fromkeys(codes)):
        if code not in rows or code not in folders:
            reason = "the source config has no such code" if code not in rows else "no folder was landed for it"
            run = {"execution_time": runlog.now().strftime("%Y-%m-%d %H:%M:%S"), "afs_source_code": code, "status": "FAILED", "message": reason}
        else:
            run = ingest_source(lake, rows[code], folders[code], names, force)
        runs.append(run)
        runlog.write_log(lake, SOURCE_LOG, runlog.SOURCE_LOG, [run])
        if run["status"] == "SUCCESS":
            updates = runlog.log_frame(lake.spark, runlog.SOURCE_LOG, [run]).select("afs_source_code", "afs_source_ingested_at")
            lake.write(SOURCE_CONFIG, update_fields(lake.read(SOURCE_CONFIG), updates, "afs_source_code"))
            lake.drop_old_versions(SOURCE_CONFIG)
    return runlog.log_frame(lake.spark, runlog.SOURCE_LOG, runs)
