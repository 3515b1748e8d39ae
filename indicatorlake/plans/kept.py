"""A gap-filled table that is kept up to date: only indicators whose rows, taxonomy or grid changed are built again."""

from __future__ import annotations

from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.changes import sums_of
from ..operators.grid import TAXONOMY, gap_fill, taxonomy, with_taxonomy
from ..operators.quality import PUBLISHED_STATUSES, source_codes
from ..sources.tables import Lake
from . import runlog
from .export import FILLED_ORDER, LOG, START_YEAR, published_uids, stage_rows, union_from
from .stage import CONFIG, table_name

KEPT_TABLE = "exp_stg_kept_tbl"
STATE_TABLE = "exp_stg_state_tbl"
STEP = "REFRESH_STG_TABLE"
_STATE = pa.schema([("afs_uid", pa.string()), ("mark", pa.string()), ("rows", pa.string()), ("taxonomy", pa.string()), ("scope", pa.string())])


def _prints(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """For every uid the number of its rows and sums of their hashes, as text."""
    summed = df.groupBy("afs_uid").agg(sums_of([F.col(c) for c in columns]).alias("s"))
    return {r.afs_uid: ",".join(map(str, r.s)) for r in summed.collect()}


def _scope(areas: DataFrame, start_year: int, end_year: int) -> str:
    summed = areas.agg(sums_of([F.col("m49_code").cast("string"), F.col("area_name").cast("string")]).alias("s")).first().s
    return ",".join(map(str, [start_year, end_year, *summed]))


def refresh_gap_filled(lake: Lake, areas: DataFrame, start_year: int = START_YEAR, end_year: int | None = None, run_id: str | None = None) -> DataFrame:
    """Bring the kept table up to date and return the log row; its uids are those that were built.

    A state table remembers, for every uid, which stored partitions its stage rows lay
    in, a fingerprint of these rows and of its taxonomy, and the grid (areas and years).
    Stage rows are looked at only where the catalog names other partitions than before;
    of these uids, the ones with the same fingerprint stay.  Built uids replace their
    partitions of the table in one step, so the table always equals a whole build; a
    run that dies leaves the old state behind and the next one builds the same uids
    again.  Uids and their fingerprints are control data, as many as the config has.
    """
    config = lake.read(CONFIG)
    found = [c for c in sorted(r[0] for r in source_codes(config).collect()) if lake.exists(table_name(c))]
    end = end_year or datetime.now(timezone.utc).year
    scope = _scope(areas, start_year, end)
    told = _prints(taxonomy(config, PUBLISHED_STATUSES).where("afs_uid IS NOT NULL"), TAXONOMY)
    marks: dict[str, str] = {}
    for code in found:
        for uid, mark in sorted(lake.partitions(table_name(code)).items()):
            marks[uid] = f"{marks.get(uid, '')}{code}:{mark};"
    old = {r.afs_uid: r for r in lake.read(STATE_TABLE).collect()} if lake.exists(STATE_TABLE) and lake.exists(KEPT_TABLE) else {}
    whole = not old or any(r.scope != scope for r in old.values())

    wanted = sorted({*marks, *told})
    moved = [u for u in wanted if u not in old or old[u].mark != marks.get(u, "")]
    rows = union_from({c: stage_rows(lake, c) for c in found}, start_year)
    fresh = _prints(rows.where(F.col("afs_uid").isin(moved)), rows.columns) if moved else {}
    prints = {u: fresh.get(u, "") if u in moved else old[u].rows for u in wanted}
    changed = [u for u in wanted if whole or u not in old or prints[u] != old[u].rows or told.get(u, "") != old[u].taxonomy]
    gone = sorted(set(old) - set(wanted))

    entry = {"run_id": run_id or runlog.new_run_id(), "step": STEP, "object_name": KEPT_TABLE, "job_status": "SKIPPED",
             "source_stg_tbls": [*changed, *gone], "created_at": runlog.now()}
    if changed or gone:
        some = rows if whole else rows.where(F.col("afs_uid").isin(changed))
        live = published_uids(config).where(F.col("afs_uid").isNotNull() if whole else F.col("afs_uid").isin(changed))
        built = with_taxonomy(gap_fill(some, areas, live, start_year, end), config, PUBLISHED_STATUSES)
        if whole:
            n = lake.write(KEPT_TABLE, built, "afs_uid", sort_by=FILLED_ORDER)
        else:
            n = lake.replace_keys(KEPT_TABLE, built, "afs_uid", [*changed, *gone], sort_by=FILLED_ORDER)
        entry |= {"job_status": "SUCCESS", "rows_affected": n}
    if changed or gone or moved:
        lake.write(STATE_TABLE, lake.spark.createDataFrame(pa.Table.from_pylist(
            [{"afs_uid": u, "mark": marks.get(u, ""), "rows": prints[u], "taxonomy": told.get(u, ""), "scope": scope} for u in wanted], _STATE)))
        lake.drop_old_versions(STATE_TABLE)
    runlog.write_log(lake, LOG, runlog.EXPORT_LOG, [entry])
    return runlog.log_frame(lake.spark, runlog.EXPORT_LOG, [entry])


def kept_rows(lake: Lake) -> DataFrame:
    """The kept table in the columns of the published one."""
    table = lake.read(KEPT_TABLE)
    first = ["afs_m49_code", "afs_uid", "afs_year", "afs_area_name"]
    return table.select(*first, *[c for c in table.columns if c not in first])
