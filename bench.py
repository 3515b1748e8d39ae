"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores.  Each query runs once
to warm up and then BENCH_RUNS times; the best run counts.  ``compared`` times the
plain formulation of the same rows next to the one the library uses.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatorlake.operators.grid import KEYS, gap_fill, reference_grid
from indicatorlake.operators.selection import batches, fan_out, selected
from indicatorlake.plans.export import published_uids, raw_export
from indicatorlake.plans.harmonise import harmonise
from indicatorlake.session import build_session, scratch_folder
from indicatorlake.sources.tables import Lake
from workload import QUERIES
from workload.export_cases import _CONFIG, _stage_frame
from workload.harmonise_cases import view
from workload.stage_cases import CODE, indicators, many_indicators
from workload.standins import END_YEAR, START_YEAR, areas, raw_source, run_sql

HEADLINE = [
    "view_faostat_qcl", "view_unstats_sdg", "view_agincentives", "unpivot_measures", "lookup_2key", "lookup_3key",
    "name_to_code", "config_checks", "table_diff", "stage_select", "stage_pre_process", "replace_by_key",
    "raw_export", "reference_grid", "gap_filled_export", "orphan_stage_rows", "recipe_wide_lookups", "recipe_many_files",
]

# Timed beside the total, which stays comparable between versions.
MORE = ["stage_many_indicators", "csv_stray_quotes", "csv_many_headers", "changed_rows", "gap_filled_refreshed", "name_codes_by_words"]


def seconds(make: Callable[[], DataFrame], runs: int) -> float:
    best = float("inf")
    for run in range(runs + 1):
        started = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        if run:
            best = min(best, time.perf_counter() - started)
    return round(best, 3)


def stored(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def per_second(make: Callable[[], DataFrame], rows: int, runs: int) -> dict[str, float]:
    took = seconds(make, runs)
    return {"sec": took, "rows": rows, "rows_per_sec": round(rows / took)}


def library_alone(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, dict[str, float]]:
    """Operators over inputs that are stored before the clock starts."""
    folder = scratch_folder(spark, "bench")
    scope = stored(areas(spark, sf_dir), f"{folder}/areas")
    raw = {code: stored(raw_source(spark, sf_dir, code).repartition(16), f"{folder}/raw_{code}") for code in ("faostat_qcl", "unstats_sdg", "wb_wdi")}
    rows = {code: df.count() for code, df in raw.items()}
    out = {f"harmonise_{code}": per_second(lambda code=code: harmonise(raw[code], scope, code), rows[code], runs) for code in raw}
    views = {code: stored(harmonise(raw[code], scope, code), f"{folder}/view_{code}") for code in ("faostat_qcl", "wb_wdi")}
    out["raw_export"] = per_second(lambda: raw_export(views, START_YEAR), sum(rows[c] for c in views), runs)

    lake = Lake(spark, f"bench_{uuid.uuid4().hex}", f"{folder}/lake")
    keyed = stored(views["faostat_qcl"].withColumn("afs_uid", F.concat(F.lit("u"), F.pmod(F.xxhash64("area_name", "afs_year"), F.lit(50)))), f"{folder}/keyed")
    lake.write("stg_bench_tbl", keyed, "afs_uid", sort_by=("afs_year",))
    changed = [f"u{k}" for k in range(10)]
    times = []
    for _ in range(runs + 1):
        started = time.perf_counter()
        n = lake.replace_keys("stg_bench_tbl", keyed, "afs_uid", changed, sort_by=("afs_year",))
        times.append(time.perf_counter() - started)
    out["replace_by_key_write"] = {"sec": round(min(times[1:]), 3), "rows": n, "rows_per_sec": round(n / min(times[1:]))}
    return out


def compared(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    """The library's plan next to the plain one for the same rows."""
    folder = scratch_folder(spark, "bench")
    stored_view = stored(view(spark, sf_dir, CODE).repartition(16), f"{folder}/view")
    stage = stored(_stage_frame(spark, sf_dir).repartition(16), f"{folder}/stage")
    # a third of all rows on one NULL key, as where a source has rows of areas beyond the reference
    hot = stage.withColumn("copies", F.explode(F.sequence(F.lit(1), F.lit(12)))).drop("copies")
    hot = stored(hot.withColumn("afs_m49_code", F.when(F.xxhash64("value", F.rand(1)) % 3 != 0, F.col("afs_m49_code"))).repartition(16), f"{folder}/hot")
    scope = stored(areas(spark, sf_dir), f"{folder}/areas")
    uids = stored(published_uids(run_sql(spark, sf_dir, _CONFIG, "customer")), f"{folder}/uids")

    def filters() -> DataFrame:
        return reduce(DataFrame.unionByName, [
            stored_view.where(i.condition).select(F.lit(i.uid).alias("afs_uid"), "*") for i in indicators()])

    def full_outer(rows: DataFrame) -> DataFrame:
        grid = reference_grid(scope, uids, START_YEAR, END_YEAR)
        return grid.join(rows.where(F.col("afs_year") >= START_YEAR), list(KEYS), "full_outer")

    return {
        "select_1000_by_index": seconds(lambda: selected(stored_view, many_indicators()), runs),
        "select_1000_by_predicates": seconds(lambda: reduce(DataFrame.unionByName, [fan_out(stored_view, b) for b in batches(many_indicators())]), runs),
        "select_one_scan": seconds(lambda: fan_out(stored_view, indicators()), runs),
        "select_union_of_filters": seconds(filters, runs),
        "gap_fill_without_fact_shuffle": seconds(lambda: gap_fill(stage, scope, uids, START_YEAR, END_YEAR), runs),
        "gap_fill_full_outer": seconds(lambda: full_outer(stage), runs),
        "gap_fill_hot_null_without_fact_shuffle": seconds(lambda: gap_fill(hot, scope, uids, START_YEAR, END_YEAR), runs),
        "gap_fill_hot_null_full_outer": seconds(lambda: full_outer(hot), runs),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: seconds(lambda: QUERIES[name](spark, sf_dir), runs) for name in HEADLINE}
    more = {name: seconds(lambda: QUERIES[name](spark, sf_dir), runs) for name in MORE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "more": more, "stored_inputs": library_alone(spark, sf_dir, runs), "compared": compared(spark, sf_dir, runs), "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
