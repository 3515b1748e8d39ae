"""What lets tables grow: cells dealt to tasks, ranges found by compiled code."""

from __future__ import annotations

from pyspark.sql import functions as F

from indicatorlake.operators.grid import reference_grid
from indicatorlake.operators.ordering import stored_and_ordered


def test_grid_is_made_in_several_tasks_of_uids_without_repeats(spark):
    areas = spark.createDataFrame([("001", "one"), ("002", "two")], "m49_code string, area_name string")
    uids = spark.range(1000).selectExpr("concat('u', id) AS afs_uid").distinct()
    cells = reference_grid(areas, uids, 2000, 2003).withColumn("task", F.spark_partition_id())
    made = cells.groupBy("task").count().collect()
    assert sum(r["count"] for r in made) == 8000 and len(made) > 1


def test_ranges_are_found_without_a_function_over_an_array(spark):
    rows = spark.range(5000).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE id % 13 END AS k", "id")
    found = stored_and_ordered(rows, "k")
    assert "lambdafunction" not in found._jdf.queryExecution().executedPlan().toString()
    got = [r.k for r in found.collect()]
    assert got == sorted(got, key=lambda k: (k is not None, k or 0)) and len(got) == 5000
    assert found.columns == ["k", "id"]
