"""Operators against plain restatements of what they mean."""

from __future__ import annotations

import json
from collections import Counter
from functools import reduce

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from indicatorlake.operators import quality as q
from indicatorlake.operators.areas import alias_table, name_codes, region_table
from indicatorlake.operators import grid
from indicatorlake.operators.grid import KEYS, all_pairs, gap_fill, reference_grid
from indicatorlake.operators.changes import BUCKETS, key_diff, row_changes
from indicatorlake.operators.lookup import first_per_key, lookup_join
from indicatorlake.operators.ordering import globally_ordered
from indicatorlake.operators.reshape import rename_columns, years_to_rows
from indicatorlake.operators import changes, ordering, predicates
from indicatorlake.operators.selection import Indicator, batches, fan_out, processed, processed_together, select_indicators, selected
from indicatorlake.plans.harmonise import OBSERVATION, assert_observation, harmonise
from indicatorlake.plans.export import published_uids
from indicatorlake.session import discard
from indicatorlake.sources.tables import export_files
from workload.export_cases import _CONFIG, _stage_frame
from workload.harmonise_cases import view
from workload.standins import areas, run_sql

SF = "/root/testdata/sf0.001"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_first_per_key_keeps_the_first_even_of_nulls(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), (None, 3, 9), (None, 4, 8), ("b", None, 1)], "k string, v int, seq int")
    assert rows(first_per_key(df, ["k"], "seq")) == Counter([("a", 2), (None, 4), ("b", None)])


def test_lookup_join_never_changes_the_number_of_rows(spark):
    main = spark.createDataFrame([("a", "m1"), ("a", "m2"), (None, "m3"), ("z", "m4")], "k string, name string")
    lookup = spark.createDataFrame([("a", "x", 1), (None, "y", 2)], "key string, name string, extra int")
    assert rows(lookup_join(main, lookup, {"k": "key"})) == Counter([("a", "m1", 1), ("a", "m2", 1), (None, "m3", None), ("z", "m4", None)])


def test_rename_is_simultaneous(spark):
    df = spark.createDataFrame([("1", "2")], "element string, element_1 string")
    assert rename_columns(df, {"element": "element_code", "element_1": "element"}).columns == ["element_code", "element"]


def test_years_to_rows_needs_a_year(spark):
    with pytest.raises(ValueError):
        years_to_rows(spark.createDataFrame([("1",)], "a string"), "year", "value")


def test_pairs_are_the_product_and_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(grid, "CELLS_PER_TASK", 4000)
    scope, uids = spark.range(20).toDF("a"), spark.range(500).selectExpr("CAST(id AS STRING) AS afs_uid")
    pairs = all_pairs(scope, uids, 10)
    assert rows(pairs.select("a", "afs_uid")) == Counter((a, str(u)) for a in range(20) for u in range(500))
    cells = pairs.withColumn("y", F.explode(F.sequence(F.lit(1), F.lit(10)))).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in cells) == 100000 and len(cells) >= 20 and max(r["count"] for r in cells) < 12000


def _stage(spark):
    data = [("003", "u1", 2010, 1.0), ("003", "u1", 2010, 2.0), ("003", "u9", 2010, 3.0), (None, "u1", 2011, 4.0),
            ("999", "u1", 2011, 5.0), ("003", "u2", 2013, 6.0), ("005", "u2", 2012, 7.0), ("005", None, 2012, 8.0),
            ("003", "u1", 2009, 9.0), ("003", "u1", None, 10.0)]
    return spark.createDataFrame(data, "afs_m49_code string, afs_uid string, afs_year bigint, v double")


def test_gap_fill_equals_left_plus_anti_and_full_outer(spark):
    scope = spark.createDataFrame([("003", "A"), ("005", "B"), ("005", "B2"), ("007", None)], "m49_code string, area_name string")
    uids = spark.createDataFrame([("u1",), ("u2",), (None,)], "afs_uid string")
    stage = _stage(spark)
    facts = stage.where("afs_year >= 2010")
    grid = reference_grid(scope, uids, 2010, 2012)
    assert grid.count() == 4 * 3 * 3
    left = grid.join(facts, list(KEYS), "left").select(*KEYS, "afs_area_name", "v")
    anti = facts.join(grid, list(KEYS), "left_anti").select(*KEYS, F.lit(None).alias("n"), "v")
    full = grid.join(facts, list(KEYS), "full_outer").select(*KEYS, "afs_area_name", "v")
    filled = gap_fill(stage, scope, uids, 2010, 2012)
    assert rows(filled) == rows(left.union(anti)) == rows(full)


def test_gap_filled_export_joins_facts_without_shuffling_them(spark):
    """Facts of one hot key must not meet in one task: they only meet broadcast dimensions, and no grid-sized side is built."""
    scope, uids = areas(spark, SF), published_uids(run_sql(spark, SF, _CONFIG, "customer"))
    plan = gap_fill(_stage_frame(spark, SF), scope, uids, 1998, 2001)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert not [j for j in joins if "FullOuter" in j or "Cartesian" in j or "LeftAnti" in j]


def test_default_grid_ends_this_year(spark):
    scope = spark.createDataFrame([("003", "A")], "m49_code string, area_name string")
    uids = spark.createDataFrame([("u1",)], "afs_uid string")
    this_year = spark.range(1).select(F.year(F.current_date())).head()[0]
    assert reference_grid(scope, uids, 2010).count() == this_year - 2010 + 1
    assert reference_grid(scope, uids, 2010, 2009).count() == 0


def test_global_order_holds_over_partitions_and_splits_a_hot_key(spark):
    hot = spark.range(0, 40000, numPartitions=8).selectExpr("CASE WHEN id % 3 > 0 THEN NULL ELSE id % 7 END AS k", "'same' AS v")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ordered = globally_ordered(hot, "k").withColumn("p", F.spark_partition_id())
        held = {r["p"]: (r["low"], r["high"], r["n"]) for r in ordered.groupBy("p").agg(
            F.min(F.coalesce("k", F.lit(-1))).alias("low"), F.max(F.coalesce("k", F.lit(-1))).alias("high"), F.count("*").alias("n")).collect()}
        values = [r["k"] for r in ordered.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(values) == 40000 and values == sorted(values, key=lambda k: -1 if k is None else k)
    assert sum(1 for low, _, _ in held.values() if low == -1) > 2
    assert max(n for _, _, n in held.values()) < 40000 / 2


def test_ranges_come_from_the_job_that_stores_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordering, "SAMPLED_ROWS", 16)
    kinds = "CASE WHEN id % 3 > 0 THEN NULL WHEN id % 5 = 0 THEN 'hot' ELSE CAST(id * 7919 % 1000 AS STRING) END AS k, CAST(id * 31 % 90 AS INT) AS n, CAST(IF(id % 11 = 0, 'NaN', CAST(id % 13 AS STRING)) AS DOUBLE) AS d"
    df = spark.sql(f"SELECT id, {kinds} FROM range(0, 60000, 1, 6)")
    ordered = ordering.stored_and_ordered(df, "k", "n", "d")
    held = ordered.withColumn("p", F.spark_partition_id()).collect()
    key = [tuple((v is not None, 2 if isinstance(v, float) and v != v else 1 if v is not None else 0, 0 if v is None or v != v else v) for v in (r.k, r.n, r.d)) for r in held]
    assert key == sorted(key) and sorted(r.id for r in held) == list(range(60000))
    sizes = Counter(r.p for r in held)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(sizes) == ranges and max(sizes.values()) < 2 * 60000 / ranges
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "passthrough" in plan
    discard(ordered)
    assert ordering.stored_and_ordered(df.where("false"), "k").count() == 0
    assert [r.id for r in ordering.stored_and_ordered(df.where("id < 2"), "id").collect()] == [0, 1]


def test_files_hold_equal_bytes_whatever_the_width_of_their_rows(spark, tmp_path, monkeypatch):
    """Short rows first, rows of 4 KB last: files by numbers of rows would differ a hundredfold.

    The tasks here hold two files each, not a part of one as at the target's real size, so more of their rows are sampled.
    """
    monkeypatch.setattr(ordering, "SAMPLED_ROWS", 4096)
    df = spark.sql("""SELECT lpad(CAST(id AS STRING), 6, '0') AS k,
        substring(concat_ws('', transform(sequence(1, 64), i -> sha2(CONCAT(id, 'x', i), 256))), 1, CASE WHEN id < 20000 THEN 40 WHEN id < 23000 THEN 800 ELSE 4000 END) AS text
        FROM range(0, 24000, 1, 6)""")
    target = 300_000
    ordered = ordering.stored_and_ordered(df, "k", range_bytes=target)
    assert export_files(ordered, f"{tmp_path}/out", rows_per_file=0) == 24000
    files = sorted((tmp_path / "out").glob("*.parquet"))
    sizes = [f.stat().st_size for f in files]
    assert len(files) > 8 and all(0.8 * target < size < 1.2 * target for size in sizes[:-1]) and sizes[-1] < 1.2 * target
    keys = [k for f in files for k in spark.read.parquet(str(f)).toPandas()["k"]]
    assert keys == sorted(keys)


INDICATORS = [Indicator("a", "afs_year >= 2000"), Indicator("b", "TRUE"), Indicator("c", "afs_flag = NULL"),
              Indicator("d", "get_json_object(SERIES, '$.item') = 'item 3'"), Indicator("e", "afs_m49_code = '003'")]


def test_fan_out_equals_the_union_of_filters(spark):
    v = view(spark, SF, "faostat_qcl")
    union = reduce(lambda a, b: a.unionByName(b), [
        v.where(i.condition).select(F.lit(i.uid).alias("afs_uid"), "*") for i in INDICATORS])
    assert rows(fan_out(v, INDICATORS)) == rows(union)


def test_many_predicates_go_in_batches(spark):
    v = spark.range(50).toDF("x")
    wanted = [Indicator(f"u{i}", f"x % 250 = {i} AND x IS NOT NULL AND x < 1000000") for i in range(250)]
    assert len(list(batches(wanted))) == 2
    assert rows(select_indicators(v, wanted)) == Counter((f"u{i}", i) for i in range(50))


def test_plain_predicates_reach_the_scan(spark, tmp_path):
    spark.range(50).selectExpr("id AS x", "CAST(id % 5 AS STRING) AS k").write.parquet(f"{tmp_path}/v")
    v = spark.read.parquet(f"{tmp_path}/v")

    def pushed(*conditions):
        df = fan_out(v, [Indicator(f"u{i}", c) for i, c in enumerate(conditions)])
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.split("PushedFilters: [")[1].split("]")[0], rows(df)

    assert pushed("k = '1'")[0] and "Or(" in pushed("k = '1'", "x < 7")[0]
    both = pushed("k = '1'", "x < 7")[1]
    assert both == Counter([("u0", i, "1") for i in range(1, 50, 5)] + [("u1", i, str(i % 5)) for i in range(7)])
    assert pushed("k = '1'", "length(k) = 1")[0] == pushed("TRUE")[0]  # only what the explode itself asks


CONDITIONS = [
    "k = 'a'", "k = 'a' AND x > 3", "x = 3", "k IN ('a', 'b', 'a') AND x = 2", "'b' = k AND k = 'b'", "k = 'a' AND k = 'b'", "k IS NULL", "TRUE", "k = NULL",
    "k = 'a' OR x = 1", "k BETWEEN 'a' AND 'b' AND x IN (1, 2, 3)", "get_json_object(bag, '$.n') = 'it''s \"5\"' AND k = 'b'", "x = 1L AND k <> 'a'", "x = 1 AND k <> 'c'",
    "NOT (k = 'a')", "x = 2.0 AND k = 'c'", "CAST(n AS INT) = 7 AND k = 'number'", "lower(k) = 'a'", "k <=> NULL AND x = 5", "k = '' AND x = 5", "x IN (1, NULL)",
    "k = 'a' AND n = '1'", "k = 'c' AND n = '7'", "k = '-- a' OR k = 'b'", "k IN ('b', 'c') AND lower(k) = 'c'",
    "(k = 'a' AND (x = 1 AND lower(k) IN ('a', 'c')))", "k = '3' AND x = 1", "k = 'a\\\\b'"]


def test_an_index_of_predicates_equals_the_union_of_filters(spark, monkeypatch):
    monkeypatch.setattr(predicates, "RESTS_TOGETHER", 2)
    names, bags = ["a", "b", "c", None, "", "3", "number", "a\\b"], [json.dumps({"n": 'it\'s "5"'}), "{}", None, "no json"]
    v = spark.createDataFrame([(x, k, bag, "7" if k == "number" else "1") for x in range(6) for k in names for bag in bags], "x int, k string, bag string, n string")
    wanted = [Indicator(f"u{i}", c) for i, c in enumerate(CONDITIONS)]
    union = reduce(lambda a, b: a.unionByName(b), [v.where(i.condition).select(F.lit(i.uid).alias("afs_uid"), "*") for i in wanted])
    assert rows(selected(v, wanted)) == rows(union) and ("u11", 0, "b", bags[0], "1") in rows(union)
    index = predicates.Index(v, [(i.uid, i.condition) for i in wanted])
    assert {uid for uid, _, _ in index.found} >= {"u0", "u1", "u2", "u3", "u4", "u5", "u11", "u13", "u17", "u21", "u22", "u24", "u25", "u26", "u27"}
    assert {uid for uid, _ in index.others} >= {"u6", "u7", "u9", "u14", "u20"}
    only = [i for i in wanted if i.uid in {"u0", "u2", "u5"}]
    plan = selected(v, only)._jdf.queryExecution().optimizedPlan().toString()
    assert rows(selected(v, only)) == Counter({k: n for k, n in rows(union).items() if k[0] in {"u0", "u2", "u5"}}) and "Join" in plan


def test_thousands_of_predicates_are_one_scan(spark, tmp_path):
    spark.range(3000).selectExpr("CAST(id % 1500 AS STRING) AS k", "CAST(id AS INT) AS x").write.parquet(f"{tmp_path}/v")
    v = spark.read.parquet(f"{tmp_path}/v")
    wanted = [Indicator(f"u{i}", f"k = '{i % 1500}'" + (f" AND x >= {i % 1500 + i % 7}" if i % 2 else "")) for i in range(3000)]
    df = selected(v, wanted)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "In(k" in plan.replace("PushedFilters: [In(k", "In(k")
    expected = Counter((w.uid, str(x % 1500), x) for i, w in enumerate(wanted) for x in (i % 1500, i % 1500 + 1500) if i % 2 == 0 or x >= i % 1500 + i % 7)
    assert rows(df) == expected


def test_queries_share_one_stored_selection(spark, tmp_path):
    spark.range(100).selectExpr("CAST(id AS INT) AS x", "CAST(id % 4 AS STRING) AS k").write.parquet(f"{tmp_path}/v")
    v = spark.read.parquet(f"{tmp_path}/v")
    wanted = [Indicator("007", "k = '1'", "SELECT afs_uid, max(x) AS x, k FROM input GROUP BY afs_uid, k"), Indicator("a/b c", "x < 3", "SELECT * FROM input"),
              Indicator("none", "k = '9'", "SELECT * FROM input")]
    out = processed_together(v, wanted)
    assert not any(f"{tmp_path}/v" in f for df in out for f in df.inputFiles())
    assert rows(reduce(lambda a, b: a.unionByName(b), out)) == Counter([("007", 97, "1"), *(("a/b c", x, str(x)) for x in range(3))])
    assert "PartitionFilters: [isnotnull(afs_uid" in out[1]._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(AnalysisException):
        processed_together(v, [*wanted, Indicator("bad", "k = '1'", "SELECT nope FROM input")])
    with pytest.raises(ValueError):
        selected(v, [Indicator("u", "x")])


def test_the_users_own_view_called_input_stays(spark):
    spark.range(2).createOrReplaceTempView("input")
    v = spark.range(6).selectExpr("id AS x", "'{}' AS bag")
    query = "WITH big AS (SELECT * FROM input WHERE bag = '{}') SELECT afs_uid, x + 100 AS x, bag FROM big ;"
    assert rows(processed(v, Indicator("u", "x > 3", query))) == Counter([("u", 104, "{}"), ("u", 105, "{}")])
    assert spark.table("input").count() == 2
    spark.catalog.dropTempView("input")


def test_bad_predicate_and_missing_column_fail_before_running(spark):
    v = spark.range(3).toDF("x")
    with pytest.raises(AnalysisException):
        fan_out(v, [Indicator("u", "nope = 1")])
    with pytest.raises(AnalysisException):
        processed(v, Indicator("u", "TRUE", "SELECT afs_uid, 1 AS y FROM input"))
    with pytest.raises(ValueError):
        fan_out(v, [Indicator("", "TRUE")])


def test_config_reasons(spark):
    data = [("u1", "s1", "TRUE", "DRAFT"), ("u2", "s1", "TRUE", "ACTIVE"), ("u2", "s1", "x = 1", "REVIEW"), ("u3", "s1", "TRUE", "ACTIVE"),
            ("u3", "s1", "TRUE", "INACTIVE"), (" ", "s1", "TRUE", "DRAFT"), (None, "", " ", None), ("u4", "s9", "TRUE", "PAUSED")]
    config = spark.createDataFrame(data, "afs_uid string, afs_source_code string, filter_string string, status string")
    views = spark.createDataFrame([("s1",)], "afs_source_code string")
    found = {(r.afs_uid, r.status): r.reasons for r in q.with_reasons(config, views).collect()}
    assert found == {
        ("u1", "DRAFT"): [], ("u2", "ACTIVE"): ["duplicate afs_uid"], ("u2", "REVIEW"): ["duplicate afs_uid"],
        ("u3", "ACTIVE"): [], (" ", "DRAFT"): ["blank afs_uid"],
        (None, None): ["bad status", "blank afs_uid", "blank afs_source_code", "blank filter_string"],
        ("u4", "PAUSED"): ["bad status", "missing view"],
    }


def test_key_diff_counts_null_as_a_key(spark):
    left = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("b",)], "k string")
    assert rows(key_diff(left, right, "k")) == Counter([(None, "left"), ("b", "right")])


def test_table_issues(spark):
    assert q.table_issues(spark.createDataFrame([], "a int"), "t") == ["t is empty"]
    assert q.table_issues(spark.range(1).toDF("a").select("a", "a", F.lit(1).alias(" ")), "t") == [
        "t has blank column names at [2]", "t repeats column names ['a']"]


def test_names(spark):
    given = ["Southern Africa", " asia ", "Korea, Rep.", "Korea, Dem. People's Rep.", "Viet Nam", "Africa: Northern Africa", "Zork",
             "Congo, Dem. Rep.", "Congo", "United Kingdom", "Atlantis", "South Africa", "Côte d'Ivoire",
             "Türkiye", "Hong Kong, China", "Bahamas, The", "St. Lucia", "Burma", "Curaçao", "Lebanon (Republic of)", "Lebanon, Northern", "São Tomé & Príncipe"]
    known = spark.createDataFrame([("710", "ZAF", "South Africa"), ("801", "AT1", "Atlantis"), ("802", "AT2", "Atlantis"), ("344", "HKG", "Hong Kong"),
                                   ("044", "BHS", "Bahamas"), ("662", "LCA", "Saint Lucia"), ("104", "MMR", "Myanmar"), ("531", "CUW", "Curacao"), ("422", "LBN", "Lebanon")],
                                  "m49_code string, iso3c string, area_name string")
    names = spark.createDataFrame([(n,) for n in [*given, None, "  "]], "n string")
    codes = name_codes(names, "n", "c", known, region_table(spark), alias_table(spark), skip_aggregates=True)
    assert {r.n: r.c for r in codes.collect()} == {
        "Southern Africa": "018", " asia ": "142", "Korea, Rep.": "410", "Korea, Dem. People's Rep.": "408", "Viet Nam": "704",
        "Africa: Northern Africa": None, "Zork": None, "Congo, Dem. Rep.": "180", "Congo": "178", "United Kingdom": "826",
        "Atlantis": None, "South Africa": "710", "Côte d'Ivoire": "384", "Türkiye": "792", "Hong Kong, China": "344", "Bahamas, The": "044",
        "St. Lucia": "662", "Burma": "104", "Curaçao": "531", "Lebanon (Republic of)": "422", "Lebanon, Northern": None, "São Tomé & Príncipe": "678"}


def test_view_schema_is_canonical_and_duplicate_areas_fan_out(spark):
    v = view(spark, SF, "usda")
    assert [(f.name, f.dataType) for f in v.schema] == [(f.name, f.dataType) for f in OBSERVATION]
    with pytest.raises(ValueError):
        assert_observation(v.drop("GEO"), "v")
    source = spark.createDataFrame([("X", "n", "2001", "1")], "iso3 string, country string, end_year string, value string")
    source = source.selectExpr("*", "end_year AS start_year", "'r' AS region", "'i' AS indicator", "'u' AS unit", "'s' AS source",
                               "'c' AS afs_source_code", "'d' AS afs_source_updated_at", "'2024-01-01' AS afs_source_ingested_at")
    twice = spark.createDataFrame([("001", "X"), ("002", "X")], "m49_code string, iso3c string")
    assert harmonise(source, twice, "fsd").count() == 2


def test_row_changes_are_a_multiset_difference(spark):
    schema = "a string, b string, x double"
    before = [("k", None, 1.0), (None, "k", 1.0), ("same", "s", 0.0), ("twice", "t", 2.0), ("twice", "t", 2.0), ("gone", "g", None), ("nan", "n", float("nan"))]
    after = [(None, "k", 1.0), (None, "k", 1.0), ("same", "s", -0.0), ("twice", "t", 2.0), ("new", "g", None), ("nan", "n", float("nan")), (None, None, None)]
    b, a = spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)
    assert rows(row_changes(b, a, ["a", "b", "x"])) == Counter([
        ("k", None, 1.0, 1, 0), (None, "k", 1.0, 1, 2), ("twice", "t", 2.0, 2, 1), ("gone", "g", None, 1, 0), ("new", "g", None, 0, 1), (None, None, None, 0, 1)])
    assert rows(row_changes(b, a, ["x"])) == Counter([(2.0, 2, 1), (None, 1, 2)])
    assert row_changes(b, b.orderBy("a"), ["a", "b", "x"]).count() == 0
    assert row_changes(b.where("false"), b.where("false"), ["a"]).count() == 0


def test_only_buckets_that_differ_are_compared(spark):
    left = spark.range(20000).selectExpr("CAST(id AS STRING) AS k", "id % 7 AS v")
    right = left.where("k <> '77'").unionByName(spark.createDataFrame([("new", 1)], "k string, v long"))
    found = key_diff(left, right, "k")
    assert rows(found) == Counter([("77", "left"), ("new", "right")])
    differ = changes.differing_buckets(left, right, [F.col("k")], [F.col("k")])
    assert 1 <= differ.count() <= 2 < 20000 < BUCKETS
    shuffled = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin" in line]
    assert shuffled == []  # the few buckets go to the rows, not the rows to them
