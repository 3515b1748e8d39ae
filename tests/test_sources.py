"""CSV rules, recipes and tables on small files."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from indicatorlake.operators.ordering import globally_ordered
from indicatorlake.plans import export, ingest, stage, sync
from indicatorlake.session import scratch_folder
from indicatorlake.sources import csv, recipes
from indicatorlake.sources.config import update_fields
from indicatorlake.sources.naming import source_table
from indicatorlake.sources.tables import Lake, export_files


@pytest.fixture
def folder(tmp_path):
    def put(**files):
        for name, text in files.items():
            path = tmp_path / name.replace("__", "/")
            path.parent.mkdir(parents=True, exist_ok=True)
            path.with_name(path.name + ".csv").write_text(text, encoding="utf-8")
        return str(tmp_path)

    return put


@pytest.fixture
def lake(spark):
    return Lake(spark, f"t_{uuid.uuid4().hex}", scratch_folder(spark, "test"))


def test_cells_stay_text_whatever_they_hold(spark, folder):
    path = folder(a='﻿SPECIES,Species,,n\n007,"a ""q"", b",,1.0\n,"two\nlines","",\n') + "/a.csv"
    df = csv.read_csv(spark, path)
    assert df.columns == ["SPECIES", "Species", "unnamed_2", "n"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted([("007", 'a "q", b', None, "1.0"), (None, "two\nlines", None, None)], key=str)
    assert source_table(df, {"afs_source_code": "x"}).columns == ["species", "species_1", "unnamed_2", "n", "afs_source_code"]
    with pytest.raises(KeyError):
        csv.read_csv(spark, path, require=["species"])


def test_choice_of_the_long_table(spark, folder, tmp_path):
    assert csv.long_table_csv(spark, folder(only="x\n1\n")).endswith("/only.csv")
    root = folder(**{"b_E_All_Data_(Normalized)": "x\n1\n", "a_E_All_Data_(Normalized)": "x\n1\n", "sub__z": "x\n1\n"})
    assert csv.long_table_csv(spark, root).endswith("/a_E_All_Data_(Normalized).csv")
    assert csv.long_table_csv(spark, root + "/only.csv").endswith("/only.csv")


def test_no_or_ambiguous_files_are_errors(spark, folder):
    root = folder(a="x\n1\n", b="x\n1\n", s1__t="x\n1\n", s2__t="x\n1\n")
    with pytest.raises(FileNotFoundError):
        csv.long_table_csv(spark, root)
    with pytest.raises(FileNotFoundError):
        csv.csv_by_name(spark, root, "zzz.csv")
    with pytest.raises(ValueError):
        csv.csv_by_name(spark, root, "t.csv")
    with pytest.raises(KeyError):
        recipes.many_files_with_names(spark, root, None)


def test_first_lookup_row_in_file_order_wins(spark, folder):
    root = folder(k="K,V\n" + "".join(f"{i % 50},{i}\n" for i in range(5000)))
    kept = recipes.lookup_table(spark, root + "/k.csv", ["K"])
    assert sorted((int(r.K), int(r.V)) for r in kept.collect()) == [(i, i) for i in range(50)]


def test_fishery_main_side_wins_and_case_only_names_survive(spark, folder):
    root = folder(**{
        "GLOBAL_PRODUCTION_raw_data (without aggregates)": "SPECIES,WATER_AREA,ref_area,v\nS1,W1,4,9\nS2,W9,5,8\n",
        "GLOBAL_PRODUCTION_SPECIES_ATTRIBUTES": "SPECIES,Species,ref_area\nS1,Cod,X\nS1,Later,Y\n",
        "GLOBAL_PRODUCTION_WATER_AREA_ATTRIBUTES": "WATER_AREA,Fishing Area,FISHING_AREA\nW1,drop,keep\n",
    })
    df = source_table(recipes.recipe_for("fao_fishstat_globalproduction")(spark, root, None), {})
    assert df.columns == ["species", "water_area", "ref_area", "v", "species_name", "fishing_area"]
    assert sorted(map(tuple, df.collect())) == [("S1", "W1", "4", "9", "Cod", "keep"), ("S2", "W9", "5", "8", None, None)]


def test_replace_keys_twice_is_once_and_odd_uids_work(spark, lake):
    uids = ["a b", "c/d=e", "f%g", "h"]
    df = spark.range(40).select(F.element_at(F.array(*map(F.lit, uids)), (F.col("id") % 4 + 1).cast("int")).alias("afs_uid"), "id")
    assert lake.write("stg_x_tbl", df, "afs_uid", replace=False) == 40
    with pytest.raises(ValueError):
        lake.write("stg_x_tbl", df, "afs_uid", replace=False)
    new = df.where("id < 8 AND afs_uid <> 'h'")
    for _ in range(2):
        assert lake.replace_keys("stg_x_tbl", new, "afs_uid", uids[1:]) == 4
        counts = {r.afs_uid: r["count"] for r in lake.read("stg_x_tbl").groupBy("afs_uid").count().collect()}
        assert counts == {"a b": 10, "c/d=e": 2, "f%g": 2}
    assert lake.write("stg_x_tbl", new, "afs_uid") == 6
    assert lake.read("stg_x_tbl").count() == 6


def test_a_failed_write_leaves_the_table(spark, lake):
    good = spark.range(4).selectExpr("'u' AS afs_uid", "id")
    lake.write("stg_y_tbl", good, "afs_uid")
    bad = good.withColumn("id", F.raise_error(F.lit("boom")).cast("bigint"))
    for write in (lambda: lake.replace_keys("stg_y_tbl", bad, "afs_uid", ["u"]), lambda: lake.write("stg_y_tbl", bad, "afs_uid")):
        with pytest.raises(Exception, match="boom"):
            write()
        assert lake.read("stg_y_tbl").count() == 4


class Breaking:
    """A session whose n-th catalog statement fails."""

    def __init__(self, spark, after):
        self.spark, self.left = spark, after

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def sql(self, text, *args, **kwargs):
        if not text.startswith(("SHOW", "DESCRIBE")):
            if self.left == 0:
                raise RuntimeError("the catalog is gone")
            self.left -= 1
        return self.spark.sql(text, *args, **kwargs)


@pytest.mark.parametrize("after", range(6))
def test_no_moment_without_the_old_or_the_new_table(spark, lake, after):
    old = spark.range(6).selectExpr("concat('u', id % 3) AS afs_uid", "id")
    new = old.where("afs_uid <> 'u1'").selectExpr("afs_uid", "id + 100 AS id")
    for table, key, work in (("a", None, lambda broken: broken.write("a", new)), ("b", "afs_uid", lambda broken: broken.write("b", new, "afs_uid")),
                             ("c", "afs_uid", lambda broken: broken.replace_keys("c", new, "afs_uid", ["u0", "u1"]))):
        lake.write(table, old, key)
        before = sorted(map(tuple, lake.read(table).collect()))
        broken = Lake(Breaking(spark, after + 1), lake.database, lake.root)
        try:
            work(broken)
            failed = False
        except RuntimeError:
            failed = True
        found = sorted(map(tuple, lake.read(table).collect()))
        wanted = sorted(map(tuple, new.collect())) if table != "c" else sorted([("u0", 100), ("u0", 103), ("u2", 2), ("u2", 5)])
        assert found == (before if failed else wanted)
        if failed:  # running it again gives what one run gives
            work(lake)
            assert sorted(map(tuple, lake.read(table).collect())) == wanted
    assert after < 4 or not failed


def test_a_failing_push_is_logged(spark, lake, folder):
    path = folder(s="k,v\n1,2\n") + "/s.csv"
    broken = Lake(Breaking(spark, 2), lake.database, lake.root)
    with pytest.raises(RuntimeError):
        sync.push(broken, path, "cfg_x", "k", force=True)
    assert lake.exists(sync.LOG) is False or lake.read(sync.LOG).head().status == "FAILED"


def test_updates_never_double_config_rows(spark):
    config = spark.createDataFrame([("a", "1"), ("b", None)], "k string, f string")
    twice = spark.createDataFrame([("a", "2"), ("a", "3")], "k string, f string")
    with pytest.raises(Exception, match="several updates for a"):
        update_fields(config, twice, "k").collect()


def test_surplus_cells_and_bad_bytes_stop_a_read(spark, folder, tmp_path):
    root = folder(wide="a,b\n1,2\n3,4,LOST\n5\n6,7,\n", many='a,b\n1,"x\ny"\n3,4,LOST\n5\n"6\n",7\n')
    for name, good in (("wide", {("1", "2"), ("5", None), ("6", "7")}), ("many", {("1", "x\ny"), ("5", None), ("6\n", "7")})):
        with pytest.raises(Exception, match="LOST"):
            csv.read_csv(spark, f"{root}/{name}.csv").collect()
        assert {tuple(r) for r in csv.read_csv(spark, f"{root}/{name}.csv", surplus="reject").collect()} == good
        kinds = {r.record: r.kind for r in csv.csv_rejects(spark, f"{root}/{name}.csv").collect()}
        assert kinds["3,4,LOST"] == "surplus" and kinds["5"] == "other width"
    (tmp_path / "latin.csv").write_bytes("a\nSão\n".encode("latin-1"))
    with pytest.raises(Exception, match="bytes that are not UTF-8"):
        csv.read_csv(spark, f"{tmp_path}/latin.csv").collect()
    assert csv.read_csv(spark, f"{tmp_path}/latin.csv", encoding="ISO-8859-1").head().a == "São"
    assert csv.read_csv(spark, f"{tmp_path}/latin.csv", bad_bytes="keep").count() == 1


def test_hidden_names_are_listed_and_read(spark, tmp_path):
    for k, name in enumerate(["_a.csv", "b.csv", ".c.csv", "_dir/d.csv", "__MACOSX/e.csv", "f.csv/part-0.csv", "f.csv/_SUCCESS"], 1):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(f"x\n{k}\n")
    root = str(tmp_path)
    assert csv.csv_names(spark, root) == [".c.csv", "_a.csv", "_dir/d.csv", "b.csv", "f.csv"]
    assert {csv.read_csv(spark, f"{root}/{n}").head().x for n in csv.csv_names(spark, root)} == {"1", "2", "3", "4", "6"}
    assert csv.read_csv(spark, f"{root}/_a.csv").head().x == "1"
    assert {r.x for r in csv.read_csv(spark, [f"{root}/_a.csv", f"{root}/b.csv"]).collect()} == {"1", "2"}


def test_records_over_lines_are_split_over_tasks(spark, folder):
    rows = [(i, f"line {i}\nnext, \"\"q\"\" {i}" if i % 3 else f"plain {i}") for i in range(4000)]
    root = folder(big="id,text\n" + "".join(f'{i},"{t}"\n' for i, t in rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        df = csv.read_csv(spark, f"{root}/big.csv", position=True)
        found = [(int(r.id), r.text) for r in df.orderBy(csv.POSITION).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == [(i, t.replace('""', '"')) for i, t in rows]


def test_files_of_an_export_are_in_order(spark, lake, tmp_path):
    rows = spark.range(1000).selectExpr("lpad(id * 7 % 1000, 3, '0') AS k", "id")
    steps = export._published(lake, export.STAGE_TABLE, lambda: globally_ordered(rows.repartition(5), "k"), f"{tmp_path}/out", rows_per_file=100)
    assert [work() for _, _, work in steps] == [1000, 1000]
    files = sorted(p for p in (tmp_path / "out").glob("*/*.parquet"))
    keys = [k for p in files for k in spark.read.parquet(str(p)).toPandas()["k"]]
    assert keys == sorted(keys) and len(files) >= 10 and lake.read(export.STAGE_TABLE).count() == 1000
    steps = export._published(lake, export.STAGE_TABLE, lambda: rows.limit(3), f"{tmp_path}/out")
    assert [work() for _, _, work in steps] == [3, 3] and spark.read.parquet(f"{tmp_path}/out/*").count() == 3


class Elsewhere:
    """A session on a cluster that names no shared folder."""

    class sparkContext:
        master = "spark://host:7077"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    with pytest.raises(RuntimeError, match="checkpoint"):
        scratch_folder(Elsewhere(), "x")
    assert "/x-" in scratch_folder(spark, "x")


def test_a_table_may_be_rewritten_from_itself(spark, lake):
    lake.write("cfg", spark.createDataFrame([("u1", "DRAFT", "x"), ("u2", "DRAFT", None)], "k string, status string, f string"))
    updates = spark.createDataFrame([("u2", "y")], "k string, f string")
    lake.write("cfg", update_fields(lake.read("cfg"), updates, "k"))
    assert sorted(map(tuple, lake.read("cfg").collect())) == [("u1", "DRAFT", "x"), ("u2", "DRAFT", "y")]


def test_export_clears_only_its_folder(spark, tmp_path):
    export_files(spark.range(100).repartition(5), f"{tmp_path}/a")
    export_files(spark.range(7), f"{tmp_path}/b")
    assert export_files(spark.range(3).coalesce(1), f"{tmp_path}/a", rows_per_file=2) == 3
    assert spark.read.parquet(f"{tmp_path}/a").count() == 3 and spark.read.parquet(f"{tmp_path}/b").count() == 7
    assert len([p for p in (tmp_path / "a").iterdir() if p.suffix == ".parquet"]) == 2


def test_ingest_reports_bad_sources_and_goes_on(spark, lake, folder):
    root = folder(good__a="x,y\n1,2\n", empty__skip="")
    rows = [("good", "ag", "2024-01-02", None), ("bad", "ag", None, None), (None, None, None, None)]
    lake.write(ingest.SOURCE_CONFIG, spark.createDataFrame(
        rows, "afs_source_code string, agency string, afs_source_updated_at string, afs_source_ingested_at string"))
    result = ingest.ingest(lake, {"good": f"{root}/good", "bad": f"{root}/none"}, None)
    assert {r.afs_source_code: r.status for r in result.collect()} == {"good": "SUCCESS", "bad": "FAILED"}
    assert spark.read.parquet(f"{lake.root}/ag/good-20240102.parquet").columns[:2] == ["x", "y"]
    again = ingest.ingest(lake, {"good": f"{root}/good"}, None, codes="good".split())
    assert again.head().status == "SKIPPED"
    first = lake.folder(ingest.source_view_name("good"))
    bad = folder(worse__a="x,y\n1,2,3\n")
    assert ingest.ingest(lake, {"good": f"{bad}/worse"}, None, codes=["good"], force=True).head().status == "FAILED"
    assert lake.folder(ingest.source_view_name("good")) == first and lake.read(ingest.source_view_name("good")).count() == 1
    new = folder(new__a="x,y\n1,2\n3,4\n")
    assert ingest.ingest(lake, {"good": f"{new}/new"}, None, codes=["good"], force=True).head().status == "SUCCESS"
    assert lake.folder(ingest.source_view_name("good")) != first and lake.read(ingest.source_view_name("good")).count() == 2
    statuses = [r.status for r in lake.read(ingest.SOURCE_LOG).where("afs_source_code = 'good'").collect()]
    assert sorted(statuses) == ["FAILED", "SKIPPED", "SUCCESS", "SUCCESS"]


def test_ingest_says_what_recipes_leave_out(spark, lake, folder):
    strange = [f"Nowhere {k:02}" for k in range(30)]
    root = folder(ilo__a="ref_area.label,v\nKenya,1\nNowhere,2\n" + "".join(f"{n},3\n" for n in strange * 2), ilo__b="x\n1\n",
                  **{"fish__AQUATIC_PROCESSED_PRODUCTION_raw_data (without aggregates)": "PRODUCT,v\nP1,1\n",
                     "fish__AQUATIC_PROCESSED_PRODUCTION_PRODUCT_ATTRIBUTES": "PRODUCT,n\nP1,a\nP1,b\nP2,c\n"})
    rows = [("ilostat_emp_dwap_rt", "ag", "some day", None), ("fao_fishstat_processed", "ag", "2024-01-02", None)]
    lake.write(ingest.SOURCE_CONFIG, spark.createDataFrame(
        rows, "afs_source_code string, agency string, afs_source_updated_at string, afs_source_ingested_at string"))
    known = spark.createDataFrame([("404", "KEN", "Kenya")], "m49_code string, iso3c string, area_name string")
    folders = {"ilostat_emp_dwap_rt": f"{root}/ilo", "fao_fishstat_processed": f"{root}/fish"}
    log = {r.afs_source_code: r.message for r in ingest.ingest(lake, folders, recipes.AreaNames.standard(known)).collect()}
    assert "publish date not understood: some day" in log["ilostat_emp_dwap_rt"]
    assert "b.csv" in log["ilostat_emp_dwap_rt"] and "names without a code: Nowhere, Nowhere 00" in log["ilostat_emp_dwap_rt"]
    assert "and 11 more" in log["ilostat_emp_dwap_rt"]
    lost = lake.read(ingest.LOST_NAMES)
    assert sorted(r.name for r in lost.collect()) == ["Nowhere", *strange] and {r.afs_source_code for r in lost.collect()} == {"ilostat_emp_dwap_rt"}
    assert "1 keys have several rows" in log["fao_fishstat_processed"]


def test_sheet_problems_stop_a_push(spark, lake, folder):
    root = folder(ok="k,v\n007,1\n", dup="k,k\n1,2\n")
    assert sync.push(lake, f"{root}/ok.csv", "cfg", "k") == 1
    with pytest.raises(ValueError, match="repeats"):
        sync.push(lake, f"{root}/dup.csv", "cfg", "k")
    assert lake.read("cfg").head().k == "007"
    assert [r.status for r in lake.read(sync.LOG).orderBy("status").collect()] == ["FAILED", "SUCCESS"]
    sync.pull(lake, "cfg", f"{root}/out.csv")
    assert csv.read_csv(spark, f"{root}/out.csv").head().k == "007"


def test_unused_tables(spark, lake):
    lake.write("stg_gone_tbl", spark.range(3).selectExpr("'u' AS afs_uid", "id"), "afs_uid")
    lake.write(stage.CONFIG, spark.createDataFrame([("u", "gone", "TRUE", "INACTIVE")], "afs_uid string, afs_source_code string, filter_string string, status string"))
    assert [tuple(r) for r in stage.unused_tables(lake, {}).collect()] == [("stg_gone_tbl", "gone", 3)]
