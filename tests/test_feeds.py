"""Feeds larger than a task: lines stay where they are read, parts are compressed, a record is parsed once."""

from __future__ import annotations

import gzip
import random

from indicatorlake.session import stored_bytes
from indicatorlake.sources import csv, records
from workload import ingest_cases

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_of_a_split_do_not_travel_to_become_records(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('n,what\n1,"two\nlines"\n2,b\n')
    found = plan(records.records_of(records.lines_of(spark, [str(path)])))
    assert "Window" not in found and "SortMergeJoin" not in found
    assert found.count("Exchange hashpartitioning") == 1  # of the records that a split ends in
    read = plan(csv.read_csv(spark, str(path)))
    assert read.count("from_csv") == 1


def test_feed_takes_less_than_its_text(spark):
    for make in (ingest_cases._ragged, ingest_cases._quotes):
        path = make(spark, SF)
        plain = sum(len(r.value) + 1 for r in spark.read.text(path).collect())
        assert stored_bytes(spark, path) < plain / 3


def test_header_and_rows_of_a_compressed_feed(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress('x,"two\nlines"\n1,"é\nb"\n2,"c"" d"\n'.encode()))
    assert csv.csv_header(spark, str(tmp_path / "a.csv.gz")) == ["x", "two\nlines"]
    assert sorted(map(tuple, csv.read_csv(spark, str(tmp_path / "a.csv.gz")).collect())) == [("1", "é\nb"), ("2", 'c" d')]


def test_records_over_many_batches_and_splits(spark, tmp_path):
    rows = [(k, f"a{k}\n" * (30 if k % 50 == 0 else k % 3) + 'b "c"') for k in range(400)]
    path = tmp_path / "many.csv"
    path.write_text("n,what\n" + "".join(f'{k},"{text.replace(chr(34), chr(34) * 2)}"\n' for k, text in rows))
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        for values in (("3", "128m", "4m"), ("3", "900", "1")):
            for n, v in zip(names, values):
                spark.conf.set(n, v)
            assert sorted((int(r.n), r.what) for r in csv.read_csv(spark, str(path)).collect()) == rows
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def test_compressed_files_are_read_once(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b'n,what\n1,"two\nlines"\n2,b\n'))
    for df in (csv.read_csv(spark, str(tmp_path / "a.csv.gz"), multiline=True), csv.csv_rejects(spark, str(tmp_path / "a.csv.gz"), multiline=True)):
        assert plan(df).count("FileScan text") == 1 and "Exchange" not in plan(df)


def test_compressed_and_plain_files_give_the_same_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "OPEN_BYTES", 64)
    rng = random.Random(8)
    some = ['"', '""', ",", ",", "\n", "a", " ", "\u00a0", "\r", "\0", "\u00fc", '"x"', '5" y', '\n1,"say ""so""\n",3\n', '\n"""",,""\n', '\n""x,1,2\n', "\n1,2\n", "\n1,2,3,\n"]
    for kind in ("p.csv", "z.csv"):
        (tmp_path / kind).mkdir()
    for k in range(30):
        use = some if k % 3 else [x for x in some if x not in ("\r", "\0", "\u00a0")]
        text = "x,y,z\n" + "".join(rng.choice(use) for _ in range(rng.choice([10, 100, 400])))
        text += '"\n' * (k % 2)
        (tmp_path / "p.csv" / f"{k:02}").write_bytes(text.encode())
        (tmp_path / "z.csv" / f"{k:02}.gz").write_bytes(gzip.compress(text.encode()))

    def rows(kind):
        read = csv.read_csv(spark, str(tmp_path / kind), multiline=True, surplus="reject", position=True).orderBy(csv.POSITION)
        rejected = csv.csv_rejects(spark, str(tmp_path / kind), multiline=True)
        return [(r[csv.POSITION].file[-5:][:2] if kind[0] == "z" else r[csv.POSITION].file[-2:], r.x, r.y, r.z) for r in read.collect()], sorted(map(tuple, rejected.collect()))

    plain, packed = rows("p.csv"), rows("z.csv")
    assert plain == packed
    assert {kind for _, kind in plain[1]} == {"surplus", "malformed", "unclosed", "other width"}
    assert ("1", 'say "so"\n', "3") in {r[1:] for r in plain[0]} and (None, '"') not in {r[1:3] for r in plain[0]}
    assert ('"', None, None) in {r[1:] for r in plain[0]}


def test_good_records_need_no_parser(spark, tmp_path):
    """Of a feed without surplus cells and carriage returns all records are taken apart where their lines are read."""
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(('x,y,z\n' + '1,"a ""b"" , c",\n2,5" z\n3,"in ""\n"" two",q\n4,"shut" x,y\n' * 50).encode()))
    lines = records.lines_of(spark, [str(tmp_path / "a.csv.gz")])
    found = records.records_of(lines, 3, whole=True).where("at > head").groupBy("done", "kind", "c0", "c1", "c2").count().collect()
    assert {(r.done, r.kind, r.c0, r.c1, r.c2): r["count"] for r in found} == {
        (True, None, "1", 'a "b" , c', None): 50, (True, "other width", "2", '5" z', None): 50,
        (True, None, "3", 'in "\n" two', "q"): 50, (True, "malformed", None, None, None): 50}


def test_bytes_of_another_encoding_stop_a_read_of_records(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'x,y\n"one\ntwo",2\n\xff,"three\nfour"\n')
    kept = csv.read_csv(spark, str(tmp_path / "a.csv"), bad_bytes="keep").collect()
    assert sorted(map(tuple, kept)) == [("one\ntwo", "2"), (csv.REPLACEMENT, "three\nfour")]
