"""CSV records whatever quotes a feed holds, against a reader that goes letter by letter."""

from __future__ import annotations

import random

import pytest

from indicatorlake.operators.reshape import diagonal_union
from indicatorlake.sources import csv, records


def letter_by_letter(text):
    """(record, kind, cells) of every record."""
    out, cells, cell, record, state, bad = [], [], "", "", "start", False
    for letter in text + ("" if text.endswith("\n") else "\n"):
        if letter == "\n" and state != "quoted":
            out.append((record, "malformed" if bad else None, [*cells, cell]))
            cells, cell, record, state, bad = [], "", "", "start", False
            continue
        record += letter
        if state == "quoted":
            if letter == '"':
                state = "closed"
            else:
                cell += letter
        elif letter == ",":
            cells, cell, state = [*cells, cell], "", "start"
        elif letter == '"' and state == "start":
            state = "quoted"
        elif letter == '"' and state == "closed":
            cell, state = cell + '"', "quoted"
        else:
            bad = bad or state == "closed"
            cell, state = cell + letter, "plain"
    if state == "quoted":
        out += [(line, "unclosed", []) for line in record[:-1].split("\n")]
    return out


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_records_equal_a_reader_by_letters(spark, tmp_path, small_splits):
    rng = random.Random(3)
    expected, files = {}, []
    for k in range(24):
        letters = "".join(rng.choice(['"', '"', '""', ",", ",", "\n", "a", "b c", '"x"', '5" y']) for _ in range(rng.choice([0, 3, 30, 120])))
        if k % 3:  # otherwise most end unclosed
            letters += '"\n' * (letter_by_letter(letters)[-1:] != [] and letter_by_letter(letters)[-1][1] == "unclosed")
        path = tmp_path / f"f{k:02}.txt"
        path.write_text(letters)
        files.append(str(path))
        expected[path.name] = sorted((r, kind or "") for r, kind, _ in letter_by_letter(letters)) if letters else []
    lines = records.lines_of(spark, files)
    found = {name: [] for name in expected}
    for r in records.records_of(lines).collect():
        found[r.file.split("/")[-1]].append((r.record, r.kind or ""))
    for name, rows in expected.items():
        assert sorted(found[name]) == rows, name
    assert lines.rdd.getNumPartitions() > 24
    assert {kind for rows in expected.values() for _, kind in rows} == {"", "malformed", "unclosed"}


def test_cells_equal_a_reader_by_letters(spark, tmp_path, small_splits):
    rng = random.Random(5)
    rows = [[rng.choice(["", "a", '5" pipe', 'say "x"', "two\nlines", "a,b", '"', "é", 'q""']) for _ in range(3)] for _ in range(60)]

    def shown(cell):
        quoted = cell.startswith('"') or "," in cell or "\n" in cell or rng.random() < 0.2
        return '"' + cell.replace('"', '""') + '"' if quoted else cell

    text = "x,y,z\n" + "".join(",".join(map(shown, row)) + "\n" for row in rows)
    assert [cells for _, _, cells in letter_by_letter(text)][1:] == rows
    for encoding in ("UTF-8", "windows-1252"):
        path = tmp_path / f"{encoding}.csv"
        path.write_bytes(text.encode(encoding))
        df = csv.read_csv(spark, str(path), encoding=encoding, position=True)
        got = [[c or "" for c in r[:3]] for r in df.orderBy(csv.POSITION).collect()]
        assert got == rows


def test_quotes_within_cells_glue_no_rows(spark, tmp_path):
    rows = [f"{k},{cell}" for k, cell in enumerate(['5" pipe', *"abcdefgh", '6" pipe', "z"])]
    path = tmp_path / "pipes.csv"
    path.write_text("n,what\n" + "\n".join(rows) + "\n")
    assert sorted(f"{r.n},{r.what}" for r in csv.read_csv(spark, str(path)).collect()) == sorted(rows)
    assert csv.csv_rejects(spark, str(path)).count() == 0


def test_text_after_a_closing_quote_and_open_quotes_are_told(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text('n,what\n1,"a"b\n2,fine\n3,"never\n4,closed\n')
    with pytest.raises(Exception, match="malformed record|unclosed record"):
        csv.read_csv(spark, str(path)).collect()
    assert [tuple(r) for r in csv.read_csv(spark, str(path), surplus="reject").collect()] == [("2", "fine")]
    assert sorted(map(tuple, csv.csv_rejects(spark, str(path)).collect())) == [
        ('1,"a"b', "malformed"), ('3,"never', "unclosed"), ("4,closed", "unclosed")]


@pytest.mark.parametrize("inner", ["x" * 1_000_000, '""' * 500_000])
def test_long_cells_of_records_of_another_width(spark, tmp_path, inner):
    path = tmp_path / "long.csv"
    path.write_text(f'a,b,c\n1,"{inner}"\n2,"{inner}",3,more\n4,"{inner}",5\n6,"{inner}\n",7\n')
    kinds = {r.record[0]: r.kind for r in csv.csv_rejects(spark, str(path)).collect()}
    assert kinds == {"1": "other width", "2": "surplus"}
    kept = {r.a: len(r.b) for r in csv.read_csv(spark, str(path), surplus="reject").collect()}
    size = len(inner.replace('""', '"'))
    assert kept == {"1": size, "4": size, "6": size + 1}


def test_files_of_any_headers_are_one_scan(spark, tmp_path):
    rng = random.Random(9)
    names = [f"col {k}" for k in range(9)]
    for k in range(14):
        header = rng.sample(names, rng.randrange(1, 9))
        cells = [[rng.choice(["", "a", "b c", 'q"x', '"in, quotes"', '"two\nlines"' if k % 3 else "z"]) for _ in header] for _ in range(rng.randrange(4))]
        cells += [["cut"], ["long"] * len(header) + ["", " "]]
        (tmp_path / f"_f {k}.csv" if k % 2 else tmp_path / f"f {k}.csv").write_text(
            ",".join(header) + "\n" + "".join(",".join(row) + "\n" for row in cells))
    paths = csv.all_csvs(spark, str(tmp_path))
    headers = csv.csv_headers(spark, paths)
    together = csv.read_csvs(spark, headers)
    apart = diagonal_union([csv.read_csv(spark, p) for p in paths])
    assert together.columns == apart.columns and len(paths) == 14
    assert sorted(map(repr, together.collect())) == sorted(map(repr, apart.collect()))

    def nodes(df):
        return len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())

    few = [p for p in paths if "two" in open(p).read()][:2]
    assert nodes(csv.read_csvs(spark, {p: headers[p] for p in few}, multiline=True)) == nodes(csv.read_csvs(spark, headers, multiline=True))
    (tmp_path / "wide.csv").write_text("col 1\n1,lost\n")
    with pytest.raises(Exception, match="lost"):
        csv.read_csvs(spark, csv.csv_headers(spark, csv.all_csvs(spark, str(tmp_path)))).collect()
    kept = csv.read_csvs(spark, csv.csv_headers(spark, csv.all_csvs(spark, str(tmp_path))), surplus="reject")
    assert kept.count() == together.count()
    with pytest.raises(ValueError, match="twice"):
        csv.read_csvs(spark, {paths[0]: ["a", "a"]})
