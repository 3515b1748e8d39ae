"""CSV feeds read as text, whatever is in them.

A CSV is a single file or a folder of part files whose name ends in ``.csv``.
Nothing in a feed is left out silently: cells beyond the header and bytes that are
no text stop the read unless the caller says otherwise, and ``csv_rejects`` shows
the rows of another width.
"""

from __future__ import annotations

import csv as python_csv
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import is_blank
from . import records

# How the bulk files that hold the long table are named, and the folder archives add.
LONG_TABLE_SUFFIX = "E_All_Data_(Normalized).csv"
ARCHIVE_FOLDER = "__MACOSX"
QUOTING = {"quote": '"', "escape": '"'}
POSITION = "_position"
RECORD = "_record"
FAULT = "_fault"
SURPLUS, OTHER_WIDTH = "surplus", records.OTHER_WIDTH
REPLACEMENT = "�"
HEADERS_AT_ONCE = 16


SCHEME = r"^[A-Za-z0-9+.-]+:/*"


def _plain(path: str) -> str:
    """A path without its scheme, which different calls spell differently."""
    return re.sub(SCHEME, "/", path).rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop path, qualified, and its file system."""
    raw = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = raw.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(raw), system


def csv_names(spark: SparkSession, folder: str) -> list[str]:
    """Names, relative to ``folder``, of all CSVs below it, sorted; [""] if it is a CSV itself.

    The file system lists the names, so none is hidden, whatever it begins with.
    """
    root = folder.rstrip("/")
    if root.lower().endswith(".csv"):
        return [""]
    path, system = _hadoop(spark, root)
    files, found = system.listFiles(path, True), set()
    while files.hasNext():
        below = _plain(files.next().getPath().toString())[len(_plain(path.toString())) :]
        name = re.match(r"(?i)/(.*?\.csv)(/|$)", below)
        if name and ARCHIVE_FOLDER not in name[1].split("/"):
            found.add(name[1])
    return sorted(found)


def _join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}" if name else folder


def readable(spark: SparkSession, path: str) -> str:
    """A path that Spark's readers take.

    They pass over names that begin with ``_`` or ``.``; such a file gets a link of
    another name in a mount table of this session.  Nothing is copied.
    """
    name = path.rstrip("/").split("/")[-1]
    if not name.startswith(("_", ".")):
        return path
    mounts = f"csv{uuid.uuid4().hex}"
    target = _hadoop(spark, path)[0].toUri().toString()
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{mounts}.link./shown.csv", target)
    return f"viewfs://{mounts}/shown.csv"


@dataclass(frozen=True)
class LongTable:
    """The CSV to read, and others of the standard name that are not read."""

    path: str
    passed_over: tuple[str, ...] = ()


def find_long_table(spark: SparkSession, folder: str) -> LongTable:
    names = [n for n in csv_names(spark, folder) if "/" not in n]
    if not names:
        raise FileNotFoundError(f"no csv in {folder}")
    if len(names) > 1:
        names = [n for n in names if n.endswith(LONG_TABLE_SUFFIX)]
    if not names:
        raise FileNotFoundError(f"several csv in {folder}, none named *{LONG_TABLE_SUFFIX}")
    return LongTable(_join(folder, names[0]), tuple(names[1:]))


def long_table_csv(spark: SparkSession, folder: str) -> str:
    """The only CSV directly in a folder, else the first one with the standard long-table name."""
    return find_long_table(spark, folder).path


def named_csv(folder: str, names: Sequence[str], name: str) -> str:
    """The one CSV called ``name`` among the listed ones."""
    if list(names) == [""]:
        return folder
    matches = [n for n in names if n.split("/")[-1] == name]
    if not matches:
        raise FileNotFoundError(f"no {name} below {folder}")
    if len(matches) > 1:
        raise ValueError(f"several {name} below {folder}: {matches}")
    return _join(folder, matches[0])


def csv_by_name(spark: SparkSession, folder: str, name: str) -> str:
    """The one CSV called ``name`` at any depth below ``folder``."""
    return named_csv(folder, csv_names(spark, folder), name)


def all_csvs(spark: SparkSession, folder: str) -> list[str]:
    """Every CSV below a folder."""
    names = csv_names(spark, folder)
    if not names:
        raise FileNotFoundError(f"no csv below {folder}")
    return [_join(folder, n) for n in names]


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a CSV, qualified as Spark names them: itself, or the part files of a folder that hold something."""
    place, system = _hadoop(spark, path)
    if not system.getFileStatus(place).isDirectory():
        return [place.toUri().toString()]
    return sorted(p.getPath().toUri().toString() for p in system.listStatus(place)
                  if not p.getPath().getName().startswith(("_", ".")) and p.getLen() > 0)


def _never_split(spark: SparkSession, paths: Sequence[str]) -> bool:
    """Whether all files of some CSVs are compressed in a way that one task has to read each."""
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    splittable = spark._jvm.java.lang.Class.forName("org.apache.hadoop.io.compress.SplittableCompressionCodec")
    files = [file.rsplit("/", 1)[-1] for path in paths for file in _data_files(spark, path)]
    found = [codecs.getCodec(spark._jvm.org.apache.hadoop.fs.Path(f"x{ending}")) for ending in {re.search(r"(\.[^.]*)?$", file)[0] for file in files}]
    return bool(found) and all(codec is not None and not splittable.isInstance(codec) for codec in found)


def _first_record(spark: SparkSession, path: str, encoding: str) -> str:
    """The first record of a CSV, read from the file system without a job; a few lines at most."""
    place, system = _hadoop(spark, path)
    if system.getFileStatus(place).isDirectory():
        parts = _data_files(spark, path)
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(parts[0])) if parts else None
    if place is None:
        raise ValueError(f"{path} is empty")
    java, stream = spark._jvm.java.io, system.open(place)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(place)
    reader = java.BufferedReader(java.InputStreamReader(stream if codec is None else codec.createInputStream(stream), encoding))
    try:
        record = None
        while record is None or not record.strip() or re.search(records.OPENS, record):
            line = reader.readLine()
            if line is None:
                break
            record = line if record is None or not record.strip() else f"{record}\n{line}"
    finally:
        reader.close()
    if record is None or not record.strip():
        raise ValueError(f"{path} is empty")
    return record


def csv_header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    """Header cells, trimmed and without a byte order mark; blank ones become ``unnamed_{i}``."""
    record = _first_record(spark, path, encoding).lstrip("\ufeff")
    cells = next(python_csv.reader([record + "\n"] if "\n" not in record else record.splitlines(keepends=True)))
    return [cell.replace("\ufeff", "").strip() or f"unnamed_{i}" for i, cell in enumerate(cells)]


def has_multiline_cells(spark: SparkSession, *paths: str, encoding: str = "UTF-8") -> bool:
    """Whether some record spans lines or has text after a closing quote, so that its lines cannot be read one by one."""
    if not records.splittable(encoding):
        return True
    return records.needs_records(records.lines_of(spark, [readable(spark, p) for p in paths], encoding))


def _cells(spark: SparkSession, paths: Sequence[str], width: int, multiline: bool, encoding: str, cells: bool = True, texts: bool = True) -> DataFrame:
    """Columns c0, c1, ..., the raw text and the fault of records that are not as the header says, and where each row stands.

    Without ``cells`` the columns may be empty, without ``texts`` the raw text of records that lose no content.
    """
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(width)]
    schema = T.StructType([*fields, T.StructField(RECORD, T.StringType())])
    options = {"columnNameOfCorruptRecord": RECORD, "mode": "PERMISSIVE", **QUOTING}
    shown = [readable(spark, p) for p in paths]
    if multiline and records.splittable(encoding):
        found = records.records_of(records.lines_of(spark, shown, encoding), width, cells=cells, texts=texts, whole=_never_split(spark, shown))
        done = F.col("done")
        # a record that is done has a comma
        body = found.where((F.col("at") > F.col("head")) & (done | ~is_blank(F.col("record"))))
        text = F.when(~done, F.regexp_replace("record", "\r$", ""))
        rows = body.withColumns({"text": text, POSITION: F.struct("file", "at.block", "at.line")}).drop("file", "at", "head")
        read = rows.select("*", _once(F.from_csv("text", ", ".join(f"`{f.name}` string" for f in schema), {**options, "multiLine": "true"})).alias("r"))
        fault = F.when(done, F.col("kind")).otherwise(F.coalesce("kind", _width_fault(F.col(f"r.{RECORD}"), width)))
        told = read.select("*", _once(fault).alias(FAULT))
        raw = F.when(done, F.col("record")).otherwise(F.coalesce(f"r.{RECORD}", F.when(F.col("kind").isNotNull(), F.col("text"))))
        parsed = [F.coalesce(f.name, f"r.{f.name}").alias(f.name) if cells else F.col(f"r.{f.name}") for f in fields]
        return told.select(*parsed, raw.alias(RECORD), FAULT, POSITION)
    # all cells are parsed whatever is selected, or else the width of a record would go unseen
    options["columnPruning"] = "false"
    rows = spark.read.schema(schema).options(header=True, multiLine=multiline, encoding=encoding, **options).csv(shown)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"))
    # always true: Spark wants a column of the file read beside the record
    return rows.select("*", _width_fault(F.col(RECORD), width).alias(FAULT), place.alias(POSITION)).where(F.length(F.coalesce("c0", F.lit(""))) >= 0)


def _once(value: Column) -> Column:
    """A value that is computed once a row: without this a filter on it computes it again, for each time it names it."""
    return F.explode(F.array(value))


def _beyond(cells: Column, width: int | Column) -> Column:
    """Whether there is content beyond the first ``width`` cells."""
    return F.size(F.filter(cells, lambda c, k: (k >= width) & ~is_blank(c))) > 0


def _raw_cells(record: Column) -> Column:
    """The cells of a record, quoted ones set aside, to count them."""
    return F.split(F.regexp_replace(record, records.QUOTED_CELL, "q"), ",", -1)


def _width_fault(record: Column, width: int) -> Column:
    """"surplus" where a record of another width has content beyond the header, else "other width"."""
    surplus = _beyond(_raw_cells(record), width)
    return F.when(record.isNotNull(), F.when(surplus, F.lit(SURPLUS)).otherwise(F.lit(OTHER_WIDTH)))


def _no_text(cells: Iterable[Column]) -> Column:
    found = F.lit(False)
    for c in cells:
        found = found | F.coalesce(F.contains(c, F.lit(REPLACEMENT)), F.lit(False))
    return found


def _stopping(rows: DataFrame, fault: Column, message: Column) -> DataFrame:
    return rows.where(F.when(fault, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def _without_loss(cells: DataFrame, shown: str, surplus: str) -> DataFrame:
    """Rows without those that lose content, which stop the read unless they are left to ``csv_rejects``."""
    loses = F.coalesce(F.col(FAULT) != OTHER_WIDTH, F.lit(False))
    if surplus != "fail":
        return cells.where(~loses)
    fault = F.when(F.col(FAULT) == SURPLUS, F.lit("more cells than the header")).otherwise(F.concat(FAULT, F.lit(" record")))
    return _stopping(cells, loses, F.concat(F.lit(f"{shown}: "), fault, F.lit(": "), F.substring(F.coalesce(RECORD, F.lit("")), 1, 500)))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    rename: dict[str, str] | None = None,
    drop: Iterable[str] = (),
    require: Iterable[str] = (),
    multiline: bool | None = None,
    position: bool = False,
    encoding: str = "UTF-8",
    surplus: str = "fail",
    bad_bytes: str = "fail",
) -> DataFrame:
    """All cells as text.

    Columns are read by position and named after the header, so names that
    differ only in case survive until ``rename`` and ``drop`` (matched with
    their case) have sorted them out.  Several paths must share one header.
    ``multiline=None`` finds out whether records span lines; either way a file is
    split over tasks, but for records that span lines in an encoding of several bytes
    a letter other than UTF-8.  ``position`` adds a column that orders rows as they
    stand in the files.

    A quote within a cell that has none at its beginning is a letter.  Records that
    lose content stop the read (``surplus="fail"``) or are left to ``csv_rejects``
    (``"reject"``): those with cells beyond the header, with text after a closing
    quote, or in a quoted cell that is never closed.  A shorter record is filled with
    NULL, as the format's readers do, and ``csv_rejects`` lists it too.  Bytes that
    are not of the encoding stop the read unless ``bad_bytes="keep"``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    header = csv_header(spark, paths[0], encoding)
    missing = [c for c in (*require, *(rename or {}), *drop) if c not in header]
    if missing:
        raise KeyError(f"{paths[0]} lacks columns {missing}, has {header}")
    if multiline is None:
        multiline = has_multiline_cells(spark, *paths, encoding=encoding)
    cells = _without_loss(_cells(spark, paths, len(header), multiline, encoding, texts=False), paths[0], surplus)
    kept = [i for i, name in enumerate(header) if name not in drop]
    if bad_bytes == "fail":
        cells = _stopping(cells, _no_text(F.col(f"c{i}") for i in kept), F.lit(f"{paths[0]}: bytes that are not {encoding}"))
    names = [(rename or {}).get(header[i], header[i]) for i in kept]
    columns = [F.col(f"c{i}") for i in kept]
    if position:
        return cells.select(*columns, POSITION).toDF(*names, POSITION)
    return cells.select(*columns).toDF(*names)


def csv_headers(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8") -> dict[str, list[str]]:
    """The header of each CSV; many files are opened at a time."""
    with ThreadPoolExecutor(max_workers=HEADERS_AT_ONCE) as pool:
        return dict(zip(paths, pool.map(lambda path: csv_header(spark, path, encoding), paths)))


def read_csvs(spark: SparkSession, headers: dict[str, list[str]], *, multiline: bool | None = None, encoding: str = "UTF-8",
              surplus: str = "fail", bad_bytes: str = "fail") -> DataFrame:
    """CSVs of any headers (by path) as one table of all their columns, in one scan; columns a file lacks are NULL.

    Every row's cells are read by place.  A small table says, for each file, how wide
    it is and where it has each column; rows meet it by their file's name and pick
    their cells.  So the plan is the same for two headers and for a thousand.
    Faults are told as ``read_csv`` tells them.
    """
    for path, header in headers.items():
        twice = sorted(name for name, n in Counter(header).items() if n > 1)
        if twice:
            raise ValueError(f"{path} has columns twice: {twice}")
    paths = list(headers)
    columns = list(dict.fromkeys(name for header in headers.values() for name in header))
    widest = max(map(len, headers.values()))
    if multiline is None:
        multiline = has_multiline_cells(spark, *paths, encoding=encoding)
    shown = [readable(spark, p) for p in paths]
    files = [(file, path) for path, visible in zip(paths, shown) for file in _data_files(spark, visible)]
    places = {path: {name: k for k, name in enumerate(header)} for path, header in headers.items()}
    table = spark.createDataFrame(pa.table({
        "_file": pa.array([_plain(file) for file, _ in files], pa.string()), "_width": pa.array([len(headers[path]) for _, path in files], pa.int32()),
        "_at": pa.array([[places[path].get(name) for name in columns] for _, path in files], pa.list_(pa.int32()))}))
    rows = _cells(spark, shown, widest, multiline, encoding).join(table, F.regexp_replace(F.col(f"{POSITION}.file"), SCHEME, "/") == F.col("_file"))
    parsed = F.array(*[F.col(f"c{i}") for i in range(widest)])
    raw = _raw_cells(F.col(RECORD))
    surplus_here = _beyond(parsed, F.col("_width")) | F.coalesce(_beyond(raw, F.col("_width")), F.lit(False))
    other = F.when(F.col(RECORD).isNotNull() & (F.size(raw) != F.col("_width")), F.lit(OTHER_WIDTH))
    told = F.when(F.col(FAULT).isin(SURPLUS, OTHER_WIDTH) | F.col(FAULT).isNull(), F.when(surplus_here, F.lit(SURPLUS)).otherwise(other)).otherwise(F.col(FAULT))
    rows = _without_loss(rows.withColumn(FAULT, told).withColumn(RECORD, F.coalesce(RECORD, F.array_join(parsed, ","))), "one of the files", surplus)
    picked = [F.get("_cells", F.get("_at", F.lit(j))).alias(f"t{j}") for j in range(len(columns))]
    out = rows.select(parsed.alias("_cells"), "_at").select(*picked)
    if bad_bytes == "fail":
        out = _stopping(out, _no_text(F.col(f"t{j}") for j in range(len(columns))), F.lit(f"bytes that are not {encoding}"))
    return out.toDF(*columns)


def csv_rejects(spark: SparkSession, path: str, *, multiline: bool | None = None, encoding: str = "UTF-8") -> DataFrame:
    """(record, kind) of the records that are not as the header says.

    "surplus": cells with content beyond the header; "malformed": text after a closing
    quote; "unclosed": a line from a quoted cell's beginning on that no quote closes;
    "other width": shorter, or longer by empty cells only.  All but the last kind are
    missing from what ``read_csv`` reads with ``surplus="reject"``.
    """
    header = csv_header(spark, path, encoding)
    if multiline is None:
        multiline = has_multiline_cells(spark, path, encoding=encoding)
    cells = _cells(spark, [path], len(header), multiline, encoding, cells=False)
    return cells.where(F.col(FAULT).isNotNull()).select(F.col(RECORD).alias("record"), F.col(FAULT).alias("kind"))
