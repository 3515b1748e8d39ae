"""Tables in a Spark catalog database, kept as Parquet below one shared root.

A table's name is a catalog view over a stored version: a folder, or a table of
partitions.  Every write makes a version of its own and replaces the view last, in
one catalog statement.  A job that dies before that leaves the table as it was,
readers of the old version are not disturbed, and running it again gives the same
table.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.reshape import quoted
from ..session import compiled_in_parts

#: Partition column that tells the generations of replaced keys apart; only inside versions.
GENERATION = "_generation"
FIRST = "first"
#: Old versions that ``drop_old_versions`` leaves for running readers.
KEPT_VERSIONS = 3
#: Replaced keys that a table's view names one by one.
MOST_GENERATIONS = 200


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _generations(noted: dict[str, str]) -> dict[str, str]:
    """The generation of every key that is not of the first one."""
    return dict(pair.split("\x01", 1)[::-1] for pair in noted["generations"].split("\x02") if pair)


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    database: str
    root: str

    def __post_init__(self) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(self.database)} LOCATION {_literal(self.root)}")

    def name(self, table: str) -> str:
        return f"{quoted(self.database)}.{quoted(table)}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def table_names(self) -> DataFrame:
        """Tables of this lake as (table_name); stored versions have no name of their own here."""
        return self.spark.sql(f"SHOW VIEWS IN {quoted(self.database)}").where("NOT isTemporary").select(
            F.col("viewName").alias("table_name")
        )

    def _fresh_folder(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}/{uuid.uuid4().hex}"

    def _point(self, table: str, query: str, **properties: str) -> None:
        """Let the table's name stand for a query over stored versions, in one statement."""
        noted = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} TBLPROPERTIES ({noted}) AS {query}")

    def _noted(self, table: str) -> dict[str, str]:
        return {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()}

    def publish(self, table: str, folder: str) -> None:
        """Let a table stand for the Parquet files of a folder written elsewhere, and note which one it stood for."""
        known = self._noted(table) if self.exists(table) else {}
        before = known.get("folder") if known.get("folder") != folder else known.get("before")
        noted = {"before": before} if before else {}
        self._point(table, f"SELECT * FROM parquet.{quoted(folder)}", folder=folder, **noted)

    def folder(self, table: str) -> str | None:
        """The folder a published table stands for."""
        return self._noted(table).get("folder") if self.exists(table) else None

    def before(self, table: str) -> DataFrame | None:
        """The rows of the folder a published table stood for before its present one."""
        folder = self._noted(table).get("before") if self.exists(table) else None
        return self.spark.read.parquet(folder) if folder and parquet_exists(self.spark, folder) else None

    def write(self, table: str, df: DataFrame, partition_by: str | None = None, replace: bool = True, sort_by: Iterable[str] = ()) -> int:
        """Create a table, or replace it whole; returns its number of rows.

        With ``partition_by`` the rows are rebalanced on it: files stay large, and
        a value holding a great part of all rows is split over several tasks.
        ``sort_by`` orders the rows of each file, so that readers skip row groups.
        """
        if not replace and self.exists(table):
            raise ValueError(f"table {table} exists")
        folder = self._fresh_folder(table)
        version = f"{table}__{uuid.uuid4().hex}"
        n, _ = self._store(df, f"{folder}/{GENERATION}={FIRST}" if partition_by else folder, partition_by, sort_by)
        fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)
        if partition_by:
            self.spark.sql(f"CREATE TABLE {self.name(version)} ({fields}, {quoted(GENERATION)} string) USING parquet "
                           f"PARTITIONED BY ({quoted(GENERATION)}, {quoted(partition_by)}) LOCATION {_literal(folder)} {self._made(folder)}")
            self.spark.catalog.recoverPartitions(self.name(version))
        else:
            self.spark.sql(f"CREATE TABLE {self.name(version)} ({fields}) USING parquet LOCATION {_literal(folder)} {self._made(folder)}")
        columns = ", ".join(quoted(c) for c in df.columns)
        where = f" WHERE {quoted(GENERATION)} = '{FIRST}'" if partition_by else ""
        self._point(table, f"SELECT {columns} FROM {self.name(version)}{where}", version=version, stored=folder, columns=columns, generations="")
        return n

    @staticmethod
    def _made(folder: str) -> str:
        return f"TBLPROPERTIES ('made' = '{time.time_ns()}', 'stored' = {_literal(folder)})"

    def drop_old_versions(self, table: str, keep: int = KEPT_VERSIONS) -> int:
        """Drop the versions a table does not stand for, but for the ``keep`` newest of them, with their files.

        Readers of a dropped version fail, so ``keep`` has to cover the writes that
        happen while one reads.  Published folders are not the lake's to remove.
        Returns how many were dropped.
        """
        current = self._noted(table).get("version") if self.exists(table) else None
        names = [r.tableName for r in self.spark.sql(f"SHOW TABLES IN {quoted(self.database)} LIKE '{table}__*'").collect()]
        old = [n for n in names if re.fullmatch(re.escape(table.lower()) + "__[0-9a-f]{32}", n.lower()) and n != current]
        aged = sorted(((int(self._noted(n).get("made", 0)), n) for n in old), reverse=True)
        for _, name in aged[keep:]:
            folder = self._noted(name).get("stored")
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(name)}")
            if folder:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return len(aged[keep:])

    def _store(self, df: DataFrame, folder: str, partition_by: str | None, sort_by: Iterable[str]) -> tuple[int, list[str]]:
        """Write files; the number of rows and the values of the partition column."""
        seen = Observation(f"store-{uuid.uuid4().hex}")
        values = F.collect_set(partition_by) if partition_by else F.lit(None).cast("array<string>")
        rows = df.hint("rebalance", partition_by) if partition_by else df
        if sort_by:
            rows = rows.sortWithinPartitions(*[c for c in (partition_by, *sort_by) if c])
        metrics = [F.count(F.lit(1)).alias("n"), *([values.alias("values")] if partition_by else [])]
        writer = rows.observe(seen, *metrics).write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        with compiled_in_parts(self.spark):
            writer.parquet(folder)
        found = seen.get
        return found["n"], list(found.get("values") or [])

    def replace_keys(self, table: str, df: DataFrame, key: str, values: Iterable[str], sort_by: Iterable[str] = ()) -> int:
        """Replace all rows of the given values of the partition column ``key`` by those of ``df``.

        A value with no new rows ends with none.  Only these partitions are written,
        as a generation of their own that no reader sees until the table's view says
        so for all of them at once.  Two runs may replace different keys of a table at
        a time; where another run replaced the same ones, or the table as a whole, this
        one is refused.  (Catalogs compare nothing by themselves: a change in the moment
        between this check and the next statement would go unseen.)  Beyond
        MOST_GENERATIONS replaced keys the table is stored anew as one version.
        """
        noted = self._noted(table)
        wanted = list(dict.fromkeys(values))
        generation = uuid.uuid4().hex
        rows = df.where(F.col(key).isin(*wanted))
        n, written = self._store(rows, f"{noted['stored']}/{GENERATION}={generation}", key, sort_by)
        version = self.name(noted["version"])
        added = [f"PARTITION ({quoted(GENERATION)} = '{generation}', {quoted(key)} = {_literal(v)}) "
                 f"LOCATION {_literal(f'{noted["stored"]}/{GENERATION}={generation}/{key}={_folder_name(v)}')}" for v in sorted(written)]
        if added:
            self.spark.sql(f"ALTER TABLE {version} ADD IF NOT EXISTS {' '.join(added)}")
        # what other runs did meanwhile: their keys stay theirs, a key of both is refused
        now = self._noted(table)
        seen, current = _generations(noted), _generations(now)
        if now["version"] != noted["version"] or any(seen.get(v) != current.get(v) for v in wanted):
            raise RuntimeError(f"{table} was changed by another run while this one wrote; its rows stay, nothing of this run is shown")
        current |= {v: generation if v in written else "none" for v in wanted}
        pairs = ", ".join(f"{_literal(k)}, {_literal(g)}" for k, g in sorted(current.items()))
        live = f"coalesce(element_at(map({pairs}), {quoted(key)}), '{FIRST}')" if pairs else f"'{FIRST}'"
        where = f" WHERE {quoted(GENERATION)} = {live}"
        self._point(table, f"SELECT {now['columns']} FROM {version}{where}",
                    **{**{k: now[k] for k in ("version", "stored", "columns")}, "generations": "\x02".join(f"{g}\x01{k}" for k, g in sorted(current.items()))})
        if len(current) > MOST_GENERATIONS:  # the view's text would grow with every key ever replaced
            self.write(table, self.read(table), key, sort_by=sort_by)
        return n

    def partitions(self, table: str) -> dict[str, str]:
        """The values of the partition column that a table shows, each with a mark that changes when its rows are replaced.

        From the catalog alone; a value whose rows were all replaced by none is not among them.
        """
        noted = self._noted(table)
        current, found = _generations(noted), {}
        for r in self.spark.sql(f"SHOW PARTITIONS {self.name(noted['version'])}").collect():
            generation, value = (unquote(part.split("=", 1)[1]) for part in r.partition.split("/"))
            if generation == current.get(value, FIRST):
                found[value] = f"{noted['version']}:{generation}"
        return found

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows, creating the table on first use."""
        if self.exists(table):
            df.write.insertInto(self.name(self._noted(table)["version"]))
        else:
            self.write(table, df)


# Fixed value: characters Spark escapes in the folder name of a partition value.
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^') | {chr(i) for i in range(1, 32)}


def _folder_name(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def version_path(root: str, agency: str, source_code: str, version: str) -> str:
    return f"{root.rstrip('/')}/{agency}/{source_code}-{version}.parquet"


def parquet_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def new_versions(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """(afs_source_code, version) pairs not stored yet."""
    keys = ["afs_source_code", "version"]
    return wanted.join(stored.select(keys).distinct(), keys, "left_anti")


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def export_files(
    df: DataFrame,
    folder: str,
    *,
    fmt: str = "parquet",
    compression: str = "snappy",
    rows_per_file: int = 5_000_000,
    clear: bool = True,
) -> int:
    """Write one table as compressed part files into a folder of its own; returns its number of rows.

    ``clear`` empties that folder first, so no shard of an earlier, larger
    export survives.
    """
    seen = Observation(f"export-{uuid.uuid4().hex}")
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
    writer = rows.write.mode("overwrite" if clear else "append").option("maxRecordsPerFile", rows_per_file)
    writer.option("compression", compression).format(fmt).save(folder)
    return seen.get["n"]


def remove_others(spark: SparkSession, folder: str, kept: str) -> None:
    """Delete what lies beside ``kept`` in its folder: files of earlier exports."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in system.listStatus(path):
        if status.getPath().getName() != kept.rstrip("/").split("/")[-1]:
            system.delete(status.getPath(), True)
