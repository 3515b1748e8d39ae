"""Session settings the library is written for."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Spark decides on broadcasts from sizes it knows or measures; the library
    # itself never forces one.  Beyond the threshold the joins shuffle, and the
    # skew settings split hot keys.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    # Methods above this size are not compiled by the JVM; Spark then splits them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_lock = threading.Lock()
_inside: dict[SparkSession, list] = {}


@contextmanager
def compiled_in_parts(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside have the method limit of SETTINGS, also in a session that was not built with them.

    A stage above it (a view of many columns) is then run from smaller methods, which
    the JVM compiles; else it interprets the large one, at a third of the speed.  The
    session's own value is back when the last of several threads leaves.
    """
    with _lock:
        held = _inside.setdefault(spark, [0, spark.conf.get(_LIMIT)])
        held[0] += 1
        if int(held[1]) > int(SETTINGS[_LIMIT]):
            spark.conf.set(_LIMIT, SETTINGS[_LIMIT])
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(_LIMIT, held[1])
                del _inside[spark]


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, as --py-files would."""
    context = spark.sparkContext
    if getattr(ship, "sent", None) == context.applicationId:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = shutil.make_archive(
        os.path.join(folder, "indicatorlake-code"), "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(name)
    ship.sent = context.applicationId


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder the cluster names for checkpoints.

    A session on one machine (tests, a laptop) that names none gets a local folder,
    removed when Python ends; on a cluster that is an error, since executors would
    not see each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        shared = _own_folder(spark)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_own: dict[str, str] = {}


def _own_folder(spark: SparkSession) -> str:
    """One local folder for each application."""
    application = spark.sparkContext.applicationId
    if application not in _own:
        folder = tempfile.mkdtemp(prefix="indicatorlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own[application] = "file://" + folder
    return _own[application]


def written(df: DataFrame, purpose: str, rows_a_file: int = 0) -> DataFrame:
    """The same rows, written to the shared folder and read back; large rows in files of so many at most.

    For small results that later plans use more than once or join to facts: they
    are computed once, survive lost executors, and Spark knows their size, so it
    can tell whether to broadcast them.
    """
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.option("maxRecordsPerFile", rows_a_file).parquet(folder)
    return df.sparkSession.read.parquet(folder)


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def discard(df: DataFrame) -> None:
    """Delete the scratch results that a frame reads, once nothing reads them any more."""
    spark = df.sparkSession
    folders = {m[0] for m in (re.match(r".*/[a-z-]+-[0-9a-f]{32}(?=/)", path) for path in df.inputFiles()) if m}
    shared = scratch_folder(spark, "x").rsplit("/", 1)[0]
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if _bare(folder).rsplit("/", 1)[0] == _bare(shared):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _bare(path: str) -> str:
    return re.sub(r"^[A-Za-z0-9+.-]+:/*", "/", path)
