"""Session settings, and the shared folder where intermediate tables live."""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_turn = threading.Lock()  # models may be fitted by several threads
_scopes = threading.local()  # `open`: paths of what is written inside each call of `alone`


def build_session(app: str = "tabloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (UTC, AQE, skew joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a folder made here; a cluster
    without it is an error, because a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tabloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, in a folder of this application.

    The file system removes that folder when the driver's JVM ends.
    """
    context = spark.sparkContext
    root = f"{shared_folder(spark)}/tabloom/{context.applicationId}"
    with _turn:
        if getattr(context, "_tabloom_scratch", None) != root:
            path = context._jvm.org.apache.hadoop.fs.Path(root)
            files = path.getFileSystem(context._jsc.hadoopConfiguration())
            files.mkdirs(path)
            files.deleteOnExit(path)
            context._tabloom_scratch = root
    return f"{root}/{label}-{uuid.uuid4().hex}"


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writes: dict[str, int | str] = {"running": 0}


@contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """DROP_SHUFFLES is on; the last of the writes beside one another puts the setting back."""
    with _turn:
        if not _writes["running"]:
            _writes["before"] = spark.conf.get(DROP_SHUFFLES, "false")
            spark.conf.set(DROP_SHUFFLES, "true")  # read when a write is planned
        _writes["running"] += 1
    try:
        yield
    finally:
        with _turn:
            _writes["running"] -= 1
            if not _writes["running"]:
                spark.conf.set(DROP_SHUFFLES, _writes["before"])


def written(df: DataFrame, label: str = "table", **options: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back.

    What was shuffled for it isn't read again, so Spark removes those files after the write. `options` are the writer's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with _dropping_shuffles(spark):
        df.write.options(**options).parquet(path)
    for inner in _scopes.__dict__.get("open", [])[-1:]:
        inner.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._tabloom_path = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Remove the files of written tables that nothing reads any more."""
    for table in tables:
        _remove(table.sparkSession, [table._tabloom_path])


def alone(make: Callable[[], DataFrame], label: str = "table") -> DataFrame:
    """The rows that `make` gives, written. What it wrote on the way is removed then: nothing else may read it."""
    _scopes.__dict__.setdefault("open", []).append(inner := [])
    try:
        rows = make()
    finally:
        _scopes.open.pop()
    table = written(rows, label)
    _remove(table.sparkSession, inner)
    return table


def _remove(spark: SparkSession, paths: list[str]) -> None:
    context = spark.sparkContext
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package: once per context, through Spark's file server."""
    context = spark.sparkContext
    with _turn:
        if not getattr(context, "_tabloom_shipped", False):
            root = Path(__file__).parent
            folder = tempfile.mkdtemp(prefix="tabloom-code-")
            context.addPyFile(shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name))
            context._tabloom_shipped = True
