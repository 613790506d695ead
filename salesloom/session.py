"""Session settings the jobs are written for."""

from __future__ import annotations

import os
import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Join strategy, partition counts and hot partitions are settled at run time
    # from measured shuffle sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join side is sent to every executor only if its size is below this.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # The 50-column feed makes generated methods too long for the JIT compiler;
    # beyond this many bytes Spark falls back to smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Do not record a Python stack for every column expression of a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings above; keyword settings win.

    ``spark.sql.shuffle.partitions`` is left to the cluster's configuration: it
    is the starting count that adaptive execution merges down from, so on 100 TB
    give it tens of thousands.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_directory(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A session without ``spark.checkpoint.dir`` uses a folder beside its tables, in the
    warehouse, which all executors reach too.
    """
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    )


_WRITTEN: dict[str, list[str]] = {}


def hadoop_path(spark: SparkSession, name: str):
    """A path and its file system, whatever store it is in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def file_state(spark: SparkSession, names: Sequence[str]) -> tuple:
    """Size and time of each file or folder: changes when an input is replaced."""
    state = []
    for name in names:
        path, system = hadoop_path(spark, name)
        content = system.getContentSummary(path)
        state.append((
            content.getLength(), content.getFileCount(),
            system.getFileStatus(path).getModificationTime(),
        ))
    return tuple(state)


def remove_folder(spark: SparkSession, name: str) -> None:
    path, system = hadoop_path(spark, name)
    system.delete(path, True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, deleted by ``remove_materialized``."""
    folder = f"{shared_directory(spark).rstrip('/')}/{name}-{os.urandom(8).hex()}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def remove_materialized(spark: SparkSession) -> None:
    """Delete what ``materialize`` and ``scratch_folder`` have written in this application."""
    for name in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        remove_folder(spark, name)


METHODS = "spark.sql.codegen.hugeMethodLimit"
# What holds while a table is written, in sessions that were not built here too.
WHILE_WRITING = {
    # Methods that the JIT compiler takes.
    METHODS: SETTINGS[METHODS],
    # A written table needs its shuffles no more: their files would lie on the executors' disks until
    # the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
_writers: dict[str, tuple[int, dict[str, str]]] = {}
_writers_lock = threading.Lock()


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """``WHILE_WRITING`` for as long as any thread of the application is in here."""
    application = spark.sparkContext.applicationId
    with _writers_lock:
        n, held = _writers.get(application, (0, {}))
        if not n:
            held = {name: spark.conf.get(name) for name in WHILE_WRITING}
            for name, value in WHILE_WRITING.items():
                if name != METHODS or int(held[name]) > int(value):
                    spark.conf.set(name, value)
        _writers[application] = n + 1, held
    try:
        yield
    finally:
        with _writers_lock:
            n, held = _writers.pop(application)
            if n > 1:
                _writers[application] = n - 1, held
            else:
                for name, value in held.items():
                    spark.conf.set(name, value)


small_methods = writing  # its name when that was all it held


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For inputs that many branches of one report read: the branches then scan only
    their columns of a table that outlives any executor.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    with writing(spark):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def side_by_side(
    spark: SparkSession, actions: Mapping[str, Callable[[], object]], at_a_time: int = 4
) -> dict:
    """Run independent actions on one session together; results by name.

    Writing one small table leaves most of a cluster idle.
    """
    with ThreadPoolExecutor(at_a_time) as pool:
        running = {n: pool.submit(inheritable_thread_target(spark)(a)) for n, a in actions.items()}
        return {n: done.result() for n, done in running.items()}
