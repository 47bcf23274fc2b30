"""Session settings and the shared folder for materialised steps."""

from __future__ import annotations

import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings that suit both a laptop and a cluster; sizes stay with the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Stream state on local disk with snapshots in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A batch adds its changes to the checkpoint, not the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Call-site capture per column expression only slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "basketry", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is absent and everything runs on one machine, as in
    tests, a temporary folder takes its place; on a cluster its absence raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if folder:
        if not current:
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="basketry-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scratch scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/basketry/{name}-{uuid.uuid4().hex}"
    context = spark.sparkContext
    context._basketry_scratch = [*scratch_paths(spark), path]
    for scope in _SCOPES.get():
        scope.append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """What this session has written below the shared folder so far."""
    return getattr(spark.sparkContext, "_basketry_scratch", [])


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """The paths that this thread takes inside the block, so that it can drop its own only."""
    own: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), own))
    try:
        yield own
    finally:
        _SCOPES.reset(token)


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch paths; tables that are still to be computed must not read from them."""
    context, gone = spark.sparkContext, set(paths)
    for path in gone:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    context._basketry_scratch = [p for p in scratch_paths(spark) if p not in gone]


def drop_scratch(spark: SparkSession, keep: list[str] = ()) -> int:
    """Delete the session's scratch paths but for ``keep``; gives the number of paths.

    For the end of a job: tables that are still to be computed may read from these paths.
    """
    paths = [p for p in scratch_paths(spark) if p not in set(keep)]
    drop_paths(spark, paths)
    return len(paths)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for the queries that are run inside the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside the block the shuffle files of a query go as it ends.

    Else they stay until the driver's garbage is collected, and a loop that writes a table in each
    round has the shuffles of all its rounds on disk.
    """
    with settings(spark, {_CLEANUP: "true"}):
        yield


def collect_garbage(spark: SparkSession) -> None:
    """Let the cluster drop shuffles and cached blocks that no table refers to any longer."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several statistics need the same shuffled table: the shuffle
    runs once, a lost executor costs a re-read only, and the written files give
    the optimiser true sizes to choose joins by.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per session.

    Functions that run in Python workers are pickled by reference, so workers
    must be able to import the package even where only the driver has it.
    """
    context = spark.sparkContext
    if getattr(context, "_basketry_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='basketry-')}/{package.name}",
                                  "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._basketry_shipped = True
