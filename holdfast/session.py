"""Session settings and the shared folder for written intermediate tables."""

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "holdfast", **settings: str) -> SparkSession:
    """A session with adaptive execution on.  Keyword settings use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """A new folder for tables that one job writes and reads back.

    On a cluster it lies under `spark.checkpoint.dir`, which all executors see.
    Only a local master, where driver and executors share one disk, may fall
    back to the system's temporary folder.  It goes when the driver's JVM ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = f"{shared.rstrip('/')}/holdfast-{uuid.uuid4().hex}"
    elif spark.conf.get("spark.master", "").startswith("local"):
        path = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    system, place = _file_system(spark, path)
    system.mkdirs(place)
    system.deleteOnExit(place)
    return path


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path, in any store that Spark reads; none if it is missing."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(place) if found.isDirectory())


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table write to this folder has been completed."""
    system, place = _file_system(spark, f"{path}/_SUCCESS")
    return system.exists(place)


def move_files(spark: SparkSession, source: str, target: str, prefix: str) -> None:
    """Move the files right below a folder into another, with a prefix to their names; a missing folder has none."""
    system, place = _file_system(spark, source)
    _, goal = _file_system(spark, target)
    system.mkdirs(goal)
    for found in system.listStatus(place) if system.exists(place) else []:
        name = found.getPath().getName()
        if found.isFile() and not name.startswith(("_", ".")):
            moved = spark._jvm.org.apache.hadoop.fs.Path(goal, f"{prefix}{name}")
            if system.exists(moved) or not system.rename(found.getPath(), moved):
                raise OSError(f"cannot move {found.getPath()} to {moved}")


# How many writes of a session are dropping their shuffles now, and its setting before.
_dropping: dict[str, tuple[int, str | None]] = {}
_dropping_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let what is executed here delete its shuffle files when it ends, and not when the driver collects garbage."""
    name, session = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark._jsparkSession.sessionUUID()
    with _dropping_lock:
        count, before = _dropping.get(session) or (0, spark.conf.get(name, None))
        _dropping[session] = (count + 1, before)
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            count, before = _dropping.pop(session)
            if count > 1:
                _dropping[session] = (count - 1, before)
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """Copy a small folder, such as a checkpoint; a missing one leaves the target missing."""
    system, place = _file_system(spark, source)
    if system.exists(place):
        other, goal = _file_system(spark, target)
        files = spark._jvm.org.apache.hadoop.fs.FileUtil
        files.copy(system, place, other, goal, False, spark._jsc.hadoopConfiguration())
