"""Session helpers: building a local session and locating a durable scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "vinculum") -> SparkSession:
    """A session with AQE on and the UI off, for tests, the bench and local runs.

    On a cluster, use the session the platform gives you; nothing here is required.
    """
    master = master or os.environ.get("VINCULUM_MASTER", "local[*]")
    builder = SparkSession.builder
    event_dir = os.environ.get("VINCULUM_EVENT_LOG_DIR")
    if event_dir:  # stage and task times for offline inspection (no UI)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir).config("spark.eventLog.compress", "false")
    return (
        builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VINCULUM_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and stage tables.

    Uses the session's ``spark.checkpoint.dir`` (or a directory already set on the
    context).  Only a local-mode session without one gets a fresh folder under the
    system temp dir; a cluster session without the setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        sc = None
    if sc is None:
        if conf:
            return conf
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        path = tempfile.mkdtemp(prefix="vinculum-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
        return path
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
    path = tempfile.mkdtemp(prefix="vinculum-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: Stage folder of this process below each checkpoint folder.
_FOLDERS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a stage table, in this process's own folder below the shared checkpoint folder.

    No other process reads it; :func:`drop_scratch` removes the folder, at the latest when the
    process ends.
    """
    base = checkpoint_dir(spark).rstrip("/")
    if base not in _FOLDERS:
        _FOLDERS[base] = f"{base}/vinculum-{uuid.uuid4().hex}"
        atexit.register(_drop_at_exit, spark)
    return f"{_FOLDERS[base]}/{name}"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder on its Hadoop-compatible file system; False if there was none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.delete(p, True))


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its file system, as table locations need it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def names_in(spark: SparkSession, path: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in fs.listStatus(p)]


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def drop_scratch(spark: SparkSession) -> None:
    """Delete this process's stage tables; DataFrames that read them end with it."""
    folder = _FOLDERS.pop(checkpoint_dir(spark).rstrip("/"), None)
    if folder:
        delete_path(spark, folder)


def _drop_at_exit(spark: SparkSession) -> None:
    if spark.getActiveSession() is not None and spark.sparkContext._jsc is not None:
        drop_scratch(spark)


_SHIPPED: set[str] = set()


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started from.

    On one machine the workers get the package's folder on their path; on a cluster the package
    travels once per application as a zip file.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.master.startswith("local"):
        paths = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            sc.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    elif sc.applicationId not in _SHIPPED:
        _SHIPPED.add(sc.applicationId)
        name = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", root, name))
