"""Session construction for local runs and tests, and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "songpulse",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE (coalescing + skew-join splitting) on and the UI off.

    On a cluster, pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the input (roughly input bytes / 200 MB).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is also the only executor, so give it the memory.
        conf["spark.driver.memory"] = os.environ.get("SONGPULSE_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session (a test) may name none: it gets a private folder. On a cluster that would
    be each machine's own disk, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        try:  # DataFrame.checkpoint() needs the context to know the folder too
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(root)
        except Exception:  # no SparkContext on this kind of session
            pass
        return root
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="songpulse-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared checkpoint folder for sinks of one run."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}songpulse/{name}-{uuid.uuid4().hex[:12]}"


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly in ``path`` on its file system; empty if it does not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder to a path that does not exist yet; the folder above it is made."""
    jvm = spark._jvm.org.apache.hadoop.fs
    source, target = jvm.Path(path), jvm.Path(to)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise FileExistsError(f"{path} cannot be moved to {to}")


def set_file_times(spark: SparkSession, path: str, second: int) -> bool:
    """Give the files directly in ``path`` this time of modification; false if their store does not keep it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    files = [f.getPath() for f in fs.listStatus(p) if f.isFile()]
    try:
        for f in files:
            fs.setTimes(f, second * 1000, -1)
    except Py4JJavaError:  # a store that refuses
        return False
    return all(fs.getFileStatus(f).getModificationTime() // 1000 == second for f in files)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for tests that look at files directly)."""
    return path[5:] if path.startswith("file:") else path

