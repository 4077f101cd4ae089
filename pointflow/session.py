"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(app: str = "pointflow", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tuned for; `conf` keys use `__` for dots.

    Nothing here is needed for right results. Adaptive execution sizes the
    shuffles, so no partition count is fixed unless the caller gives one.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="pointflow-")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder that the cluster names.

    Only a local master may fall back to a folder of this machine, since there
    every task sees it.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
