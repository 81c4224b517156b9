"""Session settings the jobs depend on."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

WORK_DIR_SETTING = "spark.checkpoint.dir"

_SETTINGS = threading.RLock()


def build_session(app_name: str = "eventlake", master: str | None = None, **conf) -> SparkSession:
    """A session for these jobs. Pass Spark settings as ``{"spark.x.y": value}`` keywords."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Event times carry a literal ``Z`` that the parser does not interpret, so the
    session zone has to be UTC for the parsed instant, date and hour to be right."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Set a runtime setting for the duration of one write.

    Settings belong to the session, so threads that share one take turns.
    """
    with _SETTINGS:
        before = spark.conf.get(key, None)
        spark.conf.set(key, value)
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream progress.

    Clusters name it in ``spark.checkpoint.dir``. Only a local session without the
    setting gets a folder of its own, since there every task sees the same disk.
    """
    context = spark.sparkContext
    folder = spark.conf.get(WORK_DIR_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {WORK_DIR_SETTING} to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="eventlake-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/eventlake"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files, on whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder; nothing is created yet."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
