"""Session set-up and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Set on sessions this package creates. A cluster's own session keeps its settings.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: str | int = "*", app: str = "starbazaar", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_roots: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    context = spark.sparkContext
    configured = (
        spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF) or context.getCheckpointDir())
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):  # local-cluster has executors of its own
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="starbazaar-")
    return _local_roots[app]


def app_dir(spark: SparkSession) -> str:
    """This application's own subfolder; removed by the file system when the driver exits."""
    path = os.path.join(shared_dir(spark), f"starbazaar-{spark.sparkContext.applicationId}")
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        fs.mkdirs(hadoop_path)
        fs.deleteOnExit(hadoop_path)
    return path


_SCOPE = "starbazaar.work.scope"


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end, those of its threads (``inheritable_thread_target``) too.

    For work whose results are stored or on the driver by then.
    """
    context = spark.sparkContext
    outer = context.getLocalProperty(_SCOPE)
    own = uuid.uuid4().hex
    context.setLocalProperty(_SCOPE, os.path.join(outer or "", own))
    try:
        yield
    finally:
        context.setLocalProperty(_SCOPE, outer)
        remove_work(spark, own)


_short_shuffles: dict[int, tuple[int, str | None]] = {}
_switching = Lock()


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query are deleted when it ends. Otherwise they stay until the driver happens to collect its garbage.

    For loads, whose queries run once each: one that is run a second time shuffles again. Can be nested, and entered by several threads.
    """
    session = spark._jsparkSession.hashCode()
    with _switching:
        depth, before = _short_shuffles.get(session) or (0, spark.conf.get(SHUFFLE_CLEANUP_CONF, None))
        _short_shuffles[session] = depth + 1, before
        spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        with _switching:
            depth, before = _short_shuffles.pop(session)
            if depth > 1:
                _short_shuffles[session] = depth - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP_CONF)
            else:
                spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def work_path(spark: SparkSession, name: str) -> str:
    """Place of an intermediate table or file in the present ``work_scope``."""
    return os.path.join(app_dir(spark), "work", spark.sparkContext.getLocalProperty(_SCOPE) or "", name)


def remove_work(spark: SparkSession, folder: str) -> None:
    """Delete the tables whose label began with ``folder/``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_path(spark, folder))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def work_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of any executor, and gives the planner real sizes. Also what makes
    a sampled range layout stable: every later reader sees the same rows under the same partition numbers. The table
    stays until its ``work_scope`` ends, outside of one until the driver exits.
    """
    spark = df.sparkSession
    path = work_path(spark, f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
