"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rowsmith", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, taken from ``spark.checkpoint.dir``.

    Only a session inside one process without that setting gets a temporary
    folder, removed at its end; a cluster must name one, because a machine-local
    path dies with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="rowsmith-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


# Tables written to the shared folder by this process, which removes them again.
_written: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/rowsmith/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def written_since(mark: int = 0) -> list[str]:
    """Paths of intermediate tables after the first ``mark`` of them."""
    return _written[mark:]


def discard(paths) -> None:
    """Delete intermediate tables that no later result reads."""
    context = SparkContext._active_spark_context
    jvm = SparkContext._jvm
    for path in list(paths):
        if jvm is not None:
            target = jvm.org.apache.hadoop.fs.Path(path)
            conf = context._jsc.hadoopConfiguration() if context is not None else jvm.org.apache.hadoop.conf.Configuration()
            target.getFileSystem(conf).delete(target, True)
        if path in _written:
            _written.remove(path)


@atexit.register
def _discard_all() -> None:
    """Intermediate tables live as long as the process that made them."""
    try:
        discard(_written)
    except Exception:  # the session's process is gone already; nothing is left to ask
        pass


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives executor loss, is computed once, and carries its true
    file size, so the join planner decides on a broadcast from a measured size.
    It is deleted by ``discard`` or at the end of the process.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, used to cut the lineage of iterative fits."""
    shared_folder(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def side_by_side(spark: SparkSession, tasks: list[Callable], parallelism: int = 4) -> list:
    """Run independent fits at the same time; results keep the order of the tasks.

    The threads only submit Spark jobs, so a cluster is not left idle between
    the small jobs of one fit.
    """
    if len(tasks) < 2 or parallelism < 2:
        return [t() for t in tasks]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(lambda t: t(), [inheritable_thread_target(spark)(t) for t in tasks])
