"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import contextlib
import contextvars
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def build_session(app_name: str = "tracelake", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on.

    Only semantics (UTC) and adaptive execution are fixed here; sizing stays
    with the cluster unless passed in ``conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # recording the Python call site of every column costs more than planning
        "spark.sql.dataFrameQueryContext.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Where a local session names none (tests) a fresh temporary folder is taken,
    once per session. On a cluster it has to be set: a local folder there is
    another one on every machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tracelake-"))
    return context.getCheckpointDir()


_scratch: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder name under the shared folder that nothing else uses."""
    parent = _scratch.get() or shared_folder(spark).rstrip("/")
    return f"{parent}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Side tables written inside are deleted at the end, also after a failure.

    For work that is finished then, such as a micro-batch whose results are
    committed: nothing that reads these tables may be used afterwards.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the library's own, if it is there."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
