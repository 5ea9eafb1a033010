"""Session helpers: settings, checkpoint folder and scratch paths."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # Checkpoints are removed once their DataFrames are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    app_name: str = "orderlake",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session with the settings the jobs assume.

    Cluster-level settings (storage credentials, executor sizes, shuffle
    partition count) come from the submitter, not from here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The folder comes from ``spark.checkpoint.dir``. Only a local session
    with no folder configured (tests) gets a temporary one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="orderlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_OWNED: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("owned_scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint folder for intermediate tables."""
    path = f"{checkpoint_dir(spark)}/orderlake-scratch/{name}-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file in whatever store it is in; returns whether it was there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(where) and fs.delete(where, True))


@contextlib.contextmanager
def owned_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders that this thread asks for inside, also after an error.

    Nothing made inside may still be read afterwards.
    """
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for path in paths:
            delete_path(spark, path)


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for what is planned inside."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


#: Small splits of files that hold a month each: a task has few months, and sorts them in memory.
GROUPED = {"spark.sql.files.maxPartitionBytes": str(32 << 20)}
#: Spark deletes a query's shuffle files as soon as it has ended, not when the driver happens to collect its garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this application's scratch folder (positions tables, landed
    test files). Call it once no DataFrame still reads from it, e.g. after a
    pipeline's writes have finished. Returns whether anything was removed."""
    return delete_path(spark, f"{checkpoint_dir(spark)}/orderlake-scratch")
