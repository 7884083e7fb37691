"""Session settings the operators rely on.

The operators themselves never create a session; they take DataFrames.  This
module holds the settings a job should run with and the one place that looks
up the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every job should carry.  UTC makes day boundaries and interval
# arithmetic independent of the machine; AQE coalesces the small shuffles of
# the aggregated results and splits skewed join partitions at run time.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "thermograph") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Set the runtime-changeable job settings on an existing session."""
    for k, v in JOB_CONF.items():
        if k == "spark.ui.enabled":
            continue
        spark.conf.set(k, v)
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone != "UTC":
        raise RuntimeError(f"the session's time zone is {zone}, not UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the cluster (a shared file system); a
    local fallback is created only when the setting is missing, as in tests.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not path:
        if not (context.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder on the "
                               "shared file system (a machine-local folder would be "
                               "lost with its executor)")
        # The setting can't be changed in a running session; the context's folder can.
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="thermograph-ckpt-"))
        return context.getCheckpointDir()
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's written tables, in the shared folder."""
    return os.path.join(checkpoint_dir(spark), f"scratch-{spark.sparkContext.applicationId}")


_RUN: ContextVar[str | None] = ContextVar("scratch_run", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A place for a written table.  Results are read from such tables, so they stay
    until the end of their :func:`scratch_run`, or :func:`clear_scratch`."""
    return os.path.join(scratch_root(spark), _RUN.get() or "", name)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are removed at the end, when the results that read them
    have been written."""
    run = f"run-{uuid.uuid4().hex}"
    before = _RUN.set(run)
    try:
        yield
    finally:
        _RUN.reset(before)
        delete_path(spark, os.path.join(scratch_root(spark), run))


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables that this application has written between its stages; to be
    called when its results are written."""
    delete_path(spark, scratch_root(spark))


# Inputs up to this estimated size take the simple plans (one window partition
# per key): a single task handles them comfortably, so the hot-key machinery
# would only add stages.  Larger inputs take the bucketed plans.
SMALL_INPUT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df) -> int | None:
    """The optimizer's size estimate of ``df`` (from file sizes for scans);
    no job is run.  None when unavailable."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:
        return None


def is_small(df, limit: int | None = None) -> bool:
    """True only when the estimate exists and is at most ``limit`` (default
    ``spark.thermograph.smallInputBytes`` or 64 MiB).  Unknown means large."""
    if limit is None:
        conf = df.sparkSession.conf.get("spark.thermograph.smallInputBytes", None)
        limit = int(conf) if conf else SMALL_INPUT_BYTES
    est = estimated_bytes(df)
    return est is not None and est <= limit


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder on any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def key_parts(key: str) -> dict:
    """Two columns standing for ``key`` in partitioning and joins:
    ``_kn`` (key is null) and ``_kv`` (key as text, '' when null).  They group
    exactly as the key does (null keys together, apart from '') and make
    joins on null keys plain equi-joins, so a join on them reuses a window's
    partitioning on them instead of shuffling again."""
    from pyspark.sql import functions as F
    return {"_kn": F.col(key).isNull(), "_kv": F.coalesce(F.col(key).cast("string"), F.lit(""))}


def join_null_safe(left, right, keys: list[str], how: str = "left"):
    """Equi-join on ``keys`` where null keys match each other (``<=>``), as
    grouping and window partitioning treat them; the right key columns are
    dropped.  Still an equi-join for the planner (hash / sort-merge)."""
    from functools import reduce

    from pyspark.sql import functions as F

    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])
