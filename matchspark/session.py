"""Session helpers: a tuned local session for tests and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files (lineage cuts) are removed once no frame refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app_name: str = "matchspark", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the defaults above.

    On a cluster the session normally already exists; ``getOrCreate`` then
    returns it unchanged apart from the SQL settings applied here.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared ``spark.checkpoint.dir``.  Only a ``local`` session
    (tests), whose tasks all see one disk, gets a scratch folder when it is
    unset; on a cluster an unset folder is an error, never a machine-local one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions manage their own checkpoint folder
        return configured
    current = sc.getCheckpointDir() or configured
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="matchspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


#: Spark removes the shuffle files of a plan made under this setting when it has been executed.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def executed_once(df):
    """The frame as a plan of its own whose shuffle files go when its action ends: otherwise they stay until the
    driver's garbage collection finds them.  Execute it once only."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return df.select("*")
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


#: Tasks for each core that AQE leaves in :func:`even_tasks` where they are above its smallest size (1 MB).  By default it
#: joins the shuffle partitions to about one task a core: with one more task than cores a stage takes twice as long.
TASKS_PER_CORE = 4
MIN_TASKS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"


@contextmanager
def even_tasks(spark: SparkSession):
    """Stages of the actions inside are cut into several tasks for each core; a number that the session sets itself stays."""
    if spark.conf.get(MIN_TASKS, None):
        yield
        return
    spark.conf.set(MIN_TASKS, str(TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(MIN_TASKS)


def materialize(df):
    """Cut the lineage of a frame that later steps read several times.

    A reliable ``checkpoint`` into the session's shared checkpoint folder: the data is computed once, and a lost
    executor re-reads the checkpoint files instead of recomputing the
    whole upstream plan.  What was shuffled for it is not kept.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return executed_once(df).checkpoint(eager=True)


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system that its URL names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system its URL names."""
    where, fs = hadoop_path(spark, path)
    return bool(fs.exists(where))


def file_or_folder(spark: SparkSession, path: str) -> tuple[str, str]:
    """(folder, file name) of a path that names one file, (path, "") of a folder: streams read folders."""
    where, fs = hadoop_path(spark, path)
    if fs.getFileStatus(where).isDirectory():
        return path, ""
    return where.getParent().toString(), where.getName()


def glob_names(spark: SparkSession, pattern: str) -> list[str]:
    """Last path parts of the files that match a glob, on any file system."""
    where, fs = hadoop_path(spark, pattern)
    return sorted(f.getPath().getName() for f in (fs.globStatus(where) or []))


BROADCAST_LIMIT_BYTES = 64 << 20


def size_estimate(df, most: int = 1 << 50) -> int:
    """The optimizer's estimate of a plan's bytes, read without running a job (0 where it has none)."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no estimate available
        return 0
    return size if size < most else 0


def broadcast_if_small(df, max_bytes: int = BROADCAST_LIMIT_BYTES):
    """Broadcast hint only behind a size check: the optimizer's estimate of
    the plan's output (exact for in-memory tables, file sizes for scans),
    read without running a job.  Larger or unknown sizes get no hint and
    AQE chooses the join from measured runtime sizes."""
    from pyspark.sql import functions as F
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no estimate available
        return df
    return F.broadcast(df) if size <= max_bytes else df
