"""Shared folders for checkpoints and intermediate tables.

The folder is the one the cluster names in ``spark.checkpoint.dir``, so that what
is cut from the lineage outlives any executor.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The configured shared folder; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="reelrank-"))
        current = context.getCheckpointDir()
    return current.rstrip("/")


# Folder of this process below the shared one.
_RUN = f"run-{uuid.uuid4().hex}"


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/reelrank/{_RUN}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Remove what this process has written to the shared folder; for the end of a job."""
    _remove(spark, f"{shared_dir(spark)}/reelrank/{_RUN}")


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    path.getFileSystem(conf).delete(path, True)


#: Has Spark remove the shuffle files of a query when it ends, and not when the driver next
#: collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def durable(df: DataFrame, name: str = "table", drop_shuffles: bool = False) -> DataFrame:
    """Compute ``df`` once, keep it as a table in the shared folder and read that.

    Columnar files rather than a checkpoint of rows: later reads take only the columns they
    need, and the planner knows the size. With ``drop_shuffles`` what was shuffled on the way
    is removed once the table is there.
    """
    path = work_dir(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    if drop_shuffles:
        conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if drop_shuffles:
            conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[table] = path
    return table


_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def release(*tables: DataFrame) -> None:
    """Remove tables that :func:`durable` has written and nothing will read again.

    What has been computed from them and stored since stays; a plan that still reads one,
    even to replace lost work, fails.
    """
    for table in tables:
        if table in _folders:
            _remove(table.sparkSession, _folders.pop(table))


def sweep(spark: SparkSession) -> None:
    """Have Spark remove shuffle files and cached blocks that nothing refers to any more.

    It learns of them when the driver's garbage is collected, which a large heap puts off for
    as long as the disk fills.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
