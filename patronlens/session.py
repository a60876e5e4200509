"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", app: str = "patronlens", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the one that ``spark.checkpoint.dir`` names, which all executors can reach.

    It goes when the application ends. Only a local session may do without the
    setting and gets a temporary folder: on a cluster a machine-local folder would be
    lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="patronlens-")
        context.setCheckpointDir(folder)
    own = f"{folder.rstrip('/')}/patronlens-{context.applicationId}"
    if own not in _own_folders:
        _own_folders.add(own)
        path = context._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return own


_own_folders: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, which cuts its lineage.

    A table rather than ``checkpoint()``: it is columnar, later steps read only
    the columns they use, its size is known to the planner, and it does not
    carry the constraints of the plan that made it. Those add up from round to
    round in an iterative operator until planning takes longer than the work.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove the files of a table from ``materialize`` that nothing reads any more, before the application ends."""
    spark = table.sparkSession
    jvm, own = spark.sparkContext._jvm, shared_folder(spark).rsplit("/", 1)[-1]
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        if path.getParent().getName() == own and path.getName().startswith("table-"):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def for_iteration(df: DataFrame) -> DataFrame:
    """``df`` made ready for many passes: lineage cut first, then kept in storage.

    Without the cut, every job of an iterative fit carries the whole plan that
    led to the rows, which costs more than a pass over them.
    """
    return materialize(df).persist(StorageLevel.MEMORY_AND_DISK)
