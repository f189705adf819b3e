"""Tables cut out of a running query and written to the folder that the cluster shares.

A staged table lasts as long as a plan that reads it: ``sweep`` deletes those that nobody can read any more.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Weak references to the file lists of the staged tables, with their paths: every plan over a table holds its list.
_staged: list[tuple[object, str, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where that is unset and the master is local (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="kinfold-")
        spark.sparkContext.setCheckpointDir(folder)
        _delete_at_exit(folder)
    return folder


def _delete_at_exit(folder: str) -> None:
    import shutil

    atexit.register(shutil.rmtree, folder.removeprefix("file://"), ignore_errors=True)


def stage(df: DataFrame, name: str, *, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    The lineage ends at the files, so a lost executor costs only the tasks that were
    running, and what follows can read the table more than once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/kinfold-{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return written(spark, path, df.schema)


def written(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table of ours in the shared folder, which ``sweep`` deletes when nobody can read it any more."""
    table = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    files = table._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    _staged.append((spark._jvm.java.lang.ref.WeakReference(files), path, spark.sparkContext.applicationId))
    return table


def sweep(spark: SparkSession) -> int:
    """Delete the staged tables that no DataFrame of this application can reach; how many went.

    Any frame derived from a table keeps it, in Python or on the JVM's side; garbage is collected first to tell.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for _ in range(3):  # what has just run is let go a moment later
        gc.collect()
        jvm.System.gc()
        time.sleep(0.05)
    kept, gone = [], 0
    for entry in _staged:
        reference, path, application = entry
        if application != spark.sparkContext.applicationId:
            continue
        if reference.get() is None:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
            gone += 1
        else:
            kept.append(entry)
    _staged[:] = kept
    return gone
