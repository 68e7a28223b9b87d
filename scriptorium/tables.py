"""Stage tables in the folder that all machines of the cluster share.

Writing a table cuts lineage: later steps read it instead of repeating the steps before it, and so
does a task that runs again after a lost executor. All tables of an application lie in one folder,
which goes when the driver's program ends.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_swept: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The application's folder inside spark.checkpoint.dir. Where that is unset, a local master
    gets a temporary folder and a cluster a folder inside the warehouse, which is shared as well."""
    app = spark.sparkContext.applicationId
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if app not in _own:
            if spark.sparkContext.master.startswith("local"):
                _own[app] = "file://" + tempfile.mkdtemp(prefix="scriptorium-")
            else:
                _own[app] = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        folder = _own[app]
    folder = f"{folder.rstrip('/')}/scriptorium-{app}"
    if folder not in _swept:
        _swept.add(folder)
        atexit.register(_sweep, spark, folder)
    return folder


def _sweep(spark: SparkSession, folder: str) -> None:
    try:
        drop(spark, folder)
    except (Py4JError, OSError, AttributeError):  # the JVM has ended first
        pass


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes df to the shared folder and reads it back; also returns the path, for drop()."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stable(df: DataFrame, name: str) -> DataFrame:
    """df itself where its rows come straight from files, whose splits are the same whenever a task
    runs again; else a kept copy. Operators that number rows by task and place need it: a task that
    reads a shuffle again may see its rows in another order."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return keep(df, name)[0] if "Exchange" in plan else df


def settle(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that nothing refers to any more. The driver
    would find them at its next full collection, which may come long after the disks are full."""
    gc.collect()
    spark._jvm.System.gc()


def drop(spark: SparkSession, *paths: str) -> None:
    """Deletes tables that no returned DataFrame reads any more."""
    jvm = spark._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
