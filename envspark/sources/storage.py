"""Tables that a plan writes on its way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    Where it is unset, a local session takes a temporary folder. A cluster has to name one: what an
    executor wrote to a folder of its own machine is not there for the others.
    """
    named = spark.conf.get(SHARED, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED} to a folder that all machines of the cluster share")
    own = tempfile.mkdtemp(prefix="stash-")
    spark.conf.set(SHARED, own)
    return own


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A new path in the shared folder, removed when the application ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{folder}/data"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table and read it back: a lost executor costs no recomputation of what came before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
