"""Intermediate tables in the folder that all executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or set on the context; a local session without one gets a folder that goes at its end.

    On a cluster a folder of one machine's own would lose what others write, so there a missing setting is an error.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    jsc = spark.sparkContext._jsc.sc()
    if not jsc.getCheckpointDir().isDefined():
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.mkdtemp(prefix="snapforge-shared-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(own)
    return jsc.getCheckpointDir().get().rstrip("/")


def root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/snapforge/{spark.sparkContext.applicationId}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system named, as Spark resolves it."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    return given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toString()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return qualified(spark, f"{root(spark)}/{uuid.uuid4().hex}/{name}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch path that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def unstage(df: DataFrame) -> None:
    """Delete what stage() wrote; call it once the last reader has been materialised."""
    files = df.inputFiles()
    if files:
        remove(df.sparkSession, files[0].rpartition("/")[0])


def clear(spark: SparkSession) -> None:
    """Delete all that this application has staged; results that have not been materialised can't be read afterwards."""
    remove(spark, root(spark))
