"""Intermediate tables, written once in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir; on one machine a temporary one will do."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="fonolith-")
        sc.setCheckpointDir(found)
    return found


def materialize(df: DataFrame) -> DataFrame:
    """df written once as Parquet in the shared folder and read again.

    The lineage ends here, so a lost executor costs no recomputation of what came before.  The files go when the
    application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/fonolith/{uuid.uuid4().hex}"
    df.write.parquet(path)
    when_done(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def when_done(spark: SparkSession, path: str) -> None:
    """The files of path go when the application ends."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)


def drop_files(df: DataFrame) -> None:
    """Removes what materialize() wrote for df, once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/fonolith/" in path:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
