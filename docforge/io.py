"""Reading tables and finding the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def application_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    A local session that names no such folder (tests) gets a temporary one; on a cluster that is an error, since
    executors would write to disks that others don't see.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "docforge-shared")
    return f"{base.rstrip('/')}/docforge-{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession) -> str:
    """A new folder for one table or checkpoint."""
    return f"{application_dir(spark)}/{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; results not yet read are lost."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(application_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and the files survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
