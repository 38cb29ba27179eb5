"""Session helpers shared by the jobs."""

from __future__ import annotations

import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share for intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``; where that is unset, the session's
    checkpoint folder; else a folder below the warehouse. On a cluster that must not be a disk of one
    machine, so there a warehouse of ``file:`` is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if where:
        return where
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; {warehouse} is local")
    return warehouse + "/_callsift"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written yet, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step", by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet into the shared folder and read it back: a cut of the lineage that
    survives lost executors and still prunes columns. Values of the columns ``by`` have a folder each,
    so that a filter on them reads no more than it keeps."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``fresh_path`` named, once nothing reads it any more."""
    assert path.startswith(shared_dir(spark).rstrip("/") + "/"), path
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
