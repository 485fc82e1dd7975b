"""Cutting the lineage of what iterates."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where it is unset, a local session gets a folder of its own; a cluster's is
    refused, as its executors would not see each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="veinloom-")


def checkpointed(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the shared folder: what reads it later sees the same rows in the same partitions.

    It is given back as a plain table of rows: a checkpoint by itself keeps what the optimizer has concluded about its
    columns, and in a loop these conclusions double with each round."""
    spark: SparkSession = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    kept = df.checkpoint()._jdf.toDF()
    return DataFrame(spark._jsparkSession.createDataFrame(kept.toJavaRDD(), kept.schema()), spark)
