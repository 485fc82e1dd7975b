"""Scratch tables in the folder that all executors share, and readers of input tables."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of our own, by application, for local sessions that name none (tests).
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where it is unset, a local session gets a folder of its own; a cluster's is
    refused, as its executors would not see each other's files."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _OWN:
            _OWN[application] = "file://" + tempfile.mkdtemp(prefix="veinloom-")
        path = _OWN[application]
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage and survives lost executors. The table stays;
    what an operator needs only while it works goes through a Scratch."""
    return _written_at(df, name)[0]


def _written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


class Scratch:
    """Tables of one piece of work. Each goes when it is dropped, the rest when the block ends; the JVM is then asked to
    collect, so that Spark also removes the shuffle files of what is no longer referred to."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._of: dict[int, tuple[DataFrame, str]] = {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        table_, path = _written_at(df, name)
        self._of[id(table_)] = (table_, path)
        return table_

    def drop(self, *tables: DataFrame, collect: bool = False) -> None:
        """Deletes tables that nothing reads any more; with collect, also the shuffle files of finished work."""
        for t in tables:
            delete_path(self.spark, self._of.pop(id(t))[1])
        if collect:
            self.collect_garbage()

    def collect_garbage(self) -> None:
        """Twice, a moment apart: the events of a job that has just ended hold its plan until listeners have seen them."""
        for _ in range(2):
            time.sleep(0.5)
            self.spark.sparkContext._jvm.System.gc()

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*[t for t, _ in self._of.values()])
        self.collect_garbage()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
