"""Incremental loads: streamed upserts into a table of snapshots, change detection, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veinloom.operators.graph import upsert


#: Parts of a streamed table by a hash of the key; a batch rewrites those that its keys are in.
BUCKETS = 64


def upsert_stream(spark: SparkSession, source: str, schema: str, table: str, checkpoint: str, key: str, order: str, policy: str = "coalesce", file_format: str = "parquet", per_batch: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Reads all files that have landed since the last call and upserts them batch by batch; returns the final state.

    Within a batch the row of the largest order counts for a key; with the policy latest it does over all batches, so
    files may land in any order. The table is laid out in buckets of keys: a batch reads and replaces those that it touches,
    and leaves all others as they are; no older state is kept. A batch that is run again after a failure finds its own rows
    there already, and every policy then gives the same state again, so it is right exactly once. A table keeps the
    number of buckets that it began with.
    """
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")

    def apply(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c != key]
        latest = lambda rows: rows.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in rest]).select(*batch.columns)
        touched = [r[0] for r in batch.where(F.col(key).isNotNull()).select(place).distinct().collect()]  # at most all buckets
        old = _table(spark, table, batch.schema, touched)
        if old is None:
            state = latest(batch)
        elif policy == "latest":
            state = latest(old.select(*batch.columns).unionByName(batch))
        else:
            state = upsert(old.select(*batch.columns), latest(batch), key, policy)
        state.withColumn("_bucket", place).repartition("_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(table)

    stream = spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", per_batch).load(source)
    fields = stream.schema
    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return _table(spark, table, fields)


def _table(spark: SparkSession, path: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame | None:
    """The rows of all or some buckets; None where nothing has been written."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(path)
    return (rows if buckets is None else rows.where(F.col("_bucket").isin(buckets))).drop("_bucket")


def changed(control: DataFrame, seen: DataFrame, name: str, stamp: str) -> DataFrame:
    """Names whose stamp differs from the one kept; names seen for the first time only set the baseline."""
    kept = control.select(name, F.col(stamp).alias("_kept"))
    return seen.join(kept, name).where(~F.col(stamp).eqNullSafe(F.col("_kept"))).select(name, stamp)


def due(control: DataFrame, name: str, last: str, interval: str, today) -> DataFrame:
    """Sources whose last update is more than their interval of days ago."""
    return control.where(F.date_diff(F.lit(today).cast("date"), F.col(last)) > F.col(interval)).select(name)


def alert_counts(subscriptions: DataFrame, user: str, topic: str, news: DataFrame, kind: str, when: str, start: str, end: str, kinds: list[str]) -> DataFrame:
    """New rows for each user and topic in a range of days, a column for each kind, users without any left out. One
    grouped join in place of a query for each subscription."""
    recent = news.where(F.col(when).cast("date").between(start, end)).groupBy(topic, kind).agg(F.count(F.lit(1)).alias("n"))
    table = subscriptions.join(recent, topic).groupBy(user, topic).pivot(kind, kinds).agg(F.sum("n"))
    table = table.select(user, topic, *[F.coalesce(F.col(k), F.lit(0)).cast("long").alias(k) for k in kinds])
    return table.withColumn("total", sum((F.col(k) for k in kinds), F.lit(0).cast("long"))).where("total > 0")
