"""First, best and numbered rows per key, each under a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veinloom.operators.lineage import checkpointed


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def position_in_key(rows: DataFrame, keys: list[str], order: list[Column], name: str = "position") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def numbered(rows: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """Consecutive numbers from 0 in the given total order, without one task for all rows.

    Rows are ranged over partitions, sorted there and checkpointed, so that all that follows sees the same partitions;
    the sizes of the partitions before are added to the place in one's own. Rows that are equal in `order` get different
    numbers, in no given order."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number is not coalesced
    ranged = checkpointed(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)).withColumn("_id", F.monotonically_increasing_id())
    # The id is the partition's number, and in its 33 low bits the row's place in the partition.
    placed = ranged.withColumn("_part", F.shiftrightunsigned("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id")
    sizes = placed.groupBy("_part").agg((F.max("_at") + 1).alias("_n"))  # one row a partition, so it may be broadcast
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def surrogate_keys(rows: DataFrame, order: list[str], prefix: str, width: int = 5, name: str = "key") -> DataFrame:
    return numbered(rows, order, "_no").withColumn(name, F.concat(F.lit(prefix), F.when(F.length(F.col("_no").cast("string")) >= width, F.col("_no").cast("string")).otherwise(F.lpad(F.col("_no").cast("string"), width, "0")))).drop("_no")


def stratified(rows: DataFrame, band: str, key: str, n: int) -> DataFrame:
    """At most n rows a band, by a hash of the key; a sampling operator, the same at every run."""
    return position_in_key(rows, [band], [F.md5(F.col(key).cast("string")), F.col(key)], "_rn").where(F.col("_rn") <= n).drop("_rn")


def batches(rows: DataFrame, order: list[str], size: int, name: str = "batch") -> DataFrame:
    return numbered(rows, order, "_no").withColumn(name, F.floor(F.col("_no") / size)).drop("_no")


def maximal_terms(matches: DataFrame, doc: str, term: str) -> DataFrame:
    """Matches whose term lies in no other matched term of the same document. A document's terms are few."""
    other = matches.select(F.col(doc).alias("_d"), F.col(term).alias("_t"))
    inside = (F.col(doc) == F.col("_d")) & (F.col(term) != F.col("_t")) & F.col("_t").contains(F.col(term))
    return matches.join(other, inside, "left_anti")
