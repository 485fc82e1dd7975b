"""Graph tables in files: batches of nodes and edges, mapping files that can be replaced, and the one-file export of a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.operators import windows as W
from veinloom.sources import readers as R


def write_batches(rows: DataFrame, path: str, order: list[str], size: int) -> None:
    """JSON records in folders batch=0, 1, ... of `size` rows each, in the given order."""
    numbered = W.batches(rows, order, size)
    numbered.select("batch", F.to_json(F.struct(*rows.columns)).alias("value")).repartition("batch").write.partitionBy("batch").text(path)


def read_batches(spark: SparkSession, path: str, schema: str, after: int = -1) -> DataFrame:
    """The records with their batch, behind a batch that was loaded before; earlier folders are not read."""
    rows = spark.read.schema("value string, batch long").text(path).where(F.col("batch") > after)
    return rows.select("batch", F.from_json("value", schema).alias("r")).select("batch", "r.*")


def edge_report(edges: DataFrame, src: str, src_nodes: DataFrame, dst: str, dst_nodes: DataFrame) -> DataFrame:
    """edges with state: loaded, or what is missing. Node frames have one key column, unique."""
    a = src_nodes.toDF(src).withColumn("_a", F.lit(True))
    b = dst_nodes.toDF(dst).withColumn("_b", F.lit(True))
    state = F.when(F.col("_a") & F.col("_b"), "loaded").when(F.col("_a"), "no target").when(F.col("_b"), "no source").otherwise("no ends")
    return edges.join(a, src, "left").join(b, dst, "left").withColumn("state", state).drop("_a", "_b")


def export_mapping(edges: DataFrame, path: str, header: dict[str, str]) -> None:
    """Edges as delimited text with a header; header says what the columns are called in the file."""
    R.write_delimited(edges.select(*[F.col(c).alias(h) for c, h in header.items()]), path)


def replace_from_mapping(edges: DataFrame, spark: SparkSession, path: str, schema: str, header: dict[str, str], old: Column, src_nodes: DataFrame, dst_nodes: DataFrame) -> DataFrame:
    """Edges without those for which `old` holds, and with those of a mapping file whose ends exist, each once."""
    names = {h: c for c, h in header.items()}
    src, dst = list(header)[:2]
    news = R.read_delimited(spark, path, schema).withColumnsRenamed(names)
    news = edge_report(news, src, src_nodes, dst, dst_nodes).where("state = 'loaded'").drop("state").distinct()
    return edges.where(~F.coalesce(old, F.lit(False))).unionByName(news)


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """A graph in one table: node rows have _id and _labels, edge rows _start, _end and _type; other columns are properties."""
    R.write_delimited(nodes.unionByName(edges, allowMissingColumns=True), path)


def read_graph(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of such a table, each without the other's columns."""
    rows = R.read_delimited(spark, path, f"_id string, _labels string, {schema}, _start string, _end string, _type string")
    return rows.where("_id is not null").drop("_start", "_end", "_type"), rows.where("_id is null").drop("_id", "_labels")
