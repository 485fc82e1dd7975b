"""Queries through data sources of our own: paged services, spreadsheets, and dump files that are watched."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinloom.operators import windows as W
from veinloom.plans.domain_queries import _files, _scratch
from veinloom.sources import paged, sheets
from veinloom.streaming import polling

PAGE_ROWS = 150


def land_pages(rows: DataFrame, order: list[str], path: str, size: int = PAGE_ROWS) -> None:
    """Rows in order as JSON pages 0.json, 1.json, ..., each with the token of the next but the last."""
    numbered = W.batches(rows, order, size, "_page")
    last = numbered.agg(F.max("_page")).first()[0]
    record = F.struct(*rows.columns)
    listed = numbered.groupBy("_page").agg(F.to_json(F.array_sort(F.collect_list(record))).alias("records"))  # a page's rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for page, records in zip(*[c.to_pylist() for c in batch.columns]):
                text = json.dumps({"records": json.loads(records), "nextPageToken": str(page + 1) if page < last else None})
                with store.open_output_stream(f"{base}/{page}.json", compression=None) as out:
                    out.write(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array([0])], names=["n"])

    listed.mapInArrow(run, "n long").count()


_PART = "SELECT p_partkey, p_name, p_size, CAST(p_retailprice AS DOUBLE) AS p_retailprice FROM part"
_PART_SCHEMA = "p_partkey long, p_name string, p_size int, p_retailprice double"


def _part(t) -> DataFrame:
    return t("part").select("p_partkey", "p_name", F.col("p_size").cast("int").alias("p_size"), F.col("p_retailprice").cast("double").alias("p_retailprice"))


@_files("source_rest", _PART)
def _rest(spark, t):
    """Parts landed as pages of a service, and read by following its tokens."""
    path = _scratch(spark, "pages")
    land_pages(_part(t), ["p_partkey"], path)
    return paged.registered(spark).read.format("paged").schema(_PART_SCHEMA).option("url", path + "/{token}.json").load()


@_files("source_rest_stream", _PART)
def _rest_stream(spark, t):
    """The same as a stream that ends where pages end, and goes on from there when it is started again."""
    path, out, mark = _scratch(spark, "pages"), _scratch(spark, "records"), _scratch(spark, "mark")
    land_pages(_part(t), ["p_partkey"], path)
    for _ in range(2):  # the second one finds nothing new
        stream = paged.registered(spark).readStream.format("paged").schema(_PART_SCHEMA).option("url", path + "/{token}.json").load()
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(_PART_SCHEMA).parquet(out)


@_files("scan_excel", _PART)
def _excel(spark, t):
    """Parts written to spreadsheets, one a partition, and read back."""
    path = _scratch(spark, "sheets")
    sheets.write_sheets(_part(t).repartition(3, "p_partkey"), path, "parts")
    return sheets.read_sheets(spark, path, _PART_SCHEMA, "parts")


def _dump(rows: DataFrame, path: str, name: str) -> None:
    """A file for each value of the column `name`, with its rows as lines."""
    folded = rows.groupBy(name).agg(F.array_join(F.array_sort(F.collect_list(F.to_json(F.struct(*rows.columns)))), "\n").alias("lines"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for key, lines in zip(*[c.to_pylist() for c in batch.columns]):
                with store.open_output_stream(f"{base}/{key}.dump", compression=None) as out:
                    out.write(lines.encode())
        yield pa.RecordBatch.from_arrays([pa.array([0])], names=["n"])

    folded.mapInArrow(run, "n long").count()


@_files("stream_poll_dumps", "SELECT DISTINCT n_name || '.dump' AS name, 'changed' AS event FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE c_acctbal < -950")
def _poll(spark, t):
    """A dump of each nation's customers; those with a debtor are dumped again between two looks, and reported once."""
    path, events, mark = (_scratch(spark, x) for x in ("dumps", "events", "mark"))
    rows = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("n_name", "c_custkey", "c_acctbal")
    _dump(rows, path, "n_name")
    polling.poll(spark, path, events, mark, end=".dump")
    _dump(rows.join(rows.where("c_acctbal < -950").select("n_name").distinct(), "n_name"), path, "n_name")
    polling.poll(spark, path, events, mark, end=".dump")
    return polling.poll(spark, path, events, mark, end=".dump").select("name", "event")
