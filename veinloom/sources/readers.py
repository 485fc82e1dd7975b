"""Readers and writers of the source formats: delimited text, JSON, zipped JSON, attribute tables."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SEPARATORS = {"comma": ",", "pipe": "|", "tab": "\t"}


def read_delimited(spark: SparkSession, path: str | list[str], schema: str, separator: str = "comma", header: bool = True, encoding: str = "UTF-8", drop_bad_lines: bool = False) -> DataFrame:
    """Delimited text with a given schema; nothing is inferred, so the files are read once."""
    reader = spark.read.schema(schema).option("sep", _SEPARATORS[separator]).option("header", header).option("encoding", encoding)
    reader = reader.option("mode", "DROPMALFORMED" if drop_bad_lines else "PERMISSIVE").option("quote", '"').option("escape", '"')
    return reader.csv(path)


def read_years(spark: SparkSession, pattern: str, schema: str, **options) -> DataFrame:
    """All files of a pattern with the year in their names as a column; a table's folder counts as its file."""
    rows = read_delimited(spark, pattern, schema, **options)
    name = F.regexp_replace(F.col("_metadata.file_path"), "/part-[^/]*$", "")
    return rows.withColumn("year", F.regexp_extract(name, r"((?:19|20)\d\d)[^/]*$", 1).cast("int"))


def read_json(spark: SparkSession, path: str, schema: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def read_zipped_json(spark: SparkSession, path: str, field: str) -> DataFrame:
    """One row of JSON text for each element of `field` in the JSON members of zip files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if name.endswith(".json"):
                            yield pd.DataFrame({"member": name, "record": [json.dumps(x) for x in json.loads(z.read(name)).get(field, [])]})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "member string, record string")


def write_zipped_json(df: DataFrame, path: str, field: str) -> None:
    """A zip file with one JSON member for each partition, under a path of any store that pyarrow knows."""
    columns = df.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        records = [dict(zip(columns, r)) for f in frames for r in f.itertuples(index=False, name=None)]
        if records:
            raw = io.BytesIO()
            with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("part.json", json.dumps({field: records}, default=str))
            with store.open_output_stream(f"{base}/{uuid.uuid4().hex}.zip", compression=None) as out:
                out.write(raw.getvalue())
        yield pd.DataFrame({"n": [len(records)]})

    df.mapInPandas(run, "n long").agg(F.sum("n")).first()


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    """Attribute tables in subfolders: entity (the folder), attribute and values, parsed from a printed list."""
    from veinloom.functions.text import parse_list

    rows = spark.read.schema("Primary_category string, Attribute string, Content string").option("header", True).option("recursiveFileLookup", True).option("escape", '"').csv(path)
    entity = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.select(entity.alias("entity"), F.col("Primary_category").alias("category"), F.col("Attribute").alias("attribute"), parse_list("Content").alias("values"))


def attributes_to_nodes(rows: DataFrame, key: str, attribute: str, value: str, columns: list[str]) -> DataFrame:
    """Attribute-value rows to one row for each key; the columns are given, so there is no pass to find them."""
    return rows.groupBy(key).pivot(attribute, columns).agg(F.min(value))


def write_delimited(df: DataFrame, path: str, by: str | None = None, append: bool = False, separator: str = "comma") -> None:
    writer = df.write.mode("append" if append else "overwrite").option("header", True).option("sep", _SEPARATORS[separator])
    (writer.partitionBy(by) if by else writer).csv(path)


def as_json_records(df: DataFrame, edge: tuple[str, str] | None = None) -> DataFrame:
    """One JSON text a row; an edge's ends are nested as start and end."""
    if edge:
        rest = [c for c in df.columns if c not in edge]
        return df.select(F.to_json(F.struct(F.struct(F.col(edge[0]).alias("id")).alias("start"), F.struct(F.col(edge[1]).alias("id")).alias("end"), *rest)).alias("record"))
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))
