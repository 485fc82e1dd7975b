"""Watching dump files: a stream over their modification times, with what was last seen of each kept as state."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.state import GroupState

from veinloom.sources.files import listed


@dataclass
class Look(InputPartition):
    at: int
    files: list


class _Watch(DataSourceStreamReader):
    """The offset is what a look at the folder has shown, and when: each file's modification time. So a look that is run
    again after a failure is the same look. Dumps are few, one a database."""

    def __init__(self, options: dict):
        self.path, self.end = options["path"], options.get("end", "")

    def initialOffset(self) -> dict:
        return {"at": 0, "files": {}}

    def latestOffset(self) -> dict:
        return {"at": time.time_ns() // 1_000_000, "files": {uri.rsplit("/", 1)[-1]: stamp for uri, stamp in listed(self.path, self.end)}}

    def partitions(self, start: dict, end: dict) -> list[Look]:
        return [Look(end["at"], sorted(end["files"].items()))]

    def read(self, partition: Look) -> Iterator[tuple]:
        for name, stamp in partition.files:
            yield name, stamp, partition.at


class WatchedFiles(DataSource):
    """name and stamp (nanoseconds since 1970) of all files of a folder at each look, and at, its time in milliseconds."""

    @classmethod
    def name(cls) -> str:
        return "watched"

    def schema(self) -> str:
        return "name string, stamp long, at long"

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _Watch(dict(self.options))


def _judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, due_ms: int) -> Iterator[pd.DataFrame]:
    """State: the last stamp, and since when nothing has been said of the file."""
    looks = pd.concat(list(frames)).sort_values("at")
    out = []
    kept, since = state.get if state.exists else (None, int(looks["at"].iloc[0]))
    for stamp, at in zip(looks["stamp"].tolist(), looks["at"].tolist()):
        event = "changed" if kept is not None and stamp > kept else "due" if due_ms and at - since >= due_ms else None
        kept = stamp if kept is None else max(kept, stamp)
        if event:
            out.append((key[0], event, kept))
            since = at
    state.update((kept, since))
    if out:
        yield pd.DataFrame(out, columns=["name", "event", "stamp"])


def watch(spark: SparkSession, path: str, due_ms: int = 0, end: str = "") -> DataFrame:
    """A stream of name, event and stamp: changed for a file that was touched since the look before, due for one of which
    nothing was said for due_ms milliseconds (0: never). A file's first look only sets what is kept. Start it with a
    trigger: each one is a look."""
    spark.dataSource.register(WatchedFiles)
    seen = spark.readStream.format("watched").option("path", path).option("end", end).load()

    def judge(key, frames, state):
        return _judge(key, frames, state, due_ms)

    return seen.groupBy("name").applyInPandasWithState(judge, "name string, event string, stamp long", "stamp long, since long", "append", "NoTimeout")


def poll(spark: SparkSession, path: str, events: str, checkpoint: str, due_ms: int = 0, end: str = "") -> DataFrame:
    """Looks once and appends what has happened since the last look to the table `events`, each event once, also over
    restarts. Returns all events so far."""
    stream = watch(spark, path, due_ms, end).writeStream.format("parquet").option("path", events).option("checkpointLocation", checkpoint)
    stream.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("name string, event string, stamp long").parquet(events)
