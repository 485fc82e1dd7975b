"""A registry of named steps, run in order, each on the tables of those before it; a run that stopped goes on where it was."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Step:
    """makes: the names of the tables that run(tables) gives; needs: those it reads."""

    name: str
    needs: tuple[str, ...]
    makes: tuple[str, ...]
    run: Callable[[Tables], dict[str, DataFrame]]


class Pipeline:
    """Steps by name, in the order in which they were registered."""

    def __init__(self, name: str):
        self.name = name
        self.steps: list[Step] = []

    def step(self, needs: str, makes: str):
        """Registers a function of tables as a step; its docstring's first line describes it."""

        def add(f):
            self.steps.append(Step(f.__name__, tuple(needs.split()), tuple(makes.split()), f))
            return f

        return add

    def run(self, spark: SparkSession, tables: Tables, folder: str) -> dict[str, DataFrame]:
        """All tables at the end. Each step's tables are written under folder before the next step; steps of which all
        tables are there from an earlier run are not run again."""
        known = dict(tables)
        for s in self.steps:
            missing = [n for n in s.needs if n not in known]
            if missing:
                raise ValueError(f"{self.name}.{s.name} needs {missing}")
            paths = {n: f"{folder.rstrip('/')}/{s.name}/{n}" for n in s.makes}
            if not all(_complete(spark, p) for p in paths.values()):
                made = s.run(known)
                for n, p in paths.items():
                    made[n].write.mode("overwrite").parquet(p)
            known |= {n: spark.read.parquet(p) for n, p in paths.items()}
        return known


def _complete(spark: SparkSession, path: str) -> bool:
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)
