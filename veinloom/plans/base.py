"""The list of queries: each is registered with the SQL it is held against, where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *more: str):
    """Registers a function of (table reader) under its name and any further names."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__doc__ = f.__doc__
        for name in (f.__name__, *more):
            if name in QUERIES:
                raise ValueError(f"two queries are called {name}")
            QUERIES[name] = run
            if sql:
                ORACLES[name] = sql
        return f

    return add


def day(c) -> F.Column:
    return F.to_date(c)


def money(c) -> F.Column:
    """Exact sums of amounts, whatever the order of rows."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")
