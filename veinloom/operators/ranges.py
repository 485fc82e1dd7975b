"""Cutting a range of dates into windows that a service answers in one go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetch_windows(rows: DataFrame, date: str, limit: int) -> DataFrame:
    """from_year, to_year and n: windows of whole years, each as long as its rows are at most `limit`; a year with more is
    a window by itself. Rows are counted by year first, so what is put in order is a row a year."""
    years = rows.where(F.col(date).isNotNull()).groupBy(F.year(date).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    listed = years.agg(F.array_sort(F.collect_list(F.struct("y", "n"))).alias("years"))
    window = lambda a, b, n: F.struct(a.alias("from_year"), b.alias("to_year"), n.alias("n"))
    last = lambda out: F.element_at(out, -1)
    fits = lambda out, x: (F.size(out) > 0) & (F.coalesce(F.get(out, F.size(out) - 1)["n"], F.lit(0)) + x["n"] <= limit)
    longer = lambda out, x: F.concat(F.slice(out, 1, F.size(out) - 1), F.array(window(last(out)["from_year"], x["y"], last(out)["n"] + x["n"])))
    cut = F.aggregate("years", F.array().cast("array<struct<from_year:int,to_year:int,n:bigint>>"), lambda out, x: F.when(fits(out, x), longer(out, x)).otherwise(F.concat(out, F.array(window(x["y"], x["y"], x["n"])))))
    return listed.select(F.explode(cut).alias("w")).select("w.*")
