"""Names that are alike by Ratcliff and Obershelp's ratio, found by rare letters that they must share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veinloom.functions import text as X


def _letters(c: Column) -> Column:
    """Each letter with the number of its occurrence, so that a bag of letters is a set."""
    one = F.filter(F.split(c, ""), lambda x: x != "")
    return F.transform(one, lambda x, i: F.concat(x, F.size(F.filter(F.slice(one, 1, i + 1), lambda y: y == x)).cast("string")))


def alike_pairs(names: DataFrame, name: str, least: float) -> DataFrame:
    """a, b and ratio (rounded) of all pairs of different names, in both orders, whose ratio is `least` or more.

    The ratio of names of n and m letters is at most twice their common letters, whatever the order, over n + m. So they
    share at least ceil(least * n / (2 - least)) letters, and of each name's letters, the rarest first, one of those at the
    front has to be common: names are joined on these only, and the ratio is worked out where enough letters are common.
    Null and empty names are like no other. The ratio depends on the order of its two names, so both are given.
    """
    once = names.select(F.col(name).alias("a")).where("a <> ''").distinct().select("a", F.length("a").alias("n"), _letters(F.col("a")).alias("_letters"))
    every = once.select("a", "n", "_letters", F.explode("_letters").alias("_x"))
    rarity = every.groupBy("_x").agg(F.count(F.lit(1)).alias("_df"))
    place = F.row_number().over(Window.partitionBy("a").orderBy("_df", "_x"))
    front = every.join(rarity, "_x").withColumn("_place", place).where(F.col("_place") <= F.col("n") - F.ceil(F.col("n") * least / (2 - least) - 1e-9) + 1)
    left = front.select("_x", "a", "n", F.col("_letters").alias("_la"))
    right = front.select("_x", F.col("a").alias("b"), F.col("n").alias("m"), F.col("_letters").alias("_lb"))
    near = (F.col("a") < F.col("b")) & (2 * F.least("n", "m") >= least * (F.col("n") + F.col("m")) - 1e-9)
    met = left.join(right, "_x").where(near)
    enough = 2 * F.size(F.array_intersect("_la", "_lb")) >= least * (F.col("n") + F.col("m")) - 1e-9
    pairs = met.where(enough).select("a", "b").distinct()
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.withColumn("ratio", F.round(X.similarity("a", "b"), 6)).where(F.col("ratio") >= least)
