"""Connected components of an edge table, by alternating large and small stars; nothing comes to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinloom.llm.storage import Scratch

#: A node with more than this share of all edge ends is hot. There are at most 1 / HOT of them, whatever the size.
HOT = 1 / 500
#: Rounds grow with the logarithm of the longest path; so many mean a fault, not a large input.
MAX_ROUNDS = 200


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _with_least(pairs: DataFrame, most: int) -> DataFrame:
    """pairs (a, b), and m, the least b of each a. Hot nodes, fewer than 2 / HOT, come by broadcast, so that their rows stay
    where they are; all others by a join on a."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(least.where(F.col("_n") > most).select(F.col("a").alias("_hot"), F.col("m").alias("_m")))
    marked = pairs.join(hot, F.col("a") == F.col("_hot"), "left")
    cold = marked.where("_hot is null").select("a", "b").join(least.where(F.col("_n") <= most).select("a", "m"), "a")
    return cold.select("a", "b", "m").unionByName(marked.where("_hot is not null").select("a", "b", F.col("_m").alias("m")))


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node and root (the smallest node of its component) for every node of the edges (two columns of longs).

    Self-loops and repeated edges are allowed, null ends are left out; an empty table gives no rows. Each round writes
    its edges to the shared folder and drops those of the round before. The result is a scratch table. Rounds go on until
    nothing changes.
    """
    a, b = edges.columns[:2]
    now = scratch.written(edges.select(F.greatest(F.col(a), F.col(b)).alias("a"), F.least(F.col(a), F.col(b)).alias("b")).where("a is not null and b is not null and a <> b").distinct(), "edges")
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        most = int(2 * mark[0] * HOT)
        # Large star: every larger neighbour of a node goes to the least of its neighbours and itself.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, most).where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        # Small star: a node and its smaller neighbours go to the least of these.
        small = _with_least(large, most).select(F.when(F.col("b") != F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b"))
        after = scratch.written(small.distinct(), "edges")
        changed = _mark(after)
        scratch.drop(now)
        now, same, mark = after, changed == mark, changed
        if same:
            break
    else:
        raise RuntimeError(f"components are not settled after {MAX_ROUNDS} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
