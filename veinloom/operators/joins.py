"""Joins beyond the plain kinds, all as equi-joins that the optimizer may broadcast, merge or split for skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outer_with_origin(left: DataFrame, right: DataFrame, keys: list[str], origin: str = "origin") -> DataFrame:
    """Full outer join that says for each row where it comes from: left_only, right_only or both."""
    a, b = left.withColumn("_in_left", F.lit(True)), right.withColumn("_in_right", F.lit(True))
    where = F.when(F.col("_in_left") & F.col("_in_right"), "both").when(F.col("_in_left"), "left_only").otherwise("right_only")
    return a.join(b, keys, "full_outer").withColumn(origin, where).drop("_in_left", "_in_right")


def overwrite(base: DataFrame, news: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Replaces the columns of rows that news has; all other rows stay. news must be unique in the keys."""
    fresh = news.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = base.join(fresh, keys, "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])


def apply_rules(facts: DataFrame, rules: DataFrame, keys: list[str], order: str, results: list[str]) -> DataFrame:
    """Looks results up by keys among which a null equals a null; of several rules for a key that of the largest order counts."""
    latest = rules.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in results])
    rule = latest.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *results)
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return facts.join(rule, on, "left").drop(*[f"_r_{k}" for k in keys])


def lookup_with_fallback(facts: DataFrame, fine: DataFrame, coarse: DataFrame, fine_keys: list[str], coarse_keys: list[str], value: str, default: str = "") -> DataFrame:
    """The value by the fine keys, else by the coarse ones, else the default."""
    a = fine.withColumnRenamed(value, "_fine")
    b = coarse.withColumnRenamed(value, "_coarse")
    return facts.join(a, fine_keys, "left").join(b, coarse_keys, "left").withColumn(value, F.coalesce("_fine", "_coarse", F.lit(default))).drop("_fine", "_coarse")


def referenced_by_any(base: DataFrame, key: str, links: list[DataFrame]) -> DataFrame:
    """Rows whose key some link table mentions: one semi join on the distinct union."""
    every = reduce(lambda x, y: x.unionByName(y), [d.toDF(key) for d in links]).distinct()
    return base.join(every, key, "left_semi")


#: Members of a part of a group; a larger group is paired part by part.
PART = 1_000


def co_participation(membership: DataFrame, group: str, member: str, since: str | None = None) -> DataFrame:
    """a < b and in how many groups both are (weight); with since, a column of the groups, also its least value in these.
    Memberships are made distinct before pairing.

    The pairs are the result, so their number is the square of a group's size; but a large group is dealt into parts by a
    hash of the member, and each pair of parts is a task of its own, so no task pairs more than PART with PART."""
    more = [since] if since else []
    once = membership.select(group, member, *more).where(F.col(group).isNotNull() & F.col(member).isNotNull()).distinct()
    parts = once.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("_k"))
    dealt = once.join(parts, group).withColumn("_p", F.pmod(F.xxhash64(member), F.col("_k")).cast("int"))
    met = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    cell = met.select(group, member, *more, "_p", F.least("_p", "_o").alias("_i"), F.greatest("_p", "_o").alias("_j"))
    a, b = cell.withColumnsRenamed({member: "a", "_p": "_pa"}), cell.drop(*more).withColumnsRenamed({member: "b", "_p": "_pb"})
    # In the cell (i, j) only members of different parts meet, in (i, i) all of the part.
    pairs = a.join(b, [group, "_i", "_j"]).where("a < b and (_i = _j or _pa <> _pb)")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("weight"), *[F.min(c).alias(c) for c in more])


def endpoints_missing(edges: DataFrame, end: str, nodes: DataFrame, key: str) -> DataFrame:
    """Edges whose end has no node."""
    return edges.join(nodes.select(F.col(key).alias(end)).distinct(), end, "left_anti")


def with_both_ends(edges: DataFrame, src: str, src_nodes: DataFrame, dst: str, dst_nodes: DataFrame) -> DataFrame:
    """Edges of which both ends exist; node frames have one key column."""
    return edges.join(src_nodes.toDF(src), src, "left_semi").join(dst_nodes.toDF(dst), dst, "left_semi")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, conditions)
