"""Node and edge tables: merging, upserts, entity resolution, degrees, hierarchy, components, communities."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinloom.operators.lineage import checkpointed

POLICIES = ("keep", "coalesce", "overwrite")


def merge_nodes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Get-or-create: nodes that are known stay as they are, new keys are added once."""
    fresh = new.where(F.col(key).isNotNull()).join(old.select(key), key, "left_anti").dropDuplicates([key])
    return old.unionByName(fresh)


def upsert(old: DataFrame, new: DataFrame, key: str, policy: str = "coalesce") -> DataFrame:
    """New keys are added; for known ones keep leaves the old row, coalesce takes new values that are not null, overwrite
    takes the new row. Rows with a null key are refused by leaving them out."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    rest = [c for c in old.columns if c != key]
    a = old.where(F.col(key).isNotNull()).select(key, *[F.col(c).alias(f"_o_{c}") for c in rest], F.lit(True).alias("_old"))
    b = new.where(F.col(key).isNotNull()).select(key, *[F.col(c).alias(f"_n_{c}") for c in rest], F.lit(True).alias("_new"))
    pick = {
        "keep": lambda c: F.when(F.col("_old"), F.col(f"_o_{c}")).otherwise(F.col(f"_n_{c}")),
        "coalesce": lambda c: F.coalesce(f"_n_{c}", f"_o_{c}"),
        "overwrite": lambda c: F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")),
    }[policy]
    return a.join(b, key, "full_outer").select(key, *[pick(c).alias(c) for c in rest])


def merge_edges(edges: DataFrame, src: str, dst: str, props: list[str] = ()) -> DataFrame:
    """One edge for each pair of ends and value of its properties; edges without both ends are left out."""
    return edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(src, dst, *props).distinct()


def resolve_entities(nodes: DataFrame, keys: list[str], node_id: str) -> tuple[DataFrame, DataFrame]:
    """Collapses nodes of equal keys into that of the least id, with the first value that is not null of each property;
    returns the survivors and the map from each id to its survivor."""
    rest = [c for c in nodes.columns if c not in keys and c != node_id]
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(node_id))).alias(c) for c in rest]
    survivors = nodes.groupBy(*keys).agg(F.min(node_id).alias(node_id), *first)
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    mapping = nodes.alias("a").join(survivors.alias("b"), on).select(F.col(f"a.{node_id}").alias("old_id"), F.col(f"b.{node_id}").alias("new_id"))
    return survivors, mapping


def repoint(edges: DataFrame, end: str, mapping: DataFrame) -> DataFrame:
    return edges.join(mapping.withColumnRenamed("old_id", end), end, "left").withColumn(end, F.coalesce("new_id", end)).drop("new_id")


def neighbour_counts(nodes: DataFrame, key: str, edges: DataFrame, end: str, other: str, name: str) -> DataFrame:
    """Distinct neighbours of every node, 0 where there is none."""
    counts = edges.groupBy(F.col(end).alias(key)).agg(F.countDistinct(other).alias(name))
    return nodes.select(key).join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def hierarchy(rows: DataFrame, node: str, parent: str, child: str) -> DataFrame:
    """Child to parent edges from rows that name a node's parent, its child, or both."""
    up = rows.select(F.col(node).alias("child"), F.col(parent).alias("parent"))
    down = rows.select(F.col(child).alias("child"), F.col(node).alias("parent"))
    return up.unionByName(down).where("child is not null and parent is not null").distinct()


def undirected_degree(edges: DataFrame, a: str, b: str) -> DataFrame:
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other")))
    return both.where("node <> other").groupBy("node").agg(F.countDistinct("other").alias("degree"))


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node): labels go to neighbours and then to the label's own label, so long paths need
    few rounds. Rounds go on until no label changes."""
    both = edges.toDF("a", "b").where("a is not null and b is not null")
    both = checkpointed(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        stepped = labels.join(near, "a").select("a", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("a").alias("new"), F.col("label").alias("far"))
        now = checkpointed(stepped.join(jump, "new", "left").select("a", F.coalesce("far", "new").alias("label"), (F.coalesce("far", "new") != F.col("label")).alias("moved")))
        moved = now.where("moved").limit(1).count()
        labels = now.select("a", "label")
        if not moved:
            return labels.toDF("node", "component")


def strong_components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of a directed graph (a, b): two nodes are in one if each reaches the other.

    In each turn the greatest node that reaches a node, and the greatest that it reaches, spread to the fixed point; nodes
    for which both are the same form a component with it and leave. Edges between nodes whose two values differ can lie in
    no component and leave too. Each turn settles at least one component in every part that is left.
    """
    left = checkpointed(edges.toDF("a", "b").where("a is not null and b is not null").distinct())
    nodes = checkpointed(left.select("a").union(left.select("b")).distinct().toDF("node"))
    done = None
    while nodes.limit(1).count():
        values = spread(nodes, left).join(spread(nodes, left.select(F.col("b").alias("a"), F.col("a").alias("b"))).withColumnRenamed("top", "back"), "node")
        values = checkpointed(values)
        found = values.where("top = back").select("node", F.col("top").alias("name"))
        done = found if done is None else done.unionByName(found)
        rest = values.where("top <> back")
        one, two = rest.toDF("a", "_ta", "_ba"), rest.toDF("b", "_tb", "_bb")
        left = checkpointed(left.join(one, "a").join(two, "b").where("_ta = _tb and _ba = _bb").select("a", "b"))
        nodes = checkpointed(rest.select("node"))
    if done is None:
        return nodes.select("node", F.col("node").alias("component"))
    least = done.groupBy("name").agg(F.min("node").alias("component"))
    return done.join(least, "name").select("node", "component")


def spread(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node and top, the greatest node from which a path of edges (a, b) leads to it, itself included."""
    now = checkpointed(nodes.select("node", F.col("node").alias("top")))
    while True:
        come = edges.join(now.toDF("a", "_t"), "a").groupBy("b").agg(F.max("_t").alias("come")).withColumnRenamed("b", "node")
        after = now.join(come, "node", "left").select("node", F.greatest("top", F.coalesce("come", "top")).alias("top"), F.coalesce(F.col("come") > F.col("top"), F.lit(False)).alias("moved"))
        after = checkpointed(after)
        now = after.select("node", "top")
        if not after.where("moved").limit(1).count():
            return now


#: Local moves, contraction and refinement go on while the modularity rises by more than this.
LEAST_GAIN = 1e-7
#: Links (both directions) of a group of communities that one task works on (24 bytes each).
GROUP_LINKS = 1_000_000


def communities(edges: DataFrame) -> DataFrame:
    """node and community (its least node) of an undirected weighted graph (a, b, weight), by Louvain's method.

    On each level nodes move to the neighbouring community of the greatest gain in modularity, until none wants to; then
    communities become the nodes of a smaller graph, whose edges have the summed weights, and whose degrees keep what lies
    inside. When a level changes nothing, the nodes of each level below may move between what has been found, down to the
    first graph, and the levels start from there again, as long as that raises the modularity. Edges of a pair are added, self-loops and edges
    with a null end or weight count for nothing, weights have to be positive. An empty graph gives no rows. The method's
    result depends on an order, here on hashes, so that it is the same at every run.
    """
    both = edges.select("a", "b", F.col("weight").cast("double").alias("w")).where("a <> b and w > 0")
    both = checkpointed(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")).groupBy("a", "b").agg(F.sum("w").alias("w")))
    nodes = checkpointed(both.groupBy("a").agg(F.sum("w").alias("k")))
    two_m = nodes.agg(F.sum("k")).first()[0]
    if not two_m:
        return nodes.select(F.col("a").alias("node"), F.col("a").alias("community"))
    value, found = None, nodes.select("a", F.col("a").alias("c"))
    while True:
        found, moved = _local_moves(both, nodes.join(found, "a"), two_m)
        if value is not None and not moved:
            break
        levels = [(*contracted(both, nodes.join(found, "a")), found)]
        while True:
            links, level, of = levels[-1]
            parts, moved = _local_moves(links, level.withColumn("c", F.col("a")), two_m)
            if not moved:
                break
            levels.append((*contracted(links, level.join(parts, "a")), _through(of, parts)))
        found = levels[-1][2]
        for links, level, of in levels[-2::-1]:
            start = of.join(found.toDF("a", "_c"), "a").groupBy("c").agg(F.first("_c").alias("_c")).toDF("a", "c")
            parts, moved = _local_moves(links, level.join(start, "a"), two_m)
            found = _through(of, parts) if moved else found
        reached = _modularity(*contracted(both, nodes.join(found, "a")), two_m)
        if value is not None and reached <= value + LEAST_GAIN:
            break
        value, best = reached, found
    named = best.groupBy("c").agg(F.min("a").alias("community"))
    return best.join(named, "c").select(F.col("a").alias("node"), "community")


def _through(of: DataFrame, parts: DataFrame) -> DataFrame:
    """a and c: from a node by its node on a level to that one's community."""
    return checkpointed(of.join(parts.toDF("c", "_to"), "c").select("a", F.col("_to").alias("c")))


def _modularity(links: DataFrame, level: DataFrame, two_m: float) -> float:
    """Of communities as nodes: what is left of the degrees once the links between them are taken off, less what chance gives."""
    between = links.agg(F.coalesce(F.sum("w"), F.lit(0.0))).first()[0]
    return 1 - between / two_m - level.agg(F.sum(F.col("k") * F.col("k"))).first()[0] / two_m**2


def contracted(links: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The weighted graph of communities: links (a, b, w) between them in both directions, and nodes (a, k) with their
    degrees, to which links inside count as before. nodes: a, k and c, the community."""
    of = nodes.select("a", "c")
    joined = links.join(of.toDF("a", "_ca"), "a").join(of.toDF("b", "_cb"), "b").where("_ca <> _cb")
    return checkpointed(joined.groupBy(F.col("_ca").alias("a"), F.col("_cb").alias("b")).agg(F.sum("w").alias("w"))), checkpointed(nodes.groupBy(F.col("c").alias("a")).agg(F.sum("k").alias("k")))


def _local_moves(links: DataFrame, nodes: DataFrame, two_m: float) -> tuple[DataFrame, int]:
    """a and c after moves that raise the modularity, until no node wants to move, and how many there were. nodes: a, k and c.

    Communities are dealt to groups of bounded size, and a task makes all moves inside its group, one after the other. What
    a move gains depends on the two communities alone, so groups do not disturb each other and each move raises the
    modularity. A graph of one group is then done; otherwise moves over all communities follow, and the next round deals
    them anew.
    """
    now, total, r = nodes.select("a", "k", "c"), 0, 0
    groups = max(1, -(-links.count() // GROUP_LINKS))
    while True:
        now, made = _moves_in_groups(links, now, two_m, groups, r)
        total += made
        if groups == 1:
            return now.select("a", "c"), total
        now, made = _moves_of_all(links, now, two_m, r)
        if not made:
            return now.select("a", "c"), total
        total, r = total + made, r + 1


def _moves_in_groups(links: DataFrame, now: DataFrame, two_m: float, groups: int, r: int) -> tuple[DataFrame, int]:
    """a, k and c after a round of moves inside groups of communities, and how many. A community that has more links than a
    group may have takes no part in it."""
    if groups == 1:
        dealt, inside = now.withColumn("_g", F.lit(0)), links.withColumn("_g", F.lit(0))
    else:
        degree = links.groupBy("a").agg(F.count(F.lit(1)).alias("_n"))
        fits = now.join(degree, "a", "left").groupBy("c").agg(F.sum(F.coalesce("_n", F.lit(0))).alias("_n")).select("c", F.when(F.col("_n") <= GROUP_LINKS, F.pmod(F.xxhash64("c", F.lit(f"g{r}")), F.lit(groups)).cast("int")).alias("_g"))
        dealt = checkpointed(now.join(fits, "c").select("a", "k", "c", "_g"))
        inside = links.join(dealt.select("a", "_g"), "a").join(dealt.select(F.col("a").alias("b"), F.col("_g").alias("_h")), "b").where("_g = _h")
    node, kind = dealt.where("_g is not null"), now.schema["a"].dataType.simpleString()
    rows = node.select("_g", F.lit(0).alias("_link"), "a", F.col("c").alias("b"), F.col("k").alias("w")).unionByName(inside.select("_g", F.lit(1).alias("_link"), "a", "b", "w"))
    moved = rows.repartitionById(groups, F.col("_g")).sortWithinPartitions("_g", "_link").mapInArrow(partial(_work_on_groups, two_m=two_m), f"a {kind}, k double, c {kind}, goes boolean")
    if groups > 1:
        moved = moved.unionByName(dealt.where("_g is null").select("a", "k", "c", F.lit(False).alias("goes")))
    after = checkpointed(moved)
    return after.drop("goes"), after.where("goes").count()


def _work_on_groups(batches: Iterator[pa.RecordBatch], two_m: float) -> Iterator[pa.RecordBatch]:
    """a, k, c and whether c is new, for the nodes of each group. Rows (group, 0, a, c, k) and then (group, 1, a, b, w)."""

    def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        link = t.column(1).to_numpy() == 1
        a, b, w = (t.column(i).to_numpy() for i in (2, 3, 4))
        order = np.argsort(a[~link], kind="stable")
        ids, was, k = a[~link][order], b[~link][order], w[~link][order]
        names, c = np.unique(was, return_inverse=True)
        x, y = np.searchsorted(ids, a[link]), np.searchsorted(ids, b[link])
        by = np.lexsort((y, x))
        to = best_moves(np.searchsorted(x[by], np.arange(len(ids) + 1)), y[by], w[link][by], k, c, two_m)
        return pa.RecordBatch.from_arrays([pa.array(ids, t.schema.field(2).type), pa.array(k), pa.array(names[to], t.schema.field(2).type), pa.array(to != c)], names=["a", "k", "c", "goes"])

    at, held = None, []
    for batch in batches:
        group = batch.column(0).to_numpy()
        ends = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(ends, ends[1:]):
            if a < b:
                if held and group[a] != at:
                    yield done(held)
                    held = []
                at = group[a]
                held.append(batch.slice(a, b - a))
    if held:
        yield done(held)


def best_moves(start: np.ndarray, near: np.ndarray, weight: np.ndarray, k: np.ndarray, c: np.ndarray, two_m: float) -> np.ndarray:
    """The community of each node after moves, one by one, to the neighbouring one of the greatest gain, until no node wants
    to. start: where each node's neighbours begin in near and weight; k: degrees; c: communities, from 0 on."""
    c, total = c.copy(), np.bincount(c, weights=k)
    order = np.random.default_rng(len(k)).permutation(len(k)).tolist()
    degree = k.tolist()
    todo, whole = order, True
    while True:
        woken: dict[int, None] = {}
        for x in todo:
            s = slice(start[x], start[x + 1])
            own, kx = c[x], degree[x]
            other, at = np.unique(c[near[s]], return_inverse=True)
            if not len(other) or (len(other) == 1 and other[0] == own):
                continue
            score = np.bincount(at, weights=weight[s]) - kx / two_m * (total[other] - kx * (other == own))
            mine = np.flatnonzero(other == own)
            stay = score[mine[0]] if len(mine) else -kx / two_m * (total[own] - kx)
            best = int(np.round(score, 9).argmax())
            if score[best] - stay > LEAST_GAIN * min(kx, 1.0) and other[best] != own:
                total[own] -= kx
                total[other[best]] += kx
                c[x] = other[best]
                woken.update(dict.fromkeys(near[s].tolist()))
                woken.pop(x, None)
        if not woken and whole:
            return c
        # Neighbours of what moved first; then all, as the degrees of communities have changed for others too.
        todo, whole = (list(woken), False) if woken else (order, True)


def _moves_of_all(links: DataFrame, now: DataFrame, two_m: float, r: int) -> tuple[DataFrame, int]:
    """a, k and c after one round of moves between any communities, and how many; none only if no node wants to move.

    Moves of a round go from communities that only lose nodes in it to such that only gain some, by a hash; so of two moves
    at once each has at least its own gain, less the product of the two degrees where they share an end. A move whose gain
    is above its half of all such losses is made, which keeps the sum of all above zero. Where none is, those are made
    that are the best of both communities that they touch, which are then all apart. So each round raises the modularity,
    and many nodes move in it, also to one hub.
    """
    salt = F.lit(str(r))  # a string, so that the compiled code of all rounds is the same
    totals = now.groupBy("c").agg(F.sum("k").alias("tot"))
    reach = links.join(now.select(F.col("a").alias("b"), "c"), "b").select("a", "c", "w").unionByName(now.select("a", "c", F.lit(0.0).alias("w")))
    into = reach.groupBy("a", "c").agg(F.sum("w").alias("into"))
    own = now.select("a", F.col("c").alias("was"), "k")
    scored = into.join(totals, "c").join(own, "a").withColumn("score", F.col("into") - F.col("k") * (F.col("tot") - F.when(F.col("c") == F.col("was"), F.col("k")).otherwise(0.0)) / two_m)
    best = scored.groupBy("a", "was", "k").agg(F.max_by("c", F.struct(F.round("score", 9), F.xxhash64("c", salt))).alias("to"), F.max("score").alias("_best"), F.max(F.when(F.col("c") == F.col("was"), F.col("score"))).alias("_stay"))
    gain = F.col("_best") - F.col("_stay")
    side = lambda c: F.pmod(F.xxhash64(c, salt), F.lit(2))  # noqa: E731, B023
    wants = best.select("a", "k", "was", "to", gain.alias("gain"), ((F.col("to") != F.col("was")) & (gain > LEAST_GAIN * F.least(F.col("k"), F.lit(1.0)))).alias("wants"))
    wants = checkpointed(wants.withColumn("may", F.col("wants") & (side("was") == 0) & (side("to") == 1)))
    may = wants.where("may")
    left, come = may.groupBy("was").agg(F.sum("k").alias("_out")), may.groupBy("to").agg(F.sum("k").alias("_in"))
    loss = F.col("k") * (F.col("_out") + F.col("_in") - 2 * F.col("k")) / (2 * two_m)
    after, made = _moved(wants.join(left, "was", "left").join(come, "to", "left").withColumn("goes", F.col("may") & (F.col("gain") > loss)))
    if not made:
        order = F.struct(F.round("gain", 9), F.xxhash64("a", salt), "a")
        ends = wants.where("wants").select(F.explode(F.array("was", "to")).alias("c"), order.alias("o")).groupBy("c").agg(F.max("o").alias("o"))
        apart = wants.withColumn("o", order).join(ends.toDF("was", "_w"), "was", "left").join(ends.toDF("to", "_t"), "to", "left")
        after, made = _moved(apart.withColumn("goes", F.col("wants") & (F.col("o") == F.col("_w")) & (F.col("o") == F.col("_t"))))
    return after, made


def _moved(marked: DataFrame) -> tuple[DataFrame, int]:
    """a, k and c after the moves that are marked to go, and how many these are."""
    goes = F.coalesce("goes", F.lit(False))
    after = checkpointed(marked.select("a", "k", F.when(goes, F.col("to")).otherwise(F.col("was")).alias("c"), goes.alias("_goes")))
    return after.drop("_goes"), after.where("_goes").count()


def modularity(edges: DataFrame, parts: DataFrame) -> DataFrame:
    both = edges.select("a", "b", "weight").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight"))
    two_m = both.agg(F.sum("weight").cast("double").alias("two_m"))
    named = both.join(parts.toDF("a", "ca"), "a").join(parts.toDF("b", "cb"), "b")
    inside = named.where("ca = cb").agg(F.coalesce(F.sum("weight"), F.lit(0)).cast("double").alias("inside"))
    spread = named.groupBy("ca").agg(F.sum("weight").cast("double").alias("d")).agg(F.sum(F.col("d") * F.col("d")).alias("squares"))
    return two_m.crossJoin(inside).crossJoin(spread).select((F.col("inside") / F.col("two_m") - F.col("squares") / F.col("two_m") / F.col("two_m")).alias("modularity"))


def detach_delete(nodes: DataFrame, edges: DataFrame, key: str, src: str, dst: str, gone: Column) -> tuple[DataFrame, DataFrame]:
    """Nodes without those for which `gone` holds, and edges without those that end in one of them."""
    out = nodes.where(gone).select(F.col(key).alias("_gone")).distinct()
    left = nodes.where(~F.coalesce(gone, F.lit(False)))
    kept = edges.join(out, F.col(src) == F.col("_gone"), "left_anti").join(out, F.col(dst) == F.col("_gone"), "left_anti")
    return left, kept


def describe(tables: dict[str, DataFrame]) -> DataFrame:
    """label, property, type and how many nodes have the property, of each node table; one pass over each."""
    out = None
    for label, df in tables.items():
        counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
        rows = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(f.name).alias("property"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("n")) for f in df.schema.fields])
        one = counted.select(F.explode(rows).alias("r")).select("r.*")
        out = one if out is None else out.unionByName(one)
    return out
