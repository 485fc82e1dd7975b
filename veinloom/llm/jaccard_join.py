"""Exact Jaccard join of word n-gram sets through R-trees over count vectors.

1. Every text becomes its set of shingle hashes. Equal sets are one node. For sets within the threshold, the symmetric
   difference is at most H, known from the size class; so of H + 1 groups of the hash range that a set fills, one at
   least is equal in both. Each node emits one key a group (for its own size class and the one below), and nodes that share a
   key are possible partners. No pair is lost, and a passage that many texts share makes no common key.
2. Possible partners form clusters. A cluster is worked on in blocks of bounded size: an R-tree over the counts of
   shingles in 128 hash groups finds the points whose summed coordinate minima reach the overlap needed, and the survivors
   are verified on the sets. Within a block, nodes that are linked already are not compared again.
3. Clusters larger than a block are dealt into several, with common pivots; what these leave in more than one component
   is then compared block by block, the rest of the cluster against its largest component, which makes it exact. There the
   trees see count vectors only; sets are made again, and verified, for the nodes that have a possible partner.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm.components import connected_components
from veinloom.llm.quality_classifier import in_chunks
from veinloom.llm.storage import Scratch, table, written
from veinloom.llm.worker_cache import forget

SHINGLE = 3
PERCENT = 90
#: Groups of hashes that are counted; with about as many groups as shingles the summed minima of unlike sets stay low.
GROUPS = 128
#: Nodes of a block, and characters of their texts.
BLOCK, BLOCK_CHARS = 2048, 8_000_000
#: About so many nodes of a large cluster are in each of its blocks.
PIVOTS = 64
LEAF = 16
#: Ways of cutting the hash range; a set goes on to the next if it leaves too many groups of the one before empty.
SEEDS = 4
#: Bits that say which texts may be chosen (16 MB).
MARKS = 1 << 27
MAX_WORDS_KNOWN = 500_000
MAX_NODES_KNOWN = 500_000
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_WORDS_KNOWN:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_sets(texts: list[str | None], known: _Words, n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the n-word shingles of each text, A-Z in lower case. A text of fewer words is one
    shingle; one without words has none."""
    words = [x.encode("utf-8", "surrogatepass").lower().split() if x else [] for x in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    total = int(sizes.sum())
    flat = np.fromiter((known[w] for ws in words for w in ws), dtype=np.uint64, count=total)
    ends = np.cumsum(sizes)
    out = []
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, total - n + 1), dtype=np.uint64)
        for k in range(n):
            rolled = mix(rolled * _M1 + flat[k : k + len(rolled)] + _M2)
        for end, size in zip(ends, sizes):
            if size >= n:
                out.append(np.unique(rolled[end - size : end - n + 1]))
            elif size:
                h = np.full(1, size, dtype=np.uint64)
                for w in flat[end - size : end]:
                    h = mix(h * _M3 + w)
                out.append(h)
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out


def size_class_bounds(percent: int, top: int) -> np.ndarray:
    """Lower bounds of size classes such that a set's partners are in its own class or the next ones to it."""
    bounds = [1]
    while bounds[-1] <= top:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.array(bounds + [bounds[-1] * 100 // percent + 1, 1 << 40], dtype=np.int64)


def most_different(percent: int, sum_of_sizes: int) -> int:
    """Largest symmetric difference of two sets with that sum of sizes whose Jaccard index is percent / 100 or more."""
    return sum_of_sizes * (100 - percent) // (100 + percent)


def group_count(needed: int, seed: int) -> int:
    """Groups for sets that differ in fewer than `needed` shingles, with some to spare for groups that are empty in both.

    Of the groups that a set fills, at least `needed`, one is equal in the other set. So a set that fills enough needs no
    keys for its empty groups, and no other way of cutting."""
    return needed + needed // 16 + (4 if needed > 8 else 0) + seed * (needed // 8)


def block_keys(s: np.ndarray, percent: int, bounds: np.ndarray) -> np.ndarray:
    """Keys of which two sets within the threshold share one at least."""
    n = len(s)
    if not n:
        return np.zeros(0, dtype=np.int64)
    own = int(np.searchsorted(bounds, n, side="right")) - 1
    keys = []
    with np.errstate(over="ignore"):
        for c in (own, own - 1):
            if c < 0:
                continue
            needed = most_different(percent, int(bounds[c + 1] - 1 + bounds[c + 2] - 1)) + 1
            for seed in range(SEEDS):
                groups = group_count(needed, seed)
                h = s if not seed else np.sort(mix(s + np.uint64(seed) * _M3))
                cuts = np.searchsorted(h, (np.arange(1, groups, dtype=np.uint64) * np.uint64((1 << 64) // groups if groups > 1 else 0)), side="left")
                begin = np.concatenate([[0], cuts])
                count = np.diff(np.append(begin, n))
                full = np.flatnonzero(count)
                sums = np.add.reduceat(mix(h * _M1 + _M2), begin[full])
                label = np.uint64(c * 64 + seed) * _M2 + full.astype(np.uint64) * _M3 + count[full].astype(np.uint64)
                keys.append(mix(mix(sums) + mix(label)))
                if len(full) >= needed:
                    break
                if seed == SEEDS - 1:
                    empty = np.setdiff1d(np.arange(groups), full).astype(np.uint64)
                    keys.append(mix(mix(np.uint64(c * 64 + 63) * _M2 + empty * _M3)))
    return np.unique(np.concatenate(keys)).view(np.int64)


def points_of(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), GROUPS), dtype=np.int32)
    for i, s in enumerate(sets):
        out[i] = np.bincount((s >> np.uint64(57)).astype(np.int64), minlength=GROUPS)
    return out


class CountTree:
    """An R-tree of two levels over count vectors, packed by size and by the first coordinates."""

    def __init__(self, points: np.ndarray):
        self.size = points.sum(axis=1)
        slab = np.argsort(self.size, kind="stable")
        per_slab = LEAF * max(1, int(np.sqrt(len(points) / LEAF)))
        parts = [slab[i : i + per_slab] for i in range(0, len(slab), per_slab)]
        self.order = np.concatenate([p[np.lexsort((points[p, 1], points[p, 0]))] for p in parts]) if parts else slab
        self.points = points
        self.leaves = [self.order[i : i + LEAF] for i in range(0, len(self.order), LEAF)]
        self.leaf_top = np.array([points[x].max(axis=0) for x in self.leaves])
        self.leaf_least = np.array([self.size[x].min() for x in self.leaves])
        self.leaf_most = np.array([self.size[x].max() for x in self.leaves])

    def near(self, p: np.ndarray, percent: int) -> np.ndarray:
        """Points whose bound on the overlap with the point p reaches what the threshold asks for."""
        n = int(p.sum())
        need = lambda m: -(-percent * (n + m) // (100 + percent))
        ok = (self.leaf_most * 100 >= percent * n) & (self.leaf_least * percent <= 100 * n)
        at = np.flatnonzero(ok)
        at = at[np.minimum(self.leaf_top[at], p).sum(axis=1) >= need(np.maximum(self.leaf_least[at], -(-percent * n // 100)))]
        if not len(at):
            return at
        inside = np.concatenate([self.leaves[i] for i in at])
        return inside[np.minimum(self.points[inside], p).sum(axis=1) >= need(self.size[inside])]


def linked(a, b, percent: int) -> bool:
    """Whether two sets reach the threshold; both are sorted arrays, or both are Python's sets."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True)) if isinstance(a, np.ndarray) else len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def tree_links(sets: list[np.ndarray], part: np.ndarray, percent: int = PERCENT, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join what the threshold joins: no pair of nodes that is linked stays in two parts.

    part: the part each set is in already; sides: if given, 1 or 2 for each set, and only pairs of both sides are compared.
    """
    if len(sets) == 2:  # a tree of one leaf; most blocks are of this kind
        apart = part[0] != part[1] and (sides is None or sides[0] != sides[1])
        return [(0, 1)] if apart and linked(sets[0], sets[1], percent) else []
    points = points_of(sets)
    inner = np.arange(len(sets)) if sides is None else np.flatnonzero(sides == 1)
    if not len(inner):
        return []
    tree = CountTree(points[inner])
    root = np.unique(part, return_inverse=True)[1].copy()
    out = []
    for q in range(len(sets)) if sides is None else np.flatnonzero(sides == 2).tolist():
        near = inner[tree.near(points[q], percent)]
        if sides is None:
            near = near[near > q]
        near = near[root[near] != root[q]]
        while len(near):
            x = near[0]
            if linked(sets[q], sets[x], percent):
                out.append((q, int(x)))
                root[root == root[x]] = root[q]
                near = near[root[near] != root[q]]
            else:
                near = near[1:]
    return out


def plain_links(members: list[np.ndarray], part: list[int], percent: int) -> list[tuple[int, int]]:
    """The same for a few sets, sorted arrays, without a tree: each set against one after the other that is in another part."""
    root = list(part)
    sizes = [len(m) for m in members]
    out = []
    for q in range(1, len(members)):
        a, n = members[q], sizes[q]
        low, high = percent * n, 100 * n
        for x in range(q):
            m = sizes[x]
            if root[x] != root[q] and 100 * m >= low and percent * m <= high:
                c = np.concatenate((a, members[x]))
                c.sort()
                both = np.count_nonzero(c[1:] == c[:-1])
                if 100 * both >= percent * (n + m - both):
                    out.append((q, x))
                    old, new = root[x], root[q]
                    root = [new if r == old else r for r in root]
    return out


def identified(documents: DataFrame) -> DataFrame:
    """doc_id, h (a hash of the text) and text: rows of one id with different texts are kept apart by h."""
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def free_names(documents: DataFrame, n: int) -> list[str]:
    """Names that no column of documents has."""
    taken = {c.lower() for c in documents.columns}
    return [name for name in (f"_beside_{i}" for i in range(n + len(taken))) if name not in taken][:n]


def beside(documents: DataFrame, found: DataFrame, value: str) -> DataFrame:
    """The columns of documents and, as the last one, what `found` (doc_id, h, value) has for their id and text, or null.
    Columns of documents may have any names."""
    doc, h, last = free_names(documents, 3)
    named = found.select(F.col("doc_id").alias(doc), F.col("h").alias(h), F.col(value).alias(last))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(F.col("text").cast("string")) == F.col(h))
    return documents.join(named, same, "left").drop(doc, h)


def signatures(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, h, size of the set, node and check (hashes of the whole set, 128 bits together; null if it is empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known = _Words()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in in_chunks(texts, 1_000_000):
                sets = shingle_sets(texts[a:b], known, shingle)
                both = [set_hash(s) for s in sets]
                node = pa.array([None if x is None else (x >> 64) - (1 << 63) for x in both], pa.int64())
                check = pa.array([None if x is None else (x & ((1 << 64) - 1)) - (1 << 63) for x in both], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), node, check], names=["doc_id", "h", "n", "node", "check"])

    return identified(documents).mapInArrow(run, "doc_id long, h long, n long, node long, check long")


def set_hash(s: np.ndarray) -> int | None:
    """128 bits of a set; none if it is empty."""
    return xxhash.xxh3_128_intdigest(s.tobytes(), seed=len(s)) if len(s) else None


def key_lists(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """node and its keys, once for each node in a task. They take more room than the texts, so they are made where they are
    shuffled, from the texts once more, and never written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known, nodes, bounds = _Words(), set(), size_class_bounds(percent, 1 << 30)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in in_chunks(texts, 1_000_000):
                node, keys = [], [np.zeros(0, dtype=np.int64)]
                for s in shingle_sets(texts[a:b], known, shingle):
                    if len(s) and (x := (set_hash(s) >> 64) - (1 << 63)) not in nodes:
                        nodes.add(x)
                        node.append(x)
                        keys.append(block_keys(s, percent, bounds))
                if len(nodes) > MAX_NODES_KNOWN:
                    nodes.clear()
                offsets = np.cumsum([len(k) for k in keys], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys)))], names=["node", "keys"])

    return documents.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "node long, keys array<long>")


def may_be_among(chosen: DataFrame, keys: list[str]) -> Callable[..., Column]:
    """A condition that holds for all rows with the keys of chosen, and for few others: bits of hashes, at most MARKS of them. So
    texts that are not chosen need not be shuffled to find that out."""
    marks = min(MARKS, max(1 << 15, 1 << (64 * chosen.count()).bit_length()))
    place = lambda *c: F.pmod(F.xxhash64(*c), F.lit(marks))
    x = chosen.select((place(*keys) + 1).alias("x"))  # bits of buckets are counted from 1
    rows = x.groupBy(F.bitmap_bucket_number("x").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bits")).toArrow().to_pylist()
    bits = np.zeros(marks >> 3, dtype=np.uint8)
    for r in rows:  # 32,768 bits each
        bits[(r["k"] - 1) << 12 : r["k"] << 12] = np.frombuffer(r["bits"], dtype=np.uint8)
    sent = chosen.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def marked(at: pd.Series) -> pd.Series:
        v = at.to_numpy()
        return pd.Series((sent.value[v >> 3] >> (v & 7).astype(np.uint8)) & 1 == 1)

    return lambda *c: marked(place(*c))


_TASK = "task string, node long, part long, side int, text string"


class WordShingles:
    """Makes the sets of word shingles of texts; one for each task, for what it remembers."""

    #: Blocks of up to so many nodes are compared without a tree: none.
    plain = 0

    def __init__(self, n: int = SHINGLE):
        self.n = n

    def maker(self) -> Callable[[list], list[np.ndarray]]:
        known = _Words()
        return lambda texts: shingle_sets(texts, known, self.n)


def by_task(columns: Iterator[tuple[list, ...]]) -> Iterator[list[tuple]]:
    """The rows of one task after the other, of columns (task, node, ...) that are sorted by task; a node that comes twice
    counts once."""
    task, block = None, {}
    for batch in columns:
        for r in zip(*batch):
            if r[0] != task:
                if block:
                    yield list(block.values())
                    block = {}
                task = r[0]
            block[r[1]] = r
    if block:
        yield list(block.values())


def block_links(rows: DataFrame, shingles, percent: int) -> DataFrame:
    """Links (a, b) found in each task's block of rows; a block is bounded by how tasks are dealt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        sets_of = shingles.maker()

        def with_sets() -> Iterator[tuple[list, ...]]:
            for batch in batches:
                task, node, part, side, texts = (batch.column(i).to_pylist() for i in range(5))
                once = dict(zip(node, texts))
                sets = dict(zip(once, sets_of(list(once.values()))))
                yield task, node, part, side, [sets[n] for n in node]

        def out(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        found: list[tuple[int, int]] = []
        for block in by_task(with_sets()):
            if len(block) < 2:
                continue
            if len(block) <= shingles.plain and not block[0][3]:
                links = plain_links([r[4] for r in block], [r[2] for r in block], percent)
            else:
                sides = np.array([r[3] for r in block])
                links = tree_links([np.unique(r[4]) for r in block], np.array([r[2] for r in block], dtype=np.int64), percent, sides if sides.any() else None)
            found += [(block[i][1], block[j][1]) for i, j in links]
            if len(found) > 10_000:
                yield out(found)
                found = []
        yield out(found)

    return rows.select("task", "node", "part", "side", "text").repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def count_vectors(rows: DataFrame, shingles) -> DataFrame:
    """node, root, part and text of rows, and counts, the count vectors of the texts' sets."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        sets_of = shingles.maker()
        for frame in frames:
            points = points_of([np.unique(s) for s in sets_of(frame["text"].tolist())])
            yield frame.assign(counts=[p.tobytes() for p in points.astype("<i4")])

    return rows.select("node", "root", "part", "text").mapInPandas(run, "node long, root long, part long, text string, counts binary")


def possible_nodes(rows: DataFrame, percent: int) -> DataFrame:
    """task, node, part and side of the rows (with counts) that have a possible partner of another part in their task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for block in by_task(tuple(f[c].tolist() for c in ("task", "node", "part", "side", "counts")) for f in frames):
            points = np.frombuffer(b"".join(r[4] for r in block), dtype="<i4").reshape(len(block), GROUPS)
            part, sides = np.array([r[2] for r in block]), np.array([r[3] for r in block])
            inner = np.flatnonzero(sides < 2)
            hit = np.zeros(len(block), dtype=bool)
            if len(inner):
                tree = CountTree(points[inner])
                for q in range(len(block)) if not sides.any() else np.flatnonzero(sides == 2).tolist():
                    near = inner[tree.near(points[q], percent)]
                    near = near[part[near] != part[q]]
                    if len(near):
                        hit[q] = True
                        hit[near] = True
            if hit.any():
                yield pd.DataFrame([block[i][:4] for i in np.flatnonzero(hit)], columns=["task", "node", "part", "side"])

    return rows.select("task", "node", "part", "side", "counts").repartition("task").sortWithinPartitions("task").mapInPandas(run, "task string, node long, part long, side int")


def keyed_nodes(rows: DataFrame) -> DataFrame:
    """key and node for all keys of rows. Dealt by key once; what groups and what joins by key share that shuffle."""
    # The filters are those that the join would add on its side; with them here, both sides share one shuffle.
    return rows.where(F.size("keys") > 0).select(F.explode("keys").alias("key"), "node").where("key is not null and node is not null").repartition("key")


def key_clusters(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """node and root of all nodes that are joined by common keys; rows: node, keys. Each key's nodes are linked to its
    least node only, so a key that very many share gives no pairs."""
    keyed = keyed_nodes(rows)
    first = keyed.groupBy("key").agg(F.min("node").alias("to"), F.max("node").alias("_last")).where("to <> _last").drop("_last")
    return connected_components(keyed.join(first, "key").where("node <> to").select("node", "to"), scratch)


def near_components(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles and component_id of every row.

    Null, empty and white texts have no shingles and are linked with nothing: their component is their own id. Rows with
    equal sets are one node, whatever their ids; the component's name is the least doc_id in it (nulls do not count, and a
    component of rows without ids has none). Rows of one id with different texts are told apart by h. Other columns are
    not read; an empty table gives no rows. Nodes go by 64 bits of a hash of the whole set; another 64 bits are compared
    before rows count as equal.
    """
    with Scratch(documents.sparkSession) as scratch:
        rows = scratch.written(signatures(documents, shingle), "rows")
        clusters = scratch.written(key_clusters(key_lists(documents, shingle, percent), scratch), "clusters")
        scratch.collect_garbage()
        # One row stands for each node; only nodes with a possible partner are read again.
        stands = rows.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "check")).alias("at"))
        chosen = stands.join(clusters, "node").select(F.col("at.doc_id").alias("_doc"), F.col("at.h").alias("_h"), "node", "root")
        chosen = scratch.written(chosen, "chosen")
        texts = identified(documents).where(may_be_among(chosen, ["_doc", "_h"])(F.col("doc_id"), F.col("h")))
        read = texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("h") == F.col("_h")))
        # Repeated rows of one id and text are one member.
        members = scratch.written(read.groupBy("node", "root").agg(F.max("text").alias("text")), "members")
        parts = connected_components(cluster_links(members, WordShingles(shingle), percent, scratch, block), scratch)
        # The least id is taken over rows that are equal by all 128 bits; one with other check bits stands alone.
        least = rows.where("node is not null").groupBy("node", "check").agg(F.min("doc_id").alias("_least"))
        in_part = least.join(stands.select("node", F.col("at.check").alias("_c")), "node").withColumn("_own", F.col("check") != F.col("_c")).join(parts, "node", "left")
        in_part = in_part.withColumn("root", F.when(~F.col("_own"), F.coalesce("root", "node")).otherwise(F.col("node"))).withColumn("_c", F.when(F.col("_own"), F.col("check")))
        in_part = scratch.written(in_part.select("node", "check", "root", "_c", "_least"), "parts")
        names = scratch.written(in_part.groupBy("root", "_c").agg(F.min("_least").alias("component_id")), "names")  # so Spark can split a hot root
        names = names.toDF("_root", "_of", "component_id")
        named = in_part.join(names, (F.col("root") == F.col("_root")) & F.col("_c").eqNullSafe(F.col("_of"))).select("node", "check", "component_id")
        done = rows.join(named, ["node", "check"], "left")
        return written(done.select("doc_id", "h", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")), "components")


def cluster_links(members: DataFrame, shingles, percent: int, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """Links that join what the threshold joins among the members (node, root, text) of clusters; a node may be in several.
    Clusters within a block are compared as one; larger ones in blocks with common pivots, then in pairs of blocks where
    parts remain. A block is bounded in nodes and in characters."""
    full = lambda n, chars, of: F.ceil(F.greatest(n / of, chars / BLOCK_CHARS)).cast("int")
    sizes = scratch.written(members.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum(F.length("text")).alias("chars")).where("size > 1").withColumn("blocks", full(F.col("size"), F.col("chars"), block)), "sizes")
    sized = members.join(sizes, "root")
    blocks = F.col("blocks")
    own = F.pmod(F.xxhash64("node", F.lit(1)), blocks).cast("int")
    pivot = (F.pmod(F.xxhash64("node", F.lit(2)), F.col("size")) < PIVOTS) & (blocks > 1)
    dealt = sized.withColumn("_k", F.explode(F.when(pivot, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own))))
    links = scratch.written(block_links(dealt.select(F.concat_ws(":", "root", "_k").alias("task"), "node", F.col("node").alias("part"), F.lit(0).alias("side"), "text"), shingles, percent), "links")
    if sizes.where("blocks > 1").limit(1).count():
        large = sized.where("blocks > 1").select("node", "root", "text")
        links = links.unionByName(_rest_links(large, links, shingles, percent, scratch, full, max(1, block // 2)))
    return links


def _rest_links(large: DataFrame, links: DataFrame, shingles, percent: int, scratch: Scratch, full, half: int) -> DataFrame:
    """What the dealt blocks cannot see: pairs of different components of a large cluster, one of them not in the largest."""
    theirs = links.join(large.select(F.col("node").alias("a")).distinct(), "a", "left_semi")
    parts = connected_components(theirs, scratch)
    nodes = large.join(parts.withColumnRenamed("root", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    nodes = scratch.written(count_vectors(nodes, shingles).withColumn("chars", F.length("text")).withColumn("_h", F.xxhash64("node", F.lit(3))), "open")
    counts = scratch.written(nodes.groupBy("root", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("c")), "counts")
    top = counts.groupBy("root").agg(F.max_by(F.struct("part", "n", "c"), F.struct("n", "part")).alias("top"), F.sum("n").alias("n"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("n_parts")).where("n_parts > 1")
    top = top.select("root", F.col("top.part").alias("top"), full(F.col("top.n"), F.col("top.c"), half).alias("_top"), full(F.col("n") - F.col("top.n"), F.col("c") - F.col("top.c"), half).alias("_rest"))
    open_ = nodes.select("node", "root", "part", "counts", "_h").join(top, "root")
    is_top = F.col("part") == F.col("top")
    near = open_.where(is_top).withColumn("_i", F.pmod("_h", "_top")).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_rest") - 1))).withColumn("side", F.lit(1))
    far = open_.where(~is_top).withColumn("_j", F.pmod("_h", "_rest")).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_top") - 1))).withColumn("side", F.lit(2))
    mine = F.pmod("_h", "_rest")
    other = open_.where(~is_top).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_rest") - 1)))
    other = other.withColumn("_i", F.least(mine, F.col("_o"))).withColumn("_j", F.greatest(mine, F.col("_o"))).withColumn("side", F.lit(0))
    task = lambda d, kind: d.select(F.concat_ws(":", F.lit(kind), "root", "_i", "_j").alias("task"), "node", "part", "side", "counts")
    possible = possible_nodes(task(near, "t").unionByName(task(far, "t")).unionByName(task(other, "r")), percent)
    possible = scratch.written(possible, "possible")
    found = scratch.written(block_links(possible.join(nodes.select("node", "text").dropDuplicates(["node"]), "node"), shingles, percent), "links")
    scratch.drop(nodes, counts, possible)
    return found


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents: doc_id, n_shingles, component_id; see near_components for nulls, ties and
    repeated rows."""
    return near_components(table(spark, sf_dir, "documents")).drop("h")


#: All pairs that share a shingle, and a recursive walk over the links.
_ORACLE = """
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0b\\f\\r]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 2) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
r(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)
"""

QUERIES: dict[str, Callable] = {"op8_ngram_jaccard": op8_ngram_jaccard}
ORACLES: dict[str, str] = {"op8_ngram_jaccard": _ORACLE}
