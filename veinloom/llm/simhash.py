"""SimHash near-duplicates: documents whose 64-bit fingerprints differ in few bits, found with BK-trees.

In a BK-tree a child hangs at its parent by an edge that bears their Hamming distance, one child an edge. If a fingerprint
is d bits from a node, all within r bits of it lie below edges from d - r to d + r; only these are followed.

Fingerprints within r bits are equal in at least m - r of m ranges of their bits, so a shard holds the fingerprints that
are equal in some m - r ranges, and every link lies within a shard. Where shards are small, a task builds the trees of many
shards as one forest and looks each of their fingerprints up. A shard that is too large for a task is cut into trees of
bounded size, which are broadcast, in blocks, to its fingerprints where they lie.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm.components import connected_components
from veinloom.llm.storage import Scratch, table, written
from veinloom.llm.worker_cache import forget

WORDS, SEED, RADIUS = 3, 42, 3
#: Shards have so many fingerprints on average at most, where these are spread evenly; more ranges of bits make them smaller.
SHARD = 4_096
#: A shard with more fingerprints is cut into trees of about half as many; trees are broadcast in blocks of so many
#: fingerprints (32 MB with their edges).
LARGE, BROADCAST = 1 << 15, 1 << 20
#: Fingerprints of small shards that a task takes together; pairs of a fingerprint and a node that are compared at a time.
FOREST, FRONTIER = 1 << 17, 1 << 20
#: Shingles that are hashed before their bits are counted.
PIECE = 1 << 17


def _bits(hashes: np.ndarray) -> np.ndarray:
    """64 columns, from the least significant bit."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints_of(texts: list[str | None]) -> np.ndarray:
    """Fingerprints as unsigned longs; texts are hashed whole, long ones piece by piece."""
    counts, totals = np.zeros((len(texts), 64), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    hashes: list[int] = []
    owners: list[tuple[int, int]] = []

    def count() -> None:
        sizes = np.array([n for _, n in owners])
        if len(hashes):
            starts = np.cumsum(sizes) - sizes
            np.add.at(counts, np.array([d for d, _ in owners]), np.add.reduceat(_bits(np.array(hashes, dtype=np.uint64)), starts, axis=0, dtype=np.int64))
        hashes.clear()
        owners.clear()

    for d, text in enumerate(texts):
        # White space of bytes is exactly the blank and \x09 to \x0D, and lower() changes A-Z only.
        words = text.encode("utf-8").lower().split() if text else []
        n = max(1, len(words) - WORDS + 1) if words else 0
        totals[d] = n
        for a in range(0, n, PIECE):
            b = min(a + PIECE, n)
            parts = [words[a + i : b + i] for i in range(WORDS)] if len(words) >= WORDS else [words]
            shingles = map(b" ".join, zip(*parts)) if len(words) >= WORDS else [b" ".join(words)]
            hashes.extend(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)))
            owners.append((d, b - a))
            if len(hashes) >= PIECE:
                count()
    count()
    return np.packbits(2 * counts > totals[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """_id and fp (the fingerprint as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints_of(batch.column(1).to_pylist()).view(np.int64))], names=["_id", "fp"])

    return documents.select(F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "_id long, fp long")


class Forest:
    """A BK-tree for each shard, as arrays. shards must be sorted; fingerprints of a shard are different."""

    def __init__(self, shards: np.ndarray, prints: np.ndarray):
        self.prints = prints
        self.shards, self.roots = np.unique(shards, return_index=True)
        # Each turn the first fingerprint of every group is its node, and the others are grouped by that node and their
        # distance to it; such a group hangs at the node by that edge, and its first fingerprint is the child.
        left = np.arange(len(prints))
        group = shards.copy()
        edges, children = [], []
        while len(left):
            first = np.r_[True, group[1:] != group[:-1]]
            node = left[first][np.cumsum(first) - 1]
            rest = ~first
            left, node = left[rest], node[rest]
            apart = np.bitwise_count(prints[left] ^ prints[node]).astype(np.int64)
            group = node * 65 + apart
            order = np.lexsort((left, group))
            left, group = left[order], group[order]
            if len(left):
                new = np.r_[True, group[1:] != group[:-1]]
                edges.append(group[new])
                children.append(left[new])
        self.edges, self.children = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (edges, children))
        order = np.argsort(self.edges)
        self.edges, self.children = self.edges[order], self.children[order]

    def near(self, prints: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of a queried fingerprint's number and a node within the radius below its root; a block at a time."""
        open_ = [(np.arange(a, min(a + FRONTIER // 16, len(prints))), roots[a : a + FRONTIER // 16]) for a in range(0, len(prints), FRONTIER // 16)]
        while open_:
            query, node = open_.pop()
            if len(query) > FRONTIER:
                open_ += [(query[a : a + FRONTIER // 2], node[a : a + FRONTIER // 2]) for a in range(0, len(query), FRONTIER // 2)]
                continue
            apart = np.bitwise_count(prints[query] ^ self.prints[node]).astype(np.int64)
            hit = apart <= radius
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(apart - radius, 0), "left")
            n = np.searchsorted(self.edges, node * 65 + np.minimum(apart + radius, 64), "right") - low
            if n.any():
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                open_.append((np.repeat(query, n), self.children[at]))


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each end of the pairs with the least of its component: as few pairs as join what these join."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(names))
    while True:
        least = np.minimum(label[x], label[y])
        now = label.copy()
        for end in (label[x], label[y], x, y):
            np.minimum.at(now, end, least)
        now = now[now]
        if (now == label).all():
            break
        label = now
    other = label != np.arange(len(names))
    return names[label[other]], names[other]


class _Links:
    """Pairs of linked fingerprints, reduced to spanning ones whenever many have come together."""

    def __init__(self):
        self.a, self.b, self.n = [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        differ = a != b
        self.a.append(a[differ])
        self.b.append(b[differ])
        self.n += int(differ.sum())
        if self.n > FRONTIER:
            a, b = self.taken()
            self.a, self.b, self.n = [a], [b], -len(a)  # the next reduction waits for as many again

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        return spanning(np.concatenate(self.a), np.concatenate(self.b)) if self.a else (np.zeros(0, dtype=np.int64),) * 2


def plan(n: int, radius: int = RADIUS, shard: int = SHARD) -> list[int]:
    """Masks of the bits that a shard's fingerprints share: all choices of m - radius of m even ranges, of the least m for
    which n evenly spread fingerprints leave shards of the wanted size."""
    for m in range(radius + 1, 17):
        ranges = [sum(1 << b for b in range(64 * i // m, 64 * (i + 1) // m)) for i in range(m)]
        masks = [sum(c) for c in combinations(ranges, m - radius)]
        if n >> min(x.bit_count() for x in masks) <= shard:
            break
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def linked(prints: DataFrame, scratch: Scratch, radius: int = RADIUS, large: int = LARGE) -> DataFrame:
    """a and b: pairs of different fingerprints (column fp, distinct) that join the same ones as all links do."""
    masks = [_signed(m) for m in plan(prints.count(), radius)]
    every = F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(m).alias("bits")) for i, m in enumerate(masks)])
    shards = prints.select("fp", F.explode(every).alias("s")).select("fp", F.col("s.i").alias("i"), F.col("s.bits").alias("bits"))
    sizes = scratch.written(shards.groupBy("i", "bits").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > large), "large")
    trees = sizes.agg(F.sum("n")).first()[0] or 0
    found = _in_small_shards(shards.join(sizes.select("i", "bits"), ["i", "bits"], "left_anti") if trees else shards, radius)
    if not trees:
        return scratch.written(found, "links")
    found = [scratch.written(found, "links")]
    # Pieces of large shards, told apart by a hash; as the fingerprints differ, pieces are of about equal size.
    hot = scratch.written(shards.join(sizes, ["i", "bits"]).withColumn("piece", F.pmod(F.xxhash64("fp"), F.ceil(2 * F.col("n") / large))), "hot")
    blocks = -(-trees // BROADCAST)
    for k in range(blocks):
        block = hot.where(F.pmod(F.xxhash64("i", "bits", "piece"), F.lit(blocks)) == k).select("i", "bits", "piece", "fp").toArrow()
        if block.num_rows:
            found.append(_near_broadcast(hot, block, scratch, radius))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _in_small_shards(shards: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        links = _Links()

        def look(rows: np.ndarray) -> None:
            new = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
            shard = np.cumsum(new) - 1
            size = np.bincount(shard)
            met = size[shard] > 1
            shard, prints = shard[met], rows[met, 2].view(np.uint64)
            if len(prints):
                forest = Forest(shard, prints)
                own = forest.roots[np.searchsorted(forest.shards, shard)]
                for query, node in forest.near(prints, own, radius):
                    links.add(prints[query].view(np.int64), prints[node].view(np.int64))

        kept = np.zeros((0, 3), dtype=np.int64)
        for batch in batches:
            kept = np.concatenate([kept, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)])
            if len(kept) > FOREST:  # all but the last shard, which may go on
                last = int(np.flatnonzero((kept[:, :2] != kept[-1, :2]).any(axis=1))[-1]) + 1 if (kept[:, :2] != kept[-1, :2]).any() else 0
                if last:
                    look(kept[:last])
                    kept = kept[last:].copy()
        if len(kept):
            look(kept)
        a, b = links.taken()
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    placed = shards.select(F.col("i").cast("long").alias("i"), "bits", "fp").repartition("i", "bits").sortWithinPartitions("i", "bits")
    return placed.mapInArrow(run, "a long, b long")


def _near_broadcast(hot: DataFrame, block: pa.Table, scratch: Scratch, radius: int) -> DataFrame:
    """Links between the trees of a block, which are broadcast, and all fingerprints of their shards."""
    columns = [block.column(n).to_numpy() for n in ("i", "bits", "piece", "fp")]
    order = np.lexsort(columns[2::-1])
    i, bits, piece, prints = (c[order] for c in columns)
    new = np.r_[True, (np.diff(i) != 0) | (np.diff(bits) != 0) | (np.diff(piece) != 0)]
    tree = np.cumsum(new) - 1
    roots: dict[tuple[int, int], list[int]] = {}
    for at in np.flatnonzero(new):
        roots.setdefault((int(i[at]), int(bits[at])), []).append(int(at))
    sent = hot.sparkSession.sparkContext.broadcast((Forest(tree, prints.view(np.uint64)), roots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        forest, of = sent.value
        links = _Links()
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            own = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            n = np.array([len(of.get(k, ())) for k in keys])
            starts = np.array([r for k in keys for r in of.get(k, ())], dtype=np.int64)
            query = np.repeat(own, n)
            for at, node in forest.near(query, starts, radius):
                links.add(query[at].view(np.int64), forest.prints[node].view(np.int64))
        a, b = links.taken()
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    out = scratch.written(hot.select("i", "bits", "fp").mapInArrow(run, "a long, b long"), "links")
    sent.destroy()
    return out


def near_copies(documents: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, large: int = LARGE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, a row for each row of documents.

    Null, empty and blank texts have fingerprint zero and are linked like any other. A row with a null id gets the component
    of what it links to, and links others; component_id is null where a component has no id. Repeated rows are rows of
    their own. An empty table gives no rows. Other columns are not read. Equal texts are one fingerprint, so a group of
    copies is one node; what joins rows with their component is a plain join, which is split where a fingerprint is hot.
    """
    spark = documents.sparkSession
    rows = written(fingerprints(documents, key, text), "fingerprints")
    with Scratch(spark) as scratch:
        prints = scratch.written(rows.groupBy("fp").agg(F.min("_id").alias("least")), "prints")
        links = linked(prints.select("fp"), scratch, radius, large)
        roots = connected_components(links, scratch)
        named = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
        of_root = named.groupBy("root").agg(F.min("least").alias("component_id"))
        parts = written(named.join(of_root, "root").select(F.col("fp").alias("_fp"), "component_id"), "components")
    return rows.join(parts, F.col("fp") == F.col("_fp")).select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents; see near_copies."""
    return near_copies(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable] = {"op11_simhash": op11_simhash}
ORACLES: dict[str, str] = {}
