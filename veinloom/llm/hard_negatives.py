"""Hard negatives of anchors by dual-tree search.

A ball tree over the anchors of each label meets a ball tree over the candidates of each label. For two nodes with centres
p and q and radii r and s all inner products lie in p.q -+ (|p| s + |q| r + r s), so a pair of nodes whose interval misses
what every anchor of the one still wants is left at once, with all anchors and candidates below. Pairs of leaves are scored
exactly. Positives are searched for first; their scores are the windows in which negatives are then searched for.

Anchors come in blocks of bounded size, each broadcast to all candidates, which stay where they were read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veinloom.llm.storage import Scratch, new_path, table
from veinloom.llm.vectors import integers, products, with_vectors
from veinloom.llm.worker_cache import forget

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: A negative's score is at least LEAST / 100 of its positive's, and at most all of it.
LEAST = 80
#: Numbers in the vectors of one block of anchors (32 MB as doubles).
BLOCK_NUMBERS = 1 << 22
ANCHOR_LEAF, CANDIDATE_LEAF = 32, 128
#: Candidates that get a tree together, and those that a task reads at least, if there are so many.
BATCH, TASK_NUMBERS = 16_384, 1 << 26
#: One more than the greatest long that a score may be.
NONE = -(1 << 62)


class BallTree:
    """Nodes as arrays: centre, its norm, radius, children (-1 at leaves) and the range of rows below, in tree order."""

    def __init__(self, rows: np.ndarray, leaf: int):
        self.order = np.arange(len(rows))
        self.centre, self.radius, self.left, self.right, self.range = [], [], [], [], []
        open_ = [(0, len(rows), None, 0)] if len(rows) else []
        while open_:
            a, b, parent, side = open_.pop()
            own = rows[self.order[a:b]]
            centre = own.mean(axis=0)
            apart = ((own - centre) ** 2).sum(axis=1)
            node = len(self.centre)
            if parent is not None:
                (self.right if side else self.left)[parent] = node
            self.centre.append(centre)
            self.radius.append(np.sqrt(apart.max()))
            self.left.append(-1)
            self.right.append(-1)
            self.range.append((a, b))
            if b - a > leaf and apart.max() > 0:  # equal rows stay together in one leaf
                pole = own[apart.argmax()]
                other = own[((own - pole) ** 2).sum(axis=1).argmax()]
                along = np.argpartition(own @ (other - pole), (b - a) // 2)
                self.order[a:b] = self.order[a:b][along]
                middle = (a + b) // 2
                open_ += [(a, middle, node, 0), (middle, b, node, 1)]
        self.centre = np.array(self.centre).reshape(len(self.radius), rows.shape[1])
        self.radius = np.array(self.radius)
        self.norm = np.sqrt((self.centre**2).sum(axis=1))

    def below(self, node: int) -> list[int]:
        return [self.left[node], self.right[node]] if self.left[node] >= 0 else [node]


def interval(a: BallTree, i: int, b: BallTree, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of rows below node i of a with rows below each of the nodes j of b, a little wide."""
    at = b.centre[j] @ a.centre[i]
    reach = a.norm[i] * b.radius[j] + b.norm[j] * a.radius[i] + a.radius[i] * b.radius[j]
    reach = reach * (1 + 1e-9) + 1e-9 * (1 + np.abs(at)) + 1e-6
    return at - reach, at + reach


class Best:
    """The k best candidates of each slot so far: scores (descending) and, at equal scores, ids (ascending)."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score, self.id, self.at = np.full((slots, k), NONE, dtype=np.int64), np.full((slots, k), np.iinfo(np.int64).max), np.full((slots, k), -1, dtype=np.int64)

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, places: np.ndarray) -> None:
        """One row for each hit; places tell candidates apart that have the same id."""
        touched = np.unique(slots)
        slots = np.concatenate([np.repeat(touched, self.k), slots])
        scores, ids, places = (np.concatenate([old[touched].ravel(), new]) for old, new in ((self.score, scores), (self.id, ids), (self.at, places)))
        order = np.lexsort((ids, -scores, slots))
        slots, scores, ids, places = slots[order], scores[order], ids[order], places[order]
        rank = np.arange(len(slots)) - np.searchsorted(slots, slots)
        kept = rank < self.k
        for old, new in ((self.score, scores), (self.id, ids), (self.at, places)):
            old[slots[kept], rank[kept]] = new[kept]

    @property
    def worst(self) -> np.ndarray:
        """What a candidate must reach to be among the best: the last of k scores, or nothing where there are fewer."""
        return self.score[:, -1]


class Search:
    """A block of anchors that looks through candidates batch after batch."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, windows: np.ndarray | None):
        """windows: for negatives, the positives' scores of each anchor, NONE where there are fewer; None for positives."""
        self.ids, self.labels, self.vectors, self.windows = ids, labels, vectors, windows
        self.rows = {int(k): np.flatnonzero(labels == k) for k in np.unique(labels)}
        self.trees = {k: BallTree(vectors[at], ANCHOR_LEAF) for k, at in self.rows.items()}
        if windows is None:
            self.best = [Best(len(ids), POSITIVES)]
            self.highest = [np.full(len(ids), np.iinfo(np.int64).max)]
            self.lowest = [np.full(len(ids), NONE)]
        else:
            self.best = [Best(len(ids), NEGATIVES) for _ in range(windows.shape[1])]
            self.highest = list(windows.T)
            # A window of a negative or missing score holds nothing: its lower end is above it.
            self.lowest = [np.where(w >= 0, -(-LEAST * w // 100), 1) for w in windows.T]

    def look(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, place: int) -> None:
        """place: number of the first of these candidates among all of the task."""
        for k in np.unique(labels):
            at = np.flatnonzero(labels == k)
            tree = BallTree(vectors[at], CANDIDATE_LEAF)
            for own, anchors in self.trees.items():
                if (own == k) == (self.windows is None):
                    self._meet(self.rows[own], anchors, tree, ids[at], vectors[at], place + at)

    def _meet(self, rows: np.ndarray, anchors: BallTree, tree: BallTree, ids: np.ndarray, vectors: np.ndarray, places: np.ndarray) -> None:
        open_ = [(0, np.array([0]))]
        while open_:
            i, nodes = open_.pop()
            a, b = anchors.range[i]
            own = rows[anchors.order[a:b]]
            # What is still wanted below this node: for each window from the least of its anchors' bounds to the greatest.
            low, high = interval(anchors, i, tree, nodes)
            wanted = np.zeros(len(nodes), dtype=bool)
            for best, bottom, top in zip(self.best, self.lowest, self.highest):
                needs = np.maximum(bottom[own], best.worst[own])
                live = needs <= top[own]
                if live.any():
                    wanted |= (high >= needs[live].min()) & (low <= top[own][live].max())
            if not wanted.any():
                continue
            nodes = nodes[wanted][np.argsort(-high[wanted], kind="stable")]  # the most promising first
            leaves = [j for j in nodes if tree.left[j] < 0]
            if anchors.left[i] < 0 and len(leaves) == len(nodes):
                for j in leaves:
                    c, d = tree.range[j]
                    at = tree.order[c:d]
                    self._score(own, ids[at], vectors[at], places[at])
                continue
            deeper = np.array([x for j in nodes for x in tree.below(j)])
            open_ += [(x, deeper) for x in anchors.below(i)]

    def _score(self, own: np.ndarray, ids: np.ndarray, vectors: np.ndarray, places: np.ndarray) -> None:
        scores = products(self.vectors[own], vectors)
        other = ids[None, :] != self.ids[own][:, None]
        for best, bottom, top in zip(self.best, self.lowest, self.highest):
            hit = (scores >= np.maximum(bottom[own], best.worst[own])[:, None]) & (scores <= top[own][:, None]) & other
            r, c = np.nonzero(hit)
            if len(r):
                best.add(own[r], scores[r, c], ids[c], places[c])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor's number and id, score and candidate's id: each candidate once for an anchor, whatever windows it is best in."""
        parts = [(np.repeat(np.arange(len(self.ids)), b.k), b.score.ravel(), b.id.ravel(), b.at.ravel()) for b in self.best]
        anchor, score, id_, at = (np.concatenate(x) for x in zip(*parts))
        _, first = np.unique(np.stack([anchor, at]), axis=1, return_index=True)
        first = first[at[first] >= 0]
        return anchor[first], self.ids[anchor[first]], score[first], id_[first]


def _found(candidates: DataFrame, block: tuple, scratch: Scratch, name: str, windows: np.ndarray | None = None) -> DataFrame:
    """_a (number of the anchor in its block), anchor_id, score and _id of the best candidates of each task, as a scratch
    table; the block is taken back from the executors once it is written."""
    sent = candidates.sparkSession.sparkContext.broadcast((*block, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        search, place = Search(*sent.value), 0
        for batch in batches:
            vectors = integers(batch.column(2), SCALE)
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for a in range(0, len(ids), BATCH):
                b = min(a + BATCH, len(ids))
                search.look(ids[a:b], labels[a:b], vectors[a:b], place)
                place += b - a
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in search.found()], names=["_a", "anchor_id", "score", "_id"])

    out = scratch.written(candidates.mapInArrow(run, "_a long, anchor_id long, score long, _id long"), name)
    sent.destroy()
    return out


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _one_block(candidates: DataFrame, block: tuple, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of one block of anchors, and the scratch tables that they are read from."""
    first = _found(candidates, block, scratch, "positives")
    positives = scratch.written(_ranked(first, ["_a"], POSITIVES).select("_a", F.col("rank").alias("_p"), F.col("_id").alias("positive_id"), F.col("score").alias("positive_score")), "ranked")
    windows = np.full((len(block[0]), POSITIVES), NONE, dtype=np.int64)
    for a, p, score in positives.select("_a", "_p", "positive_score").toArrow().to_pandas().itertuples(index=False):  # five rows an anchor of the block
        windows[a, p - 1] = score
    second = _found(candidates, block, scratch, "negatives", windows)
    inside = (LEAST * F.col("positive_score") <= 100 * F.col("score")) & (F.col("score") <= F.col("positive_score"))
    ranked = _ranked(second.join(positives, "_a").where(inside), ["_a", "_p"], NEGATIVES)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), [first, positives, second]


def mine(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100, swap: int = 7) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, as the module's heading says.

    Anchors are the rows whose id `every` divides; where `swap` divides it the label is (label + 1) % 10. Rows with a null
    id, label or vector or with a null or non-finite component take no part. Equal anchor rows give their results once, and
    rows of an anchor's own id are no positives or negatives of it; other repeated rows are rows of their own, also where
    they share an id. An anchor without other rows of its label, or a positive without rows in its window (as where its
    score is negative), gives no rows; nor does an empty table. Other columns are not read. Two passes over the candidates
    for each block of anchors; between tasks go at most 5, then 25 rows an anchor and task, and tasks are large.
    """
    spark = embeddings.sparkSession
    id_ = F.col(key).cast("long")
    changed = F.when(id_ % swap == 0, (F.col(label).cast("long") + 1) % 10).otherwise(F.col(label).cast("long"))
    rows = with_vectors(embeddings.where(F.col(key).isNotNull() & F.col(label).isNotNull()), key, vector, changed.alias("_label"))
    anchors = rows.where(F.col("_id") % every == 0).dropDuplicates(["_id", "_label", "_v"])
    number = F.sum(F.size("_v"))
    all_numbers = rows.agg(number).first()[0] or 0
    path = new_path(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    with Scratch(spark) as scratch:
        anchors = scratch.written(anchors, "anchors")
        blocks = -(-(anchors.agg(number).first()[0] or 0) // BLOCK_NUMBERS)
        tasks = max(spark.sparkContext.defaultParallelism, all_numbers // TASK_NUMBERS)
        candidates = rows.select("_id", "_label", "_v").coalesce(tasks)
        for n in range(blocks):
            taken = anchors.where(F.pmod(F.xxhash64("_id", "_v"), F.lit(blocks)) == n).select("_id", "_label", "_v").toArrow()
            if not taken.num_rows:
                continue
            ids, labels = (taken.column(i).to_numpy() for i in (0, 1))
            block = ids, labels, integers(taken.column(2).combine_chunks(), SCALE)
            result, used = _one_block(candidates, block, scratch)
            result.write.mode("append").parquet(path)
            scratch.drop(*used)
    return spark.read.schema(schema).parquet(path)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to five negatives for each positive of each anchor; see mine."""
    return mine(table(spark, sf_dir, "embeddings"))


_ORACLE = f"""
WITH kept AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.id AS anchor, r.id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score FROM kept a JOIN kept r ON a.id % 100 = 0 AND a.id <> r.id
), positives AS (
  SELECT anchor, id, score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= {POSITIVES}
)
SELECT p.anchor AS anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same AND {LEAST} * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= {NEGATIVES}
"""

QUERIES: dict[str, Callable] = {"op13_hard_negatives": op13_hard_negatives}
ORACLES: dict[str, str] = {"op13_hard_negatives": _ORACLE}
