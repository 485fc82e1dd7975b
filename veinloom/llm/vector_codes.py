"""Compression of vectors to codes: each of four parts becomes the number of its nearest codebook entry.

The nearest entry is found by annular norm pruning. Entries are sorted by norm. By the triangle inequality an entry at a
distance of at most d has a norm within d of the vector's own norm, so two binary searches give the interval of entries that
the best distance so far still allows; that annulus, its ends included, is evaluated exactly, ring after ring outwards,
and shrinks as better entries are found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm.storage import table, written
from veinloom.llm.vectors import integers, products, with_vectors
from veinloom.llm.worker_cache import forget

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries of one ring, and vectors that are looked up together.
RING, BLOCK = 16, 4_096


class Codebook:
    """Entries of one part, sorted by norm; ties of norm by index."""

    def __init__(self, entries: np.ndarray):
        squares = (entries * entries).sum(axis=1)
        self.order = np.lexsort((np.arange(len(entries)), squares))
        self.entries, self.squares = entries[self.order], squares[self.order].astype(np.int64)
        self.norms = np.sqrt(squares[self.order])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each vector; of entries at the same distance the least index."""
        index, best = np.empty(len(vectors), dtype=np.int64), np.empty(len(vectors), dtype=np.int64)
        by_norm = np.argsort((vectors * vectors).sum(axis=1), kind="stable")  # so that a block's annuli lie together
        for at in range(0, len(vectors), BLOCK):
            rows = by_norm[at : at + BLOCK]
            index[rows], best[rows] = self._block(vectors[rows])
        return index, best

    def _block(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        squares = (v * v).sum(axis=1)
        norms, squares = np.sqrt(squares), squares.astype(np.int64)
        # The ring with the entry of the nearest norm comes first; then rings outwards on both sides.
        middle = np.minimum(np.searchsorted(self.norms, norms), len(self.norms) - 1) // RING
        best, index = np.full(len(v), np.iinfo(np.int64).max), np.full(len(v), len(self.order))
        for ring in np.unique(middle):
            self._evaluate(np.flatnonzero(middle == ring), int(ring), v, squares, best, index)
        rings = -(-len(self.order) // RING)
        for step in range(1, rings):
            for side in (-step, step):
                first, last = self._annulus(norms, best)
                ring = middle + side
                open_ = (ring >= first // RING) & (ring <= (last - 1) // RING) & (ring >= 0) & (ring < rings) & (last > first)
                for r in np.unique(ring[open_]):
                    self._evaluate(np.flatnonzero(open_ & (ring == r)), int(r), v, squares, best, index)
            if not ((middle - step > first // RING) | (middle + step < (last - 1) // RING)).any():
                break
        return index, best

    def _annulus(self, norms: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of entries whose norms differ from a vector's by its best distance at most. Roots of integers below
        2**62 are wrong by less than 2**-21; the interval is wider by more than that, so none on its edge is missed."""
        reach = np.sqrt(best.astype(np.float64)) + 1e-5
        return np.searchsorted(self.norms, norms - reach, "left"), np.searchsorted(self.norms, norms + reach, "right")

    def _evaluate(self, rows: np.ndarray, ring: int, v: np.ndarray, squares: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        a, b = ring * RING, min((ring + 1) * RING, len(self.order))
        distance = squares[rows, None] - 2 * products(v[rows], self.entries[a:b]) + self.squares[None, a:b]
        least = distance.min(axis=1)
        at = np.where(distance == least[:, None], self.order[None, a:b], len(self.order)).min(axis=1)
        better = (least < best[rows]) | (least == best[rows]) & (at < index[rows])
        best[rows[better]], index[rows[better]] = least[better], at[better]


def _parts(vectors: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(vectors, PARTS, axis=1)]


def _sums(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round. A task sums what it assigns and gives one row for each entry it used, so what is
    shuffled is bounded by tasks and entries, whatever copies the vectors hold; what comes to the driver by entries."""
    width = books[0].shape[1]
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        ready = [Codebook(b) for b in books]
        sums, counts = [np.zeros(b.shape, dtype=np.int64) for b in books], [np.zeros(len(b), dtype=np.int64) for b in books]
        for batch in batches:
            for p, part in enumerate(_parts(integers(batch.column(0), SCALE))):
                index, _ = ready[p].nearest(part)
                np.add.at(sums[p], index, part.astype(np.int64))
                counts[p] += np.bincount(index, minlength=len(counts[p]))
        for p in range(PARTS):
            used = np.flatnonzero(counts[p])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), p, dtype=np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[p][used]), *[pa.array(np.ascontiguousarray(sums[p][used, i])) for i in range(width)]], names=["part", "entry", "n", *names])

    schema = ", ".join(["part int", "entry int", "n long", *[f"{s} long" for s in names]])
    after = [b.copy() for b in books]
    for r in rows.select("_v").mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]).collect():
        after[r["part"]][r["entry"]] = [r[s] // r["n"] for s in names]
    return after


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def learn(rows: DataFrame) -> list[np.ndarray] | None:
    """Codebooks of four parts, from the 256 vectors of the least ids (of equal ids, by their components; ids that are null
    come last), bettered in four rounds over all rows. None where no vector takes part."""
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "_v").limit(ENTRIES).select("_v").collect()
    if not first:
        return None
    start = integers(pa.array([r["_v"] for r in first], pa.list_(pa.float64())), SCALE)
    if not start.shape[1] or start.shape[1] % PARTS:
        raise ValueError(f"vectors of {start.shape[1]} components cannot be cut into {PARTS} equal parts")
    books = _parts(start)
    for _ in range(ROUNDS):
        books = _sums(rows, books)
    return books


def encode(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """_id, _label, code and error of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        ready = [Codebook(b) for b in books]
        for batch in batches:
            found = [ready[p].nearest(part) for p, part in enumerate(_parts(integers(batch.column(2), SCALE)))]
            codes = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            text = codes.tobytes().hex()
            error = np.sum([d for _, d in found], axis=0).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([text[a : a + 2 * PARTS] for a in range(0, len(text), 2 * PARTS)], pa.string()), pa.array(error)], names=["_id", "_label", "code", "error"])

    return rows.select("_id", "_label", "_v").mapInArrow(run, "_id long, _label long, code string, error long")


def compress(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of the rows whose vector takes part.

    Rows with a null vector, or with a null or non-finite component, are left out; a null id or label is kept, null labels
    count as one label; equal rows are rows of their own; an empty table gives no rows. Vectors of different lengths, or of
    a length that four does not divide, raise ValueError. Other columns are not read. Encoded rows, a few bytes each, are
    written to the shared folder, as the labels' sums need all of them; sums meet their rows in a plain join on the label,
    which is broadcast if the sums are few and else split where a label is hot.
    """
    spark = embeddings.sparkSession
    rows = with_vectors(embeddings, key, vector, F.col(label).cast("long").alias("_label"))
    out = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    books = learn(rows)
    if books is None:
        return spark.createDataFrame([], out)
    coded = written(encode(rows, books), "codes")
    sums = coded.groupBy("_label").agg(F.sum("error").alias("label_error")).withColumnRenamed("_label", "_of")
    return coded.join(sums, F.col("_label").eqNullSafe(F.col("_of"))).select(F.col("_id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each vector that takes part; see compress."""
    return compress(table(spark, sf_dir, "embeddings"))


def _oracle() -> str:
    """All rounds written out; entries and vectors are rows of one component each, so distances are plain sums."""
    kept = "SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, embedding AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = [
        f"kept AS MATERIALIZED ({kept})",
        f"cells AS MATERIALIZED (SELECT r, (i - 1) // (len(v) // {PARTS}) AS part, (i - 1) % (len(v) // {PARTS}) AS pos, CAST(floor({SCALE} * CAST(v[i] AS DOUBLE)) AS BIGINT) AS x FROM (SELECT r, v, unnest(range(1, len(v) + 1)) AS i FROM kept))",
        f"book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, pos, x FROM cells WHERE r <= {ENTRIES})",
    ]
    for k in range(ROUNDS + 1):
        apart = f"SELECT c.r, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x)) AS d FROM cells c JOIN book{k} b ON c.part = b.part AND c.pos = b.pos GROUP BY ALL"
        steps.append(f"near{k} AS MATERIALIZED (SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM ({apart}) GROUP BY r, part)")
        if k < ROUNDS:
            mean = "SELECT n.part, n.entry, c.pos, sum(c.x) AS s, count(*) AS n FROM near{0} n JOIN cells c ON n.r = c.r AND n.part = c.part GROUP BY ALL".format(k)
            steps.append(f"book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, CAST(COALESCE((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, b.x) AS BIGINT) AS x FROM book{k} b LEFT JOIN ({mean}) m USING (part, entry, pos))")
    coded = f"coded AS MATERIALIZED (SELECT r, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY r)"
    last = f"SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}"
    return f"WITH {', '.join(steps)}, {coded} SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, ({last}) AS codebooks_sha256 FROM coded c JOIN kept k USING (r)"


QUERIES: dict[str, Callable] = {"op12_vector_codes": op12_vector_codes}
ORACLES: dict[str, str] = {"op12_vector_codes": _oracle()}
