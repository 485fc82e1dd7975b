"""Benchmark decontamination: an FM-index for each shard of documents, searched for all windows of the benchmark."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm.fm_index import FmIndex
from veinloom.llm.jaccard_join import beside, identified
from veinloom.llm.quality_classifier import in_chunks
from veinloom.llm.storage import table, written
from veinloom.llm.worker_cache import forget

WINDOW = 10
#: Characters of a shard; a longer text is a shard by itself.
SHARD_CHARS = 3_000_000
#: Characters of the benchmark that are broadcast at once; a larger benchmark is searched for in blocks of that size.
BLOCK_CHARS = 32_000_000
_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class Phrases:
    """The windows of a block of benchmark items, over a vocabulary of that block."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1)) if ids else ():
                owned = owners[tuple(ids[i : i + window])]
                if item is not None:
                    owned.add(item)
        self.owners = list(owners.values())
        self.lengths = np.array([len(p) for p in owners], dtype=np.int64)
        self.patterns = np.zeros((len(owners), window), dtype=np.int64)
        for row, p in enumerate(owners):
            self.patterns[row, : len(p)] = p

    def find(self, docs: list[list[bytes]]) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """For each document the merged runs of words inside occurrences, and the items that occur."""
        runs: list[list[tuple[int, int]]] = [[] for _ in docs]
        items: list[set[str]] = [set() for _ in docs]
        get, zero = self.vocabulary.get, 0
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        text = np.zeros(int(starts[-1]), dtype=np.int64)
        for d, s in zip(docs, starts):
            text[s : s + len(d)] = [get(w, zero) for w in d]
        # A word that no item has is in no window: runs of such words shrink to one 0, and places map back.
        keep = np.ones(len(text), dtype=bool)
        keep[1:] = (text[1:] != 0) | (text[:-1] != 0)
        place = np.flatnonzero(keep)
        index = FmIndex(np.append(text[place], 0), len(self.vocabulary))
        low, high = index.search(self.patterns, self.lengths)
        found = np.flatnonzero(high > low)
        counts = (high - low)[found]
        if not len(found):
            return runs, items
        which = np.repeat(found, counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[found], counts)
        at = place[index.locate(rows)]
        doc = np.searchsorted(starts, at, side="right") - 1
        begin = at - starts[doc]
        end = begin + self.lengths[which]
        order = np.lexsort((begin, doc))
        for d, a, b in zip(doc[order].tolist(), begin[order].tolist(), end[order].tolist()):
            if runs[d] and a <= runs[d][-1][1]:
                runs[d][-1] = (runs[d][-1][0], max(b, runs[d][-1][1]))
            else:
                runs[d].append((a, b))
        for pair in np.unique(doc * len(self.owners) + which).tolist():
            items[pair // len(self.owners)] |= self.owners[pair % len(self.owners)]
        return runs, items


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> Iterator[Phrases]:
    """The benchmark in blocks, each of a size that can be broadcast, one after the other. Texts without words are left
    out; an item without an id hits like any other, but is not listed."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t")).where("t is not null")
    chars = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    n = max(1, -(-chars // block_chars))
    numbered = rows.withColumn("_b", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
    for b in range(n):
        yield Phrases([(r["i"], r["t"]) for r in numbered.where(F.col("_b") == b).collect()], window)


def _block_hits(rows: DataFrame, phrases: Phrases) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for ids, hashes, texts in shards(batches):
            docs = [words_of(x) for x in texts]
            runs, items = shared.value.find(docs)
            yield pa.RecordBatch.from_arrays(
                [ids, hashes, pa.array([len(d) for d in docs], pa.int64()), pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], _RUNS), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=["doc_id", "h", "n_words", "runs", "items"],
            )

    return rows.mapInArrow(run, f"{_HIT}, items array<string>")


_HIT = "doc_id long, h long, n_words long, runs array<struct<start: long, end: long>>"


def find_hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, h (a hash of the text), n_words, runs (of word numbers, end exclusive) and the occurring items of every row.

    Null and empty texts have no words. Repeated rows are searched each; other columns are not read. An empty benchmark
    hits nothing, an empty table gives no rows. Map-only, unless the benchmark is larger than a block: then one block after
    the other is broadcast and searched for, and what each hits is written and merged by text.
    """
    rows, first, later = identified(documents), None, []
    for phrases in phrase_blocks(benchmark, window, block_chars):
        found = _block_hits(rows, phrases)
        if first is None:
            first = found
            continue
        if not later:
            first = written(first, "hits")
        later.append(written(found.where(F.size("runs") > 0).dropDuplicates(["doc_id", "h"]), "hits"))
    if not later:
        return first
    every = reduce(DataFrame.unionByName, later).groupBy("doc_id", "h").agg(F.flatten(F.collect_list("runs")).alias("more"), F.flatten(F.collect_list("items")).alias("others"))
    every = every.withColumnsRenamed({"doc_id": "_d", "h": "_h"})
    joined = first.join(every, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("h").eqNullSafe(F.col("_h")), "left")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            runs = [merged(sorted((x["start"], x["end"]) for x in [*a, *(b or ())])) for a, b in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], _RUNS), batch.column(4)], names=["doc_id", "h", "n_words", "runs", "items"])

    items = F.array_sort(F.array_union("items", F.coalesce("others", F.array().cast("array<string>"))))
    return joined.select("doc_id", "h", "n_words", "runs", items.alias("items"), "more").mapInArrow(merge, f"{_HIT}, items array<string>")


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array, list]]:
    """Runs of rows of about SHARD_CHARS characters, over the borders of batches."""
    ids, hashes, texts, size = [], [], [], 0
    for batch in batches:
        column = batch.column(2).to_pylist()
        for a, b in in_chunks(column, SHARD_CHARS // 2):
            ids.append(batch.column(0).slice(a, b - a))
            hashes.append(batch.column(1).slice(a, b - a))
            texts.extend(column[a:b])
            size += sum(len(x or "") for x in column[a:b])
            if size >= SHARD_CHARS // 2:
                yield pa.concat_arrays(ids), pa.concat_arrays(hashes), texts
                ids, hashes, texts, size = [], [], [], 0
    if texts:
        yield pa.concat_arrays(ids), pa.concat_arrays(hashes), texts


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in runs:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without_runs(text: str, runs: list[tuple[int, int]]) -> str:
    """The text without the characters from the first to the last word of each run."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for a, b in runs:
        out.append(text[at : spans[a][0]])
        at = spans[b - 1][1]
    return "".join(out) + text[at:]


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All rows and columns; hit runs of words are cut out of `text`, other texts stay as they are (n_chars is not changed).
    Map-only, unless the benchmark is larger than a block; then the texts are joined with what was found in them."""
    at, last = documents.columns.index("text"), len(documents.columns)
    blocks = phrase_blocks(benchmark, window, block_chars)
    first = next(blocks)
    if next(blocks, None) is None:
        shared = documents.sparkSession.sparkContext.broadcast(first)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            for batch in batches:
                texts = batch.column(at).to_pylist()
                for a, b in in_chunks(texts, SHARD_CHARS):
                    runs, _ = shared.value.find([words_of(x) for x in texts[a:b]])
                    yield with_text(batch.slice(a, b - a), at, [without_runs(x, r) if r else x for x, r in zip(texts[a:b], runs)])

        return documents.mapInArrow(cut, documents.schema)

    hits = find_hits(documents, benchmark, window, block_chars).where(F.size("runs") > 0).dropDuplicates(["doc_id", "h"])
    joined = beside(documents, hits, "runs")

    def cut_found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = zip(batch.column(at).to_pylist(), batch.column(last).to_pylist())
            yield with_text(batch.select(range(last)), at, [without_runs(x, [(r["start"], r["end"]) for r in runs]) if runs else x for x, runs in found])

    return joined.mapInArrow(cut_found, documents.schema)


def with_text(batch: pa.RecordBatch, at: int, texts: list[str | None]) -> pa.RecordBatch:
    """The batch with other texts in column `at`."""
    columns = batch.columns
    columns[at] = pa.array(texts, columns[at].type)
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents: its words, how many are hit, and the items that occur; see find_hits."""
    hits = find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["end"] - r["start"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"))


#: All windows of all documents joined with those of the benchmark.
_ORACLE = """
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS MATERIALIZED (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
q AS MATERIALIZED (SELECT DISTINCT item, least(10, len(ws)) AS k, array_to_string(ws[i:i + 9], ' ') AS g FROM (SELECT item, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM b WHERE len(ws) > 0)),
v AS MATERIALIZED (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM q) WHERE len(ws) >= k)),
h AS MATERIALIZED (SELECT doc_id, i, v.k, item FROM v JOIN q ON q.g = v.g AND q.k = v.k),
c AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

QUERIES: dict[str, Callable] = {"op4_decontamination": op4_decontamination}
ORACLES: dict[str, str] = {"op4_decontamination": _ORACLE}
