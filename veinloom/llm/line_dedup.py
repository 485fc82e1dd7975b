"""Fuzzy line deduplication: MinHash over character shingles, banding, exact verification, union-find over all lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm.components import connected_components
from veinloom.llm.jaccard_join import beside, BLOCK_CHARS, cluster_links, identified, MAX_NODES_KNOWN, mix, tree_links
from veinloom.llm.quality_classifier import in_chunks
from veinloom.llm.storage import Scratch, table, written
from veinloom.llm.worker_cache import forget

CHARS = 5
PERCENT = 80
#: At the threshold 1 - (1 - 0.8 ** 6) ** 21 = 0.998 of the pairs share a band. Five rows (16 bands for the same recall) need
#: fewer keys, but unrelated lines then meet so often that buckets grow with the square of the input: 1,255,909 rows in
#: buckets at 0.51 GB, with six rows 716,683.
BANDS, ROWS = 21, 6
BLOCK = 2048
#: Characters whose shingles are hashed together; keys that a task packs together; keys of a slot, on average.
RUN_CHARS, PACKED, SLOT_KEYS = 1 << 16, 1 << 22, 1 << 20
_P, _P32 = np.uint64(0x100000001B3), np.uint32(0x9E3779B1)
_A = (mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_A64, _B64 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def normal(line: str) -> str:
    """Lower case, white space squeezed; lines that are equal then are one."""
    # Of white space only the blank is printable, so most lines have nothing to squeeze.
    if line.isprintable() and "  " not in line and line[:1] != " " and line[-1:] != " ":
        return line.lower()
    return " ".join(line.lower().split())


def _windows(lines: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lines' characters, which of them begin n characters of one line, and where each line's begin among these. A
    shorter line, which may not be empty, is filled up."""
    codes = np.frombuffer("".join(x if len(x) >= n else x.ljust(n, "\x00") for x in lines).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sizes = np.array([max(n, len(x)) for x in lines], dtype=np.int64)
    ends = np.cumsum(sizes)
    inside = np.ones(len(codes), dtype=bool)
    for k in range(1, n):
        inside[ends - k] = False
    counts = sizes - n + 1
    return codes, inside[: len(codes) - n + 1], np.cumsum(counts) - counts


def shingle_hashes(lines: list[str], n: int = CHARS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lines' n-character shingles, not yet distinct, and where each line's begin. A shorter line, which
    may not be empty, is one shingle."""
    codes, inside, starts = _windows(lines, n)
    codes = codes.astype(np.uint64)
    with np.errstate(over="ignore"):
        h = codes[: len(inside)].copy()
        for k in range(1, n):
            h *= _P
            h += codes[k : len(inside) + k]
        h = mix(h * np.uint64(0x9E3779B97F4A7C15))
    return h[inside], starts


def odd_hashes(lines: list[str], n: int = CHARS) -> tuple[np.ndarray, np.ndarray]:
    """The same with 32 bits, of a hash that takes 32 bits at a time; odd, as zero would be the least under any factor."""
    codes, inside, starts = _windows(lines, n)
    with np.errstate(over="ignore"):
        h = codes[: len(inside)].copy()
        for k in range(1, n):
            h *= _P32
            h += codes[k : len(inside) + k]
        h ^= h >> np.uint32(16)
        h *= np.uint32(0x7FEB352D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x846CA68B)
        h ^= h >> np.uint32(16)
    return h[inside] | np.uint32(1), starts


def runs(lines: list[str], chars: int = RUN_CHARS) -> Iterator[list[str]]:
    """The lines in runs of about so many characters, whose hashes stay in the processor's cache."""
    begin, size = 0, 0
    for i, line in enumerate(lines):
        size += len(line)
        if size >= chars:
            yield lines[begin : i + 1]
            begin, size = i + 1, 0
    if begin < len(lines):
        yield lines[begin:]


def band_keys(lines: list[str]) -> np.ndarray:
    """BANDS keys of each line, from the minima of its hashes times odd factors."""
    least, at = np.empty((BANDS * ROWS, len(lines)), dtype=np.uint32), 0
    with np.errstate(over="ignore"):
        for run in runs(lines):
            x, starts = odd_hashes(run)
            buffer = np.empty_like(x)
            for k in range(BANDS * ROWS):
                np.multiply(x, _A[k], out=buffer)
                np.minimum.reduceat(buffer, starts, out=least[k, at : at + len(run)])
            at += len(run)
        keys = np.zeros((len(lines), BANDS), dtype=np.uint64)
        for band in range(BANDS):
            x = np.full(len(lines), band + 1, dtype=np.uint64)
            for r in range(ROWS):
                x = mix(x * _P + least[band * ROWS + r].astype(np.uint64))
            keys[:, band] = x
    return keys.view(np.int64)


class CharShingles:
    """Makes the sets of character shingles of lines, as sorted arrays."""

    #: Buckets of up to so many lines are compared without a tree.
    plain = 64

    def maker(self) -> Callable[[list], list[np.ndarray]]:
        def sets_of(lines: list[str]) -> list[np.ndarray]:
            out = []
            for run in runs(lines):
                h, starts = shingle_hashes(run)
                for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(h)]):
                    s = np.sort(h[a:b])
                    new = s[1:] != s[:-1]
                    out.append(s if new.all() else np.concatenate([s[:1], s[1:][new]]))
            return out

        return sets_of


def hashes(line: str) -> tuple[int, int]:
    """Node and check of a normal line: 128 bits of a hash."""
    h = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)


def line_rows(documents: DataFrame) -> DataFrame:
    """doc_id, h (a hash of the text), idx, node and check of every line that is not blank; at a text's first one, how many
    it has; once for each node in a task, its band keys, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        seen: set[int] = set()
        for batch in batches:
            ids, texts_h, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a, b in in_chunks(texts, 1_000_000):
                doc, text_h, idx, node, check, counts, new, new_at = [], [], [], [], [], [], [], []
                for d, th, x in zip(ids[a:b], texts_h[a:b], texts[a:b]):
                    begin = len(node)
                    for i, line in enumerate((x or "").split("\n")):
                        line = normal(line)
                        if line:
                            h, c = hashes(line)
                            if h not in seen:
                                seen.add(h)
                                new.append(line)
                                new_at.append(len(node))
                            doc.append(d), text_h.append(th), idx.append(i), node.append(h), check.append(c)
                    if n := len(node) - begin:
                        counts += [n, *[None] * (n - 1)]
                if len(seen) > MAX_NODES_KNOWN:
                    seen.clear()
                if not node:
                    continue
                lists: list[bytes | None] = [None] * len(node)
                for i, k in zip(new_at, band_keys(new)):
                    lists[i] = k.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(text_h, pa.int64()), pa.array(idx, pa.int32()), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(counts, pa.int32()), pa.array(lists, pa.binary())], names=["doc_id", "h", "idx", "node", "check", "lines", "keys"])

    return identified(documents).where("doc_id is not null").mapInArrow(run, "doc_id long, h long, idx int, node long, check long, lines int, keys binary")


def chosen_lines(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """node and text of chosen lines (doc_id, h, idx, node): one join on documents, and only chosen lines go further. What
    a repeated row gives again is mostly left out, as equal rows follow one another."""
    wanted = chosen.groupBy("doc_id", "h").agg(F.collect_list(F.struct("idx", "node")).alias("wanted"))  # bounded by a text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        last = None
        for batch in batches:
            nodes, out = [], []
            for *place, text, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                if place == last:
                    continue
                last = place
                lines = (text or "").split("\n")
                for w in wanted:
                    if w["idx"] < len(lines) and (line := normal(lines[w["idx"]])):
                        nodes.append(w["node"])
                        out.append(line)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(out, pa.string())], names=["node", "text"])

    return identified(documents).join(wanted, ["doc_id", "h"]).select("doc_id", "h", "text", "wanted").mapInArrow(run, "node long, text string")


def packets(rows: DataFrame, slots: int) -> DataFrame:
    """slot, and packed keys and nodes, of rows (node, keys): a key's slot is its place in the range of all keys. One row for
    each slot and PACKED keys of a task."""

    def packed(keys: list[bytes], nodes: list[int]) -> pa.RecordBatch:
        key = np.frombuffer(b"".join(keys), dtype="<u8")
        node = np.repeat(np.array(nodes, dtype="<i8"), BANDS)
        slot = (((key >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)).astype(np.uint16 if slots < 1 << 16 else np.uint32)
        order = np.argsort(slot, kind="stable")
        key, node = key[order], node[order]
        used, begin = np.unique(slot[order], return_index=True)
        ends = np.append(begin[1:], len(key))
        columns = [pa.array([x[a:b].tobytes() for a, b in zip(begin, ends)], pa.binary()) for x in (key, node)]
        return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *columns], names=["slot", "keys", "nodes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        keys, nodes = [], []
        for batch in batches:
            keys += batch.column(1).to_pylist()
            nodes += batch.column(0).to_pylist()
            if len(keys) * BANDS >= PACKED:
                yield packed(keys, nodes)
                keys, nodes = [], []
        if keys:
            yield packed(keys, nodes)

    return rows.where("keys is not null").select("node", "keys").mapInArrow(run, "slot int, keys binary, nodes binary")


class SlotPairs:
    """The distinct (key, node) pairs of a slot. Pairs of a key that very many nodes have are given out early, so what is
    held stays near `most` however large one bucket is."""

    def __init__(self, most: int):
        self.most, self.size = most, 0
        self.keys: list[np.ndarray] = []
        self.nodes: list[np.ndarray] = []
        self.hot = np.zeros(0, dtype=np.uint64)

    def add(self, key: np.ndarray, node: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """Takes pairs; what it returns are rows of hot keys."""
        out = []
        if len(self.hot):
            is_hot = np.isin(key, self.hot)
            out.append(self._hot_rows(key[is_hot], node[is_hot]))
            key, node = key[~is_hot], node[~is_hot]
        self.keys.append(key), self.nodes.append(node)
        self.size += len(key)
        if self.size > 2 * self.most:
            key, node = self._distinct(np.concatenate(self.keys), np.concatenate(self.nodes))
            of, at, n = np.unique(key, return_inverse=True, return_counts=True)
            many = n > max(1, self.most // 64)
            self.hot = np.concatenate([self.hot, of[many]])
            is_hot = many[at]
            out.append(self._hot_rows(key[is_hot], node[is_hot]))
            self.keys, self.nodes = [key[~is_hot]], [node[~is_hot]]
            self.size = len(self.keys[0])
            self.most = max(self.most, self.size)
        return out

    @staticmethod
    def _distinct(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        return key[new], node[new]

    @staticmethod
    def _hot_rows(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
        return key, node, key, ~key, key.view(np.int64)

    def rest(self) -> tuple[np.ndarray, ...]:
        """key, node, two hashes of the key's nodes and the least of these, of the keys that several nodes have."""
        if not self.keys:
            return (np.zeros(0, dtype=np.uint64),) * 5
        key, node = np.concatenate(self.keys), np.concatenate(self.nodes)
        order = np.argsort(key)
        key = key[order]
        same = np.zeros(len(key) + 1, dtype=bool)
        same[1:-1] = key[1:] == key[:-1]
        again = same[:-1] | same[1:]  # only what has an equal key is looked at further
        key, node = self._distinct(key[again], node[order[again]])
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
        n = np.diff(np.append(first, len(key)))
        sums = []
        for salt in (_A64, _B64):
            with np.errstate(over="ignore"):
                x = np.add.reduceat(mix(node.view(np.uint64) * salt + salt), first) if len(first) else np.zeros(0, dtype=np.uint64)
            sums.append(np.repeat(x, n))
        least = np.repeat(np.minimum.reduceat(node, first), n) if len(first) else node
        several = np.repeat(n > 1, n)
        return tuple(x[several] for x in (key, node, *sums, least))


def shared_keys(rows: DataFrame, n_rows: int, scratch: Scratch, slot_keys: int = SLOT_KEYS) -> DataFrame:
    """key and node of all nodes that share a key with another; x and y, two hashes of the key's nodes; label, the least of
    these (of a key of very many nodes, x, y and label are its own). rows: node, keys; n_rows: how many these are at most,
    which says in how many slots the keys are sorted."""
    slots = max(1, -(-n_rows * BANDS // slot_keys))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()

        def out(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in columns], names=["key", "node", "x", "y", "label"])

        slot, pairs = None, SlotPairs(4 * slot_keys)
        for batch in batches:
            for s, key, node in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if s != slot:
                    yield out(pairs.rest())
                    slot, pairs = s, SlotPairs(4 * slot_keys)
                for rows_ in pairs.add(np.frombuffer(key.as_buffer(), dtype="<u8"), np.frombuffer(node.as_buffer(), dtype="<i8")):
                    yield out(rows_)
        yield out(pairs.rest())

    dealt = packets(rows, slots).repartition(slots, "slot").sortWithinPartitions("slot")
    return scratch.written(dealt.mapInArrow(run, "key long, node long, x long, y long, label long"), "several")


def different(several: DataFrame) -> DataFrame:
    """node and root (a key) of buckets; of keys with the same nodes only one is kept."""
    kept = several.groupBy("x", "y").agg(F.min("key").alias("key")).select("key")
    return several.join(kept, "key").select("node", F.col("key").alias("root")).distinct()


def buckets(rows: DataFrame, n_rows: int, scratch: Scratch, slot_keys: int = SLOT_KEYS) -> DataFrame:
    """node and root (a key) of all nodes that share a key with another; of keys with the same nodes only one is kept."""
    return different(shared_keys(rows, n_rows, scratch, slot_keys))


def links_within(sets: list[np.ndarray], buckets_: list[list[int]], percent: int, plain: int = CharShingles.plain) -> list[int]:
    """For each set the first of those that it is linked with, when all pairs in a bucket (numbers of sets) are compared
    that are not yet linked through others. No pair is compared twice."""
    root, apart = list(range(len(sets))), set()

    def join(i: int, j: int) -> None:
        old, new = max(root[i], root[j]), min(root[i], root[j])
        root[:] = [new if r == old else r for r in root]

    for bucket in sorted(buckets_, key=len, reverse=True):
        if len({root[i] for i in bucket}) < 2:
            continue
        if len(bucket) > plain:
            for i, j in tree_links([sets[i] for i in bucket], np.array([root[i] for i in bucket]), percent):
                join(bucket[i], bucket[j])
            continue
        for at, q in enumerate(bucket):
            n = len(sets[q])
            for x in bucket[:at]:
                if root[x] == root[q] or (x, q) in apart:
                    continue
                m = len(sets[x])
                if 100 * min(m, n) >= percent * max(m, n):
                    c = np.concatenate((sets[q], sets[x]))
                    c.sort()
                    both = np.count_nonzero(c[1:] == c[:-1])
                    if 100 * both >= percent * (n + m - both):
                        join(x, q)
                        continue
                apart.add((x, q))
    return root


def bucket_links(members: DataFrame, several: DataFrame, percent: int, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join what the threshold joins in any bucket. members: label, node, text and chars of the lines in
    buckets with that label, several: see shared_keys.

    Buckets of one label are compared together, as those of a group of alike lines mostly have its least lines in common:
    each line is sent and cut into shingles once a label. A label of more lines than a block is left to cluster_links,
    bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        sets_of = CharShingles().maker()

        def with_sets() -> Iterator[tuple[list, ...]]:
            for batch in batches:
                label, node, x, texts = (c.to_pylist() for c in batch.columns)
                sets = iter(sets_of([t for t in texts if t is not None]))
                yield label, node, x, [None if t is None else next(sets) for t in texts]

        a, b = [], []
        for _, of_label in groupby(chain.from_iterable(zip(*columns) for columns in with_sets()), key=lambda r: r[0]):
            rows = list(of_label)
            sets = {r[1]: r[3] for r in sorted((r for r in rows if r[3] is not None), key=lambda r: r[1])}
            at, of = {n: i for i, n in enumerate(sets)}, {}
            for _, n, x, s in rows:
                if s is None and n in at:
                    of.setdefault(x, set()).add(at[n])
            nodes = list(sets)
            for i, r in enumerate(links_within(list(sets.values()), [sorted(v) for v in of.values()], percent)):
                if i != r:
                    a.append(nodes[i]), b.append(nodes[r])
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    large = scratch.written(sizes.where((F.col("n") > block) | (F.col("chars") > BLOCK_CHARS)).select("label"), "large")
    some = large.limit(1).count() > 0
    theirs = lambda d, how: d.join(large, "label", how) if some else d
    texts = theirs(members, "left_anti").select("label", "node", F.lit(None).cast("long").alias("x"), "text")
    places = theirs(several, "left_anti").select("label", "node", "x", F.lit(None).cast("string").alias("text"))
    links = scratch.written(texts.unionByName(places).repartition("label").sortWithinPartitions("label").mapInArrow(run, "a long, b long"), "links")
    if some:
        known = members.join(large, "label", "left_semi").select("node", "text").dropDuplicates(["node"])
        in_large = scratch.written(different(several.join(large, "label", "left_semi")).join(known, "node"), "members")
        links = links.unionByName(cluster_links(in_large, CharShingles(), percent, scratch, block))
    return links


def removed_lines(documents: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, h (a hash of the text), n_lines (that are not blank) and removed (sorted numbers of lines, from 0) of every
    text with such lines that has an id.

    Of each component of lines, that of the least (doc_id, h, number) stays; equal rows (same id and text) count as one,
    rows of one id with different texts each for themselves. Blank lines are never removed. Rows without an id are left
    alone. Null and empty texts have no lines. Every pair of lines that shares a band is verified, unless both are linked
    already through others. Lines count as equal by 128 bits.
    """
    with Scratch(documents.sparkSession) as scratch:
        keys = scratch.written(line_rows(documents), "keys")
        rows = scratch.written(keys.drop("keys"), "rows")
        several = shared_keys(keys, rows.count(), scratch)
        in_buckets = scratch.written(several.select("label", "node").distinct(), "buckets")
        scratch.drop(keys, collect=True)
        place = F.struct("doc_id", "h", "idx")
        # Equal lines, by all 128 bits: how many and which is first.
        equal = scratch.written(rows.groupBy("node", "check").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("n")), "equal")
        stands = equal.join(in_buckets.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min(F.struct("at", "check")).alias("s"))
        chosen = scratch.written(stands.select("s.at.*", "node", "s.check"), "chosen")
        members = scratch.written(chosen_lines(documents, chosen).join(in_buckets, "node").select("label", "node", "text", F.length("text").alias("chars")), "members")
        scratch.drop(in_buckets, collect=True)
        parts = connected_components(bucket_links(members, several, percent, scratch, block), scratch)
        # A line with a linked node's first 64 bits, but not its others, is not that line.
        parts = parts.join(chosen.select("node", "check"), "node").select("node", "check", "root")
        parts = scratch.written(parts, "parts")
        # Groups of more than one line, equal or linked; only their lines matter further.
        linked_ = scratch.written(equal.join(parts, ["node", "check"]), "linked")
        first = scratch.written(linked_.groupBy("root").agg(F.min("at").alias("first")), "first")
        alone = equal.where("n > 1").join(parts, ["node", "check"], "left_anti")
        groups = linked_.join(first, "root").select("node", "check", "first").unionByName(alone.select("node", "check", F.col("at").alias("first")))
        # Written, so that the join with rows is one of two plain shuffles, of which Spark splits the hot side.
        groups = scratch.written(groups, "groups")
        gone = rows.join(groups, ["node", "check"]).where(F.col("first") != place).groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("idx")).alias("removed"))
        counted = rows.where("lines is not null").groupBy("doc_id", "h").agg(F.max("lines").cast("long").alias("n_lines"))
        none = F.array().cast("array<int>")
        return written(counted.join(gone, ["doc_id", "h"], "left").select("doc_id", "h", "n_lines", F.coalesce("removed", none).alias("removed")), "removed")


def dedup_lines(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All rows and columns of documents, `text` without the removed lines; a text that loses all lines becomes empty."""
    joined = beside(documents, removed_lines(documents, percent).where(F.size("removed") > 0), "removed")
    at, last = documents.columns.index("text"), len(documents.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [x if x is None or r is None else "\n".join(line for i, line in enumerate(x.split("\n")) if i not in set_) for x, r, set_ in ((x, r, set(r or ())) for x, r in zip(texts, batch.column(last).to_pylist()))]
            columns = [batch.column(i) for i in range(last)]
            columns[at] = pa.array(new, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:last])

    return joined.mapInArrow(run, documents.schema)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents: its lines, how many go and which. Rows without an id have none counted; see
    removed_lines for ties, repeated rows and empty texts."""
    documents = table(spark, sf_dir, "documents")
    every = identified(documents).select("doc_id", "h").join(removed_lines(documents), ["doc_id", "h"], "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return every.select("doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.size(removed).cast("long").alias("n_removed"), F.array_join(removed.cast("array<string>"), ",").alias("removed"))


QUERIES: dict[str, Callable] = {"op2_line_dedup": op2_line_dedup}
ORACLES: dict[str, str] = {}
