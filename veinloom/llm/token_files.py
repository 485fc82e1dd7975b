"""Token ids in ORC files: written in order of doc_id, with row indexes and Bloom filters, read back by stripe."""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veinloom.llm.bpe import _BYTES, vocabulary
from veinloom.llm.quality_classifier import in_chunks
from veinloom.llm.storage import new_path, table
from veinloom.llm.worker_cache import forget, kept

END_ID = 2
#: Files of a group whose sizes are summed together; one task sees the groups' sums, a thousandth of the number of files.
GROUP = 1_000
#: The manifest is broadcast up to so many files (24 MB), and joined beyond.
MAX_FILES = 1_000_000
#: Words that a worker remembers; the store is emptied when it is full, so memory is bounded.
MAX_WORDS = 1_000_000
#: Characters that are encoded together; each different piece in them is looked up once.
BATCH_CHARS = 3_000_000
#: Signs that form one pre-token when they stand together; no quotation mark, which may begin a contraction, and no "<",
#: which may begin a special token.
_SIGNS = ".,;:!?*$%&#|-"
SCHEMA = "doc_id long, shard int, local_start long, n_tokens long, ids array<int>"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(16 << 20),
}


#: Packers of short lists of ids.
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(17)]
#: A line end without white space beside it is a token of its own; two white characters together need the longer way.
_GAP = re.compile(r"\s\s")


class PieceEncoder:
    """The library's encoding, asked for once for each different word.

    A byte-level pre-tokeniser takes a blank together with what follows it and lets no other token hold one, so a text
    can be cut before each blank, except inside a run of white space that goes on behind the blank. Arrow finds the different pieces of many
    texts at once, and their ids are put together as arrays.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.words: dict[str, bytes] = {}
        spec = json.loads(self.library.to_str())
        pre = spec["pre_tokenizer"] or {}
        #: Whether words can be cut off and given to the library's model directly.
        self.plain = not spec["normalizer"] and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]

    def of_word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) > MAX_WORDS:
                self.words.clear()
            letters = word.replace(" ", "\u0120") if word.isascii() else word.encode("utf-8").decode("latin-1").translate(_BYTES)
            tokens = self.library.model.tokenize(letters)
            if len(tokens) == 1:
                ids = _PACKED[1](tokens[0].id)
            else:
                ids = [t.id for t in tokens]
                ids = _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else struct.pack(f"<{len(ids)}I", *ids)
            self.words[word] = ids
        return ids

    @staticmethod
    def cut(text: str) -> list[str]:
        parts = text.split(" ")
        out = [parts[0]] + [" " + p for p in parts[1:]]
        if "  " in text or any(len(p) > 1 and p[1].isspace() for p in out[1:]):
            joined = [out[0]]
            for p in out[1:]:
                if joined[-1][-1:].isspace() and (len(p) == 1 or p[1].isspace()):
                    joined[-1] += p
                else:
                    joined.append(p)
            out = joined
        return out

    def of_piece(self, piece: str) -> bytes:
        # A blank (or none) with letters of a Latin alphabet, and the signs after them, are two pre-tokens, of which the
        # second may be empty.
        if self.plain:
            word = piece.rstrip(_SIGNS)
            if word[word[:1] == " " :].isalpha() and (word.isascii() or max(word) < "\u0180"):
                return self.of_word(word) if len(word) == len(piece) else self.of_word(word) + self.of_word(piece[len(word) :])
        ids = self.words.get(piece)
        if ids is None:
            if len(self.words) > MAX_WORDS:
                self.words.clear()
            self.words[piece] = ids = np.array(self.library.encode(piece, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return ids

    def encode_simple(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts without two white characters together, one text after the other, and where each text's end.
        There a piece begins at each blank, and a line end is a piece of its own."""
        data = [x.encode("utf-8", "surrogatepass") for x in texts]
        blob = b"".join(data)
        ends = np.cumsum([len(x) for x in data])
        chars = np.frombuffer(blob, dtype=np.uint8)
        line_end = chars == 10
        cut = (chars == 32) | line_end
        cut[1:] |= line_end[:-1]
        cut[np.append(0, ends[:-1])] = True
        begin = np.flatnonzero(cut)
        offsets = np.append(begin, len(blob)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(blob)]).dictionary_encode()
        ids = list(map(self.of_piece, pieces.dictionary.to_numpy(zero_copy_only=False).tolist()))
        # A batch of texts is far from 2^31 ids, or none of them could be an array of ids.
        sizes = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) // 4
        known, at = np.frombuffer(b"".join(ids), dtype="<u4"), np.cumsum(sizes, dtype=np.int32) - sizes
        which = pieces.indices.to_numpy()
        n = sizes[which]
        until = np.cumsum(n, dtype=np.int32)
        place = np.repeat(at[which] - (until - n), n)
        place += np.arange(until[-1], dtype=np.int32)
        out = known[place]
        return out, until[np.searchsorted(begin, ends) - 1]

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; null is empty."""
        out = [b""] * len(texts)
        simple = []
        for i, x in enumerate(texts):
            if x and _GAP.search(x):
                out[i] = b"".join(map(self.of_piece, self.cut(x)))
            elif x:
                simple.append(i)
        if simple:
            ids, ends = self.encode_simple([texts[i] for i in simple])
            raw, begin = ids.tobytes(), 0
            for i, end in zip(simple, (ends.astype(np.int64) * 4).tolist()):
                out[i], begin = raw[begin:end], end
        return out


def write_tokens(documents: DataFrame, vocab_path: str, path: str, end_id: int = END_ID) -> None:
    """Writes ORC files under path: one row a document, in ascending order of doc_id over the files and within them.

    Null and empty texts hold the end id only. Rows of equal doc_id are all written, ordered by a hash of the text; null
    ids come first. Other columns are not read. An empty table gives a file or folder without rows. One shuffle by range,
    of the texts; salted by the hash, so a third of all rows under one id still spreads.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    jdocs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("_h"))
    ordered = jdocs.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("pieces", vocab_path), lambda: PieceEncoder(vocab_path))
        shard, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in in_chunks(texts, BATCH_CHARS):
                raw = [x + end for x in encoder.encode_batch(texts[a:b])]
                sizes = np.array([len(x) // 4 for x in raw], dtype=np.int64)
                offsets = np.zeros(len(raw) + 1, dtype=np.int32)
                np.cumsum(sizes, out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(raw), dtype="<u4").astype(np.int32)))
                starts = at + offsets[:-1].astype(np.int64)
                at += int(sizes.sum())
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), pa.array(np.full(len(raw), shard, dtype=np.int32)), pa.array(starts), pa.array(sizes), ids], names=["doc_id", "shard", "local_start", "n_tokens", "ids"])

    ordered.mapInArrow(run, SCHEMA).write.options(**ORC_OPTIONS).orc(path)
    spark = documents.sparkSession
    spark.read.schema(SCHEMA).orc(path).groupBy("shard").agg(F.sum("n_tokens").alias("n")).coalesce(1).write.parquet(totals_path(path))


def totals_path(path: str) -> str:
    """The manifest of token files: how many ids each has, one row of a few bytes a file."""
    return path.rstrip("/") + "-totals"


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The rows of such files with each document's start among all ids. With doc_ids only these documents are read:
    the filter reaches the files, where stripes and row groups go by their ranges and Bloom filters; where files begin
    comes from the manifest, so that no other column of any file is read."""
    rows = spark.read.schema(SCHEMA).orc(path)
    # A running sum over groups of files, then one over the groups' sums.
    totals = spark.read.schema("shard int, n long").parquet(totals_path(path)).withColumn("_g", F.floor(F.col("shard") / GROUP))
    within = F.coalesce(F.sum("n").over(Window.partitionBy("_g").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = totals.groupBy("_g").agg(F.sum("n").alias("_all"))
    ahead = F.coalesce(F.sum("_all").over(Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = totals.withColumn("_within", within).join(groups.select("_g", ahead.alias("_ahead")), "_g").select("shard", (F.col("_within") + F.col("_ahead")).alias("_before"))
    if totals.count() <= MAX_FILES:
        before = F.broadcast(before)
    chosen = rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))
    return chosen.join(before, "shard").select("doc_id", (F.col("_before") + F.col("local_start")).alias("start"), "ids")


def digests(tokens: DataFrame) -> DataFrame:
    """n_tokens and the CRC-32 of each document's ids, computed from the ids that were read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # a worker that reads has no use for what it remembered when it wrote
        for batch in batches:
            lists = batch.column(2)
            flat = memoryview(lists.flatten().to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(at) // 4), pa.array([zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return tokens.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents, from the files; see write_tokens for nulls, repeated ids and empty texts."""
    path = new_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), path)
    return digests(read_tokens(spark, path))


QUERIES: dict[str, Callable] = {"op6_token_files": op6_token_files}
ORACLES: dict[str, str] = {}
