"""Quality rules: counts over a text, and a Viterbi labelling of its lines that decides whether it is kept."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm import line_crf, training
from veinloom.llm.quality_classifier import in_chunks
from veinloom.llm.storage import table
from veinloom.llm.worker_cache import forget

#: A document is kept if at least this share of its characters lies in content lines.
MIN_CONTENT = 0.5
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SYMBOLS = "#*$%&|<>"
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, n_lines long, states string"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, covered = 0, 0  # covered: the end of what is counted so far
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; all 0 for null."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    word_chars = len(text) - sum(text.count(c) for c in " \t\n\r\x0b\x0c")
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    return len(words), word_chars, sum(text.count(c) for c in _SYMBOLS), dup, repeated_words(words)


def judge(documents: DataFrame, model: line_crf.Model, min_content: float = MIN_CONTENT) -> DataFrame:
    """The counts, the line labels (a string of 0 and 1) and the verdict for every row.

    A null or empty text has no words, so it fails the base rules. Lines of white space only are no units of the
    labelling. Repeated rows are judged each; other columns are not read; an empty table gives no rows. Map-only.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in in_chunks(texts):
                part = texts[a:b]
                share, lines, states = line_crf.content_shares(shared.value, [line_crf.split_lines(x) for x in part])
                base = [counts(x) for x in part]
                failed = [n < MIN_WORDS or 100 * rep > MAX_REPEAT_PERCENT * n for n, _, _, _, rep in base]
                kept = [not f and bool(s >= min_content) for f, s in zip(failed, share)]
                columns = [pa.array(list(c), pa.int64()) for c in zip(*base)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), *columns, pa.array(failed, pa.bool_()), pa.array(kept, pa.bool_()), pa.array(share), pa.array(lines), pa.array(["".join(map(str, s)) for s in states], pa.string())],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share", "n_lines", "states"],
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def keep_good(documents: DataFrame, model: line_crf.Model, min_content: float = MIN_CONTENT) -> DataFrame:
    """The rows, with all their columns, of the documents that the rules keep; map-only, one verdict a row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in in_chunks(texts):
                part = texts[a:b]
                share, _, _ = line_crf.content_shares(shared.value, [line_crf.split_lines(x) for x in part])
                keep = []
                for x, s in zip(part, share):
                    n, _, _, _, rep = counts(x)
                    keep.append(n >= MIN_WORDS and 100 * rep <= MAX_REPEAT_PERCENT * n and bool(s >= min_content))
                yield batch.slice(a, b - a).filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents; see judge for nulls, empty texts and repeated rows."""
    documents = table(spark, sf_dir, "documents")
    return judge(documents, training.fit_quality(documents, table(spark, sf_dir, "labels"))).drop("states")


QUERIES: dict[str, Callable] = {"op7_quality_rules": op7_quality_rules}
ORACLES: dict[str, str] = {}
