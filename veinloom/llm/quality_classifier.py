"""Document quality from the marginals of a line-labelling CRF."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm import line_crf, training
from veinloom.llm.storage import table
from veinloom.llm.worker_cache import forget

#: Rows of a batch are cut into runs of about so many characters, so that memory is bounded by one text plus this.
CHUNK_CHARS = 2_000_000


def in_chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, x in enumerate(texts):
        size += len(x or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def score_quality(documents: DataFrame, model: line_crf.Model) -> DataFrame:
    """doc_id, score and number of lines of every row.

    A null or empty text, or one of white space only, has no lines and the score 0. Repeated rows are scored each. Other
    columns are not read, whatever their names. An empty table gives no rows. Map-only: no shuffle.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in in_chunks(texts):
                s, n = line_crf.scores(shared.value, [line_crf.split_lines(x) for x in texts[a:b]])
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(s), pa.array(n)], names=["doc_id", "score", "n_lines"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, n_lines long")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents; see score_quality for nulls, empty texts and repeated rows, and fit_quality for
    what is learnt from. A null id is in no test fold."""
    documents = table(spark, sf_dir, "documents")
    model = training.fit_quality(documents, table(spark, sf_dir, "labels"))
    return score_quality(documents, model).select("doc_id", F.coalesce(training.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_lines")


QUERIES: dict[str, Callable] = {"op3_quality_classifier": op3_quality_classifier}
ORACLES: dict[str, str] = {}
