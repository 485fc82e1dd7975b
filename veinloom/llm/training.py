"""The bounded sample of labelled documents from which the line models are fitted."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinloom.llm import line_crf

#: At most so many labelled documents of each label are fetched to the driver for fitting.
MAX_PER_LABEL = 800
#: Of the labelled texts, only those up to this size are candidates for the sample; scoring has no such bound.
MAX_TRAIN_CHARS = 30_000


def held_out(doc_id) -> F.Column:
    """Whether a document's labels are for testing only."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def fit_quality(documents: DataFrame, labels: DataFrame, max_per_label: int = MAX_PER_LABEL, all_folds: bool = False) -> line_crf.Model:
    """Fits the CRF on at most 2 * max_per_label labelled documents, chosen by a hash of their ids.

    Rows of the test fold are left out unless all_folds. Labels that are null, or not 0 or 1, and ids without a text are
    not used; an id with several labels counts once, with the larger. Without both labels the neutral model results.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    if not all_folds:
        known = known.where(~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).withColumn("_h", F.xxhash64("_id"))
    rows = []
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("_y") == y).orderBy("_h", "_id").limit(max_per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = documents.select(F.col("doc_id").alias("_d"), F.col("text").alias("_t")).where(F.length("_t") <= MAX_TRAIN_CHARS)
    ids = {r["_id"]: r["_y"] for r in chosen.collect()}
    if ids:
        # The ids are at most 2 * max_per_label, so the filter and what it lets through are bounded.
        frame = documents.sparkSession.createDataFrame([(int(k), int(v)) for k, v in ids.items()], "_id bigint, _y int")
        rows = texts.join(F.broadcast(frame), F.col("_d") == F.col("_id")).select("_d", "_t", "_y").collect()
    rows = sorted({r["_d"]: r for r in rows}.values(), key=lambda r: r["_d"])
    return line_crf.fit([line_crf.split_lines(r["_t"]) for r in rows], np.array([r["_y"] for r in rows], dtype=np.int64))
