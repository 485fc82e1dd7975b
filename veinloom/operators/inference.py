"""A model of any kind, applied to a column in bounded batches and loaded once in each Python worker."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, SparkSession
from pyspark.sql import types as T

#: Rows that a model sees at a time.
BATCH_ROWS = 256


def inferred(text: Column, load: Callable[[], Callable[[Sequence[str]], Sequence]], kind: T.DataType, batch_rows: int = BATCH_ROWS) -> Column:
    """What the model says of each text: load() is called once a worker and gives a function of a list of texts.

    Null texts are not shown to the model and give null; empty texts are shown. Texts are whole, however long. kind is a
    string or a number; a model with more to say gives JSON.
    """

    def make() -> Callable:
        model = load()

        def predict(texts: np.ndarray) -> np.ndarray:
            flat = texts.ravel().tolist()
            shown = [i for i, x in enumerate(flat) if x is not None]
            out = np.empty(len(flat), dtype=object)
            for i, y in zip(shown, model([flat[i] for i in shown]) if shown else ()):
                out[i] = y
            return out

        return predict

    return predict_batch_udf(make, return_type=kind, batch_size=batch_rows)(text)


def shared(spark: SparkSession, model) -> Callable[[], object]:
    """Sends a model of bounded size to the executors; what is returned gives it there, as load() needs it."""
    sent = spark.sparkContext.broadcast(model)
    return lambda: sent.value


