"""Aggregates with arguments of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def threshold_sweep(rows: DataFrame, truth: Column, scores: dict[str, Column], cutoffs: list[float]) -> DataFrame:
    """combiner, cutoff, accuracy (rounded) of saying yes where a score reaches the cutoff, and how many reach it: all
    combined scores against all cutoffs in one pass. A null score reaches nothing; rows with a null truth are left out."""
    every = F.array(*[F.struct(F.lit(k).alias("combiner"), s.cast("double").alias("score")) for k, s in scores.items()])
    grid = F.explode(F.array(*[F.lit(float(c)) for c in cutoffs])).alias("cutoff")
    wide = rows.select(truth.alias("_truth"), F.explode(every).alias("_s")).where("_truth is not null").select("_truth", "_s.*", grid)
    said = F.coalesce(F.col("score") >= F.col("cutoff"), F.lit(False))
    return wide.groupBy("combiner", "cutoff").agg(F.round(F.avg((said == F.col("_truth")).cast("int")), 6).alias("accuracy"), F.count(F.when(said, 1)).alias("reached"))


def coverage_report(labels: DataFrame, score: Column, occurrences: Column, cutoffs: list[float]) -> DataFrame:
    """cutoff, labels and occurrences at or above it, and their shares of all in percent: what the cutoff command prints."""
    wide = labels.select(score.cast("double").alias("_s"), occurrences.cast("long").alias("_n"), F.explode(F.array(*[F.lit(float(c)) for c in cutoffs])).alias("cutoff"))
    hit = F.col("_s") >= F.col("cutoff")
    n = F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0))
    return wide.groupBy("cutoff").agg(F.count(F.when(hit, 1)).alias("labels"), F.round(100.0 * F.count(F.when(hit, 1)) / F.count(F.lit(1)), 4).alias("label_coverage"), n.alias("occurrences"), F.round(100.0 * n / F.sum("_n"), 4).alias("occurrence_coverage"))
