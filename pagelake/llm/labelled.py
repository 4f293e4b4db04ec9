"""Labelled rows, all of them or bounded samples, for the classifiers that are trained here."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_split


def labelled_rows(labels: DataFrame, documents: DataFrame, target: str) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id and label of every row to learn from, rows of each class).

    Only rows outside the held-out split whose document exists count; null ids and labels are left out, and
    a doc_id with several labels takes the largest."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(target).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~crc_split(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).where(F.col("label").isin(0, 1))
    known = known.join(documents.select(F.col("doc_id").cast("bigint").alias("doc_id")), "doc_id", "left_semi")
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
    return known, {c: counts.get(c, 0) for c in (0, 1)}


def training_labels(labels: DataFrame, documents: DataFrame, target: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id and label of at most ``per_class`` of the ``labelled_rows`` of each class, rows of each class in all).

    The sample is the lowest in hash order, so it is the same at every run; each class is a bounded top-k,
    not a sort of the table."""
    known, counts = labelled_rows(labels, documents, target)
    parts = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    return parts[0].union(parts[1]), counts


def prior_shift(counts: dict[int, int], per_class: int) -> float:
    """What to add to the log-odds of a model fitted on the bounded sample, so that it holds for all rows."""
    taken = {c: min(n, per_class) for c, n in counts.items()}
    if not all(counts.values()):
        return 0.0
    return math.log(counts[1] / counts[0]) - math.log(taken[1] / taken[0])
