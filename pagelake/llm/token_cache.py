"""Operator 6: token counts with a digest cache.

A count is stored under (version, digest): the SHA-256 of the tokenizer's file
and the SHA-256 of the content, null as empty and otherwise byte for byte, since
any further normalisation could change the count.  Digests that the cache lacks
are encoded once each, whichever rows hold them, and appended; then every row
takes its count from the cache.

Texts move through one shuffle, and only those of missing digests: each task
passes on the first copy of a text, so a text of a third of all rows arrives
once per task.

Defined cases: null and empty texts have 0 bytes and the tokenizer's count of
the empty text; repeated rows share a digest; an empty table appends nothing;
equal cache rows (two writers) count once; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_text, documents_of, materialize, text_blocks, with_row
from .tokens import encoder, tokenizer_digest

_SCHEMA = "digest binary, n_tokens long, version string"


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for a tokenizer version; none if the cache does not exist yet."""
    try:
        stored = spark.read.schema(_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], _SCHEMA)
    return stored.where(F.col("version") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _digests(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = arrow_text(batch.column("text"))
            sha = [hashlib.sha256(data[a:b].tobytes()).digest() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_bytes": pa.array(np.diff(offs)), "digest": pa.array(sha, pa.binary())})

    return with_row(documents_of(docs)).select("row", "doc_id", "text").mapInArrow(run, "row long, doc_id long, n_bytes long, digest binary")


def _first_copies(docs: DataFrame) -> DataFrame:
    """(digest, text) of the first copy of each text in a task; a task remembers digests, not texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            data, offs = arrow_text(batch.column("text"))
            keep, sha = [], []
            for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
                d = hashlib.sha256(data[a:b].tobytes()).digest()
                if d not in seen:
                    seen.add(d)
                    keep.append(i)
                    sha.append(d)
            yield pa.RecordBatch.from_pydict({"digest": pa.array(sha, pa.binary()), "text": batch.column("text").take(pa.array(keep, pa.int64()))})

    return docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, "digest binary, text string")


def _encoded(texts: DataFrame, tokenizer: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, last = encoder(tokenizer), None
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            keep = [i for i, d in enumerate(digests) if d != (digests[i - 1] if i else last)]  # sorted by the join
            last = digests[-1] if digests else last
            column = batch.column("text").take(pa.array(keep, pa.int64()))
            counts = [np.diff(enc.encode(data, offs)[1]) for _, _, data, offs in text_blocks(column)]
            yield pa.RecordBatch.from_pydict({"digest": pa.array([digests[i] for i in keep], pa.binary()), "n_tokens": pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))})

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """Per document: row, doc_id, n_bytes (UTF-8), digest, n_tokens; missing counts are appended to ``cache``."""
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    rows = materialize(_digests(docs), "token-digests")
    misses = rows.select("digest").distinct().join(read_cache(spark, cache, version), "digest", "left_anti")
    found = _encoded(_first_copies(docs).join(materialize(misses, "token-misses"), "digest", "left_semi"), tokenizer)
    found = found.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")).withColumn("version", F.lit(version))
    found.write.mode("append").partitionBy("version").parquet(cache)
    # written out, so that the join deals out its rows itself and may split a digest of many rows
    counts = materialize(read_cache(spark, cache, version), "token-counts")
    return rows.join(counts, "digest").select("row", "doc_id", "n_bytes", "digest", "n_tokens")
