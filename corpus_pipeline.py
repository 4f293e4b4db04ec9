"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir), where ``docs`` is the table of documents
that its predecessor wrote, and returns the documents that stay, all columns
unchanged; the last returns packed pieces.  Decisions are made per row: a stage
numbers its documents, writes the numbers of the rows that go and takes them out by
an anti join, which Spark broadcasts only below its own size limit.  Operator and
anti join find the same numbers: those of a table just read from Parquet files are
the places of its rows in them, those of any other frame are written with its rows.
Spark's own would differ between two scans when executors come or go.

An empty table passes every stage as an empty table; null ids and texts follow
the definitions of the operators; extra columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm import cuckoo_dedup, simhash, sumsq_packing, text_cnn, winnow
from pagelake.llm.common import materialize, number_rows, read_table, scratch_path, small_batches

TOXIC_AT = 0.3
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


def _in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage with its Python steps, all of which run before it returns, fed by small Arrow batches."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return stage(spark, docs, sf_dir)

    return run_stage


def _without(docs: DataFrame, row: str, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose number in the column ``row`` stands in ``dropped``, and without that column."""
    gone = materialize(dropped.select(F.col("row").alias(row)), "dropped")
    return docs.join(gone, row, "left_anti").drop(row)


@_in_small_batches
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, row = number_rows(docs, "numbered")
    scored = text_cnn.score_toxicity(docs, read_table(spark, sf_dir, "labels"), row=row)
    return _without(docs, row, scored.where(F.col("score") >= TOXIC_AT))


@_in_small_batches
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, row = number_rows(docs, "numbered")
    return _without(docs, row, cuckoo_dedup.deduplicate(docs, row=row).where("NOT kept"))


@_in_small_batches
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest doc_id stays (a null id ranks last)."""
    docs, row = number_rows(docs, "numbered")
    grouped = materialize(simhash.near_duplicates(docs, row=row), "near-groups")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    stays = grouped.groupBy("component").agg(F.min(rank).alias("first")).select("component", F.col("first.row").alias("stays"))
    return _without(docs, row, grouped.join(stays, "component").where("row <> stays"))


@_in_small_batches
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs, row = number_rows(docs, "numbered")
    marked = winnow.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), row=row)
    return _without(docs, row, marked.where(winnow.is_contaminated(F.col("n_hit"), F.col("n_words"))))


@_in_small_batches
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = sumsq_packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: neither the classifier nor the tokenizer can be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
