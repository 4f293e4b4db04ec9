"""ST2: incremental extraction — every page extractor is a stateless projection
(array-form first/last wins, paging and caps, no window or aggregate), so the
same function runs on ``readStream`` over arriving response files.

Cross-page operators (W1/W2 across pages, joins, aggregates, pseudonyms) are
batch operators and are applied to the extracted output tables instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.shred import shred_html
from ..sources import RESPONSE_SCHEMA


def stream_responses(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming read of stored response files (parquet, explicit schema)."""
    r = spark.readStream.schema(RESPONSE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def extract_stream(responses: DataFrame, extractor: Callable[[DataFrame], DataFrame], kinds: list[str] | None = None) -> DataFrame:
    """Filter by kind *before* shredding (no pushdown through the Python stage),
    shred, then apply ``extractor``; works for batch and streaming frames alike."""
    df = responses
    if kinds:
        df = df.where(df.kind.isin(kinds))
    cols = ["page_key", "base_url", "url", "status", "headers", "cmid", "modtype", "body"]
    return extractor(shred_html(df.select(*cols), keep_html=False))


def run_to_table(stream: DataFrame, checkpoint: str, table_path: str, trigger_once: bool = True):
    """Append a streaming extraction to parquet with a checkpoint (exactly-once
    file sink); ``availableNow`` processes what has arrived and stops."""
    w = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start(table_path)
