"""Response tables in, datasets out.

The response table (superset of an HTTP response) is::

    page_key STRING, base_url STRING, url STRING, status INT,
    headers MAP<STRING,STRING>, body STRING, fetched_at TIMESTAMP,
    kind STRING, course_id BIGINT, cmid BIGINT, attempt BIGINT, modtype STRING
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import filename_from_disposition, normalize_headers, origin

RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("page_key", T.StringType()),
        T.StructField("base_url", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("body", T.StringType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("course_id", T.LongType()),
        T.StructField("cmid", T.LongType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("modtype", T.StringType()),
    ]
)
RESPONSE_COLUMNS = [f.name for f in RESPONSE_SCHEMA.fields]


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read stored responses with an explicit schema (no inference).

    Partitioned layouts (``kind=…/modtype=…``) prune at the scan, so filter on
    ``kind`` / ``modtype`` right after this call."""
    reader = spark.read.schema(RESPONSE_SCHEMA)
    df = reader.parquet(path) if fmt == "parquet" else reader.format(fmt).load(path)
    return df.withColumn("headers", normalize_headers("headers"))


def conform_responses(df: DataFrame) -> DataFrame:
    """Give any frame the full response column set (missing columns as typed nulls)."""
    cols = []
    for f in RESPONSE_SCHEMA.fields:
        cols.append(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in RESPONSE_COLUMNS]
    return df.select(*cols, *extra)


def pages_as_responses(pages: DataFrame) -> DataFrame:
    """Adapter for the driver's ``pages(page_id, url, html)`` table: status 200,
    body = html, kind = 'page', base_url = the page's origin."""
    return conform_responses(
        pages.select(
            F.col("page_id").cast("string").alias("page_key"),
            origin("url").alias("base_url"),
            F.col("url"),
            F.lit(200).alias("status"),
            F.create_map().cast("map<string,string>").alias("headers"),
            F.col("html").alias("body"),
            F.lit("page").alias("kind"),
        )
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_manifest(df: DataFrame) -> DataFrame:
    """File name, size and content type per download response (metadata only)."""
    h = F.col("headers")
    return df.select(
        "page_key",
        "url",
        "status",
        F.coalesce(h["content-type"], F.lit("application/octet-stream")).alias("content_type"),
        filename_from_disposition(h["content-disposition"]).alias("filename"),
        F.coalesce(h["content-length"].try_cast("bigint"), F.octet_length("body").cast("bigint")).alias("size_bytes"),
    )


def write_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet",
                  mode: str = "overwrite") -> None:
    """Write a result table; nested columns stay nested in parquet, the
    ``json`` format serialises them as text."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)
