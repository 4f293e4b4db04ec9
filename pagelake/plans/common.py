"""Shared inputs for the named queries: driver tables as response rows, shredded once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shred import shred_html
from ..sources import pages_as_responses, read_table


def spread(spark: SparkSession, df: DataFrame) -> int | None:
    """Partitions to ask of the shredder: as many as task slots where the input has fewer files than slots (a
    small table in one file), none where the files already fill the slots.  Listing files runs no job."""
    slots = spark.sparkContext.defaultParallelism
    return slots if len(df.inputFiles()) < slots else None


def shredded_pages(spark: SparkSession, sf_dir: str, keep_html: bool = False, body: Column | None = None) -> DataFrame:
    """``pages`` as responses with their node arrays (page_id kept as BIGINT); ``body`` rewrites the markup first."""
    resp = pages_as_responses(read_table(spark, sf_dir, "pages")).select(
        F.col("page_key").cast("bigint").alias("page_id"), "page_key", "url", "base_url", "status",
        (F.col("body") if body is None else body).alias("body"),
        F.length("body").cast("bigint").alias("html_len"),
    )
    return shred_html(resp, keep_html=keep_html, partitions=spread(spark, resp))


# SQL fragments shared by oracles (DuckDB dialect, RE2 regexes).
WS = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]+"


def sql_norm(expr: str) -> str:
    return f"trim(regexp_replace(coalesce({expr}, ''), '{WS}', ' ', 'g'))"


def sql_decode(expr: str) -> str:
    """Decode the entities present in the driver pages (``&amp;`` last, ``;`` optional)."""
    out = expr
    for ent, ch in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&nbsp;", " ")):
        out = f"replace({out}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return f"regexp_replace({out}, '&amp;?', '&', 'g')"


def sql_strip_tags(expr: str) -> str:
    return f"regexp_replace({expr}, '<[^>]*>', '', 'g')"


def sql_truncate(expr: str, n: int) -> str:
    return f"CASE WHEN length({expr}) > {n} THEN left({expr}, {n - 1}) || '…' ELSE {expr} END"


CHROME = ("nav", "header", "footer", "script", "style", "noscript")


def sql_body_without_chrome(html: str = "html") -> str:
    """Everything after ``<body…>``, comments and chrome elements removed
    (an unclosed chrome element runs to the end of the page)."""
    body = f"CASE WHEN regexp_matches({html}, '<body[^>]*>') THEN regexp_extract({html}, '(?s)<body[^>]*>(.*)$', 1) ELSE {html} END"
    out = f"regexp_replace({body}, '<!--.*?-->', '', 'gs')"
    for t in CHROME:
        out = f"regexp_replace({out}, '<{t}[\\s>].*?(</{t}>|$)', '', 'gs')"
    return out


def sql_request_path(url: str = "url") -> str:
    p = f"regexp_extract({url}, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)"
    q = f"regexp_extract({url}, '^[^?#]*(\\?[^#]*)?', 1)"
    return f"(CASE WHEN {p} = '' THEN '/' ELSE {p} END || {q})"
