"""Mixed activity responses to one typed table, one row per response.

Every page is parsed once, in one Python stage.  The extractors then run one after another as
projections over the same rows: each sees the nodes of its own ``modtype`` and null for all other
rows, and its fields are kept as ``title``, ``content`` (JSON without nulls, P11), ``parser_degraded``
and ``error``.  No row is joined, grouped or split off, so null and repeated keys keep every row.
A page of an unknown type, or whose extractor finds markup it does not know, gives its plain text in
the same last projection and carries the error record (Q2).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lms
from .activities import extract_rating, extract_resource, extract_url
from .pages import fallback_columns, page_text
from .quality import error_record
from .shred import shred_html

Extractor = Callable[..., DataFrame]
KEEP = ("page_key", "modtype")
PAGE = ("base_url", "status", "headers", "cmid")
_REGISTERED: dict[str, Extractor] = {}


def register_extractor(modtype: str, extract: Extractor) -> None:
    """Use ``extract`` for pages of ``modtype``, in place of the library's own if there is one.

    ``extract(pages, keep=...)`` gets shredded responses (``nodes``, status, headers, base_url, cmid,
    modtype, page_key; nodes are null on rows of other types) and returns exactly one row per input row:
    the ``keep`` columns unchanged, title, parser_degraded, any fields, and ``error`` if it can fail."""
    _REGISTERED[modtype] = extract


def extractors(as_of: float) -> dict[str, Extractor]:
    """modtype -> extractor (shredded responses, keep) of one row per page."""
    return {
        "resource": extract_resource,
        "url": extract_url,
        "page": page_text,
        "forum": lms.extract_forum,
        "assign": lms.extract_assign,
        "quiz": partial(lms.extract_quiz, as_of=as_of),
        "ratingallocate": extract_rating,
        "folder": lms.extract_folder_page,
        "workshop": lms.extract_workshop,
        "lesson": lms.extract_lesson,
        "choice": lms.extract_choice,
        "feedback": lms.extract_feedback,
        **_REGISTERED,
    }


def extract_activity(responses: DataFrame, as_of: float, partitions: int | None = None, known: dict[str, Extractor] | None = None) -> DataFrame:
    """page_key, modtype, title, content (JSON), parser_degraded and error of every response.

    ``known`` names the extractors to use (default: all); pages of other types give their plain text.
    Each extractor adds its expressions to the plan, so a table of few types plans faster with few."""
    none = error_record(F.lit(None).cast("string"))
    pages = shred_html(responses.select(*KEEP, *PAGE, "body"), keep_html=False, partitions=partitions)
    staged = pages.select(F.struct(*KEEP, *PAGE, "nodes").alias("_page"), F.lit(None).alias("_found"))
    for modtype, extract in (extractors(as_of) if known is None else known).items():
        mine = F.col("_page.modtype") == modtype
        own = staged.select("_page", "_found", *[F.col(f"_page.{c}") for c in (*KEEP, *PAGE)], F.when(mine, F.col("_page.nodes")).alias("nodes"))
        rows = extract(own, keep=("_page", "_found"))
        fields = [c for c in rows.columns if c not in ("_page", "_found", "title", "parser_degraded", "error")]
        found = F.struct("title", F.to_json(F.struct(*fields)).alias("content"), "parser_degraded", (F.col("error") if "error" in rows.columns else none).alias("error"))
        staged = rows.select("_page", F.when(mine, found).otherwise(F.col("_found")).alias("_found"))
    failed = F.col("_found").isNull() | F.col("_found.error").isNotNull()
    page = staged.select("_found", failed.alias("_failed"), *[F.col(f"_page.{c}") for c in (*KEEP, *PAGE)], F.when(failed, F.col("_page.nodes")).alias("nodes"))
    plain = fallback_columns(F.col("nodes"), F.concat_ws(" ", F.col("modtype"), F.col("cmid").cast("string")))
    read = page.select(*KEEP, "_found", "_failed", *[c.alias(f"_{k}") for k, c in plain.items()])
    choose = lambda own, text: F.when(F.col("_failed"), text).otherwise(F.col(f"_found.{own}")).alias(own)
    return read.select(
        *KEEP, choose("title", F.col("_title")), choose("content", F.to_json(F.struct(F.col("_raw_text").alias("raw_text")))),
        choose("parser_degraded", F.col("_parser_degraded")), F.col("_found.error").alias("error"),
    )
