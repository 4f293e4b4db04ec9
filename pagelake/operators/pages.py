"""Page text extractors (title + main text) over shredded responses.

All are single projections over the node array: no shuffle, batch or stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dom as D
from ..functions.text import truncate
from ..functions.urls import url_path

HEADING = D.tag("h1", "h2")
MAIN_CANDIDATES = [D.id_is("region-main"), D.attr_eq("role", "main"), D.tag("main"), D.tag("body")]
PAGE_CANDIDATES = [
    # '#region-main .box.generalbox', '[role=main] .box.generalbox', '#region-main', '[role=main]', 'main'
    ("within", D.id_is("region-main"), D.cls("box", "generalbox")),
    ("within", D.attr_eq("role", "main"), D.cls("box", "generalbox")),
    ("self", D.id_is("region-main")),
    ("self", D.attr_eq("role", "main")),
    ("self", D.tag("main")),
]


def request_path(url: Column) -> Column:
    """The request path of a stored response: path plus query of its URL."""
    q = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)?", 1)
    p = url_path(url)
    return F.concat(F.when(p == "", F.lit("/")).otherwise(p), q)


def clean_page(df: DataFrame, path: Column | None = None, max_len: int | None = None,
               keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Remove chrome, then title = first h1/h2 (default: the request path),
    text = first of ``#region-main, [role=main], main, body`` in *document order*
    (a comma union, so ``body`` wins), truncated to ``max_len`` if given; ``length`` before truncation.

    Staged in three projections so the located nodes and the text are computed
    once per page (each is referenced several times downstream).
    """
    nodes = F.col("nodes")
    path = request_path(F.col("url")) if path is None else path
    kept = F.filter(nodes, lambda n: ~n["in_chrome"])
    located = df.select(
        *keep,
        path.alias("path"),
        "nodes",
        D.first(F.filter(kept, HEADING)).alias("_h"),
        D.first(F.filter(kept, D.any_of(MAIN_CANDIDATES))).alias("_m"),
    )
    texts = located.select(
        *keep,
        "path",
        D.node_text(nodes, F.col("_h"), skip_chrome=True).alias("_title"),
        D.node_text(nodes, F.col("_m"), skip_chrome=True).alias("_text"),
    )
    return texts.select(
        *keep,
        "path",
        F.when(F.col("_title") == "", F.col("path")).otherwise(F.col("_title")).alias("title"),
        truncate(F.col("_text"), max_len).alias("text"),
        F.length("_text").cast("bigint").alias("length"),
    )


def fallback_columns(nodes: Column, label: Column, max_len: int | None = None) -> dict[str, Column]:
    """E17 as columns: title first (chrome still present), then chrome removed and
    the candidates tried *one after another* (``#region-main`` wins over ``body``)."""
    title = D.first_text(nodes, HEADING)
    ok = F.col("status").between(200, 299)
    raw = D.cascade_text(nodes, MAIN_CANDIDATES, skip_chrome=True)
    return {
        "title": F.when(ok & (title != ""), title).otherwise(label),
        "raw_text": F.when(ok, truncate(raw, max_len)).otherwise(F.lit("")),
        "parser_degraded": F.lit(True),
    }


def fallback_text(df: DataFrame, nodes: Column | None = None, label: Column | None = None,
                  max_len: int | None = None, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Always degraded."""
    nodes = F.col("nodes") if nodes is None else nodes
    label = F.concat_ws(" ", F.col("modtype"), F.col("cmid").cast("string")) if label is None else label
    return df.select(*keep, *[c.alias(k) for k, c in fallback_columns(nodes, label, max_len).items()])


def _first_in(nodes: Column, cand) -> Column:
    if cand[0] == "within":
        return D.first(D.select_within(nodes, cand[1], cand[2]))
    return D.first(F.filter(nodes, cand[1]))


def page_text_columns(nodes: Column, max_len: int | None = None) -> dict[str, Column]:
    """E6 as columns: first non-empty of five containers; degraded iff empty."""
    parts = [F.nullif(D.node_text(nodes, _first_in(nodes, c)), F.lit("")) for c in PAGE_CANDIDATES]
    text = F.coalesce(*parts, F.lit(""))
    title = D.first_text(nodes, HEADING)
    ok = F.col("status").between(200, 299)
    label = F.concat(F.lit("Page "), F.col("cmid").cast("string"))
    return {
        "title": F.when(ok & (title != ""), title).otherwise(label),
        "text": F.when(ok, truncate(text, max_len)).otherwise(F.lit("")),
        "parser_degraded": ~ok | (text == ""),
    }


def page_text(df: DataFrame, nodes: Column | None = None, max_len: int | None = None, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E6 over shredded responses."""
    nodes = F.col("nodes") if nodes is None else nodes
    return df.select(*keep, *[c.alias(k) for k, c in page_text_columns(nodes, max_len).items()])
