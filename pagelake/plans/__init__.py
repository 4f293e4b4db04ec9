"""Named queries (each ``(spark, sf_dir) -> DataFrame``) and their DuckDB oracles."""

from __future__ import annotations

from . import lms_queries, media_queries, page_queries, table_queries

_MODULES = [page_queries, table_queries, lms_queries, media_queries]


def all_queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles():
    out = {}
    for m in _MODULES:
        out.update(m.ORACLES)
    return out
