"""Row-producing helpers over node arrays: one output row per matching node.

Per-match values are computed *inside* the array (``transform``) and only the
small result structs are exploded, so a page's node array is never copied
once per match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dom as D


def explode_matches(df: DataFrame, matches: Column, fields: dict[str, Callable[[Column, Column], Column]],
                    keep: tuple[str, ...] = ("page_key",), pos_name: str = "pos") -> DataFrame:
    """``matches`` is an array of nodes; ``fields`` maps output names to
    ``fn(nodes, node) -> Column``.  Output: ``keep`` + ``pos`` + fields."""
    nodes = F.col("nodes")
    structs = F.transform(matches, lambda a: F.struct(*[fn(nodes, a).alias(k) for k, fn in fields.items()]))
    return D.exploded(df, keep, structs, pos_name, "_m").select(
        *keep, F.col(pos_name).cast("bigint").alias(pos_name), *[F.col("_m")[k].alias(k) for k in fields]
    )


def child_path(*tags: str) -> D.Sel:
    """``t0 > t1 > … > tn`` as a predicate on the last node, through parent pointers."""
    nodes = F.col("nodes")

    def fn(n):
        cond = n["tag"] == tags[-1]
        cur = n
        for t in reversed(tags[:-1]):
            cur = F.get(nodes, cur["parent"])
            cond = cond & (cur["tag"] == t)
        return cond

    return D.Sel(fn)
