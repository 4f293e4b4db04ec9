"""Q1–Q7: degraded flags, error records, layout fingerprints, drift and shape reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dom as D


def fingerprint(df: DataFrame, container: D.Pred, select: D.Pred = D.ELEMENT,
                value: Callable[[Column], Column] | None = None, keep: tuple[str, ...] = ("page_key",),
                full: bool = False) -> DataFrame:
    """Q3: values of the nodes matching ``select`` under every ``container``
    match, sorted, as JSON -> SHA-1 -> first 8 hex characters (``full``: the whole hash too, as ``layout``).

    The reference form is ``container='<selector>'``, ``select=has_attr('data-region')``,
    ``value=attrs['data-region']``; any attribute or the tag name works the same way.
    """
    value = value or (lambda n: n["tag"])
    vals = F.array_sort(F.transform(D.select_within(F.col("nodes"), container, select), value))
    staged = df.select(*keep, vals.alias("_v"))
    hashed = staged.select(*keep, F.sha1(F.to_json(F.col("_v")).cast("binary")).alias("layout"), "_v")
    return hashed.select(
        *keep,
        *(["layout"] if full else []),
        F.substring("layout", 1, 8).alias("fingerprint"),
        F.size("_v").cast("bigint").alias("values_count"),
    )


def layout_drift(fp: DataFrame, size_col: str = "html_len") -> DataFrame:
    """Q4: pages per layout (the whole hash; its prefix is shown) with their size range (a drift report)."""
    return fp.groupBy("layout").agg(
        F.first("fingerprint").alias("fingerprint"),
        F.count("*").alias("pages"),
        F.min(size_col).cast("bigint").alias(f"min_{size_col}"),
        F.max(size_col).cast("bigint").alias(f"max_{size_col}"),
    ).drop("layout")


def error_record(code: Column, parser: Column | None = None, selector: Column | None = None,
                 status: Column | None = None, path: Column | None = None, message: Column | None = None) -> Column:
    """Q2: the nullable error struct carried next to a result (a bad page never fails the job)."""
    none = F.lit(None).cast("string")
    return F.when(
        code.isNotNull(),
        F.struct(
            code.alias("code"),
            (parser if parser is not None else none).alias("parser"),
            (selector if selector is not None else none).alias("selector"),
            (status if status is not None else F.lit(None).cast("int")).alias("status"),
            (path if path is not None else none).alias("path"),
            (message if message is not None else none).alias("message"),
        ),
    )


def data_attr_names(n: Column) -> Column:
    """Sorted ``data-*`` attribute names of a node (empty for a missing node)."""
    return F.coalesce(F.sort_array(F.filter(F.map_keys(n["attrs"]), lambda k: k.startswith("data-"))),
                      F.array().cast("array<string>"))


def attr_profile(df: DataFrame, anchors_fn, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Q5: per event anchor, the sorted ``data-*`` names on the anchor, its
    closest ``li`` and ``td``, and whether the cell carries a day timestamp."""
    nodes = F.col("nodes")
    rows = D.let(anchors_fn(nodes), li=lambda a: D.closest(nodes, a, D.tag("li")),
                 td=lambda a: D.closest(nodes, a, D.tag("td")))
    prof = F.transform(rows, lambda r: F.struct(
        F.to_json(data_attr_names(r["_"])).alias("anchor_data_attrs"),
        F.to_json(data_attr_names(r["li"])).alias("list_item_data_attrs"),
        F.to_json(data_attr_names(r["td"])).alias("table_cell_data_attrs"),
        F.coalesce(D.attr(r["td"], "data-day-timestamp").isNotNull(), F.lit(False)).alias("has_td_day_timestamp"),
    ))
    out = D.exploded(df, keep, prof, item="p")
    return out.select(*keep, F.col("pos").cast("bigint").alias("pos"), "p.*")
