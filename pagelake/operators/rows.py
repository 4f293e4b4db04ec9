"""Order-dependent row logic across pages, without single-task steps.

Position columns are mandatory: nothing here relies on row order surviving a
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """W1 across pages: the first row per key by ``order`` (one shuffle on ``keys``)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def last_per_key(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """W2 across pages: per key, each value from the row with the largest ``order``
    (``max_by`` is a partial aggregate, so it combines map-side before the shuffle)."""
    return df.groupBy(*keys).agg(*[F.max_by(v, order).alias(v) for v in values])


def page_slice(df: DataFrame, keys: list[str], order: list[str], limit: int = 10, offset: int = 0) -> DataFrame:
    """W4 on a table: rows ``offset+1 .. offset+limit`` per key in ``order``, with
    ``total`` and ``has_more = offset + returned < total``.  A limit that is no
    positive number means 10, any other is honoured (floor); offset >= 0."""
    limit, offset = forum_limit(limit), max(0, int(offset))
    w = Window.partitionBy(*keys).orderBy(*order)
    wk = Window.partitionBy(*keys)
    ranked = df.withColumn("_rn", F.row_number().over(w)).withColumn("total", F.count(F.lit(1)).over(wk))
    page = ranked.where((F.col("_rn") > offset) & (F.col("_rn") <= offset + limit))
    returned = F.least(F.greatest(F.col("total") - offset, F.lit(0)), F.lit(limit))
    return page.withColumn("has_more", (offset + returned) < F.col("total")).drop("_rn")


def forum_limit(limit) -> int:
    """Forum page size: non-positive or invalid -> 10, else its floor."""
    try:
        v = float(limit)
    except (TypeError, ValueError):
        return 10
    if not v > 0:
        return 10
    return max(1, int(v // 1))


def cap_per_group(df: DataFrame, keys: list[str], order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows per group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def alpha_label(idx: Column) -> Column:
    """0 -> 'A', 25 -> 'Z', 26 -> 'AA', … (bijective base 26, up to 13 letters)."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    init = F.struct((idx + 1).cast("bigint").alias("n"), F.lit("").alias("s"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(13)),
        init,
        lambda acc, _: F.when(
            acc["n"] > 0,
            F.struct(
                F.floor((acc["n"] - 1) / 26).cast("bigint").alias("n"),
                F.concat(F.substr(letters, ((acc["n"] - 1) % 26 + 1).cast("int"), F.lit(1)), acc["s"]).alias("s"),
            ),
        ).otherwise(acc),
        lambda acc: acc["s"],
    )


def dense_index(df: DataFrame, order: str, tie: str, name: str = "idx", span: int = 1 << 16, by: tuple[str, ...] = ()) -> DataFrame:
    """0-based position of every row by (``order``, ``tie``), for an integral ``order`` column (null first);
    rows of each combination of the columns ``by``, which are not null, are numbered by themselves.

    Rows fall into buckets of ``span`` consecutive order values; a bucket's rows are numbered by themselves
    and moved up by the number of rows in lower buckets, a running sum over one row per bucket.  All lazy:
    nothing runs before the action, and no intermediate table is written."""
    keyed = df.withColumn("_b", F.coalesce(F.floor(F.col(order).cast("bigint") / span), F.lit(-(1 << 62))))
    counts = keyed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    below = (Window.partitionBy(*by) if by else Window).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_b", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*by, "_b").orderBy(F.col(order).asc_nulls_first(), tie)
    return (
        keyed.withColumn("_rn", F.row_number().over(inside) - 1)
        .join(offsets, [*by, "_b"])
        .withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint"))
        .drop("_b", "_rn", "_off")
    )


def pseudonymize(df: DataFrame, col: str, prefix: str, order: str, out: str = "pseudonym") -> DataFrame:
    """The n-th distinct value in first-seen order becomes ``'<prefix> A'``, ``B``, …
    (``AA`` after ``Z``).  First-seen = the smallest ``order`` of each value
    (partial aggregate before the shuffle; equal positions rank by the value); the value -> label map is joined
    back with a plain join, so AQE broadcasts it only when it is small."""
    firsts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.min(order).alias("_first"))
    labelled = dense_index(firsts, "_first", col, "_idx").select(
        col, F.concat(F.lit(prefix + " "), alpha_label(F.col("_idx"))).alias(out)
    )
    return df.join(labelled, col, "left")
