"""The timeline over extracted event rows.

Events carry ``course_id, event_type, modtype, due_at_unix, due_at`` (all
nullable).  Null rules follow the reference: the course and type filters drop
nulls, the window and modtype filters keep them, and undated events sort
first (as 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lms_date_unix

DEFAULT_WINDOW = 30


def window_of(w) -> int:
    """Window days: non-positive or invalid -> 30, else its floor."""
    try:
        v = float(w)
    except (TypeError, ValueError):
        return DEFAULT_WINDOW
    if not v > 0 or v != v:
        return DEFAULT_WINDOW
    return int(v // 1)


def event_due(df: DataFrame, tz: str = "Europe/Berlin") -> Column:
    """Seconds of an event's due time: the unix column, else the parsed display date."""
    due = F.col("due_at_unix")
    if "due_at" in df.columns:
        due = F.coalesce(due, lms_date_unix(F.col("due_at"), tz))
    return due


def timeline(events: DataFrame, *, as_of: float, window_days=DEFAULT_WINDOW, course_id=None, event_type=None,
             modtypes=None, tz: str = "Europe/Berlin", sort: bool = True) -> DataFrame:
    """P1–P4 then O1.  ``as_of`` is explicit unix seconds (never the wall clock)."""
    w = window_of(window_days)
    ev = events
    if course_id is not None:
        ev = ev.where(F.col("course_id") == F.lit(course_id))
    if event_type:
        ev = ev.where(F.col("event_type") == F.lit(event_type))
    due = event_due(ev, tz)
    ev = ev.where(due.isNull() | due.between(F.lit(as_of), F.lit(as_of + w * 86400)))
    if modtypes:
        ev = ev.where(F.col("modtype").isNull() | F.col("modtype").isin(list(modtypes)))
    ev = ev.withColumn("_sort", F.coalesce(event_due(ev, tz).cast("double"), F.lit(0.0)))
    return ev.orderBy("_sort", *[c for c in ("event_id",) if c in ev.columns]).drop("_sort") if sort else ev.drop("_sort")


def top_due(events: DataFrame, n: int, tie: str = "event_id", tz: str = "Europe/Berlin") -> DataFrame:
    """O2: the first ``n`` events by due time (undated first) — a top-k, planned as
    ``TakeOrderedAndProject`` (per-partition top-n, then a merge of n·partitions rows)."""
    return events.orderBy(F.coalesce(event_due(events, tz).cast("double"), F.lit(0.0)), F.col(tie)).limit(n)


def restrict_to(events: DataFrame, allowed: DataFrame, on: list[str]) -> DataFrame:
    """Keep events whose key is in ``allowed`` (left-semi join; no columns added)."""
    return events.join(allowed.select(*on), on, "left_semi")
