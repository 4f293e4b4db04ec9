"""S3, E19a–E19e, E20: calendar events from upcoming lists, calendar blocks,
month views and the JSON event feed.

Every extractor returns rows with the timeline event columns::

    page_key, pos, title, course_id, course_name, modtype, event_type, cmid,
    event_id, due_at, due_at_unix, url

All are projections + explode over one response row; nothing shuffles, so they
run unchanged on a stream.  Page-level failures (bad feed envelope, month view
without its container) become rows with an ``error_code`` instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dom as D
from ..functions.dates import lms_date_unix, unix_guard, unix_to_iso, ymd_to_unix
from ..functions.text import js_parse_int, normalize_text
from ..functions.urls import absolute_url, cmid_from_url, course_id_from_url, modtype_from_component, modtype_from_href

EVENT_FIELDS = ["title", "course_id", "course_name", "modtype", "event_type", "cmid", "event_id", "due_at",
                "due_at_unix", "url"]

FEED_EVENT_TYPE = T.ArrayType(T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("eventtype", T.StringType()),
    T.StructField("timestart", T.DoubleType()),
    T.StructField("modulename", T.StringType()),
    T.StructField("instance", T.LongType()),
    T.StructField("course", T.StructType([T.StructField("id", T.LongType()), T.StructField("fullname", T.StringType())])),
    T.StructField("action", T.StructType([T.StructField("url", T.StringType())])),
    T.StructField("url", T.StringType()),
]))


def _nz(x: Column) -> Column:
    """JS ``x || undefined`` for numbers: 0 and null become null."""
    return D.bind(x, lambda v: F.when(v != 0, v))


def _ne(x: Column) -> Column:
    """JS ``x || undefined`` for strings: '' and null become null."""
    return D.nonempty(x)


def _event(title=None, course_id=None, course_name=None, modtype=None, event_type=None, cmid=None, event_id=None,
           due_unix=None, due_text=None, url=None) -> Column:
    """The event struct; ``due_at`` is the display text when one is given (the
    extractor passes null when a timestamp attribute won), else the ISO form of
    the unix due time."""
    none_s, none_l = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    due_unix = due_unix if due_unix is not None else none_l
    due_at = F.coalesce(due_text if due_text is not None else none_s, unix_to_iso(due_unix))
    vals = [title, course_id, course_name, modtype, event_type, cmid, event_id, due_at, due_unix, url]
    types = ["string", "bigint", "string", "string", "string", "bigint", "bigint", "string", "bigint", "string"]
    return F.struct(*[(v if v is not None else F.lit(None)).cast(t).alias(k) for k, v, t in zip(EVENT_FIELDS, vals, types)])


def _explode_events(df: DataFrame, events: Column, keep: tuple[str, ...], extra: list[Column] | None = None) -> DataFrame:
    out = D.exploded(df, [*keep, *(extra or [])], events)
    return out.select(*keep, *[F.col(c) for c in out.columns if c not in (*keep, "pos", "e")],
                      F.col("pos").cast("bigint").alias("pos"), *[F.col("e")[k].alias(k) for k in EVENT_FIELDS])


def _ts_from_string(s: Column) -> Column:
    """applyUnixDateFromString: leading integer, used only if finite and > 0."""
    return unix_guard(js_parse_int(s))


# ------------------------------------------------------------------ E19a


def upcoming_items(nodes: Column, base: Column, tz: str) -> Column:
    """``li[data-region=event-list-item], [data-region=event-list-content] > li``."""
    items = F.filter(nodes, lambda li: (li["tag"] == "li") & (
        (D.attr(li, "data-region") == "event-list-item")
        | (D.attr(D.parent_of(nodes, li), "data-region") == "event-list-content")))
    raw = D.let(
        items,
        a=lambda li: D.first(D.find(nodes, li, D.tag("a") & D.attr_contains("href", "/mod/"))),
        name=lambda li: _ne(D.node_text(nodes, D.first(D.find(nodes, li, D.cls("event-name") | D.cls("eventname") | D.tag("h3"))))),
        date_text=lambda li: _ne(D.node_text(nodes, D.first(D.find(nodes, li, D.cls("date") | D.tag("time") | D.cls("event-time"))))),
        ts_str=lambda li: F.coalesce(
            D.attr(D.first(D.find(nodes, li, D.has_attr("data-timestamp"))), "data-timestamp"),
            D.attr(D.closest(nodes, li, D.has_attr("data-timestamp")), "data-timestamp")),
        course=lambda li: _ne(D.node_text(nodes, D.first(D.find(nodes, li, D.cls("coursename") | D.cls("course-name"))))),
    )
    mid = D.let(
        raw,
        href=lambda r: D.attr(r["a"], "href"),
        title=lambda r: F.coalesce(r["name"], _ne(D.node_text(nodes, r["a"]))),
        ts=lambda r: _ts_from_string(r["ts_str"]),
        parsed=lambda r: F.floor(lms_date_unix(r["date_text"], tz)).cast("bigint"),
    )
    return F.transform(mid, lambda m: _event(
        title=m["title"], course_id=F.when(m["href"].isNotNull(), _nz(course_id_from_url(m["href"]))),
        course_name=m["_"]["course"], modtype=modtype_from_href(m["href"]),
        cmid=F.when(m["href"].isNotNull(), _nz(cmid_from_url(m["href"]))),
        due_unix=F.coalesce(m["ts"], m["parsed"]),
        due_text=F.when(m["ts"].isNull(), m["_"]["date_text"]),
        url=F.when(m["href"].isNotNull(), absolute_url(base, m["href"])),
    ))


# ------------------------------------------------------------------ E19b


def _course_from(li_course_attr: Column, href: Column) -> Column:
    """data-course-id wins when present (0 -> missing), else the course from the URL."""
    return F.when(_ne(li_course_attr).isNotNull(), _nz(js_parse_int(li_course_attr))).when(
        href.isNotNull(), _nz(course_id_from_url(href)))


def block_items(nodes: Column, base: Column) -> Column:
    """``li[data-region=event-item]`` with component, type, ids and the
    timestamp cascade (anchor, day cell, li, ancestor, then year/month/day)."""
    items = F.filter(nodes, lambda li: (li["tag"] == "li") & (D.attr(li, "data-region") == "event-item"))
    raw = D.let(
        items,
        a=lambda li: D.first(D.find(nodes, li, D.tag("a") & (D.attr_eq("data-action", "view-event")
                                                             | D.attr_eq("data-action", "event-action-view")
                                                             | D.attr_contains("href", "/mod/")))),
        day=lambda li: D.closest(nodes, li, D.attr_eq("data-region", "day")),
        up_ts=lambda li: D.attr(D.closest(nodes, li, D.has_attr("data-timestamp")), "data-timestamp"),
        names=lambda li: _ne(normalize_text(F.array_join(F.transform(
            F.filter(D.subtree(nodes, li), D.cls("coursename") | D.attr_eq("data-region", "course-name")),
            lambda n: D.text_of(nodes, n)), ""))),
    )
    mid = D.let(
        raw,
        ts_str=lambda r: F.coalesce(
            D.attr(r["a"], "data-timestamp"),
            D.attr(D.closest(nodes, r["a"], D.has_attr("data-day-timestamp")), "data-day-timestamp"),
            D.attr(r["_"], "data-day-timestamp"), r["up_ts"]),
        title=lambda r: F.coalesce(
            _ne(D.node_text(nodes, D.first(D.find(nodes, r["a"], D.cls("eventname"))))),
            _ne(normalize_text(D.attr(r["a"], "title"))), _ne(D.node_text(nodes, r["a"]))),
        href=lambda r: D.attr(r["a"], "href"),
    )
    due = D.let(mid, due=lambda m: F.coalesce(
        _ts_from_string(m["ts_str"]), _ts_from_string(D.attr(m["_"]["day"], "data-day-timestamp")),
        unix_guard(ymd_to_unix(D.attr(m["_"]["day"], "data-year"), D.attr(m["_"]["day"], "data-month"),
                               D.attr(m["_"]["day"], "data-day")))))
    out = F.transform(due, lambda d: _event(
        title=d["_"]["title"], course_id=_course_from(D.attr(d["_"]["_"]["_"], "data-course-id"), d["_"]["href"]),
        course_name=d["_"]["_"]["names"],
        modtype=modtype_from_component(D.attr(d["_"]["_"]["_"], "data-event-component")),
        event_type=D.attr(d["_"]["_"]["_"], "data-event-eventtype"),
        cmid=F.when(d["_"]["href"].isNotNull(), _nz(cmid_from_url(d["_"]["href"]))),
        event_id=_nz(js_parse_int(D.attr(d["_"]["_"]["_"], "data-event-id"))), due_unix=d["due"],
        url=F.when(d["_"]["href"].isNotNull(), absolute_url(base, d["_"]["href"])),
    ))
    return F.filter(out, lambda e: e["title"].isNotNull())


# ------------------------------------------------------------------ E19c


def calendar_block(nodes: Column, base: Column, tz: str) -> Column:
    """``.block_calendar_upcoming li a[href*='/mod/']``; the date is the li
    text with the title removed (first occurrence, like ``String.replace``)."""
    links = D.select_within(nodes, D.cls("block_calendar_upcoming"), D.tag("a") & D.attr_contains("href", "/mod/"))
    raw = D.let(
        links,
        li=lambda a: D.closest(nodes, a, D.tag("li")),
        blk=lambda a: D.closest(nodes, a, D.cls("block_calendar_upcoming")),
        href=lambda a: D.attr(a, "href"),
        title=lambda a: D.node_text(nodes, a),
    )
    raw = F.filter(raw, lambda r: r["li"].isNotNull() & (r["li"]["pre"] > r["blk"]["pre"])
                   & (F.coalesce(r["href"], F.lit("")) != "") & (r["title"] != ""))
    mid = D.let(raw, li_text=lambda r: D.node_text(nodes, r["li"]))
    mid = D.let(mid, at=lambda m: F.instr(m["li_text"], m["_"]["title"]))
    dated = D.let(mid, date_text=lambda m: _ne(normalize_text(F.when(
        m["at"] > 0, F.concat(F.substring(m["_"]["li_text"], 1, m["at"] - 1),
                              F.substr(m["_"]["li_text"], m["at"] + F.length(m["_"]["_"]["title"])))
    ).otherwise(m["_"]["li_text"]))))
    dated = D.let(dated, parsed=lambda d: F.floor(lms_date_unix(d["date_text"], tz)).cast("bigint"))

    def build(d):
        r = d["_"]["_"]["_"]["_"]
        href = r["href"]
        return _event(
            title=r["title"], course_id=_nz(course_id_from_url(href)), modtype=modtype_from_href(href),
            cmid=_nz(cmid_from_url(href)), due_unix=d["parsed"], due_text=d["_"]["date_text"],
            url=absolute_url(base, href),
        )

    return F.transform(dated, build)


# ------------------------------------------------------------------ E20

MONTH_CONTAINER = D.cls("calendarwrapper")


def month_anchors(nodes: Column) -> Column:
    """``[data-region=day] a[data-action=view-event], … a[data-action=event-action-view], … a[href*=/mod/]``."""
    return D.select_within(
        nodes, D.attr_eq("data-region", "day"),
        D.tag("a") & (D.attr_eq("data-action", "view-event") | D.attr_eq("data-action", "event-action-view")
                      | D.attr_contains("href", "/mod/")))


def month_events(nodes: Column, base: Column) -> Column:
    """One event per day-cell anchor; timestamp cascade, course from the li
    attribute over the URL, course name from the li or the cell label."""
    raw = D.let(
        month_anchors(nodes),
        li=lambda a: D.closest(nodes, a, D.tag("li")),
        td=lambda a: D.closest(nodes, a, D.tag("td")),
        day=lambda a: D.closest(nodes, a, D.attr_eq("data-region", "day")),
        up_ts=lambda a: D.attr(D.closest(nodes, a, D.has_attr("data-timestamp")), "data-timestamp"),
        up_day=lambda a: D.attr(D.closest(nodes, a, D.has_attr("data-day-timestamp")), "data-day-timestamp"),
        title=lambda a: F.coalesce(
            _ne(D.node_text(nodes, D.first(D.find(nodes, a, D.cls("eventname"))))),
            _ne(normalize_text(D.attr(a, "title"))), _ne(D.node_text(nodes, a))),
    )
    mid = D.let(
        raw,
        ts_str=lambda r: F.coalesce(D.attr(r["_"], "data-timestamp"), r["up_ts"], D.attr(r["li"], "data-timestamp"),
                                    r["up_day"], D.attr(r["li"], "data-day-timestamp"), D.attr(r["td"], "data-day-timestamp")),
        href=lambda r: D.attr(r["_"], "href"),
        li_course=lambda r: _ne(normalize_text(F.array_join(F.transform(
            F.filter(D.subtree(nodes, r["li"]), D.cls("coursename")), lambda n: D.text_of(nodes, n)), ""))),
        aria=lambda r: D.attr(r["td"], "aria-label"),
    )
    due = D.let(mid, due=lambda m: F.coalesce(
        _ts_from_string(m["ts_str"]),
        unix_guard(ymd_to_unix(D.attr(m["_"]["day"], "data-year"), D.attr(m["_"]["day"], "data-month"),
                               D.attr(m["_"]["day"], "data-day")))))

    def build(d):
        m, r = d["_"], d["_"]["_"]
        li = r["li"]
        return _event(
            title=r["title"], course_id=_course_from(D.attr(li, "data-course-id"), m["href"]),
            course_name=F.coalesce(m["li_course"], _ne(F.when(m["aria"].isNotNull(), normalize_text(m["aria"])))),
            modtype=modtype_from_component(D.attr(li, "data-event-component")),
            event_type=D.attr(li, "data-event-eventtype"), cmid=F.when(m["href"].isNotNull(), _nz(cmid_from_url(m["href"]))),
            event_id=_nz(js_parse_int(D.attr(li, "data-event-id"))), due_unix=d["due"],
            url=F.when(m["href"].isNotNull(), absolute_url(base, m["href"])),
        )

    return F.filter(F.transform(due, build), lambda e: e["title"].isNotNull())


def extract_month(df: DataFrame, course_id=None, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E20 page level: events (optionally one course); no events but the container
    -> no rows; no events and no container -> one row with error_code 'parse_error'."""
    nodes = F.col("nodes")
    ev = month_events(nodes, F.col("base_url"))
    if course_id is not None:
        ev = F.filter(ev, lambda e: e["course_id"] == F.lit(course_id))
    staged = df.select(*keep, ev.alias("_ev"), F.exists(nodes, MONTH_CONTAINER).alias("_has"))
    err = F.when((F.size("_ev") == 0) & ~F.col("_has"), F.array(_event())).otherwise(F.array())
    rows = F.concat(F.transform("_ev", lambda e: F.struct(e.alias("e"), F.lit(None).cast("string").alias("error_code"))),
                    F.transform(err, lambda e: F.struct(e.alias("e"), F.lit("parse_error").alias("error_code"))))
    out = D.exploded(staged, keep, rows, item="r")
    return out.select(*keep, F.when(F.col("r.error_code").isNull(), F.col("pos")).cast("bigint").alias("pos"),
                      *[F.col("r.e")[k].alias(k) for k in EVENT_FIELDS], F.col("r.error_code").alias("error_code"))


# ------------------------------------------------------------------ S3 / E19d


def feed_events(body: Column, base: Column) -> Column:
    """S3 + E19d: the JSON feed as ``STRUCT<error_code, message, events ARRAY<event>>``.

    Envelope checks in order: not JSON -> invalid_json; not an array with a first
    element -> unexpected_shape; error flag or exception -> ajax_error (with the
    platform's error code); no ``data.events`` array -> missing_events."""
    v = F.try_parse_json(body)
    first = F.try_variant_get(v, "$[0]", "variant")
    is_obj = F.coalesce(F.schema_of_variant(first).startswith("OBJECT"), F.lit(False))
    err_flag = F.coalesce(F.try_variant_get(first, "$.error", "boolean"), F.lit(False))
    exc = F.try_variant_get(first, "$.exception", "variant")
    raw_events = F.try_variant_get(first, "$.data.events", "variant")
    is_arr = F.coalesce(F.schema_of_variant(raw_events).startswith("ARRAY"), F.lit(False))
    events = F.try_variant_get(raw_events, "$", FEED_EVENT_TYPE.simpleString())
    code = (F.when(v.isNull(), F.lit("invalid_json"))
            .when(first.isNull() | ~is_obj, F.lit("unexpected_shape"))
            .when(err_flag | (exc.isNotNull() & (F.schema_of_variant(exc) != "NULL")), F.lit("ajax_error"))
            .when(~is_arr, F.lit("missing_events")))
    message = F.when(code == "ajax_error", F.try_variant_get(first, "$.exception.errorcode", "string"))

    def ev(e):
        raw_url = F.coalesce(e["action"]["url"], e["url"])
        ts = F.when(e["timestart"] != 0, unix_guard(e["timestart"]))
        return _event(
            title=_ne(e["name"]), modtype=_ne(e["modulename"]), event_type=_ne(e["eventtype"]),
            event_id=_nz(e["id"]), due_unix=ts, course_id=_nz(e["course"]["id"]),
            course_name=_ne(e["course"]["fullname"]),
            url=F.when(_ne(raw_url).isNotNull(), absolute_url(base, raw_url)),
            cmid=F.when(_ne(raw_url).isNotNull(), _nz(cmid_from_url(raw_url))),
        )

    return F.struct(code.alias("error_code"), message.alias("message"),
                    F.when(code.isNull(), F.transform(events, ev)).otherwise(F.array()).alias("events"))


def read_event_feed(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """S3 as rows: one row per feed event, or one error row per bad envelope."""
    staged = df.select(*keep, feed_events(F.col("body"), F.col("base_url")).alias("f"))
    rows = F.concat(
        F.transform("f.events", lambda e: F.struct(e.alias("e"), F.lit(None).cast("string").alias("error_code"),
                                                   F.lit(None).cast("string").alias("message"))),
        F.when(F.col("f.error_code").isNotNull(),
               F.array(F.struct(_event().alias("e"), F.col("f.error_code").alias("error_code"),
                                F.col("f.message").alias("message")))).otherwise(F.array()),
    )
    out = D.exploded(staged, keep, rows, item="r")
    return out.select(*keep, F.when(F.col("r.error_code").isNull(), F.col("pos")).cast("bigint").alias("pos"),
                      *[F.col("r.e")[k].alias(k) for k in EVENT_FIELDS], "r.error_code", "r.message")


# ------------------------------------------------------------------ E19e


def timeline_source(pages: DataFrame, feeds: DataFrame | None = None, tz: str = "Europe/Berlin",
                    keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E19e: per upcoming page, the first non-empty source of (a) upcoming list,
    (b) block items, (c) calendar block, then (d) the feed stored for the same
    ``page_key`` (a left join: pages without a feed keep their HTML result)."""
    nodes, base = F.col("nodes"), F.col("base_url")
    # a later source is read only where all before it are empty
    filled = lambda items: D.bind(items, lambda v: F.when(F.size(v) > 0, v))
    html = F.coalesce(filled(upcoming_items(nodes, base, tz)), filled(block_items(nodes, base)), filled(calendar_block(nodes, base, tz)))
    staged = pages.select(*keep, html.alias("_html"))
    if feeds is not None:
        f = feeds.select(*keep, feed_events(F.col("body"), F.col("base_url"))["events"].alias("_feed"))
        staged = staged.join(f, list(keep), "left")
        chosen = F.coalesce(F.col("_html"), F.col("_feed"), F.array())
    else:
        chosen = F.coalesce(F.col("_html"), F.array())
    source = (F.when(F.col("_html").isNotNull(), F.lit("html")).when(F.size(chosen) > 0, F.lit("feed"))
              .otherwise(F.lit("none")))
    return _explode_events(staged.select(*keep, chosen.alias("_ev"), source.alias("source")), F.col("_ev"), keep,
                           extra=[F.col("source")])
