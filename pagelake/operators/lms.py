"""Course lists, search results, forum, assignment and quiz pages.

Each extractor is a projection (plus an explode for list outputs) over
shredded responses with ``page_key, base_url, status, cmid, nodes``; per-page
lists are de-duplicated and paged inside the array, so nothing here shuffles
and every extractor also runs on a stream.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dom as D
from ..functions.dates import parse_lms_date
from ..functions.text import JS_WS_CLASS, js_parse_int, normalize_text, truncate_snippet
from ..functions.urls import absolute_url
from .flat import Pages, grouped, listed
from .rows import forum_limit

WS = "[" + JS_WS_CLASS + "]"


def _nodes() -> Column:
    return F.col("nodes")


def _ok() -> Column:
    return F.col("status").between(200, 299)


def first_wins(arr: Column, key) -> Column:
    """W1 inside a page: keep the first element per key (document order kept)."""
    keys = F.transform(arr, key)
    return F.filter(arr, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def _text(nodes: Column, n: Column) -> Column:
    return D.node_text(nodes, n)


def _raw_text(nodes: Column, n: Column) -> Column:
    return F.coalesce(D.text_of(nodes, n), F.lit(""))


# ------------------------------------------------------------------ E1


def extract_courses(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Course links ``a[href*="/course/view.php?id="]``; id from the first
    ``[?&]id=``; first link per id wins; name = title attribute, else link text,
    else ``Course <id>``; url resolved against the base."""
    nodes = _nodes()
    links = F.filter(nodes, lambda a: (a["tag"] == "a") & F.contains(D.attr(a, "href"), F.lit("/course/view.php?id=")))
    items = F.transform(links, lambda a: F.struct(
        a["pre"].alias("pre"),
        D.nonempty(F.regexp_extract(D.attr(a, "href"), r"[?&]id=(\d+)", 1)).try_cast("bigint").alias("cid"),
    ))
    items = first_wins(F.filter(items, lambda x: x["cid"].isNotNull()), lambda x: x["cid"])
    staged = df.select(*keep, "base_url", "nodes", items.alias("_items"))

    def row(x):
        a = F.get(nodes, x["pre"])
        title = normalize_text(D.attr(a, "title"))
        name = F.coalesce(D.nonempty(title), D.nonempty(_text(nodes, a)),
                          F.concat(F.lit("Course "), x["cid"].cast("string")))
        return F.struct(x["cid"].alias("course_id"), name.alias("name"),
                        absolute_url(F.col("base_url"), D.attr(a, "href")).alias("url"))

    out = D.exploded(staged, keep, F.transform(F.col("_items"), row), item="c")
    return out.select(*keep, F.col("pos").cast("bigint").alias("pos"), "c.course_id", "c.name", "c.url")


# ------------------------------------------------------------------ E3 / E3b / E3c


def _page_number(nodes: Column, li: Column) -> Column:
    attr_num = js_parse_int(D.attr(li, "data-page-number"))
    link_text = _text(nodes, D.first(D.find(nodes, li, D.tag("a") & D.cls("page-link"))))
    return F.coalesce(attr_num, F.when(link_text.rlike(r"^\d+$"), link_text.try_cast("bigint")))


def search_has_more(nodes: Column) -> Column:
    """A later ``li.page-item`` sibling of the active item whose page number
    exceeds the active one (any numbered item when the active number is unknown)."""
    active = D.first(D.select_within(nodes, D.tag("ul") & D.cls("pagination"), D.tag("li") & D.cls("page-item", "active")))
    active_num = _page_number(nodes, active)
    later = D.next_siblings(nodes, active, D.tag("li") & D.cls("page-item"))
    return F.coalesce(
        F.exists(later, lambda s: _page_number(nodes, s).isNotNull()
                 & (active_num.isNull() | (_page_number(nodes, s) > active_num))),
        F.lit(False),
    )


def search_page_state(nodes: Column) -> Column:
    """``STRUCT<has_region_main, has_no_results_marker, is_valid_empty_state>``."""
    region = D.first(F.filter(nodes, D.id_is("region-main")))
    text = D.text_of(nodes, region)
    marker = F.coalesce(text.rlike(r"(?is)(Keine\s+Kurse.*gefunden|No\s+courses?.*found|Nothing\s+to\s+display)"), F.lit(False))
    has = region.isNotNull()
    return F.struct(has.alias("has_region_main"), marker.alias("has_no_results_marker"), (has & marker).alias("is_valid_empty_state"))


def extract_search_results(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """``div.coursebox[data-courseid]`` boxes, first wins per id; fullname,
    category, snippet (F3), url and enrol url."""
    nodes = _nodes()
    boxes = F.filter(nodes, lambda b: (b["tag"] == "div") & F.array_contains(b["class_tokens"], "coursebox")
                     & D.attr(b, "data-courseid").isNotNull())
    items = F.transform(boxes, lambda b: F.struct(b["pre"].alias("pre"), js_parse_int(D.attr(b, "data-courseid")).alias("cid")))
    items = first_wins(F.filter(items, lambda x: x["cid"].isNotNull()), lambda x: x["cid"])
    staged = df.select(*keep, "base_url", "nodes", items.alias("_items"))

    def row(x):
        box = F.get(nodes, x["pre"])
        link = D.first(F.filter(D.subtree(nodes, box), lambda a: (a["tag"] == "a") & (
            D.inside(nodes, box, a, D.tag("h3") & D.cls("coursename"))
            | (D.inside(nodes, box, a, D.tag("h3")) & F.contains(D.attr(a, "href"), F.lit("/course/view.php?id=")))
        )))
        href = F.coalesce(D.attr(link, "href"), F.lit(""))
        full = normalize_text(F.coalesce(D.attr(link, "title"), _raw_text(nodes, link)))
        cat = _text(nodes, D.first(D.find(nodes, box, D.tag("a"), within=D.cls("coursecat"))))
        summary = _raw_text(nodes, D.first(D.find(nodes, box, D.cls("summary"))))
        cid = x["cid"].cast("string")
        return F.struct(
            x["cid"].alias("course_id"),
            F.coalesce(D.nonempty(full), F.concat(F.lit("Course "), cid)).alias("fullname"),
            D.nonempty(cat).alias("category"),
            truncate_snippet(summary).alias("summary_snippet"),
            absolute_url(F.col("base_url"), href).alias("url"),
            absolute_url(F.col("base_url"), F.concat(F.lit("/enrol/index.php?id="), cid)).alias("enrol_url"),
        )

    out = D.exploded(staged, keep, F.transform(F.col("_items"), row), item="r")
    return out.select(*keep, F.col("pos").cast("bigint").alias("pos"), "r.*")


# ------------------------------------------------------------------ E7 / W4


def _discussion(nodes: Column, tr: Column) -> Column:
    topic = D.first(D.find(nodes, tr, D.tag("a"), within=D.tag("th") & D.cls("topic")))
    alt = D.first(D.find(nodes, tr, D.tag("a") & D.attr_contains("href", "/mod/forum/discuss.php")))
    title_el = F.coalesce(topic, alt)
    item_title = _text(nodes, title_el)
    href = D.attr(title_el, "href")

    def info_div(cell_pred):
        return D.first(F.filter(D.subtree(nodes, tr), lambda d: (d["tag"] == "div")
                                & F.array_contains(D.parent_of(nodes, d)["class_tokens"], "author-info")
                                & D.inside(nodes, tr, D.parent_of(nodes, d), cell_pred)))

    author_raw = F.coalesce(D.nonempty(_raw_text(nodes, info_div(D.tag("td") & D.cls("author")))),
                            _raw_text(nodes, D.first(D.find(nodes, tr, D.tag("td") & D.cls("author")))))
    last_raw = F.coalesce(D.nonempty(_raw_text(nodes, info_div(D.tag("td") & D.cls("text-start")))),
                          _raw_text(nodes, D.first(D.find(nodes, tr, D.tag("td") & D.cls("lastpost")))))
    spans = D.find(nodes, tr, D.tag("span"), within=D.tag("td"))
    replies = D.first(F.filter(F.transform(spans, lambda s: js_parse_int(_text(nodes, s))), lambda v: v.isNotNull()))
    return F.struct(
        js_parse_int(D.attr(tr, "data-discussionid")).alias("discussion_id"),
        F.coalesce(D.nonempty(item_title), F.lit("(ohne Titel)")).alias("title"),
        D.nonempty(normalize_text(author_raw)).alias("author"),
        D.nonempty(normalize_text(last_raw)).alias("last_post"),
        replies.alias("replies"),
        absolute_url(F.col("base_url"), href).alias("url"),
    )


def _discussion_rows(nodes: Column) -> Column:
    return D.select_within(nodes, D.tag("table") & D.cls("discussion-list"),
                           D.tag("tr") & D.attr_eq("data-region", "discussion-list-item"))


def extract_forum(df: DataFrame, limit=10, offset: int = 0, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E7 + W4 + A1: one row per forum page with the sliced discussions
    (``ARRAY<STRUCT>``), ``total_on_page``, ``has_more``, limit and offset."""
    limit, offset = forum_limit(limit), max(0, int(offset))
    nodes = _nodes()
    rows = _discussion_rows(nodes)
    staged = df.select(*keep, "base_url", "status", "cmid", "nodes", rows.alias("_rows"))
    sliced = F.slice(F.col("_rows"), offset + 1, limit)
    discussions = F.transform(sliced, lambda tr: _discussion(nodes, tr))
    total = F.size("_rows")
    title = D.first_text(nodes, D.tag("h1", "h2"))
    ok = _ok()
    return staged.select(
        *keep,
        F.when(ok & (title != ""), title).otherwise(F.concat(F.lit("Forum "), F.col("cmid").cast("string"))).alias("title"),
        F.when(ok, D.nonempty(D.cascade_text(nodes, [D.cls("activity-description"), D.id_is("intro")]))).alias("description"),
        F.when(ok, discussions).otherwise(F.array()).alias("discussions"),
        F.when(ok, total).otherwise(F.lit(0)).cast("bigint").alias("total_on_page"),
        F.when(ok, (offset + F.size(sliced)) < total).otherwise(F.lit(False)).alias("has_more"),
        F.lit(offset).alias("offset"),
        F.lit(limit).alias("limit"),
        (~ok | (total == 0)).alias("parser_degraded"),
    )


def forum_threads(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E7 as rows: every discussion of every forum page (no paging), with position."""
    nodes = _nodes()
    staged = df.select(*keep, "base_url", "nodes", _discussion_rows(nodes).alias("_rows"))
    out = D.exploded(staged, keep, F.transform(F.col("_rows"), lambda tr: _discussion(nodes, tr)), item="d")
    return out.select(*keep, F.col("pos").cast("bigint").alias("pos"), "d.*")


# ------------------------------------------------------------------ header lines


def header_lines(nodes: Column) -> Column:
    """Normalised texts of ``.activity-header .activity-dates div, .activity-header div``
    (the union is every div under an activity header), in document order."""
    divs = D.select_within(nodes, D.cls("activity-header"), D.tag("div"))
    return F.transform(divs, lambda d: _text(nodes, d))


def labelled_lines(lines: Column, pattern: str) -> Column:
    """(label in lower case, value) of every line that ``pattern`` matches, in order; stage it before use."""
    pairs = F.transform(lines, lambda l: F.struct(F.lower(F.regexp_extract(l, pattern, 1)).alias("k"), F.trim(F.regexp_extract(l, pattern, 2)).alias("v")))
    return F.filter(pairs, lambda p: p["k"] != "")


def last_labelled(pairs: Column, key_prefixes: tuple[str, ...]) -> Column:
    """W2 inside a page: the value of the last labelled line whose label starts with one of ``key_prefixes``."""
    def is_key(p):
        cond = F.lit(False)
        for x in key_prefixes:
            cond = cond | p["k"].startswith(x)
        return cond

    return D.last(F.filter(pairs, is_key))["v"]


# ------------------------------------------------------------------ E8

# The assignment status-table labels and the fields they fill.
ASSIGN_LABELS = {
    "submission status": "submission_status",
    "grading status": "grading_status",
    "grade": "grade",
    "time remaining": "time_remaining",
    "last modified": "last_modified",
    "group": "group",
}
ASSIGN_DATE_RE = r"(?i)^(Due|Open(?:s|ed)?|Close(?:s|d)?|Fälligkeit|Fällig)" + WS + r"*:?" + WS + r"*(.+)$"


def _table_rows(nodes: Column, table_pred) -> Column:
    """``<table_pred> tr`` rows as (label = first th, lower-cased; value = first td)."""
    trs = D.select_within(nodes, table_pred, D.tag("tr"))
    return F.transform(trs, lambda tr: F.struct(
        F.lower(_text(nodes, D.first(D.find(nodes, tr, D.tag("th"))))).alias("label"),
        _text(nodes, D.first(D.find(nodes, tr, D.tag("td")))).alias("value"),
    ))


def extract_assign(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Dates from header lines (last wins), status-table fields through the
    fixed label map (last row wins, values ≤ 500), description; degraded iff
    nothing was found."""
    nodes = _nodes()
    lines = df.select(*keep, "status", "cmid", "nodes", header_lines(nodes).alias("_lines"),
                      _table_rows(nodes, D.cls("submissionstatustable") | D.cls("submissionsummarytable")).alias("_rows"))
    staged = lines.select(
        *keep, "status", "cmid", "nodes", labelled_lines(F.col("_lines"), ASSIGN_DATE_RE).alias("_kv"),
        F.filter("_rows", lambda r: (r["label"] != "") & (r["value"] != "")).alias("_rows"),
        D.first_text(nodes, D.tag("h1", "h2")).alias("_h"),
    )
    kv = F.col("_kv")

    def last_value(label: str) -> Column:
        return D.last(F.filter(F.col("_rows"), lambda r: r["label"] == label))["value"]

    cols = {
        "description": D.nonempty(D.cascade_text(nodes, [D.cls("activity-description"), D.id_is("intro")])),
        "deadline": D.nonempty(last_labelled(kv, ("due", "fäll"))),
        "opens": D.nonempty(last_labelled(kv, ("open",))),
        "closes": D.nonempty(last_labelled(kv, ("close",))),
        **{name: last_value(label) for label, name in ASSIGN_LABELS.items()},
    }
    ok = _ok()
    found = staged.select(*keep, "status", "cmid", "_h", *[F.when(ok, c).alias(k) for k, c in cols.items()])
    return found.select(
        *keep,
        F.when(ok & (F.col("_h") != ""), F.col("_h")).otherwise(F.concat(F.lit("Assignment "), F.col("cmid").cast("string"))).alias("title"),
        *cols,
        (~ok | (F.coalesce(*[F.col(k) for k in cols]).isNull())).alias("parser_degraded"),
    )


# ------------------------------------------------------------------ E9 / E9b / A4 / P7

QUIZ_DATE_RE = r"(?i)^(Opened|Opens?|Closed|Closes?|Geöffnet|Öffnet|Schließt)" + WS + r"*:?" + WS + r"*(.+)$"
GRADING_RE = r"(?i)^Grading method" + WS + r"*:" + WS + r"*(.+)$"
ALLOWED_RE = r"(?i)^Attempts?" + WS + r"+allowed" + WS + r"*:" + WS + r"*(.+)$"
GRADE_RE = r"(?i)^(?:Your" + WS + r"+)?(?:final" + WS + r"+)?grade" + WS + r"*:" + WS + r"*(.+)$"
STATE_RE = r"(?i)^(finished|in progress|abgeschlossen|in bearbeitung|never submitted|überprüfen)"
MARKS_RE = r"^\d[\d.,/" + JS_WS_CLASS + r"]+$"
PERCENT_RE = r"^\d[\d.,]+" + WS + r"*%$"


def _attempt_rows(nodes: Column) -> Column:
    """``table.quizattemptsummary tbody tr, .quizattempt table tbody tr``.

    A ``tr`` always sits in a row group (the shredder adds the implied
    ``tbody``), so "a tbody row under a matching container" is a tr whose parent
    is a ``tbody`` and that lies in the container's subtree."""
    container = (D.tag("table") & D.cls("quizattemptsummary")) | D.cls("quizattempt")
    trs = D.select_within(nodes, container, D.tag("tr"))
    return F.filter(trs, lambda tr: D.parent_of(nodes, tr)["tag"] == "tbody")


def _attempt_cells(nodes: Column, tr: Column) -> Column:
    """One attempt row's cells (``td, th`` in document order) with their text and
    review link, computed once so later rules read plain fields."""
    return F.transform(D.find(nodes, tr, D.tag("td", "th")), lambda c: F.struct(
        _text(nodes, c).alias("t"),
        D.attr(D.first(F.filter(D.subtree(nodes, c), lambda a: (a["tag"] == "a")
                                & F.contains(D.attr(a, "href"), F.lit("/mod/quiz/review.php")))), "href").alias("review"),
    ))


def _last_where(cells: Column, pred) -> Column:
    return D.last(F.filter(cells, lambda c: pred(c["t"])))["t"]


def _attempt_state(cells: Column) -> Column:
    return _last_where(cells, lambda t: t.rlike(STATE_RE))


def _attempt(base: Column, cells: Column) -> Column:
    """Column 0 is the attempt number; state, marks, grade and review link are
    recognised by content, the last matching cell winning."""
    review = D.last(F.filter(cells, lambda c: c["review"].isNotNull()))["review"]
    return F.struct(
        js_parse_int(D.first(cells)["t"]).alias("attempt_number"),
        _attempt_state(cells).alias("state"),
        _last_where(cells, lambda t: t.rlike(MARKS_RE) & F.contains(t, F.lit("/"))).alias("marks"),
        _last_where(cells, lambda t: t.rlike(PERCENT_RE)).alias("grade"),
        absolute_url(base, review).alias("review_url"),
    )


def quizinfo_texts(nodes: Column) -> Column:
    """Normalised texts of ``.quizinfo p, .quizinfo li, .quizinfo div``."""
    return F.transform(D.select_within(nodes, D.cls("quizinfo"), D.tag("p", "li", "div")), lambda e: _text(nodes, e))


QUIZ_FIELDS = "_lines array<string>, _info array<string>, _cells array<array<struct<t: string, review: string>>>, _desc string, _h string"


def quiz_parts(p: Pages) -> dict[str, pa.Array]:
    """The texts and links that ``extract_quiz`` works on, for ``located_html``."""
    lines = p.under(p.cls("activity-header"), p.tag("div"))
    info = p.under(p.cls("quizinfo"), p.tag("p", "li", "div"))
    rows = p.under((p.tag("table") & p.cls("quizattemptsummary")) | p.cls("quizattempt"), p.tag("tr"))
    rows = rows[p.tag("tbody")[p.parent[rows]]]
    which, cells = p.pairs(rows, np.flatnonzero(p.tag("td", "th")))
    link = p.first_in(cells, p.tag("a") & p.has("href", lambda v: "/mod/quiz/review.php" in v))
    read = pa.StructArray.from_arrays([p.texts(cells), p.attr(link, "href")], ["t", "review"])
    described, intro = (p.texts(p.first_of(m)) for m in (p.cls("activity-description"), p.has("id", lambda v: v == "intro")))
    return {
        "_lines": p.listed(lines, p.texts(lines)),
        "_info": p.listed(info, p.texts(info)),
        "_cells": p.listed(rows, listed(grouped(which, len(rows)), read)),
        "_desc": pc.if_else(pc.equal(described, ""), intro, described),
        "_h": p.texts(p.first_of(p.tag("h1", "h2"))),
    }


def _last_info(texts: Column, pattern: str) -> Column:
    # an element is consumed by the first rule it matches (grading, then attempts, then grade)
    order = [GRADING_RE, ALLOWED_RE, GRADE_RE]
    earlier = order[: order.index(pattern)]

    def takes(t):
        cond = t.rlike(pattern)
        for p in earlier:
            cond = cond & ~t.rlike(p)
        return cond

    hit = D.last(F.filter(texts, takes))
    return D.nonempty(F.trim(F.regexp_extract(hit, pattern, 1)))


def extract_quiz(df: DataFrame, *, as_of: float, tz: str = "Europe/Berlin", keep: tuple[str, ...] = ("page_key",),
                 max_attempts: int | None = None) -> DataFrame:
    """E9 + E9b + A4 + P7, of pages with their nodes or with what ``quiz_parts`` found: dates, quiz info, attempts (all, or the first ``max_attempts``; all counted),
    remaining attempts, and the status at ``as_of`` (explicit unix seconds)."""
    if "nodes" in df.columns:
        nodes = _nodes()
        df = df.select(
            *keep, "status", "cmid", "base_url", header_lines(nodes).alias("_lines"), quizinfo_texts(nodes).alias("_info"),
            F.transform(_attempt_rows(nodes), lambda tr: _attempt_cells(nodes, tr)).alias("_cells"),
            D.cascade_text(nodes, [D.cls("activity-description"), D.id_is("intro")]).alias("_desc"),
            D.first_text(nodes, D.tag("h1", "h2")).alias("_h"),
        )
    base = F.col("base_url")
    # the attempts are made apart from their number and states, so that a reader of those alone resolves no link
    staged = df.select(
        *keep, "status", "cmid", "base_url", labelled_lines(F.col("_lines"), QUIZ_DATE_RE).alias("_kv"), "_info", "_desc", "_h",
        F.filter("_cells", lambda cs: (F.size(cs) >= 2) & js_parse_int(D.first(cs)["t"]).isNotNull()).alias("_att"),
    )
    kv = F.col("_kv")
    # stage 1: the located values (each is referenced several times below)
    found = staged.select(
        *keep, "status", "cmid",
        F.transform("_att", lambda cs: _attempt(base, cs)).alias("att"),
        F.size("_att").alias("used"),
        F.transform("_att", lambda cs: F.coalesce(_attempt_state(cs), F.lit(""))).alias("states"),
        D.nonempty(last_labelled(kv, ("open", "geöff", "öffn"))).alias("opens"),
        D.nonempty(last_labelled(kv, ("close", "schließ"))).alias("closes"),
        _last_info(F.col("_info"), ALLOWED_RE).alias("allowed"),
        _last_info(F.col("_info"), GRADING_RE).alias("grading"),
        _last_info(F.col("_info"), GRADE_RE).alias("overall"),
        D.nonempty(F.col("_desc")).alias("desc"),
        F.col("_h").alias("h"),
    )
    # stage 2: derived numbers
    c = F.col
    derived = found.select(
        "*",
        js_parse_int(c("allowed")).alias("allowed_n"),
        F.unix_seconds(parse_lms_date(c("opens"), tz)).alias("open_ts"),
        F.unix_seconds(parse_lms_date(c("closes"), tz)).alias("close_ts"),
    )
    used = c("used")
    remaining = F.when((used > 0) & c("allowed_n").isNotNull(), F.greatest(F.lit(0), c("allowed_n") - used))
    status = (
        F.when(c("open_ts") > F.lit(as_of), F.lit("not_open"))
        .when(c("close_ts") < F.lit(as_of), F.lit("closed"))
        .when(F.exists("states", lambda s: s.rlike(r"(?i)in progress|in bearbeitung")), F.lit("in_progress"))
        .when(F.exists("states", lambda s: s.rlike(r"(?i)finished|abgeschlossen")), F.lit("submitted"))
        .when(used > 0, F.lit("submitted"))
        .otherwise(F.lit("open"))
    )
    ok = _ok()
    anything = (c("desc").isNotNull() | c("opens").isNotNull() | c("closes").isNotNull() | c("grading").isNotNull()
                | (used > 0))
    return derived.select(
        *keep,
        F.when(ok & (c("h") != ""), c("h")).otherwise(F.concat(F.lit("Quiz "), c("cmid").cast("string"))).alias("title"),
        F.when(ok, c("desc")).alias("description"),
        F.when(ok, c("opens")).alias("opens"),
        F.when(ok, c("closes")).alias("closes"),
        F.when(ok, c("grading")).alias("grading_method"),
        F.when(ok, c("allowed")).alias("attempts_allowed"),
        F.when(ok, c("overall")).alias("overall_grade"),
        F.when(ok, F.col("att") if max_attempts is None else F.slice("att", 1, max_attempts)).otherwise(F.array()).alias("attempts"),
        F.when(ok, used).otherwise(F.lit(0)).cast("bigint").alias("attempts_used"),
        F.when(ok, remaining).cast("bigint").alias("attempts_remaining"),
        F.when(ok, status).otherwise(F.lit("unknown")).alias("quiz_status"),
        (~ok | ~anything).alias("parser_degraded"),
    )


# ------------------------------------------------------------------ E2

def extract_course_activities(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Sections ``li.course-section`` with a ``ul[data-for=cmlist]``; items
    ``li[data-for=cmitem]`` with an id and a modtype other than ``label``; name from
    ``[data-activityname]`` then ``.instancename``; link ``a.aalink`` then
    ``a.stretched-link`` then the synthesized view URL; empty sections dropped.
    One row per activity with its section position and name."""
    nodes = _nodes()
    base = F.col("base_url")
    sections = F.filter(nodes, D.tag("li") & D.cls("course-section"))

    def items_of(sec):
        cmlist = D.first(D.find(nodes, sec, D.tag("ul") & D.attr_eq("data-for", "cmlist")))
        lis = F.filter(D.subtree(nodes, cmlist), D.tag("li") & D.attr_eq("data-for", "cmitem"))
        raw = D.let(lis, cmid=lambda li: js_parse_int(D.attr(li, "data-id")),
                    mt=lambda li: F.regexp_extract(F.coalesce(D.attr(li, "class"), F.lit("")), r"\bmodtype_([a-z_]+)", 1))
        raw = F.filter(raw, lambda r: r["cmid"].isNotNull() & (r["mt"] != "") & (r["mt"] != "label"))

        def act(r):
            li = r["_"]
            named = F.coalesce(D.attr(D.first(D.find(nodes, li, D.has_attr("data-activityname"))), "data-activityname"), F.lit(""))
            name = F.when(named != "", named).otherwise(_text(nodes, D.first(D.find(nodes, li, D.cls("instancename")))))
            name = F.when(name != "", name).otherwise(F.concat(F.lit("Activity "), r["cmid"].cast("string")))
            link = F.coalesce(
                D.nonempty(D.attr(D.first(D.find(nodes, li, D.tag("a") & D.cls("aalink"))), "href")),
                D.nonempty(D.attr(D.first(D.find(nodes, li, D.tag("a") & D.cls("stretched-link"))), "href")))
            synth = F.concat(F.lit("/mod/"), r["mt"], F.lit("/view.php?id="), r["cmid"].cast("string"))
            return F.struct(r["cmid"].alias("cmid"), name.alias("name"),
                            r["mt"].alias("modtype"), absolute_url(base, F.coalesce(link, synth)).alias("url"))

        return F.when(cmlist.isNotNull(), F.transform(raw, act)).otherwise(F.array())

    secs = D.let(sections, name=lambda sec: F.coalesce(
        D.nonempty(D.attr(sec, "data-sectionname")),
        D.nonempty(_text(nodes, D.first(D.find(nodes, sec, D.tag("h3", "h4"))))), F.lit("")),
        acts=items_of)
    secs = F.filter(secs, lambda s: F.size(s["acts"]) > 0)
    title_text = normalize_text(F.regexp_replace(F.coalesce(D.text_of(nodes, D.first(F.filter(nodes, D.tag("title")))),
                                                            F.lit("")), ":.*$", ""))
    course_name = F.coalesce(D.nonempty(D.first_text(nodes, D.tag("h1"))), D.nonempty(title_text),
                             F.concat(F.lit("Course "), F.col("course_id").cast("string")))
    staged = D.exploded(df, [*keep, course_name.alias("course_name")], secs, "section_pos", "s")
    out = D.exploded(staged, [*keep, "course_name", F.col("section_pos").cast("bigint").alias("section_pos"),
                               F.col("s.name").alias("section_name")], F.col("s.acts"), item="a")
    return out.select(*keep, "course_name", "section_pos", "section_name", F.col("pos").cast("bigint").alias("pos"), "a.*")


# ------------------------------------------------------------------ E12

def extract_folder_page(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E12, one row per page: title, description, ``entries`` and parser_degraded.

    Entries come from the first of five link selectors (``.foldertree``, ``.fp-filename-icon``,
    ``.filemanager``, ``#region-main``, anywhere; each ``a[href*=pluginfile.php]``)
    that yields links; first link per raw href wins; name from ``.fp-filename`` /
    ``.filename``, the link text or the decoded last URL segment; size from ``.fp-size`` /
    ``.filesize`` in the enclosing ``li`` / ``tr``.  A page on another status than 2xx has no
    entries; degraded iff neither a description nor an entry was found."""
    from ..functions.urls import uri_decode

    nodes = _nodes()
    base = F.col("base_url")
    pf = D.tag("a") & D.attr_contains("href", "pluginfile.php")
    lists = [D.select_within(nodes, w, pf) for w in (D.cls("foldertree"), D.cls("fp-filename-icon"), D.cls("filemanager"),
                                                     D.id_is("region-main"))] + [F.filter(nodes, pf)]
    lists = [F.filter(l, lambda a: F.coalesce(D.attr(a, "href"), F.lit("")) != "") for l in lists]
    staged = df.select(*keep, "base_url", "status", "cmid", "nodes", *[l.alias(f"_l{i}") for i, l in enumerate(lists)])
    chosen = F.coalesce(*[F.when(F.size(f"_l{i}") > 0, F.col(f"_l{i}")) for i in range(len(lists))], F.array())
    chosen = first_wins(chosen, lambda a: D.attr(a, "href"))

    def entry(a):
        href = D.attr(a, "href")
        name_el = D.first(D.find(nodes, a, D.cls("fp-filename") | D.cls("filename")))
        raw = F.coalesce(D.nonempty(_raw_text(nodes, name_el)), _raw_text(nodes, a))
        seg = F.element_at(F.split(F.element_at(F.split(href, "/"), -1), r"\?"), 1)
        name = F.coalesce(D.nonempty(normalize_text(raw)), F.coalesce(uri_decode(seg), seg))
        holder = D.closest(nodes, a, D.tag("li", "tr"))
        size = _text(nodes, D.first(D.find(nodes, holder, D.cls("fp-size") | D.cls("filesize"))))
        return F.struct(name.alias("name"), absolute_url(base, href).alias("download_url"),
                        D.nonempty(size).alias("size"))

    entries = F.transform(chosen, entry)
    return _typed_page(staged, keep, "Folder", {}, "entries", entries)


def _typed_page(staged: DataFrame, keep: tuple[str, ...], label: str, fields: dict[str, Column], items: str, found: Column) -> DataFrame:
    """Title, description, ``fields`` and the array ``items`` of a 2xx page; defaults and degraded on any other."""
    nodes, ok = _nodes(), _ok()
    read = staged.select(
        *keep, "status", "cmid", F.when(ok, D.first_text(nodes, D.tag("h1", "h2"))).alias("_h"),
        F.when(ok, D.nonempty(D.cascade_text(nodes, [D.cls("activity-description"), D.id_is("intro")]))).alias("description"),
        *[F.when(ok, c).alias(k) for k, c in fields.items()], F.when(ok, found).otherwise(F.filter(found, lambda _: F.lit(False))).alias(items),
    )
    return read.select(
        *keep,
        F.coalesce(F.nullif("_h", F.lit("")), F.concat(F.lit(f"{label} "), F.col("cmid").cast("string"))).alias("title"),
        "description", *fields, items,
        (F.col("description").isNull() & (F.coalesce(F.size(items), F.lit(0)) <= 0)).alias("parser_degraded"),
    )


def extract_folder(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E12, one row per entry: pos, name, download_url, size."""
    out = D.exploded(extract_folder_page(df, keep), keep, F.col("entries"))
    return out.select(*keep, F.col("pos").cast("bigint").alias("pos"), "e.*")


# ------------------------------------------------------------------ E15

def _choice_options(nodes: Column) -> Column:
    """Options from ``.option, .choiceoption, input[type=radio][name=answer]``.

    Deliberate difference from the reference (which emits a wrapper and its
    radio twice): one row per option — a radio inside a matched wrapper is merged
    into the wrapper row and only sets ``selected``.  A wrapper's label is the
    first ``.choicetext, .text, label`` text (else its own text), votes from
    ``.count`` / ``.numvotes`` (0 -> null); a standalone radio takes its label via
    ``label[for=id]``, else the enclosing label, else a label in the enclosing div."""
    wrapper = D.cls("option") | D.cls("choiceoption")
    radio = D.tag("input") & D.attr_eq("type", "radio") & D.attr_eq("name", "answer")
    matches = F.filter(nodes, lambda n: wrapper(n) | (radio(n) & D.closest(nodes, n, wrapper).isNull()))

    def row(el):
        is_input = el["tag"] == "input"
        w_label_el = D.first(D.find(nodes, el, D.cls("choicetext") | D.cls("text") | D.tag("label")))
        w_label = normalize_text(F.coalesce(D.nonempty(_raw_text(nodes, w_label_el)), _raw_text(nodes, el)))
        votes_text = _text(nodes, D.first(D.find(nodes, el, D.cls("count") | D.cls("numvotes"))))
        votes = F.when(votes_text != "", F.when(js_parse_int(votes_text) != 0, js_parse_int(votes_text)))
        inner_checked = F.exists(D.find(nodes, el, radio), lambda r: D.attr(r, "checked").isNotNull())
        i_id = D.attr(el, "id")
        by_for = _text(nodes, D.first(F.filter(nodes, lambda l: (l["tag"] == "label") & (D.attr(l, "for") == i_id))))
        enclosing = F.coalesce(D.nonempty(_raw_text(nodes, D.closest(nodes, el, D.tag("label")))),
                               _raw_text(nodes, D.first(D.find(nodes, D.closest(nodes, el, D.tag("div")), D.tag("label")))))
        i_label = F.when(i_id.isNotNull(), by_for).otherwise(normalize_text(enclosing))
        return F.struct(
            F.when(is_input, i_label).otherwise(w_label).alias("label"),
            F.when(is_input, F.lit(None).cast("bigint")).otherwise(votes).alias("votes"),
            F.when(is_input, D.attr(el, "checked").isNotNull()).otherwise(inner_checked).alias("selected"),
        )

    return F.filter(F.transform(matches, row), lambda o: o["label"] != "")


def extract_choice(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E15, one row per page: title, description, opens and closes from header lines (last line of a
    label wins), the user's selection from ``.choiceresponse, .userresponse, .currentchoice``, the
    ``options`` and parser_degraded (neither a description nor an option, or another status than 2xx)."""
    nodes = _nodes()
    mine = D.cls("choiceresponse") | D.cls("userresponse") | D.cls("currentchoice")
    staged = df.select(*keep, "status", "cmid", "nodes", labelled_lines(header_lines(nodes), FEEDBACK_DATE_RE).alias("_kv"), _choice_options(nodes).alias("_options"))
    fields = {
        "opens": D.nonempty(last_labelled(F.col("_kv"), ("open",))),
        "closes": D.nonempty(last_labelled(F.col("_kv"), ("close",))),
        "user_selection": D.nonempty(D.first_text(nodes, mine)),
    }
    return _typed_page(staged, keep, "Choice", fields, "options", F.col("_options"))


def extract_choice_options(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E15, one row per option: pos, label, votes, selected."""
    out = D.exploded(extract_choice(df, keep), keep, F.col("options"), item="o")
    return out.select(*keep, F.col("pos").cast("bigint").alias("pos"), "o.*")


# ------------------------------------------------------------------ E16

FEEDBACK_DATE_RE = r"(?i)^(Open(?:s|ed)?|Close(?:s|d)?)" + WS + r"*:?" + WS + r"*(.+)$"
ALREADY_RE = r"(?i)already" + WS + r"+submitted|bereits" + WS + r"+ausgefüllt|bereits" + WS + r"+abgegeben"
COUNT_RE = r"(?i)(\d+)" + WS + r"+(?:responses?|Antworten)"


def extract_feedback(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """opens/closes from header lines (whole-word labels), ``already_submitted``
    from a phrase anywhere in the body text, ``submission_count`` from the last
    ``.feedbacksummary p, .generalbox p, #region-main p`` that states a number of
    responses; degraded iff nothing was found."""
    nodes = _nodes()
    staged = df.select(*keep, "status", "cmid", "nodes", header_lines(nodes).alias("_lines"))
    body_text = F.coalesce(D.text_of(nodes, D.root_of(nodes, "body")), F.lit(""))
    ps = D.select_within(nodes, D.cls("feedbacksummary") | D.cls("generalbox") | D.id_is("region-main"), D.tag("p"))
    counts = F.filter(F.transform(ps, lambda p: F.regexp_extract(_text(nodes, p), COUNT_RE, 1)), lambda x: x != "")
    found = staged.select(
        *keep, "status", "cmid",
        D.first_text(nodes, D.tag("h1", "h2")).alias("h"),
        D.nonempty(D.cascade_text(nodes, [D.cls("activity-description"), D.id_is("intro")])).alias("description"),
        D.nonempty(last_labelled(labelled_lines(F.col("_lines"), FEEDBACK_DATE_RE), ("open",))).alias("opens"),
        D.nonempty(last_labelled(labelled_lines(F.col("_lines"), FEEDBACK_DATE_RE), ("close",))).alias("closes"),
        F.when(body_text.rlike(ALREADY_RE), F.lit(True)).alias("already_submitted"),
        D.last(counts).try_cast("bigint").alias("submission_count"),
    )
    ok = _ok()
    c = F.col
    anything = (c("description").isNotNull() | c("opens").isNotNull() | c("closes").isNotNull()
                | c("already_submitted").isNotNull() | c("submission_count").isNotNull())
    return found.select(
        *keep,
        F.when(ok & (c("h") != ""), c("h")).otherwise(F.concat(F.lit("Feedback "), c("cmid").cast("string"))).alias("title"),
        *[F.when(ok, c(k)).alias(k) for k in ("description", "opens", "closes", "already_submitted", "submission_count")],
        (~ok | ~anything).alias("parser_degraded"),
    )


# ------------------------------------------------------------------ E14

LESSON_DATE_RE = r"(?i)^(Open(?:s|ed)?|Close(?:s|d)?|Available|Deadline)" + WS + r"*:?" + WS + r"*(.+)$"
LESSON_ATTEMPTS_RE = r"(?i)^(?:Number of|Anzahl" + WS + r"+der)" + WS + r"+Attempts?" + WS + r"*:" + WS + r"*(\d+)"
LESSON_SCORE_RE = r"(?i)^(?:Best|Bester)?" + WS + r"*(?:Score|Punktzahl)" + WS + r"*:" + WS + r"*(.+)$"


def extract_lesson(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Available/Opens and Deadline/Closes from header lines; attempts used and
    best score from ``.lesson-infosummary p, .generalbox p, #region-main p`` (a
    paragraph is consumed by the attempts rule first; the last match wins)."""
    nodes = _nodes()
    staged = df.select(*keep, "status", "cmid", "nodes", header_lines(nodes).alias("_lines"),
                       F.transform(D.select_within(nodes, D.cls("lesson-infosummary") | D.cls("generalbox") | D.id_is("region-main"),
                                                   D.tag("p")), lambda p: _text(nodes, p)).alias("_ps"))
    ps = F.col("_ps")
    attempts = D.last(F.filter(ps, lambda t: t.rlike(LESSON_ATTEMPTS_RE)))
    score = D.last(F.filter(ps, lambda t: ~t.rlike(LESSON_ATTEMPTS_RE) & t.rlike(LESSON_SCORE_RE)))
    found = staged.select(
        *keep, "status", "cmid",
        D.first_text(nodes, D.tag("h1", "h2")).alias("h"),
        D.nonempty(D.cascade_text(nodes, [D.cls("activity-description"), D.id_is("intro")])).alias("description"),
        D.nonempty(last_labelled(labelled_lines(F.col("_lines"), LESSON_DATE_RE), ("open", "avail"))).alias("opens"),
        D.nonempty(last_labelled(labelled_lines(F.col("_lines"), LESSON_DATE_RE), ("close", "dead"))).alias("closes"),
        F.regexp_extract(attempts, LESSON_ATTEMPTS_RE, 1).try_cast("bigint").alias("attempts_used"),
        D.nonempty(F.trim(F.regexp_extract(score, LESSON_SCORE_RE, 1))).alias("best_score"),
    )
    ok = _ok()
    c = F.col
    fields = ("description", "opens", "closes", "attempts_used", "best_score")
    anything = F.lit(False)
    for k in fields:
        anything = anything | c(k).isNotNull()
    return found.select(
        *keep,
        F.when(ok & (c("h") != ""), c("h")).otherwise(F.concat(F.lit("Lesson "), c("cmid").cast("string"))).alias("title"),
        *[F.when(ok, c(k)).alias(k) for k in fields],
        (~ok | ~anything).alias("parser_degraded"),
    )


# ------------------------------------------------------------------ E13

WORKSHOP_DATE_RE = r"(?i)^(Due|Open(?:s|ed)?|Close(?:s|d)?|Fälligkeit|Fällig)" + WS + r"*:?" + WS + r"*(.+)$"


def _phase_text(nodes: Column, state: str, inner: D.Sel, extra: D.Sel) -> Column:
    """First of ``.userplan .phase.<state> <inner>`` or ``<extra>`` in document order."""
    def in_plan(n):
        ph = D.closest(nodes, D.parent_of(nodes, n), D.cls("phase", state))
        return ph.isNotNull() & D.closest(nodes, D.parent_of(nodes, ph), D.cls("userplan")).isNotNull()

    return D.first_text(nodes, lambda n: (inner(n) & in_plan(n)) | extra(n))


def extract_workshop(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Opens, closes (Due and Fällig count as closes), the active phase
    (then the current phase), and submission status / grade from the status
    table by label *contains* (last row wins)."""
    nodes = _nodes()
    rows = _table_rows(nodes, D.cls("submissionstatustable") | D.cls("submissionsummarytable"))
    staged = df.select(*keep, "status", "cmid", "nodes", header_lines(nodes).alias("_lines"),
                       F.filter(rows, lambda r: (r["label"] != "") & (r["value"] != "")).alias("_rows"))
    r = F.col("_rows")
    active = _phase_text(nodes, "active", D.cls("phasename") | D.cls("title"), D.cls("phasebadge", "active"))
    current = _phase_text(nodes, "current", D.cls("phasename"), D.cls("phasecurrent"))
    found = staged.select(
        *keep, "status", "cmid",
        D.first_text(nodes, D.tag("h1", "h2")).alias("h"),
        D.nonempty(D.cascade_text(nodes, [D.cls("activity-description"), D.id_is("intro")])).alias("description"),
        D.nonempty(last_labelled(labelled_lines(F.col("_lines"), WORKSHOP_DATE_RE), ("open",))).alias("opens"),
        D.nonempty(last_labelled(labelled_lines(F.col("_lines"), WORKSHOP_DATE_RE), ("close", "fäll", "due"))).alias("closes"),
        F.coalesce(D.nonempty(active), D.nonempty(current)).alias("current_phase"),
        D.last(F.filter(r, lambda x: F.contains(x["label"], F.lit("submission")) | F.contains(x["label"], F.lit("abgabe"))))["value"]
        .alias("submission_status"),
        D.last(F.filter(r, lambda x: F.contains(x["label"], F.lit("grade")) | F.contains(x["label"], F.lit("note"))))["value"]
        .alias("grade"),
    )
    ok = _ok()
    c = F.col
    fields = ("description", "opens", "closes", "current_phase", "submission_status", "grade")
    anything = F.lit(False)
    for k in fields:
        anything = anything | c(k).isNotNull()
    return found.select(
        *keep,
        F.when(ok & (c("h") != ""), c("h")).otherwise(F.concat(F.lit("Workshop "), c("cmid").cast("string"))).alias("title"),
        *[F.when(ok, c(k)).alias(k) for k in fields],
        (~ok | ~anything).alias("parser_degraded"),
    )
