"""Render learning-platform pages from the driver tables, inside Spark.

The driver's ``pages`` table has no platform markup, so round-trip queries
build it: each renderer turns table rows into response rows (``page_key,
base_url, url, status, headers, body, kind, cmid, ...``), the extractor reads
them back, and the oracle computes the same values straight from the base
table.  Pages group a *bounded* number of rows (``key div N``), so no page
grows with the table.  All text is HTML-escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import conform_responses, read_table

BASE = "https://lms.example.com"
DATE_FMT = "d MMMM yyyy, HH:mm"          # Spark pattern
DATE_FMT_SQL = "%-d %B %Y, %H:%M"         # the same in strftime


def esc(x) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _s(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("string")


def page(title: Column, inner: Column) -> Column:
    return F.concat(
        F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), title,
        F.lit('</title></head><body><nav class="navbar"><a href="/my/">Dashboard</a></nav><div id="page">'),
        inner, F.lit('</div><footer>Footer</footer></body></html>'),
    )


def responses(df: DataFrame, *, key: Column, path: Column, body: Column, kind: str, cmid: Column | None = None,
              modtype: str | None = None, status: Column | None = None, headers: Column | None = None) -> DataFrame:
    return conform_responses(df.select(
        key.alias("page_key"),
        F.lit(BASE).alias("base_url"),
        F.concat(F.lit(BASE), path).alias("url"),
        (status if status is not None else F.lit(200)).alias("status"),
        (headers if headers is not None else F.create_map().cast("map<string,string>")).alias("headers"),
        body.alias("body"),
        F.lit(kind).alias("kind"),
        (cmid if cmid is not None else F.lit(None).cast("bigint")).alias("cmid"),
        F.lit(modtype).cast("string").alias("modtype"),
    ))


def dashboard_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboards of 50 suppliers each (per nation): tiles first (odd ids carry a
    ``title``), then a list repeating every course, plus a link without an id."""
    s = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", F.floor(F.col("s_suppkey") / 50).alias("bucket"))
    odd = (F.col("s_suppkey") % 2) == 1
    k = _s("s_suppkey")
    tile = F.concat(F.lit('<div class="card"><a class="tile" href="/course/view.php?id='), k, F.lit('"'),
                    F.when(odd, F.concat(F.lit(' title="'), esc("s_name"), F.lit('"'))).otherwise(F.lit("")),
                    F.lit(">"), F.when(odd, F.lit("Kurs")).otherwise(esc("s_name")), F.lit("</a></div>"))
    lst = F.concat(F.lit('<li><a href="/course/view.php?id='), k, F.lit('">'), esc("s_name"), F.lit(" (Liste)</a></li>"))
    g = s.groupBy("s_nationkey", "bucket").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", tile.alias("t"), lst.alias("l")))).alias("items"))
    inner = F.concat(
        F.lit('<h2>Meine Kurse</h2><div class="tiles">'), F.array_join(F.transform("items", lambda x: x["t"]), ""),
        F.lit('<a href="/course/view.php?id=abc">kaputt</a></div><ul class="courses">'),
        F.array_join(F.transform("items", lambda x: x["l"]), ""), F.lit("</ul>"),
    )
    key = F.concat(F.lit("dash-"), _s("s_nationkey"), F.lit("-"), _s("bucket"))
    return responses(g, key=key, path=F.lit("/my/"), body=page(F.lit("Dashboard"), inner), kind="dashboard")


def forum_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forum pages of 20 discussions each: a discussion is a conversation (title =
    first turn, starter = its role, last post = the last turn's role)."""
    c = read_table(spark, sf_dir, "conversations")
    d = c.groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("first_text"), F.min_by("role", "turn").alias("starter"),
        F.max_by("role", "turn").alias("last_role"), (F.count("*") - 1).alias("replies"),
    ).withColumn("bucket", F.floor(F.col("conv_id") / 20))
    k = _s("conv_id")
    row = F.concat(
        F.lit('<tr class="discussion" data-region="discussion-list-item" data-discussionid="'), k, F.lit('">'),
        F.lit('<th class="topic starter"><div class="p-3"><a href="/mod/forum/discuss.php?d='), k, F.lit('">'),
        esc("first_text"), F.lit("</a></div></th>"),
        F.lit('<td class="author"><div class="author-info"><div class="name">'), esc("starter"), F.lit("</div></div></td>"),
        F.lit('<td class="text-start"><div class="author-info"><div class="name">'), esc("last_role"), F.lit("</div></div></td>"),
        F.lit('<td><span class="label">Antworten</span> <span>'), _s("replies"), F.lit("</span></td></tr>"),
    )
    g = d.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("conv_id", row.alias("r")))).alias("items"))
    inner = F.concat(
        F.lit("<h1>Forum "), _s("bucket"), F.lit('</h1><div class="activity-description">Diskussionen '), _s("bucket"),
        F.lit('</div><table class="table discussion-list"><thead><tr><th>Thema</th><th>Gestartet</th><th>Letzter</th><th>Antworten</th></tr></thead><tbody>'),
        F.array_join(F.transform("items", lambda x: x["r"]), ""), F.lit("</tbody></table>"),
    )
    key = F.concat(F.lit("forum-"), _s("bucket"))
    return responses(g, key=key, path=F.concat(F.lit("/mod/forum/view.php?id="), _s("bucket")),
                     body=page(F.lit("Forum"), inner), kind="activity", cmid=F.col("bucket").cast("bigint"), modtype="forum")


def _date(col: Column) -> Column:
    return F.date_format(col, DATE_FMT)


def assign_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One assignment page per order: opened/due lines (German due label for
    status P), a status table with a repeated empty row and an unknown label."""
    o = read_table(spark, sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("Submitted for grading"))
              .when(F.col("o_orderstatus") == "O", F.lit("No submission")).otherwise(F.lit("Draft (not submitted)")))
    grading = F.when(F.col("o_orderstatus") == "F", F.lit("Graded")).otherwise(F.lit("Not graded"))
    due_label = F.when(F.col("o_orderstatus") == "P", F.lit("Fälligkeit:")).otherwise(F.lit("Due:"))
    due = _date(F.col("o_orderdate") + F.expr("INTERVAL 14 DAYS"))
    k = _s("o_orderkey")
    inner = F.concat(
        F.lit('<div id="page-header"><h1>Assignment '), k, F.lit("</h1></div>"),
        F.lit('<div class="activity-header"><div class="activity-dates"><div><strong>Opened:</strong> '), _date(F.col("o_orderdate")),
        F.lit("</div><div><strong>"), due_label, F.lit("</strong> "), due, F.lit("</div></div></div>"),
        F.lit('<div class="activity-description"><p>'), esc("o_orderpriority"), F.lit("</p></div>"),
        F.lit('<table class="generaltable submissionstatustable"><tbody>'),
        F.lit("<tr><th>Submission status</th><td>"), status, F.lit("</td></tr>"),
        F.lit("<tr><th>Grading status</th><td>"), grading, F.lit("</td></tr>"),
        F.lit("<tr><th>Grade</th><td>"), _s("o_custkey"), F.lit(" / 1500</td></tr>"),
        F.lit("<tr><th>Bonus</th><td>ignored</td></tr><tr><th>Submission status</th><td> </td></tr></tbody></table>"),
    )
    return responses(o, key=F.concat(F.lit("assign-"), k), path=F.concat(F.lit("/mod/assign/view.php?id="), k),
                     body=page(F.lit("Assignment"), inner), kind="activity", cmid=F.col("o_orderkey"), modtype="assign")


def quiz_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quiz page per order; its line items are the attempts (line status O =
    in progress), attempts allowed = custkey mod 13 + 1, closes 60 days after opening."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                       "l_quantity", "l_linestatus")
    k = _s("l_orderkey")
    row = F.concat(
        F.lit("<tr><td>"), _s("l_linenumber"), F.lit("</td><td>"),
        F.when(F.col("l_linestatus") == "O", F.lit("In progress")).otherwise(F.lit("Finished")),
        F.lit("</td><td>"), F.col("l_quantity").cast("int").cast("string"), F.lit(".00/50.00</td><td>"),
        (F.col("l_linenumber") * 10).cast("string"), F.lit('.00%</td><td><a href="/mod/quiz/review.php?attempt='),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("string"), F.lit("&amp;cmid="), k,
        F.lit('">Review</a></td></tr>'),
    )
    att = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("r")))).alias("items"))
    j = o.join(att, o.o_orderkey == att.l_orderkey, "left")
    ok_ = _s("o_orderkey")
    allowed = ((F.col("o_custkey") % 13) + 1).cast("string")
    rows = F.coalesce(F.array_join(F.transform("items", lambda x: x["r"]), ""), F.lit(""))
    inner = F.concat(
        F.lit("<h1>Quiz "), ok_, F.lit("</h1>"),
        F.lit('<div class="activity-header"><div class="activity-dates"><div><strong>Opened:</strong> '), _date(F.col("o_orderdate")),
        F.lit("</div><div><strong>Closes:</strong> "), _date(F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")), F.lit("</div></div></div>"),
        F.lit('<div class="box quizinfo"><p>Grading method: Highest grade</p><p>Attempts allowed: '), allowed, F.lit("</p></div>"),
        F.lit('<table class="generaltable quizattemptsummary"><thead><tr><th>Attempt</th><th>State</th><th>Marks</th><th>Grade</th><th>Review</th></tr></thead><tbody>'),
        rows, F.lit("</tbody></table>"),
    )
    return responses(j, key=F.concat(F.lit("quiz-"), ok_), path=F.concat(F.lit("/mod/quiz/view.php?id="), ok_),
                     body=page(F.lit("Quiz"), inner), kind="activity", cmid=F.col("o_orderkey"), modtype="quiz")


# ------------------------------------------------------------------ calendar pages from ``events``
# Modtype per event type (three types have one, 'view' and 'error' do not).
EVENT_MODTYPES = {"purchase": "assign", "signup": "quiz", "click": "forum"}
FEED_BLOCK = 50          # events per feed response (the platform's maximum)
PAGE_BLOCK = 1000        # event-id block per user page


def _modtype_col() -> Column:
    m = None
    for t, mt in EVENT_MODTYPES.items():
        m = F.when(F.col("event_type") == t, F.lit(mt)) if m is None else m.when(F.col("event_type") == t, F.lit(mt))
    return m


def events_with_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.dates import ntz_to_unix

    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return e.select("*", _modtype_col().alias("modtype"), ntz_to_unix("ts").alias("epoch"),
                    ntz_to_unix(F.date_trunc("day", "ts")).alias("day_epoch"))


def feed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed responses of 50 events each (``event_id div 50``); every 17th block
    (block mod 17 = 5) is an error envelope.  Events of type 'error' carry
    timestart 0, typed events an action URL, the others a top-level URL."""
    e = events_with_times(spark, sf_dir).withColumn("block", F.floor(F.col("event_id") / FEED_BLOCK))
    has_mod = F.col("modtype").isNotNull()
    ev = F.struct(
        F.col("event_id").alias("id"),
        F.concat(F.lit("Event "), _s("event_id")).alias("name"),
        F.col("event_type").alias("eventtype"),
        F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.col("epoch")).alias("timestart"),
        F.col("modtype").alias("modulename"),
        F.col("user_id").alias("instance"),
        F.struct(F.col("user_id").alias("id"), F.concat(F.lit("Course "), _s("user_id")).alias("fullname")).alias("course"),
        F.when(has_mod, F.struct(F.concat(F.lit("/mod/"), F.col("modtype"), F.lit("/view.php?id="), _s("event_id")).alias("url"))).alias("action"),
        F.when(~has_mod, F.concat(F.lit(BASE + "/calendar/view.php?view=day&time="), _s("epoch"))).alias("url"),
    )
    g = e.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("event_id", ev.alias("ev")))).alias("items"))
    good = F.to_json(F.array(F.struct(F.lit(False).alias("error"),
                                      F.struct(F.transform("items", lambda x: x["ev"]).alias("events")).alias("data"))))
    bad = F.lit('[{"error":true,"exception":{"message":"Invalid sesskey","errorcode":"invalidsesskey"}}]')
    body = F.when(F.col("block") % 17 == 5, bad).otherwise(good)
    return responses(g, key=F.concat(F.lit("feed-"), _s("block")), path=F.lit("/lib/ajax/service.php"), body=body,
                     kind="feed")


def _user_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_with_times(spark, sf_dir).withColumn("block", F.floor(F.col("event_id") / PAGE_BLOCK))


def month_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month views per (user, event-id block): day cells with event items.  Typed
    events have an anchor timestamp and a course link; 'view' relies on the day
    cell; 'error' has timestamp 0 and no component.  Users with id mod 10 = 3 get a
    drifted page: no calendar container and renamed day cells, so nothing is
    recognised and the page must come back as a parse error."""
    e = _user_pages(spark, sf_dir)
    m = F.col("modtype")
    href = F.when(m.isNotNull(), F.concat(F.lit("/mod/"), m, F.lit("/view.php?id="), _s("event_id"), F.lit("&course="), _s("user_id"))) \
        .otherwise(F.concat(F.lit("/calendar/view.php?view=day&id="), _s("event_id")))
    comp = F.when(m.isNotNull(), F.concat(F.lit(' data-event-component="mod_'), m, F.lit('"'))) \
        .when(F.col("event_type") == "view", F.lit(' data-event-component="user"')).otherwise(F.lit(""))
    ts_attr = F.when(m.isNotNull(), F.concat(F.lit(' data-timestamp="'), _s("epoch"), F.lit('"'))) \
        .when(F.col("event_type") == "error", F.lit(' data-timestamp="0"')).otherwise(F.lit(""))
    name = F.when(F.col("event_type") == "error", F.lit("")).otherwise(
        F.concat(F.lit('<span class="eventname">Event '), _s("event_id"), F.lit("</span>")))
    li = F.concat(
        F.lit('<li data-region="event-item"'), comp, F.lit(' data-event-eventtype="'), F.col("event_type"),
        F.lit('" data-event-id="'), _s("event_id"), F.lit('" data-course-id="'), _s("user_id"), F.lit('">'),
        F.lit('<a data-action="view-event" href="'), esc(href), F.lit('" title="'), F.col("event_type"), F.lit(" "),
        _s("event_id"), F.lit('"'), ts_attr, F.lit(">"), name, F.lit("</a></li>"),
    )
    e = e.withColumn("y", F.year("ts")).withColumn("mo", F.month("ts")).withColumn("d", F.dayofmonth("ts"))
    days = e.groupBy("user_id", "block", "day_epoch", "y", "mo", "d").agg(
        F.array_sort(F.collect_list(F.struct("event_id", li.alias("li")))).alias("items"))
    drift = (F.col("user_id") % 10) == 3
    region = F.when(drift, F.lit("calendar-cell")).otherwise(F.lit("day"))
    cell = F.concat(
        F.lit('<td class="day" data-region="'), region, F.lit('" data-day-timestamp="'), _s("day_epoch"),
        F.lit('" data-year="'), _s("y"), F.lit('" data-month="'), _s("mo"), F.lit('" data-day="'), _s("d"),
        F.lit('" aria-label="Tag '), _s("day_epoch"), F.lit('"><ul>'),
        F.array_join(F.transform("items", lambda x: x["li"]), ""), F.lit("</ul></td>"),
    )
    pages = days.groupBy("user_id", "block").agg(F.array_sort(F.collect_list(F.struct("day_epoch", cell.alias("c")))).alias("cells"))
    table = F.concat(F.lit('<table class="calendarmonth"><tbody><tr>'),
                     F.array_join(F.transform("cells", lambda x: x["c"]), ""), F.lit("</tr></tbody></table>"))
    drift = (F.col("user_id") % 10) == 3
    inner = F.concat(F.lit("<h2>Kalender</h2>"), F.when(drift, F.concat(F.lit('<div class="calendar-new">'), table, F.lit("</div>")))
                     .otherwise(F.concat(F.lit('<div class="calendarwrapper" data-courseid="1">'), table, F.lit("</div>"))))
    key = F.concat(F.lit("month-"), _s("user_id"), F.lit("-"), _s("block"))
    return responses(pages, key=key, path=F.lit("/calendar/view.php?view=month"), body=page(F.lit("Kalender"), inner),
                     kind="month")


def upcoming_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upcoming lists per (user, event-id block): typed events link to their
    activity and carry a timestamp element; the others only have a heading and
    an English display date (read in Europe/Berlin)."""
    e = _user_pages(spark, sf_dir)
    m = F.col("modtype")
    shown = F.date_format("ts", DATE_FMT)
    li = F.concat(
        F.lit('<li data-region="event-list-item">'),
        F.when(m.isNotNull(), F.concat(F.lit('<a href="/mod/'), m, F.lit("/view.php?id="), _s("event_id"), F.lit("&amp;course="),
                                       _s("user_id"), F.lit('">Event '), _s("event_id"), F.lit("</a>")))
        .otherwise(F.concat(F.lit("<h3>Event "), _s("event_id"), F.lit("</h3>"))),
        F.lit('<span class="date">'), shown, F.lit("</span>"),
        F.when(m.isNotNull(), F.concat(F.lit('<div data-timestamp="'), _s("epoch"), F.lit('"></div>'))).otherwise(F.lit("")),
        F.lit('<span class="coursename">Course '), _s("user_id"), F.lit("</span></li>"),
    )
    pages = e.groupBy("user_id", "block").agg(F.array_sort(F.collect_list(F.struct("event_id", li.alias("li")))).alias("items"))
    inner = F.concat(F.lit('<div data-region="event-list-content"><ul>'),
                     F.array_join(F.transform("items", lambda x: x["li"]), ""), F.lit("</ul></div>"))
    key = F.concat(F.lit("upcoming-"), _s("user_id"), F.lit("-"), _s("block"))
    return responses(pages, key=key, path=F.lit("/calendar/view.php?view=upcoming"), body=page(F.lit("Termine"), inner),
                     kind="upcoming")


SEARCH_PAGE = 7  # results per search page


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course-search result pages of 7 suppliers (``s_suppkey div 7``): boxes with a
    category (the nation) and a long summary; the first box of each page repeats
    at the end (first wins); the pager numbers the next page only when the page
    is full."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    j = s.join(n, "s_nationkey", "left").withColumn("bucket", F.floor(F.col("s_suppkey") / SEARCH_PAGE))
    k = _s("s_suppkey")
    summary = F.repeat(F.concat(F.lit("Kurs "), F.col("s_name"), F.lit(" in "), F.coalesce(F.col("n_name"), F.lit("")), F.lit(". ")), 12)
    box = F.concat(
        F.lit('<div class="coursebox clearfix" data-courseid="'), k, F.lit('"><div class="info"><h3 class="coursename">'),
        F.lit('<a class="aalink" href="/course/view.php?id='), k, F.lit('">'), esc("s_name"), F.lit("</a></h3></div>"),
        F.lit('<div class="content"><div class="summary"><p>'), esc(summary), F.lit('</p></div>'),
        F.lit('<div class="coursecat">Kategorie: <a href="/course/index.php?categoryid='), _s("s_nationkey"), F.lit('">'),
        esc(F.coalesce(F.col("n_name"), F.lit(""))), F.lit("</a></div></div></div>"),
    )
    g = j.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", box.alias("b")))).alias("items"))
    page_no = (F.col("bucket") + 1).cast("string")
    full = F.size("items") == SEARCH_PAGE
    pager = F.concat(
        F.lit('<nav><ul class="pagination">'),
        F.when(F.col("bucket") > 0, F.concat(F.lit('<li class="page-item"><a class="page-link" href="#">'),
                                               _s("bucket"), F.lit("</a></li>"))).otherwise(F.lit("")),
        F.lit('<li class="page-item active" data-page-number="'), page_no, F.lit('"><a class="page-link" href="#">'), page_no,
        F.lit("</a></li>"),
        F.when(full, F.concat(F.lit('<li class="page-item"><a class="page-link" href="#">'), (F.col("bucket") + 2).cast("string"),
                              F.lit("</a></li>"))).otherwise(F.lit("")),
        F.lit('<li class="page-item"><a class="page-link" href="#">»</a></li></ul></nav>'),
    )
    inner = F.concat(
        F.lit('<div id="region-main"><h2>Suchergebnisse</h2><div class="courses">'),
        F.array_join(F.transform("items", lambda x: x["b"]), ""), F.get(F.col("items"), 0)["b"],
        F.lit("</div>"), pager, F.lit("</div>"),
    )
    return responses(g, key=F.concat(F.lit("search-"), _s("bucket")),
                     path=F.concat(F.lit("/course/search.php?search=kurs&perpage=7&page="), _s("bucket")),
                     body=page(F.lit("Suche"), inner), kind="search")


def triage_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored response per order: status F -> a normal 200 page with session
    cookies; O -> 200 serving the login form; P -> 303 to the login page.  Every
    URL carries a sesskey to be masked."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    k = _s("o_orderkey")
    st = F.col("o_orderstatus")
    status = F.when(st == "P", F.lit(303)).otherwise(F.lit(200))
    body = (F.when(st == "F", F.concat(F.lit("<html><body><h1>Order "), k, F.lit("</h1></body></html>")))
            .when(st == "O", F.lit('<html><body><form method="post" action="' + BASE + '/login/index.php" id="login">'
                                   '<input name="username"></form></body></html>'))
            .otherwise(F.lit("")))
    headers = (F.when(st == "F", F.create_map(F.lit("content-type"), F.lit("text/html; charset=utf-8"), F.lit("set-cookie"),
                                              F.concat(F.lit("MoodleSession=s"), k, F.lit("; path=/; secure, MOODLEID1_=%25"), k,
                                                       F.lit("; expires=Wed, 01 Jan 2030 00:00:00 GMT; path=/"))))
               .when(st == "O", F.create_map(F.lit("content-type"), F.lit("text/html")))
               .otherwise(F.create_map(F.lit("location"), F.lit(BASE + "/login/index.php"))))
    return responses(o, key=F.concat(F.lit("resp-"), k),
                     path=F.concat(F.lit("/mod/page/view.php?id="), k, F.lit("&sesskey=abc"), k),
                     body=body, kind="page", status=status, headers=headers.cast("map<string,string>"))


# Modtype per part type word (ECONOMY parts become labels, which are skipped).
PART_MODTYPES = {"STANDARD": "assign", "SMALL": "quiz", "MEDIUM": "forum", "LARGE": "resource", "ECONOMY": "label",
                 "PROMO": "url"}


def course_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course pages of 40 parts (``p_partkey div 40``), sections by ``p_size div 10``;
    names via data-activityname (even keys) or .instancename, links a.aalink
    (key mod 3 = 0), a.stretched-link (= 1) or none; plus a section without a list."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    word = F.split(F.col("p_type"), " ")[0]
    mt = None
    for w, m in PART_MODTYPES.items():
        mt = F.when(word == w, F.lit(m)) if mt is None else mt.when(word == w, F.lit(m))
    p = p.select("*", mt.alias("mt"), F.floor(F.col("p_partkey") / 40).alias("course"), F.floor(F.col("p_size") / 10).alias("sec"))
    k = _s("p_partkey")
    even = (F.col("p_partkey") % 2) == 0
    name = F.when(even, F.concat(F.lit('<div data-activityname="'), esc("p_name"), F.lit('"><span class="instancename">'),
                                 esc("p_name"), F.lit(" Extra</span></div>"))) \
        .otherwise(F.concat(F.lit('<span class="instancename">'), esc("p_name"), F.lit("</span>")))
    r3 = F.col("p_partkey") % 3
    link = F.when(r3 == 0, F.concat(F.lit('<a class="aalink" href="/mod/'), F.col("mt"), F.lit("/view.php?id="), k, F.lit('&amp;forceview=1">go</a>'))) \
        .when(r3 == 1, F.concat(F.lit('<a class="stretched-link" href="/mod/'), F.col("mt"), F.lit("/view.php?id="), k, F.lit('">go</a>'))) \
        .otherwise(F.lit(""))
    item = F.concat(F.lit('<li class="activity activity-wrapper modtype_'), F.col("mt"), F.lit('" data-for="cmitem" data-id="'), k,
                    F.lit('"><div class="activity-item">'), name, link, F.lit("</div></li>"))
    secs = p.groupBy("course", "sec").agg(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("i")))).alias("items"))
    head = F.when(F.col("sec") % 2 == 0, F.concat(F.lit('<li class="section course-section" data-sectionname="Woche '), _s("sec"), F.lit('">'))) \
        .otherwise(F.concat(F.lit('<li class="section course-section"><h3 class="sectionname">Abschnitt '), _s("sec"), F.lit("</h3>")))
    sec_html = F.concat(head, F.lit('<ul class="section-cmlist" data-for="cmlist">'), F.array_join(F.transform("items", lambda x: x["i"]), ""),
                        F.lit("</ul></li>"))
    pages = secs.groupBy("course").agg(F.array_sort(F.collect_list(F.struct("sec", sec_html.alias("h")))).alias("secs"))
    inner = F.concat(F.lit("<h1>Kurs "), _s("course"), F.lit('</h1><ul class="topics">'),
                     F.lit('<li class="course-section" data-sectionname="Leer"><p>nichts</p></li>'),
                     F.array_join(F.transform("secs", lambda x: x["h"]), ""), F.lit("</ul>"))
    out = responses(pages, key=F.concat(F.lit("course-"), _s("course")), path=F.concat(F.lit("/course/view.php?id="), _s("course")),
                    body=page(F.concat(F.lit("Kurs "), _s("course"), F.lit(": Übersicht")), inner), kind="course")
    return out.withColumn("course_id", F.regexp_extract("page_key", r"(\d+)$", 1).cast("bigint"))


def folder_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder pages of 25 parts (``p_partkey div 25``): a file tree of
    pluginfile links (key mod 4 = 0 without a filename span or text, so the name
    comes from the URL), the first file repeated, and a stray link outside the tree."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    p = p.withColumn("folder", F.floor(F.col("p_partkey") / 25))
    href = F.concat(F.lit("/pluginfile.php/"), _s("folder"), F.lit("/mod_folder/content/0/"),
                    F.replace(F.col("p_name"), F.lit(" "), F.lit("%20")), F.lit(".pdf?forcedownload=1"))
    label = F.when(F.col("p_partkey") % 4 == 0, F.lit("")).otherwise(
        F.concat(F.lit('<span class="fp-filename">'), esc("p_name"), F.lit(".pdf</span>")))
    li = F.concat(F.lit('<li><span class="fp-filename-icon"><a href="'), esc(href), F.lit('">'), label, F.lit("</a></span> "),
                  F.lit('<span class="fp-size">'), _s("p_size"), F.lit(" KB</span></li>"))
    g = p.groupBy("folder").agg(F.array_sort(F.collect_list(F.struct("p_partkey", li.alias("li")))).alias("items"))
    inner = F.concat(
        F.lit('<div id="region-main"><h2>Ordner '), _s("folder"), F.lit('</h2><div class="foldertree"><ul>'),
        F.array_join(F.transform("items", lambda x: x["li"]), ""), F.get(F.col("items"), 0)["li"],
        F.lit('</ul></div><p><a href="/pluginfile.php/0/other/x.pdf">Anderes</a></p></div>'),
    )
    return responses(g, key=F.concat(F.lit("folder-"), _s("folder")), path=F.concat(F.lit("/mod/folder/view.php?id="), _s("folder")),
                     body=page(F.lit("Ordner"), inner), kind="activity", cmid=F.col("folder").cast("bigint"), modtype="folder")


def choice_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One choice page per region: each nation is a wrapped option (label, radio
    checked when n_nationkey mod 5 = 2, vote count 3·key) plus one standalone
    'Enthaltung' radio labelled through ``for``."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    k = _s("n_nationkey")
    opt = F.concat(
        F.lit('<div class="option"><label for="choice_'), k, F.lit('"><span class="text">'), esc("n_name"),
        F.lit('</span></label><input type="radio" name="answer" id="choice_'), k, F.lit('" value="'), k, F.lit('"'),
        F.when(F.col("n_nationkey") % 5 == 2, F.lit(" checked")).otherwise(F.lit("")), F.lit('><span class="count">'),
        (F.col("n_nationkey") * 3).cast("string"), F.lit("</span></div>"),
    )
    g = n.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", opt.alias("o")))).alias("items"))
    r = _s("n_regionkey")
    inner = F.concat(
        F.lit("<h2>Abstimmung "), r, F.lit('</h2><form><div class="choices">'), F.array_join(F.transform("items", lambda x: x["o"]), ""),
        F.lit('<div class="extra"><input type="radio" name="answer" id="extra_'), r, F.lit('"><label for="extra_'), r,
        F.lit('">Enthaltung</label></div></div></form>'),
    )
    return responses(g, key=F.concat(F.lit("choice-"), r), path=F.concat(F.lit("/mod/choice/view.php?id="), r),
                     body=page(F.lit("Abstimmung"), inner), kind="activity", cmid=F.col("n_regionkey").cast("bigint"), modtype="choice")
