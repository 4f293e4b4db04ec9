"""Round-trip queries: platform pages rendered from driver tables, extracted back,
and checked against SQL on the base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dom import exploded
from ..operators.flat import located_html
from ..operators.lms import QUIZ_FIELDS, extract_assign, extract_courses, extract_forum, extract_quiz, forum_threads, quiz_parts
from ..operators.shred import shred_html
from . import render as R
from .common import spread, sql_norm

B = R.BASE


def _shred(df: DataFrame) -> DataFrame:
    cols = ["page_key", "base_url", "url", "status", "headers", "cmid", "modtype", "body"]
    return shred_html(df.select(*cols), keep_html=False, partitions=spread(df.sparkSession, df))


# ------------------------------------------------------------------ E1 / W1
def q_dashboard_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + W1: courses on rendered dashboards, first link per id wins."""
    return extract_courses(_shred(R.dashboard_pages(spark, sf_dir)))


SQL_DASHBOARD_COURSES = f"""
SELECT 'dash-' || s_nationkey || '-' || (s_suppkey // 50) AS page_key,
       (row_number() OVER (PARTITION BY s_nationkey, s_suppkey // 50 ORDER BY s_suppkey) - 1)::BIGINT AS pos,
       s_suppkey AS course_id, {sql_norm('s_name')} AS name, '{B}/course/view.php?id=' || s_suppkey AS url
FROM supplier
"""


# ------------------------------------------------------------------ E7
def q_forum_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every discussion row of every rendered forum page."""
    return forum_threads(_shred(R.forum_pages(spark, sf_dir)))


_CONV = f"""
SELECT conv_id, conv_id // 20 AS bucket,
       {sql_norm('arg_min(text, turn)')} AS t, arg_min(role, turn) AS starter, arg_max(role, turn) AS last_role,
       count(*) - 1 AS replies
FROM conversations GROUP BY conv_id
"""
SQL_FORUM_THREADS = f"""
SELECT 'forum-' || bucket AS page_key,
       (row_number() OVER (PARTITION BY bucket ORDER BY conv_id) - 1)::BIGINT AS pos,
       conv_id AS discussion_id,
       CASE WHEN t = '' THEN '(ohne Titel)' ELSE t END AS title,
       starter AS author, last_role AS last_post, replies::BIGINT AS replies,
       '{B}/mod/forum/discuss.php?d=' || conv_id AS url
FROM ({_CONV})
"""


def q_forum_paging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 + A1: page 2 of every forum (limit 5, offset 5): ids, counts, has_more."""
    f = extract_forum(_shred(R.forum_pages(spark, sf_dir)), limit=5, offset=5)
    return f.select(
        "page_key", "title",
        F.array_join(F.transform("discussions", lambda d: d["discussion_id"].cast("string")), ",").alias("ids"),
        F.size("discussions").cast("bigint").alias("returned"), "total_on_page", "has_more", "parser_degraded",
    )


SQL_FORUM_PAGING = f"""
WITH c AS (SELECT conv_id, bucket, row_number() OVER (PARTITION BY bucket ORDER BY conv_id) AS rn FROM ({_CONV})),
g AS (SELECT bucket, count(*) AS total,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE rn BETWEEN 6 AND 10), '') AS ids
      FROM c GROUP BY bucket)
SELECT 'forum-' || bucket AS page_key, 'Forum ' || bucket AS title, ids,
       least(5, greatest(0, total - 5))::BIGINT AS returned, total::BIGINT AS total_on_page,
       5 + least(5, greatest(0, total - 5)) < total AS has_more, total = 0 AS parser_degraded
FROM g
"""


# ------------------------------------------------------------------ E8
def q_assign_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, status-table fields and description of every rendered assignment."""
    a = extract_assign(_shred(R.assign_pages(spark, sf_dir)))
    return a.select("page_key", "title", "description", "deadline", "opens", "closes", "submission_status",
                    "grading_status", "grade", "time_remaining", "parser_degraded")


SQL_ASSIGN_STATUS = f"""
SELECT 'assign-' || o_orderkey AS page_key, 'Assignment ' || o_orderkey AS title,
       {sql_norm('o_orderpriority')} AS description,
       strftime(o_orderdate + INTERVAL 14 DAY, '{R.DATE_FMT_SQL}') AS deadline,
       strftime(o_orderdate, '{R.DATE_FMT_SQL}') AS opens, NULL::VARCHAR AS closes,
       CASE o_orderstatus WHEN 'F' THEN 'Submitted for grading' WHEN 'O' THEN 'No submission' ELSE 'Draft (not submitted)' END AS submission_status,
       CASE WHEN o_orderstatus = 'F' THEN 'Graded' ELSE 'Not graded' END AS grading_status,
       o_custkey || ' / 1500' AS grade, NULL::VARCHAR AS time_remaining, false AS parser_degraded
FROM orders
"""

# ------------------------------------------------------------------ E9 / E9b / A4 / P7
QUIZ_AS_OF = 896659200  # 1998-06-01T00:00:00Z


def _quiz(spark, sf_dir):
    pages = R.quiz_pages(spark, sf_dir).select("page_key", "base_url", "status", "cmid", "body")
    return extract_quiz(located_html(pages, quiz_parts, QUIZ_FIELDS, partitions=spread(spark, pages)), as_of=QUIZ_AS_OF, tz="Europe/Berlin")


def q_quiz_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 + A4 + P7: dates, info box, attempts used/remaining and the status at a fixed as_of."""
    return _quiz(spark, sf_dir).select("page_key", "opens", "closes", "grading_method", "attempts_allowed",
                                       "attempts_used", "attempts_remaining", "quiz_status", "parser_degraded")


SQL_QUIZ_STATUS = f"""
WITH a AS (SELECT l_orderkey, count(*) AS used, bool_or(l_linestatus = 'O') AS any_progress,
                  bool_or(l_linestatus = 'F') AS any_finished FROM lineitem GROUP BY l_orderkey),
q AS (SELECT o.*, coalesce(a.used, 0) AS used, coalesce(a.any_progress, false) AS any_progress,
             coalesce(a.any_finished, false) AS any_finished, (o_custkey % 13) + 1 AS allowed,
             epoch(timezone('Europe/Berlin', o_orderdate)) AS open_ts,
             epoch(timezone('Europe/Berlin', o_orderdate + INTERVAL 60 DAY)) AS close_ts
      FROM orders o LEFT JOIN a ON a.l_orderkey = o.o_orderkey)
SELECT 'quiz-' || o_orderkey AS page_key,
       strftime(o_orderdate, '{R.DATE_FMT_SQL}') AS opens,
       strftime(o_orderdate + INTERVAL 60 DAY, '{R.DATE_FMT_SQL}') AS closes,
       'Highest grade' AS grading_method, allowed::VARCHAR AS attempts_allowed, used::BIGINT AS attempts_used,
       CASE WHEN used > 0 THEN greatest(0, allowed - used) END::BIGINT AS attempts_remaining,
       CASE WHEN open_ts > {QUIZ_AS_OF} THEN 'not_open' WHEN close_ts < {QUIZ_AS_OF} THEN 'closed'
            WHEN any_progress THEN 'in_progress' WHEN any_finished THEN 'submitted' WHEN used > 0 THEN 'submitted'
            ELSE 'open' END AS quiz_status,
       false AS parser_degraded
FROM q
"""


def q_quiz_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9b + W5: attempt rows (all of a quiz) with state, marks, grade and review link."""
    q = exploded(_quiz(spark, sf_dir), ["page_key"], F.col("attempts"), item="a")
    return q.select("page_key", F.col("pos").cast("bigint").alias("pos"), "a.*")


SQL_QUIZ_ATTEMPTS = f"""
SELECT 'quiz-' || l_orderkey AS page_key, (rn - 1)::BIGINT AS pos, l_linenumber::BIGINT AS attempt_number,
       CASE WHEN l_linestatus = 'O' THEN 'In progress' ELSE 'Finished' END AS state,
       l_quantity::INT || '.00/50.00' AS marks, (l_linenumber * 10) || '.00%' AS grade,
       '{B}/mod/quiz/review.php?attempt=' || (l_orderkey * 100 + l_linenumber) || '&cmid=' || l_orderkey AS review_url
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
"""


QUERIES = {
    "dashboard_courses": q_dashboard_courses,
    "forum_threads": q_forum_threads,
    "forum_paging": q_forum_paging,
    "assign_status": q_assign_status,
    "quiz_status": q_quiz_status,
    "quiz_attempts": q_quiz_attempts,
}
ORACLES = {
    "dashboard_courses": SQL_DASHBOARD_COURSES,
    "forum_threads": SQL_FORUM_THREADS,
    "forum_paging": SQL_FORUM_PAGING,
    "assign_status": SQL_ASSIGN_STATUS,
    "quiz_status": SQL_QUIZ_STATUS,
    "quiz_attempts": SQL_QUIZ_ATTEMPTS,
}


# ------------------------------------------------------------------ S3 / E19d
from ..operators.events import extract_month, read_event_feed, timeline_source, upcoming_items  # noqa: E402
from ..operators.events import EVENT_FIELDS  # noqa: E402


def q_feed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + E19d: every event of every rendered feed, or one error row per bad envelope."""
    return read_event_feed(R.feed_pages(spark, sf_dir).select("page_key", "base_url", "body"))


_EV = """
SELECT event_id, user_id, event_type, ts,
  CASE event_type WHEN 'purchase' THEN 'assign' WHEN 'signup' THEN 'quiz' WHEN 'click' THEN 'forum' END AS modtype,
  floor(epoch(ts))::BIGINT AS epoch, floor(epoch(date_trunc('day', ts)))::BIGINT AS day_epoch
FROM events
"""
_ISO = "strftime(to_timestamp({x}), '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"

SQL_FEED_EVENTS = f"""
WITH e AS (SELECT *, event_id // 50 AS block FROM ({_EV})),
good AS (
  SELECT 'feed-' || block AS page_key, (row_number() OVER (PARTITION BY block ORDER BY event_id) - 1)::BIGINT AS pos,
    'Event ' || event_id AS title, nullif(user_id, 0) AS course_id, 'Course ' || user_id AS course_name, modtype,
    event_type, CASE WHEN modtype IS NOT NULL THEN nullif(event_id, 0) END AS cmid, nullif(event_id, 0) AS event_id,
    CASE WHEN event_type <> 'error' AND epoch > 0 THEN {_ISO.format(x='epoch')} END AS due_at,
    CASE WHEN event_type <> 'error' AND epoch > 0 THEN epoch END AS due_at_unix,
    CASE WHEN modtype IS NOT NULL THEN '{B}/mod/' || modtype || '/view.php?id=' || event_id
         ELSE '{B}/calendar/view.php?view=day&time=' || epoch END AS url,
    NULL::VARCHAR AS error_code, NULL::VARCHAR AS message
  FROM e WHERE block % 17 <> 5),
bad AS (
  SELECT DISTINCT 'feed-' || block AS page_key, NULL::BIGINT AS pos, NULL::VARCHAR AS title, NULL::BIGINT AS course_id,
    NULL::VARCHAR AS course_name, NULL::VARCHAR AS modtype, NULL::VARCHAR AS event_type, NULL::BIGINT AS cmid,
    NULL::BIGINT AS event_id, NULL::VARCHAR AS due_at, NULL::BIGINT AS due_at_unix, NULL::VARCHAR AS url,
    'ajax_error' AS error_code, 'invalidsesskey' AS message
  FROM e WHERE block % 17 = 5)
SELECT * FROM good UNION ALL SELECT * FROM bad
"""


# ------------------------------------------------------------------ E20 / F10
def q_events_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E20 + F10: events of every rendered month view; drifted pages give a parse-error row."""
    pages = _shred(R.month_pages(spark, sf_dir))
    return extract_month(pages)


SQL_EVENTS_MONTH = f"""
WITH e AS (SELECT *, event_id // 1000 AS block FROM ({_EV})),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id, block ORDER BY day_epoch, event_id) - 1 AS rn FROM e),
good AS (
  SELECT 'month-' || user_id || '-' || block AS page_key, rn::BIGINT AS pos,
    CASE WHEN event_type = 'error' THEN 'error ' || event_id ELSE 'Event ' || event_id END AS title,
    nullif(user_id, 0) AS course_id, 'Tag ' || day_epoch AS course_name,
    CASE WHEN modtype IS NOT NULL THEN modtype WHEN event_type = 'view' THEN 'user' END AS modtype,
    event_type, nullif(event_id, 0) AS cmid, nullif(event_id, 0) AS event_id,
    {_ISO.format(x="CASE WHEN modtype IS NOT NULL AND epoch > 0 THEN epoch ELSE day_epoch END")} AS due_at,
    CASE WHEN modtype IS NOT NULL AND epoch > 0 THEN epoch ELSE day_epoch END AS due_at_unix,
    CASE WHEN modtype IS NOT NULL THEN '{B}/mod/' || modtype || '/view.php?id=' || event_id || '&course=' || user_id
         ELSE '{B}/calendar/view.php?view=day&id=' || event_id END AS url,
    NULL::VARCHAR AS error_code
  FROM o WHERE user_id % 10 <> 3),
bad AS (
  SELECT DISTINCT 'month-' || user_id || '-' || block AS page_key, NULL::BIGINT AS pos, NULL::VARCHAR AS title,
    NULL::BIGINT AS course_id, NULL::VARCHAR AS course_name, NULL::VARCHAR AS modtype, NULL::VARCHAR AS event_type,
    NULL::BIGINT AS cmid, NULL::BIGINT AS event_id, NULL::VARCHAR AS due_at, NULL::BIGINT AS due_at_unix,
    NULL::VARCHAR AS url, 'parse_error' AS error_code
  FROM e WHERE user_id % 10 = 3)
SELECT * FROM good UNION ALL SELECT * FROM bad
"""


# ------------------------------------------------------------------ E19a / E19e
def q_events_upcoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E19a + E19e: upcoming lists (first non-empty HTML source, else the feed)."""
    pages = _shred(R.upcoming_pages(spark, sf_dir))
    return timeline_source(pages, tz="Europe/Berlin")


SQL_EVENTS_UPCOMING = f"""
WITH e AS (SELECT *, event_id // 1000 AS block,
                  floor(epoch(timezone('Europe/Berlin', date_trunc('minute', ts))))::BIGINT AS shown_epoch FROM ({_EV}))
SELECT 'upcoming-' || user_id || '-' || block AS page_key, 'html' AS source,
  (row_number() OVER (PARTITION BY user_id, block ORDER BY event_id) - 1)::BIGINT AS pos,
  'Event ' || event_id AS title,
  CASE WHEN modtype IS NOT NULL THEN nullif(user_id, 0) END AS course_id, 'Course ' || user_id AS course_name,
  modtype, NULL::VARCHAR AS event_type, CASE WHEN modtype IS NOT NULL THEN nullif(event_id, 0) END AS cmid,
  NULL::BIGINT AS event_id,
  CASE WHEN modtype IS NOT NULL AND epoch > 0 THEN {_ISO.format(x='epoch')} ELSE strftime(ts, '{R.DATE_FMT_SQL}') END AS due_at,
  CASE WHEN modtype IS NOT NULL AND epoch > 0 THEN epoch ELSE shown_epoch END AS due_at_unix,
  CASE WHEN modtype IS NOT NULL THEN '{B}/mod/' || modtype || '/view.php?id=' || event_id || '&course=' || user_id END AS url
FROM e
"""

QUERIES.update({"feed_events": q_feed_events, "events_month": q_events_month, "events_upcoming": q_events_upcoming})
ORACLES.update({"feed_events": SQL_FEED_EVENTS, "events_month": SQL_EVENTS_MONTH, "events_upcoming": SQL_EVENTS_UPCOMING})


# ------------------------------------------------------------------ E3 / E3b / E3c
from ..operators.lms import extract_search_results, search_has_more, search_page_state  # noqa: E402
from .common import WS  # noqa: E402


def q_search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + W1 + F3: course boxes of rendered search pages (repeated box dropped)."""
    return extract_search_results(_shred(R.search_pages(spark, sf_dir)))


_SUMMARY = sql_norm("repeat('Kurs ' || s_name || ' in ' || coalesce(n_name, '') || '. ', 12)")
SQL_SEARCH_RESULTS = f"""
WITH j AS (SELECT s.*, n.n_name, {_SUMMARY} AS t, s_suppkey // 7 AS bucket
           FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey),
c AS (SELECT *, left(t, 300) AS cut, regexp_extract(left(t, 300), '(?s)^(.+) [^ ]*$', 1) AS bs FROM j)
SELECT 'search-' || bucket AS page_key, (row_number() OVER (PARTITION BY bucket ORDER BY s_suppkey) - 1)::BIGINT AS pos,
  s_suppkey AS course_id, {sql_norm('s_name')} AS fullname, nullif({sql_norm('n_name')}, '') AS category,
  CASE WHEN t = '' THEN NULL WHEN length(t) <= 300 THEN t ELSE rtrim(CASE WHEN bs = '' THEN cut ELSE bs END) || '…' END AS summary_snippet,
  '{B}/course/view.php?id=' || s_suppkey AS url, '{B}/enrol/index.php?id=' || s_suppkey AS enrol_url
FROM c
"""


def q_search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3b + E3c: per search page, has_more from the pager and the page state."""
    sh = _shred(R.search_pages(spark, sf_dir))
    n = F.col("nodes")
    st = search_page_state(n)
    return sh.select("page_key", search_has_more(n).alias("has_more"), st["has_region_main"].alias("has_region_main"),
                     st["has_no_results_marker"].alias("has_no_results_marker"),
                     st["is_valid_empty_state"].alias("is_valid_empty_state"))


SQL_SEARCH_PAGES = """
SELECT 'search-' || (s_suppkey // 7) AS page_key, count(*) = 7 AS has_more, true AS has_region_main,
       false AS has_no_results_marker, false AS is_valid_empty_state
FROM supplier GROUP BY s_suppkey // 7
"""

QUERIES.update({"search_results": q_search_results, "search_pages": q_search_pages})
ORACLES.update({"search_results": SQL_SEARCH_RESULTS, "search_pages": SQL_SEARCH_PAGES})


# ------------------------------------------------------------------ Q5
from ..operators.events import month_anchors  # noqa: E402
from ..operators.quality import attr_profile  # noqa: E402


def q_attr_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: data-attribute profile of every event anchor on rendered month views."""
    return attr_profile(_shred(R.month_pages(spark, sf_dir)), month_anchors)


SQL_ATTR_PROFILE = f"""
WITH e AS (SELECT *, event_id // 1000 AS block FROM ({_EV})),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id, block ORDER BY day_epoch, event_id) - 1 AS rn FROM e)
SELECT 'month-' || user_id || '-' || block AS page_key, rn::BIGINT AS pos,
  CASE WHEN event_type = 'view' THEN '["data-action"]' ELSE '["data-action","data-timestamp"]' END AS anchor_data_attrs,
  CASE WHEN event_type = 'error' THEN '["data-course-id","data-event-eventtype","data-event-id","data-region"]'
       ELSE '["data-course-id","data-event-component","data-event-eventtype","data-event-id","data-region"]' END AS list_item_data_attrs,
  '["data-day","data-day-timestamp","data-month","data-region","data-year"]' AS table_cell_data_attrs,
  true AS has_td_day_timestamp
FROM o WHERE user_id % 10 <> 3
"""

QUERIES["attr_profile"] = q_attr_profile
ORACLES["attr_profile"] = SQL_ATTR_PROFILE


# ------------------------------------------------------------------ P6 / P8 / Q7 / A6
from ..operators.triage import capture_report, triage_counts  # noqa: E402


def q_response_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7 + P6 + P8: capture report of every stored response."""
    return capture_report(R.triage_responses(spark, sf_dir))


SQL_RESPONSE_TRIAGE = f"""
SELECT 'resp-' || o_orderkey AS page_key, CASE WHEN o_orderstatus = 'P' THEN 303 ELSE 200 END AS http_status,
  '{B}/mod/page/view.php?id=' || o_orderkey || '&sesskey=REDACTED' AS url,
  CASE o_orderstatus WHEN 'F' THEN 'text/html; charset=utf-8' WHEN 'O' THEN 'text/html' END AS content_type,
  CASE o_orderstatus WHEN 'F' THEN length('<html><body><h1>Order ' || o_orderkey || '</h1></body></html>')
       WHEN 'O' THEN length('<html><body><form method="post" action="{B}/login/index.php" id="login"><input name="username"></form></body></html>')
       ELSE 0 END::BIGINT AS body_length,
  CASE WHEN o_orderstatus = 'F' THEN 'MOODLEID1_,MoodleSession' ELSE '' END AS set_cookie_names,
  o_orderstatus = 'P' AS redirect_status, o_orderstatus <> 'P' AS html_content_type, o_orderstatus = 'O' AS login_form,
  CASE WHEN o_orderstatus = 'P' THEN '3xx' ELSE '2xx' END AS status_class, o_orderstatus IN ('O', 'P') AS login
FROM orders
"""


def q_triage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses per status class and login outcome."""
    return triage_counts(capture_report(R.triage_responses(spark, sf_dir)))


SQL_TRIAGE_COUNTS = """
SELECT CASE WHEN o_orderstatus = 'P' THEN '3xx' ELSE '2xx' END AS status_class, o_orderstatus IN ('O', 'P') AS login,
       count(*)::BIGINT AS responses
FROM orders GROUP BY ALL
"""

QUERIES.update({"response_triage": q_response_triage, "triage_counts": q_triage_counts})
ORACLES.update({"response_triage": SQL_RESPONSE_TRIAGE, "triage_counts": SQL_TRIAGE_COUNTS})


# ------------------------------------------------------------------ E2
from ..operators.lms import extract_course_activities  # noqa: E402


def q_course_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities of every rendered course page (labels and empty sections dropped)."""
    pages = R.course_pages(spark, sf_dir)
    sh = shred_html(pages.select("page_key", "base_url", "url", "status", "course_id", "body"), keep_html=False, partitions=spread(spark, pages))
    return extract_course_activities(sh)


SQL_COURSE_ACTIVITIES = f"""
WITH p AS (
  SELECT *, p_partkey // 40 AS course, p_size // 10 AS sec,
    CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 'assign' WHEN 'SMALL' THEN 'quiz' WHEN 'MEDIUM' THEN 'forum'
      WHEN 'LARGE' THEN 'resource' WHEN 'ECONOMY' THEN 'label' WHEN 'PROMO' THEN 'url' END AS mt
  FROM part),
a AS (SELECT * FROM p WHERE mt IS NOT NULL AND mt <> 'label')
SELECT 'course-' || course AS page_key, 'Kurs ' || course AS course_name,
  (dense_rank() OVER (PARTITION BY course ORDER BY sec) - 1)::BIGINT AS section_pos,
  CASE WHEN sec % 2 = 0 THEN 'Woche ' || sec ELSE 'Abschnitt ' || sec END AS section_name,
  (row_number() OVER (PARTITION BY course, sec ORDER BY p_partkey) - 1)::BIGINT AS pos,
  p_partkey AS cmid,
  {"CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE " + sql_norm('p_name') + " END"} AS name,
  mt AS modtype,
  '{B}/mod/' || mt || '/view.php?id=' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '&forceview=1' ELSE '' END AS url
FROM a
"""

QUERIES["course_activities"] = q_course_activities
ORACLES["course_activities"] = SQL_COURSE_ACTIVITIES


# ------------------------------------------------------------------ A5
def q_course_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: activity rows nested back into sections and courses in page order
    (``array_sort`` of collected (section_pos, pos) structs — order never relies
    on shuffle order), shown as a compact outline string per course."""
    acts = q_course_activities(spark, sf_dir)
    secs = acts.groupBy("page_key", "section_pos", "section_name").agg(
        F.array_sort(F.collect_list(F.struct("pos", "cmid"))).alias("acts"))
    courses = secs.groupBy("page_key").agg(
        F.array_sort(F.collect_list(F.struct("section_pos", "section_name", "acts"))).alias("sections"))
    outline = F.array_join(F.transform("sections", lambda s: F.concat(
        s["section_name"], F.lit(":"), F.array_join(F.transform(s["acts"], lambda a: a["cmid"].cast("string")), ","))), "|")
    return courses.select("page_key", F.size("sections").cast("bigint").alias("sections"), outline.alias("outline"))


SQL_COURSE_NESTED = f"""
WITH a AS ({SQL_COURSE_ACTIVITIES}),
s AS (SELECT page_key, section_pos, section_name, string_agg(cmid::VARCHAR, ',' ORDER BY pos) AS ids FROM a GROUP BY ALL)
SELECT page_key, count(*)::BIGINT AS sections, string_agg(section_name || ':' || ids, '|' ORDER BY section_pos) AS outline
FROM s GROUP BY page_key
"""

QUERIES["course_nested"] = q_course_nested
ORACLES["course_nested"] = SQL_COURSE_NESTED


# ------------------------------------------------------------------ E12
from ..operators.lms import extract_folder  # noqa: E402


def q_folder_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File entries of every rendered folder page."""
    return extract_folder(_shred(R.folder_pages(spark, sf_dir)))


SQL_FOLDER_FILES = f"""
WITH f AS (SELECT *, p_partkey // 25 AS folder,
                  row_number() OVER (PARTITION BY p_partkey // 25, p_name ORDER BY p_partkey) AS dup FROM part),
u AS (SELECT * FROM f WHERE dup = 1)
SELECT 'folder-' || folder AS page_key,
  (row_number() OVER (PARTITION BY folder ORDER BY p_partkey) - 1)::BIGINT AS pos,
  CASE WHEN p_partkey % 4 = 0 THEN p_name || '.pdf' ELSE {sql_norm("p_name || '.pdf'")} END AS name,
  '{B}/pluginfile.php/' || folder || '/mod_folder/content/0/' || replace(p_name, ' ', '%20') || '.pdf?forcedownload=1' AS download_url,
  p_size || ' KB' AS size
FROM u
"""

QUERIES["folder_files"] = q_folder_files
ORACLES["folder_files"] = SQL_FOLDER_FILES


# ------------------------------------------------------------------ E15 / D15
from ..operators.lms import extract_choice_options  # noqa: E402


def q_choice_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E15 + D15: options of every rendered choice page (one row per option)."""
    return extract_choice_options(_shred(R.choice_pages(spark, sf_dir)))


SQL_CHOICE_OPTIONS = f"""
SELECT 'choice-' || n_regionkey AS page_key,
  (row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::BIGINT AS pos,
  {sql_norm('n_name')} AS label, nullif(n_nationkey * 3, 0)::BIGINT AS votes, n_nationkey % 5 = 2 AS selected
FROM nation
UNION ALL
SELECT 'choice-' || n_regionkey, count(*)::BIGINT, 'Enthaltung', NULL::BIGINT, false FROM nation GROUP BY n_regionkey
"""

QUERIES["choice_options"] = q_choice_options
ORACLES["choice_options"] = SQL_CHOICE_OPTIONS


# ------------------------------------------------------------------ R2
from ..operators.sanitize import sanitize_feed  # noqa: E402


def q_feed_sanitized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: every event of every sanitised feed, read back from its JSON."""
    feeds = R.feed_pages(spark, sf_dir).select("page_key", F.regexp_extract("page_key", r"\d+$", 0).cast("bigint").alias("block"), "body")
    v = F.try_parse_json("sanitized")
    rows = exploded(sanitize_feed(feeds, "block"), ["page_key"], F.try_variant_get(v, "$[0].data.events", "array<variant>"))
    read = lambda path, kind: F.try_variant_get(F.col("e"), path, kind)
    return rows.select(
        "page_key", F.col("pos").cast("bigint").alias("pos"), read("$.id", "bigint").alias("id"), read("$.instance", "bigint").alias("instance"), read("$.name", "string").alias("name"),
        read("$.course.id", "bigint").alias("course_id"), read("$.course.fullname", "string").alias("course_name"), read("$.action.url", "string").alias("action_url"),
        read("$.url", "string").alias("url"), read("$.eventtype", "string").alias("event_type"),
    )


def _sql_letters(i: str, most: int = 6) -> str:
    """'A' for 0, 'AA' for 26, … for numbers of up to ``most`` letters."""
    first = [(26**n - 26) // 25 for n in range(1, most + 2)]
    chars = lambda n: " || ".join(f"chr(65 + ((({i} - {first[n - 1]}) // {26**k}) % 26)::INT)" for k in reversed(range(n)))
    return "CASE " + " ".join(f"WHEN {i} < {first[n]} THEN {chars(n)}" for n in range(1, most + 1)) + " END"


SQL_FEED_SANITIZED = f"""
WITH e AS (SELECT *, event_id // 50 AS block, row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) - 1 AS pos FROM ({_EV}) WHERE event_id // 50 % 17 <> 5),
n AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM e),
c AS (SELECT user_id, row_number() OVER (ORDER BY min(event_id)) - 1 AS i FROM e GROUP BY user_id)
SELECT 'feed-' || block AS page_key, pos::BIGINT AS pos, (9000 + pos)::BIGINT AS id, (4000 + pos)::BIGINT AS instance, 'Event ' || {_sql_letters('n.i')} AS name,
  (7000 + pos)::BIGINT AS course_id, 'Course ' || {_sql_letters('c.i')} AS course_name,
  CASE WHEN modtype IS NOT NULL THEN '/mod/' || modtype || '/view.php?id=' || (4000 + pos) END AS action_url,
  CASE WHEN modtype IS NULL THEN '{B}/calendar/view.php?view=day&time=' || epoch END AS url, event_type
FROM e JOIN n USING (event_id) JOIN c USING (user_id)"""

QUERIES["feed_sanitized"] = q_feed_sanitized
ORACLES["feed_sanitized"] = SQL_FEED_SANITIZED


# ------------------------------------------------------------------ E12, E15 whole
from ..operators.lms import extract_choice, extract_folder_page  # noqa: E402
from ..sources import read_table  # noqa: E402


def q_folder_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per folder page; every seventh folder answers 500, every third has a description."""
    g = F.col("cmid")
    intro = F.concat(F.lit('<div class="activity-description">Files  of '), R._s("cmid"), F.lit("</div>"))
    pages = R.folder_pages(spark, sf_dir).withColumn("status", F.when(g % 7 == 3, 500).otherwise(F.col("status"))).withColumn(
        "body", F.when(g % 3 == 0, F.replace("body", F.lit('<div class="foldertree">'), F.concat(intro, F.lit('<div class="foldertree">')))).otherwise(F.col("body")))
    out = extract_folder_page(_shred(pages))
    return out.select("page_key", "title", "description", F.size("entries").cast("bigint").alias("n_entries"), F.get("entries", 0)["size"].alias("first_size"), "parser_degraded")


SQL_FOLDER_CONTENT = """
WITH f AS (SELECT p_partkey // 25 AS g, count(DISTINCT p_name) AS n, arg_min(p_size, p_partkey) AS s FROM part GROUP BY 1)
SELECT 'folder-' || g AS page_key, CASE WHEN g % 7 = 3 THEN 'Folder ' || g ELSE 'Ordner ' || g END AS title,
  CASE WHEN g % 7 <> 3 AND g % 3 = 0 THEN 'Files of ' || g END AS description, CASE WHEN g % 7 = 3 THEN 0 ELSE n END::BIGINT AS n_entries,
  CASE WHEN g % 7 <> 3 THEN s || ' KB' END AS first_size, g % 7 = 3 AS parser_degraded
FROM f"""


def q_choice_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per poll of ten customers: error pages (key mod 7 = 3), polls without options (mod 5 = 1), a chosen option (mod 2 = 0)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.floor(F.col("c_custkey") / 10).cast("bigint").alias("g"))
    option = F.concat(F.lit('<div class="option"><span class="text">'), R.esc("c_name"), F.lit('</span><span class="count">'), R._s("c_custkey"), F.lit("</span></div>"))
    polls = c.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("c_custkey", option.alias("o")))).alias("items"))  # ten rows a page
    g, s = F.col("g"), R._s("g")
    inner = F.concat(
        F.lit('<h2>Poll '), s, F.lit('</h2><div class="activity-header"><div>Opens: day '), s, F.lit("</div><div>Closes: then</div></div>"),
        F.when(g % 2 == 0, F.concat(F.lit('<div class="currentchoice">Yours: '), s, F.lit("</div>"))).otherwise(F.lit("")),
        F.when(g % 5 == 1, F.lit("<p>none</p>")).otherwise(F.array_join(F.transform("items", lambda x: x["o"]), "")),
    )
    pages = R.responses(polls, key=F.concat(F.lit("poll-"), s), path=F.concat(F.lit("/mod/choice/view.php?id="), s), body=R.page(F.lit("Poll"), inner), kind="activity", cmid=g, modtype="choice")
    out = extract_choice(_shred(pages.withColumn("status", F.when(F.col("cmid") % 7 == 3, 503).otherwise(F.col("status")))))
    return out.select("page_key", "title", "opens", "closes", "user_selection", F.size("options").cast("bigint").alias("n_options"),
                      F.aggregate("options", F.lit(0).cast("bigint"), lambda a, o: a + F.coalesce(o["votes"], F.lit(0))).alias("votes"), "parser_degraded")


SQL_CHOICE_CONTENT = """
WITH p AS (SELECT c_custkey // 10 AS g, count(*) AS n, sum(c_custkey) AS v, c_custkey // 10 % 7 = 3 AS bad, c_custkey // 10 % 5 = 1 AS blank FROM customer GROUP BY 1, 4, 5)
SELECT 'poll-' || g AS page_key, CASE WHEN bad THEN 'Choice ' ELSE 'Poll ' END || g AS title, CASE WHEN NOT bad THEN 'day ' || g END AS opens, CASE WHEN NOT bad THEN 'then' END AS closes,
  CASE WHEN NOT bad AND g % 2 = 0 THEN 'Yours: ' || g END AS user_selection, CASE WHEN bad OR blank THEN 0 ELSE n END::BIGINT AS n_options,
  CASE WHEN bad OR blank THEN 0 ELSE v END::BIGINT AS votes, bad OR blank AS parser_degraded
FROM p"""

QUERIES["folder_content"] = q_folder_content
ORACLES["folder_content"] = SQL_FOLDER_CONTENT
QUERIES["choice_content"] = q_choice_content
ORACLES["choice_content"] = SQL_CHOICE_CONTENT
