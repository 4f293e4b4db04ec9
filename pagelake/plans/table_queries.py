"""Named queries over ``documents``, ``part``, ``orders`` and ``events`` (direct oracles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import lms_date_unix, ntz_to_unix, unix_to_iso
from ..functions.text import (
    MAX_TEXT_LEN,
    mask_sesskey,
    normalize_text,
    redact_text,
    slugify,
    truncate,
    truncate_snippet,
)
from ..functions.urls import search_path
from ..functions.jsonx import json_shape, json_or_self_keys
from ..operators.requests import validate_requests
from ..operators.rows import pseudonymize
from ..operators.timeline import restrict_to, timeline, top_due
from ..sources import read_table
from .common import WS, sql_norm, sql_truncate

# ------------------------------------------------------------------ documents


def q_norm_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 over whole documents."""
    d = read_table(spark, sf_dir, "documents")
    n = normalize_text("text")
    return d.select("doc_id", n.alias("text"), F.length(n).cast("bigint").alias("length"))


SQL_NORM_DOCUMENTS = f"SELECT doc_id, {sql_norm('text')} AS text, length({sql_norm('text')})::BIGINT AS length FROM documents"


def q_truncate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """at most 5000 characters, '…' marks a cut."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", truncate("text", MAX_TEXT_LEN).alias("text"))


SQL_TRUNCATE_DOCUMENTS = f"SELECT doc_id, {sql_truncate('text', MAX_TEXT_LEN)} AS text FROM documents"


def q_snippet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """300-character snippets cut at a word boundary."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", truncate_snippet("text").alias("snippet"))


_N = sql_norm("text")
SQL_SNIPPET_DOCUMENTS = f"""
WITH n AS (SELECT doc_id, {_N} AS t FROM documents),
c AS (SELECT doc_id, t, left(t, 300) AS cut, regexp_extract(left(t, 300), '(?s)^(.+) [^ ]*$', 1) AS bs FROM n)
SELECT doc_id,
  CASE WHEN t = '' THEN NULL WHEN length(t) <= 300 THEN t
       ELSE rtrim(CASE WHEN bs = '' THEN cut ELSE bs END) || '…' END AS snippet
FROM c
"""


def q_redact_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 + R3 over whole documents: e-mails, tokens, cookies, JSON keys, sesskey in URLs."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", mask_sesskey(redact_text("text")).alias("text"))


def _q(s: str) -> str:
    return s.replace("'", "''")


_WSC = WS[1:-2]
SQL_REDACT_DOCUMENTS = f"""
SELECT doc_id,
  regexp_replace(
   regexp_replace(
    regexp_replace(
     regexp_replace(
      regexp_replace(
       regexp_replace(text, '[A-Z0-9._%+-]+@[A-Z0-9.-]+\\.[A-Z]{{2,}}', 'user@example.test', 'gi'),
       '(sesskey|logintoken|authtoken)=([^&"{_q("'")}<>]+)', '\\1=REDACTED', 'gi'),
      '(MoodleSession\\w*|MOODLEID\\w*)=([^;"{_q("'")}{_WSC}<>]+)', '\\1=REDACTED', 'gi'),
     '"sesskey"[{_WSC}]*:[{_WSC}]*"[^"]+"', '"sesskey":"REDACTED"', 'gi'),
    '"wwwroot"[{_WSC}]*:[{_WSC}]*"([^"]+)"', '"wwwroot":"https://lms.example.test"', 'gi'),
   'sesskey=[^&]+', 'sesskey=REDACTED', 'g') AS text
FROM documents
"""


def q_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's source as 'Source A', 'Source B', … in first-seen order (doc_id)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return pseudonymize(d, "source", "Source", "doc_id")


SQL_PSEUDONYMS = """
WITH f AS (SELECT source, min(doc_id) AS first FROM documents WHERE source IS NOT NULL GROUP BY source),
r AS (SELECT source, (row_number() OVER (ORDER BY first) - 1) AS i FROM f),
l AS (SELECT source, 'Source ' || CASE
        WHEN i < 26 THEN chr(65 + i::INT)
        WHEN i < 702 THEN chr(65 + ((i - 26) // 26)::INT) || chr(65 + ((i - 26) % 26)::INT)
        ELSE chr(65 + ((i - 702) // 676)::INT) || chr(65 + (((i - 702) // 26) % 26)::INT) || chr(65 + ((i - 702) % 26)::INT)
      END AS pseudonym FROM r)
SELECT d.source, d.doc_id, l.pseudonym FROM documents d LEFT JOIN l USING (source)
"""


# ------------------------------------------------------------------ part


def q_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F18 over part names."""
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", slugify("p_name").alias("slug"))


SQL_SLUGS = """
SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS slug
FROM part
"""


def q_search_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """search request paths (pages 0 and 1, 25 per page) for every part name."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pg = p.select("p_partkey", "p_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("page"))
    return pg.select("p_partkey", "page", search_path(F.col("p_name"), F.col("page"), F.lit(25)).alias("path"))


SQL_SEARCH_FRONTIER = """
SELECT p_partkey, page,
  '/course/search.php?search=' || replace(replace(replace(replace(url_encode(p_name), '~', '%7E'), '%20', '+'), '%2A', '*'), '%7e', '%7E')
  || '&perpage=25' || CASE WHEN page > 0 THEN '&page=' || page ELSE '' END AS path
FROM part, (SELECT unnest([0, 1]) AS page)
"""


# ------------------------------------------------------------------ orders: display dates


def q_lms_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8 round trip: order dates rendered as platform display strings (English with
    AM/PM, or German with month names and 24 h), then parsed back in Europe/Berlin."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    en = F.date_format("o_orderdate", "EEEE, d MMMM yyyy, h:mm a")
    de = F.date_format("o_orderdate", "d. MMMM yyyy, HH:mm")
    for e, g in (("January", "Januar"), ("February", "Februar"), ("March", "März"), ("May", "Mai"), ("June", "Juni"),
                 ("July", "Juli"), ("October", "Oktober"), ("December", "Dezember")):
        de = F.replace(de, F.lit(e), F.lit(g))
    shown = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Montag, "), de)).otherwise(en)
    return o.select("o_orderkey", lms_date_unix(shown, "Europe/Berlin").alias("due_unix"))


SQL_LMS_DATES = "SELECT o_orderkey, epoch(timezone('Europe/Berlin', o_orderdate))::BIGINT AS due_unix FROM orders"


# ------------------------------------------------------------------ events: timeline


def events_as_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver ``events`` as timeline events: user -> course, type kept, a modtype
    for three types (null for the others), errors undated."""
    e = read_table(spark, sf_dir, "events")
    due = F.when(F.col("event_type") != "error", ntz_to_unix("ts"))
    return e.select(
        "event_id",
        F.col("user_id").alias("course_id"),
        "event_type",
        F.when(F.col("event_type") == "purchase", F.lit("assign"))
        .when(F.col("event_type") == "signup", F.lit("quiz"))
        .when(F.col("event_type") == "click", F.lit("forum")).alias("modtype"),
        due.alias("due_at_unix"),
        unix_to_iso(due).alias("due_at_iso"),
    )


SQL_EVENTS_AS_TIMELINE = """
SELECT event_id, user_id AS course_id, event_type,
  CASE event_type WHEN 'purchase' THEN 'assign' WHEN 'signup' THEN 'quiz' WHEN 'click' THEN 'forum' END AS modtype,
  CASE WHEN event_type <> 'error' THEN floor(epoch(ts))::BIGINT END AS due_at_unix,
  CASE WHEN event_type <> 'error' THEN strftime(to_timestamp(floor(epoch(ts))), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS due_at_iso
FROM events
"""

AS_OF = 1705276800  # 2024-01-15T00:00:00Z, inside the driver's event range


def q_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + P4 + O1: next 7 days from AS_OF, modtypes assign/quiz (nulls kept, undated kept)."""
    ev = events_as_timeline(spark, sf_dir)
    return timeline(ev, as_of=AS_OF, window_days=7, modtypes=["assign", "quiz"])


SQL_TIMELINE = f"""
SELECT * FROM ({SQL_EVENTS_AS_TIMELINE})
WHERE (due_at_unix IS NULL OR due_at_unix BETWEEN {AS_OF} AND {AS_OF + 7 * 86400})
  AND (modtype IS NULL OR modtype IN ('assign', 'quiz'))
"""


def q_timeline_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2: one course and one event type (nulls dropped), 30-day default window."""
    ev = events_as_timeline(spark, sf_dir)
    return timeline(ev, as_of=AS_OF, course_id=42, event_type="purchase")


SQL_TIMELINE_COURSE = f"""
SELECT * FROM ({SQL_EVENTS_AS_TIMELINE})
WHERE course_id = 42 AND event_type = 'purchase'
  AND (due_at_unix IS NULL OR due_at_unix BETWEEN {AS_OF} AND {AS_OF + 30 * 86400})
"""


def q_timeline_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: the first 50 purchases due from AS_OF (the limit is the feature)."""
    ev = timeline(events_as_timeline(spark, sf_dir), as_of=AS_OF, event_type="purchase", sort=False)
    return top_due(ev, 50)


SQL_TIMELINE_TOPK = f"""
SELECT * FROM ({SQL_EVENTS_AS_TIMELINE})
WHERE event_type = 'purchase' AND (due_at_unix IS NULL OR due_at_unix BETWEEN {AS_OF} AND {AS_OF + 30 * 86400})
ORDER BY coalesce(due_at_unix, 0), event_id LIMIT 50
"""


def q_timeline_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5: 'view' events of users who have a purchase in the window (left-semi join)."""
    ev = events_as_timeline(spark, sf_dir)
    window = timeline(ev, as_of=AS_OF, sort=False)
    buyers = window.where(F.col("event_type") == "purchase").select("course_id")
    return restrict_to(window.where(F.col("event_type") == "view"), buyers, ["course_id"])


SQL_TIMELINE_SEMI = f"""
WITH w AS (SELECT * FROM ({SQL_EVENTS_AS_TIMELINE}) WHERE due_at_unix IS NULL OR due_at_unix BETWEEN {AS_OF} AND {AS_OF + 30 * 86400})
SELECT * FROM w WHERE event_type = 'view' AND course_id IN (SELECT course_id FROM w WHERE event_type = 'purchase')
"""


def q_event_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """props parsed when it is JSON (else kept as text); the ``k`` member."""
    e = read_table(spark, sf_dir, "events").select("event_id", "props")
    return e.select("event_id", *json_or_self_keys(F.col("props"), "k"))


SQL_EVENT_PROPS_JSON = """
SELECT event_id, json_valid(props) AS is_json,
       CASE WHEN json_valid(props) THEN try_cast(json_extract(props, '$.k') AS BIGINT) END AS k
FROM events
"""


def q_json_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: shape profile of every props value, counted per shape."""
    e = read_table(spark, sf_dir, "events").select("props")
    return json_shape(e, F.col("props")).groupBy("parsed_type", "first_keys").agg(F.count("*").alias("n"))


SQL_JSON_SHAPE = """
WITH s AS (
  SELECT CASE WHEN NOT json_valid(props) THEN 'invalid_json'
              WHEN json_type(props) = 'OBJECT' THEN 'object'
              WHEN json_type(props) = 'ARRAY' THEN 'array' ELSE lower(json_type(props)) END AS parsed_type,
         CASE WHEN json_valid(props) AND json_type(props) = 'OBJECT' THEN to_json(list_sort(json_keys(props))) ELSE '[]' END AS first_keys
  FROM events)
SELECT parsed_type, first_keys, count(*)::BIGINT AS n FROM s GROUP BY ALL
"""


def q_request_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as tool requests and validated against the tool input ranges."""
    e = read_table(spark, sf_dir, "events")
    req = e.select(
        "event_id",
        F.col("event_id").alias("cmid"),
        F.col("event_type").alias("modtype"),
        F.floor("value").cast("bigint").alias("limit"),
        (F.col("user_id") - 75).alias("offset"),
        F.col("props").alias("query"),
        F.month(F.col("ts")).alias("month"),
        (F.year(F.col("ts")) + F.col("user_id") * 0).alias("year"),
        F.floor(F.col("value") / 5).cast("bigint").alias("page"),
    )
    return validate_requests(req).select("event_id", "valid", "reasons")


SQL_REQUEST_CHECKS = """
WITH r AS (
  SELECT event_id, event_id AS cmid, event_type AS modtype, floor(value)::BIGINT AS "limit", user_id - 75 AS "offset",
         props AS query, month(ts) AS month, year(ts) AS year, floor(value / 5)::BIGINT AS page
  FROM events),
c AS (
  SELECT event_id, list_filter([
    CASE WHEN cmid IS NULL OR cmid < 1 THEN 'cmid' END,
    CASE WHEN modtype IS NULL OR NOT regexp_matches(modtype, '^[a-z_]+$') THEN 'modtype' END,
    CASE WHEN "limit" IS NOT NULL AND ("limit" < 1 OR "limit" > 25) THEN 'limit' END,
    CASE WHEN "offset" IS NOT NULL AND "offset" < 0 THEN 'offset' END,
    CASE WHEN query IS NOT NULL AND (length(query) < 2 OR length(query) > 200) THEN 'query' END,
    CASE WHEN page IS NOT NULL AND (page < 0 OR page > 20) THEN 'page' END,
    CASE WHEN year IS NOT NULL AND (year < 2020 OR year > 2100) THEN 'year' END,
    CASE WHEN month IS NOT NULL AND (month < 1 OR month > 12) THEN 'month' END
  ], lambda x: x IS NOT NULL) AS rs
  FROM r)
SELECT event_id, len(rs) = 0 AS valid, array_to_string(rs, ',') AS reasons FROM c
"""


QUERIES = {
    "norm_documents": q_norm_documents,
    "truncate_documents": q_truncate_documents,
    "snippet_documents": q_snippet_documents,
    "redact_documents": q_redact_documents,
    "pseudonyms": q_pseudonyms,
    "slugs": q_slugs,
    "search_frontier": q_search_frontier,
    "lms_dates": q_lms_dates,
    "timeline": q_timeline,
    "timeline_course": q_timeline_course,
    "timeline_topk": q_timeline_topk,
    "timeline_semi": q_timeline_semi,
    "event_props_json": q_event_props_json,
    "json_shape": q_json_shape,
    "request_checks": q_request_checks,
}
ORACLES = {
    "norm_documents": SQL_NORM_DOCUMENTS,
    "truncate_documents": SQL_TRUNCATE_DOCUMENTS,
    "snippet_documents": SQL_SNIPPET_DOCUMENTS,
    "redact_documents": SQL_REDACT_DOCUMENTS,
    "pseudonyms": SQL_PSEUDONYMS,
    "slugs": SQL_SLUGS,
    "search_frontier": SQL_SEARCH_FRONTIER,
    "lms_dates": SQL_LMS_DATES,
    "timeline": SQL_TIMELINE,
    "timeline_course": SQL_TIMELINE_COURSE,
    "timeline_topk": SQL_TIMELINE_TOPK,
    "timeline_semi": SQL_TIMELINE_SEMI,
    "event_props_json": SQL_EVENT_PROPS_JSON,
    "json_shape": SQL_JSON_SHAPE,
    "request_checks": SQL_REQUEST_CHECKS,
}


# ------------------------------------------------------------------ ST1
def q_rate_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 on events: per user at most 3 admitted requests per day (the driver's
    events are sparse, about 67 per user in a month).  No SQL oracle: the rule
    refers to its own earlier decisions; tests compare it with brute force."""
    from ..streaming.rate import rate_admission, with_epoch_ms

    e = with_epoch_ms(read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "ts")
    out = rate_admission(e, key="user_id", ts_ms="ts_ms", order="event_id", max_calls=3, window_ms=86_400_000)
    return out.select("event_id", "user_id", "ts_ms", "admitted", "retry_after_s")


QUERIES["rate_admission"] = q_rate_admission
