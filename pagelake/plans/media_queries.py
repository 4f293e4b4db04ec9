"""Queries over rendered resource, rating, review and recording pages, and mixed activities.

The pages are rendered from the driver tables inside Spark; each oracle computes
the same values straight from the base table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dom import exploded
from ..operators import media
from ..operators.activities import extract_rating, extract_resource
from ..operators.dispatch import extract_activity
from ..operators.flat import located_html
from ..operators.review import REVIEW_FIELDS, extract_review, review_parts
from ..operators.shred import shred_html
from ..sources import read_table
from . import render as R
from .common import spread

B = R.BASE
COLUMNS = ["page_key", "base_url", "url", "status", "headers", "cmid", "modtype", "body"]


def _shred(df: DataFrame) -> DataFrame:
    return shred_html(df, keep_html=False, partitions=spread(df.sparkSession, df))


# ------------------------------------------------------------------ E4
def resource_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per part: a redirect (key mod 4 = 0), a file link with its size (1), a description alone (2),
    an error page whose markup must be ignored (3)."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    k, kind = R._s("p_partkey"), F.col("p_partkey") % 4
    href = F.concat(F.lit("/pluginfile.php/"), k, F.lit("/mod_resource/content/1/"), F.replace("p_name", F.lit(" "), F.lit("%20")), F.lit(".pdf"))
    link = F.concat(F.lit('<div class="resourceworkaround">File <a href="'), R.esc(href), F.lit('">open</a> '), R._s("p_size"), F.lit(" KB</div>"))
    inner = F.concat(F.lit("<h2>"), R.esc("p_name"), F.lit("</h2>"), F.when(kind == 2, F.concat(F.lit('<div id="intro">About '), k, F.lit("</div>"))).otherwise(link))
    empty = F.create_map().cast("map<string,string>")
    return R.responses(
        p, key=F.concat(F.lit("resource-"), k), path=F.concat(F.lit("/mod/resource/view.php?id="), k), body=R.page(F.lit("File"), inner), kind="activity",
        cmid=F.col("p_partkey").cast("bigint"), modtype="resource", status=F.when(kind == 0, 303).when(kind == 3, 404).otherwise(200),
        headers=F.when(kind == 0, F.create_map(F.lit("location"), href)).otherwise(empty),
    )


def q_resource_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_resource(_shred(resource_pages(spark, sf_dir).select(*COLUMNS)))


SQL_RESOURCE_LINKS = f"""
SELECT 'resource-' || p_partkey AS page_key, CASE WHEN k IN (1, 2) THEN p_name ELSE 'Resource ' || p_partkey END AS title,
  CASE WHEN k = 1 THEN p_name || '.pdf' END AS filename, CASE WHEN k = 1 THEN p_size || ' KB' END AS filesize,
  CASE WHEN k < 2 THEN '{B}/pluginfile.php/' || p_partkey || '/mod_resource/content/1/' || replace(p_name, ' ', '%20') || '.pdf' END AS download_url,
  CASE WHEN k = 2 THEN 'About ' || p_partkey END AS description, k = 3 AS parser_degraded
FROM (SELECT *, p_partkey % 4 AS k FROM part)"""


# ------------------------------------------------------------------ E11
def rating_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per ten customers: the user's rated list (key mod 3 = 0), an options table without ``tbody`` tags
    (1), or unknown markup that must give an error (2)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey").withColumn("g", F.floor(F.col("c_custkey") / 10).cast("bigint"))
    li = F.concat(F.lit("<li>"), R.esc("c_name"), F.lit(" (Fri, 14-16)"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit(" ("), R._s("c_nationkey"), F.lit(" - ok)"))).otherwise(""))
    tr = F.concat(F.lit("<tr><td>"), R.esc("c_name"), F.lit("<td>Group "), R._s("c_custkey"), F.lit("<td>"), R._s("c_nationkey"))
    gathered = c.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("c_custkey", li.alias("li"), tr.alias("tr")))).alias("rows"))  # ten rows a page
    kind, g = F.col("g") % 3, R._s("g")
    status = F.concat(
        F.lit('<div class="choicestatustable"><table class="generaltable"><tr><td>Rating ends at</td><td>May '), g, F.lit("</td></tr><tr><td>Your Rating</td><td><ul>"),
        F.array_join(F.transform("rows", lambda r: r["li"]), ""), F.lit("</ul></td></tr><tr><td>Your Allocation</td><td>W"), g, F.lit("</td></tr></table></div>"),
    )
    options = F.concat(F.lit('<table id="mod_ratingallocateshowoptions">'), F.array_join(F.transform("rows", lambda r: r["tr"]), ""), F.lit("</table>"))
    inner = F.concat(F.lit("<h2>Ratings</h2>"), F.when(kind == 0, status).when(kind == 1, options).otherwise(F.lit("<p>changed</p>")))
    return R.responses(gathered, key=F.concat(F.lit("rating-"), g), path=F.concat(F.lit("/mod/ratingallocate/view.php?id="), g), body=R.page(F.lit("Rating"), inner),
                       kind="activity", cmid=F.col("g"), modtype="ratingallocate")


def q_rating_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_rating(_shred(rating_pages(spark, sf_dir).select(*COLUMNS)))
    rows = out.select("page_key", "deadline", "allocation", "parser_degraded", F.col("error.code").alias("code"), F.posexplode_outer("choices").alias("pos", "c"))
    return rows.select("page_key", "deadline", "allocation", "parser_degraded", "code", F.col("pos").cast("bigint").alias("pos"), "c.*")


SQL_RATING_CHOICES = """
WITH c AS (SELECT *, c_custkey // 10 AS g, row_number() OVER (PARTITION BY c_custkey // 10 ORDER BY c_custkey) - 1 AS n FROM customer)
SELECT 'rating-' || g AS page_key, CASE WHEN g % 3 = 0 THEN 'May ' || g END AS deadline, CASE WHEN g % 3 = 0 THEN 'W' || g END AS allocation, FALSE AS parser_degraded,
  NULL::VARCHAR AS code, n::BIGINT AS pos, CASE WHEN g % 3 = 1 THEN c_name ELSE c_name || ' (Fri, 14-16)' END AS title,
  CASE WHEN g % 3 = 1 THEN 'Group ' || c_custkey END AS description, CASE WHEN g % 3 = 1 THEN c_nationkey END::BIGINT AS max_size,
  CASE WHEN g % 3 = 0 AND c_custkey % 2 = 0 THEN c_nationkey || ' - ok' END AS user_rating
FROM c WHERE g % 3 < 2
UNION ALL
SELECT DISTINCT 'rating-' || g, NULL, NULL, TRUE, 'parse_error', NULL::BIGINT, NULL, NULL, NULL::BIGINT, NULL FROM c WHERE g % 3 = 2"""


# ------------------------------------------------------------------ E10, E10b
def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review page per order: its line items are questions; orders of status F are finished attempts."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    flag = F.col("l_returnflag")
    state = F.when(flag == "R", "correct").when(flag == "A", "incorrect").otherwise("partiallycorrect")
    tick = lambda n: F.when(F.col("l_suppkey") % 3 >= n, F.lit(" checked")).otherwise(F.lit(""))
    answer = F.when(
        F.col("l_partkey") % 2 == 0,
        F.concat(F.lit('<div class="r0"><input type="radio"'), tick(1), F.lit("><label>Opt one</label></div>"), F.lit('<div class="r1"><input type="radio"'), tick(2), F.lit('><div class="flex-fill">Opt two</div></div>')),
    ).otherwise(F.concat(F.lit('<input type="text" readonly value="'), R._s("l_suppkey"), F.lit('">')))
    que = F.concat(
        F.lit('<div class="que multichoice '), state, F.lit('"><div class="info"><h3 class="no">Question <span class="qno">'), R._s("l_linenumber"), F.lit('</span></h3><div class="state">'), state,
        F.lit('</div><div class="grade">Mark 1 out of '), R._s("l_linenumber"), F.lit('</div></div><div class="content"><div class="formulation"><h4 class="accesshide">Question text</h4>'),
        F.when(F.col("l_partkey") % 5 == 0, F.lit("Cloze")).otherwise(F.concat(F.lit('<div class="qtext"><p>Part '), R._s("l_partkey"), F.lit("</p></div>"))),
        F.lit('<div class="answer">'), F.when(F.col("l_partkey") % 5 == 0, F.lit("")).otherwise(answer), F.lit('</div></div><div class="outcome"><div class="rightanswer">The correct answer is: '),
        R._s("l_suppkey"), F.lit("</div></div></div></div>"),
    )
    questions = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", que.alias("q")))).alias("items"))
    j = o.join(questions, o["o_orderkey"] == questions["l_orderkey"])
    k = R._s("o_orderkey")
    inner = F.concat(
        F.lit('<h1>Review</h1><table class="quizreviewsummary"><tr><th>State</th><td>'), F.when(F.col("o_orderstatus") == "F", F.lit("Finished")).otherwise(F.lit("In progress")),
        F.lit("</td></tr><tr><th>Grade</th><td>"), R.esc("o_orderpriority"), F.lit("</td></tr></table>"), F.array_join(F.transform("items", lambda x: x["q"]), ""),
    )
    return R.responses(j, key=F.concat(F.lit("review-"), k), path=F.concat(F.lit("/mod/quiz/review.php?attempt="), k), body=R.page(F.lit("Review"), inner), kind="review",
                       modtype="quiz").withColumn("attempt", F.regexp_extract("page_key", r"\d+", 0).cast("bigint"))


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = review_pages(spark, sf_dir).select("page_key", "status", "attempt", "body")
    return extract_review(located_html(pages, review_parts, REVIEW_FIELDS, partitions=spread(spark, pages)))


def q_quiz_review_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviews(spark, sf_dir).select("page_key", "title", "state", "grade", "marks", F.coalesce(F.size("questions"), F.lit(0)).cast("bigint").alias("n_questions"), "parser_degraded")


SQL_QUIZ_REVIEW_HEADER = """
SELECT 'review-' || o_orderkey AS page_key, 'Review' AS title, CASE WHEN o_orderstatus = 'F' THEN 'Finished' ELSE 'In progress' END AS state, o_orderpriority AS grade,
  NULL::VARCHAR AS marks, CASE WHEN o_orderstatus = 'F' THEN count(*) ELSE 0 END::BIGINT AS n_questions, o_orderstatus <> 'F' AS parser_degraded
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus, o_orderpriority"""


def q_quiz_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exploded(_reviews(spark, sf_dir), ["page_key"], F.col("questions"), item="q")
    return rows.select("page_key", F.col("pos").cast("bigint").alias("pos"), "q.number", "q.state", "q.is_correct", "q.marks", "q.question_text",
                       F.array_join("q.your_answer", "|").alias("your_answer"), "q.correct_answer")


SQL_QUIZ_QUESTIONS = """
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS n,
  CASE l_returnflag WHEN 'R' THEN 'correct' WHEN 'A' THEN 'incorrect' ELSE 'partiallycorrect' END AS s FROM lineitem)
SELECT 'review-' || l_orderkey AS page_key, n::BIGINT AS pos, l_linenumber::BIGINT AS number, s AS state, s = 'correct' AS is_correct, 'Mark 1 out of ' || l_linenumber AS marks,
  CASE WHEN l_partkey % 5 = 0 THEN 'Cloze' ELSE 'Part ' || l_partkey END AS question_text,
  CASE WHEN l_partkey % 5 = 0 THEN '' WHEN l_partkey % 2 = 1 THEN l_suppkey::VARCHAR WHEN l_suppkey % 3 = 0 THEN '' WHEN l_suppkey % 3 = 1 THEN 'Opt one' ELSE 'Opt one|Opt two' END AS your_answer,
  l_suppkey::VARCHAR AS correct_answer
FROM l JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'"""


# ------------------------------------------------------------------ recordings
def _uuid(k) -> object:
    return F.concat(F.lpad(R._s(k), 8, "0"), F.lit("-1111-2222-3333-444444444444"))


def recording_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as activities of courses (40 parts a course): odd keys are recordings."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    k = F.col("p_partkey")
    return p.select(
        F.floor(k / 40).cast("bigint").alias("course_id"), k.cast("bigint").alias("cmid"), F.when(k % 2 == 1, "opencast").otherwise("resource").alias("modtype"),
        F.concat(F.lit(f"{B}/mod/opencast/view.php?id="), R._s("p_partkey")).alias("url"), "p_name", "p_size",
    )


def recording_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of the odd parts by key mod 8: embedded object (1), embedded string (3), list with a language switch and
    a German link plus detail pages (5), no stored page at all (7)."""
    a = recording_activities(spark, sf_dir).where("modtype = 'opencast' AND cmid % 8 <> 7")
    k, name = R._s("cmid"), F.col("p_name")
    obj = F.concat(F.lit('{"id": "x}", "metadata": {"id": "'), F.upper(_uuid("cmid")), F.lit('", "title": " '), name, F.lit(' ", "created": "2024-01-02"}, "streams": [{"poster": "p.jpg"}, {"src": "/static/'), k, F.lit('.mp4?x=1"}]}'))
    as_string = F.concat(F.lit("JSON.parse('"), F.replace(obj, F.lit("'"), F.lit("\\'")), F.lit("')"))
    link = lambda lang, text: F.concat(F.lit('<a href="/mod/opencast/view.php?id='), k, F.lit("&amp;e="), _uuid("cmid"), F.lit(f"&amp;lang={lang}\">"), text, F.lit("</a>"))
    listing = F.concat(F.lit("<p>window.episode; none here</p>"), link("en", F.lit("en")), link("de", R.esc(name)), link("en", F.lit("later")))
    kind = F.col("cmid") % 8
    inner = F.when(kind == 1, F.concat(F.lit("<script>window.episode = "), obj, F.lit("; var y = {};</script>"))).when(
        kind == 3, F.concat(F.lit("<script>window.episode = "), as_string, F.lit(";</script>"))).otherwise(listing)
    pages = a.select("url", inner.alias("inner"))
    old = a.where(kind == 5).select(
        F.concat(F.lit(f"{B}/mod/opencast/view.php?id="), k, F.lit("&e="), _uuid("cmid"), F.lit("&lang=de")).alias("url"),
        F.when(F.col("cmid") % 16 == 5, F.concat(F.lit('<script>play("https:\\/\\/media.example.com\\/'), k, F.lit('.mp4")</script>'))).otherwise(F.lit("<p>nothing</p>")).alias("inner"),
    )
    both = pages.union(old)
    return both.select("url", F.lit(B).alias("base_url"), F.lit(200).alias("status"), R.page(F.lit("Recording"), F.col("inner")).alias("body"))


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.recordings(recording_activities(spark, sf_dir), recording_pages(spark, sf_dir), _shred)


def q_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(spark, sf_dir)


_SQL_FOUND = f"""
SELECT p_partkey // 40 AS course_id, p_partkey AS cmid, 0::BIGINT AS pos, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS title,
  lpad(p_partkey::VARCHAR, 8, '0') || '-1111-2222-3333-444444444444' AS episode_id,
  CASE WHEN p_partkey % 8 = 5 THEN 'https://media.example.com/' || p_partkey || '.mp4' ELSE '{B}/static/' || p_partkey || '.mp4?x=1' END AS media_url,
  CASE WHEN p_partkey % 8 <> 5 THEN '2024-01-02' END AS recorded_at,
  '{B}/mod/opencast/view.php?id=' || p_partkey || CASE WHEN p_partkey % 8 = 5 THEN '&e=' || lpad(p_partkey::VARCHAR, 8, '0') || '-1111-2222-3333-444444444444&lang=de' ELSE '' END AS source_url
FROM part WHERE p_partkey % 8 IN (1, 3) OR p_partkey % 16 = 5"""


def q_recordings_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.recordings_summary(recording_activities(spark, sf_dir), recording_pages(spark, sf_dir), _found(spark, sf_dir))


SQL_RECORDINGS_SUMMARY = """
SELECT p_partkey // 40 AS course_id, count(*) AS opencast_activities_found, count(*) FILTER (WHERE p_partkey % 8 IN (1, 3) OR p_partkey % 16 = 5) AS recordings,
  bool_or(p_partkey % 8 = 7) AS parser_degraded
FROM part WHERE p_partkey % 2 = 1 GROUP BY 1"""


def q_crawl_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = recording_activities(spark, sf_dir).where("modtype = 'opencast'")
    return media.crawl_gaps(acts, recording_pages(spark, sf_dir)).select("course_id", "cmid")


SQL_CRAWL_GAPS = "SELECT p_partkey // 40 AS course_id, p_partkey AS cmid FROM part WHERE p_partkey % 8 = 7"


def q_recording_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 over parts titled by the first word of their name, so that titles collide within a course."""
    rows = recording_activities(spark, sf_dir).select(
        "course_id", "cmid", F.regexp_extract("p_name", r"^\S+", 0).alias("title"), F.when(F.col("cmid") % 3 > 0, F.concat(F.lit("id"), (F.col("cmid") % 4).cast("string"), F.lit("-000000000"))).alias("episode_id")
    )
    return media.recording_names(rows, ["cmid"]).select("course_id", "cmid", "file_name")


# ------------------------------------------------------------------ E22
def q_activity_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resource and rating pages, the latter also as an unknown type, through the one dispatch."""
    ratings = rating_pages(spark, sf_dir).select(*COLUMNS)
    unknown = ratings.withColumn("modtype", F.lit("glossary")).withColumn("page_key", F.concat(F.lit("glossary:"), "page_key"))
    mixed = resource_pages(spark, sf_dir).select(*COLUMNS).unionByName(ratings).unionByName(unknown)
    out = extract_activity(mixed, as_of=0.0, partitions=spread(spark, mixed))
    return out.select("page_key", "modtype", "title", F.get_json_object("content", "$.download_url").alias("download_url"), "parser_degraded", F.col("error.code").alias("code"))


SQL_ACTIVITY_MIX = f"""
SELECT page_key, 'resource' AS modtype, title, download_url, parser_degraded, NULL::VARCHAR AS code FROM ({SQL_RESOURCE_LINKS})
UNION ALL
SELECT DISTINCT 'rating-' || g, 'ratingallocate', 'Ratings', NULL, g % 3 = 2, CASE WHEN g % 3 = 2 THEN 'parse_error' END FROM (SELECT c_custkey // 10 AS g FROM customer)
UNION ALL
SELECT DISTINCT 'glossary:rating-' || g, 'glossary', 'Ratings', NULL, TRUE, NULL FROM (SELECT c_custkey // 10 AS g FROM customer)"""


QUERIES = {
    "resource_links": q_resource_links,
    "rating_choices": q_rating_choices,
    "quiz_review_header": q_quiz_review_header,
    "quiz_questions": q_quiz_questions,
    "recordings": q_recordings,
    "recordings_summary": q_recordings_summary,
    "crawl_gaps": q_crawl_gaps,
    "recording_names": q_recording_names,
    "activity_mix": q_activity_mix,
}

ORACLES = {
    "resource_links": SQL_RESOURCE_LINKS,
    "rating_choices": SQL_RATING_CHOICES,
    "quiz_review_header": SQL_QUIZ_REVIEW_HEADER,
    "quiz_questions": SQL_QUIZ_QUESTIONS,
    "recordings": _SQL_FOUND,
    "recordings_summary": SQL_RECORDINGS_SUMMARY,
    "crawl_gaps": SQL_CRAWL_GAPS,
    "activity_mix": SQL_ACTIVITY_MIX,
}
