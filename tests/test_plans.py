"""Plans: building a query runs no job beyond reading schemas; row operators on tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from pagelake.operators import rows
from pagelake.operators.timeline import window_of

SF = "/root/testdata/sf0.001"
OWN = [n for n in sorted(E.queries()) if not n.startswith("op") and n != "pipeline"]


def test_building_runs_no_jobs(spark):
    tracker = spark.sparkContext.statusTracker()
    E.queries()[OWN[0]](spark, SF)
    for name in OWN:
        spark.sparkContext.setJobGroup(name, name)
        E.queries()[name](spark, SF)
        # a job per table read at most: the footer that gives its schema
        assert len(tracker.getJobIdsForGroup(name)) <= 4, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_dense_index(spark):
    values = [(5, "b"), (5, "a"), (None, "n"), (70_000, "z"), (-3, "m"), (10_000_000, "q")]
    df = spark.createDataFrame(values, "pos long, v string")
    got = {r.v: r.idx for r in rows.dense_index(df, "pos", "v").collect()}
    want = sorted(values, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert got == {v: i for i, (_, v) in enumerate(want)}


def test_table_forms(spark):
    df = spark.createDataFrame([(k, i, i * 10) for k in "ab" for i in range(30)], "k string, i int, v int")
    page = rows.page_slice(df, ["k"], ["i"], limit=28, offset=1)
    assert page.count() == 56 and page.where("has_more").count() == 56  # a limit beyond 25 is honoured
    assert rows.cap_per_group(df, ["k"], ["i"], 3).count() == 6
    assert {r.v for r in rows.first_per_key(df, ["k"], ["i"]).collect()} == {0}
    assert {r.v for r in rows.last_per_key(df, ["k"], "i", ["v"]).collect()} == {290}


@pytest.mark.parametrize("given,want", [(None, 30), (-1, 30), ("x", 30), (7.9, 7), (365, 365)])
def test_window(given, want):
    assert window_of(given) == want


def test_rate_admission_null_keys(spark):
    from pagelake.streaming.rate import rate_admission

    df = spark.createDataFrame([(None, t, t) for t in range(5)] + [(1, t, t) for t in range(5)], "k long, ts long, o long")
    got = rate_admission(df, key="k", ts_ms="ts", order="o", max_calls=2).groupBy("k").agg(F.sum(F.col("admitted").cast("int")).alias("n")).collect()
    assert {r.k: r.n for r in got} == {None: 2, 1: 2}


def test_redaction_keeps_prose(spark):
    from pagelake.functions.text import mask_sesskey, redact_text

    text = "see x?sesskey=abc for details. logintoken=t1 then the rest MoodleSession=zz end"
    row = spark.createDataFrame([(text,)], "t string").select(redact_text("t").alias("r"), mask_sesskey("t").alias("m")).first()
    assert row.r == "see x?sesskey=REDACTED for details. logintoken=REDACTED then the rest MoodleSession=REDACTED end"
    assert row.m.endswith("for details. logintoken=t1 then the rest MoodleSession=zz end")


def test_external_url_skips_empty(spark):
    from pagelake.operators.activities import extract_url
    from pagelake.operators.shred import shred_html

    df = spark.createDataFrame(
        [("1", 200, {}, "https://l", 7, '<main><a href="">x</a><a href="https://o/z">y</a></main>'), ("2", 302, {"location": ""}, "https://l", 8, "")],
        "page_key string, status int, headers map<string,string>, base_url string, cmid long, body string",
    )
    got = {r.page_key: (r.external_url, r.parser_degraded) for r in extract_url(shred_html(df, keep_html=False)).collect()}
    assert got == {"1": ("https://o/z", False), "2": (None, True)}


@pytest.mark.parametrize("text,want", [
    ("2026-04-01", "2026-04-01 00:00:00"),
    ("2026-04-01T12:20", "2026-04-01 10:20:00"),
    ("2026-04-01T12:20:30Z", "2026-04-01 12:20:30"),
    ("2026-04-01T12:20:30+0500", "2026-04-01 07:20:30"),
    ("Wed, 01 Apr 2026 12:20:00 +0200", "2026-04-01 10:20:00"),
    ("Wed, 01 Apr 2026 12:20:00 GMT", "2026-04-01 12:20:00"),
    ("Mittwoch, 1. April 2026, 12:20", "2026-04-01 10:20:00"),
    ("April 1, 2026, 12:20 PM", "2026-04-01 10:20:00"),
    ("2026-13-01", None), ("2026-04-01 x", None), ("soon", None),
])
def test_dates(spark, text, want):
    from pagelake.functions.dates import parse_lms_date

    row = spark.createDataFrame([(text,)], "t string").select(parse_lms_date("t").cast("string").alias("d")).first()
    assert row.d == want


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["quiz_attempts", "quiz_questions", "events_upcoming", "events_month", "attr_profile", "feed_sanitized"])
def test_exploded_arrays_are_computed_once(spark, name):
    """A filter on the array's size below the explode would compute the whole array a second time."""
    plan = _plan(E.queries()[name](spark, SF))
    assert "posexplode" in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "size(" in line]


def test_located_node_is_evaluated_once(spark):
    from pagelake.functions import dom as D
    from pagelake.functions.urls import absolute_url
    from pagelake.operators.shred import shred_html

    df = shred_html(spark.createDataFrame([('<ul><li>x<li><a href="/a/../b c">t<b>u</b></a></ul><p></p>', "https://h")], "body string, base string"), keep_html=False)
    nodes = F.col("nodes")
    link = D.first(F.filter(nodes, D.tag("a") & D.attr_contains("href", "/a/")))
    cols = [D.node_text(nodes, link), D.attr(D.closest(nodes, link, D.tag("a")), "href"), absolute_url(F.col("base"), D.attr(link, "href")), D.node_text(nodes, D.first(F.filter(nodes, D.tag("p"))))]
    for c in cols[:3]:
        assert _plan(df.select(c.alias("c"))).count("/a/") == 1
    assert tuple(df.select(*cols).first()) == ("tu", "/a/../b c", "https://h/b%20c", "")


def test_dense_index_by_group(spark):
    df = spark.createDataFrame([(g, i * 100_000, f"{g}{i}") for g in "ab" for i in range(5)], "g string, pos long, v string")
    assert {r.v: r.idx for r in rows.dense_index(df, "pos", "v", by=("g",)).collect()} == {f"{g}{i}": i for g in "ab" for i in range(5)}


def test_sanitized_feeds_are_opened_three_times(spark):
    from pagelake.operators.sanitize import sanitize_feed

    feeds = spark.createDataFrame([(1, "[]")], "o long, body string")
    # the first names (once for their counts, once for their numbers) and the names per feed
    assert _plan(sanitize_feed(feeds, "o")).count("posexplode(") == 3
