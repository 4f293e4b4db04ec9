"""Recordings, review and dispatch: the rules that rendered pages do not reach."""

import json

import pytest
from pyspark.sql import functions as F

from pagelake.operators import media
from pagelake.operators.activities import extract_rating, extract_resource
from pagelake.operators.review import extract_review
from pagelake.operators.shred import shred_html
from pagelake.plans import media_queries


@pytest.mark.parametrize("page,want", [
    ("x", None),
    ("window.episode = 5; window.episode={\"a\": 1}", {"a": 1}),
    ("window.episode = {\"a\": \"}\", \"b\": {\"c\": 2}}; {}", {"a": "}", "b": {"c": 2}}),
    ("window.episode = {\"a\": \"\\\"}\"}", {"a": "\"}"}),
    ("window.episode = JSON.parse( \"{\\\"a\\\": 1}\" )", {"a": 1}),
    ("window.episode = JSON.parse('{\"a\": \"it\\'s\"}')", {"a": "it's"}),
    ("window.episode = {\"a\": 1", None),
    ("window.episode = {\"a\": \"open", None),
    ("window.episode = JSON.parse(x); window.episode = {\"b\": 1}", {"b": 1}),
])
def test_embedded_json(page, want):
    got = media.embedded_json(page)
    assert (json.loads(got) if got else None) == want


def test_find_mp4_and_episode():
    assert media.find_mp4({"z": ["a.MP4#t"], "a": "b.mp4"}) == "a.MP4#t"
    assert media.find_mp4({"a": "mp4", "b": [1, None, {"c": "x.mp4x"}]}) is None
    page = 'window.episode = {"metadata": {"episodeId": "AB", "start": "s"}, "title": "t", "x": "other.mp4", "publications": ["p.mp4"]}'
    assert media.episode_of(page) == {"episode_id": "ab", "title": "t", "media_url": "p.mp4", "recorded_at": "s"}
    assert media.episode_of("window.episode = {a: 1}") is None and media.episode_of(None) is None
    assert media.episode_of("window.episode = {}") == {"episode_id": None, "title": None, "media_url": None, "recorded_at": None}


def test_recording_names(spark):
    ids = ["04d797da-1", "04d797da-2", None, "04d797da-3"]
    rows = [(1, 42, "Vorlesung 1", e, i) for i, e in enumerate(ids)] + [(1, 43, "???", None, 9), (1, 43, "", None, 10), (2, 42, "Vorlesung 1", None, 0)]
    df = spark.createDataFrame(rows, "course_id long, cmid long, title string, episode_id string, i int")
    got = [r.file_name for r in media.recording_names(df, ["i"]).orderBy("course_id", "i").collect()]
    assert got == ["vorlesung-1.mp4", "vorlesung-1-04d797da.mp4", "vorlesung-1-2.mp4", "vorlesung-1-3.mp4", "recording-43.mp4", "recording-43-2.mp4", "vorlesung-1.mp4"]


def shred(spark, rows):
    df = spark.createDataFrame(rows, "page_key string, status int, body string").withColumn("base_url", F.lit("https://l")).withColumn("cmid", F.lit(7)).withColumn("attempt", F.lit(3))
    return shred_html(df.withColumn("headers", F.create_map().cast("map<string,string>")), keep_html=False)


def test_review_guard_and_rating_errors(spark):
    que = '<div class="que incorrect"><div class="info"><span class="qno">2</span></div><div class="qtext">Q</div><div class="answer"><select><option>a<option selected>b</select></div></div>'
    head = '<table class="quizreviewsummary"><tr><th>Status<td>{}</table>'
    got = {r.page_key: r for r in extract_review(shred(spark, [("done", 200, head.format("Beendet") + que), ("open", 200, head.format("In progress") + que), ("err", 500, head.format("Finished") + que)])).collect()}
    q = got["done"].questions[0]
    assert (q.number, q.is_correct, q.question_text, q.your_answer, got["done"].parser_degraded) == (2, False, "Q", ["b"], False)
    assert got["open"].questions is None and got["open"].state == "In progress" and got["open"].parser_degraded
    assert got["err"].title == "Quiz-Review 3" and got["err"].state is None and got["err"].parser_degraded
    rated = {r.page_key: r for r in extract_rating(shred(spark, [("none", 200, "<p>x"), ("err", 404, "<p>x"), ("empty", 200, '<div class="choicestatustable"></div>')])).collect()}
    assert rated["none"].error.code == "parse_error" and rated["err"].error is None and rated["empty"].error is None
    assert all(r.parser_degraded for r in rated.values())


def test_resource_prefers_plugin_file(spark):
    page = '<a href="/x?forcedownload=1">f</a><a href="/pluginfile.php/1/a%20b.pdf">p</a><div class="filedetails">12,5 MB</div>'
    row = extract_resource(shred(spark, [("1", 200, page)])).first()
    assert (row.download_url, row.filename, row.filesize, row.parser_degraded) == ("https://l/pluginfile.php/1/a%20b.pdf", "a b.pdf", "12,5 MB", False)


def test_every_order_is_a_review_page(spark):
    """The oracles hold only for keys with mod 8 = 1: over tables whose keys k read 8 k + 1 they cover every order."""
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW orders AS SELECT * REPLACE (o_orderkey * 8 + 1 AS o_orderkey) FROM read_parquet('{sf}/orders.parquet')")
    con.sql(f"CREATE VIEW lineitem AS SELECT * REPLACE (l_orderkey * 8 + 1 AS l_orderkey) FROM read_parquet('{sf}/lineitem.parquet')")
    for name in ("quiz_review_header", "quiz_questions"):
        got = media_queries.QUERIES[name](spark, sf)
        want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({media_queries.ORACLES[name]})").fetchall()
        want = [(f"review-{(int(r[0].removeprefix('review-')) - 1) // 8}", *r[1:]) for r in want]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_recording_names_without_course(spark):
    rows = [(None, 1, "Intro", None), (None, 2, "Intro", None), (None, 3, "Intro", "abcdefgh-1"), (7, 4, "Intro", None), (7, 5, None, None)]
    got = media.recording_names(spark.createDataFrame(rows, "course_id bigint, cmid bigint, title string, episode_id string"), ["cmid"])
    assert {r.cmid: r.file_name for r in got.collect()} == {1: "intro.mp4", 2: "intro-2.mp4", 3: "intro-abcdefgh.mp4", 4: "intro.mp4", 5: "recording-5.mp4"}
