"""F-functions and DOM selectors on small literal inputs (expected values pinned)."""

import pytest
from pyspark.sql import functions as F

from pagelake.functions import dom as D
from pagelake.functions import text as TX
from pagelake.functions import urls as U
from pagelake.functions.dates import lms_date_unix, unix_to_iso, ymd_to_unix


def one(spark, col, *vals, schema="x string"):
    df = spark.createDataFrame([tuple(v) if isinstance(v, tuple) else (v,) for v in vals], schema)
    return [r[0] for r in df.select(col).collect()]


def test_normalize_truncate_snippet(spark):
    assert one(spark, TX.normalize_text("x"), "  a \n\t b c  ", None) == ["a b c", ""]
    assert one(spark, TX.truncate("x", 5), "abcdef", "abcde") == ["abcd…", "abcde"]
    long = "word " * 100
    snip = one(spark, TX.truncate_snippet("x"), long, "   ", "short text")
    assert snip[0].endswith("…") and len(snip[0]) <= 301 and not snip[0][:-1].endswith(" ")
    assert snip[1] is None and snip[2] == "short text"
    assert one(spark, TX.truncate_snippet("x"), "x" * 400)[0] == "x" * 300 + "…"


def test_slug_parse_int_choice_line(spark):
    assert one(spark, TX.slugify("x"), "Vorlesung 1: Intro!", "--A--b--") == ["vorlesung-1-intro", "a-b"]
    assert one(spark, TX.js_parse_int("x"), " 12abc", "x1", "", "-3") == [12, None, None, -3]
    t, r = TX.split_choice_line(F.col("x"))
    df = spark.createDataFrame([("W09 (Freitag, 14-16) (4 - Highly appreciated)",), ("Plain",)], "x string")
    rows = df.select(t, r).collect()
    assert rows[0][0] == "W09 (Freitag, 14-16)" and rows[0][1] == "4 - Highly appreciated"
    assert rows[1][0] == "Plain" and rows[1][1] is None


def test_redact_and_answer_prefix(spark):
    s = 'mail a.b@x.org sesskey=abc&x=1 MoodleSession=zz; "sesskey": "k1" "wwwroot": "https://h/p"'
    out = one(spark, TX.redact_text("x"), s)[0]
    assert "user@example.test" in out and "sesskey=REDACTED&x=1" in out and "MoodleSession=REDACTED;" in out
    assert '"sesskey":"REDACTED"' in out and '"wwwroot":"https://lms.example.test"' in out
    assert one(spark, TX.strip_answer_prefix("x"), "The correct answer is: 42", "Die richtige Antwort ist: B") == ["42", "B"]


@pytest.mark.parametrize("href,expected", [
    ("/mod/page/view.php?id=5", "https://lms.example.com/mod/page/view.php?id=5"),
    ("mod/x.php", "https://lms.example.com/mod/x.php"),
    ("https://other.org/a b", "https://other.org/a%20b"),
    ("//cdn.example.org/x", "https://cdn.example.org/x"),
    ("/a/./b/../c", "https://lms.example.com/a/c"),
    ("/für", "https://lms.example.com/f%C3%BCr"),
    ("?q=1", "https://lms.example.com/?q=1"),
    ("", ""),
    ("mailto:x@y", "mailto:x@y"),
])
def test_absolute_url(spark, href, expected):
    assert one(spark, U.absolute_url(F.lit("https://lms.example.com"), F.col("x")), href) == [expected]


def test_url_ids_and_modtypes(spark):
    urls = ["/course/view.php?id=42", "/mod/assign/view.php?id=7&course=3", "/mod/quiz/view.php?id=0", "/x?courseid=9"]
    assert one(spark, U.course_id_from_url("x"), *urls) == [42, 3, None, 9]
    assert one(spark, U.cmid_from_url("x"), *urls) == [42, 7, 0, None]
    assert one(spark, U.modtype_from_href("x"), *urls) == [None, "assign", "quiz", None]
    assert one(spark, U.modtype_from_component("x"), "mod_assign", "course", "") == ["assign", "course", None]


@pytest.mark.parametrize("path,norm,reason", [
    ("/mod/forum/view.php?id=1", "/mod/forum/view.php?id=1", None),
    ("/course//./view.php", "/course/view.php", None),
    ("/mod/../admin", None, "traversal"),
    ("/mod/%2e%2e/admin", None, "traversal"),
    ("/admin/index.php", None, "out_of_scope"),
    ("/my/a..b", None, "out_of_scope"),
    ("/calendar/x%20y?q=%2e", "/calendar/x y?q=%2e", None),
])
def test_path_verdict(spark, path, norm, reason):
    r = spark.createDataFrame([(path,)], "x string").select(U.path_verdict(F.col("x")).alias("r")).first().r
    assert (r.path, r.reason) == (norm, reason)


@pytest.mark.parametrize("url,verdict", [
    ("https://lms.example.com/pluginfile.php/1/mod_resource/content/0/a.pdf", "ok"),
    ("https://lms.example.com/webservice/pluginfile.php/1/a.pdf", "ok"),
    ("http://lms.example.com/pluginfile.php/1/a.pdf", "protocol_mismatch"),
    ("https://evil.example.org/pluginfile.php/1/a.pdf", "host_mismatch"),
    ("https://lms.example.com/mod/resource/view.php?id=1", "not_pluginfile"),
    ("not a url", "invalid_url"),
])
def test_file_url_verdict(spark, url, verdict):
    assert one(spark, U.file_url_verdict(F.col("x"), F.lit("https://lms.example.com")), url) == [verdict]


def test_filenames_and_cookies(spark):
    assert one(spark, U.filename_from_url("x"), "https://h/p/Skript%20A+B.pdf?x=1", "https://h/") == ["Skript A+B.pdf", None]
    hs = ["attachment; filename=\"a.pdf\"", "attachment; filename*=UTF-8''%C3%A4.pdf; filename=\"x.pdf\"",
          "attachment; filename*=UTF-8''%E0%A4%A.pdf", None]
    assert one(spark, U.filename_from_disposition("x"), *hs) == ["a.pdf", "ä.pdf", "%E0%A4%A.pdf", None]
    got = one(spark, U.cookie_names("x"), "MoodleSession=a; path=/, MOODLEID1_=b; expires=Wed, 01 Jan 2026 00:00:00 GMT, MoodleSession=c")
    assert got == [["MOODLEID1_", "MoodleSession"]]


def test_search_path(spark):
    df = spark.createDataFrame([("data science*", 0, 25), ("ä b", 2, 10)], "q string, p int, l int")
    got = [r[0] for r in df.select(U.search_path(F.col("q"), F.col("p"), F.col("l"))).collect()]
    assert got == ["/course/search.php?search=data+science*&perpage=25", "/course/search.php?search=%C3%A4+b&perpage=10&page=2"]


def test_dates(spark):
    vals = ["Wednesday, 1 April 2026, 12:20 PM", "Mittwoch, 1. April 2026, 12:20", "1 April 2026, 23:59 PM", "garbage"]
    assert one(spark, lms_date_unix("x", "UTC"), *vals) == [1775046000, 1775046000, None, None]
    assert one(spark, unix_to_iso("x"), 1778835600, 0, schema="x long") == ["2026-05-15T09:00:00.000Z", None]
    df = spark.createDataFrame([("2026", "5", "15"), ("2026", "13", "1")], "y string, m string, d string")
    assert [r[0] for r in df.select(ymd_to_unix(F.col("y"), F.col("m"), F.col("d"))).collect()] == [1778803200, None]


def test_dom_selectors(spark, shred_one):
    from pagelake.operators.shred import shred_html

    html = ('<body><div id="region-main"><h2>T</h2><ul><li class="a correct">x<li class="incorrect">y</ul>'
            '<label for="i1">L1</label><input id="i1"><label>L2 <input id="i2"></label></div></body>')
    df = shred_html(spark.createDataFrame([("0", html)], "page_key string, body string"), keep_html=False, partitions=1)
    n = F.col("nodes")
    li = F.filter(n, D.tag("li"))
    inputs = F.filter(n, D.tag("input"))
    r = df.select(
        F.size(F.filter(n, D.cls("correct"))).alias("correct"),
        D.node_text(n, D.first(li)).alias("li0"),
        D.closest(n, D.first(li), D.id_is("region-main"))["tag"].alias("closest"),
        F.size(D.next_siblings(n, D.first(li), D.tag("li"))).alias("sibs"),
        D.label_for(n, D.first(inputs)).alias("l1"),
        D.label_for(n, F.get(inputs, 1)).alias("l2"),
        D.cascade_text(n, [D.id_is("nope"), D.tag("h2")]).alias("casc"),
    ).first()
    assert r.correct == 1 and r.li0 == "x" and r.closest == "div" and r.sibs == 1
    assert r.l1 == "L1" and r.l2 == "L2" and r.casc == "T"


def test_ancestors_of_shallow_and_deep_nodes(spark):
    """closest, inside and remove against a walk over parent numbers, on both sides of the depth limit."""
    from pagelake.operators.shred import ANC_DEPTH, shred_html

    deep = ANC_DEPTH + 9
    html = '<body><div class="keep"><p>a</p></div>' + '<div class="x">' + "<section>" * deep + '<div class="y"><a href="u">t</a></div>' + "</section>" * deep + "</div><p>z</p></body>"
    df = shred_html(spark.createDataFrame([("0", html), ("1", ""), ("2", None)], "page_key string, body string"), partitions=1)
    n = F.col("nodes")
    pre = lambda arr: F.transform(arr, lambda d: d["pre"])
    rows = df.select(
        "page_key", "nodes",
        F.transform(n, lambda d: D.closest(n, d, D.cls("x"))["pre"]).alias("x"),
        F.transform(n, lambda d: D.closest(n, d, D.tag("section"))["pre"]).alias("section"),
        pre(D.remove(n, D.cls("y"))).alias("kept"),
        pre(D.remove(n, D.attr_eq("href", "none"))).alias("all"),
        pre(F.filter(n, lambda d: D.inside(n, F.get(n, 0), d, D.cls("y")))).alias("in_y"),
    ).orderBy("page_key").collect()
    for r in rows:
        up = {d.pre: d.parent for d in r.nodes}

        def line(i):
            return [i] + (line(up[i]) if up[i] >= 0 else [])

        def nearest(i, hit):
            return next((j for j in line(i) if hit(r.nodes[j])), None)

        is_x, is_y = (lambda d: "x" in d.class_tokens), (lambda d: "y" in d.class_tokens)
        assert r.x == [nearest(i, is_x) for i in up]
        assert r.section == [nearest(i, lambda d: d.tag == "section") for i in up]
        assert r.kept == [i for i in up if nearest(i, is_y) is None] and r.all == list(up)
        assert r.in_y == [i for i in up if any(is_y(r.nodes[j]) for j in line(i)[1:] if j > 0)]
        assert all((d.anc is None) == (d.depth > ANC_DEPTH) for d in r.nodes)
    assert any(d.anc is None for d in rows[0].nodes)


def test_request_limits_per_tool(spark):
    from pagelake.operators.requests import SEARCH_MAX_LIMIT, validate_requests

    df = spark.createDataFrame([(0,), (1,), (25,), (26,), (50,), (51,), (None,)], "limit int")
    flags = lambda out: [r.valid for r in out.collect()]
    assert flags(validate_requests(df)) == [False, True, True, False, False, False, True]
    assert flags(validate_requests(df, SEARCH_MAX_LIMIT)) == [False, True, True, True, True, False, True]
