"""E22 with E12 and E15: one row per response, whatever its key, type and status."""

import json

from pyspark.sql import functions as F

from pagelake.operators import dispatch

SCHEMA = "page_key string, base_url string, status int, headers map<string,string>, cmid bigint, modtype string, body string"
FOLDER = ('<h1>Files</h1><div class="activity-description">All  files</div><div class="foldertree"><li><a href="/pluginfile.php/1/a%20b.pdf?x=1"></a><span class="fp-size">3 KB</span></li>'
          '<li><a href="/pluginfile.php/1/a%20b.pdf?x=1">again</a></li></div>')
CHOICE = ('<h2>Poll</h2><div class="activity-header"><div>Opens: Monday</div><div>Closes: Friday</div></div><div class="currentchoice">Your selection: Yes</div>'
          '<div class="option"><span class="text">Yes</span><span class="count">4</span></div><label for="n">No</label><input type="radio" name="answer" id="n" checked>')


def extract(spark, rows, types=None):
    df = spark.createDataFrame([(k, "https://x.org", status, None, 5, modtype, body) for k, modtype, status, body in rows], SCHEMA)
    return dispatch.extract_activity(df, as_of=0.0, partitions=1, known=types and {t: dispatch.extractors(0.0)[t] for t in types})


def test_types_and_fallback(spark):
    rows = [("f", "folder", 200, FOLDER), ("f500", "folder", 500, FOLDER), ("fe", "folder", 200, "<p>none</p>"), ("c", "choice", 200, CHOICE), ("c4", "choice", 404, CHOICE),
            ("p", "page", 200, "<main><h1>P</h1>text</main>"), ("g", "glossary", 200, "<main><h1>G</h1>words</main>"), ("n", None, 200, None)]
    out = {r.page_key: r for r in extract(spark, rows).collect()}
    assert len(out) == len(rows)
    folder = json.loads(out["f"].content)
    assert out["f"].title == "Files" and folder["description"] == "All files" and not out["f"].parser_degraded
    assert folder["entries"] == [{"name": "a b.pdf", "download_url": "https://x.org/pluginfile.php/1/a%20b.pdf?x=1", "size": "3 KB"}]
    for key, title in (("f500", "Folder 5"), ("fe", "Folder 5"), ("c4", "Choice 5")):
        assert out[key].title == title and out[key].parser_degraded and list(json.loads(out[key].content).values()) == [[]]
    choice = json.loads(out["c"].content)
    assert (choice["opens"], choice["closes"], choice["user_selection"]) == ("Monday", "Friday", "Your selection: Yes")
    assert choice["options"] == [{"label": "Yes", "votes": 4, "selected": False}, {"label": "No", "selected": True}]
    assert out["p"].title == "P" and "text" in json.loads(out["p"].content)["text"]
    assert out["g"].title == "G" and out["g"].parser_degraded and "words" in json.loads(out["g"].content)["raw_text"]
    assert out["n"].parser_degraded and out["n"].error is None


def test_null_and_repeated_keys_keep_every_row(spark):
    unknown = "<main><h1>R</h1><p>drift</p></main>"
    got = extract(spark, [(None, "ratingallocate", 200, unknown), ("k", "ratingallocate", 200, unknown), ("k", "ratingallocate", 200, unknown), ("k", "folder", 200, FOLDER)], ["ratingallocate", "folder"])
    rows = got.collect()
    assert sorted(str(r.page_key) for r in rows) == ["None", "k", "k", "k"]
    failed = [r for r in rows if r.modtype == "ratingallocate"]
    assert all(r.error.code == "parse_error" and r.parser_degraded and "drift" in json.loads(r.content)["raw_text"] for r in failed)
    assert got.where("false").collect() == []
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_registered_extractor(spark):
    def extract_wiki(df, keep):
        return df.select(*keep, F.lit("Wiki").alias("title"), F.size("nodes").alias("n"), F.lit(False).alias("parser_degraded"))

    dispatch.register_extractor("wiki", extract_wiki)
    try:
        row = extract(spark, [("w", "wiki", 200, "<p>x</p>")], ["wiki"]).first()
    finally:
        dispatch._REGISTERED.pop("wiki")
    assert row.title == "Wiki" and json.loads(row.content)["n"] > 1 and row.parser_degraded is False
