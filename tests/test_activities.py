"""Activity extractors on hand-written fixtures (shapes of the platform's pages)."""

from pyspark.sql import functions as F

from pagelake.operators.lms import extract_feedback
from pagelake.operators.shred import shred_html

FEEDBACK = """<html><body><h2>Feedback zur Vorlesung</h2>
<div class="activity-header"><div class="activity-dates"><div><strong>Opened:</strong> 1 April 2026</div>
<div><strong>Closes:</strong> 30 April 2026</div></div></div>
<div id="region-main"><div class="feedbacksummary"><p>Bisher 12 Antworten</p><p>Insgesamt 42 responses</p></div>
<p>You have already   submitted this feedback.</p></div></body></html>"""


def _pages(spark, *rows):
    df = spark.createDataFrame([(str(i), st, i, b) for i, (st, b) in enumerate(rows)],
                               "page_key string, status int, cmid long, body string")
    return shred_html(df, keep_html=False, partitions=1)


def test_feedback(spark):
    out = {r.page_key: r for r in extract_feedback(_pages(spark, (200, FEEDBACK), (404, ""), (200, "<p>x</p>"))).collect()}
    r = out["0"]
    assert (r.title, r.opens, r.closes) == ("Feedback zur Vorlesung", "1 April 2026", "30 April 2026")
    assert r.already_submitted is True and r.submission_count == 42 and r.parser_degraded is False
    assert out["1"].title == "Feedback 1" and out["1"].parser_degraded is True
    assert out["2"].parser_degraded is True and out["2"].submission_count is None


LESSON = """<html><body><h1>Lektion 3</h1>
<div class="activity-header"><div><strong>Available:</strong> 1 April 2026</div><div><strong>Deadline:</strong> 9 April 2026</div></div>
<div class="box generalbox lesson-infosummary"><p>Number of attempts: 1</p><p>Best score: 80%</p></div></body></html>"""


def test_lesson(spark):
    from pagelake.operators.lms import extract_lesson

    out = {r.page_key: r for r in extract_lesson(_pages(spark, (200, LESSON), (500, LESSON))).collect()}
    r = out["0"]
    assert (r.title, r.opens, r.closes) == ("Lektion 3", "1 April 2026", "9 April 2026")
    assert r.attempts_used == 1 and r.best_score == "80%" and r.parser_degraded is False
    assert out["1"].title == "Lesson 1" and out["1"].parser_degraded is True and out["1"].opens is None


WORKSHOP = """<html><body><h2>Peer Review</h2><div class="activity-description">Bewerten Sie zwei Abgaben.</div>
<div class="activity-header"><div><strong>Opens:</strong> 1 May 2026</div><div><strong>Due:</strong> 20 May 2026</div></div>
<div class="userplan"><div class="phase done"><span class="phasename">Setup</span></div>
<div class="phase active"><span class="phasename">Submission phase</span></div></div>
<table class="submissionstatustable"><tr><th>Abgabestatus</th><td>Eingereicht</td></tr><tr><th>Grade</th><td>8 / 10</td></tr></table>
</body></html>"""


def test_workshop(spark):
    from pagelake.operators.lms import extract_workshop

    r = extract_workshop(_pages(spark, (200, WORKSHOP))).first()
    assert (r.title, r.opens, r.closes) == ("Peer Review", "1 May 2026", "20 May 2026")
    assert r.current_phase == "Submission phase" and r.submission_status == "Eingereicht" and r.grade == "8 / 10"
    assert r.description == "Bewerten Sie zwei Abgaben." and r.parser_degraded is False
