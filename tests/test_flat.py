"""Pages read together in numpy: the trees of the tree builder, and the extractors' parts as their selectors find them."""

import random

import pyarrow as pa

from pagelake.operators import flat
from pagelake.operators.lms import QUIZ_FIELDS, extract_quiz, quiz_parts
from pagelake.operators.review import REVIEW_FIELDS, extract_review, review_parts
from pagelake.operators.shred import parse_html, shred_html

TEXTS = ["a", "x  y ", " ", "\n", "é &amp; b", "x>y", "<!-- c -->", "&copy; ", "<", "3/4", "Opened: 1 May 2026", "Finished", "7.5 %", "Attempts allowed: 3"]
TAGS = "div div div span p ul li table tbody tr td th h1 h2 input input br select option label form a dl dt dd head body title".split()
ATTRS = ["", "", *3 * [' class="que correct"', ' class="answer"', ' class="quizattempt"', ' class="info"'], ' class="qno"', ' class="no"', ' class="state"', ' class="grade"', ' class="formulation"', ' class="qtext"', ' class="answer"', ' class="ablock"', ' class="accesshide"',
         ' class="flex-fill"', ' class="rightanswer"', ' class="quizinfo"', ' class="quizattempt"', ' class="activity-header"', ' class="activity-description"', ' id="intro"', ' type="text" value=" v  w"',
         ' type="number" value="5"', ' checked', ' selected', ' href="/mod/quiz/review.php?a=1&amp;b"', ' class="quizreviewsummary"', ' class="quizattemptsummary"']


def markup(rng, depth):
    if depth <= 0 or rng.random() < 0.25:
        return rng.choice(TEXTS[:8] if rng.random() < 0.98 else TEXTS) if rng.random() < 0.6 else rng.choice(TEXTS[9:])
    tag, attr = rng.choice(TAGS[:-3] if rng.random() < 0.99 else TAGS), rng.choice(ATTRS)
    inner = lambda n: "".join(markup(rng, depth - 1) for _ in range(rng.randrange(n)))
    if tag in ("input", "br"):
        return f"<{tag}{attr}>"
    if tag in ("table", "tbody", "tr", "td", "th"):
        rows = "".join(f"<tr{rng.choice(ATTRS)}>" + "".join(f"<{c}>{rng.choice(['', '', '3 '])}{inner(3)}</{c}>" for c in rng.choices(["td", "th"], k=rng.randrange(4))) + "</tr>" for _ in range(rng.randrange(4)))
        return f"<table{attr}>" + (f"<tbody>{rows}</tbody>" if rng.random() < 0.5 else rows) + "</table>"
    if tag in ("ul", "li"):
        return f"<ul{attr}>" + "".join(f"<li>{inner(3)}</li>" for _ in range(rng.randrange(3))) + "</ul>"
    if tag in ("select", "option"):
        return f"<select{attr}>" + "".join(f"<option{rng.choice(['', ' selected'])}>o{k}</option>" for k in range(3)) + "</select>"
    return f"<{tag}{attr}>{inner(5)}" + (f"</{tag}>" if rng.random() < 0.99 else "")


def page(rng):
    body = "".join(markup(rng, 6) for _ in range(rng.randrange(8)))
    head = rng.choice(["", '<meta charset="u">', "<title>T &amp; x</title>", "\n<title>q</title>\n", "x", "<title></title>"])
    return f'<!DOCTYPE html><html lang="de"><head>{head}</head><body class="k">{body}</body></html>\n' if rng.random() < 0.95 else body


def test_same_trees_as_the_tree_builder():
    rng, together = random.Random(4), 0
    for _ in range(20):
        htmls = [page(rng) for _ in range(40)] + [None, "", "x", "<div>", "<p>a<p>b"]
        rng.shuffle(htmls)
        seen = []
        for k, (places, p, _) in enumerate(flat.read_pages(pa.array(htmls, pa.string()))):
            seen += places.tolist()
            together += len(places) if k == 0 else 0
            for j, i in enumerate(places.tolist()):
                tb, lo = parse_html(htmls[i]), int(p.first[j])
                got = [(*p.known[p.kind[n]], max(int(p.parent[n]) - lo, -1), int(p.post[n]) - lo, int(p.depth[n]), p.data[p.offs[n] : p.offs[n + 1]].tobytes().decode()) for n in range(lo, int(p.first[j + 1]))]
                assert got == [(tb.tag[n], dict(tb.attrs[n]), tb.cls[n], tb.parent[n], tb.post[n], tb.depth[n], tb.text[n] or "") for n in range(len(tb.tag))], htmls[i]
        assert sorted(seen) == list(range(len(htmls)))
    assert together > 200


def test_plain_pages_are_read_together():
    """Pages like those of the platform take the way of the whole batch."""
    html = '<!DOCTYPE html><html><head><meta charset="utf-8"><title>T</title></head>\n<body><table class="a"><tr><td>1 &amp; 2</td></tr></table><ul><li>x<ul><li>y</li></ul></li></ul><input checked></body></html>\n'
    assert [len(places) for places, _, _ in flat.read_pages(pa.array([html] * 5))] == [5]


def test_parts_equal_the_selectors(spark):
    rng = random.Random(9)
    rows = [(str(k), "https://x.y", rng.choice([200, 200, 200, 404]), k, k, html) for k, html in enumerate([page(rng) for _ in range(500)] + [None, ""])]
    df = spark.createDataFrame(rows, "page_key string, base_url string, status int, cmid long, attempt long, body string").repartition(2)
    finished = "<table class=\"quizreviewsummary\"><tr><th>State</th><td>Finished</td></tr></table></body>"
    done = df.selectExpr("* except (body)", f"replace(body, '</body>', '{finished}') AS body")
    for frame, parts, fields, extract in ((df, quiz_parts, QUIZ_FIELDS, lambda f: extract_quiz(f, as_of=0)), (done, review_parts, REVIEW_FIELDS, extract_review)):
        want, got = (sorted(map(repr, extract(f).collect())) for f in (shred_html(frame, keep_html=False), flat.located_html(frame, parts, fields)))
        assert got == want
        assert sum("[Row(" in x for x in got) > 8


def test_parts_of_pages_without_nodes():
    """Batches of null and empty pages alone, as they come from rows with null columns."""
    for htmls in ([None], ["", None], ["<!DOCTYPE html>"], ["x", None]):
        for places, p, _ in flat.read_pages(pa.array(htmls, pa.string())):
            for parts in (quiz_parts, review_parts):
                found = parts(p)
                assert {len(x) for x in found.values()} == {len(places)}
                assert found["_h"].to_pylist() == [""] * len(places)
    assert flat.read_pages(pa.array([], pa.string())) == []
