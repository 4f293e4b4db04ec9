"""The review page of a finished quiz attempt, one projection per page."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dom as D
from ..functions.text import js_parse_int, normalize_text, strip_answer_prefix
from .flat import Pages, gathered, grouped, listed, normalized, string_bytes

# Label prefixes of the summary table (lower case) and the fields they fill, in order of trial.
HEADER_LABELS = {
    "state": ("state", "status"),
    "started": ("started", "begonnen"),
    "completed": ("completed", "abgeschlossen", "beendet"),
    "time_taken": ("time taken", "duration", "verbrauchte", "dauer"),
    "marks": ("marks", "punkte"),
    "grade": ("grade", "bewertung", "note"),
}
FINISHED = r"(?i)\b(finished|beendet|abgeschlossen|completed)\b"


def _text(nodes: Column, n: Column) -> Column:
    return D.node_text(nodes, n)


def _info(nodes: Column, que: Column, name: str) -> Column:
    return _text(nodes, D.first(D.find(nodes, que, D.cls(name), within=D.cls("info"))))


def _chosen(nodes: Column, que: Column) -> Column:
    """The user's answers: ticked options, else typed values, else selected options."""
    options = F.filter(D.find(nodes, que, D.tag("div")), lambda d: F.array_contains(D.parent_of(nodes, d)["class_tokens"], "answer"))
    ticked = F.filter(options, lambda o: F.exists(D.subtree(nodes, o), D.tag("input") & D.has_attr("checked")))
    label = D.cls("flex-fill") | D.attr_eq("data-region", "answer-label") | D.tag("label", "p")
    marked = F.transform(ticked, lambda o: F.coalesce(D.nonempty(_text(nodes, D.first(D.find(nodes, o, label)))), _text(nodes, o)))
    number = D.tag("input") & D.attr_eq("type", "number")
    typed = F.filter(D.subtree(nodes, que), lambda n: (D.tag("input")(n) & (D.attr(n, "type") == "text") & D.inside(nodes, que, n, D.cls("answer") | D.cls("ablock")))
                     | (number(n) & D.inside(nodes, que, n, D.cls("answer"))))
    values = F.transform(typed, lambda n: normalize_text(D.attr(n, "value")))
    selects = F.transform(D.find(nodes, que, D.tag("select"), within=D.cls("answer")), lambda s: _text(nodes, D.first(D.find(nodes, s, D.tag("option") & D.has_attr("selected")))))
    filled = lambda a: F.filter(a, lambda t: t != "")
    return D.bind(filled(marked), lambda m: F.when(F.size(m) > 0, m).otherwise(filled(F.concat(values, selects))))


def _located(nodes: Column, que: Column) -> Column:
    """What is read of one question, as ``review_parts`` finds it."""
    form = D.first(D.find(nodes, que, D.cls("formulation")))
    hidden = D.cls("accesshide")
    visible = F.filter(D.subtree(nodes, form), lambda n: (n["tag"] == "#text") & ~D.inside(nodes, form, n, hidden))
    fallback = normalize_text(F.array_join(visible["text"], ""))
    one = lambda name: _text(nodes, D.first(D.find(nodes, que, D.cls(name))))
    return F.struct(
        F.coalesce(D.nonempty(_info(nodes, que, "qno")), _info(nodes, que, "no")).alias("number"),
        _info(nodes, que, "state").alias("state"),
        que["class_tokens"].alias("tokens"),
        _info(nodes, que, "grade").alias("marks"),
        F.coalesce(D.nonempty(one("qtext")), fallback).alias("text"),
        _chosen(nodes, que).alias("answer"),
        *[one(name).alias(name) for name in ("rightanswer", "generalfeedback", "specificfeedback")],
    )


def _question(que: Column) -> Column:
    return F.struct(
        js_parse_int(F.regexp_extract(que["number"], r"\d+", 0)).alias("number"),
        D.nonempty(que["state"]).alias("state"),
        F.when(F.array_contains(que["tokens"], "correct"), True).when(F.arrays_overlap(que["tokens"], F.array(*map(F.lit, ("incorrect", "partiallycorrect", "notanswered")))), False).alias("is_correct"),
        D.nonempty(que["marks"]).alias("marks"),
        D.nonempty(que["text"]).alias("question_text"),
        que["answer"].alias("your_answer"),
        strip_answer_prefix(D.nonempty(que["rightanswer"])).alias("correct_answer"),
        D.nonempty(que["generalfeedback"]).alias("explanation"),
        D.nonempty(que["specificfeedback"]).alias("specific_feedback"),
    )


REVIEW_FIELDS = ("_h string, _rows array<struct<k: string, v: string>>, _ques array<struct<number: string, state: string, tokens: array<string>, marks: string, "
                 "text: string, answer: array<string>, rightanswer: string, generalfeedback: string, specificfeedback: string>>")


def review_parts(p: Pages) -> dict[str, pa.Array]:
    """The texts that ``extract_review`` works on, for ``located_html``: the heading, summary rows and questions."""
    rows = p.under(p.tag("table") & p.cls("quizreviewsummary"), p.tag("tr"))
    pairs = [p.texts(p.first_in(rows, p.tag(t))) for t in ("th", "td")]
    ques = np.flatnonzero(p.tag("div") & p.cls("que"))
    info = p.nearest(p.cls("info"))

    def one(name: str, within: np.ndarray | None = None) -> pa.Array:
        return p.texts(p.first_in(ques, p.cls(name), within))

    def nonempty(first: pa.Array, other: pa.Array) -> pa.Array:
        return pc.if_else(pc.equal(first, ""), other, first)

    text = one("qtext")
    form = np.where(pc.equal(text, "").to_numpy(zero_copy_only=False), p.first_in(ques, p.cls("formulation")), -1)
    which, runs = p.pairs(form, np.flatnonzero(p.tag("#text")))
    seen = p.nearest(p.cls("accesshide"))[runs] <= form[which]
    which, runs = which[seen], runs[seen]
    data, offs = gathered(p.data, p.offs[runs], p.offs[runs + 1])
    text = nonempty(text, normalized(data, offs[grouped(which, len(ques))]))

    answer, ablock = p.nearest(p.cls("answer")), p.nearest(p.cls("answer") | p.cls("ablock"))
    here = np.flatnonzero(p.tag("div") & (p.parent >= 0))
    in_ticked, options = p.pairs(ques, here[p.cls("answer")[p.parent[here]]])
    checked = p.first_in(options, p.tag("input") & p.has("checked")) >= 0
    in_ticked, options = in_ticked[checked], options[checked]
    label = p.cls("flex-fill") | p.has("data-region", lambda v: v == "answer-label") | p.tag("label", "p")
    ticked = nonempty(p.texts(p.first_in(options, label)), p.texts(options))
    in_typed, typed = p.pairs(ques, np.flatnonzero(p.tag("input") & p.has("type", lambda v: v in ("text", "number"))))
    inside = np.where(p.has("type", lambda v: v == "text")[typed], ablock[typed], answer[typed]) > ques[in_typed]
    in_typed, typed = in_typed[inside], typed[inside]
    in_select, selects = p.pairs(ques, np.flatnonzero(p.tag("select")))
    inside = answer[selects] > ques[in_select]
    in_select, selects = in_select[inside], selects[inside]
    chosen = p.texts(p.first_in(selects, p.tag("option") & p.has("selected")))

    filled = pc.not_equal(ticked, "").to_numpy(zero_copy_only=False)
    marked = np.zeros(len(ques) + 1, bool)
    marked[in_ticked[filled]] = True
    values = pa.concat_arrays([ticked, normalized(*string_bytes(p.attr(typed, "value"))), chosen])
    owner = np.concatenate([in_ticked, in_typed, in_select])
    use = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
    use[len(ticked):] &= ~marked[owner[len(ticked):]]
    use = np.flatnonzero(use)
    use = use[np.argsort(owner[use], kind="stable")]
    answers = listed(grouped(owner[use], len(ques)), values.take(pa.array(use)))

    tokens = pa.array([t for _, _, t in p.known], pa.list_(pa.string())).take(pa.array(p.kind[ques]))
    parts = [nonempty(one("qno", info), one("no", info)), one("state", info), tokens, one("grade", info), text, answers, *map(one, ("rightanswer", "generalfeedback", "specificfeedback"))]
    names = ["number", "state", "tokens", "marks", "text", "answer", "rightanswer", "generalfeedback", "specificfeedback"]
    return {
        "_h": p.texts(p.first_of(p.tag("h1", "h2"))),
        "_rows": p.listed(rows, pa.StructArray.from_arrays(pairs, ["k", "v"])),
        "_ques": p.listed(ques, pa.StructArray.from_arrays(parts, names)),
    }


def extract_review(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E10 + E10b: title, header fields (last row of a label wins) and questions, one row per page, of pages
    with their nodes or with what ``review_parts`` found.

    Questions are given only where the header says that the attempt is finished; any other page keeps its
    header, has no questions and is degraded."""
    if "nodes" in df.columns:
        nodes = F.col("nodes")
        trs = D.select_within(nodes, D.tag("table") & D.cls("quizreviewsummary"), D.tag("tr"))
        rows = F.transform(trs, lambda tr: F.struct(
            _text(nodes, D.first(D.find(nodes, tr, D.tag("th")))).alias("k"), _text(nodes, D.first(D.find(nodes, tr, D.tag("td")))).alias("v")))
        ques = F.transform(F.filter(nodes, D.tag("div") & D.cls("que")), lambda q: _located(nodes, q))
        df = df.select(*keep, "status", "attempt", "nodes", D.first_text(nodes, D.tag("h1", "h2")).alias("_h"), rows.alias("_rows"))
    else:
        ques = F.col("_ques")
    ok = F.col("status").between(200, 299)
    from_ = "nodes" if "nodes" in df.columns else "_ques"
    pairs = F.transform("_rows", lambda r: F.struct(F.lower(r["k"]).alias("k"), r["v"].alias("v")))
    located = df.select(*keep, "status", "attempt", from_, "_h", F.filter(pairs, lambda p: (p["k"] != "") & (p["v"] != "")).alias("_pairs"))

    def field(name: str) -> Column:
        def starts(p, prefixes):
            out = F.lit(False)
            for x in prefixes:
                out = out | p["k"].startswith(x)
            return out

        before = [x for n, xs in HEADER_LABELS.items() for x in xs if list(HEADER_LABELS).index(n) < list(HEADER_LABELS).index(name)]
        return D.last(F.filter("_pairs", lambda p: starts(p, HEADER_LABELS[name]) & ~starts(p, before)))["v"]

    headed = located.select(*keep, "status", "attempt", from_, "_h", *[F.when(ok, field(n)).alias(n) for n in HEADER_LABELS])
    done = ok & F.coalesce(F.col("state").rlike(FINISHED), F.lit(False))
    useful = F.filter(F.transform(ques, _question), lambda q: F.coalesce(q["question_text"], q["state"], q["marks"], q["correct_answer"]).isNotNull())
    staged = headed.select(*keep, "status", "attempt", "_h", *HEADER_LABELS, F.when(done, useful).alias("questions"))
    return staged.select(
        *keep,
        F.when(ok & (F.col("_h") != ""), F.col("_h")).otherwise(F.concat(F.lit("Quiz-Review "), F.col("attempt").cast("string"))).alias("title"),
        *HEADER_LABELS, "questions", (F.coalesce(F.size("questions"), F.lit(0)) <= 0).alias("parser_degraded"),
    )


def attempt_reviews(attempts: DataFrame, reviews: DataFrame) -> DataFrame:
    """Attempts with the review page that their link names (left join; attempts without a page stay)."""
    return attempts.join(reviews.withColumnRenamed("url", "review_url"), "review_url", "left")
