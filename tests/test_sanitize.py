"""R2: sanitised feeds against a walk over the parsed JSON."""

import json
import re

from pagelake.operators.sanitize import sanitize_feed


def letters(i):
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def expected(bodies):
    """By hand: the feeds in order, names numbered as they come."""
    seen = {"Event": {}, "Course": {}}

    def label(kind, name):
        return f"{kind} {letters(seen[kind].setdefault(name, len(seen[kind])))}"

    def new_id(v, new):
        return new if isinstance(v, (int, float)) or (isinstance(v, str) and re.fullmatch(r"\s*(-?\d+(\.\d+)?)?\s*", v)) else None

    out = []
    for body in bodies:
        try:
            v = json.loads(body)
        except (TypeError, ValueError):
            out.append(None)
            continue
        if isinstance(v, list) and v and isinstance(v[0], dict):
            v = [v[0]]
            for i, e in enumerate((v[0].get("data") or {}).get("events") or []):
                e["name"] = label("Event", str(e.get("name") or f"Event {i + 1}"))
                e["id"], e["instance"] = new_id(e.get("id"), 9000 + i), new_id(e.get("instance"), 4000 + i)
                for holder in (e, e.get("action") or {}):
                    if isinstance(holder.get("url"), str):
                        holder["url"] = re.sub(r"id=\d+", f"id={4000 + i}", holder["url"])
                if isinstance(e.get("course"), dict):
                    e["course"]["id"] = new_id(e["course"].get("id"), 7000 + i)
                    e["course"]["fullname"] = label("Course", e["course"].get("fullname") or f"Course {i + 1}")
                for holder in (e, e.get("course") or {}):
                    for k in [k for k in ("id", "instance") if k in holder and holder[k] is None]:
                        del holder[k]
        out.append(v)
    return out


def feed(*events, **more):
    return json.dumps([{"error": False, "data": {"events": list(events), "firstid": 3}, **more}, {"second": 1}])


def test_sanitize_feed(spark):
    many = [{"id": n, "name": f"n{n}", "x": {"deep": [1, None, "ä"]}, "course": {"id": 1, "fullname": "Maths", "short": "M"}} for n in range(30)]
    bodies = [
        feed({"id": 5, "instance": "7", "name": "b", "url": "https://h/?id=12&courseid=3", "action": {"url": "/x?id=9", "n": 1}}, {"id": None, "name": "a", "url": 4, "instance": "x"}),
        feed({"name": "a", "course": {"id": "q"}}, {"course": "text", "action": None}, methodname="m"),
        feed(), feed(*many), feed(*many), "[]", "[1]", '{"a": 1}', '[{"error": true, "exception": {"errorcode": "x"}}]', '[{"data": {"events": 3}}]', "no json", "", None,
    ]
    df = spark.createDataFrame([(i, b, "x") for i, b in enumerate(bodies)], "n long, body string, label string")
    rows = sanitize_feed(df, "n").orderBy("n").collect()
    assert df.columns + ["sanitized"] == list(rows[0].asDict())
    want = expected([b if b != '[{"data": {"events": 3}}]' else "[]" for b in bodies])
    want[9] = [{"data": {"events": 3}}]
    assert [r.sanitized and json.loads(r.sanitized) for r in rows] == want
    two = json.loads(sanitize_feed(df.where("n = 3"), "n", limit=2).first().sanitized)
    assert [e["name"] for e in two[0]["data"]["events"]] == ["Event A", "Event B"]
    assert sanitize_feed(df.limit(0), "n").count() == 0


def test_repeated_and_null_orders(spark):
    body = feed({"id": 1, "name": "mail me@x.org now"})
    rows = sanitize_feed(spark.createDataFrame([(None, body), (None, body), (4, body)], "n long, body string"), "n").collect()
    assert len(rows) == 3 and {json.loads(r.sanitized)[0]["data"]["events"][0]["name"] for r in rows} == {"Event A"}
