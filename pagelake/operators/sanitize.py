"""R2: stored event feeds without personal data, fit to be kept as samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dom import bind, exploded
from ..functions.text import redact_text
from .rows import alpha_label, dense_index

# Where the replacement ids of a feed start.
EVENT_IDS, INSTANCE_IDS, COURSE_IDS = 9000, 4000, 7000
SLOTS = 1 << 31  # an array has fewer elements, so (feed, position) fits one number
FEEDS_PER_BUCKET = 1024
_MEMBERS = "map<string,variant>"


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _text(v: Column) -> Column:
    return _get(v, "$", "string")


def _name(v: Column, path: str, prefix: str, i: Column) -> Column:
    return F.coalesce(_get(v, path, "string"), F.concat(F.lit(f"{prefix} "), (i + 1).cast("string")))


def _id(v: Column, new: Column) -> Column:
    """The new id for a number, a truth value or a numeric text; null, which drops the member, for anything else."""
    numeric = bind(F.trim(_text(v)), lambda t: (t == "") | t.try_cast("double").isNotNull())
    number = bind(F.coalesce(F.schema_of_variant(v), F.lit("")), lambda kind: F.when(kind.startswith("STRING"), numeric).otherwise(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|BOOLEAN)")))
    return F.when(number, new.cast("bigint").cast("variant"))


def _replace(members: Column, new: dict[str, Column]) -> Column:
    """``members`` as a variant with those of ``new`` in place of theirs; a null value drops the member."""
    names = list(new)
    fresh = F.map_filter(F.create_map(*[x for k in names for x in (F.lit(k), new[k])]), lambda _, v: v.isNotNull())
    kept = F.map_filter(members, lambda k, _: ~k.isin(*names))
    return F.to_variant_object(F.map_concat(kept, fresh))


def _event(ev: Column, i: Column, labels: Column) -> Column:
    return bind(F.coalesce(_get(ev, "$", _MEMBERS), F.create_map().cast(_MEMBERS)), lambda members: _clean_event(members, ev, i, labels))


def _clean_event(members: Column, ev: Column, i: Column, labels: Column) -> Column:
    instance = (i + INSTANCE_IDS).cast("string")

    def url(v: Column) -> Column:
        return bind(v, lambda u: F.when(_is(u, "STRING"), F.regexp_replace(_text(u), r"id=\d+", F.concat(F.lit("id="), instance)).cast("variant")).otherwise(u))

    action, course = members["action"], members["course"]
    named = lambda kind, name: labels[F.concat(F.lit(kind), name)].cast("variant")
    new_action = F.when(_is(action, "OBJECT"), _replace(_get(action, "$", _MEMBERS), {"url": url(_get(action, "$.url", "variant"))})).otherwise(action)
    new_course = F.when(_is(course, "OBJECT"), _replace(_get(course, "$", _MEMBERS), {
        "id": _id(_get(course, "$.id", "variant"), i + COURSE_IDS), "fullname": named("c", _name(course, "$.fullname", "Course", i))})).otherwise(course)
    return _replace(members, {
        "id": _id(members["id"], i + EVENT_IDS), "instance": _id(members["instance"], i + INSTANCE_IDS), "name": named("e", _name(ev, "$.name", "Event", i)),
        "url": url(members["url"]), "action": new_action, "course": new_course,
    })


def sanitize_feed(feeds: DataFrame, order: str, body: str = "body", out: str = "sanitized", limit: int | None = None, **site) -> DataFrame:
    """R2: ``feeds`` with ``out``, the feed as JSON without what could name a person or a course.

    Texts are redacted first (R1; ``site`` goes to ``redact_text``).  In the first element of the envelope the
    ids of an event, its instance and its course become 9000, 4000 and 7000 plus its position; ids in its
    addresses become the instance's; names become 'Event A', 'Course A', … in order of first appearance over
    all feeds by (``order``, position), ``order`` being an integer below 2**32 (null first, then by name).  All
    other members stay; an id that is no number goes.  ``limit`` keeps that many events a feed, default all.
    Other envelopes come back as they are; null and texts that are no JSON (or repeat a member) give null.
    Every row stays, repeated rows too: labels are looked up by the text's digest.  Labels are counted per 1024 feeds of
    consecutive order; the sums over these run in one task a kind."""
    first = _get(F.col("_v"), "$[0]", "variant")
    read = feeds.withColumn("_v", F.try_parse_json(redact_text(F.col(body), **site))).withColumn("_first", F.when(_is(F.col("_v"), "ARRAY") & _is(first, "OBJECT"), first))
    events = _get(F.col("_first"), "$.data.events", "array<variant>")
    read = read.withColumn("_events", events if limit is None else F.slice(events, 1, limit)).withColumn("_digest", F.sha2(F.col(body), 256))

    at = F.coalesce(F.col(order).cast("bigint"), F.lit(-1)) * F.lit(SLOTS)
    seen = exploded(read, ["_digest", at.alias("_at")], F.col("_events"), "_i", "_e")
    course = _get(F.col("_e"), "$.course", "variant")
    names = seen.select("_digest", (F.col("_at") + F.col("_i")).alias("_at"), F.explode(F.array(
        F.struct(F.lit("e").alias("kind"), _name(F.col("_e"), "$.name", "Event", F.col("_i")).alias("name")),
        F.struct(F.lit("c").alias("kind"), F.when(_is(course, "OBJECT"), _name(course, "$.fullname", "Course", F.col("_i"))).alias("name")),
    )).alias("_n")).select("_digest", "_at", "_n.*").where("name IS NOT NULL")
    firsts = names.groupBy("kind", "name").agg(F.min("_at").alias("_at"))
    # both kinds in one pass: a pass per kind would read and parse every feed again
    prefix = F.when(F.col("kind") == "e", F.lit("Event ")).otherwise(F.lit("Course "))
    label = dense_index(firsts, "_at", "name", "_idx", span=SLOTS * FEEDS_PER_BUCKET, by=("kind",)).select(
        "kind", "name", F.concat(prefix, alpha_label(F.col("_idx"))).alias("label"))
    used = names.select("_digest", "kind", "name").distinct().join(label, ["kind", "name"])
    pairs = F.collect_list(F.struct(F.concat("kind", "name"), F.col("label")))  # at most two names an event of one feed
    labels = used.groupBy("_digest").agg(F.map_from_entries(pairs).alias("_labels"))

    joined = read.join(labels, "_digest", "left")
    clean = F.transform("_events", lambda e, i: _event(e, i, F.col("_labels")))
    data = _get(F.col("_first"), "$.data", _MEMBERS)
    whole = _replace(_get(F.col("_first"), "$", _MEMBERS), {"data": _replace(data, {"events": F.to_variant_object(clean)})})
    result = F.when(F.col("_events").isNotNull(), F.to_json(F.array(whole))).when(F.col("_first").isNotNull(), F.to_json(F.array("_first"))).otherwise(F.to_json(F.col("_v")))
    return joined.select(*feeds.columns, F.when(F.col("_v").isNotNull(), result).alias(out))
