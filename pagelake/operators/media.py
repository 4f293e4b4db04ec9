"""Lecture recordings over shredded responses.

Only reading the embedded episode object needs Python (a small Arrow function
over the page text); links, joins, counts and preferences stay in Catalyst.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dom as D
from ..functions.text import normalize_text, slugify
from ..functions.urls import absolute_url

#: name of the page variable that holds an episode
VARIABLE = "window.episode"
EPISODE = T.StructType([T.StructField(n, T.StringType()) for n in ("episode_id", "title", "media_url", "recorded_at")] + [T.StructField("found", T.BooleanType())])
_STRING = r'"(?:\\.|[^"\\])*"' + "|" + r"'(?:\\.|[^'\\])*'"
_TOKEN = re.compile(_STRING + r"|[{}\"']", re.DOTALL)
_PARSE_CALL = re.compile(r"JSON\.parse\s*\(\s*(" + _STRING + ")", re.DOTALL)
_MP4 = re.compile(r"\.mp4(?:\?|#|$)", re.IGNORECASE)


def embedded_json(page: str, variable: str = VARIABLE) -> str | None:
    """text of the first object assigned to ``variable``, as a literal or through ``JSON.parse("…")``."""
    for m in re.finditer(re.escape(variable) + r"\s*=\s*", page):
        call = _PARSE_CALL.match(page, m.end())
        if call:
            inner = call[1][1:-1]
            if call[1][0] == "'":
                inner = inner.replace("\\'", "'").replace('"', '\\"')
            try:
                text = json.loads(f'"{inner}"')
            except ValueError:
                continue
            if text:
                return text
        elif page.startswith("{", m.end()):
            depth = 0
            for t in _TOKEN.finditer(page, m.end()):
                if t[0] in "\"'":  # a string that never ends
                    break
                depth += {"{": 1, "}": -1}.get(t[0], 0)
                if not depth:
                    return page[m.end() : t.end()]
    return None


def find_mp4(value) -> str | None:
    """the first string below ``value``, in key order, that names an mp4 file."""
    if isinstance(value, str):
        return value if _MP4.search(value) else None
    below = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return next((hit for hit in map(find_mp4, below) if hit), None)


def episode_of(page: str | None) -> dict | None:
    """The embedded episode of a page, None if there is none or its JSON is no object."""
    text = embedded_json(page or "")
    try:
        episode = json.loads(text, parse_constant=lambda c: 1 / 0) if text else None
    except (ValueError, ZeroDivisionError, RecursionError):
        return None
    if not isinstance(episode, dict):
        return None
    meta = episode.get("metadata")
    meta = meta if isinstance(meta, dict) else {}

    def pick(*places) -> str | None:
        return next((d[k] for d, k in places if isinstance(d.get(k), str)), None)

    rid = pick((meta, "id"), (meta, "episodeId"), (episode, "id"), (episode, "episodeId"))
    media = (find_mp4(x) for x in (episode.get("streams"), episode.get("publications"), episode))
    return {
        "episode_id": rid.lower() if rid else None,
        "title": pick((meta, "title"), (episode, "title")),
        "media_url": next((m for m in media if m), None),
        "recorded_at": pick((meta, "created"), (meta, "start"), (episode, "created")),
    }


@F.pandas_udf(EPISODE)
def _episode(pages: pd.Series) -> pd.DataFrame:
    found = [episode_of(p) for p in pages]
    table = pd.DataFrame([f or {} for f in found], columns=EPISODE.names[:-1], dtype=object)
    return table.assign(found=[f is not None for f in found])


def embedded_episodes(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """The embedded episode of every page that has one (body and base_url of responses)."""
    likely = df.where(F.contains(F.col("body"), F.lit(VARIABLE)))  # the filter reaches the scan; Python sees only these
    read = likely.select(*keep, "base_url", _episode("body").alias("e")).where("e.found")
    return read.select(
        *keep, "e.episode_id", F.nullif(normalize_text("e.title"), F.lit("")).alias("title"),
        F.when(F.col("e.media_url").isNotNull(), absolute_url(F.col("base_url"), F.col("e.media_url"))).alias("media_url"),
        "e.recorded_at", F.lit(None).cast("string").alias("source_url"),
    )


EPISODE_LINK = r"[?&]e=([0-9a-fA-F-]{36})"


def listed_episodes(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E21b + W3: episode links of shredded list pages, one row per episode in order of first appearance.

    Of several links of an episode a later German one with a real title replaces the first; a bare
    language switch is no title."""
    nodes, base = F.col("nodes"), F.col("base_url")
    links = F.filter(nodes, D.tag("a") & D.attr_contains("href", "/mod/opencast/view.php"))
    parsed = F.transform(links, lambda a: F.struct(
        F.lower(F.regexp_extract(D.attr(a, "href"), EPISODE_LINK, 1)).alias("id"), D.node_text(nodes, a).alias("text"),
        F.lower(F.regexp_extract(D.attr(a, "href"), r"(?i)[?&]lang=(de|en)\b", 1)).alias("lang"), absolute_url(base, D.attr(a, "href")).alias("link"),
    ))
    staged = df.select(*keep, F.filter(parsed, lambda l: l["id"] != "").alias("_links"))
    rows = D.exploded(staged, keep, F.col("_links"), "at", "l").select(*keep, "at", "l.*").withColumn("switch", F.lower("text").isin("de", "en"))
    better = (F.col("lang") == "de") & ~F.col("switch")
    packed = F.struct("text", "link", "switch")
    one = rows.groupBy(*keep, "id").agg(F.min("at").alias("first_at"), F.min_by(packed, "at").alias("first"), F.max_by(packed, F.when(better, F.col("at"))).alias("german"))
    chosen = one.withColumn("c", F.coalesce("german", "first"))
    return chosen.select(
        *keep, F.col("first_at").cast("bigint").alias("pos"), F.col("id").alias("episode_id"),
        F.when(~F.col("c.switch"), F.nullif("c.text", F.lit(""))).alias("title"), F.lit(None).cast("string").alias("media_url"),
        F.lit(None).cast("string").alias("recorded_at"), F.col("c.link").alias("source_url"),
    )


def raw_mp4_url(body: Column) -> Column:
    """the first absolute mp4 address in a page's text (escaped slashes undone)."""
    return F.nullif(F.regexp_extract(F.replace(body, F.lit("\\/"), F.lit("/")), r"https?://[^\"'\s]+\.mp4", 0), F.lit(""))


def recordings(activities: DataFrame, responses: DataFrame, shred) -> DataFrame:
    """Recordings of the opencast activities (course_id, cmid, url, base_url).

    An activity page's embedded episode wins over its list; a listed episode takes its media from the
    response of its own page (J2), embedded or as raw address; episodes without media are dropped (J3)."""
    ok = responses.where(F.col("status").between(200, 299)).select("url", "base_url", "body")
    visits = activities.where("modtype = 'opencast'").select("course_id", "cmid", "url").join(ok, "url")
    keys = ("course_id", "cmid", "url")
    direct = embedded_episodes(visits, keys).withColumn("pos", F.lit(0).cast("bigint"))
    lists = visits.withColumn("e", _episode("body")).where("NOT e.found").select(*keys, "base_url", "body")
    listed = listed_episodes(shred(lists), keys)
    detail = ok.where(F.contains(F.col("body"), F.lit("mp4"))).select(F.col("url").alias("source_url"), "base_url", F.col("body"))
    read = detail.select("source_url", "base_url", _episode("body").alias("d"), raw_mp4_url(F.col("body")).alias("raw")).select(
        "source_url", F.col("d.episode_id").alias("d_id"), F.nullif(normalize_text("d.title"), F.lit("")).alias("d_title"),
        F.when(F.col("d.media_url").isNotNull(), absolute_url(F.col("base_url"), F.col("d.media_url"))).alias("d_media"), F.col("d.recorded_at").alias("d_at"), "raw",
    )
    from_page = F.col("d_media").isNotNull()
    resolved = listed.join(read, "source_url").select(
        *keys, "pos", F.coalesce("episode_id", F.when(from_page, F.col("d_id"))).alias("episode_id"), F.coalesce("title", F.when(from_page, F.col("d_title"))).alias("title"),
        F.coalesce("d_media", "raw").alias("media_url"), F.when(from_page, F.col("d_at")).alias("recorded_at"), "source_url",
    )
    columns = [*keys, "pos", "episode_id", "title", "media_url", "recorded_at", "source_url"]
    found = direct.select(*columns).union(resolved.select(*columns)).where(F.col("media_url").isNotNull())
    return found.select(
        "course_id", "cmid", "pos", F.coalesce("title", F.concat(F.lit("Recording "), F.col("cmid").cast("string"))).alias("title"), "episode_id", "media_url", "recorded_at",
        F.coalesce("source_url", "url").alias("source_url"),
    )


def recordings_summary(activities: DataFrame, responses: DataFrame, found: DataFrame) -> DataFrame:
    """Per course its opencast activities, recordings, and whether an activity has no stored 2xx page."""
    acts = activities.where("modtype = 'opencast'").select("course_id", "cmid", "url")
    stored = responses.where(F.col("status").between(200, 299)).select("url", F.lit(True).alias("stored")).distinct()
    marked = acts.join(stored, "url", "left")
    counts = found.groupBy("course_id").agg(F.count(F.lit(1)).alias("recordings"))
    per = marked.groupBy("course_id").agg(F.count(F.lit(1)).alias("opencast_activities_found"), F.bool_or(F.col("stored").isNull()).alias("parser_degraded"))
    return per.join(counts, "course_id", "left").select("course_id", "opencast_activities_found", F.coalesce("recordings", F.lit(0)).cast("bigint").alias("recordings"), "parser_degraded")


def crawl_gaps(activities: DataFrame, responses: DataFrame) -> DataFrame:
    """Activities whose page is not among the stored responses."""
    return activities.join(responses.select("url"), "url", "left_anti")


def recording_names(rows: DataFrame, order: list[str]) -> DataFrame:
    """File names that are unique within a course, given in ``order``.

    ``slug.mp4``; if taken, the first 8 characters of the episode id are added; if that is taken too or
    there is none, the smallest free number from 2 on.  One sorted pass per partition that remembers the
    names of the course at hand."""
    fields = [*rows.schema.fields, T.StructField("slug", T.StringType()), T.StructField("file_name", T.StringType())]
    slug = F.coalesce(F.nullif(slugify(F.coalesce("title", F.lit(""))), F.lit("")), F.concat(F.lit("recording-"), F.col("cmid").cast("string")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        course, used, tried = object(), set(), {}
        for pdf in batches:
            names = []
            for c, s, e in zip(pdf["course_id"], pdf["slug"], pdf["episode_id"]):
                c = None if pd.isna(c) else c  # rows without a course are one group
                if c != course:
                    course, used, tried = c, set(), {}
                name = f"{s}.mp4"
                if name in used and isinstance(e, str):
                    name = f"{s}-{e[:8]}.mp4"
                if name in used:
                    k = tried.get(s, 2)  # numbers below were found taken before
                    while f"{s}-{k}.mp4" in used:
                        k += 1
                    tried[s], name = k, f"{s}-{k}.mp4"
                used.add(name)
                names.append(name)
            yield pdf.assign(file_name=names)

    placed = rows.withColumn("slug", slug).repartition("course_id").sortWithinPartitions("course_id", *order)
    return placed.mapInPandas(run, T.StructType(fields)).drop("slug")
