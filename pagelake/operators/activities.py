"""Activity extractors, one projection per page kind.

Every extractor takes shredded responses (``nodes`` plus ``status``,
``headers``, ``base_url``, ``cmid``) and returns typed rows with
``parser_degraded``.  Non-2xx rows get the default title and degraded=true.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dom as D
from ..functions.text import file_size_text, js_parse_int, split_choice_line
from ..functions.urls import absolute_url, filename_from_url
from .quality import error_record

HEADING = D.tag("h1", "h2")
DESCRIPTION = [D.cls("activity-description"), D.id_is("intro")]


def _ok(status: str = "status") -> Column:
    return F.col(status).between(200, 299)


def _title(nodes: Column, label: str) -> Column:
    t = D.first_text(nodes, HEADING)
    default = F.concat(F.lit(label + " "), F.col("cmid").cast("string"))
    return F.when(_ok() & (t != ""), t).otherwise(default)


def extract_url(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """E5: external link of a URL activity.

    3xx with ``location`` -> that value, unresolved.  Otherwise
    ``.urlworkaround a`` (resolved), else the first link under
    ``.box.generalbox``, ``#intro`` or ``main`` that is not a URL-view or
    login link, not root-relative and not on the site; degraded iff none.
    """
    nodes = F.col("nodes")
    status = F.col("status")
    location = F.col("headers")["location"]
    redirect = status.between(300, 399) & (F.coalesce(location, F.lit("")) != "")
    workaround = D.attr(D.first(D.select_within(nodes, D.cls("urlworkaround"), D.tag("a"))), "href")
    content_links = D.select_within(
        nodes, D.any_of([D.cls("box", "generalbox"), D.id_is("intro"), D.tag("main")]), D.tag("a")
    )
    base = F.col("base_url")
    candidate = D.attr(
        D.first(
            F.filter(
                content_links,
                lambda a: (F.coalesce(D.attr(a, "href"), F.lit("")) != "")
                & ~F.contains(D.attr(a, "href"), F.lit("/mod/url/view.php"))
                & ~F.contains(D.attr(a, "href"), F.lit("/login/"))
                & ~D.attr(a, "href").startswith("/")
                & ~F.startswith(D.attr(a, "href"), base),
            )
        ),
        "href",
    )
    found = F.coalesce(F.when(workaround != "", absolute_url(base, workaround)), candidate)
    description = D.cascade_text(nodes, [D.cls("activity-description"), D.cls("box", "generalbox"), D.id_is("intro")])
    external = F.when(redirect, location).when(_ok(), found)
    return df.select(
        *keep,
        F.when(redirect, F.concat(F.lit("URL "), F.col("cmid").cast("string"))).otherwise(_title(nodes, "URL")).alias("title"),
        external.alias("external_url"),
        F.when(_ok() & ~redirect, F.nullif(description, F.lit(""))).alias("description"),
        (~redirect & external.isNull()).alias("parser_degraded"),
    )


def extract_resource(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """File behind a resource activity.

    A redirect gives its target as download url and nothing else.  A page gives the
    first ``a[href*=pluginfile.php]``, else the first ``a[href*=forcedownload]``; the
    name comes from the url, the size from the first resource or file-details block;
    degraded iff neither link nor description was found, or on any other status."""
    nodes, status, base = F.col("nodes"), F.col("status"), F.col("base_url")
    location = F.col("headers")["location"]
    redirect = status.between(300, 399) & (F.coalesce(location, F.lit("")) != "")

    def link(part: str) -> Column:
        hit = D.first(F.filter(nodes, D.tag("a") & D.attr_contains("href", part)))
        return D.attr(hit, "href")

    section = D.node_text(nodes, D.first(F.filter(nodes, D.cls("resourcecontent") | D.cls("resourceworkaround") | D.cls("filedetails"))))
    found = df.select(
        *keep, "status", "cmid", redirect.alias("_redirect"),
        F.when(redirect, absolute_url(base, location)).when(_ok(), absolute_url(base, F.coalesce(link("pluginfile.php"), link("forcedownload")))).alias("download_url"),
        F.when(_ok(), file_size_text(section)).alias("filesize"),
        F.when(_ok(), F.nullif(D.cascade_text(nodes, [D.cls("activity-description"), D.cls("box", "generalbox"), D.id_is("intro")]), F.lit(""))).alias("description"),
        F.when(_ok(), D.first_text(nodes, HEADING)).alias("_h"),
    )
    return found.select(
        *keep,
        F.coalesce(F.nullif("_h", F.lit("")), F.concat(F.lit("Resource "), F.col("cmid").cast("string"))).alias("title"),
        F.when(_ok(), filename_from_url(F.col("download_url"))).alias("filename"),
        "filesize", "download_url", "description",
        (~F.col("_redirect") & F.col("download_url").isNull() & F.col("description").isNull()).alias("parser_degraded"),
    )


# Labels of the rating status table and the fields they fill.
RATING_LABELS = {
    "rating ends at": "deadline",
    "time remaining": "time_remaining",
    "estimated publication date": "publication_date",
    "your allocation": "allocation",
}
RATING_LISTS = ("your rating", "rateable choices")
RATING_MARKUP = D.cls("choicestatustable") | D.cls("choicesummarytable") | D.id_is("mod_ratingallocateshowoptions")


def extract_rating(df: DataFrame, keep: tuple[str, ...] = ("page_key",)) -> DataFrame:
    """Rating allocation, one row per page.

    Label/value rows of the status tables (last wins), the list of choices from the
    options table or else from the last non-empty list cell, and ``error`` (Q2) where a
    2xx page shows none of the known markup and nothing was found."""
    nodes = F.col("nodes")
    tables = D.cls("choicestatustable") | D.cls("choicesummarytable")
    cells = D.let(
        F.transform(D.select_within(nodes, tables, D.tag("tr")), lambda tr: D.find(nodes, tr, D.tag("td"))),
        label=lambda c: F.lower(D.node_text(nodes, D.first(c))), value=lambda c: F.get(c, 1),
    )
    option_rows = D.select_within(nodes, D.id_is("mod_ratingallocateshowoptions") | (D.tag("table") & D.cls("ratingallocate_choices_table")), D.tag("tbody"))
    located = df.select(
        *keep, "status", "cmid", "nodes", F.filter(cells, lambda c: F.size(c["_"]) >= 2).alias("_cells"),
        F.flatten(F.transform(option_rows, lambda b: D.children(nodes, b, D.tag("tr")))).alias("_options"),
        F.coalesce(F.exists(nodes, RATING_MARKUP), F.lit(False)).alias("_known"),
        F.transform(D.select_within(nodes, D.cls("activity-header"), D.tag("div")), lambda d: D.node_text(nodes, d)).alias("_dates"),
    )

    def items(cell: Column) -> Column:
        lis = F.filter(D.find(nodes, cell["value"], D.tag("li")), lambda li: D.parent_of(nodes, li)["tag"] == "ul")
        lines = F.filter(F.transform(lis, lambda li: D.node_text(nodes, li)), lambda t: t != "")

        def entry(t: Column) -> Column:
            title, rating = split_choice_line(t)
            return _choice(title, None, None, F.when(cell["label"] == "your rating", rating))

        return F.transform(lines, entry)

    def option(tr: Column) -> Column:
        tds = D.find(nodes, tr, D.tag("td"))
        text = lambda i: F.coalesce(D.node_text(nodes, F.get(tds, i)), F.lit(""))
        return _choice(text(0), F.nullif(text(1), F.lit("")), js_parse_int(text(2)), None)

    def value(label: str) -> Column:
        return D.last(F.filter(F.col("_values"), lambda v: (v["label"] == label) & (v["text"] != "")))["text"]

    staged = located.select(
        *keep, "status", "cmid", "_known",
        D.first_text(nodes, HEADING).alias("_h"),
        F.nullif(D.cascade_text(nodes, DESCRIPTION), F.lit("")).alias("description"),
        F.nullif(F.trim(F.regexp_extract(D.first(F.filter("_dates", lambda t: t.rlike(r"(?i)^Closed\s*:?\s*.+$"))), r"(?i)^Closed\s*:?\s*(.+)$", 1)), F.lit("")).alias("_closed"),
        F.transform("_cells", lambda c: F.struct(c["label"].alias("label"), D.node_text(nodes, c["value"]).alias("text"))).alias("_values"),
        D.last(F.filter(F.transform(F.filter("_cells", lambda c: c["label"].isin(*RATING_LISTS)), items), lambda x: F.size(x) > 0)).alias("_listed"),
        F.filter(F.transform("_options", option), lambda o: o["title"] != "").alias("_table"),
    )
    none = F.array().cast("array<struct<title:string,description:string,max_size:bigint,user_rating:string>>")
    found = staged.select(
        *keep, "status", "cmid", "_known", "_h", "description",
        *[(F.coalesce(value(label), F.col("_closed")) if name == "deadline" else value(label)).alias(name) for label, name in RATING_LABELS.items()],
        F.when(F.size("_table") > 0, F.col("_table")).otherwise(F.coalesce("_listed", none)).alias("choices"),
    )
    fields = ["description", *RATING_LABELS.values()]
    anything = F.coalesce(*fields).isNotNull() | (F.size("choices") > 0)
    return found.select(
        *keep,
        F.when(_ok() & (F.col("_h") != ""), F.col("_h")).otherwise(F.concat(F.lit("RatingAllocate "), F.col("cmid").cast("string"))).alias("title"),
        *[F.when(_ok(), F.col(c)).alias(c) for c in fields],
        F.when(_ok(), F.col("choices")).otherwise(none).alias("choices"),
        (~_ok() | ~anything).alias("parser_degraded"),
        error_record(
            F.when(_ok() & ~anything & ~F.col("_known"), F.lit("parse_error")), F.lit("ratingallocate"), F.lit(".choicestatustable"), F.col("status"),
            message=F.lit("No status table or options table found."),
        ).alias("error"),
    )


def _choice(title, description, max_size, rating) -> Column:
    null = F.lit(None)
    return F.struct(
        title.alias("title"), (null if description is None else description).cast("string").alias("description"),
        (null if max_size is None else max_size).cast("bigint").alias("max_size"), (null if rating is None else rating).cast("string").alias("user_rating"),
    )
