"""URL, path, header and file-name functions.

All are native expressions.  ``parse_url`` raises on malformed input under
ANSI mode, so URL parts are taken with anchored regexes instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dom import bind, nonempty
from .text import JS_WS_CLASS, _c

SCHEME_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"
ORIGIN_RE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)"
PATH_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"
HOST_RE = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^@/?#]*@)?([^/?#:]*)"
PROTOCOL_RE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)"

# The scope and file-path rules of the tool layer.
SAFE_PATH_RE = r"^/(mod|course|calendar|my|blocks)(/|$)"
PLUGINFILE_PATH_RE = r"^/(?:webservice/)?(?:token)?pluginfile\.php/"


def origin(url) -> Column:
    return F.regexp_extract(_c(url), ORIGIN_RE, 1)


def url_path(url) -> Column:
    return F.regexp_extract(_c(url), PATH_RE, 1)


def url_host(url) -> Column:
    return F.lower(F.regexp_extract(_c(url), HOST_RE, 1))


def url_protocol(url) -> Column:
    return F.lower(F.regexp_extract(_c(url), PROTOCOL_RE, 1))


def percent_encode(x, keep: str = r"[!-~]") -> Column:
    """UTF-8 percent-encode every character not matching ``keep`` (one char class)."""
    def encoded(s):
        return F.array_join(
            F.transform(
                F.split(s, ""),
                lambda ch: F.when(ch.rlike("^" + keep + "$"), ch).otherwise(
                    F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")
                ),
            ),
            "",
        )

    return bind(_c(x), lambda s: F.when(s.rlike(r"\A" + keep + r"*\z"), s).otherwise(encoded(s)))


# WHATWG percent-encode sets, as "characters kept" classes.
_PATH_KEEP = r"[!$-;=@-_a-z|~]"        # printable ASCII minus space " # < > ? ` { }
_QUERY_KEEP = r"[!$-&(-;=?-~]"         # minus space " # < > '
_FRAGMENT_KEEP = r"[!#-;=?-_a-~]"      # minus space " < > `
# A root-relative reference that needs neither encoding nor dot removal: it goes behind the origin as it is.
_PLAIN_REF = r"\A/(?!/)" + _PATH_KEEP + r"*(?:\?" + _QUERY_KEEP + r"*)?\z"


def remove_dot_segments(path) -> Column:
    """RFC 3986 dot-segment removal on an absolute path (``/a/./b/../c`` -> ``/a/c``)."""
    return bind(_c(path), lambda p: F.when(p.startswith("/") & ~F.contains(p, F.lit("/.")), p).otherwise(_without_dots(p)))


def _without_dots(path: Column) -> Column:
    segs = F.slice(F.split(path, "/"), F.lit(2), F.size(F.split(path, "/")))
    kept = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    last_seg = F.element_at(F.split(path, "/"), -1)
    tail = F.when(last_seg.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(joined == "/", joined).otherwise(F.concat(joined, tail))


def _split_ref(ref: Column):
    path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    query = F.regexp_extract(ref, r"^[^?#]*(\?[^#]*)?", 1)
    frag = F.regexp_extract(ref, r"^[^#]*(#.*)?$", 1)
    return path, query, frag


def absolute_url(base, href) -> Column:
    """resolve ``href`` against ``base + '/'`` the way a browser does.

    Absolute, scheme-relative, root-relative, query-only, fragment-only and
    relative references are handled; dot segments are removed; path, query and
    fragment are percent-encoded with the WHATWG sets.  Empty stays empty.
    """
    base = _c(base)
    return bind(F.trim(_c(href)), lambda h: F.when(
        h.rlike(_PLAIN_REF) & ~F.contains(h, F.lit("/.")), F.concat(origin(F.concat(base, F.lit("/"))), h)
    ).otherwise(_resolved(base, h)))


def _resolved(base: Column, href: Column) -> Column:
    b = F.concat(base, F.lit("/"))
    b_origin = origin(b)
    b_path = url_path(b)
    b_dir = F.regexp_extract(b_path, r"^(.*/)", 1)
    b_query = F.regexp_extract(b, r"^[^?#]*(\?[^#]*)?", 1)
    h_path, h_query, h_frag = _split_ref(href)

    abs_org = F.lower(origin(href))
    abs_path = F.when(url_path(href) == "", F.lit("/")).otherwise(url_path(href))
    abs_query = F.regexp_extract(href, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*[^?#]*(\?[^#]*)?", 1)
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1)
    net = F.concat(scheme, href)  # a scheme-relative reference takes the base scheme
    net_org = F.lower(origin(net))
    net_path = F.when(url_path(net) == "", F.lit("/")).otherwise(url_path(net))

    # (origin, path, query, fragment) per reference form; encoded once below.
    cases = [
        (href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://"), (abs_org, abs_path, abs_query, h_frag)),
        (href.startswith("//"), (net_org, net_path, h_query, h_frag)),
        (href.startswith("/"), (b_origin, h_path, h_query, h_frag)),
        (href.startswith("?"), (b_origin, b_path, h_query, h_frag)),
        (href.startswith("#"), (b_origin, b_path, b_query, h_frag)),
    ]
    rel = (b_origin, F.concat(b_dir, h_path), h_query, h_frag)

    def pick(i):
        out = F.when(cases[0][0], cases[0][1][i])
        for cond, parts in cases[1:]:
            out = out.when(cond, parts[i])
        return out.otherwise(rel[i])

    built = F.concat(
        pick(0),
        percent_encode(remove_dot_segments(pick(1)), _PATH_KEEP),
        percent_encode(pick(2), _QUERY_KEEP),
        percent_encode(pick(3), _FRAGMENT_KEEP),
    )
    other_scheme = href.rlike(SCHEME_RE) & ~href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://")
    return F.when(href.isNull() | (href == ""), href).when(other_scheme, href).otherwise(built)


def course_id_from_url(url) -> Column:
    """``course=``/``courseid=`` anywhere, else ``id=`` only on ``/course/view.php``."""
    url = _c(url)
    c1 = nonempty(F.regexp_extract(url, r"[?&](?:course|courseid)=(\d+)", 1))
    c2 = F.when(url.rlike(r"/course/view\.php"), F.regexp_extract(url, r"[?&]id=(\d+)", 1))
    return F.coalesce(c1, c2).try_cast("bigint")


def cmid_from_url(url) -> Column:
    """first ``[?&]id=<digits>``; callers drop 0."""
    return F.regexp_extract(_c(url), r"[?&]id=(\d+)", 1).try_cast("bigint")  # null for ''


def modtype_from_href(href) -> Column:
    """``/mod/<type>/``."""
    return nonempty(F.regexp_extract(_c(href), r"/mod/([a-z_]+)/", 1))


def modtype_from_class(cls_attr) -> Column:
    """``modtype_<type>`` token in a class attribute."""
    return F.nullif(F.regexp_extract(_c(cls_attr), r"\bmodtype_([a-z_]+)", 1), F.lit(""))


def modtype_from_component(component) -> Column:
    """``mod_assign`` -> ``assign``; other non-empty values are kept."""
    c = F.coalesce(_c(component), F.lit(""))
    return F.when(c.startswith("mod_"), F.substr(c, F.lit(5))).when(c != "", c)


def uri_decode(x) -> Column:
    """``decodeURIComponent``: ``+`` stays literal; a bad escape gives null."""
    return F.try_url_decode(F.replace(_c(x), F.lit("+"), F.lit("%2B")))


def filename_from_url(url) -> Column:
    """decoded last path segment, null if empty or undecodable."""
    last = F.element_at(F.split(url_path(url), "/"), -1)
    return F.nullif(uri_decode(last), F.lit(""))


def _strip_quotes(x: Column) -> Column:
    t = F.trim(x)
    quoted = (F.length(t) >= 2) & (
        (t.startswith('"') & t.endswith('"')) | (t.startswith("'") & t.endswith("'"))
    )
    return F.when(quoted, F.regexp_extract(t, r"(?s)^.(.*).$", 1)).otherwise(t)


def filename_from_disposition(header) -> Column:
    """RFC 5987 ``filename*`` wins over ``filename``; quotes stripped; a bad
    escape keeps the raw value."""
    h = _c(header)
    enc = F.regexp_extract(h, r"(?i)filename\*\s*=\s*(?:UTF-8'[^']*')?([^;\r\n]+)", 1)
    plain = F.regexp_extract(h, r"(?i)filename\s*=\s*([^;\r\n]+)", 1)
    enc_s = _strip_quotes(enc)
    return (
        F.when(h.isNull(), F.lit(None).cast("string"))
        .when(enc != "", F.coalesce(uri_decode(enc_s), enc_s))
        .when(plain != "", _strip_quotes(plain))
    )


def path_verdict(path) -> Column:
    """``STRUCT<path STRING, reason STRING>`` — the normalised in-scope path
    (query kept untouched) or the reason it is rejected."""
    p = _c(path)
    raw = F.regexp_extract(p, r"^([^?]*)", 1)
    query = F.regexp_extract(p, r"^[^?]*(\?.*)?$", 1)
    traversal = raw.rlike(r"(?i)%2e") | raw.rlike(r"(^|/)\.\.(/|$)")
    decoded = uri_decode(raw)
    is_abs = decoded.startswith("/")
    segs = F.filter(F.split(decoded, "/"), lambda s: (s != "") & (s != "."))
    joined = F.array_join(segs, "/")
    trailing = decoded.endswith("/") & (joined != "")
    norm = F.concat(F.when(is_abs, F.lit("/")).otherwise(F.lit("")), joined, F.when(trailing, F.lit("/")).otherwise(F.lit("")))
    norm = F.when(norm == "", F.lit(".")).otherwise(norm)
    reason = (
        F.when(traversal, F.lit("traversal"))
        .when(decoded.isNull(), F.lit("undecodable"))
        .when(~norm.rlike(SAFE_PATH_RE) | F.contains(norm, F.lit("..")), F.lit("out_of_scope"))
    )
    return F.struct(F.when(reason.isNull(), F.concat(norm, query)).alias("path"), reason.alias("reason"))


def file_url_verdict(url, base) -> Column:
    """'ok' or why a download URL is refused: same protocol, same host,
    path below the base path and a ``pluginfile.php`` path."""
    u, b = _c(url), _c(base)
    parsable = u.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#\s]+")
    base_path = F.regexp_replace(url_path(b), "/+$", "")
    path = F.when(url_path(u) == "", F.lit("/")).otherwise(url_path(u))
    under = (base_path == "") | path.startswith(F.concat(base_path, F.lit("/")))
    rel = F.when(base_path == "", path).otherwise(F.substr(path, F.length(base_path) + 1))
    return (
        F.when(~parsable | u.isNull(), F.lit("invalid_url"))
        .when(url_protocol(u) != url_protocol(b), F.lit("protocol_mismatch"))
        .when(url_host(u) != url_host(b), F.lit("host_mismatch"))
        .when(~under | ~rel.rlike(PLUGINFILE_PATH_RE), F.lit("not_pluginfile"))
        .otherwise(F.lit("ok"))
    )


def search_path(query, page, limit) -> Column:
    """``/course/search.php?search=<q>&perpage=<n>[&page=<p>]`` (page 0 omitted),
    form-encoded like ``URLSearchParams``."""
    page = _c(page)
    return F.concat(
        F.lit("/course/search.php?search="),
        F.url_encode(_c(query)),
        F.lit("&perpage="),
        _c(limit).cast("string"),
        F.when(page > 0, F.concat(F.lit("&page="), page.cast("string"))).otherwise(F.lit("")),
    )


def cookie_names(set_cookie) -> Column:
    """cookie names in a joined ``Set-Cookie`` value: distinct, sorted."""
    parts = F.split(_c(set_cookie), r",(?=[^;,]+=)")
    names = F.filter(F.transform(parts, lambda p: F.trim(F.substring_index(p, "=", 1))), lambda n: n != "")
    return F.when(_c(set_cookie).isNull() | (_c(set_cookie) == ""), F.array().cast("array<string>")).otherwise(
        F.array_sort(F.array_distinct(names))
    )


def normalize_headers(headers) -> Column:
    """Lower-case keys, drop null values; a later duplicate key wins."""
    h = _c(headers)
    entries = F.transform(
        F.map_entries(F.map_filter(h, lambda k, v: v.isNotNull())),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    last_wins = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda f: f["key"] == e["key"]),
    )
    return F.map_from_entries(last_wins)


def join_header_values(values) -> Column:
    """S2 for multi-valued headers: ``ARRAY<STRING>`` -> ``'a, b'``."""
    return F.array_join(_c(values), ", ")


__all__ = [n for n in dir() if not n.startswith("_")] + ["JS_WS_CLASS"]
