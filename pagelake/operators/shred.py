"""Shred an HTML column into a pre-order node array.

This is the only Python stage on the page path.  It runs as ``mapInArrow`` so
pages travel in Arrow batches, every page is parsed once, and nothing is
shuffled.  All selectors and extractions downstream are Catalyst expressions
over the array it produces.

Node layout (one struct per element or text run, in document order):

    pre        index of the node in the array (== its pre-order number)
    post       largest ``pre`` inside its subtree (== pre for leaves)
    parent     ``pre`` of the parent element, -1 for the root
    depth      0 for the root
    tag        lower-case tag name, ``#text`` for text runs,
               ``#data`` for the raw text of script/style
    attrs      attribute map (first occurrence wins, values decoded)
    class_tokens  whitespace-split ``class``
    in_chrome  node is, or lies inside, page chrome (nav, header, footer,
               .navbar, #nav-drawer, [role=navigation], script, style, noscript)
    text       decoded text for ``#text`` nodes, else null
    data       raw text for ``#data`` nodes, else null
    anc        indices of the node's ancestors, root first; null for nodes deeper than
               ``ANC_DEPTH``, whose ancestors are searched among all earlier nodes instead

Because ``pre`` equals the array index, the subtree of node ``a`` is the
contiguous slice ``nodes[a.pre+1 .. a.post]``; descendant queries never scan
the whole page.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NODE_TYPE = T.StructType(
    [
        T.StructField("pre", T.IntegerType(), False),
        T.StructField("post", T.IntegerType(), False),
        T.StructField("parent", T.IntegerType(), False),
        T.StructField("depth", T.IntegerType(), False),
        T.StructField("tag", T.StringType(), False),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType(), True), False),
        T.StructField("class_tokens", T.ArrayType(T.StringType(), False), False),
        T.StructField("in_chrome", T.BooleanType(), False),
        T.StructField("text", T.StringType(), True),
        T.StructField("data", T.StringType(), True),
        T.StructField("anc", T.ArrayType(T.IntegerType(), False), True),
    ]
)
NODES_TYPE = T.ArrayType(NODE_TYPE, False)
ANC_DEPTH = 64  # longer ancestor lists would grow with the square of a chain of nested elements

_ARROW_NODE = pa.struct(
    [
        pa.field("pre", pa.int32(), False),
        pa.field("post", pa.int32(), False),
        pa.field("parent", pa.int32(), False),
        pa.field("depth", pa.int32(), False),
        pa.field("tag", pa.string(), False),
        pa.field("attrs", pa.map_(pa.string(), pa.string()), False),
        pa.field("class_tokens", pa.list_(pa.field("element", pa.string(), False)), False),
        pa.field("in_chrome", pa.bool_(), False),
        pa.field("text", pa.string()),
        pa.field("data", pa.string()),
        pa.field("anc", pa.list_(pa.field("element", pa.int32(), False))),
    ]
)

# Fixed HTML vocabulary (HTML Living Standard, tree construction).
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link meta param source track wbr".split()
)
RAW_TEXT_TAGS = frozenset(["script", "style"])
HEAD_TAGS = frozenset(
    "base basefont bgsound link meta noframes script style template title noscript".split()
)
CLOSES_P = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p
    pre section search summary table ul li dd dt listing plaintext xmp""".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPE_BOUNDARY = frozenset(
    "applet caption html table td th marquee object template button".split()
)
SPECIAL = frozenset(
    """address applet area article aside base basefont bgsound blockquote body br button
    caption center col colgroup dd details dir div dl dt embed fieldset figcaption figure
    footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe img input
    keygen li link listing main marquee menu meta nav noembed noframes noscript object ol p
    param plaintext pre script search section select source style summary table tbody td
    template textarea tfoot th thead title tr track ul wbr xmp""".split()
)
CHROME_TAGS = frozenset("nav header footer script style noscript".split())
TABLE_SECTIONS = frozenset(["tbody", "thead", "tfoot"])
TABLE_BOUNDARY = frozenset(["html", "table", "template"])
# End tags that are searched in a scope, with the elements that bound it.
SCOPED_ENDS: dict[str, frozenset[str]] = {
    **dict.fromkeys(
        """address article aside blockquote button center details dialog dir div dl fieldset figcaption figure
        footer form header hgroup listing main menu nav ol pre search section summary ul applet marquee object
        dd dt h1 h2 h3 h4 h5 h6""".split(),
        SCOPE_BOUNDARY,
    ),
    "li": SCOPE_BOUNDARY | {"ol", "ul"},
    "p": SCOPE_BOUNDARY,
    **dict.fromkeys("table caption tbody thead tfoot tr td th".split(), TABLE_BOUNDARY),
}


# Plain markup: lower-case tags, double-quoted attributes, the five basic entities in them, simple comments.
# html.parser reads such a page tag by tag with the same outcome; any other page is left to it.
_MARKUP = re.compile(r"<([^<>]*)>")
_TAG = re.compile(r'(/?)([a-z][a-z0-9]*)((?: [a-z][a-z0-9_-]*(?:="(?:[^"<>&]|&(?:amp|lt|gt|quot|#39);)*")?)*) ?(/?)')
_ATTR = re.compile(r' ([a-z][a-z0-9_-]*)(?:="([^"]*)")?')
_SKIPPED = re.compile(r"!(?:(?i:doctype) html|--[ a-zA-Z0-9](?:[^<>-]|-(?!-))*--)")
_OPEN_TITLE = re.compile(r"<title[^>]*>[^<]*(?!</title>)(?:<|\Z)")
#: the standard parser reads the content of these by rules of their own
_NOT_PLAIN = frozenset("script style textarea xmp iframe noembed noframes noscript plaintext svg math".split())
_SKIP = ("", "", None, False)
_KNOWN_TAGS = 8192


def _described(tag: str, attrs) -> tuple[list[tuple[str, str]], list[str], bool]:
    """(attributes, class tokens, whether the element itself is page chrome) of a start tag."""
    seen: dict[str, str] = {}
    for k, v in attrs:
        if k not in seen:
            seen[k] = "" if v is None else v
    tokens = seen["class"].split() if "class" in seen else []
    own = tag in CHROME_TAGS or "navbar" in tokens or seen.get("id") == "nav-drawer" or seen.get("role") == "navigation"
    return list(seen.items()), tokens, own


_BARE = _described("", ())


def _read_tag(raw: str):
    """('/' or '', name, description, self-closing) of the plain tag ``<raw>``; null if it is not plain."""
    m = _TAG.fullmatch(raw)
    if m is None:
        return _SKIP if _SKIPPED.fullmatch(raw) else None
    end, tag, attrs, slash = m.groups()
    if end:
        return None if attrs or slash or raw != "/" + tag else (end, tag, None, False)
    if tag in _NOT_PLAIN:
        return None
    return end, tag, _described(tag, [(k, unescape(v) if "&" in v else v) for k, v in _ATTR.findall(attrs)]), bool(slash)


_tags: dict[str, tuple] = {}  # descriptions of the tags read last, as templates repeat them


def _plain_tags(raws: list[str]) -> list[tuple] | None:
    """Descriptions of a page's tags; null if one is not plain."""
    if len(_tags) > _KNOWN_TAGS:
        _tags.clear()
    out = []
    for raw in raws:
        known = _tags.get(raw)
        if known is None:
            known = _read_tag(raw)
            if known is None:
                return None
            _tags[raw] = known
        out.append(known)
    return out


class _TreeBuilder(HTMLParser):
    """Builds flat node columns for one page with HTML5-style implied tags."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.post: list[int] = []
        self.attrs: list[list[tuple[str, str]]] = []
        self.cls: list[list[str]] = []
        self.chrome: list[bool] = []
        self.text: list[str | None] = []
        self.data: list[str | None] = []
        self.stack: list[int] = []
        self.html_idx = -1
        self.head_idx = -1
        self.body_idx = -1
        self.has_p = False
        self.error: str | None = None

    # -- node creation -------------------------------------------------
    def _new(self, tag: str, known=_BARE, text=None, data=None) -> int:
        idx = len(self.tag)
        par = self.stack[-1] if self.stack else -1
        self.tag.append(tag)
        self.parent.append(par)
        self.depth.append(self.depth[par] + 1 if par >= 0 else 0)
        self.post.append(idx)
        items, tokens, own = known
        self.attrs.append(items)
        self.cls.append(tokens)
        self.chrome.append(own or (par >= 0 and self.chrome[par]))
        self.text.append(text)
        self.data.append(data)
        return idx

    def _open(self, tag: str, known=_BARE) -> int:
        idx = self._new(tag, known)
        self.stack.append(idx)
        return idx

    def _pop(self) -> None:
        idx = self.stack.pop()
        self.post[idx] = len(self.tag) - 1

    def _pop_until(self, idx: int) -> None:
        while self.stack:
            top = self.stack[-1]
            self._pop()
            if top == idx:
                return

    def _find_in_scope(self, tag: str, boundary=SCOPE_BOUNDARY) -> int:
        for idx in reversed(self.stack):
            t = self.tag[idx]
            if t == tag:
                return idx
            if t in boundary:
                return -1
        return -1

    # -- document skeleton ---------------------------------------------
    def _ensure_html(self) -> None:
        if self.html_idx < 0:
            self.html_idx = self._open("html")

    def _ensure_body(self) -> None:
        self._ensure_html()
        if self.body_idx >= 0:
            return
        if self.head_idx >= 0 and self.head_idx in self.stack:
            self._pop_until(self.head_idx)
        while self.stack and self.stack[-1] != self.html_idx:
            self._pop()
        self.body_idx = self._open("body")

    def _top_tag(self) -> str | None:
        return self.tag[self.stack[-1]] if self.stack else None

    def read_plain(self, html: str) -> bool:
        """Read the page without the standard parser if all its markup is plain; false, and nothing read, if not."""
        parts = _MARKUP.split(html)
        if html.count("<") != len(parts) // 2 or ("<title" in html and _OPEN_TITLE.search(html)):
            return False
        tags = _plain_tags(parts[1::2])
        if tags is None:
            return False
        texts = parts[::2]
        if texts[0]:
            self.handle_data(unescape(texts[0]) if "&" in texts[0] else texts[0])
        for (end, tag, known, slash), text in zip(tags, texts[1:]):
            if known is not None:
                if slash:
                    self._start_end(tag, known)
                else:
                    self._start(tag, known)
                    if tag in VOID_TAGS:
                        self._pop()
            elif end:
                self.handle_endtag(tag)
            if text:
                self.handle_data(unescape(text) if "&" in text else text)
        return True

    # -- parser callbacks ------------------------------------------------
    def handle_starttag(self, tag, attrs):
        self._start(tag, _described(tag, attrs))
        if tag in VOID_TAGS:
            self._pop()

    def handle_startendtag(self, tag, attrs):
        self._start_end(tag, _described(tag, attrs))

    def _start_end(self, tag, known):
        self._start(tag, known)
        if tag in VOID_TAGS or self._top_tag() == tag:
            self._pop()

    def _start(self, tag, known):
        if tag == "html":
            self._ensure_html()
            return
        if tag == "head":
            self._ensure_html()
            if self.head_idx < 0 and self.body_idx < 0:
                self.head_idx = self._open("head", known)
            return
        if tag == "body":
            if self.body_idx < 0:
                self._ensure_html()
                if self.head_idx >= 0 and self.head_idx in self.stack:
                    self._pop_until(self.head_idx)
                while self.stack and self.stack[-1] != self.html_idx:
                    self._pop()
                self.body_idx = self._open("body", known)
            return
        if self.body_idx < 0:
            if tag in HEAD_TAGS:
                self._ensure_html()
                if self.head_idx < 0:
                    self.head_idx = self._open("head")
                elif self.head_idx not in self.stack:
                    # content after </head> but before <body> still belongs to head
                    self.stack.append(self.head_idx)
            else:
                self._ensure_body()
        self._implied_ends(tag)
        self._open(tag, known)
        if tag == "p":
            self.has_p = True

    def _implied_ends(self, tag):
        if self.has_p and tag in CLOSES_P:
            p = self._find_in_scope("p")
            if p >= 0:
                self._pop_until(p)
        if tag in HEADINGS and self._top_tag() in HEADINGS:
            self._pop()
        if tag == "li":
            self._close_list_item(("li",))
        elif tag in ("dd", "dt"):
            self._close_list_item(("dd", "dt"))
        elif tag == "option":
            if self._top_tag() == "option":
                self._pop()
        elif tag == "optgroup":
            if self._top_tag() == "option":
                self._pop()
            if self._top_tag() == "optgroup":
                self._pop()
        elif tag in TABLE_SECTIONS:
            self._clear_to(("table",))
        elif tag == "tr":
            self._clear_to(("tbody", "thead", "tfoot", "table"))
            if self._top_tag() == "table":
                self._open("tbody")
        elif tag in ("td", "th"):
            self._clear_to(("tr", "tbody", "thead", "tfoot", "table"))
            if self._top_tag() == "table":
                self._open("tbody")
            if self._top_tag() in TABLE_SECTIONS:
                self._open("tr")

    def _close_list_item(self, names):
        for idx in reversed(self.stack):
            t = self.tag[idx]
            if t in names:
                self._pop_until(idx)
                return
            if t in SPECIAL and t not in ("address", "div", "p"):
                return

    def _clear_to(self, targets):
        """Pop open cells/rows back to the nearest table context, if any."""
        if self._top_tag() in targets:
            return
        table = self._find_in_scope("table", boundary=frozenset(["html", "template"]))
        if table < 0:
            return
        while self.stack and self.tag[self.stack[-1]] not in targets:
            if self.stack[-1] == table:
                break
            self._pop()

    def handle_endtag(self, tag):
        if tag in VOID_TAGS or tag in ("html", "body"):
            return
        if tag == "head":
            if self.head_idx >= 0 and self.head_idx in self.stack:
                self._pop_until(self.head_idx)
            return
        if self._top_tag() == tag:
            self._pop()
            return
        if tag in SCOPED_ENDS:
            # open elements inside are closed with it, unless a scope boundary lies between
            boundary = SCOPED_ENDS[tag]
            for idx in reversed(self.stack):
                t = self.tag[idx]
                if t == tag or (tag in HEADINGS and t in HEADINGS):
                    self._pop_until(idx)
                    return
                if t in boundary:
                    return
            return
        for idx in reversed(self.stack):
            t = self.tag[idx]
            if t == tag:
                self._pop_until(idx)
                return
            if t in SPECIAL:
                return

    def handle_data(self, data):
        if not data:
            return
        top = self._top_tag()
        if top in RAW_TEXT_TAGS:
            self._new("#data", data=data)
            return
        if self.body_idx < 0 and (top is None or top in ("html", "head")):
            if not data.strip():
                return
            self._ensure_body()
        last = len(self.tag) - 1
        if last >= 0 and self.tag[last] == "#text" and self.parent[last] == (
            self.stack[-1] if self.stack else -1
        ):
            self.text[last] += data
        else:
            self._new("#text", text=data)

    def close(self):
        super().close()
        while self.stack:
            self._pop()


def parse_html(html: str | None) -> _TreeBuilder:
    """Parse one page; never raises: a broken page yields what was read and says so in ``error``."""
    tb = _TreeBuilder()
    if html:
        try:
            if not tb.read_plain(html):
                tb.feed(html)
            tb.close()
        except Exception as e:  # one malformed page must not fail the job
            tb.error = f"{type(e).__name__}: {e}"
            while tb.stack:
                tb._pop()
    return tb


OUT_BYTES = 4 << 20


def _spans(column) -> list[tuple[int, int]]:
    """Row ranges of about ``OUT_BYTES`` of markup: one output batch each, so that a task never holds the
    nodes of a whole input batch.  A page is never cut."""
    out, lo, size = [], 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if size and size + n > OUT_BYTES:
            out.append((lo, i))
            lo, size = i, 0
        size += n
    return [*out, (lo, len(column))] if len(column) else []


def _ancestors(parents: list[int]) -> list[list[int] | None]:
    """Ancestors of every node, root first; null beyond ``ANC_DEPTH``.  Siblings share one list."""
    below: dict[int, list[int] | None] = {-1: []}
    out = []
    for parent in parents:
        path = below.get(parent, ())
        if path == ():
            up = out[parent]
            path = None if up is None or len(up) >= ANC_DEPTH else [*up, parent]
            below[parent] = path
        out.append(path)
    return out


def _nodes_array(htmls) -> tuple[pa.Array, pa.Array]:
    """Parse pages into one Arrow ``list<struct>`` column and one of parse errors."""
    offsets = [0]
    errors: list[str | None] = []
    cols: dict[str, list] = {k: [] for k in ("pre", "post", "parent", "depth", "tag", "chrome", "text", "data")}
    attr_offsets = [0]
    attr_keys: list[str] = []
    attr_vals: list[str] = []
    cls_offsets = [0]
    cls_vals: list[str] = []
    anc_offsets = [0]
    anc_vals: list[int] = []
    anc_null: list[bool] = []
    for html in htmls:
        tb = parse_html(html)
        errors.append(tb.error)
        n = len(tb.tag)
        cols["pre"].extend(range(n))
        cols["post"].extend(tb.post)
        cols["parent"].extend(tb.parent)
        cols["depth"].extend(tb.depth)
        cols["tag"].extend(tb.tag)
        cols["chrome"].extend(tb.chrome)
        cols["text"].extend(tb.text)
        cols["data"].extend(tb.data)
        for path in _ancestors(tb.parent):
            if path:
                anc_vals.extend(path)
            anc_null.append(path is None)
            anc_offsets.append(len(anc_vals))
        for items in tb.attrs:
            for k, v in items:
                attr_keys.append(k)
                attr_vals.append(v)
            attr_offsets.append(len(attr_keys))
        for toks in tb.cls:
            cls_vals.extend(toks)
            cls_offsets.append(len(cls_vals))
        offsets.append(offsets[-1] + n)
    attrs = pa.MapArray.from_arrays(
        pa.array(attr_offsets, pa.int32()), pa.array(attr_keys, pa.string()), pa.array(attr_vals, pa.string())
    )
    cls = pa.ListArray.from_arrays(pa.array(cls_offsets, pa.int32()), pa.array(cls_vals, pa.string()))
    anc = pa.ListArray.from_arrays(pa.array(anc_offsets, pa.int32()), pa.array(anc_vals, pa.int32()), mask=pa.array(anc_null, pa.bool_()))
    structs = pa.StructArray.from_arrays(
        [
            pa.array(cols["pre"], pa.int32()),
            pa.array(cols["post"], pa.int32()),
            pa.array(cols["parent"], pa.int32()),
            pa.array(cols["depth"], pa.int32()),
            pa.array(cols["tag"], pa.string()),
            attrs,
            cls.cast(_ARROW_NODE.field("class_tokens").type),
            pa.array(cols["chrome"], pa.bool_()),
            pa.array(cols["text"], pa.string()),
            pa.array(cols["data"], pa.string()),
            anc.cast(_ARROW_NODE.field("anc").type),
        ],
        fields=list(_ARROW_NODE),
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs), pa.array(errors, pa.string())


def shred_html(df: DataFrame, html_col: str = "body", out_col: str = "nodes", keep_html: bool = True,
               partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` (the node array) to every row of ``df``.

    Filter and project ``df`` *before* calling this: Catalyst cannot push
    predicates or column pruning through a Python stage.

    Rows stay in the partitions they have.  A caller whose input is one small
    file may ask for ``partitions`` (a round-robin exchange of the pages).

    ``parse_error`` tells why a page was read only in part; null for all others.
    """
    if partitions is not None:
        df = df.repartition(partitions)
    in_fields = [f for f in df.schema.fields if keep_html or f.name != html_col]
    out_schema = T.StructType(in_fields + [T.StructField(out_col, NODES_TYPE, False), T.StructField("parse_error", T.StringType())])
    keep = [f.name for f in in_fields]

    def run(batches):
        for batch in batches:
            for lo, hi in _spans(batch.column(html_col)):
                part = batch.slice(lo, hi - lo)
                nodes, errors = _nodes_array(part.column(html_col).to_pylist())
                arrays = [*(part.column(name) for name in keep), nodes, errors]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, out_col, "parse_error"])

    return df.mapInArrow(run, out_schema)
