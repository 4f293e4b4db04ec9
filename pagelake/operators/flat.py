"""D1 for many pages at once: the nodes of a batch as flat numpy columns, and what extractors look for in them.

``read_pages`` gives the same trees as ``shred.parse_html``.  Pages of plain markup whose elements are all closed
where they are meant to be (apart from a left-out ``tbody``) are read together in numpy; any other page goes through
the tree builder.  ``located_html`` emits only what an extractor's ``locate`` finds, as texts and small lists, so
that no node array travels to the JVM; rules, dates, URLs and status stay column expressions behind it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.text import JS_WS_CLASS
from .shred import CLOSES_P, HEAD_TAGS, HEADINGS, SPECIAL, TABLE_SECTIONS, VOID_TAGS, _read_tag, _SKIP, _spans, parse_html

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WS_RUN = "[" + JS_WS_CLASS + "]+"
_START, _END, _LEAF, _NONE, _BAD = 1, 2, 3, 0, 9
_TEXT = ("#text", {}, [])
_ITEM_SCOPE = SPECIAL - {"address", "div", "p"}


def _counts(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(flags, dtype=np.int64)])


def _any(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a flag is set in each range; meant for flags that are rare."""
    at = np.flatnonzero(flags)
    return np.searchsorted(at, ends) > np.searchsorted(at, starts) if len(at) else np.zeros(len(starts), bool)


def _picked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``gathered`` for ascending slices that do not overlap."""
    sizes = np.empty(2 * len(starts) + 1, np.int64)
    sizes[0::2] = np.append(starts, len(data)) - np.append(0, ends)
    sizes[1::2] = ends - starts
    return data[np.repeat(np.arange(len(sizes)) % 2 == 1, sizes)], _counts(ends - starts)


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all slices, where each begins and the last ends)."""
    size = ends - starts
    offs = _counts(size)
    return data[np.repeat(starts - offs[:-1], size) + np.arange(offs[-1])], offs


def _strings(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offs) - 1, pa.py_buffer(np.ascontiguousarray(offs, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def normalized(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    """F1 of every string: runs of white space become one blank, none at the ends."""
    texts = _strings(data, offs)
    if not len(texts):
        return texts
    blank = data == 32
    odd = (data > 127) | ((data < 14) & (data > 8))
    odd[1:] |= blank[1:] & blank[:-1]
    full = offs[1:] > offs[:-1]
    rough = _any(odd, offs[:-1], offs[1:])
    rough[full] |= blank[offs[:-1][full]] | blank[offs[1:][full] - 1]
    if not rough.any():
        return texts
    mask = pa.array(rough)
    clean = pc.utf8_trim(pc.replace_substring_regex(texts.filter(mask), _WS_RUN, " "), " ")
    return pc.replace_with_mask(texts, mask, clean)


class Pages:
    """The nodes of a batch of pages in document order; all indices count over the batch.

    ``first`` has the first node of each page and the number of all, ``kind`` the place of a node's (tag,
    attributes, class tokens) in ``known``; ``data`` has the bytes of all texts, ``offs`` where those of a node begin."""

    def __init__(self, first, parent, post, depth, kind, known, data, offs):
        self.first, self.parent, self.post, self.depth = first, parent, post, depth
        self.kind, self.known, self.data, self.offs = kind, known, data, offs
        self.page = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self._by: dict[tuple[str, str], list[int]] = {}
        for k, (tag, attrs, tokens) in enumerate(known):
            self._by.setdefault(("tag", tag), []).append(k)
            for name in attrs:
                self._by.setdefault(("attr", name), []).append(k)
            for token in dict.fromkeys(tokens):
                self._by.setdefault(("class", token), []).append(k)
        order = np.argsort(depth, kind="stable")
        self._levels = np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []

    def _are(self, kinds: Iterable[int]) -> np.ndarray:
        mask = np.zeros(len(self.known) + 1, bool)
        mask[list(kinds)] = True
        return mask[self.kind]

    def tag(self, *names: str) -> np.ndarray:
        return self._are(k for n in names for k in self._by.get(("tag", n), ()))

    def cls(self, name: str) -> np.ndarray:
        return self._are(self._by.get(("class", name), ()))

    def has(self, name: str, test: Callable[[str], bool] = lambda v: True) -> np.ndarray:
        return self._are(k for k in self._by.get(("attr", name), ()) if test(self.known[k][1][name]))

    def attr(self, nodes: np.ndarray, name: str) -> pa.Array:
        """Attribute values of nodes; null where there is none, also for a node -1."""
        values = pa.array([a.get(name) for _, a, _ in self.known] + [None], pa.large_string())
        kinds = np.full(len(nodes), len(self.known), np.int64)
        kinds[nodes >= 0] = self.kind[nodes[nodes >= 0]]
        return values.take(pa.array(kinds))

    def nearest(self, mask: np.ndarray) -> np.ndarray:
        """The deepest proper ancestor of each node that is in ``mask``, or -1."""
        out = np.full(len(self.parent), -1, np.int64)
        for at in self._levels[1:]:
            up = self.parent[at]
            out[at] = np.where(mask[up], up, out[up])
        return out

    def under(self, outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
        """Nodes of ``inner`` with an ancestor in ``outer``."""
        return np.flatnonzero(inner & (self.nearest(outer) >= 0))

    def pairs(self, roots: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``roots``, node) for all ``nodes`` (ascending) in the subtrees of ``roots``."""
        lo, hi = np.searchsorted(nodes, roots, "right"), np.searchsorted(nodes, self.post[roots], "right")
        lo, hi = np.where(roots < 0, 0, lo), np.where(roots < 0, 0, hi)
        offs = _counts(hi - lo)
        which = np.repeat(np.arange(len(roots)), hi - lo)
        return which, nodes[np.arange(offs[-1]) - offs[which] + lo[which]]

    def first_in(self, roots: np.ndarray, mask: np.ndarray, within: np.ndarray | None = None) -> np.ndarray:
        """The first node of ``mask`` in each root's subtree, or -1; with ``within`` (from ``nearest``) only such with
        an ancestor of that kind below the root."""
        which, found = self.pairs(roots, np.flatnonzero(mask))
        if within is not None:
            go = within[found] > roots[which]
            which, found = which[go], found[go]
        out = np.full(len(roots), -1, np.int64)
        out[which[::-1]] = found[::-1]
        return out

    def first_of(self, mask: np.ndarray) -> np.ndarray:
        """The first node of ``mask`` on each page, or -1."""
        nodes = np.flatnonzero(mask)
        at = np.searchsorted(nodes, self.first[:-1])
        there = at < np.searchsorted(nodes, self.first[1:])
        out = np.full(len(at), -1, np.int64)
        out[there] = nodes[at[there]]
        return out

    def texts(self, nodes: np.ndarray) -> pa.Array:
        """Normalised texts of nodes; '' for a node -1."""
        starts, ends = np.zeros((2, len(nodes)), np.int64)
        there = np.flatnonzero(nodes >= 0)
        starts[there], ends[there] = self.offs[nodes[there]], self.offs[self.post[nodes[there]] + 1]
        return normalized(*gathered(self.data, starts, ends))

    def listed(self, nodes: np.ndarray, values: pa.Array) -> pa.Array:
        """The values of ascending nodes as one list a page."""
        return listed(np.searchsorted(nodes, self.first), values)


def listed(offs: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), values)


def grouped(which: np.ndarray, groups: int) -> np.ndarray:
    """Offsets of lists from the ascending group numbers of their values."""
    return np.searchsorted(which, np.arange(groups + 1))


# ---------------------------------------------------------------- reading


def _from_builders(htmls: list[str | None]) -> tuple[Pages, list[str | None]]:
    first, errors, parent, post, depth, kind, texts = [0], [], [], [], [], [], []
    codes: dict[tuple, int] = {}
    for html in htmls:
        tb, base = parse_html(html), first[-1]
        errors.append(tb.error)
        parent += [p + base if p >= 0 else -1 for p in tb.parent]
        post += [p + base for p in tb.post]
        depth += tb.depth
        kind += [codes.setdefault((t, tuple(a), tuple(c)), len(codes)) for t, a, c in zip(tb.tag, tb.attrs, tb.cls)]
        texts += [t or "" for t in tb.text]
        first.append(base + len(tb.tag))
    data, offs = string_bytes(pa.array(texts, pa.large_string()))
    known = [(t, dict(a), list(c)) for t, a, c in codes]
    return Pages(np.array(first), *(np.array(x, np.int64) for x in (parent, post, depth, kind)), known, data, offs), errors


class _Tokens:
    """Tags of the pages that may be plain: where they begin and end, what they are, and the text bytes between them."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        pages = len(offs) - 1
        lt, gt = np.flatnonzero(data == 60), np.flatnonzero(data == 62)
        page = np.repeat(np.arange(pages), np.diff(np.searchsorted(lt, offs)))
        paired = len(lt) == len(gt) and bool((lt < gt).all() and (gt[:-1] < lt[1:]).all())
        close = gt if paired else np.append(gt, len(data) + 1)[np.searchsorted(gt, lt)]
        bad = (close > np.append(lt[1:], len(data))) | (close >= offs[page + 1])
        self.plain = np.zeros(pages, bool)
        self.plain[page] = True
        self.plain[page[bad]] = False
        go = self.plain[page]
        lt, close, page = lt[go], close[go], page[go]
        raw = _strings(*_picked(data, lt + 1, close)).dictionary_encode()
        code = raw.indices.to_numpy(zero_copy_only=False)
        kinds, names, self.known, self.names = [], [], [], {}
        comment = []
        for text in raw.dictionary.to_pylist():
            read = _read_tag(text)
            comment.append(text.startswith("!-"))
            end, tag, known, slash = read or ("", "", None, False)
            if read is None:
                kind = _BAD
            elif read is _SKIP:
                kind = _NONE
            elif end:
                kind = _NONE if tag in ("html", "body") else _BAD if tag in VOID_TAGS else _END
            elif slash or tag in VOID_TAGS:
                kind = _BAD if tag in ("html", "head", "body", "title") else _LEAF
            else:
                kind = _START
            kinds.append(kind)
            names.append(self.name(tag))
            self.known.append((tag, {} if known is None or tag == "html" else dict(known[0]), [] if known is None or tag == "html" else known[1]))
        self.known += [("tbody", {}, []), _TEXT]
        kind, name = np.array(kinds + [_BAD], np.int8)[code], np.array(names + [0], np.int64)[code]
        title = np.flatnonzero((kind == _START) & (name == self.name("title")))
        after = np.minimum(title + 1, len(kind) - 1)
        self.plain[page[title[(kind[after] != _END) | (name[after] != name[title]) | (page[after] != page[title])]]] = False
        self.plain[page[kind == _BAD]] = False
        remarks = np.array(comment + [False], bool)[code]
        if remarks.any():
            noted = page[remarks]
            self.plain[noted[_any(data == 38, offs[noted], offs[noted + 1])]] = False
        # texts: before the first tag of a page and behind every tag; all texts stand one after the other in ``text``
        first = np.concatenate([np.ones(min(1, len(page)), bool), page[1:] != page[:-1]])
        last = np.append(first[1:], np.ones(min(1, len(page)), bool))
        after = np.where(last, offs[page + 1], np.append(lt[1:], 0))
        starts, ends = np.empty(2 * len(lt), np.int64), np.empty(2 * len(lt), np.int64)
        starts[0::2], ends[0::2] = np.where(first, offs[page], lt), lt
        starts[1::2], ends[1::2] = close + 1, after
        self.text, at = _picked(data, starts, ends)
        head, before = at[0:-1:2], at[1::2]  # where the text before a first tag begins, and where it ends
        self.head, self.total = np.zeros(pages, np.int64), np.zeros(pages, np.int64)
        self.head[page[first]] = head[first]
        self.total[page[last]] = at[2::2][last]
        go = kind != _NONE
        self.before, self.kind, self.tag, self.code, self.page = before[go], kind[go], name[go], code[go].astype(np.int32), page[go]

    def name(self, tag: str) -> int:
        return self.names.setdefault(tag, len(self.names))

    def solid(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether each range of ``text`` has more than white space."""
        out = ends > starts
        at = np.flatnonzero(out)
        data, offs = gathered(self.text, starts[at], ends[at])
        out[at] = _any(~_SPACE[data], offs[:-1], offs[1:])
        return out

    def named(self, tags: Iterable[str]) -> np.ndarray:
        mask = np.zeros(len(self.names) + 1, bool)
        mask[[self.names[t] for t in tags if t in self.names]] = True
        return mask


def _structure(kind: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(depth, parent, closing token or -1, whether it closes nothing or leaves its page with other than two open) of tokens."""
    step = np.where(kind == _START, 1, np.where(kind == _END, -1, 0))
    total = np.cumsum(step)
    head = np.concatenate([[True], page[1:] != page[:-1]])
    at = np.maximum.accumulate(np.where(head, np.arange(len(page)), 0))
    open_ = total - (total - step)[at]
    depth = open_ - (step == 1)
    last = np.append(np.flatnonzero(head)[1:] - 1, len(page) - 1)
    wrong = depth < 0
    wrong[last] |= open_[last] != 2
    size, levels = len(page), int(depth.max()) + 3
    row = page * levels + np.maximum(depth, -1) + 1
    starts = np.flatnonzero(kind == _START)
    key = row[starts] * size + starts
    order = np.argsort(key)
    key, starts = key[order], starts[order]

    def last_start(rows: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        place = np.searchsorted(key, rows * size + tokens) - 1
        found = starts[np.maximum(place, 0)] if len(starts) else np.zeros(len(tokens), np.int64)
        return np.where((place >= 0) & (row[found] == rows), found, -1) if len(starts) else np.full(len(tokens), -1)

    parent = last_start(row - 1, np.arange(size))
    ends = np.flatnonzero(kind == _END)
    opened = last_start(row[ends], ends)
    wrong[ends[opened < 0]] = True
    close = np.full(size, -1, np.int64)
    close[opened[opened >= 0]] = ends[opened >= 0]
    return depth, parent, close, wrong


def _built(t: _Tokens, plain: np.ndarray) -> tuple[Pages, np.ndarray]:
    """(the trees of the pages ``plain``, which of all pages must go to the tree builder after all)."""
    go = plain[t.page]
    before, kind, tag, code, page = (x[go] for x in (t.before, t.kind, t.tag, t.code, t.page))
    odd = np.zeros(len(plain), bool)
    left = plain.copy()
    left[page] = False
    odd |= left  # no tag at all
    if not len(page):
        none = np.zeros(0, np.int64)
        return Pages(np.zeros(1, np.int64), none, none, none, none, t.known, np.zeros(0, np.uint8), np.zeros(1, np.int64)), odd
    tr, table, tbody = t.name("tr"), t.name("table"), t.name("tbody")
    depth, parent, close, wrong = _structure(kind, page)
    element = (kind == _START) | (kind == _LEAF)
    bare = np.unique(parent[element & (tag == tr) & (parent >= 0)])
    bare = bare[(tag[bare] == table) & (close[bare] >= 0)]
    if len(bare):  # tables without a tbody: one is put around their rows
        inside = np.zeros(len(page) + 1, bool)
        inside[bare] = True
        odd[page[element & inside[parent] & (tag != tr)]] = True
        at = np.concatenate([bare + 1, close[bare]])
        order = np.argsort(at, kind="stable")
        at = at[order]
        new = np.concatenate([np.full(len(bare), _START), np.full(len(bare), _END)])[order]
        kind, page, tag = np.insert(kind, at, new), np.insert(page, at, page[at]), np.insert(tag, at, tbody)
        code = np.insert(code, at, len(t.known) - 2)
        before = np.insert(before, at, before[at])
        depth, parent, close, wrong = _structure(kind, page)
        element = (kind == _START) | (kind == _LEAF)
    odd[page[wrong]] = True
    shut = np.flatnonzero(close >= 0)
    odd[page[shut[tag[shut] != tag[close[shut]]]]] = True

    # texts behind tokens
    size = len(page)
    ends_page = np.append(page[1:] != page[:-1], True)
    lo, hi = before, np.where(ends_page, t.total[page], np.append(before[1:], 0))
    head = np.flatnonzero(np.concatenate([[True], ends_page[:-1]]))
    odd[page[head[t.solid(t.head[page[head]], before[head])]]] = True
    holder = np.where(kind == _START, np.arange(size), parent)
    name = lambda x: np.where(x >= 0, tag[x], -1)
    html, head_tag, body = t.name("html"), t.name("head"), t.name("body")
    held = name(holder)
    skeleton = (holder < 0) | (held == html) | (held == head_tag)
    bone = np.flatnonzero(skeleton)
    odd[page[bone[t.solid(lo[bone], hi[bone])]]] = True
    said = (hi > lo) & ~skeleton
    if len(bare):  # a text straight in such a table would move
        odd[page[said & (held == table) & np.isin(holder, parent[(tag == tbody) & (code == len(t.known) - 2)])]] = True

    # skeleton: html, head, body once each, nothing else beside them
    e = np.flatnonzero(element)
    up = name(parent[e])
    what = tag[e]
    pages = np.unique(page)
    for one, above in ((html, -1), (head_tag, html), (body, html)):
        number = np.bincount(page[e[(what == one) & (up == above)]], minlength=len(plain))
        odd[pages[number[pages] != 1]] = True
        odd[page[e[(what == one) & (up != above)]]] = True
    odd[page[e[((up == html) & (what != head_tag) & (what != body)) | ((up == -1) & (what != html))]]] = True
    odd[page[e[(up == head_tag) & ~t.named(HEAD_TAGS)[what]]]] = True
    odd[page[e[(depth[e] > 2) & np.isin(up, [t.name(x) for x in HEAD_TAGS]) & (name(parent[parent[e]]) == head_tag)]]] = True
    is_body, is_head = e[what == body], e[what == head_tag]
    odd[page[is_body[close[is_body] >= 0]]] = True
    first_body = np.full(len(plain), -1, np.int64)
    first_body[page[is_body[::-1]]] = is_body[::-1]
    odd[page[is_head[(close[is_head] < 0) | (close[is_head] > first_body[page[is_head]])]]] = True

    # elements whose start would end others
    row = up[:]
    odd[page[e[t.named(HEADINGS)[what] & t.named(HEADINGS)[row]]]] = True
    odd[page[e[np.isin(what, [t.name("option"), t.name("optgroup")]) & np.isin(row, [t.name("option"), t.name("optgroup")]) & ~((what == t.name("option")) & (row == t.name("optgroup")))]]] = True
    odd[page[e[t.named(TABLE_SECTIONS)[what] & (row != table)]]] = True
    odd[page[e[(what == tr) & ~t.named(TABLE_SECTIONS)[row]]]] = True
    odd[page[e[t.named(["td", "th"])[what] & (row != tr)]]] = True

    # nodes
    there = np.zeros(2 * size, bool)
    there[0::2], there[1::2] = element, said
    node = np.cumsum(there) - 1
    slots = np.flatnonzero(there)
    token, is_text = slots // 2, slots % 2 == 1
    above = np.where(is_text, holder[token], parent[token])
    parent_node = np.where(above >= 0, node[2 * np.maximum(above, 0)], -1)
    tail = np.append(np.flatnonzero(page[token][1:] != page[token][:-1]), len(token) - 1)
    page_end = np.zeros(len(plain), np.int64)
    page_end[page[token[tail]]] = tail
    own = np.arange(len(token))
    post = np.where(is_text | (kind[token] == _LEAF), own, np.where(close[token] >= 0, node[2 * np.maximum(close[token], 0) - 1], page_end[page[token]]))
    node_depth = np.where(is_text, depth[np.maximum(above, 0)] + 1, depth[token])
    what_is = np.where(is_text, len(t.known) - 1, code[token])
    data, offs = gathered(t.text, np.where(is_text, lo[token], 0), np.where(is_text, hi[token], 0))
    coded = _any(data == 38, offs[:-1], offs[1:])
    if coded.any():
        texts = _strings(data, offs)
        mask = pa.array(coded)
        data, offs = string_bytes(pc.replace_with_mask(texts, mask, pa.array([unescape(x) for x in texts.filter(mask).to_pylist()], pa.large_string())))
    counts = np.bincount(page[token], minlength=len(plain))[np.flatnonzero(plain)]
    if odd.any():
        return None, odd
    got = Pages(_counts(counts), parent_node, post, node_depth, what_is, t.known, data, offs)
    # ancestors in whose scope a start would end an element
    at = np.flatnonzero(got.tag(*CLOSES_P))
    near_p = got.nearest(got.tag("p"))
    items = got.nearest(got.tag(*_ITEM_SCOPE))
    lis, terms = got.tag("li"), got.tag("dd", "dt")
    scope = np.maximum(items, 0)
    moved = (lis & (items >= 0) & lis[scope]) | (terms & (items >= 0) & terms[scope])
    moved[at] |= near_p[at] >= 0
    odd[np.flatnonzero(plain)[got.page[moved]]] = True
    return got, odd


def read_pages(column: pa.Array) -> list[tuple[np.ndarray, Pages, list[str | None]]]:
    """(places in the column, their pages, parse errors) of the pages read together and of the others."""
    data, offs = string_bytes(column)
    tokens = _Tokens(data, offs)
    plain, got = tokens.plain, None
    while plain.any():
        got, odd = _built(tokens, plain)
        if not odd.any():
            break
        plain, got = plain & ~odd, None
    rest = np.flatnonzero(~plain)
    out = [] if got is None else [(np.flatnonzero(plain), got, [None] * int(plain.sum()))]
    return [*out, (rest, *_from_builders(column.take(pa.array(rest)).to_pylist()))] if len(rest) else out


Locate = Callable[[Pages], dict[str, pa.Array]]


def located_html(df: DataFrame, locate: Locate, fields: str, html_col: str = "body", partitions: int | None = None) -> DataFrame:
    """``df`` without its markup and with the columns ``fields`` (DDL) that ``locate`` finds in every page, and
    ``parse_error`` as in ``shred_html``.  The batches are those of ``shred_html``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if partitions is not None:
        df = df.repartition(partitions)
    kept = [f for f in df.schema.fields if f.name != html_col]
    wanted = T._parse_datatype_string(fields)
    arrow = to_arrow_schema(wanted)
    keep = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            for lo, hi in _spans(batch.column(html_col)):
                part = batch.slice(lo, hi - lo)
                order, columns, errors = [], {f.name: [] for f in arrow}, []
                for places, pages, said in read_pages(part.column(html_col)):
                    found = locate(pages)
                    order.append(places)
                    errors += said
                    for f in arrow:
                        columns[f.name].append(found[f.name].cast(f.type))
                back = pa.array(np.argsort(np.concatenate(order)))
                arrays = [pa.concat_arrays(columns[f.name]).take(back) for f in arrow]
                yield pa.RecordBatch.from_arrays([*(part.column(name) for name in keep), *arrays, pa.array(errors, pa.string()).take(back)], names=[*keep, *arrow.names, "parse_error"])

    return df.mapInArrow(run, T.StructType([*kept, *wanted.fields, T.StructField("parse_error", T.StringType())]))
