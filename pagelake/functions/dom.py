"""Selector and tree functions over the node array, as Catalyst expressions.

A *predicate* is a Python callable ``node Column -> boolean Column``; predicates
compose with ``&``, ``|`` and ``~`` through :class:`Sel`.  Nothing here parses a
selector string: callers build the few selectors they need from the helpers
below, the way a Spark user writes ``col('x') == 1``.

Because the shredder numbers nodes in pre-order and stores node ``i`` at array
index ``i``, the subtree of ``a`` is the contiguous range
``nodes[a.pre+1 .. a.post]``.  Descendant searches and text extraction therefore
touch only the subtree, never the whole page.

ANSI mode is on by default: use ``get`` / ``try_element_at`` (null on a miss),
never ``arr[0]`` (raises on an empty array).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import normalize_text, truncate

Pred = Callable[[Column], Column]


class Sel:
    """A composable node predicate (a tiny stand-in for one CSS compound selector)."""

    def __init__(self, fn: Pred):
        self.fn = fn

    def __call__(self, n: Column) -> Column:
        return self.fn(n)

    def __and__(self, other: "Sel") -> "Sel":
        return Sel(lambda n: self.fn(n) & other.fn(n))

    def __or__(self, other: "Sel") -> "Sel":
        return Sel(lambda n: self.fn(n) | other.fn(n))

    def __invert__(self) -> "Sel":
        return Sel(lambda n: ~self.fn(n))


def _sel(fn: Pred) -> Sel:
    return Sel(fn)


def attr(n: Column, name: str) -> Column:
    """Attribute value or null (map lookup is null-safe under ANSI)."""
    return n["attrs"][name]


def tag(*names: str) -> Sel:
    return _sel(lambda n: n["tag"].isin(*names))


ELEMENT = _sel(lambda n: ~n["tag"].startswith("#"))
TEXT = _sel(lambda n: n["tag"] == "#text")


def cls(*classes: str) -> Sel:
    """Whole-token class test (``correct`` does not match ``incorrect``)."""
    def fn(n):
        out = F.array_contains(n["class_tokens"], classes[0])
        for c in classes[1:]:
            out = out & F.array_contains(n["class_tokens"], c)
        return out

    return _sel(fn)


def id_is(value: str) -> Sel:
    return _sel(lambda n: attr(n, "id") == value)


def has_attr(name: str) -> Sel:
    return _sel(lambda n: attr(n, name).isNotNull())


def attr_eq(name: str, value: str) -> Sel:
    return _sel(lambda n: attr(n, name) == value)


def attr_prefix(name: str, value: str) -> Sel:
    return _sel(lambda n: F.startswith(attr(n, name), F.lit(value)))


def attr_contains(name: str, value: str) -> Sel:
    return _sel(lambda n: F.contains(attr(n, name), F.lit(value)))


def in_chrome(flag: bool = True) -> Sel:
    return _sel(lambda n: n["in_chrome"] == F.lit(flag))


def any_of(sels: Iterable[Sel]) -> Sel:
    """Comma union — one OR predicate, so order and uniqueness are automatic."""
    sels = list(sels)
    out = sels[0]
    for s in sels[1:]:
        out = out | s
    return out


# ---------------------------------------------------------------- structure

def bind(expr: Column, fn) -> Column:
    """Evaluate ``expr`` once and hand it to ``fn`` as a lambda variable, so ``fn``
    may reference it many times without copying the expression tree."""
    return F.get(F.transform(F.array(expr), fn), 0)


def exploded(df: DataFrame, keep: Iterable, items: Column, pos: str = "pos", item: str = "e") -> DataFrame:
    """``keep``, position and element of every item of an array, like ``posexplode``.  Spark puts a test of
    the array below a plain ``posexplode`` and computes the whole array for that test once more, so the
    outer form is used and its rows without an item are dropped."""
    return df.select(*keep, F.posexplode_outer(items).alias(pos, item)).where(F.col(pos).isNotNull())


def nonempty(x: Column) -> Column:
    """``x``, null for ''; unlike ``nullif`` inside a lambda it evaluates ``x`` once."""
    return bind(x, lambda v: F.when(v != "", v))


def subtree(nodes: Column, a: Column) -> Column:
    """Strict descendants of ``a`` in document order.  They are read by index: ``slice`` on the page
    would copy all its nodes for every subtree.  ``a`` is evaluated once."""
    return bind(a, lambda x: F.when(
        x["post"] > x["pre"], F.transform(F.sequence(x["pre"] + 1, x["post"]), lambda i: F.get(nodes, i))
    ).when(x.isNotNull(), F.filter(F.array(x), lambda _: F.lit(False))))


def select(nodes: Column, pred: Pred) -> Column:
    """All nodes matching ``pred`` in document order."""
    return F.filter(nodes, pred)


def descendants(nodes: Column, a: Column, pred: Pred | None = None) -> Column:
    """D3: descendants of ``a`` (space combinator)."""
    sub = subtree(nodes, a)
    return sub if pred is None else F.filter(sub, pred)


def children(nodes: Column, a: Column, pred: Pred | None = None) -> Column:
    """Children of ``a`` (``>`` combinator)."""
    if pred is None:
        return bind(a, lambda x: F.filter(subtree(nodes, x), lambda d: d["parent"] == x["pre"]))
    return bind(a, lambda x: F.filter(subtree(nodes, x), lambda d: (d["parent"] == x["pre"]) & pred(d)))


def select_within(nodes: Column, outer: Pred, inner: Pred) -> Column:
    """``outer inner`` over the whole page: nodes matching ``inner`` with an
    ancestor matching ``outer``; each node once, in document order.

    Work is the summed size of the matching subtrees: each outer match
    contributes the ``pre`` numbers of its matching descendants; a nested
    outer match repeats a subset, which ``array_distinct`` drops without
    disturbing document order.
    """
    pres = F.array_distinct(
        F.flatten(
            F.transform(
                F.filter(nodes, outer),
                lambda a: F.transform(F.filter(subtree(nodes, a), inner), lambda d: d["pre"]),
            )
        )
    )
    return F.transform(pres, lambda i: F.get(nodes, i))


def ancestors(nodes: Column, x: Column) -> Column:
    """Ancestors of ``x``, root first, read through its list of indices.  Nodes too deep to carry
    one get the ancestors among all earlier nodes."""
    listed = F.transform(x["anc"], lambda i: F.get(nodes, i))
    return F.coalesce(listed, F.filter(F.slice(nodes, 1, x["pre"]), lambda a: a["post"] >= x["pre"]))


def inside(nodes: Column, root: Column, d: Column, pred: Pred) -> Column:
    """``d`` has an ancestor strictly between ``root`` and ``d`` that matches ``pred``
    (the descendant combinator evaluated relative to ``root``)."""
    return F.exists(ancestors(nodes, d), lambda a: (a["pre"] > root["pre"]) & pred(a))


def find(nodes: Column, root: Column, pred: Pred, within: Pred | None = None) -> Column:
    """``root.find('<within> <pred>')``: descendants of ``root`` matching ``pred``,
    optionally only those with an ancestor matching ``within`` below ``root``."""
    sub = subtree(nodes, root)
    if within is None:
        return F.filter(sub, pred)
    return F.filter(sub, lambda d: pred(d) & inside(nodes, root, d, within))


def parent_of(nodes: Column, d: Column) -> Column:
    return F.get(nodes, d["parent"])


def let(arr: Column, **fields) -> Column:
    """A ``let`` for array lambdas: each element becomes ``struct(_ = element,
    <name> = fn(element), …)``.  Later stages read the fields instead of
    re-evaluating (and re-copying) the expressions; Catalyst cannot share
    sub-expressions across freshly named lambda variables by itself."""
    return F.transform(arr, lambda x: F.struct(x.alias("_"), *[fn(x).alias(k) for k, fn in fields.items()]))


def first(arr: Column) -> Column:
    """First element in document order or null (``get`` never raises)."""
    return F.get(arr, 0)


def last(arr: Column) -> Column:
    """W2 inside a page: the last match or null (``arr`` is evaluated once)."""
    return F.try_element_at(arr, F.lit(-1))


def closest(nodes: Column, x: Column, pred: Pred) -> Column:
    """Nearest ancestor-or-self of ``x`` matching ``pred`` (largest ``pre``)."""
    return bind(x, lambda y: last(F.filter(F.concat(ancestors(nodes, y), F.array(y)), pred)))


def next_siblings(nodes: Column, x: Column, pred: Pred | None = None) -> Column:
    """Later siblings of ``x``."""
    def later(y):
        par = F.get(nodes, y["parent"])
        window = F.slice(nodes, y["post"] + 2, F.greatest(par["post"] - y["post"], F.lit(0)))
        return F.filter(window, lambda s: (s["parent"] == y["parent"]) & (F.lit(True) if pred is None else pred(s)))

    return bind(x, later)


def text_of(nodes: Column, a: Column, skip_chrome: bool = False) -> Column:
    """Concatenated descendant text, no separator; script/style excluded.

    ``array_join`` skips nulls, and only ``#text`` nodes carry ``text``.
    """
    sub = subtree(nodes, a)
    if skip_chrome:
        sub = F.filter(sub, lambda d: ~d["in_chrome"])
    return F.array_join(sub["text"], "")


def node_text(nodes: Column, a: Column, skip_chrome: bool = False) -> Column:
    """Normalised text of one node (F1 ∘ D9); '' when ``a`` is null."""
    return normalize_text(text_of(nodes, a, skip_chrome))


def first_text(nodes: Column, pred: Pred, skip_chrome: bool = False) -> Column:
    """Normalised text of the first match of ``pred`` ('' if none)."""
    pool = F.filter(nodes, lambda d: ~d["in_chrome"]) if skip_chrome else nodes
    return node_text(nodes, first(F.filter(pool, pred)), skip_chrome)


def remove(nodes: Column, pred: Pred) -> Column:
    """Drop every node matching ``pred`` together with its subtree.  The nodes that stay keep
    their numbers, so the result is for reading, not for further steps by index."""
    return F.filter(nodes, lambda d: ~F.coalesce(pred(d) | F.exists(ancestors(nodes, d), pred), F.lit(False)))


def cascade_text(nodes: Column, preds: list[Pred], max_len: int | None = None, skip_chrome: bool = False) -> Column:
    """Text of the first selector whose first match has non-empty text ('' if none)."""
    parts = [nonempty(first_text(nodes, p, skip_chrome)) for p in preds]
    out = F.coalesce(*parts, F.lit(""))
    return truncate(out, max_len) if max_len else out


def selector_hits(nodes: Column, named: dict[str, Pred]) -> Column:
    """``MAP<STRING,INT>`` of match counts per named selector."""
    args = []
    for name, pred in named.items():
        args += [F.lit(name), F.size(F.filter(nodes, pred))]
    return F.create_map(*args)


def label_for(nodes: Column, inp: Column) -> Column:
    """``label[for=id]`` text, else the enclosing label, else a label in the enclosing div."""
    by_for = first(F.filter(nodes, lambda l: (l["tag"] == "label") & (attr(l, "for") == attr(inp, "id"))))
    enclosing = closest(nodes, inp, tag("label"))
    div = closest(nodes, inp, tag("div"))
    in_div = first(descendants(nodes, div, tag("label")))
    return F.coalesce(
        nonempty(node_text(nodes, by_for)),
        nonempty(node_text(nodes, enclosing)),
        nonempty(node_text(nodes, in_div)),
    )


def root_of(nodes: Column, name: str = "body") -> Column:
    return first(F.filter(nodes, lambda d: d["tag"] == name))
