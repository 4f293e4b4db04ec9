"""Tree shape, implied tags, text fidelity."""

from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from pagelake.operators.shred import parse_html


def tags(tb):
    return list(tb.tag)


def test_preorder_intervals_and_parents():
    tb = parse_html("<html><body><div><p>a</p><p>b</p></div></body></html>")
    n = len(tb.tag)
    for i in range(n):
        assert tb.post[i] >= i
        p = tb.parent[i]
        if p >= 0:
            assert p < i <= tb.post[p]
            assert tb.depth[i] == tb.depth[p] + 1


def test_implied_paragraph_end_and_unclosed_b():
    tb = parse_html("<body><article><h1>T</h1><p><b>one<br><p>two</p></article></body>")
    ps = [i for i, t in enumerate(tb.tag) if t == "p"]
    assert len(ps) == 2
    # the second p is a sibling of the first, not its child
    assert tb.parent[ps[0]] == tb.parent[ps[1]]
    first_text = "".join(tb.text[j] for j in range(ps[0] + 1, tb.post[ps[0]] + 1) if tb.text[j])
    assert first_text == "one"


def test_implied_li_option_and_table_sections():
    tb = parse_html("<ul><li>a<li>b</ul><select><option>x<option>y</select><table><tr><td>1<td>2<tr><td>3</table>")
    t = tags(tb)
    assert t.count("li") == 2 and t.count("option") == 2
    assert t.count("tbody") == 1 and t.count("tr") == 2 and t.count("td") == 3
    li = [i for i, x in enumerate(t) if x == "li"]
    assert tb.parent[li[0]] == tb.parent[li[1]]
    tr = [i for i, x in enumerate(t) if x == "tr"]
    assert t[tb.parent[tr[0]]] == "tbody"


def test_void_elements_and_stray_end_tags():
    tb = parse_html("<div>a<br>b<img src=x></span>c</div>")
    div = tags(tb).index("div")
    kids = [i for i in range(len(tb.tag)) if tb.parent[i] == div]
    assert [tb.tag[i] for i in kids] == ["#text", "br", "#text", "img", "#text"]


def test_entities_comments_script():
    tb = parse_html("<head><script>var t=\"</p>\";</script></head><body><!-- c -->A &amp B &copy; &lt;x&gt;</body>")
    texts = [x for x in tb.text if x]
    assert "".join(texts) == "A & B © <x>"
    assert tb.data[tags(tb).index("#data")] == 'var t="</p>";'


def test_implied_body_and_chrome_flags():
    tb = parse_html("<title>t</title><nav><a href='/x'>n</a></nav><main>m</main><div class='navbar'>z</div>")
    t = tags(tb)
    assert "body" in t and "head" in t
    a = t.index("a")
    assert tb.chrome[a] and tb.chrome[t.index("nav")]
    assert not tb.chrome[t.index("main")]
    nb = [i for i, x in enumerate(t) if x == "div"][0]
    assert tb.chrome[nb]


def test_attributes_first_wins_and_classes():
    tb = parse_html('<div id="a" id="b" class=" x  y " data-k="1&amp;2">z</div>')
    i = tags(tb).index("div")
    assert dict(tb.attrs[i]) == {"id": "a", "class": " x  y ", "data-k": "1&2"}
    assert tb.cls[i] == ["x", "y"]


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.skip:
            self.skip -= 1

    def handle_data(self, d):
        if not self.skip:
            self.out.append(d)


_frag = st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<br>", "<li>", "<ul>", "</ul>", "<div>", "</div>",
                         "<td>", "<tr>", "<table>", "</table>", "&amp;", "&lt;", "x", "y z", " ", "é"])


@settings(max_examples=200, deadline=None)
@given(st.lists(_frag, max_size=30))
def test_text_of_root_equals_stdlib_text(frags):
    html = "<body>" + "".join(frags) + "</body>"
    tb = parse_html(html)
    ref = _Text()
    ref.feed(html)
    ref.close()
    got = "".join(x for x in tb.text if x)
    assert got.strip() == "".join(ref.out).strip()


def test_spark_nodes_match_python(shred_one):
    pages = shred_one("<body><p>a<p>b</body>", "")
    assert [n["tag"] for n in pages[0]] == ["html", "body", "p", "#text", "p", "#text"]
    assert [n["pre"] for n in pages[0]] == list(range(6))
    assert pages[1] == []


def text_after(html, element, marker="AFTER"):
    """Tags of the ancestors of the text ``marker``, and whether it lies inside the first ``element``."""
    tb = parse_html(html)
    at = next(i for i, t in enumerate(tb.text) if t and marker in t)
    first = tb.tag.index(element)
    return first < at <= tb.post[first]


def test_end_tags_close_open_children():
    for tag, inside in [
        ("ul", "<li>a<li>b"), ("ol", "<li>a"), ("dl", "<dt>a<dd>b"), ("div", "<p>x"), ("nav", "<ul><li>Home</ul>"), ("section", "<div><p>x"),
        ("table", "<tr><td>a<td>b<tr><td>c"), ("table", "<tbody><tr><td>a</td></tr>"), ("table", "<tr><td>a</td></tr>"), ("main", "<ul><li><p>x"), ("h2", "<b>x"),
    ]:
        assert not text_after(f"<body><{tag}>{inside}</{tag}>AFTER", tag), (tag, inside)
        assert not text_after(f"<body><{tag}>{inside}</{tag}><p>AFTER", tag), (tag, inside)


def test_end_tags_respect_scope():
    assert text_after("<div><table><tr><td>x</div>AFTER</table>", "td")  # a cell bounds the search for div
    assert text_after("<ul><li><ul><li>a</ul>AFTER</li></ul>", "li")  # the inner list closes, the outer item stays
    assert not text_after("<h1>T</h2>AFTER", "h1")  # any heading end closes the open heading
    assert text_after("<div>a</span></section>AFTER</div>", "div")  # stray end tags change nothing
    tb = parse_html("<div id=a><p>x</div><div id=b>y</div>")
    divs = [i for i, t in enumerate(tb.tag) if t == "div"]
    assert tb.parent[divs[0]] == tb.parent[divs[1]]


def test_clean_page_with_unclosed_nav_items(spark):
    from pagelake.operators.pages import clean_page
    from pagelake.operators.shred import shred_html

    page = "<nav><ul><li>Home<li>Courses</ul></nav><main><h1>T</h1><p>Body " + "word " * 7000
    df = spark.createDataFrame([("1", "https://x/y", page, 200)], "page_key string, url string, body string, status int")
    row = clean_page(shred_html(df, keep_html=False)).first()
    assert row.title == "T" and row.text == ("T Body " + "word " * 7000).strip() or row.text.endswith("word")
    assert row.length == len(row.text) > 30_000 and "Home" not in row.text


_markup = st.sampled_from([
    "<p>", "</p>", "<b>", "</b>", "<br>", "<br/>", "<li>", "<ul>", "</ul>", "<div>", "</div>", "<td>", "<tr>", "<table>", "</table>", "<h1>", "</h2>", "<title>", "</title>",
    "<body>", "</body>", "<option>", "<select>", '<a href="/x?a=1&amp;b=2" class="q  r">', "</a>", '<div class="navbar" id="a" id="b">', "<input checked>", "<!-- c -->", "<!-->", "<script>",
    "</script>", "<textarea>", "</textarea>", "<A>", "< ", "x > y", "&amp;", "&lt", '<a href="&copy=1">', "<a b=c>", "</p >", "<div/>", "<p", " ", "é",
])


@settings(max_examples=300, deadline=None)
@given(st.lists(_markup, max_size=14))
def test_plain_markup_is_read_as_by_the_standard_parser(frags):
    from pagelake.operators.shred import _TreeBuilder

    html = "".join(frags)
    got, ref = parse_html(html), _TreeBuilder()
    ref.feed(html)
    ref.close()
    fields = ("tag", "parent", "depth", "post", "attrs", "cls", "chrome", "text", "data")
    assert [getattr(got, f) for f in fields] == [getattr(ref, f) for f in fields]


def test_plain_pages_need_no_standard_parser():
    from pagelake.operators.shred import _TreeBuilder

    plain = '<!DOCTYPE html><html><head><title>T &amp; U</title></head><body><!-- c --><a href="/x?a=1&amp;b=2">x</a><br/></body></html>'
    tb = _TreeBuilder()
    assert tb.read_plain(plain)
    assert dict(tb.attrs[tb.tag.index("a")]) == {"href": "/x?a=1&b=2"} and "T & U" in tb.text
    for other in ("<script>1</script>", "<a href=x>", "a < b", "<title><b></title>", "<title>x"):
        tb = _TreeBuilder()
        assert not tb.read_plain(other) and not tb.tag, other
