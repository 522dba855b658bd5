import random
import time
from html.parser import HTMLParser

import pytest

from slotwise.llm import html_text, queries

CASES = [
    ("<ul><li>a<li>b<ul><li>c<li>d</ul><li>e</ul>after", "- a\n- b\n  - c\n  - d\n- e\n\nafter"),
    ('<ol start=3><li>x<li><li value=9>y</ol>', "3. x\n4.\n9. y"),
    ("<table><tr><td>a<td>bbb<tr><td colspan=2>wide cell here<tr><th>long cell<td>z</table>t", "a          bbb\nwide cell here\nlong cell  z\n\nt"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><caption>C</caption><thead><tr><th>h</thead><tbody><tr><td>1<tr hidden><td>2</table>", "C\nh\n1"),
    ("<p>one<p hidden>no<p>two <b>bold</b>, x<br>y<pre>\n a\n  b</pre>z", "one\n\ntwo bold, x\ny\n\n a\n  b\n\nz"),
    ('a<div style="display: none">x</div>b', "ab"),
    ("<style>.k{display:none} #z, p.q{visibility:hidden}</style><p class='a k'>n<p class=q>n<p class=r>yes<i id=z>no</i>", "yes"),
    ("&lt;x&gt; 1 < 2 <!-- c --> &copy;<b", "<x> 1 < 2 ©"),
    ("<details><summary>S</summary>hid</details><details open><summary>T</summary>shown</details>", "S\nT\nshown"),
    ("<head><title>t</title></head>x<script>if(a<b)'</p>'</script>y<noscript>n</noscript>", "xy"),
    ("<div>a</div><div><div>b</div></div>c<h1>d</h1>e", "a\nb\nc\n\nd\n\ne"),
    ("  lots \n of\tspace  <b> here </b> ", "lots of space here"),
    ("<p>a</p><!-- unclosed <p>b", "a"),
    ("<td>loose</td></p></div>x", "loose\n\nx"),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize("page, text", CASES)
def test_layout(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div id=a">Hello</div><p>World</p>', "Hello\n\nWorld"),
        ("<p title='it's'>one</p><p>two</p>", "one\n\ntwo"),
        ("<p a\"b c'>one<p \"x>two", "one\n\ntwo"),
        ("<p title = 'a>b' class=x/>one</p x='>'>two", "one\n\ntwo"),
        ("<p hidden=>no</p><p id=a'b style=display:none>no<p x=>yes", "yes"),
        ('one<p title="two>three', "one"),
    ],
)
def test_quotes_open_values_only(page, text):
    assert html_text.extract(page) == text


class Words(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_all_words_of_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html").collect()
    got = {r["page_id"]: r["text"] for r in queries.op6_html_text(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(pages)
    for r in pages:
        plain = Words()
        plain.feed(r["html"])
        assert "".join(w for w in " ".join(plain.out).split() if w != "-") == "".join(w for w in got[r["page_id"]].split() if w != "-")


def test_broken_pages_are_linear():
    began = time.time()
    for page in ("<a " * 100_000, "<div>" * 100_000 + "x", "<table><tr><td>" * 20_000 + "x", "<" * 100_000, "<b>" * 50_000 + "</i>" * 50_000, "<p>" * 50_000, "&" * 100_000, "<!--" * 50_000, "<title>" * 50_000, "<table>" + "<tr><td colspan=999999999>x" * 200, "<ul><li>" * 2_000 + "x"):
        html_text.extract(page)
    assert time.time() - began < 30


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "<p>a", None), (2, "<p>b", "u"), (2, "<p>b", "u")], "page_id long, html string, text string")
    assert sorted(map(tuple, html_text.texts(df).collect()), key=repr) == sorted([(1, ""), (None, "a"), (2, "b"), (2, "b")], key=repr)
    assert html_text.texts(df.limit(0)).collect() == []


def canvas(rows):
    """A table's cells (text, columns, rows down) drawn at the places that a naive walk gives them; texts of three letters."""
    taken, placed = set(), []
    for r, row in enumerate(rows):
        c = 0
        for text, columns, down in row:
            while (r, c) in taken:
                c += 1
            taken |= {(r + i, c + j) for i in range(down) for j in range(columns)}
            placed.append((r, c, text))
            c += columns
    out = []
    for r in range(len(rows)):
        line = ""
        for _, c, text in sorted(x for x in placed if x[0] == r):
            line = line.ljust(5 * c) + text
        out.append(line)
    return "\n".join(x for x in out if x)


def test_spans_against_a_canvas():
    rng = random.Random(3)
    for trial in range(200):
        rows = [[(f"{i:03d}", 1, 1) for i in range(12)]]
        for r in range(rng.randint(1, 6)):
            # cells side by side keep to the first twelve columns
            rows.append([(f"{r}{chr(97 + i)}x", rng.choice([1, 1, 2]), rng.choice([1, 1, 2, 3])) for i in range(rng.randint(0, 2))])
        html = "<table>" + "".join("<tr>" + "".join(f"<td colspan={c} rowspan='{d}'>{t}" for t, c, d in row) + "</tr>" for row in rows) + "</table>"
        assert html_text.extract(html) == canvas(rows), trial


def test_row_spans():
    assert html_text.extract("<table><tr><td rowspan=2>A<td>b</tr><tr><td>c</tr></table>") == "A  b\n   c"
    assert html_text.extract("<table><tbody><tr><td rowspan=0>A<td>b<tr><td>c<tr><td>d</tbody><tbody><tr><td>e</table>") == "A  b\n   c\n   d\ne"
    # a row without text still counts
    assert html_text.extract("<table><tr><td rowspan=3>A<td>b<tr><td><tr><td>c<tr><td>d</table>") == "A  b\n   c\nd"


def test_spans_are_bounded():
    began = time.time()
    wide = "<table><tr>" + "<td colspan=1000 rowspan=0>x" * 200 + "<tr><td>y" * 5_000 + "</table>"
    assert len(html_text.extract(wide)) < 20_000_000 and time.time() - began < 30


def chosen(parts, path):
    """Whether a selector of (combinator, tag, classes, id) selects the last of a path of (tag, classes, id)."""

    def fits(part, node):
        return part[1] in ("", node[0]) and part[2] <= node[1] and part[3] in ("", node[2])

    def walk(j, at):
        if not fits(parts[j], path[at]):
            return False
        if not j:
            return True
        above = [at - 1] if parts[j][0] else range(at)
        return any(i >= 0 and walk(j - 1, i) for i in above)

    return walk(len(parts) - 1, len(path) - 1)


def test_selectors_against_all_paths():
    rng = random.Random(4)
    for trial in range(300):
        words = [rng.choice(["div", "*", "", "b"]) + "".join(rng.sample([".x", ".y", "#i"], rng.randint(0, 2))) for _ in range(rng.randint(1, 4))]
        words = [w or "div" for w in words]
        text = words[0] + "".join(rng.choice([" ", " > ", ">", "  "]) + w for w in words[1:])
        parts = html_text.selector(text)
        assert parts and len(parts) == len(words)
        nodes, html, want = [("html", frozenset(), ""), ("body", frozenset(), "")], "", []
        for d in range(6):
            tag, classes, name = rng.choice(["div", "b"]), frozenset(rng.sample("xy", rng.randint(0, 2))), rng.choice(["", "i"])
            nodes.append((tag, classes, name))
            html += f'<{tag} class="{" ".join(classes)}"' + (f" id={name}" if name else "") + f">w{d} "
            if any(chosen(parts, nodes[: i + 1]) for i in range(len(nodes))):
                break
            want.append(f"w{d}")
        got = html_text.extract(f"<style>q{{}} {text}, p:hover {{display:none}}</style><body>{html}")
        assert got.split() == want, (trial, text, html)


def test_selectors_with_other_signs_select_nothing():
    for text in ("a:hover", "a[b]", "a + b", "a ~ b", "> a", "a >", "#a#b", "a > > b", "", "@media x"):
        assert html_text.selector(text) is None
    assert html_text.extract("<style>div .a{display:none} p.a.b{visibility:hidden}</style><div><p class=a>no</p><p>yes</p></div><p class='b a'>no</p><p class=a>seen</p>") == "yes\n\nseen"
