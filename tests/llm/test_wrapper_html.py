import random

import pytest

from epicentre.llm import markup, wrapper_html as w

NAV = "<nav><ul>{}</ul></nav>"


def texts_of(pages):
    """Main texts of one host's pages, without Spark."""
    one = None
    for p in pages:
        x = w.bounded(w.wrapper_of(w.parse(p)))
        one = x if one is None else w.joined(one, x)
    b = w.boundary_of(one)
    return [w.main_text(w.parse(p), b) for p in pages]


def shape(node):
    return [node.label + "?" * node.optional + "+" * node.repeated, *[shape(k) for k in node.kids]] if node.kids else node.label + "?" * node.optional + "+" * node.repeated


def wrapper(*pages):
    one = w.wrapper_of(w.parse(pages[0]))
    for p in pages[1:]:
        one = w.joined(one, w.wrapper_of(w.parse(p)))
    return one


# -- markup ---------------------------------------------------------------------------
def flat(block):
    return [k.text if isinstance(k, markup.Text) else [k.label, *flat(k)] for k in block.kids]


@pytest.mark.parametrize("html, want", [
    ("<p>a<p>b", [["p", "a"], ["p", "b"]]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>d", [["ul", ["li", "a"], ["li", "b", ["ul", ["li", "c"]]]], "d"]),
    ("<p>a <b>b</b>c<br>d\n\t e</p>", [["p", "a bc d e"]]),
    ('<div title="a > b" class=\'x  y2\'>t</div>', [["div x y0", "t"]]),
    ("<script>if (a < b) '</p>'</script>x<style>p{}</style>", ["x"]),
    ("a<!-- <p>no</p> -->b <!-- never ends <p>", ["ab"]),
    ("1 &lt; 2 &amp;amp; &eacute;&#233;&#xe9; &am 3 < 4", ["1 < 2 &amp; ééé &am 3 < 4"]),
    ("<p>a&nbsp;&nbsp;b</p><p> \n </p>", [["p", "a b"], ["p"]]),
    ("x<button>no</button>y<span class='social-share'>no <i>no</i></span>z", ["xyz"]),
    ("<p>a<span class='ad'>no</p><p>b</p>", [["p", "a"], ["p", "b"]]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", [["table", ["tr", ["td", "a"], ["td", "b"]], ["tr", ["td", "c"]]]]),
    ("</div></p><h1>a<h2>b</h2>", [["h1", "a"], ["h2", "b"]]),
    ("<p style='display: none'>no</p><div hidden>no<div>no</div></div>a<p aria-hidden=true>no</p>", ["a"]),
    ("<dl><dt>a<dd>b<dt>c</dl><p>cut <a href='x", [["dl", ["dt", "a"], ["dd", "b"], ["dt", "c"]], ["p", "cut"]]),
])
def test_parse(html, want):
    assert flat(markup.parse(html)) == want


def test_parse_odd_pages():
    assert flat(markup.parse(None)) == flat(markup.parse("")) == []
    deep = markup.parse("<div>" * 5000 + "x" + "</div>" * 5000 + "<p>y")
    assert "x" in str(flat(deep)) and w.wrapper_of(deep).size() < 400
    assert flat(markup.parse("<" * 1000 + "a" + "<p " * 1000))
    long = "<p>" + "word " * 400_000 + "</p>"
    assert texts_of([long]) == ["word " * 399_999 + "word"]


# -- inference ------------------------------------------------------------------------
def test_repeats_optionals_and_slots():
    got = wrapper("<div><h1>a</h1><p>b</p></div>", "<div><h1>c</h1><p>b</p><p>d</p><ul><li>e</li></ul></div>")
    assert shape(got) == ["html", ["div", ["h1", "#"], ["p+", "#"], ["ul?", ["li", "#"]]]]
    h1, p = got.kids[0].kids[:2]
    assert h1.kids[0].same == 0 and p.kids[0].same == 0
    same = wrapper("<div><h1>a</h1><p>x</p></div>", "<div><h1>a</h1><p>y</p></div>").kids[0].kids
    assert same[0].kids[0].same != 0 and same[1].kids[0].same == 0


def test_groups_of_several_tags():
    got = wrapper("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>e<dd>f</dl>")
    assert shape(got) == ["html", ["dl", ["(dt\tdd)+", ["dt", "#"], ["dd", "#"]]]]
    assert shape(wrapper("<dl><dt>e<dd>f</dl>", "<dl><dt>a<dd>b<dt>c<dd>d</dl>")) == shape(got)


def test_content_of_any_order_stays_bounded():
    rng = random.Random(1)
    tags = [f"div class='c{chr(97 + i // 26)}{chr(97 + i % 26)}'" for i in range(300)]
    pages = ["<section>" + "".join(f"<{t}>{i}</div>" for i, t in enumerate(rng.sample(tags, 100))) + "</section>" for _ in range(10)]
    got = wrapper(*pages)
    assert got.kids[0].kids[0].label == w.ANY and got.size() < 100
    assert texts_of(pages) == ["\n\n".join(map(str, range(100)))] * 10


def test_order_of_pages_does_not_matter_for_the_text():
    pages = [PAGE.format(t=f"Title {i}", b="".join(f"<p>Paragraph {i} {k} with some words.</p>" for k in range(1 + i % 4)), n=i) for i in range(12)]
    want = texts_of(pages)
    for seed in range(3):
        order = list(range(12))
        random.Random(seed).shuffle(order)
        assert [t for _, t in sorted(zip(order, texts_of([pages[i] for i in order]), strict=True))] == want


# -- main text ------------------------------------------------------------------------
PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><script>x('</p>')</script></head><body class='has-sidebar page-{n}'><header><a href='/'>Site</a><p>Motto of the site</p></header>"
    "<div class='cookie-notice'>We use cookies.<form><input><button>OK</button></form></div><div id='main-menu'><a href=a>One</a> <a href=b>Two {n}</a></div>"
    "<article><header><h1>{t}</h1><p>By someone</p></header>{b}<aside>Also of interest: {n}</aside><div class='ad-slot'>Buy {n} now</div></article>"
    "<section id='comments'><h2>{n} comments</h2><article class='comment'><p>First! {n}</p></article></section><footer>&copy; {n}</footer></body></html>")


def test_article_without_what_surrounds_it():
    pages = [PAGE.format(t=f"Title {i}", b=f"<p>Body <b>{i}</b> &amp; more.<ul><li>a{i}<li>b</ul><blockquote>said</blockquote>", n=i) for i in range(5)]
    assert texts_of(pages) == [f"Title {i}\n\nBody {i} & more.\n\na{i}\n\nb\n\nsaid" for i in range(5)]
    assert texts_of(pages[:1]) == ["Title 0\n\nBody 0 & more.\n\na0\n\nb\n\nsaid"]
    assert texts_of(pages[:1] * 3) == ["Title 0\n\nBody 0 & more.\n\na0\n\nb\n\nsaid"] * 3


def test_pages_without_names_are_told_by_the_wrapper():
    """Plain divs only: the menu is links, the notice is the same everywhere, the text varies."""
    page = "<body><div><a href=x>Home</a> <a href=y>More {i}</a></div><div>The same notice on all pages of this host, whatever they say.</div><div><h1>T {i}</h1><p>{b}</p></div><div>End of the page.</div></body>"
    pages = [page.format(i=i, b=f"words of page {i} " * (3 + i)) for i in range(6)]
    assert texts_of(pages) == [f"T {i}\n\n" + (f"words of page {i} " * (3 + i)).strip() for i in range(6)]


def test_main_element_and_pages_that_differ():
    with_main = "<body><div>Bar</div><main><h1>T{0}</h1><p>text {0} of the page</p></main><div class=footer>f</div></body>"
    without = "<body><div class='content'><p>another kind of page</p></div><div class=footer>f</div></body>"
    assert texts_of([with_main.format(1), with_main.format(2), without]) == ["T1\n\ntext 1 of the page", "T2\n\ntext 2 of the page", "another kind of page"]
    empty = "<body><nav><a>x</a></nav><article></article><div>not the article</div></body>"
    full = "<body><nav><a>x</a></nav><article><p>t{0}</p></article><div>not the article</div></body>"
    assert texts_of([full.format(1), full.format(2), empty]) == ["t1", "t2", ""]


def test_names_that_hold_the_article_are_no_reason_to_drop_it():
    page = "<body><div class='content-with-sidebar comments-open'><article><p>kept {0}</p></article><div class='sidebar'>no</div></div></body>"
    assert texts_of([page.format(i) for i in range(3)]) == [f"kept {i}" for i in range(3)]


# -- the operator ---------------------------------------------------------------------
PAGES = "page_id long, url string, html string"


def test_host_of(spark):
    urls = ["http://A.b.com/x?y", "https://u:p@c.org:80/", "c.org/x", None, "", "ftp://h", "http://[::1]/"]
    from pyspark.sql import functions as F

    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(w.host_of(F.col("url"))).collect()]
    assert got[:6] == ["a.b.com", "c.org", "", "", "", "h"]


def test_hosts_partitions_and_odd_rows(spark, clash):
    pages = [(i, f"http://h{i % 3}.org/{i}", PAGE.format(t=f"Title {i}", b=f"<p>Body of {i}.</p>" * (1 + i % 3), n=i)) for i in range(60)]
    want = {i: f"Title {i}" + f"\n\nBody of {i}." * (1 + i % 3) for i in range(60)}
    odd = [(100, "http://h0.org/", None), (101, None, ""), (102, None, "just text &amp; more"), (None, "http://h1.org/x", pages[1][2]), (5, pages[5][1], pages[5][2]), (103, "http://one.org", "<p>" + "long " * 100_000)]
    df = spark.createDataFrame(pages + odd, PAGES).repartition(7)
    rows = w.page_texts(clash(df).withColumn("host", df.url)).collect()
    assert len(rows) == 66 and all(r.n_chars == len(r.text) for r in rows)
    got = {}
    for r in rows:
        got.setdefault(r.page_id, []).append(r.text)
    for i, t in want.items():
        assert got[i] == [t] * (2 if i == 5 else 1)
    assert got[100] == [""] and got[101] == [""] and got[102] == ["just text & more"] and got[None] == [want[1]] and got[103] == [("long " * 100_000).strip()]
    assert w.page_texts(spark.createDataFrame([], PAGES)).collect() == []


def test_given_pages_by_plain_patterns(spark, sf001):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf001}/pages.parquet'")
    got = sorted(tuple(r) for r in w.page_texts(spark.read.parquet(f"{sf001}/pages.parquet")).collect())
    assert got == sorted(con.sql(w.PAGE_TEXTS_SQL).fetchall())
