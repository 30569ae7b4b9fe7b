"""Main text by site style trees: page reader, trees and edge cases."""

from __future__ import annotations

import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from histlake.llm import op12_site_trees as T
from histlake.llm.common import table
from histlake.llm.page_tree import label_of, read_page

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def frame(spark, rows, schema=PAGES):
    more = len(schema.split(",")) - 3
    return spark.createDataFrame([(*r, *[None] * more) for r in rows], schema)


def sentence(rng, n=8):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n)).capitalize() + "."


def texts(spark, rows, **kw):
    return {r["page_id"]: r["text"] for r in T.extract_main_text(frame(spark, rows), **kw).collect()}


def test_reader_mends_bad_markup():
    page = ("<!doctype html><body class=x><p>a <b>b<i>c</b> d<p>e&amp;f &lt; &#233; &am<br>g<ul><li>h<li>i</ul>"
            "<script>if (a<b) '</p>'</script><!-- <p>no</p> --><style>p{}</style>k < l <td>m<div title='x>y' id=q>n</p>o")
    blocks = defaultdict(str)
    for c in read_page(page)[0]:
        blocks[c.block] += c.text
    assert [T.tidy(b) for b in blocks.values() if T.tidy(b)] == ["a bc d", "e&f < é &am g", "h", "i", "k < l", "m", "n", "o"]


def test_reader_survives_anything():
    rng = random.Random(3)
    pieces = ["<", ">", "</", "<p", "<div class=", "\"", "'", "=", "&", "&#", "<!--", "-->", "<script>", "</script", "x", " ", "<a href='", "<li>",
              "</ul>", "<table><tr><td>", "\0", "é"]
    for _ in range(400):
        T.main_text("".join(rng.choice(pieces) for _ in range(rng.randrange(60))))
    assert T.main_text("<div>" * 3000 + "deep") == "deep"


def test_script_and_inline_elements_do_not_break_a_block():
    assert T.main_text("<p>one <script>x</script>two<span class=k> three</span><button>go</button></p>four") == "one two three\nfour"


def test_labels():
    assert label_of("div", " class='adBox-12 side_bar' id=\"n7\" role=search") == "div.ad.bar.box.n.search.side"
    assert label_of("p", " style='display: none'").startswith("!") and label_of("p", " hidden") == "!p"
    assert T.by_label("/html/body/div.main.menu/p") == (True, False)
    assert T.by_label("/html/body/header/h") == (True, False) and T.by_label("/html/body/article/header/h") == (False, True)
    assert T.by_label("/html/body/div.ad") == (True, False) and T.by_label("/html/body/div.address") == (False, False)
    assert T.by_label("/html/body/article/div.comments/p") == (True, True)
    assert T.by_label("/html/body/ol.commentlist/li")[0] and T.by_label("/html/body/div.subscription/p")[0]
    assert T.by_label("/html/body/div.commentary/p") == (False, False) and T.by_label("/html/body/div.comment/p")[0]


def test_marked_parts_go_even_on_a_single_page(spark):
    page = ("<html><head><title>t</title></head><body><header>Top</header><nav>Menu</nav><div class='cookie-notice'>We use</div>"
            "<main><h1>Title</h1><p>First&nbsp;&eacute;  <b>line</b>\n of text</p><aside>Side</aside><p>Second</p>"
            "<form><label>Mail</label></form><section id='comments'><p>Nice!</p></section></main><div>Elsewhere</div>"
            "<footer>End</footer></body></html>")
    assert texts(spark, [(1, "http://a.example/x", page)]) == {1: "Title\nFirst é line of text\nSecond"}


def plain_site(rng, host, n, first):
    """Pages without telling tags: only the site's tree can tell."""
    slogans = [sentence(rng) for _ in range(3)]
    rows, want = [], {}
    for i in range(n):
        paras = [sentence(rng, rng.randrange(1, 30)) for _ in range(rng.randrange(1, 6))]
        body = "".join(f"<p>{p}</p>" for p in paras)
        html = (f"<html><body><div id=a><span class=z>Home</span> News</div><div id=b>{rng.choice(slogans)}</div>"
                f"<div id=c>{body}</div><div id=d><div>All rights</div><p>Made by {host}</p></div></body></html>")
        rows.append((first + i, f"http://{host}/{i}", html))
        want[first + i] = "\n".join(paras)
    return rows, want


def test_unmarked_boilerplate_goes_by_entropy(spark):
    rng = random.Random(1)
    rows, want = plain_site(rng, "one.example", 60, 0)
    small, want_small = plain_site(rng, "two.example", 5, 100)     # too few pages of its own: the merged tree tells
    got = texts(spark, rows + small)
    assert got == {**want, **want_small}
    assert texts(spark, rows + small, max_keys=2) == got            # several passes


def test_copies_of_an_article_stay(spark):
    rng = random.Random(2)
    rows, want = plain_site(rng, "one.example", 60, 0)
    copy = rows[0][2]
    rows += [(200 + i, "http://one.example/c", copy) for i in range(30)]
    got = texts(spark, rows)
    assert got == {**want, **{200 + i: want[0] for i in range(30)}}
    page = "<body><article><h1>Same</h1><blockquote>Odd node</blockquote></article></body>"
    other = [(i, f"http://h/{i}", f"<body><article><h1>{sentence(rng)}</h1><p>{sentence(rng)}</p></article></body>") for i in range(40)]
    got = texts(spark, other + [(100 + i, "http://h/x", page) for i in range(20)])
    assert all(got[100 + i] == "Same\nOdd node" for i in range(20))


def test_constant_line_inside_articles_goes(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(50):
        p = [sentence(rng) for _ in range(3)]
        rows.append((i, f"https://n.example/{i}", f"<article><p>{p[0]}</p><p>{p[1]}</p><p class=tail>Read us daily</p><p>{p[2]}</p></article>"))
        want[i] = "\n".join(p)
    assert texts(spark, rows) == want


def test_importance_matches_the_formulas(spark):
    rng = random.Random(5)
    rows, _ = plain_site(rng, "one.example", 40, 0)
    got = {(r["host"], r["node"]): r for r in T.site_trees(frame(spark, rows)).collect()}
    pages: dict = defaultdict(int)
    having: dict = defaultdict(int)
    shapes: dict = defaultdict(int)
    for _, _, html in rows:
        chunks, runs = read_page(html)
        for path, found in runs.items():
            pages[path] += 1
            for s in found:
                shapes[path, s] += 1
        for path, found in T.texts_by_node(chunks).items():
            for t in found:
                having[path, t] += 1
    for path, m in pages.items():
        c = [n for (p, _), n in having.items() if p == path]
        if not c:
            continue
        s = [n for (p, _), n in shapes.items() if p == path]
        content = 1 - sum(math.log(n, m) for n in c) / len(c)
        shape = -sum(n / sum(s) * math.log(n / sum(s), m) for n in s)
        want = (m * max(content, shape) + T.PRIOR) / (m + T.PRIOR)
        row = got["one.example", T._digest(path)]
        assert abs(row["importance"] - want) < 1e-9 and abs(row["share"] - m / 40) < 1e-12
    assert len(got) == len({p for p, _ in having})


def test_odd_pages(spark):
    rows = [(1, None, "<p>a</p>"), (1, "no scheme", "b"), (None, "http://h/", None), (2, "HTTP://H/", ""), (3, "http://h", "<nav>x</nav>"),
            (4, "http://h", "x" * 300_000), (5, "://", "&#xD800;&#0;"), (5, "://", "&#xD800;&#0;")]
    schema = PAGES + ", host string, text string, node long, path string, n_chars int"
    out = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in T.extract_main_text(frame(spark, rows, schema)).collect())
    assert out == [(0, "", 0), (1, "a", 1), (1, "b", 1), (2, "", 0), (3, "", 0), (4, "x" * 300_000, 300_000),
                   (5, "��", 2), (5, "��", 2)]
    empty = T.extract_main_text(frame(spark, []))
    assert empty.count() == 0 and empty.columns == ["page_id", "url", "text", "n_chars"]


def test_rows_of_the_table_stay(spark):
    pages = table(spark, SF, "pages")
    out = T.extract_main_text(pages)
    assert out.count() == pages.count() and out.where(F.col("n_chars") == 0).count() == 0
