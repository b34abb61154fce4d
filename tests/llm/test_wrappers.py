"""Main text of pages: the tables' pages against a plain parser, and other templates."""

import functools
import random
from html.parser import HTMLParser

import pytest

from ordertide.llm import wrappers
from ordertide.ship import ship

SF = "/root/testdata/sf0.001"


class Plain(HTMLParser):
    """Text of article elements, a block a line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1", "br", "article"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def plain(page):
    p = Plain()
    p.feed(page or "")
    p.close()
    return " ".join(filter(None, (" ".join(b.split()) for b in p.blocks)))


def test_query(spark):
    ship(spark)
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    want = sorted((r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in pages)
    assert sorted(map(tuple, wrappers.op11_wrappers(spark, SF).collect())) == want


def words(n, rng):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def classed(i, rng):
    title, texts = words(5, rng), [words(rng.randint(5, 40), rng) for _ in range(rng.randint(1, 6))]
    advert = f'<div class="advertisement">{words(9, rng)}</div>' if i % 2 else ""
    page = f"""<html><body><header><a href=/>Site</a><nav><a href=#>{words(1, rng)}</a></nav></header>
      <div class="cookie-notice">We use cookies {words(4, rng)}<button>OK</button></div><div id="wrap"><div class="post post-{i}"><h1>{title}</h1>
      {"".join(f"<p>{t}</p>" for t in texts)}{advert}<h2>Sub</h2><ul><li>{texts[0]}</li><li>two</li></ul></div>
      <aside class="sidebar"><ul><li><a>{words(4, rng)}</a></li></ul></aside><section id="comments"><article class="comment"><p>{words(30, rng)}</p></article></section>
      <form><label>Mail</label><input><textarea>hi</textarea></form></div><footer>{words(20, rng)}</footer></body></html>"""
    return page, " ".join([title, *texts, "Sub", texts[0], "two"])


def nameless(i, rng):
    title, texts = words(5, rng), [words(rng.randint(5, 40), rng) for _ in range(rng.randint(2, 6))]
    page = f"""<table><tr><td>Home | About | Contact</td></tr><tr><td><a href=1>{words(2, rng)}</a> <a href=2>{words(2, rng)}</a></td></tr></table>
      <div><h1>{title}</h1>{"".join(f"<p>{t}" for t in texts)}</div><div>Copyright 2020 the owners of this site</div>"""
    return page, " ".join([title, *texts])


def marked_up(i, rng):
    texts = [words(rng.randint(5, 40), rng) for _ in range(4)]
    page = f"""<body class="post-{i} home-header"><main><article class="post post-{i} category-{words(1, rng)}"><header><h1>{texts[0]}</h1><p>by {words(2, rng)}</p></header>
      <p>{texts[1]} &eacute;t&eacute; &#233;&nbsp;&lt;b&gt; a<b>b</b>c &amp&copy; 1 < 2</p><!-- <p>no</p> --><blockquote><p>{texts[2]}</p></blockquote>
      <table><tr><td>1<td>2<tr><td>{texts[3]}</table><div class="share-buttons">Share this</div><nav>prev next</nav></article></main>
      <script>document.write("<p>x</p>")</script><noscript>js</noscript></body>"""
    return page, f"{texts[0]} {texts[1]} été é <b> abc &© 1 < 2 {texts[2]} 1 2 {texts[3]}"


@pytest.mark.parametrize("n", [1, 8])
def test_templates(spark, n):
    ship(spark)
    rng = random.Random(n)
    rows, want = [], []
    for host, make in (("a.example", classed), ("b.example", nameless), ("c.example", marked_up)):
        for i in range(n):
            page, text = make(i, rng)
            rows.append((len(rows), f"https://{host}/{i}?x=1", page))
            want.append((len(want), rows[-1][1], text, len(text)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert sorted(map(tuple, wrappers.extract_pages(df).collect())) == want


def test_edges(spark):
    ship(spark)
    long = "<article>" + "<p>text &amp; more</p>" * 50_000
    rows = [(1, None, None), (2, "http://x.example", ""), (None, "no address", "plain words"), (None, "no address", "plain words"),
            (3, "http://X.example:80/a", "<div>" * 3_000 + "<p>deep"), (4, "http://y.example", long), (5, "http://z.example", "<nav>only</nav>"),
            (6, "http://z.example", "<p ='" * 500 + "<a <b" * 500), (7, "http://u@w.example/", "<article><p>one<p>two</article><script>1")]
    df = spark.createDataFrame([(*r, "h", "s") for r in rows], "page_id long, url string, html string, host string, slots string")
    found = wrappers.extract_pages(df).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    text = {r.page_id: r.text for r in found}
    assert (text[1], text[2], text[None], text[3], text[5], text[7]) == ("", "", "plain words", "deep", "", "one two")
    assert text[4] == " ".join(["text & more"] * 50_000)
    assert wrappers.extract_pages(df.limit(0)).collect() == []


def test_order_and_grouping_change_no_slot():
    rng = random.Random(5)
    pages = [wrappers.page_wrapper(make(i, rng)[0]) for i in range(12) for make in (classed, nameless, marked_up)]

    def facts(node):
        return {k: node.get(k) for k in ("n", "chars", "links", "text", "first", "last")} | {"of": {k: facts(v) for k, v in node["of"].items()}}
    whole = functools.reduce(wrappers.align, pages)
    for _ in range(5):
        rng.shuffle(pages)
        k = rng.randint(1, len(pages) - 1)
        parts = [functools.reduce(wrappers.align, p) for p in (pages[:k], pages[k:])]
        assert facts(wrappers.align(*parts)) == facts(whole)
        assert wrappers.article_slots(wrappers.align(*parts)) == wrappers.article_slots(whole)


def test_expression():
    pages = ["<ul><li>a<li>b</ul><p>x</p>", "<h1>t</h1><ul><li>c</ul><p>x</p>", "<h2>s</h2><p>x</p><h2>s</h2><p>x</p>"]
    made = wrappers.expression(functools.reduce(wrappers.align, map(wrappers.page_wrapper, pages[:2])))
    assert made.startswith("(<h1>") and "<ul>(<li>#</>)+</>" in made and made.count("<p>") == 1
    made = wrappers.expression(wrappers.page_wrapper(pages[2]))
    assert made.startswith("((<h2>") and made.endswith(")+")
