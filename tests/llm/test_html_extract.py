import html
import itertools
import re

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tixprep.llm.html_extract import EDGE_KINDS, N_FEATURES, Forest, Potentials, extract, forest, main_text, marginals, parse, trained
from tixprep.llm.html_pages import LABELLED_PAGES


def plain_article(page):
    """The blocks of the one article of a page of the test tables, by text cutting alone."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1).replace("<br>", " ").replace("<b>", "")
    parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split(r"</?p>|</?h1>", inner)]
    return "\n\n".join(p for p in parts if p)


def test_whole_table(spark):
    from tixprep.llm.queries import QUERIES
    t = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pydict()
    want = {i: (u, plain_article(h)) for i, u, h in zip(t["page_id"], t["url"], t["html"], strict=True)}
    rows = QUERIES["op6_main_text"](spark, "/root/testdata/sf0.01").collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in rows} == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_messages_equal_enumeration():
    """Marginals of nodes and links against the sum over all labellings of a small tree."""
    rng = np.random.default_rng(3)
    parent, depth = np.array([-1, 0, 0, 1, 1, 2, -1]), np.array([0, 1, 1, 2, 2, 2, 0])
    trees = Forest(parent, depth, rng.integers(0, EDGE_KINDS, 7), rng.normal(size=(7, N_FEATURES)), np.zeros(7))
    p = Potentials(rng.normal(size=N_FEATURES) * 0.3, rng.normal(size=(EDGE_KINDS, 2, 2)))
    score = trees.x @ p.node
    node, pair, total = np.zeros((7, 2)), np.zeros((7, 2, 2)), 0
    for y in itertools.product((0, 1), repeat=7):
        w = np.exp(sum(score[k] * y[k] for k in range(7)) + sum(p.edge[trees.edge[k], y[parent[k]], y[k]] for k in range(7) if parent[k] >= 0))
        total += w
        for k in range(7):
            node[k, y[k]] += w
            if parent[k] >= 0:
                pair[k, y[parent[k]], y[k]] += w
    got_node, got_pair = marginals(trees, p)
    assert np.allclose(got_node, node / total) and np.allclose(got_pair, pair / total)


def test_pages_left_out_of_training():
    """Each hand-made page is extracted with weights learnt from the others."""
    from tixprep.llm import html_extract as X
    pages = [parse(t) for t in LABELLED_PAGES]
    right = total = 0
    for k in range(len(pages)):
        p = X.fit(forest([q for j, q in enumerate(pages) if j != k] * 8))
        trees = forest([pages[k]])
        some = np.array([v.chars > 0 for v in pages[k].nodes])
        right += ((marginals(trees, p)[0][:, 1] >= 0.5) == (trees.label > 0))[some].sum()
        total += some.sum()
    assert right / total > 0.85


def test_markup_without_articles_and_broken_pages(spark):
    p = trained()
    long = "The river rose through the night, and by morning the lower fields were under water, he said. " * 3
    def one(t):
        return extract([parse(t)], p)[0]
    assert one(f"<body><div class=nav><a href=/>Home</a></div><div id='content'><p>{long}<p>A &amp; B&nbsp;c &lt;d&gt; &eacute;</div><div class='footer'>x</div>") == long.strip() + "\n\nA & B c <d> é"
    for odd in ("", "plain words only", "<", "<p", "<p>a", "</p></div>", "<!-- never closed <p>x", "<script>var a='</p>'", "<a " * 3000, "<div>" * 3000 + "x", "<p>" * 2000,
                "<li>a<li>b<table><tr><td>x<td>y<tr><td>z", "&#x110000; &#0; &bogus; &amp", '<p class="a b>c</p>', "<b><p>x</b></p>", "\x00<p>\x00</p>", "é" * 50000):
        assert isinstance(one(odd), str)
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (2, None, ""), (3, "v", f"<article><h1>T</h1><p>{long}</p><script>no</script><style>no</style><!-- no --></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    out = main_text(pages).collect()
    assert len(out) == 5 and [r["text"] for r in out if r["page_id"] in (1, 2)] == ["", "", ""]
    assert [r["text"] for r in out if r["page_id"] == 3] == ["T\n\n" + long.strip()]
    assert main_text(pages.limit(0)).count() == 0


def test_furniture_inside_the_article():
    p = trained()
    t = ("<html><body><header><a href='/'>Site</a></header><article><h1>Title here</h1><p>First paragraph of the story, with words.</p><div class='ad'>Buy a new boat today.</div>"
         "<aside class='related'><p>Other stories</p></aside><p>Second paragraph,<br>on two lines.</p><ul><li>point one</li><li>point two</li></ul>"
         "<form><p>Enter your name</p><button>Go</button></form><section class='comments'><p>Nice article, thank you all for it.</p></section></article><footer>Imprint</footer></body></html>")
    assert extract([parse(t)], p)[0] == "Title here\n\nFirst paragraph of the story, with words.\n\nSecond paragraph, on two lines.\n\npoint one\n\npoint two"


def test_pages_without_optional_end_tags():
    """Every way to leave out the end tags of head, body and html gives the text of the whole page."""
    p = trained()
    long = "The river rose through the night, and by morning the lower fields were under water, he said. " * 3
    article = f"<article><h1>T</h1><p>{long}</p></article>"
    heads = ["<title>x</title>", "<title>x</title>\n<meta charset=utf-8><link rel=a href=b><script>var a='<p>'</script><style>p {}</style>\n", "<noscript><img src=a></noscript><base href=/>", ""]
    for head, head_end, body, end in itertools.product(heads, ("", "</head>"), ("", "<body>", "<body class='page'>"), ("", "</body>", "</html>", "</body></html>")):
        page = f"<!doctype html><html><head>{head}{head_end}{body}{article}{end}"
        assert extract([parse(page)], p)[0] == "T\n\n" + long.strip(), page
    for body in (f"{long}", f"<b>{long}</b>", f"<div id='content'><p>{long}</div>"):
        blocks = parse(f"<html><head><title>x</title>{body}").blocks
        assert [text for _, text in blocks] == [long.strip()]
    assert parse("<html><head><noscript>off</noscript><title>x</title> <template><p>off</p></template></head>").blocks == []


def test_formulas_stay():
    p = trained()
    long = "The river rose through the night, and by morning the lower fields were under water, he said. " * 3
    page = (f"<html><body><article><h1>T</h1><p>{long}</p><p>The energy is <math><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow></math> at rest, he said.</p>"
            f"<p>Rows <math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable></math> follow, he said.</p><p>{long}</p></article></body></html>")
    assert extract([parse(page)], p)[0] == f"T\n\n{long.strip()}\n\nThe energy is E=mc2 at rest, he said.\n\nRows 1 2 follow, he said.\n\n{long.strip()}"
