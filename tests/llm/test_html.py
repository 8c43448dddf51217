import itertools

import numpy as np
from pyspark.sql import functions as F

from tremorlake.llm.html import Forest, Page, extract, labelled_pages, labels_of, main_texts, op3_html_extraction, trained

from fixtures import CLASHING, SF_DIR


def text(source):
    return main_texts([source], *trained())[0]


def test_marginals_equal_enumeration():
    forest = Forest([Page("<div><p>a</p><p>b c</p></div><nav>d</nav>"), Page("<p>x")])
    rng = np.random.default_rng(1)
    unary, pair = rng.normal(size=forest.x.shape[1]), rng.normal(size=(40, 2, 2))
    got, joint = forest.messages(unary, pair)
    n = len(forest.parent)
    total, ones, both = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for y in itertools.product((0, 1), repeat=n):
        weight = np.exp(sum((forest.x[i] @ unary) * y[i] for i in range(n)) + sum(
            pair[forest.group[i], y[forest.parent[i]], y[i]] for i in range(n) if forest.parent[i] >= 0))
        total += weight
        for i in range(n):
            ones[i] += weight * y[i]
            if forest.parent[i] >= 0:
                both[i, y[forest.parent[i]], y[i]] += weight
    assert np.allclose(got, ones / total) and np.allclose(joint, both / total)


def test_held_out_layouts():
    pages = [Page(s) for s in labelled_pages(150, seed=77)]
    forest = Forest(pages)
    y = np.concatenate([labels_of(p) for p in pages])
    own = np.concatenate([p.own for p in pages])
    right = (forest.messages(*trained())[0] > 0.5) == y
    assert (right * own).sum() / own.sum() > 0.97


def test_parts_that_are_not_the_article():
    prose = "Several plain words make a sentence that is long enough to be read as a paragraph of the text."
    page = (f'<html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body><div class="cookie-notice"><p>We use cookies</p></div>'
            f'<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">About</a></li></ul></nav><div class="ad">Buy now</div>'
            f'<article><h1>Title &amp; more</h1><p>{prose}<p>{prose} <a href="x">Link</a> caf&eacute;&nbsp;&#x41;&#66;<br>next\n line</p></article>'
            f'<aside><h3>Related</h3><ul><li><a href="c">C</a></li></ul></aside><section class="comments"><div class="comment"><p>{prose}</p></div></section>'
            f'<form><p>Write to us</p><input></form><footer>&copy; us</footer></body></html>')
    assert text(page) == f"Title & more {prose} {prose} Link café AB next line"


def test_comments_that_are_articles_and_parts_inside_the_article():
    prose = "Several plain words make a sentence that is long enough to be read as a paragraph of the text."
    other = "Nobody could say when the first of the bridges was built, but records show that it was standing by then."
    page = (f"<body><article><header><h1>Head</h1></header><p>{prose}</p><section><h2>Part</h2><p>{other}</p></section><footer><p>Filed under news</p></footer>"
            f'<div class="notice">This site needs consent</div></article><div class="comments"><article><p>{prose}</p></article><article><p>{other}</p></article></div></body>')
    assert text(page) == f"Head {prose} Part {other}"
    page = (f'<body><div id="content"><h2>Flood &amp; fire</h2><p>{prose}</p><div class="advert"><p>Buy now {other}</p></div><p>{other}</p>'
            f'<form><label>Your mail</label><input><p>Subscribe to our newsletter for more</p></form></div><div id="sidebar"><p>{prose}</p></div></body>')
    assert text(page) == f"Flood & fire {prose} {other}"


def test_text_directly_in_the_body():
    prose = "Several plain words make a sentence that is long enough to be read as a paragraph of the text."
    four = " ".join([prose] * 4)
    assert text(f"<body>{four}<br><br>{four}</body>") == f"{four} {four}" and text(four) == four
    menu = "<nav><ul><li><a href=/>Home</a></li><li><a href=/b>About us</a></li></ul></nav>"
    assert text(f"<body>{menu}{four}<p>{four}</p></body>") == f"{four} {four}"
    assert text(f"<body><a href=#main>Skip to content</a><article><h1>Head</h1><p>{four}</p></article>&copy; us</body>") == f"Head {four}"
    page = Page("<body>one <b>two</b><p>three</p>four</body>")
    assert [w for _, w in page.blocks] == ["one two", "three", "four"] and len({n for n, _ in page.blocks}) == 3


def test_names_behind_long_classes_count():
    long = "u-x " * 100
    assert Page(f'<div class="{long}" id="comments">x</div>').named == Page('<div id="comments">x</div>').named != [(), ()]
    assert Page("<p data-label='no'>x</p>").label == [None, None]


def test_broken_markup_keeps_its_text():
    prose = "Several plain words make a sentence that is long enough to be read as a paragraph of the text. " * 3
    assert text(f"<article><p><b>{prose}<p>{prose}</article></div></p>") == " ".join((prose + prose).split())
    assert text(f"<article><p>{prose} &amp &am") == " ".join(prose.split()) + " & &am"
    assert text(f"<article><p title='a > b\" c'>{prose}") == prose.strip()
    assert text("<script>never closed <p>x") == "" and text("<!-- never closed") == "" and text("") == "" and text(None) == ""
    assert "<" not in text(f"<article><p>{prose}" + "<div" * 2000 + f"<p>{prose}</p>").replace("<div", "")


def test_pages_of_the_table(spark):
    got = op3_html_extraction(spark, SF_DIR).collect()
    assert len(got) == 50 and all(r.n_chars == len(r.text) > 0 and "&copy" not in r.text for r in got)


def test_awkward_rows(spark):
    long = "<article>" + "<p>some words of a long page that goes on</p>" * 20_000
    rows = [(1, None, None), (2, "u", ""), (None, "u", " \n "), (3, "u", "<p>"), (3, "u", "<p>"), (4, "u", long), (5, "u", "\x00<퟿>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in CLASHING:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    got = extract(df).collect()
    assert len(got) == len(rows) and all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (None, 1, 2, 3))
    assert next(r for r in got if r.page_id == 4).n_chars == 20_000 * len("some words of a long page that goes on ") - 1
    assert extract(df.limit(0)).count() == 0
