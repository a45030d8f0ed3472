import time

import numpy as np
import pytest

from marketpipe.llm import html_text


@pytest.fixture(scope="module")
def model():
    return html_text.train()


def test_marginals_equal_enumeration():
    """Sum-product on a small tree against the sum over all states."""
    f = html_text.forest([html_text.Dom("<body><article><p>a<b>c</b></p></article><nav><a>x</a></nav></body>")])
    rng = np.random.default_rng(2)
    w, theta = rng.normal(size=html_text.FEATURES), rng.normal(size=(html_text.EDGES, 2, 2))
    p, joint = html_text.beliefs(f, w, theta)
    n = len(f.kind)
    total, each, pairs = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for state in np.ndindex(*(2,) * n):
        s = np.array(state)
        weight = np.exp(sum((f.x[i] @ w) * s[i] + (theta[f.kind[i], s[f.parent[i]], s[i]] if f.depth[i] else 0) for i in range(n)))
        total += weight
        each += weight * s
        for i in range(n):
            if f.depth[i]:
                pairs[i, s[f.parent[i]], s[i]] += weight
    assert np.allclose(p, each / total)
    assert np.allclose(joint[f.depth > 0], pairs[f.depth > 0] / total)


def test_other_labelled_pages(model):
    f = html_text.forest([html_text.Dom(h) for h in html_text.labelled_pages(120, 77)])
    p, _ = html_text.beliefs(f, model.w, model.theta)
    assert ((p > 0.5) == html_text.labels_of(f)).mean() > 0.99


PAGE = """<!DOCTYPE html><html lang=en><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=a>Home</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy   this.</div>
<div class="cookie-notice"><p>We use cookies, and more.</p></div><article><h1>A &amp; B &am</h1><p><b>First.<br><p>Second  &lt;tag&gt; é
 and <a href=x>link</a>&nbsp;text.<div class="sponsored">Paid.</div><form><label>Mail</label><input><button>Send</button></form><ul><li>one<li>two</ul><aside>Also read.</aside><p>Last.</p></article>
<section id="comments"><h2>Comments</h2><p>I liked this very much, thank you all.</p></section><aside class="sidebar"><p>Popular, all of it.</p></aside><footer>&copy; x &middot; y</footer>"""


def test_page(model):
    assert html_text.texts([PAGE], model) == ["A & B &am\n\nFirst.\n\nSecond <tag> é and link text.\n\none\n\ntwo\n\nLast."]


S = "This is a sentence of the article, and it goes on for a while."
SHORT = "One short paragraph here."


def deep(n, inner):
    return "<div>" * n + inner + "</div>" * n


#: Layouts that the training pages do not have: html, its blocks of main text.
LAYOUTS = {
    "reading list": (f"<body><nav><a href=a>Home</a></nav><article><h1>Reading list</h1><p>{S} {S}</p><ul><li><a href=1>First book on the list</a></li><li><a href=2>Second book</a></li></ul><p>{S}</p></article><footer>Foot</footer></body>", ["Reading list", f"{S} {S}", "First book on the list", "Second book", S]),
    "study": (f"<body><header><a href=/>Site</a></header><article><h1>Study</h1><section class=methods><h2>Methods</h2><p>{S}</p></section><section class=discussion><h2>Discussion</h2><p>{S} {S}</p></section><div class='related-work'><p>{S} {S} {S}</p></div><p class=notice>{S}</p><div id=feedback-loops><p>{S}</p></div></article></body>", ["Study", "Methods", S, "Discussion", f"{S} {S}", f"{S} {S} {S}", S, S]),
    "deep 5": (f"<body><nav><ul><li><a href=a>Home</a></li></ul></nav>{deep(5, f'<article><p>{SHORT}</p></article>')}<footer>c</footer></body>", [SHORT]),
    "deep 6": (f"<body>{deep(6, '<article><p>Short text.</p></article>')}</body>", ["Short text."]),
    "classless": (f"<body><div><a href=a>Home</a> <a href=b>About</a></div><div><div>{S}</div><div>{S} {S}</div></div></body>", [S, f"{S} {S}"]),
    "two divs": ("<html><body><div><div>Short words here.</div></div></body></html>", ["Short words here."]),
    "blog": (f"<body class=home><div id=masthead><h1>My blog</h1></div><div id=wrap><div id=primary><div class='post hentry'><h2 class=entry-title>Post title</h2><div class=entry-content><p>{S}</p><blockquote><p>{S}</p></blockquote></div><div class=share-buttons><a href=x>Share</a></div></div><div id=comments><ol class=commentlist><li class=comment><p>Nice post, thanks.</p></li></ol></div></div><div id=secondary class=widget-area><h3>Archive</h3><ul><li><a href=j>June</a></li></ul></div></div><div id=colophon>Powered by words</div></body>", ["Post title", S, S]),
    "news": (f"<body><div class=topbar><a href=l>Log in</a></div><main><article class=news-story><h1>Big news</h1><div class=body><p>{S} {S} {S}</p><aside class=related><h3>Read also</h3><ul><li><a href=x>Other story</a></li></ul></aside><p>{S} {S}</p><div class=advert>Buy this now.</div><p>{S}</p></div></article><div class=cookie-banner><p>We use cookies.</p></div></main></body>", ["Big news", f"{S} {S} {S}", f"{S} {S}", S]),
    "bare": (f"<p>{S}</p>", [S]),
    "words": ("Just words.", ["Just words."]),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts_that_training_has_not(model, name):
    html, want = LAYOUTS[name]
    assert html_text.texts([html], model)[0].split("\n\n") == want


LONG = f"{S} {S} {S}"


def around(part):
    return f"<body><nav><a href=a>Home</a></nav><article><h1>Title here</h1><p>{LONG}</p>{part}<p>{LONG}</p></article><footer>c</footer></body>"


#: Pages that training has not: what stands in them, and the blocks of their main text.
KEPT = {
    **{name: (around(f"<section id={name}><h2>Part</h2><p>{LONG}</p><p>{LONG}</p></section>"), ["Title here", LONG, "Part", LONG, LONG, LONG]) for name in ("cookies", "follow-up", "social-policy", "share-prices", "legal-form", "subscribe-model", "search-methods", "footer-notes")},
    "details": (around(f"<details><summary>More on it</summary><p>{LONG}</p></details>"), ["Title here", LONG, "More on it", LONG, LONG]),
    "details of a class": (around(f"<details class=note><summary>More on it</summary><p>{S}</p></details>"), ["Title here", LONG, "More on it", S, LONG]),
    "form around all": (f"<body><form id=aspnetForm method=post><input type=hidden name=v value=1><div class=menu><ul><li><a href=a>Home</a></li><li><a href=b>B</a></li></ul></div><div id=content><h1>Title here</h1><p>{LONG}</p><p>{LONG}</p></div><div class=footer>c</div></form></body>", ["Title here", LONG, LONG]),
    "form alone": (f"<body><form id=aspnetForm><h1>Title here</h1><p>{LONG}</p></form></body>", ["Title here", LONG]),
    "header wrapper": (f"<body><div id=header-wrapper><article><h1>Title here</h1><p>{LONG}</p></article></div></body>", ["Title here", LONG]),
    "headline": (f"<body><header><a href=/>Site</a></header><article><header><h1>Title here</h1><p>By A. Name</p></header><p>{LONG}</p><p>{LONG}</p></article></body>", ["Title here", "By A. Name", LONG, LONG]),
    "hidden": (around("<p hidden>Not seen by anyone here.</p>"), ["Title here", LONG, LONG]),
    "hidden by style": (around(f"<div style='display:none'><p>{LONG}</p></div>"), ["Title here", LONG, LONG]),
    "links above": (f"<body><center><a href=a>Home</a> | <a href=b>News</a></center><h1>Title here</h1><p>{LONG}</p></body>", ["Title here", LONG]),
    "newsletter in an article": (around("<form class=newsletter><label>Mail</label><input><button>Go</button><p>Sign up now.</p></form>"), ["Title here", LONG, LONG]),
    "long sidebar": (f"<body><article><h1>Title here</h1><p>{LONG}</p></article><div class=sidebar><h3>Also</h3><p>{LONG}</p><p>{LONG}</p></div></body>", ["Title here", LONG]),
}


@pytest.mark.parametrize("name", KEPT)
def test_parts_that_look_like_clutter_and_wrappers(model, name):
    html, want = KEPT[name]
    assert html_text.texts([html], model)[0].split("\n\n") == want


BOX = "Words of clutter stand here, not of the article."
CLUTTER = {
    "related list": f"<section class=related><h3>{BOX}</h3><ul><li><a href=x>{BOX}</a></li></ul></section>",
    "short notice": f"<section class=notice><p>{BOX}</p></section>",
    "discussion of readers": f"<section id=discussion><h3>{BOX}</h3><div class=comment><p>{BOX}</p></div></section>",
    "menu": f"<div class=menu><p>{BOX}</p></div>",
    "share": f"<div class=share><p>{BOX}</p></div>",
    "advert": f"<div class=promo>{BOX}</div>",
    "aside": f"<aside><p>{BOX}</p></aside>",
}


@pytest.mark.parametrize("name", CLUTTER)
def test_clutter_goes_wherever_it_stands(model, name):
    box = CLUTTER[name]
    pages = [f"<body><nav><ul><li><a href=a>Home</a></li></ul></nav>{a}<article><h1>Title of it</h1><p>{S} {S}</p>{b}<p>{S}</p>{c}</article>{d}<footer>x</footer></body>" for a, b, c, d in ((box, "", "", ""), ("", box, "", ""), ("", "", box, ""), ("", "", "", box))]
    assert html_text.texts(pages, model) == [f"Title of it\n\n{S} {S}\n\n{S}"] * 4


def test_blocks_of_other_labelled_pages(model):
    f = html_text.forest([html_text.Dom(h) for h in html_text.labelled_pages(150, 78)])
    p, _ = html_text.beliefs(f, model.w, model.theta)
    own = np.array([any(r is not None and r[0] == i and r[1].strip() for r in d.runs) for d in f.doms for i in range(len(d.tags))])
    y, kept = html_text.labels_of(f)[own] == 1, p[own] > 0.5
    assert (y & kept).sum() / kept.sum() > 0.95 and (y & kept).sum() / y.sum() > 0.95


def test_end_tags_cost_the_same_at_any_depth(model):
    began = time.perf_counter()
    html_text.Dom("<div>" * 5000 + "</b></p></i></section>" * 20_000 + "x")
    html_text.Dom("<b><div>" + "<i>" * 5000 + "</b><li>" * 20_000)
    assert time.perf_counter() - began < 4


def test_odd_pages(model):
    got = html_text.texts([None, "", "   ", "<", "<article>", "</p></div>", "<article><p>" + "<b>" * 3000 + "deep", "<article><p>" + "w " * 200_000 + "</p></article>"], model)
    assert got[:6] == ["", "", "", "<", "", ""] and got[6] == "deep" and len(got[7]) == 399_999
    assert html_text.texts([], model) == []


def test_column(spark, model):
    from marketpipe.llm.shared import prepare

    prepare(spark)
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (1, "u", PAGE, "x")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string"), model).collect()
    assert sorted(r["page_id"] for r in got) == [1, 1, 2] and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["text"] for r in got if r["page_id"] == 1} == set(html_text.texts([PAGE], model)) and [r["text"] for r in got if r["page_id"] == 2] == [""]
    assert html_text.extract(spark.createDataFrame([], "page_id bigint, url string, html string"), model).count() == 0
