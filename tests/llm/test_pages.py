"""Main text: names that must not exclude text, containers by element, and whole tables through Spark."""

import pytest

from shelfsync.llm import pagetext

LONG = "Long sentence, with marks; it goes on and on for a while. " * 6
SAID = LONG.strip()


@pytest.mark.parametrize("part,shown", [
    ('<h2 id="related-work">Related work</h2>', "Related work"),
    ('<h2 id="search">Search</h2>', "Search"),
    ('<h2 id="share">Share</h2>', "Share"),
    (f'<section id="cookies"><h2>Baking</h2><p>{LONG}</p></section>', f"Baking {SAID}"),
    ('<section id="cookies"><p>Short one.</p></section>', "Short one."),
    ('<dl id="menu"><dt>Soup</dt><dd>hot</dd></dl>', "Soup hot"),
    ('<h2 class="section-header">Part two</h2>', "Part two"),
    ('<p class="ad-hoc">An ad hoc rule.</p>', "An ad hoc rule."),
    ('<p class="notice">Take notice.</p>', "Take notice."),
    ('<table class="table-header"><tr><th>a</th><td>b</td></tr></table>', "a b"),
    ('<p data-id="menu">One.</p>', "One."),
    ('<p data-role="banner">Two.</p>', "Two."),
    ('<p title="see id=menu">Three.</p>', "Three."),
    ('<div data-class="ad" title=\'class="ad"\'>Four.</div>', "Four."),
    ('<div class="widget-free no-ads">Five.</div>', "Five."),
    ('<span id="banner">Six.</span>', "Six."),
    ('<ul class="share"><li>Seven</li></ul>', "Seven"),
    (f'<div class="promo"><p>{LONG}</p></div>', SAID),          # the ratios say content
    # not article text
    ('<div class="ad">buy</div>', ""),
    ('<div CLASS = "x Ad y">buy</div>', ""),
    ("<div class=sidebar>links</div>", ""),
    ('<div id="share">links</div>', ""),
    ('<div role="navigation">links</div>', ""),
    ('<section class="related">links</section>', ""),
    (f'<div class="comments"><p>{LONG}</p></div>', ""),
    (f'<section id="comments"><p>{LONG}</p></section>', ""),
    (f'<ol class="comment-list"><li><p>{LONG}</p></li></ol>', ""),
    ("<aside>aside</aside><nav>nav</nav><form>form</form>", ""),
])
@pytest.mark.parametrize("root", ["article", "main"])
def test_names_inside_the_article(root, part, shown):
    page = f"<html><body><nav>menu</nav><{root}><h1>Title</h1><p>{LONG}</p>{part}<p>{LONG}</p></{root}><footer>f</footer></body></html>"
    assert pagetext.main_text(page) == " ".join(x for x in ("Title", SAID, shown, SAID) if x)


def test_container_is_an_element_not_a_path():
    menu, foot = "<div><ul><li>MENU1</li><li>MENU2</li></ul></div>", "<div>Copyright SITE</div>"
    body = f"<div><h1>HEADX</h1><p>{LONG}</p><ul><li>point</li></ul><p>Short.</p><p>{LONG}</p></div>"
    shown = f"HEADX {SAID} point Short. {SAID}"
    assert pagetext.main_text(f"<body>{menu}{body}{foot}</body>") == shown
    notice = "<div><p>We use small files, you know.</p></div>"
    assert pagetext.main_text(f"<body>{notice}{menu}{body}{notice}{foot}</body>") == shown
    two = f"<div>{body}{body}</div>"                            # text in two elements: what holds both
    assert pagetext.main_text(f"<body>{menu}{two}{foot}</body>") == f"{shown} {shown}"
    parts = "<div class='table-header'>" + f"<table class='menu-table'><tr><td>{LONG}</td></tr></table><h2 id='nav'>H</h2></div>"
    assert pagetext.main_text(f"<body>{menu}{parts}{foot}</body>") == f"{SAID} H"


def test_attributes():
    got = pagetext._attributes(""" a=1 B = 'x "y' c="p>q" d id=z ID="later" e='' """)
    assert got == {"a": "1", "b": 'x "y', "c": "p>q", "d": "", "id": "z", "e": ""}


def test_extract_through_spark(spark):
    schema = "page_id long, url string, html string, text string, n_chars string, block int"
    pages = [("<article><p>One &amp; <b>tw</b>o.</p></article>", "One & two."), (None, ""), ("", ""), ("plain", "plain"),
             ("<p>" + "x " * 50000 + "</p>", ("x " * 50000).strip()), ("<nav>menu</nav>", "")]
    rows = [(i, f"u{i}", h, "other", "y", 3) for i, (h, _) in enumerate(pages)]
    rows += [(None, None, "<p>no id</p>", None, None, None), rows[0], rows[0]]
    got = pagetext.extract(spark.createDataFrame(rows, schema).repartition(3))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(i, f"u{i}", t, len(t)) for i, (_, t) in enumerate(pages)]
    want += [(None, None, "no id", 5), want[0], want[0]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert pagetext.extract(spark.createDataFrame([], schema)).count() == 0
