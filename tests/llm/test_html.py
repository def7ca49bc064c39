"""Blocks, features and the tree, and the main text of pages."""

import numpy as np
import pytest

from bookledger.llm.html_blocks import (
    FEATURES,
    TOKEN,
    Leaf,
    Split,
    _attributes,
    blocks,
    extract_text,
    features,
    grow,
    judge,
    main_text,
    trained_tree,
)
from bookledger.llm.html_training import PAGES

TREE = trained_tree()
LONG = "Lyat edat onst, anst onble eredou eaor to edre of thheenti of atreon eswhly erti. "


def texts(page):
    return [b.text for b in blocks(page)]


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", []),
        ("  \n", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a<b>b</b>c<br>d<p>e", ["abc d", "e"]),
        ("<p>x &lt;b&gt; &amp;amp; caf&eacute;&#233;&#x41;&nbsp;z &am", ["x <b> &amp; caféé" + "A z &am"]),
        ("<script>var t='</p><p>no';</script>a<style>p{}</style><!-- <p>no --><p>b", ["a", "b"]),
        ("<p>cut <a href='x", ["cut"]),
        ("<p>cut<!-- open <p>no", ["cut"]),
        ("<p>a</p><script>never closed <p>no", ["a"]),
        ("</div></p>a</table>b", ["a", "b"]),
        ("<head><title>no</title><meta charset=x>", []),
        ("<head><title>no<body><p>title is never closed", []),
        ("<p hidden>no</p><p style='display: none'>no</p><span style=display:none>no</span><p>a > b < c", ["a > b < c"]),
        ("<div data-x='a>b'>quoted</div>", ["quoted"]),
        ("<ul><li>1<li>2</ul><select><option>no</select><button>no</button>", ["1", "2"]),
        ("<p>" + "deep " * 50_000, ["deep " * 49_999 + "deep"]),
        ("<div>" * 3000 + "x" + "</div>" * 3000, ["x"]),
    ],
)
def test_blocks(page, expected):
    assert texts(page) == expected


def test_features_hold_the_neighbours():
    rows = features(blocks("<p>one two <a>three four</a></p><nav>five</nav><h2>six seven</h2>"))
    at = {name: rows[:, i].tolist() for i, name in enumerate(FEATURES)}
    assert at["words"] == [4, 1, 2] and at["link_density"] == [0.5, 0, 0]
    assert at["previous_words"] == [0, 4, 1] and at["next_words"] == [1, 2, 0]
    assert at["previous_link_density"] == [0, 0.5, 0] and at["next_link_density"] == [0, 0, 0]
    assert at["mark"] == [0, -1, 0] and at["heading"] == [0, 0, 1]


def used(tree):
    return {FEATURES[tree.feature]} | used(tree.low) | used(tree.high) if isinstance(tree, Split) else set()


def test_links_and_neighbours_decide():
    """Words and link density of a block and of its neighbours stand in the tree, besides the mark."""
    assert {"mark", "words", "link_density"} <= used(TREE)
    assert used(TREE) & {"previous_link_density", "next_link_density"}


KEPT = [
    "<div class='site has-sidebar'><article>{}</article></div>",
    "<div class='content no-sidebar'>{}</div>",
    "<article class='post share-prices-rise'>{}</article>",
    "<form id='aspnetForm'><article>{}</article></form>",
    "<article><div title=it's>{}</div></article>",
    "<div class=header-page><main>{}</main></div>",
    "<article data-x='a\"b' \" class=post>{}</article>",
    "<div class='sidebar-layout'><article>{}</article></div>",
]


@pytest.mark.parametrize("container", KEPT)
def test_articles_are_not_lost(container):
    inside = f"<h1>Title of it</h1><p>{LONG}</p><p>{LONG}{LONG}</p><p>{LONG}</p>"
    assert main_text(f"<html><body>{container.format(inside)}</body></html>", TREE) == "\n\n".join(texts(inside))


LINKS = "<div><a href=/a>One of the many things to read</a> <a href=/b>Another of the many things to read</a> <a href=/c>A third</a></div>"


@pytest.mark.parametrize("container", ["{}", "<div class=content>{}</div>", "<div>{}</div>"])
def test_unnamed_links_go_by_their_density(container):
    """A plain reading of pages without an article element: paragraphs stay, bars of links and words between them go."""
    paragraphs = [LONG.strip(), "So be it.", f"{LONG}{LONG}".strip(), LONG.strip()]
    page = LINKS + "<p>Read this</p>" + LINKS + "".join(f"<p>{p}</p>" for p in paragraphs) + LINKS + "<p>And this</p>" + LINKS
    assert main_text(f"<body>{container.format(page)}</body>", TREE) == "\n\n".join(paragraphs)


@pytest.mark.parametrize(
    ("tag", "expected"),
    [
        ("<p title=it's>", {"title": "it's"}),
        ("<p class='a b' id=\"c\">", {"class": "a b", "id": "c"}),
        ("<p x' y\" z>", {"x'": "", 'y"': "", "z": ""}),
        ("<p a = 'b>c' d>", {"a": "b>c", "d": ""}),
        ("<p a=>", {"a": ""}),
    ],
)
def test_attributes(tag, expected):
    found = TOKEN.match(tag + "text")
    assert found["end"] == ">" and found.end() == len(tag)
    assert _attributes(found["attributes"]) == expected


def test_tree_learns_what_it_is_shown():
    rows = np.array([[0, 5.0], [0, 9], [1, 5], [1, 9], [0, 7]])
    tree = grow(rows, np.array([False, True, False, False, True]))
    assert isinstance(tree, Split)
    assert [judge(tree, r) for r in rows] == [False, True, False, False, True]
    assert grow(rows, np.zeros(5, dtype=bool)) == Leaf(False)


def test_tree_fits_its_table():
    judged = [
        (judge(TREE, row), b.keep == "1")
        for page in PAGES
        for b, row in zip(blocks(page), features(blocks(page)), strict=True)
        if b.keep is not None
    ]
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged)


AROUND = [
    "<header><h1>Site</h1><p>{}</p></header>", "<nav><ul><li><a href=/>x</a></li></ul></nav>", "<footer><p>{}</p></footer>",
    "<aside><p>{}</p></aside>", "<div class='sidebar-left'><p>{}</p></div>", "<div id=cookieNotice><p>{}</p></div>",
    "<div class='ad'>{}</div>", "<form><p>{}</p><input><textarea>{}</textarea></form>", "<script>var a = '<p>{}</p>';</script>",
    "<style>p{{}}</style>", "<section id=comments><article class=comment><p>{}</p></article></section>",
    "<div role=banner>{}</div>", "<div class='related-posts'><p>{}</p></div>", "<div class=advertisement><p>{}</p></div>",
    "<div class='newsletter signup'><p>{}</p></div>", "<noscript><p>{}</p></noscript>", "<div class='user-comments'><p>{}</p></div>",
]


@pytest.mark.parametrize("around", AROUND)
@pytest.mark.parametrize("container", ["<article>{}</article>", "<main><article>{}</article></main>", "<div id='content'>{}</div>"])
def test_what_surrounds_an_article_goes(around, container):
    noise = around.replace("{}", LONG).replace("{{", "{").replace("}}", "}")
    inside = f"<h1>Title</h1><p>{LONG}</p><p>De.</p><ul><li>a point</li></ul><p>{LONG}{LONG}</p>"
    if "content" in container:
        inside = f"<h1>Title</h1><p>{LONG}</p><p>De.</p><p>{LONG}{LONG}</p>"
    wanted = "\n\n".join(texts(inside))
    article = container.format(inside)
    assert main_text(f"<html><body>{noise}{article}{noise}</body></html>", TREE) == wanted


@pytest.mark.parametrize("noise", [a for a in AROUND if "<header" not in a and "<noscript" not in a])
def test_what_stands_inside_an_article_goes(noise):
    noise = noise.replace("{}", LONG).replace("{{", "{").replace("}}", "}")
    page = f"<body><article><header><h1>Title</h1></header><p>{LONG}</p>{noise}<p>The end.</p></article>"
    assert main_text(page, TREE) == f"Title\n\n{LONG.strip()}\n\nThe end."


SCHEMA = "page_id long, url string, html string, text string, n_chars long"


def test_pages(spark):
    article = f"<article><h1>T</h1><p>{LONG}</p></article>"
    rows = [(1, "u", article), (2, None, None), (3, "u", ""), (None, "u", article), (1, "u", article), (4, "u", "<nav>x</nav>")]
    frame = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    got = sorted(extract_text(frame).collect(), key=str)
    text = f"T\n\n{LONG.strip()}"
    assert got == sorted([(1, "u", text), (2, None, ""), (3, "u", ""), (None, "u", text), (1, "u", text), (4, "u", "")], key=str)
    assert extract_text(frame.where("false")).collect() == []


def test_test_pages_against_a_plain_reading(spark):
    import html
    import re

    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = {r["page_id"]: r["html"] for r in table.collect()}
    for row in extract_text(table).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[row["page_id"]], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
        plain = [" ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", "", p)).split()) for p in parts]
        assert row["text"] == "\n\n".join(p for p in plain if p)
