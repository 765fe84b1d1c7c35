import html
import itertools
import random
import re

import numpy as np
import pytest

from tidemark.llm.page_text import (
    FEATURES,
    Flow,
    Page,
    PageRules,
    block_features,
    content_blocks,
    extract_text,
    fit_weights,
    main_text,
    train_weights,
)

PRIOR = np.array(PageRules().prior)


def text_of(source):
    return main_text(source, PRIOR)


def test_given_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {row["page_id"]: row for row in extract_text(pages).collect()}
    assert len(found) == pages.count()
    for row in pages.collect():
        article = re.search(r"<article>(.*)</article>", row["html"], re.S)[1]
        expected = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert found[row["page_id"]]["text"] == expected
        assert found[row["page_id"]]["n_chars"] == len(expected)
        assert found[row["page_id"]]["url"] == row["url"]


PARTS = {
    "menu": '<ul class="menu"><li><a href=/a>Home</a><li><a href=/b>Away &amp; more</a></ul>',
    "header": "<header><a href=/>Site</a><h2>The site of sites</h2></header>",
    "footer": "<footer>&copy; 2024 Somebody. All rights are with them, and so on.</footer>",
    "sidebar": "<aside><p>Other things that were written here, at some length.</p></aside>",
    "notice": '<div id="cookie-notice">We use cookies, as all do. Go on if you like.</div>',
    "advert": '<div class="ad-slot big">Buy this thing now, it is cheap. It really is.</div>',
    "form": "<form>Your name, please: <input name=q><button>Send it now</button></form>",
    "script": "<script>if (a < b) { document.write('<p>not text</p>'); }</script>",
    "style": "<style>p > b { color: red }</style>",
    "comments": '<section id="comments"><article><p>I liked this very much, truly.</p></article></section>',
    "markup": "<!-- <p>Hidden words here.</p> -->",
    "hidden": '<p style="display: none">Nobody sees these words, ever.</p>',
}


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("outer", ["article", "main", 'div class="post-content"'])
def test_parts_that_are_not_the_article(part, outer):
    close = outer.split()[0]
    # A header inside the article is the article's own.
    within = "" if part == "header" else PARTS[part]
    page = (
        f"<html><body class='has-sidebar'>{PARTS[part]}<{outer}><h1>A title</h1><p>First words, which go on for"
        f" a while &amp; end.<p>Short.{within}<p>Last words of it, and they end here.</{close}>{PARTS[part]}</body>"
    )
    assert text_of(page) == (
        "A title First words, which go on for a while & end. Short. Last words of it, and they end here."
    )


@pytest.mark.parametrize(
    "inner, expected",
    [
        ("a<b>b</b>c <i>d</i>", "abc d"),
        ("<p>one<br>two\n\n three&nbsp;four</p>", "one two three four"),
        ("<p>&lt;b&gt; &#x41;&#66; &eacute; &unknown; &", "<b> AB é &unknown; &"),
        ("x < y and y > z", "x < y and y > z"),
        ("<a title='>' href=\"it's\">quoted</a>", "quoted"),
        ("<ul><li>one<li>two</ul>", "one two"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<p>open <b>bold<p>next</b></div></span> end", "open bold next end"),
        ("<P>Upper</P><DiV>case</dIv>", "Upper case"),
        ("<p a=\"never closed>all the rest", "all the rest"),
        ("<object>seen", "seen"),
        ("<p>before<script>never closed <p>gone", "before"),
        ("<p>before<!-- never closed <p>gone", "before"),
        ("<p>before<", "before<"),
        ("<header><h1>Its title</h1></header><p>text", "Its title text"),
    ],
)
def test_odd_markup(inner, expected):
    assert text_of(f"<article>{inner}") == expected


@pytest.mark.parametrize("source", [None, "", " \n", "<article></article>", "<nav>Only a menu, as it is.</nav>", "<", "<!--"])
def test_pages_without_content(source):
    assert text_of(source) == ""


def test_plain_pages_without_marks():
    prose = "Words of prose stand here, one after the other, and more follow them. " * 4
    page = f"<div><a href=/>Home</a> <a href=/x>News</a></div><div><p>{prose}</p><p>So it is.</p><p>{prose}</p></div><div><a href=/>Terms</a></div>"
    assert text_of(page) == " ".join([*prose.split(), "So it is.", *prose.split()])


def test_cut_is_the_cheapest_labelling():
    """Against all labellings of blocks and elements of small random pages."""
    rng = random.Random(5)
    rules = PageRules()
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            tag = rng.choice(["p", "div", "li", "nav", "section"])
            text = rng.choice(["Short", "a longer run of words, with marks.", "<a>linked words</a>", ""])
            parts.append(f"<{tag}>{text}{rng.choice(['', f'</{tag}>'])}")
        page = Page("<div>" + "".join(parts))
        count = len(page.blocks)
        elements = sorted({e for b in page.blocks for e in _above(page, b.element)})
        if count + len(elements) > 12 or not count:
            continue
        weights = np.array([rng.uniform(-2, 2) for _ in FEATURES])
        got = content_blocks(page, weights, rules)
        best, labelling = None, {}
        for sides in itertools.product([False, True], repeat=count + len(elements)):
            cost = _cost(page, weights, rules, sides, elements)
            best = cost if best is None else min(best, cost)
            key = sides[:count]
            labelling[key] = min(labelling.get(key, cost), cost)
        assert labelling[tuple(got)] == pytest.approx(best, abs=1e-6)


def _above(page, element):
    while element > 0:
        yield element
        element = page.elements[element].parent


def _cost(page, weights, rules, sides, elements):
    learned = np.array([name not in ("away", "main") for name in FEATURES])
    features = block_features(page)
    part = np.clip(features[:, learned] @ weights[learned], -rules.most_from_text, rules.most_from_text)
    odds = part + features[:, ~learned] @ weights[~learned]
    place = {e: len(page.blocks) + i for i, e in enumerate(elements)}
    total = sum(-o if s and o < 0 else o if not s and o > 0 else 0 for o, s in zip(odds, sides))
    for i, block in enumerate(page.blocks):
        if block.element > 0:
            total += rules.inside * (sides[i] != sides[place[block.element]])
        if i:
            before = page.blocks[i - 1].element
            near = before == block.element or page.elements[before].parent == page.elements[block.element].parent
            total += (rules.beside if near else rules.across) * (sides[i] != sides[i - 1])
    for e in elements:
        parent = page.elements[e].parent
        one, other = page.elements[e], page.elements[parent]
        if parent > 0 and one.away == other.away and one.main == other.main:
            total += rules.inside * (sides[place[e]] != sides[place[parent]])
    return total


def test_flow_of_a_known_graph():
    flow = Flow(6)
    for a, b, room in [(0, 1, 16), (0, 2, 13), (1, 2, 10), (2, 1, 4), (1, 3, 12), (3, 2, 9), (2, 4, 14), (4, 3, 7), (3, 5, 20), (4, 5, 4)]:
        flow.join(a, b, float(room), 0.0)
    assert flow.saturate(0, 5) == [True, True, True, False, True, False]


def test_training(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = train_weights(pages)
    assert (weights == train_weights(pages.repartition(5))).all()
    assert fit_weights(np.zeros((0, len(FEATURES))), np.zeros(0), PageRules()).tolist() == list(PRIOR)


def test_odd_rows_and_names(spark):
    long = "<article>" + "<p>some words, said again.</p>" * 3000 + "</article>"
    rows = [(None, None, None), (1, "u", None), (1, "u", ""), (1, "u", ""), (2, None, long), (3, "v", "<p" * 2000), (4, "w", "<a b='" * 999)]
    frame = spark.createDataFrame([(*r, "t", 5, 0) for r in rows], "page_id long, url string, html string, text string, n_chars int, label int")
    found = sorted(map(tuple, extract_text(frame, weights=PRIOR).collect()), key=str)
    said = " ".join(["some words, said again."] * 3000)
    assert found == sorted(
        [(None, None, "", 0), (1, "u", "", 0), (1, "u", "", 0), (1, "u", "", 0), (2, None, said, len(said)), (3, "v", "", 0), (4, "w", "", 0)],
        key=str,
    )
    assert extract_text(frame.limit(0)).count() == 0
