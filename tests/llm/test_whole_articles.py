"""Pages made of known parts: the text of the article comes out whole, to the block, and nothing that stands around it."""

import html
import random

import pytest

from kasane.llm import mainhtml

WORDS = "stone river lantern über 漢字 a&b <tag> walk seven quiet morning harbour".split()
AROUND = [
    "<nav><ul><li><a href=/>Home</a></li><li><a href=/x>About us and all that we do here every day of the long year</a></li></ul></nav>",
    '<div class="sidebar"><p>{long}</p></div>',
    "<footer><p>{long}</p></footer>",
    '<div id="comments"><p>{long}</p><p>{long}</p></div>',
    "<script>var x = '<p>{long}</p>';</script>",
    '<form><input><p>Your name, please, and {long}</p></form>',
    '<div class="ad-banner">{long}</div>',
]


def said(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def block(rng):
    """(markup, texts) of a block of an article, of any length, linked or not."""
    kind = rng.choice(["p", "p", "p", "h2", "ul", "link", "pre", "quote", "table"])
    text = said(rng, rng.choice([1, 2, 5, 30, 60]))
    shown = html.escape(text)
    if kind == "ul":
        items = [said(rng, rng.randint(1, 4)) for _ in range(rng.randint(1, 4))]
        return "<ul>" + "".join(f"<li><a href=/i>{html.escape(x)}</a>" for x in items) + "</ul>", items
    if kind == "link":
        return f'<p><a href="/l">{shown}</a></p>', [text]
    if kind == "quote":
        return f"<blockquote><p>{shown}</p></blockquote>", [text]
    if kind == "table":
        return f"<table><tr><td>{shown}<td><b>x</b> y</table>", [text, "x y"]
    return f"<{kind}>\n {shown.replace(' ', chr(10) + ' ', 1)} </{kind}>", [text]


@pytest.mark.parametrize("seed", range(60))
def test_planted_article(seed):
    rng = random.Random(seed)
    blocks = [block(rng) for _ in range(rng.randint(0, 6))]
    at = rng.randint(0, len(blocks))
    long = said(rng, 200)  # one block of weight, anywhere in the article
    blocks.insert(at, (f"<p>{html.escape(long)}</p>", [long]))
    blocks.insert(rng.randint(0, len(blocks)), ("<p>tail " + html.escape(long) + "</p>", ["tail " + long]))
    around = [x.replace("{long}", html.escape(said(rng, rng.randint(5, 60)))) for x in rng.sample(AROUND, rng.randint(0, len(AROUND)))]
    k = rng.randint(0, len(around))
    name = rng.choice(['div id="content"', "article", "main", 'section class="story-text"'])
    page = f"<html><head><title>t</title></head><body>{''.join(around[:k])}<{name}>{''.join(m for m, _ in blocks)}</{name.split()[0]}>{''.join(around[k:])}</body></html>"
    assert mainhtml.main_text(page).split("\n") == [t for _, texts in blocks for t in texts]


def test_what_stands_before_the_first_surge():
    page = '<body><nav>m</nav><div id=content><h1>T</h1><p>Lead.</p><h2>Sub</h2><ul><li><a href=a>one</a><li><a href=b>two</a><li><a href=c>three</a></ul><p>' + "long text " * 40 + "</p><p>End.</p></div></body>"
    assert mainhtml.main_text(page).split("\n") == ["T", "Lead.", "Sub", "one", "two", "three", ("long text " * 40).strip(), "End."]
    assert mainhtml.main_text("<body><p><a href=x>a paragraph that is a link</a></p><p>short</p></body>") == "a paragraph that is a link\nshort"
    assert mainhtml.main_text("<body><p>Lead.</p><p>" + "long text " * 40 + "</p><p>End.</p></body>").split("\n")[::2] == ["Lead.", "End."]
