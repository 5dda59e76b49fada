from __future__ import annotations

import html
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clienttrail.llm import html_text
from clienttrail.llm.html_text import main_text

LONG = "This sentence is here to be long enough for an article, with words and more words. "
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav>'


def plain_article(page):
    """Text of the test tables' pages, whose articles hold h1, p, b and br only."""
    inside = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = [re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:h1|p)>", inside.replace("<b>", ""))]
    texts = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
    return "\n".join(t for t in texts if t)


def test_whole_table(spark, small_dir):
    got = {r["page_id"]: r for r in html_text.op2_text_density(spark, small_dir).collect()}
    pages = spark.read.parquet(f"{small_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        row = got[page["page_id"]]
        assert row["text"] == plain_article(page["html"])
        assert row["url"] == page["url"] and row["n_chars"] == len(row["text"])


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b", "a\nb"),
        ("<div><div><div", ""),
        ("<" * 500, "<" * 500),
        ("<article><p>one <b>two</b>\n three&nbsp;four</p></article>", "one two three four"),
        ("<p>x</p><script>var a = '<p>no</p>'</script><style>p{}</style><!-- <p>no --><p>y", "x\ny"),
        (f"<body>{NAV}<p>{LONG}</p><p>{LONG}", f"{LONG.strip()}\n{LONG.strip()}"),
        ("<main><ul><li>one<li>two</ul><table><tr><td>c<td>d</table></main>", "one\ntwo\nc\nd"),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes", "yes"),
        ("<textarea>no</textarea><p>yes</p><form><p>no</p></form>", "yes"),
        ("a<br>b<wbr>c", "a bc"),
        ("<p>1 &lt; 2 &copy; &#233;&eacute;", "1 < 2 © éé"),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_page_without_article_elements():
    page = f"""<body><div class="site-header"><a href="/">Home</a> <a href="/x">More</a></div>
    <div id="cookie-notice">We use cookies. {LONG}</div>
    <div id="wrap"><h1>Headline</h1><div><div class="entry"><p>{LONG}</p><div class="ad-box">{LONG}</div>
    <ul><li>point one<li>point two</ul><p>Short.</p><p>{LONG}</p></div></div>
    <div class="sidebar"><ul><li><a href="1">Popular one</a></li><li><a href="2">Popular two</a></li></ul></div></div>
    <div id="comments"><p>Reader: {LONG * 5}</p></div><footer>{LONG}</footer></body>"""
    text = LONG.strip()
    assert main_text(page) == f"Headline\n{text}\npoint one\npoint two\nShort.\n{text}"


def test_links_count_against_a_block():
    links = "".join(f'<a href="{i}">a link with some words in it</a> ' for i in range(30))
    page = f"<body><div><div>{links}</div></div><div><p>{LONG * 3}</p><p>{LONG * 2}</p></div></body>"
    assert main_text(page) == f"{(LONG * 3).strip()}\n{(LONG * 2).strip()}"


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert main_text(deep) == "x"
    many = "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>"
    assert main_text(many).count("\n") == 2999


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("<>/pabdiv \"'=!-&;x"), max_size=60))
def test_any_markup_gives_text(page):
    assert isinstance(main_text(page), str)


def test_odd_rows(spark):
    kinds = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, None, None, "x", 1), (None, "u", "<p>a", "x", 1), (2, "u", "<p>a", None, 1), (2, "u", "<p>a", None, 1)]
    got = html_text.extract_pages(spark.createDataFrame(rows, kinds)).collect()
    wanted = [(1, None, "", 0), (None, "u", "a", 1), (2, "u", "a", 1), (2, "u", "a", 1)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))
    assert html_text.extract_pages(spark.createDataFrame([], kinds)).count() == 0


PARAGRAPHS = "".join(f"<p>Paragraph {i}. {LONG}</p>" for i in range(8))
WHOLE = "\n".join(f"Paragraph {i}. {LONG.strip()}" for i in range(8))


def paragraphs(name, count):
    return "".join(f"<p>{name} {i}. {LONG}</p>" for i in range(count))


def lines(name, count):
    return [f"{name} {i}. {LONG.strip()}" for i in range(count)]


@pytest.mark.parametrize("around", ["<body>{}", "<body><main>{}</main>"])
def test_sibling_articles_are_kept(around):
    two = f"<article>{paragraphs('One', 8)}</article><article>{paragraphs('Two', 7)}</article>"
    card = f'<article><h3><a href="/x">A headline of another story to read</a></h3><p>Short words.</p></article>'
    page = around.format(two + card * 4)
    assert main_text(NAV + page) == "\n".join(lines("One", 8) + lines("Two", 7))


@pytest.mark.parametrize(
    "page",
    [
        '<main><div class="elementor-widget">{}</div></main>',
        '<main><div class="widget">{}</div></main>',
        '<article><div class="social-story">{}</div></article>',
        '<body><form id="aspnetForm"><div>{}</div></form></body>',
        '<body><div role="dialog"><div class="promo">{}</div></div></body>',
    ],
)
def test_a_name_alone_drops_no_article(page):
    assert main_text(NAV + page.format(PARAGRAPHS)) == WHOLE


def test_a_named_part_of_the_story_stays():
    part = f'<section class="responses-of-the-state">{paragraphs("State", 4)}</section>'
    page = f"<body>{NAV}<div><div>{paragraphs('Story', 5)}</div>{part}</div></body>"
    assert main_text(page) == "\n".join(lines("Story", 5) + lines("State", 4))


@pytest.mark.parametrize("names", ['id="comments"', 'class="story-comments"', 'class="readerComments list"'])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_comments_go_however_long(names, tag):
    comments = f"<section {names}>{paragraphs('Reader', 30)}</section>"
    page = f"<body>{NAV}<{tag}>{paragraphs('Story', 4)}</{tag}>{comments}</body>"
    assert main_text(page) == "\n".join(lines("Story", 4))


def test_hidden_text_is_never_taken_back():
    page = f"<body><div hidden>{PARAGRAPHS}</div><p>Seen.</p></body>"
    assert main_text(page) == "Seen."


def literal_sums(tree):
    """Composite density and its sums by the published formula, from trees (tag, text, children)."""

    def measure(node):
        tag, text, children = node
        parts = [measure(c) for c in children]
        chars = len(text) + sum(m["C"] for m in parts)
        tags = sum(m["T"] + 1 for m in parts)
        links = chars if tag == "a" else sum(m["LC"] for m in parts)
        link_tags = tags + 1 if tag == "a" else sum(m["LT"] for m in parts)
        return {"C": chars, "T": tags, "LC": links, "LT": link_tags, "parts": parts}

    body = measure(tree)

    def density(m):
        if m["C"] == 0:
            return 0.0
        per_tag = m["C"] / max(1, m["T"])
        ratio = (m["C"] / max(1, m["LC"])) * (max(1, m["T"]) / max(1, m["LT"]))
        other = max(1, m["C"] - m["LC"])
        base = math.log(m["C"] / other * m["LC"] + body["LC"] / max(1, body["C"]) * m["C"] + math.e)
        return per_tag * math.log(max(ratio, 1.0)) / max(math.log(base), 1e-9) if base > 1 else per_tag

    def walk(m):
        yield density(m), sum(density(c) for c in m["parts"])
        for c in m["parts"]:
            yield from walk(c)

    return list(walk(body))


trees = st.recursive(
    st.tuples(st.sampled_from(["div", "a", "b", "p"]), st.text("xyz", max_size=40), st.just([])),
    lambda inner: st.tuples(st.sampled_from(["div", "b"]), st.text("xyz", max_size=40), st.lists(inner, max_size=4)),
    max_leaves=12,
)


@settings(max_examples=200, deadline=None)
@given(trees)
def test_density_against_the_formula(tree):
    def build(node, parent):
        made = html_text._Node(node[0], parent)
        made.parts = [node[1], *(build(c, made) for c in node[2])]
        return made

    body = build(("body", tree[1], [tree]), None)
    nodes = html_text._in_order(body)
    html_text._count(nodes)
    got = [html_text.density(n, body) for n in nodes]
    sums = [sum(html_text.density(c, body) for c in n.children()) for n in nodes]
    wanted = literal_sums(("body", tree[1], [tree]))
    assert got == pytest.approx([d for d, _ in wanted]) and sums == pytest.approx([t for _, t in wanted])
    found, threshold = html_text._content(body)
    best = max(sums)
    tops = [n for n, t in zip(nodes, sums) if t == pytest.approx(best)]
    assert any(f is n for f in found for t in tops for n in html_text._up(t))
