"""Main text of web pages by composite text density.

For each element the density is its characters per tag, adjusted by the share of link characters and
link tags in it against the whole body. The subtree with the greatest sum of its children's densities
is the content; the least density on the path from it to the body is the threshold above which other
subtrees count as content too. Elements that are no article text by their tag (menus, footers, scripts and
so on) are taken out before densities are computed. A word in a class or id, or a role, is evidence only: it
counts where the element's own density, its links or the text beside it agree (see _judge_marks).
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from clienttrail.llm.common import read_table, values_of

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Fixed values of HTML: elements without content, with raw text, that start blocks, that end a paragraph.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
_ENDS_PARAGRAPH = _BLOCKS - {"caption", "legend", "li", "td", "th", "tr", "tbody", "thead", "tfoot"}
_CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}

#: Elements that hold no article text, wherever they stand.
_DROPPED_TAGS = _RAW | frozenset(
    "head nav footer aside button select option datalist object embed canvas audio video applet "
    "dialog menu input label".split()
)
_DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form "
    "status tablist".split()
)
#: Words in a class or id that mark such elements.
_DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment "
    "comments consent cookie cookies copyright disqus footer login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pagination pager paywall popup promo promos "
    "promoted promotion recommended related replies respond responses share sharing sidebar signin "
    "signup social sponsor sponsored sponsors subscribe subscription toolbar topbar widget".split()
)
_COMMENT_WORDS = frozenset("comment comments disqus".split())
#: Words that say where or how large an element is, not what it holds: ad-box is as clear as ad.
_PLACE_WORDS = frozenset(
    "area article articles bar block blocks body bottom box btn button card cards center col column container "
    "content desktop entry fixed float form global group head header holder horizontal inline inner item items js "
    "large layout left link links list lower main mobile module outer overlay page panel placeholder popular post "
    "posts primary reader readers right row secondary section side site slot small sticky sub text title top unit "
    "upper user users vertical view wrap wrapper zone".split()
)
#: A marked element with text of its own has this many paragraphs, and less than this share of it in links.
_MIN_PARAGRAPHS, _MAX_LINKS = 2, 0.25
#: Text that is left of a page, in characters, below which even a comment section may be its content.
_LITTLE = 140
#: What is known of an element by its names: nothing; a hint; a clear name; a clear name of reader comments; hidden.
_NONE, _HINT, _CLEAR, _COMMENTS, _HIDDEN = range(5)


class _Node:
    __slots__ = ("tag", "parent", "parts", "mark", "dropped", "chars", "tags", "link_chars", "link_tags", "paragraphs")

    def __init__(self, tag: str, parent: _Node | None):
        self.tag, self.parent = tag, parent
        self.parts: list[_Node | str] = []
        self.mark, self.dropped = _NONE, False
        self.chars = self.tags = self.link_chars = self.link_tags = self.paragraphs = 0

    def children(self) -> list[_Node]:
        return [p for p in self.parts if type(p) is _Node and not p.dropped]


def _mark(tag: str, attributes: str) -> int:
    """What an element's tag, role, class, id and style say against its being article text."""
    if tag in _DROPPED_TAGS:
        return _HIDDEN
    mark = _CLEAR if tag == "form" else _NONE
    if not attributes.strip(" /") or tag in ("html", "body", "main"):
        return mark
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return _HIDDEN
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return _HIDDEN
        if name == "role" and value.lower().strip() in _DROPPED_ROLES:
            mark = max(mark, _CLEAR)
        if name in ("class", "id"):
            mark = max([mark, *(_named(tag, token) for token in value.split())])
    return mark


def _named(tag: str, token: str) -> int:
    words = {w.lower() for w in _NAME_PARTS.findall(token)}
    if words & _COMMENT_WORDS:
        return _COMMENTS
    if tag == "article" or not words & _DROPPED_WORDS:
        return _NONE
    return _HINT if words - _DROPPED_WORDS - _PLACE_WORDS else _CLEAR


def parse(page: str) -> _Node:
    """A lenient tree of a page; markup errors never lose text."""
    root = node = _Node("#root", None)
    at = 0
    for match in iter(_Scanner(page)):
        start, end, close, tag, attributes, raw = match
        if start > at:
            node.parts.append(page[at:start])
        at = end
        if not tag:
            continue
        if close:
            up = node
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                node = up.parent
            continue
        if tag in _ENDS_PARAGRAPH:
            node = _closed(node, {"p"}, {"table", "td", "th", "li", "blockquote", "div", "article", "section"})
        elif tag in _CLOSED_BY:
            node = _closed(node, *_CLOSED_BY[tag])
        if tag == "body" and (body := next((n for n in _up(node) if n.tag == "body"), None)):
            node = body  # a second body tag opens nothing
            continue
        child = _Node(tag, node)
        child.mark = _mark(tag, attributes)
        child.dropped = child.mark == _HIDDEN
        node.parts.append(child)
        if tag not in _VOID and not raw:
            node = child
    if at < len(page):
        node.parts.append(page[at:])
    return root


class _Scanner:
    """Tags of a page: (start, end, closing, name, attributes, raw); raw elements in one piece."""

    def __init__(self, page: str):
        self.page = page

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str, bool]]:
        page, at = self.page, 0
        while match := _TOKEN.search(page, at):
            at = match.end()
            tag = (match["tag"] or match["tag2"] or "").lower()
            closing = bool(match["close"] or match["close2"])
            attributes = match["attrs"] or match["attrs2"] or ""
            raw = tag in _RAW and not closing
            if raw:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style"):
                    at = len(page)
            yield match.start(), at, closing, tag, attributes, raw


def _up(node: _Node | None) -> Iterator[_Node]:
    while node is not None:
        yield node
        node = node.parent


def _closed(node: _Node, closing: set[str], barriers: set[str]) -> _Node:
    """The node that is open after an implied end tag of one of the closing elements."""
    for up in _up(node):
        if up.tag in closing:
            return up.parent
        if up.tag in barriers:
            break
    return node


def _in_order(root: _Node) -> list[_Node]:
    """All nodes that are not dropped, parents first."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += reversed(node.children())
    return out


def _count(nodes: list[_Node]) -> None:
    for node in reversed(nodes):
        own = sum(len(_SPACE.sub(" ", p).strip()) for p in node.parts if type(p) is str)
        children = node.children()
        node.chars = own + sum(c.chars for c in children)
        node.tags = sum(c.tags + 1 for c in children)
        node.paragraphs = (node.tag == "p") + sum(c.paragraphs for c in children)
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        else:
            node.link_chars = sum(c.link_chars for c in children)
            node.link_tags = sum(c.link_tags for c in children)


def density(node: _Node, body: _Node) -> float:
    """Composite text density; zero counts in denominators are taken as one."""
    chars, tags = node.chars, max(1, node.tags)
    if not chars:
        return 0.0
    links, link_tags, rest = max(1, node.link_chars), max(1, node.link_tags), max(1, chars - node.link_chars)
    base = math.log(chars / rest * node.link_chars + body.link_chars / max(1, body.chars) * chars + math.e)
    value = chars / links * tags / link_tags
    # The logarithm's base is above one; below two characters a tag the value may not exceed one.
    return chars / tags * math.log(max(value, 1.0)) / max(math.log(base), 1e-9) if base > 1 else chars / tags


def _content(body: _Node) -> tuple[list[_Node], float]:
    """The subtrees that hold the content, in page order, none within another; and the path's threshold."""
    nodes = _in_order(body)
    _count(nodes)
    densities = {id(n): density(n, body) for n in nodes}
    sums = {id(n): sum(densities[id(c)] for c in n.children()) for n in nodes}
    best: dict[int, _Node] = {}
    for node in reversed(nodes):
        best[id(node)] = max(
            [node, *(best[id(c)] for c in node.children())], key=lambda n: sums[id(n)]
        )
    top = best[id(body)]
    threshold = min(densities[id(n)] for n in _up(top) if id(n) in densities)
    marked = {id(top)}
    stack = [body]
    while stack:
        node = stack.pop()
        if densities[id(node)] >= threshold:
            marked.add(id(best[id(node)]))
            stack += node.children()
    found, inside = [], set()
    for node in nodes:
        if node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
        elif id(node) in marked:
            found.append(node)
            inside.add(id(node))
    return found, threshold


def _article(found: list[_Node], threshold: float, body: _Node) -> list[_Node]:
    """Content within article elements is these whole articles; a main element is narrowed to its articles.

    Beside the largest article others count if they hold found content or are as dense as the path to it, and are
    no link cards. What was found outside is kept where the articles hold less than half of it.
    """
    order = _in_order(body)
    articles = [n for n in order if n.tag in ("article", "main")]
    known = {id(n) for n in articles}
    outer = [n for n in articles if not any(id(u) in known for u in _up(n.parent))]
    if not outer:
        return found
    holders = {id(u) for n in found for u in _up(n)}

    def counts(node: _Node) -> bool:
        dense = id(node) in holders or density(node, body) >= threshold
        return dense and node.chars > 0 and node.link_chars < _MAX_LINKS * node.chars

    main = max(outer, key=lambda n: n.chars)
    chosen = [n for n in outer if n is main or counts(n)]
    if 2 * sum(n.chars for n in chosen) < sum(n.chars for n in found):
        return found
    out = []
    for node in chosen:
        # The articles of a main element, or of an article that is a list of them, without those inside others.
        parts = [n for n in _in_order(node) if n.tag == "article" and n is not node and counts(n)]
        inner = {id(n) for n in parts}
        parts = [n for n in parts if not any(id(u) in inner for u in _up(n.parent))]
        out += parts if parts and 2 * sum(n.chars for n in parts) >= node.chars else [node]
    return out


def _blocks(node: _Node, out: list[str]) -> None:
    """Append the texts of a subtree's blocks, in page order."""
    run: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
        if text:
            out.append(text)
        run.clear()

    stack: list[tuple[_Node, Iterator]] = [(node, iter(node.parts))]
    while stack:
        current, parts = stack[-1]
        part = next(parts, None)
        if part is None:
            stack.pop()
            if current.tag in _BLOCKS:
                flush()
        elif type(part) is str:
            run.append(part)
        elif part.tag in ("br", "wbr"):
            run.append(" " if part.tag == "br" else "")
        elif not part.dropped:
            if part.tag in _BLOCKS:
                flush()
            stack.append((part, iter(part.parts)))
    flush()


def main_text(page: str | None) -> str:
    """The article's text: white space in a block as one space, blocks joined by a line feed."""
    if not page:
        return ""
    root = parse(page)
    body = next((n for n in _in_order(root) if n.tag == "body"), root)
    _judge_marks(body)
    found = _article(*_content(body), body)
    out: list[str] = []
    for node in [*_heading(body, found), *found]:
        _blocks(node, out)
    return "\n".join(out)


def _judge_marks(body: _Node) -> None:
    """Drop the elements whose names speak against them and whose text does not speak for them.

    A hint in a name counts unless the element has paragraphs, few links and at least the body's density. A clear
    name counts unless the element holds more than half of the page's text, in paragraphs, and little is left
    without it: a quarter of its text, or for reader comments next to nothing.
    """
    nodes = _in_order(body)
    marked = [n for n in nodes if n.mark]
    if not marked:
        return
    _count(nodes)
    usual = density(body, body)
    for node in marked:
        texty = node.paragraphs >= _MIN_PARAGRAPHS and node.link_chars < _MAX_LINKS * node.chars
        node.dropped = not (node.mark == _HINT and texty and density(node, body) >= usual)
    left = _plain_chars(body)
    for node in marked:
        if not node.dropped or node.paragraphs < _MIN_PARAGRAPHS or 2 * node.chars <= body.chars:
            continue
        enough = _LITTLE if node.mark == _COMMENTS else (node.chars - node.link_chars) / 4
        if left < enough and not any(u.dropped for u in _up(node.parent)):
            node.dropped = False
            left += _plain_chars(node)


def _plain_chars(top: _Node) -> int:
    """Characters outside links of a subtree, without what is dropped in it."""
    total, stack = 0, [top]
    while stack:
        node = stack.pop()
        if node.tag != "a":
            total += sum(len(_SPACE.sub(" ", p).strip()) for p in node.parts if type(p) is str)
            stack += node.children()
    return total


def _heading(body: _Node, found: list[_Node]) -> list[_Node]:
    """The page's first h1, if it stands before the content rather than in it."""
    order = _in_order(body)
    first = next((n for n in order if n.tag == "h1"), None)
    if first is None or not found:
        return []
    if any(n in found for n in _up(first)) or any(n is first for f in found for n in _up(f)):
        return []
    place = {id(n): i for i, n in enumerate(order)}
    return [first] if place[id(first)] < min(place[id(n)] for n in found) else []


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in values_of(batch.column("html"))]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes],
            ["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text (empty if there is none or html is null), n_chars.

    Rows are judged one by one: repeated rows give equal results, nulls in page_id and url stay, an empty table gives
    none, columns beside the three are not read. Of subtrees with equal sums the outermost is taken. Long and deep
    pages are read whole, in one pass over their elements for each step.
    """
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )


def op2_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))
