"""HTML extraction by composite text density.

Each DOM node has a density: its characters per tag, adjusted for the share of characters and tags
that belong to links. A node's density sum adds up its children's; the node of the greatest sum is
the heart of the page. The least density on the path from it to the body is the page's threshold:
outside the heart, what is as dense is content too. Elements that say they are no part of an
article (menus, forms, scripts, hidden ones, ...) are left out before anything is counted; a class or id
that names an advert, comments and the like counts only if links or thin text agree (``settle``).

``article`` and ``main`` widen or narrow that choice. A heart within an article gives the whole article; one
within ``main`` gives ``main`` less what lies beside the heart, is less dense than the threshold and mostly
links. A heart that holds articles gives them alone if they have half of its text without links, or the
one with the page's only ``h1``; else the heart stays. Articles less dense than the threshold are left out
of a heart or ``main`` of which articles have less than half of the text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, sliced, trim, without

#: Kinds of elements, and words in class names and ids.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
LEFT_OUT = frozenset("head script style noscript template nav footer aside form button select option textarea input label iframe svg canvas object embed dialog menu title audio video map datalist".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption body html dd dt li legend summary".split())
#: A start tag ends an open element of these names, unless one of the others stands between.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)), "option": (("option",), ("select",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr")), "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
}
NOISE = frozenset("ad ads adbox adslot banner promo promotion promotions nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead consent notice notices gdpr popup modal overlay disqus respond reply replies responses related recommended recommendations share sharing social newsletter subscribe subscription signup login search widget widgets pagination pager toolbar skip alert toast".split())
NOISE_BEGINS = ("advert", "sponsor", "cookie", "comment", "discussion")
#: Names of what readers write; it may be most of a page and have articles of its own.
REPLIES = ("comment", "discussion", "disqus", "repl", "respond")
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_TAG = re.compile(r"""<!--(?:.*?-->|.*)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "children", "out", "name", "in_article", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: "Node | None", out: bool, name: str = "", in_article: bool = False):
        self.tag, self.parent, self.out = tag, parent, out
        self.name, self.in_article = name, in_article  # the word of its class or id that speaks against it
        self.children: list = []  # nodes and strings
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _noisy(tag: str, attributes: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element says itself that it is left out, else the word of its class or id that hints at it."""
    if tag in LEFT_OUT:
        return True, ""
    if tag == "header":
        return not in_article, ""
    if not attributes or tag in ("html", "body", "article", "main"):
        return False, ""
    hint = ""
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, ""
        if name == "role" and value.lower() in NOISE_ROLES:
            return True, ""
        # ids of headings and within an article are made from titles
        if not hint and (name == "class" or (name == "id" and not in_article and tag not in HEADINGS)):
            hint = _hint(value, in_article)
    return False, hint


def _hint(value: str, in_article: bool) -> str:
    for one in value.split():
        parts = [p.lower() for p in _PART.split(one) if p]
        if not parts or parts[0] in ("has", "with", "no", "without", "is"):
            continue
        for p in (parts[0], parts[-1]):
            if p.startswith(NOISE_BEGINS) or (p in NOISE and not (p == "header" and in_article)):
                return p
    return ""


def parse(page: str) -> Node:
    """The tree of a page: unclosed elements end where HTML has them end, stray end tags are passed over."""
    root = Node("html", None, False)
    at, stack = 0, [root]
    names = ["html"]
    find = _TAG.search
    while True:
        found = find(page, at)
        text = page[at : found.start() if found else len(page)]
        if text:
            stack[-1].children.append(text)
        if not found:
            return root
        at = found.end()
        closing, name, rest = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            if name in names[1:]:
                while names[-1] != name:
                    names.pop()
                    stack.pop()
                names.pop()
                stack.pop()
            continue
        if name == "html":
            continue
        if name in CLOSES_P and "p" in names:
            _end(stack, names, ("p",), ("td", "th", "button", "object", "article", "section", "div", "li", "table"))
        if name in IMPLIED:
            _end(stack, names, *IMPLIED[name])
        parent = stack[-1]
        in_article = "article" in names or "main" in names
        out, hint = _noisy(name, rest, in_article)
        node = Node(name, parent, parent.out or out, hint, in_article)
        parent.children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            if name in ("textarea", "title"):
                node.children.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif name not in VOID and not rest.endswith("/"):
            stack.append(node)
            names.append(name)
        elif name not in VOID and name in BLOCK:  # "<p/>" opens a paragraph all the same
            stack.append(node)
            names.append(name)


def _end(stack: list, names: list, these: tuple, within: tuple) -> None:
    for i in range(len(names) - 1, 0, -1):
        if names[i] in these:
            del stack[i:], names[i:]
            return
        if names[i] in within:
            return


def _nodes(root: Node) -> list[Node]:
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(x for x in node.children if isinstance(x, Node) and not x.out)
    return order


def measure(root: Node) -> list[Node]:
    """Counts, densities and density sums of all nodes not left out, parents before children."""
    order = _nodes(root)
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for x in node.children:
            if isinstance(x, str):
                node.chars += len("".join(x.split())) if "&" not in x else len("".join(entities.unescape(x).split()))
            elif not x.out:
                node.chars += x.chars
                node.tags += x.tags + 1
                node.link_tags += x.link_tags + (x.tag == "a")
                node.link_chars += x.link_chars if x.tag != "a" else x.chars
    whole, links = max(1, root.chars), root.link_chars
    for node in reversed(order):
        c, t, lc, lt = max(1, node.chars), max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
        plain = max(1, node.chars - node.link_chars)
        base = math.log(c / plain * node.link_chars + links / whole * c + math.e)
        # both logarithms one up, so that a node without links has a density too
        node.density = node.chars / t * math.log(1 + max(1.0, c / lc * t / lt)) / math.log(1 + base)
        # words set off within a block are no part beside it: their elements hand on what blocks they hold
        node.total = sum(x.density if x.tag in BLOCK else x.total for x in node.children if isinstance(x, Node) and not x.out)
    return order


def _within(node: Node, above: Node) -> bool:
    while node is not None and node is not above:
        node = node.parent
    return node is above


def _path(order: list[Node]) -> list[Node]:
    """The nodes from the heart of a measured page to its root."""
    heart = max(order, key=lambda n: n.total)  # of equal sums the first in the page's order
    if not heart.total:
        heart = max(order, key=lambda n: n.density)
    path = [heart]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def _to_body(path: list[Node]) -> list[Node]:
    return path[: next((i for i, n in enumerate(path) if n.tag == "body"), len(path) - 1) + 1]


def settle(root: Node) -> tuple[list[Node], list[Node]]:
    """The measured page and the path from its heart, less the elements whose name and text both speak against them.

    A name counts if a third of the text is in links or if it has few characters a tag: within the heart or an
    article, less than half of the least on the path from the heart to the body; elsewhere, less than the heart.
    It does not count where half of the page's text and its title, ``main`` or an article are in the element.
    """
    order = measure(root)
    named = [n for n in order if n.name]
    if not named or not root.chars:
        return order, _path(order)
    titled, framing = set(), set()
    for n in reversed(order):
        if (n.tag in ("h1", "main") and n.chars) or id(n) in titled:
            titled.add(id(n.parent))
        if (n.tag == "article" and n.chars) or id(n) in framing:
            framing.add(id(n.parent))
    whole = root.chars - root.link_chars
    facts = []  # of each element as it stands: whether it has few links, and its plain characters a tag
    for n in named:
        plain = n.chars - n.link_chars
        frame = 2 * plain >= whole and (id(n) in titled or (id(n) in framing and not n.name.startswith(REPLIES)))
        if not frame:
            n.out = True
            facts.append((n, 3 * n.link_chars < n.chars, plain / (n.tags + 1)))
    order = measure(root)
    if 10 * (root.chars - root.link_chars) < whole:  # nearly all is so named: the names say nothing
        for n, few, _ in facts:
            n.out = not few
        order = measure(root)
    path = _path(order)
    heart, ratio = path[0], lambda n: (n.chars - n.link_chars) / (n.tags + 1)
    inner, outer = min(map(ratio, _to_body(path))) / 2, ratio(heart)
    back = [n for n, few, r in facts if n.out and few and r >= (inner if n.in_article or _within(n, heart) else outer)]
    for n in back:
        n.out = False
    return (measure(root) if back else order), path


def _outermost(frame: Node) -> list[Node]:
    """The articles and mains in ``frame`` that are in no other in it, in page order."""
    found, todo = [], [frame]
    while todo:
        node = todo.pop()
        if node is not frame and node.tag in ("article", "main"):
            found.append(node)
        else:
            todo.extend(x for x in reversed(node.children) if isinstance(x, Node) and not x.out and x.chars)
    return found


def _selection(order: list[Node], path: list[Node], threshold: float) -> tuple[set[int], set[int]]:
    """What is taken, and what of it is passed over; ``path`` leads from the heart to the root."""
    heart, above = path[0], {id(n) for n in path}
    articles, mains = [n for n in path if n.tag == "article"], [n for n in path if n.tag == "main"]
    if articles:
        return {id(articles[-1])}, set()
    thin = [n for n in order if id(n) not in above and n.density < threshold]
    frame = mains[-1] if mains else heart
    outer = _outermost(frame)
    most = bool(outer) and 2 * sum(n.chars - n.link_chars for n in outer) >= frame.chars - frame.link_chars
    cards = set() if most else {id(n) for n in thin if n.tag == "article"}
    if mains:
        beside = {id(n) for n in _nodes(frame)} - {id(n) for n in _nodes(heart)}
        return {id(frame)}, cards | {id(n) for n in thin if 2 * n.link_chars > n.chars and id(n) in beside}
    if most:  # the heart is no more than their frame
        return {id(n) for n in outer}, set()
    titles = [n for n in order if n.tag == "h1" and n.chars]
    titled = [n for n in outer if len(titles) == 1 and _within(titles[0], n)]
    if titled:  # the page's one title says which is its article
        return {id(titled[0])}, set()
    dense = {id(n) for n in order if id(n) not in above and n.density >= threshold and n.chars > 0}
    return {id(heart)} | dense, cards


def extract(page: str | None) -> str:
    """The main text of a page: blocks in page order, one to a line; empty if there is none."""
    root = parse(page or "")
    order, path = settle(root)
    if not root.chars:
        return ""
    threshold = min(n.density for n in _to_body(path))
    chosen, passed = _selection(order, path, threshold)
    blocks: list[str] = []
    piece: list[str] = []

    def flush() -> None:
        line = " ".join("".join(piece).split())
        if line:
            blocks.append(line)
        piece.clear()

    todo: list = [(root, id(root) in chosen)]
    while todo:
        x, inside = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            if inside:
                piece.append(entities.unescape(x) if "&" in x else x)
        elif not x.out:
            inside = (inside or id(x) in chosen) and id(x) not in passed
            if x.tag == "br":
                piece.append(" ")
            if x.tag in BLOCK:
                flush()
                todo.append((None, False))
            todo.extend((y, inside) for y in reversed(x.children))
    flush()
    return "\n".join(blocks)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the article; empty for a null page or one without) and ``n_chars``, its code points.

    Each row is judged by its own page alone, so repeated rows come out alike; very long pages are read
    whole, an empty table gives an empty one. Columns of these names are replaced, others stay.
    """
    base = without(pages, "text", "n_chars")
    names = [*base.columns, "text", "n_chars"]
    at = names.index(html)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, at):
            texts = [extract(x.as_py()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)
        trim()

    return base.mapInArrow(step, base.withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    return extracted(read(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
