"""Main text of HTML pages by composite text density over the whole DOM."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of a page's prose.
NOISE = frozenset("script style noscript template nav header footer aside form button select option textarea dialog iframe object svg canvas math menu head title".split())
#: Elements whose content is plain characters up to their end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements that are prose whatever their length, unless they are mostly links.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
#: An open element that the start of these ends (where the markup leaves end tags out).
ENDED_BY = {
    "p": BLOCK - {"body", "html"}, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot", "thead"}), "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}), "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "thead": frozenset({"tbody", "tfoot"}), "tbody": frozenset({"tbody", "tfoot"}), "option": frozenset({"option", "optgroup"}),
    "head": frozenset({"body"}),
}
_ENDERS = frozenset().union(*ENDED_BY.values())
#: What an element may not be ended through.
SCOPE = frozenset("html body table td th caption object template button article section main aside nav header footer div form ul ol dl blockquote".split())
#: Words of class, id and role values that mark menus, adverts, notices and comments. A value counts if a whole token is one
#: of these, or if all parts of a token ("cookie-notice", "siteFooter") are of these or neutral and one is of these.
MARKED = frozenset(
    "ad ads adsbygoogle adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr masthead menu "
    "modal nav navbar navigation newsletter notice notices notification outbrain pagination pager paywall popup promo promoted respond sidebar signup sponsor sponsored subscribe taboola "
    "toolbar widget widgets complementary contentinfo".split()
)
#: Words that may as well stand for prose: an element they mark goes only if it is less dense than the page, too.
DOUBTFUL = frozenset("alert dialog disclaimer discussion header overlay promotion reactions related replies search share sharing social".split())
NEUTRAL = frozenset("area article bar block body bottom box btn button buttons col column container content count entry form global group head icon icons inner item items left link links list main module outer page panel post posts reader readers right row section site slot text thread title top user users visitor wrap wrapper".split())
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(?:(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>|[!?/][^>]*(?:>|\Z))", re.S)
#: A tag with a quote that never ends: up to the next ">".
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*?)(/?)>")
_ATTRIBUTE = re.compile(r"(?:^|\s|/)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)|(?=[\s/>]|$))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")


class Node:
    """An element: its children and texts in order, and the sums over its subtree that densities need."""

    __slots__ = ("tag", "parent", "items", "noise", "marked", "doubtful", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: "Node | None", noise: bool, marked: bool = False, doubtful: bool = False):
        self.tag, self.parent, self.items, self.noise, self.marked, self.doubtful = tag, parent, [], noise, marked, doubtful


def _kind(value: str) -> int:
    """2 for a class, id or role value with a marking token, 1 for a doubtful one, else 0."""
    found = 0
    for token in value.split():
        if token.lower() in MARKED:
            return 2
        parts = [p.lower() for p in _PARTS.findall(token)]
        if parts and all(p in MARKED or p in DOUBTFUL or p in NEUTRAL for p in parts):
            found = max(found, 2 if any(p in MARKED for p in parts) else int(any(p in DOUBTFUL for p in parts)))
    return found


def _marks(attributes: str) -> tuple[bool, int]:
    """(whether an element is hidden, the kind of its class, id and role values)."""
    marked = 0
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False, 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" and value.lower() != "false" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, 0
        if name in ("class", "id", "role"):
            marked = max(marked, _kind(value))
    return False, marked


def parse(page: str) -> Node:
    """The DOM of a page, tolerant of missing and stray end tags; content of noise elements is marked as such."""
    root = Node("#document", None, False)
    node, at, n = root, 0, len(page)
    last = page.rfind(">")
    open_tags: Counter = Counter()

    def next_tag(begin: int) -> tuple[int, re.Match | None]:
        """Where the next tag or comment begins, and its match; a lone "<" is text, and so is all after the last ">"."""
        while (begin := page.find("<", begin)) >= 0:
            match = (_TAG.match(page, begin) or _PLAIN_TAG.match(page, begin)) if begin <= last or page.startswith(("<!", "<?", "</"), begin) else None
            if match is not None:
                return begin, match
            if begin > last and all(page.find(x, begin) < 0 for x in ("<!", "<?", "</")):
                break
            begin += 1
        return n, None

    def close(child: Node) -> None:
        """Ends the open elements down to ``child``."""
        nonlocal node
        while True:
            ended, node = node, node.parent
            open_tags[ended.tag] -= 1
            if ended is child:
                return

    while at < n:
        begin, match = next_tag(at)
        if begin > at:
            node.items.append(page[at:begin])
        if match is None:
            break
        at = match.end()
        closing, tag, attributes, _ = match.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            found = node if open_tags[tag] > 0 else root
            while found is not root and found.tag != tag:
                if found.tag in SCOPE and tag not in SCOPE:
                    found = root
                    break
                found = found.parent
            if found is not root:
                close(found)
            elif tag == "br":
                node.items.append(Node("br", node, False))
            continue
        open_ = node if tag in _ENDERS else root
        while open_ is not root:
            if tag in ENDED_BY.get(open_.tag, ()):
                close(open_)
                open_ = node
                continue
            if open_.tag in SCOPE:
                break
            open_ = open_.parent
        hidden, marked = _marks(attributes)
        if tag in ("html", "body", "article", "main"):
            marked = 0
        child = Node(tag, node, tag in NOISE or hidden, marked == 2, marked == 1)
        node.items.append(child)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            stop = end.start() if end else n
            child.items.append(page[at:stop])
            at = end.end() if end else n
            continue
        node = child
        open_tags[tag] += 1
    _settle(root)
    return root


def _settle(root: Node) -> None:
    """Turns marks into noise and hands noise down to what lies inside.

    A marked element that holds an article, or a heading and most of the page, is a layout ("with-sidebar"), and no noise.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(reversed([x for x in node.items if isinstance(x, Node)]))
    seen: dict[int, tuple[int, bool, bool]] = {}
    for node in reversed(order):
        size, article, heading = 0, node.tag in ("article", "main"), node.tag == "h1"
        for x in node.items:
            if isinstance(x, str):
                size += len(x)
            elif not x.noise:
                inner = seen[id(x)]
                size, article, heading = size + inner[0], article or inner[1], heading or inner[2]
        seen[id(node)] = size, article, heading
    whole = seen[id(root)][0]
    for node in order:
        size, article, heading = seen[id(node)]
        if node.marked and not article and not (heading and 5 * size > 3 * whole):
            node.noise = True
        if node.parent is not None and node.parent.noise:
            node.noise = True


def _measure(root: Node) -> list[Node]:
    """Fills the sums of every node (children before parents) and returns the nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(reversed([x for x in node.items if isinstance(x, Node)]))
    for node in reversed(order):
        chars = tags = link_chars = link_tags = 0
        for x in node.items:
            if isinstance(x, Node):
                if not x.noise:
                    chars += x.chars
                    tags += x.tags + 1
                    link_chars += x.link_chars
                    link_tags += x.link_tags
            elif not node.noise:
                chars += len(x) - x.count(" ") - x.count("\n")
        if node.tag == "a":
            link_chars, link_tags = chars, link_tags + 1
        node.chars, node.tags, node.link_chars, node.link_tags = chars, tags, link_chars, link_tags
    return order


def _densities(order: list[Node], body: Node) -> None:
    """Composite text density of each node and the sum over its children.

    density = chars/tags * log_base(chars/link_chars * tags/link_tags), base = ln(chars/plain * link_chars + share * chars
    + e): characters per tag, less the more of the text and of the tags are links.
    """
    from math import e, log

    share = body.link_chars / max(1, body.chars)
    for node in order:
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, node.link_tags
        if not c or node.noise:
            node.density = 0.0
            continue
        base = log(c / max(1, c - lc) * lc + share * c + e)
        node.density = c / t * log(max(1.0, c / max(1, lc) * t / max(1, lt)) + e - 1) / max(1.0, log(base) + 1)
    for node in reversed(order):
        node.total = sum(x.density for x in node.items if isinstance(x, Node) and not x.noise) + (node.density if any(isinstance(x, str) and x.strip() for x in node.items) else 0.0)


def _drop_doubtful(order: list[Node], body: Node) -> bool:
    """Turns elements with a doubtful mark into noise where they have fewer unlinked characters per tag than the page.

    The composite density is no measure here: it grows with an element's size.
    """
    plain = lambda x: (x.chars - x.link_chars) / max(1, x.tags)
    least, dropped = plain(body), False
    for node in order:
        if node.doubtful and not node.noise and node is not body and plain(node) < least:
            node.noise = dropped = True
        elif node.parent is not None and node.parent.noise and not node.noise:
            node.noise = True
    return dropped


def _blocks(node: Node, wanted=None) -> list[str]:
    """Texts of the blocks below a node in page order, of ``wanted`` elements: white space collapsed, references decoded."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            out.append(text)

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        elif x.noise or wanted is not None and not wanted(x):
            if x.tag in BLOCK:
                flush()
        elif x.tag == "br":
            held.append(" ")
        else:
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(x.items))
    flush()
    return out


def _beside(order: list[Node], path: list[Node], threshold: float):
    """Tells the elements of a text without an article: all of the core, the path, and what beside it is prose.

    Beside the path, from the top down, an element is taken whole if it is at least as dense as the threshold, or a
    paragraph, quotation or heading, and not mostly links; what is not is searched for such elements. Inline elements go
    with the text around them.
    """
    whole, on_path, taken = {id(path[0])}, set(map(id, path)), set(map(id, path))
    for x in order:  # parents before children
        above = id(x.parent) if x.parent is not None else None
        if above in whole:
            whole.add(id(x))
        elif id(x) not in on_path and not x.noise:
            linked = 2 * x.link_chars > x.chars
            inline = x.tag not in BLOCK and above in on_path and (not linked or any(isinstance(y, str) and y.strip() for y in x.parent.items))
            if inline or x.chars and not linked and (x.density >= threshold or x.tag in PROSE):
                whole.add(id(x))
    for x in reversed(order):  # an element that holds a taken one is passed through
        if id(x) in whole or id(x) in taken:
            taken.add(id(x))
            if x.parent is not None:
                taken.add(id(x.parent))
    return lambda x: id(x) in taken


def main_text(page: str | None) -> str:
    """The main text of a whole page, its blocks joined by blank lines; empty if there is none.

    Every DOM node gets its link-adjusted characters per tag. The subtree whose children's densities sum highest is the
    core; the least density on the path from it up to the body is the threshold. An ``article`` (or ``main``) around the
    core, or one that holds at least half of it, is taken whole. Without one the text is that of the core, of everything
    on the path's own level, and of every other subtree below the body that is at least as dense as the threshold, with
    its heading. Noise elements and marked ones (menus, adverts, notices, comments) count nowhere; elements with a
    doubtful mark go where their density is below the page's. Without a body the document stands for it.
    """
    if not page:
        return ""
    root = parse(page)
    order = _measure(root)
    body = next((x for x in order if x.tag == "body"), root)
    if not body.chars:
        body = root
    _densities(order, body)
    if _drop_doubtful(order, body):
        _measure(root)
        _densities(order, body)
    inside, node = set(), None
    stack = [body]
    while stack:
        x = stack.pop()
        inside.add(id(x))
        stack.extend(y for y in x.items if isinstance(y, Node) and not y.noise)
    core = max((x for x in order if id(x) in inside), key=lambda x: x.total, default=None)
    if core is None or not core.chars:
        return ""
    # an inline core stands for its block
    while core is not body and core.tag not in BLOCK:
        core = core.parent
    path = [core]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min((x.density for x in path if x.tag not in ("html", "#document")), default=0.0)
    articles = [x for x in path if x.tag in ("article", "main")]
    if not articles:  # the core spans more than the article that holds most of it
        articles = sorted((x for x in order if x.tag in ("article", "main") and id(x) in inside and 2 * x.chars >= core.chars), key=lambda x: x.chars)[-1:]
    if articles:
        return "\n\n".join(_blocks(next((x for x in reversed(articles) if x.tag == "article"), articles[0])))
    return "\n\n".join(_blocks(body, _beside(order, path, threshold)))


def extract_text(pages: DataFrame, *, html_column: str = "html", text: str = "text") -> DataFrame:
    """Adds ``text`` and ``n_chars`` (code points) to every row; whole pages are read, whatever their length.

    Null and empty pages have an empty text. Rows that repeat are read alike; an empty table gives no rows. Columns of
    these two names are replaced.
    """
    kept = pages.drop(*[c for c in (text, "n_chars") if c != html_column])
    names = kept.columns
    at = names.index(html_column)
    schema = StructType([*kept.schema.fields, StructField(text, StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*names, text, "n_chars"])

    return kept.mapInArrow(run, schema)
