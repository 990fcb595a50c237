"""Operator 10, HTML extraction: tree scoring.

A page becomes a tree (unclosed and misnested tags are repaired the way browsers mostly do).
Elements that are never article text are set aside: navigation, page headers and footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments, by element, role,
or a class or id that as a whole names such furniture (``ad-slot``, ``related-posts``).  A class
or id with only a word of it (``legal-status``, made from a heading) is a doubt: headings and
inline elements stay, paragraphs, list items and cells go if most of their text is links, and
other elements also if they have little text and no heading or paragraph.  A class that is just
the name of a subject (``legal``, ``map``) is a doubt too: the element stays if it has a heading
of its own or reads like a longer piece of prose, and is not mostly links.  Formulas (``math``, without their
annotations) and ``xmp`` are text.  Every paragraph then passes points to its ancestors, for
its length and its commas, the full sum to the parent, half to the grandparent and less
further up; a container's points are discounted by its link density.  The container with
most points is kept, widened to the article element or the heading that it belongs to,
together with those siblings that have a fair share of its points or read like a paragraph.

Text is the kept elements' blocks in page order: character references decoded, white space
inside a block turned into one space, trimmed, blocks joined by one space.

Defined results: null and empty pages, and pages without article text, give an empty text;
null ids and urls keep their row; repeated rows give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.llm.common import byte_slices, prepare

# Kinds of elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg canvas object annotation annotation-xml xmp noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
MATH = set("math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
INLINE |= MATH
ASIDE = set("nav aside footer form button select option optgroup fieldset input dialog menu menuitem datalist output progress meter head audio video map".split())
ASIDE_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar tablist status".split())
ASIDE_WORDS = set("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion nav navbar navigation menu breadcrumb breadcrumbs "
                  "sidebar aside footer masthead cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login "
                  "comment comments disqus respond replies reply share sharing social related recommended recommendations widget pagination pager toolbar skip search banner "
                  "toc copyright legal disclaimer paywall outbrain taboola".split())
#: Of these, those that articles are about as well: an id of no others is a doubt.
SUBJECTS = set("alert banner consent copyright disclaimer legal login map menu navigation notice notification promotion recommendations recommended related reply search sharing signup social status subscribe subscription widget".split())
#: Of those, the ones that name no kind of furniture: a class of no others is a doubt.
TOPICS = set("legal map search social status".split())
#: Those that no article is about: a class with one of them names furniture, whatever else it says.
ADVERTS = set("ad ads adv advert adverts advertisement advertising adsense sponsored promo nav navbar breadcrumb breadcrumbs sidebar masthead cookie cookies gdpr newsletter disqus pagination pager toolbar popup modal paywall outbrain taboola".split())
#: Words that go with furniture: a name of these and ASIDE_WORDS alone names it as a whole.
FITTINGS = set("area article articles bar block bottom box btn button buttons center column container content count div entry facebook field fixed form global google gpt group header hero holder icon icons inner input item items "
               "left link links list main meta mobile page pages panel post posts primary right row secondary section site slot stories story sub tags text this title top topbar twitter unit wrap wrapper".split())
HEADER_WORDS = {"header", "topbar", "hero"}
ARTICLE_WORDS = set("article content main body entry post story text".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"},
        "option": {"select"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}}
SIBLINGS = {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tfoot"}, "thead": {"tbody", "thead", "tfoot"}, "tfoot": {"tbody", "thead", "tfoot"}}
PARAGRAPHS = {"p", "pre", "td", "blockquote"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold text themselves, however little.
TEXTUAL = PARAGRAPHS | HEADINGS | {"li", "dt", "dd", "th", "caption", "figcaption", "summary"}
#: An element in doubt goes if more of its text is links, or if it has less text (and no textual element).
DOUBT_LINKED, DOUBT_LENGTH = 0.5, 25
#: The same for a doubt by class (and no heading).
TOPIC_LENGTH = 200
#: Degrees of doubt: by a name with a word of furniture, and by a class that is a subject's name.
BY_NAME, BY_TOPIC = 1, 2

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+>|[^>]*>)""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.IGNORECASE)
_NAME_WORDS = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")
_COMMAS = re.compile("[,،、，]")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>?", re.IGNORECASE) for tag in RAW}


class Node:
    __slots__ = ("tag", "parent", "kids", "aside", "article", "points", "length", "linked", "commas", "blocks", "doubt")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.kids = tag, parent, []
        self.aside = self.article = False
        self.points = 0.0
        self.doubt = self.length = self.linked = self.commas = self.blocks = 0


def _judge(node: Node, attributes: str) -> None:
    """Mark an element that is no article text, or that says it is the article."""
    tag = node.tag
    node.aside = tag in ASIDE
    node.article = tag in ("article", "main")
    if len(attributes) < 4:
        return
    names: list[tuple[str, list[str]]] = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            for part in value.split():
                found = [w.lower() for w in _NAME_WORDS.findall(part)]
                if found and found[0] not in ("has", "with", "no", "is", "without", "js"):
                    names.append((name, found))
        elif name == "role":
            node.aside |= value.strip().lower() in ASIDE_ROLES
            node.article |= value.strip().lower() in ("main", "article")
        elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            node.aside = True
        elif name == "style":
            node.aside |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE) is not None
        elif name == "itemprop":
            node.article |= value.strip().lower() == "articlebody"
    if tag in ("html", "body"):
        return
    headers = HEADER_WORDS if tag in ("div", "section") and not any(ARTICLE_WORDS.intersection(found) for _, found in names) else set()
    for name, found in names:
        words = set(found)
        hit = words & (ASIDE_WORDS if tag not in ("article", "main") else {"comment", "comments", "reply", "ad", "ads", "related", "promo", "sponsored"})
        if not hit and not words & headers:
            continue
        if name == "id" and tag in HEADINGS:           # where a link leads, made from the heading
            continue
        if _furniture(name, words, headers):
            node.aside = True
        else:
            node.doubt = max(node.doubt, BY_TOPIC if name == "class" and words <= TOPICS else BY_NAME)


def _furniture(name: str, words: set[str], headers: set[str]) -> bool:
    """Whether a class or id names furniture as a whole."""
    if name == "class" and words & ADVERTS:
        return True
    words = {w for w in words if not w[0].isdigit()}
    if words - ASIDE_WORDS - FITTINGS:
        return False
    if name == "class":
        return not words <= TOPICS
    return bool(words & (ASIDE_WORDS - SUBJECTS | headers))


def parse(html: str) -> Node:
    """The page as a tree; text is kept as strings among the children."""
    root = Node("html", None)
    here, at, end = root, 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        text = html[at:m.start()] if m else html[at:]
        if text:
            here.kids.append(unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None and tag not in ("html", "body"):
                here = node.parent
            elif node is None and tag == "p":          # an end tag alone breaks the line
                here.kids.append(Node("p", here))
            continue
        if tag in RAW:
            close = _RAW_END[tag].search(html, at)
            if not m[3].rstrip().endswith("/>"):
                if tag == "xmp":               # its text as it stands, tags and all
                    here = _repair(here, "pre")
                    node = Node("pre", here)
                    _judge(node, m[3])
                    node.kids.append(html[at:close.start() if close else end])
                    here.kids.append(node)
                at = close.end() if close else end
            continue
        if tag in ("html", "body", "head") and here.parent is None and tag == "html":
            _judge(root, m[3])
            continue
        here = _repair(here, tag)
        node = Node(tag, here)
        _judge(node, m[3])
        here.kids.append(node)
        if tag not in VOID and not (m[3].endswith("/>") and (tag in MATH or tag not in INLINE | CLOSES_P)):
            here = node
    return root


def _repair(here: Node, tag: str) -> Node:
    """Where a new element goes, once the elements are closed that it ends."""
    if tag == "body":
        while here.parent is not None:
            here = here.parent
        return here
    if tag in CLOSES_P:
        node = here
        while node is not None and node.tag in INLINE:
            node = node.parent
        if node is not None and node.tag == "p":
            here = node.parent
        if tag in HEADINGS and here.tag in HEADINGS:
            here = here.parent
    if tag in SAME:
        node, ends = here, SIBLINGS.get(tag, {tag})
        while node is not None and node.tag not in SAME[tag]:
            if node.tag in ends:
                return node.parent
            node = node.parent
    if tag != "head" and here.tag == "head" and tag not in ("meta", "link", "base", "title"):
        here = here.parent
    return here


def _ordered(root: Node) -> list[Node]:
    """Elements that are not set aside, parents first."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [k for k in reversed(node.kids) if isinstance(k, Node) and not k.aside]
    return out


def _settle(nodes: list[Node]) -> None:
    """Set aside the elements in doubt that do not read like article text, inner ones first."""
    textual: dict[Node, bool] = {}
    headed: dict[Node, bool] = {}
    for node in reversed(nodes):
        length = linked = 0
        holds = heading = False
        for kid in node.kids:
            if isinstance(kid, str):
                length += len(kid.strip())
            elif not kid.aside:
                length += kid.length
                linked += kid.length if kid.tag == "a" else kid.linked
                holds |= textual[kid]
                heading |= headed[kid]
        node.length, node.linked = length, linked
        textual[node] = holds or (node.tag in TEXTUAL and length > 0)
        headed[node] = heading or (node.tag in HEADINGS and length > 0)
        if node.doubt and node.tag not in INLINE and node.tag not in HEADINGS:
            short = length < TOPIC_LENGTH and not headed[node] if node.doubt == BY_TOPIC else length < DOUBT_LENGTH and not textual[node]
            node.aside |= short or _density(node) > DOUBT_LINKED
    for node in nodes:
        node.length = node.linked = 0


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        for kid in node.kids:
            if isinstance(kid, str):
                size = len(kid.strip())
                node.length += size
                if size:
                    node.commas += len(_COMMAS.findall(kid))
            elif not kid.aside:
                node.length += kid.length
                node.linked += kid.length if kid.tag == "a" else kid.linked
                node.commas += kid.commas
                node.blocks += kid.blocks + (kid.tag not in INLINE)


def _density(node: Node) -> float:
    return node.linked / node.length if node.length else 0.0


def _score(nodes: list[Node]) -> Node | None:
    """Let paragraphs pass their points up; the best container."""
    for node in nodes:
        if node.tag in PARAGRAPHS or (node.tag in ("div", "section", "article", "main", "center", "dd") and not node.blocks):
            if node.length < 20 or _density(node) > 0.5:
                continue
            points = 1 + node.commas + min(node.length / 100, 3.0) + node.length / 1000
            above, level = (node.parent, 0) if node.tag in PARAGRAPHS else (node, 0)
            while above is not None:
                above.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                above, level = above.parent, level + 1
    best = None
    for node in nodes:
        if node.tag in INLINE or not node.length:
            continue
        value = (node.points + (25 if node.article else 0)) * (1 - _density(node))
        node.points = value
        if value > 0 and (best is None or value > best.points):
            best = node
    return best


def _widened(best: Node) -> Node:
    """The article element around the best container, or its parent while that adds a heading."""
    node = best
    while node is not None:
        if node.article:
            return node
        node = node.parent
    while best.parent is not None and best.parent.tag not in ("html", "body"):
        headed = any(isinstance(k, Node) and k is not best and not k.aside and (k.tag in HEADINGS or k.tag in ("header", "hgroup")) for k in best.parent.kids)
        if not headed or _density(best.parent) > 0.25:
            break
        best = best.parent
    return best


def _kept(best: Node) -> list[Node]:
    """The best container with the siblings that belong to it, in page order."""
    if best.parent is None or best.tag in ("html", "body"):
        return [best]
    out = []
    for kid in best.parent.kids:
        if kid is best:
            out.append(kid)
        elif isinstance(kid, Node) and not kid.aside and kid.tag not in ("header", *INLINE):
            fair = kid.points >= max(10.0, 0.2 * best.points) and kid.tag not in ("ul", "ol", "dl")
            prose = kid.tag == "p" and kid.length >= 80 and _density(kid) < 0.25
            title = kid.tag in HEADINGS and not best.article
            if fair or prose or title:
                out.append(kid)
    return out


def _texts(tops: list[Node]) -> list[str]:
    """Blocks of the kept elements, white space folded."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            blocks.append(text)

    for top in tops:
        todo: list = [top]
        while todo:
            item = todo.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                run.append(item)
            elif item.aside:
                if item.tag not in INLINE:
                    flush()
            elif item.tag == "br":
                run.append(" ")
            else:
                block = item.tag not in INLINE
                kids = item.kids
                if item.tag == "header":           # of a header only the heading is article text
                    kids = [n for n in _ordered(item) if n.tag in HEADINGS]
                if block:
                    flush()
                    todo.append(None)
                todo += reversed(kids)
    flush()
    return blocks


def main_text(html: str | None) -> str:
    """The article text of one page."""
    if not html:
        return ""
    nodes = _ordered(parse(html))
    if any(node.doubt for node in nodes):
        _settle(nodes)
        nodes = _ordered(nodes[0])
    _measure(nodes)
    best = _score(nodes)
    if best is None:                 # no paragraph to go by: all that is not set aside, unless it is links
        return " ".join(_texts(nodes[:1])) if _density(nodes[0]) < 0.5 else ""
    return " ".join(_texts(_kept(_widened(best))))


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(batch.column("html")):
                part = batch.slice(lo, hi - lo)
                texts = [main_text(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return given.mapInArrow(run, "page_id long, url string, text string, n_chars long")
