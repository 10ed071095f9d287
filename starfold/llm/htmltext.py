"""Main text of web pages by scoring the page's tree.

A page is read into a tree of its block elements; inline elements only leave their text. Navigation, headers and footers of
the page, asides, controls, scripts and what is hidden are taken out by element and role, with all they hold, and so are lists
that are mostly links. Forms, and elements whose class or id names an advert, a notice, a sidebar, remarks and the like, are
suspect only: they go unless they hold the page's article or most of its text (``judge``). Paragraphs then pass points for their length and commas to five ancestors, all
to the parent, half to the next one up, then a third and so on; every container's points are discounted by the share of its
text that is links. The container with the most points is the article, or the article or main element around it. Its
siblings are kept where they score enough beside it or are plain paragraphs and headings.

Blocks are joined in page order by two line breaks. Null and empty pages, and those without text, give the empty text.
Broken markup is read as browsers do in the common cases: open paragraphs and items end at the next one, unknown end tags
are ignored, and what is never closed ends with the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "search head frameset noframes option optgroup select button textarea".split()
)
VOID_BREAKS = frozenset("br hr wbr img input".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video noembed".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())
# A new one of these ends an open one of those, if no element of the third set lies between.
ENDS_OPEN = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
DROPPED = frozenset("head nav footer aside button select textarea dialog menu search fieldset option frameset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
# Words of class and id that name what is not the article, wherever they stand.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner breadcrumb breadcrumbs "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "login comment comments disqus respond replies reply discussion sidebar sidebars nav navbar navigation menu menus submenu footer "
    "footnav masthead topbar share sharing social related recommended recommendations outbrain taboola widget widgets pagination "
    "pager skip toolbar".split()
)
# Those of them that name what readers wrote.
REMARK_WORDS = frozenset("comment comments disqus respond replies reply".split())
# Beginnings of words that do so too.
DROPPED_STEMS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar", "sponsor", "adsby")
# Inline elements whose class or id can name an advert or a notice.
INLINE = frozenset("span ins a label font small".split())
# Beside one of these words the ones above only describe a layout.
SPARED_WORDS = frozenset("wrap wrapper layout container has with no page without body".split())

LISTINGS = frozenset("ul ol dl div section table".split())

# How many ancestors get a paragraph's points: all of them, half, a third, ...
ANCESTORS = 5
# Siblings are kept from this share of the best container's points on, and below this share of linked text.
SIBLING_SHARE = 0.2
LINKED_SHARE = 0.25
# Suspects that together weigh so many times what is not suspect hold the article between them.
SCATTERED = 4

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


class Node:
    """A block element: its text blocks and child elements in page order."""

    __slots__ = ("tag", "attributes", "parent", "in_article", "parts", "gone", "score", "length", "links", "anchors")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.in_article = parent is not None and (parent.in_article or parent.tag in ("article", "main"))
        self.parts: list[Node | Block] = []
        self.gone = False
        self.score = 0.0
        self.length = self.links = self.anchors = 0

    def density(self) -> float:
        return self.links / self.length if self.length else 0.0

    def worth(self) -> float:
        return self.score * (1 - self.density())


class Block:
    """A run of text without block boundaries; ``links`` counts its characters within links."""

    __slots__ = ("text", "links", "anchors")

    def __init__(self, text: str, links: int, anchors: int):
        self.text, self.links, self.anchors = text, links, anchors


def parse(page: str) -> list[Node]:
    """The elements of a page's tree, in page order; the first holds all."""
    root = Node("#page", "", None)
    found, here = [root], root
    pieces: list[tuple[str, bool]] = []
    in_link = False
    anchors = 0
    # The inline element being left out, and how deep in elements of its name.
    hushed, depth = "", 0

    def flush() -> None:
        nonlocal anchors
        if any(piece for piece, _ in pieces):
            text = " ".join(html.unescape("".join(piece for piece, _ in pieces)).split())
            if text:
                linked = sum(len(" ".join(piece.split())) for piece, link in pieces if link)
                here.parts.append(Block(text, min(linked, len(text)), anchors))
        pieces.clear()
        anchors = 0

    def end(tags: set[str], within: set[str] | frozenset[str]) -> None:
        nonlocal here
        at = here
        while at.parent is not None and at.tag not in within:
            if at.tag in tags:
                here = at.parent
                return
            at = at.parent

    position = 0
    while True:
        tag_match = _TAG.search(page, position)
        if not hushed:
            pieces.append((page[position : tag_match.start() if tag_match else len(page)], in_link))
        if tag_match is None:
            break
        position = tag_match.end()
        tag = tag_match[2] or tag_match[5]
        if tag is None:
            if tag_match[0].startswith("<![CDATA["):
                pieces.append((html.escape(tag_match[0][9:-3]), in_link))
            continue
        tag = tag.lower()
        closing = bool(tag_match[1] or tag_match[4])
        attributes = tag_match[3] or tag_match[6] or ""
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                ending = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, position)
                position = ending.end() if ending else len(page)
        elif hushed and tag not in BLOCKS:
            depth += (tag == hushed) * (-1 if closing else 1)
            hushed = hushed if depth else ""
        elif tag in INLINE and attributes and unwanted_inline(attributes):
            hushed, depth = tag, 1
        elif tag == "a":
            in_link = not closing
            anchors += in_link
        elif tag in VOID_BREAKS:
            pieces.append((" ", in_link))
            if tag == "hr":
                flush()
        elif tag in BLOCKS:
            flush()
            hushed, depth = "", 0
            if closing:
                at = here
                while at is not root and at.tag != tag:
                    at = at.parent
                if at is not root:
                    here = at.parent
            else:
                if here.tag == "p" or tag in HEADINGS and here.tag in HEADINGS:
                    here = here.parent
                if tag in ENDS_OPEN:
                    end(*ENDS_OPEN[tag])
                elif tag == "body":
                    end({"head"}, frozenset())
                here = Node(tag, attributes, here)
                here.parent.parts.append(here)
                found.append(here)
                in_link = False
                if attributes.endswith("/") and tag not in ("p", "div"):
                    here = here.parent
    flush()
    return found


WANTED, GONE, SUSPECT, REMARKS = range(4)


def verdict(node: Node) -> int:
    """What an element's name, role, class and id say of it: no part of any article, suspect, or perhaps readers' remarks."""
    if node.tag in DROPPED or node.tag == "header" and not node.in_article:
        return GONE
    spared = node.tag in ("html", "body", "article", "main")
    words: set[str] = set()
    for name, value in _ATTRIBUTE.findall(node.attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name in ("class", "id"):
            words.update(word.lower() for word in _WORDS.findall(value))
        elif name == "role" and value.strip().lower() in DROPPED_ROLES and not spared:
            return GONE
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
            return GONE
    if node.tag == "article":
        return REMARKS if words & {"comment", "comments", "reply"} else WANTED
    if spared or words & SPARED_WORDS:
        return SUSPECT if node.tag == "form" else WANTED
    if words & REMARK_WORDS or any(word.startswith("comment") and word != "commentary" for word in words):
        return REMARKS
    if node.tag == "form" or dropping(words) or "header" in words and node.tag == "div" and not node.in_article:
        return SUSPECT
    return WANTED


def dropping(words: set[str]) -> bool:
    return bool(words & DROPPED_WORDS) or any(word.startswith(DROPPED_STEMS) and word != "commentary" for word in words)


def unwanted_inline(attributes: str) -> bool:
    """Whether an inline element is an advert, a notice or the like, by the words of its class and id."""
    values = [value for name, value in _ATTRIBUTE.findall(attributes) if name.lower() in ("class", "id")]
    return dropping({word.lower() for value in values for word in _WORDS.findall(html.unescape(value))})


def judge(found: list[Node]) -> None:
    """Mark what is unwanted.

    Names and words alone only make an element suspect. A suspect goes, but not if it holds the page's weightiest article (or
    main) element. Where no such element has text of its own outside suspects, half of that weight is enough, and a suspect
    stays if it weighs more than all that is not suspect and than the other suspects, or, if suspects together weigh far more than the rest, if it shares
    a listed word with the heaviest and is hardly linked. Weight is paragraph points. What is within a kept suspect is judged
    again beside it.
    """
    says = {id(node): verdict(node) for node in found}
    for node in found[1:]:
        node.gone = node.parent.gone or says[id(node)] == GONE
        # An article with a remark's class is one only among remarks or within another article.
        if node.tag == "article" and says[id(node)] == REMARKS:
            at = node.parent
            while at is not None and not (at.tag == "article" or says[id(at)] == REMARKS):
                at = at.parent
            if at is None:
                says[id(node)] = WANTED
    weight, held, linked, length = {}, {}, {}, {}
    for node in reversed(found):
        own = 0 if node.gone or node.tag in HEADINGS else sum(
            points(part.text) * (1 - part.links / len(part.text)) for part in node.parts if isinstance(part, Block)
        )
        kids = [part for part in node.parts if isinstance(part, Node) and not part.gone]
        at = id(node)
        weight[at] = own + sum(weight[id(kid)] for kid in kids)
        mine = [part for part in node.parts if isinstance(part, Block)]
        length[at] = sum(len(part.text) for part in mine) + sum(length[id(kid)] for kid in kids)
        linked[at] = sum(part.links for part in mine) + sum(linked[id(kid)] for kid in kids)
        real = node.tag in ("article", "main") and says[at] == WANTED
        held[at] = max([weight[at] if real else 0, *(held[id(kid)] for kid in kids)])

    def clean(top: Node) -> float:
        """Weight below a node outside suspects."""
        total, waiting = weight[id(top)], [part for part in top.parts if isinstance(part, Node)]
        while waiting:
            node = waiting.pop()
            if node.gone:
                continue
            if says[id(node)] != WANTED:
                total -= weight[id(node)]
            else:
                waiting.extend(part for part in node.parts if isinstance(part, Node))
        return total

    root, waiting = found[0], [found[0]]
    outside = clean(root)
    told = any(
        not node.gone and says[id(node)] == WANTED and (node.tag == "article" and clean(node) >= 1 or node.tag == "main" and clean(node) >= weight[id(root)] / 4)
        for node in outermost(found, says)
    )
    while waiting:
        suspects, layer = [], waiting
        waiting = []
        while layer:
            node = layer.pop()
            for part in node.parts:
                if isinstance(part, Node) and not part.gone:
                    (layer if says[id(part)] == WANTED else suspects).append(part)
        plain = [node for node in suspects if says[id(node)] == SUSPECT]
        heaviest = max(plain, key=lambda node: weight[id(node)], default=None)
        suspected = sum(weight[id(node)] for node in plain)
        scattered = SCATTERED * outside < suspected
        for node in suspects:
            at = id(node)
            keep = held[at] > 0 and (1 if told else 2) * held[at] >= held[id(root)]
            if says[at] == SUSPECT and not told and weight[at]:
                alike = linked[at] < LINKED_SHARE * length[at] and listed(node) & listed(heaviest)
                keep = keep or weight[at] > max(outside, suspected / 2) or scattered and bool(alike)
            if keep:
                waiting.append(node)
            else:
                hide(node)
        outside += sum(clean(node) for node in waiting)


def listed(node: Node) -> set[str]:
    """The words of class and id that make an element suspect."""
    values = [value for name, value in _ATTRIBUTE.findall(node.attributes) if name.lower() in ("class", "id")]
    return {word for value in values for word in map(str.lower, _WORDS.findall(html.unescape(value))) if dropping({word})}


def outermost(found: list[Node], says: dict[int, int]) -> Iterator[Node]:
    """Article and main elements that no suspect element is around; of nested ones all."""
    waiting = [found[0]]
    while waiting:
        node = waiting.pop()
        if node.gone or says[id(node)] != WANTED:
            continue
        if node.tag in ("article", "main"):
            yield node
        waiting.extend(part for part in node.parts if isinstance(part, Node))


def hide(top: Node) -> None:
    waiting = [top]
    while waiting:
        node = waiting.pop()
        node.gone = True
        waiting.extend(part for part in node.parts if isinstance(part, Node))


def prune(found: list[Node]) -> None:
    """Mark what is unwanted, and count text and link characters of what is left."""
    judge(found)
    for node in reversed(found):
        for part in node.parts:
            if isinstance(part, Block):
                node.length, node.links, node.anchors = node.length + len(part.text), node.links + part.links, node.anchors + part.anchors
        menu = node.tag in LISTINGS and node.anchors > 2 and node.density() > 0.6
        node.gone = node.gone or not node.length or menu
        if node.parent is not None and not node.gone:
            above = node.parent
            above.length, above.links, above.anchors = above.length + node.length, above.links + node.links, above.anchors + node.anchors


def points(text: str) -> float:
    return 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)


def score(found: list[Node]) -> None:
    """Points of all paragraphs to their ancestors."""
    for node in found:
        own = [part for part in node.parts if isinstance(part, Block)]
        if not own or node.gone or node.tag in HEADINGS:
            continue
        given = sum(points(part.text) * (1 - part.links / len(part.text)) for part in own)
        # A paragraph's points go to what holds it; loose text counts for the element it stands in.
        at = node.parent if node.tag in PARAGRAPHS and node.parent is not None else node
        for share in range(1, ANCESTORS + 1):
            if at is None:
                break
            at.score += given / share
            at = at.parent


def blocks(part: Node | Block) -> Iterator[str]:
    """The texts below ``part`` that are not gone, in page order."""
    waiting = [part]
    while waiting:
        part = waiting.pop()
        if isinstance(part, Block):
            yield part.text
        elif not part.gone:
            waiting.extend(reversed(part.parts))


def kept_parts(best: Node) -> list[Node | Block]:
    """The best container and those of its siblings that belong to it, in page order."""
    if best.parent is None:
        return [best]
    least = SIBLING_SHARE * best.worth()
    kept: list[Node | Block] = []
    for part in best.parent.parts:
        if isinstance(part, Block):
            belongs = part.links < LINKED_SHARE * len(part.text)
        else:
            plain = part.tag in HEADINGS or part.tag in PARAGRAPHS or part.tag in ("figure", "table", "ul", "ol", "dl")
            belongs = part is best or part.density() < LINKED_SHARE and (plain or part.worth() >= least)
        if belongs:
            kept.append(part)
    return kept


def main_text(page: str | None) -> str:
    """The article of a page."""
    found = parse(page or "")
    prune(found)
    score(found)
    best = max(found, key=lambda node: 0.0 if node.gone else node.worth())
    around = at = best
    while at is not None and around.tag != "article":
        if at.tag in ("article", "main"):
            around = at
        at = at.parent
    if around.score == 0 or around.tag in ("body", "html"):
        around = found[0]
    return "\n\n".join(text for part in kept_parts(around) for text in blocks(part))


def extract(pages: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text in ``out`` (replaced if there) in place of the markup."""
    kept = [name for name in pages.columns if name not in (html_column, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*kept, out])

    seen = pages.select(*(f"`{name}`" for name in kept), html_column)
    return seen.mapInArrow(run, seen.drop(html_column).schema.add(out, "string"))
