"""Main-text extraction from HTML by tree scoring (operator 1).

A tolerant parse, one forward scan, builds the element tree and, in page order,
its text blocks.  A tag, comment or script that the page's end cuts off is
dropped, as in browsers.  Boilerplate subtrees (menus, page headers, footers, sidebars, notices,
adverts, forms, scripts, styles, reader comments) are cut while parsing.
Every paragraph-like block then passes points for its length and its commas
to its ancestors, less with distance; an element's points are discounted by
its link density.  The best container is kept; a best article or main with other
ones beside it, any other container with all that stands beside it or its
ancestors and isn't mostly links.  Lists of links go where they stand outside
the prose.

Null or empty html gives an empty text; a page in which nothing scores keeps
all its remaining blocks; of containers with equal scores the innermost counts.
Very long pages are parsed whole, in time that follows their length.  Pages
are independent rows, so repeated rows and null ids pass through, an empty
table gives no rows, and the work needs no shuffle.  Only id, url and html are
read, so other columns can have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame

from .common import pick

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var".split())
#: Elements whose own text is a paragraph: its points go to the parent.
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt td th pre blockquote figcaption caption address summary".split())
SEMANTIC = frozenset(("article", "main"))
CUT_TAGS = frozenset("head script style noscript template nav footer aside form button select option textarea "
                     "iframe svg canvas object audio video map dialog menu".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                      "form".split())
#: Words of class and id that mark boilerplate, compared with whole words.
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription share sharing social "
    "sidebar widget widgets related recommended recommendations breadcrumb breadcrumbs menu nav navbar navigation "
    "footer comment comments commentlist disqus respond reply replies pagination pager login signup skip "
    "masthead toolbar".split())
#: Those of them whose elements hold articles of their own: comments, teasers, adverts.
LIST_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion popup modal overlay newsletter "
    "widget widgets related recommended recommendations sidebar comment comments commentlist disqus respond reply "
    "replies".split())
#: Names an article has for its kind or state, not for what it is.
ARTICLE_KIND = re.compile(r"(?i)^(category|tag|type|format|status|post|has|with|no)[-_]|[-_](open|closed|enabled|disabled)$")
#: Words that only say which part of a page's furniture an element is: "share-buttons", but not "share-prices".
FURNITURE_WORDS = frozenset(
    "area aside bar block body bottom box button buttons card cards center close col column container content count "
    "counter desktop element feed form group head heading holder icon icons inline inner item items label large left "
    "link links list main medium mobile module off on outer page pane panel popular post posts primary right row "
    "secondary section slot small story stories tab tabs text thread title toggle top unit wrap wrapper".split())
#: Elements that are prose whatever their id: headings get ids made from their words.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6".split())
OPTIONAL_END = frozenset("li p dt dd tr td th option".split())
RAW = frozenset(("script", "style"))
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: A start tag ends an open element of these kinds, up to the boundary tags.
IMPLIED_END = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
               "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
               "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
LEVELS = 4          # ancestors that get discounted points
LINKS = 0.5         # share of link text from which what stands beside the best container is no prose


class Element:
    __slots__ = ("tag", "parent", "children", "cut", "why", "first", "last", "score", "chars", "link_chars", "links",
                 "semantic")

    def __init__(self, tag: str, parent: "Element | None", why: str, first: int):
        #: why: what cuts the element itself (tag, list, name, or empty); cut: it or an ancestor is cut.
        self.tag, self.parent, self.why, self.first = tag, parent, why, first
        self.cut = bool(why) or parent is not None and parent.cut
        self.children: list[Element] = []
        #: The nearest article or main from here upwards, itself included.
        self.semantic = self if tag in SEMANTIC else parent.semantic if parent else None
        self.last, self.score, self.chars, self.link_chars, self.links = first, 0.0, 0, 0, 0


class Block:
    __slots__ = ("text", "owner", "link_chars")

    def __init__(self, text: str, owner: Element, link_chars: int):
        self.text, self.owner, self.link_chars = text, owner, link_chars


NEXT = re.compile(r"<(?:(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*+)|(?P<comment>!--)|(?P<other>[!?/]))")
ATTRIBUTE = re.compile(r"""[\s/]*+(?:(?P<name>[^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"(?P<d>[^"]*+)(?P<de>")?|'(?P<s>[^']*+)(?P<se>')?|(?P<u>[^\s>]*+)))?+)?+""")
COMMENT_END = re.compile("--!?>")

Token = tuple[str, str, dict]  # kind ("text", "start" or "end"), text or tag, attributes


def _attributes(html: str, at: int) -> tuple[dict, int]:
    """The attributes from ``at`` on, and the place after the tag; -1 if the page ends within it."""
    attrs: dict[str, str] = {}
    while True:
        m = ATTRIBUTE.match(html, at)
        at = m.end()
        if m["name"] is None:
            return attrs, at + 1 if at < len(html) else -1
        value = next((v for v in (m["d"], m["s"], m["u"]) if v is not None), "")
        if m["d"] is not None and m["de"] is None or m["s"] is not None and m["se"] is None:
            return attrs, -1
        attrs.setdefault(m["name"].lower(), unescape(value) if "&" in value else value)


def tokens(html: str) -> Iterator[Token]:
    """Texts, start tags and end tags of a page in one forward scan.

    What scripts and styles hold and what the page's end cuts off are left out.
    """
    at, size = 0, len(html)
    while at < size:
        m = NEXT.search(html, at)
        if m is None:
            yield "text", unescape(html[at:]), {}
            return
        if m.start() > at:
            yield "text", unescape(html[at:m.start()]), {}
        if m["tag"] is None:
            if m["comment"]:
                end = COMMENT_END.search(html, m.end() - 2 if html.startswith(">", m.end()) else m.end())
                at = end.end() if end else -1
            else:
                at = html.find(">", m.end()) + 1 or -1
        else:
            tag = m["tag"].lower()
            attrs, at = _attributes(html, m.end())
            if at >= 0:
                yield "end" if m["end"] else "start", tag, attrs
                if tag in RAW and not m["end"]:  # no markup up to its end tag
                    end = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                    at = end.start() if end else -1
        if at < 0:
            return


class TreeBuilder:
    """Elements and text blocks of a page, in page order; tolerant of unclosed and stray tags."""

    def __init__(self, page: str, cut_forms: bool = True):
        self.cut_forms = cut_forms
        self.blocks: list[Block] = []
        self.root = Element("#root", None, "", 0)
        self.stack = [self.root]
        self.open: dict[str, int] = {}
        self.parts: list[str] = []
        self.in_link = self.link_chars = 0
        #: Start less end tags, of those seen and of the whole page.
        self.seen: dict[str, int] = {}
        self.whole: dict[str, int] | None = None
        self.page = page

    def build(self) -> "TreeBuilder":
        handle = {"text": lambda data, _: self.handle_data(data), "start": self.handle_starttag,
                  "end": lambda tag, _: self.handle_endtag(tag)}
        for kind, what, attrs in tokens(self.page):
            handle[kind](what, attrs)
        self.close()
        return self

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                owner = next(e for e in reversed(self.stack) if e.tag not in INLINE)
                self.blocks.append(Block(text, owner, min(self.link_chars, len(text))))
            self.parts.clear()
        self.link_chars = 0

    def pop(self) -> None:
        e = self.stack.pop()
        self.open[e.tag] -= 1
        if e.tag not in INLINE:
            self.flush_inside(e)
        if e.tag == "a":
            self.in_link -= 1
        e.last = len(self.blocks)

    def flush_inside(self, e: Element) -> None:
        self.stack.append(e)
        self.flush()
        self.stack.pop()

    def close(self) -> None:
        while len(self.stack) > 1:
            self.pop()
        self.flush()
        self.root.last = len(self.blocks)

    def close_to(self, tags, boundary) -> None:
        """Ends the nearest open element of ``tags`` unless a boundary stands before it."""
        if not any(self.open.get(t) for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                while len(self.stack) > i:
                    self.pop()
                return
            if tag in boundary:
                return

    def boilerplate(self, tag: str, attrs: dict) -> str:
        """What cuts an element: "tag" (or its role or style), "list" or "name" (words of class and id), or ""."""
        if tag in CUT_TAGS and (tag != "form" or self.cut_forms):
            return "tag"
        if tag == "header" and not any(self.open.get(t) for t in SEMANTIC):
            return "tag"
        if "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return "tag"
        if (attrs.get("role") or "").lower() in CUT_ROLES:
            return "tag"
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or ""):
            return "tag"
        if tag in ("html", "body", "main"):
            return ""
        inside = any(self.open.get(t) for t in SEMANTIC)
        classes, slug = (attrs.get("class") or "").split(), (attrs.get("id") or "").split()
        if tag == "article":
            classes, slug = ([x for x in names if not ARTICLE_KIND.search(x)] for names in (classes, slug))
        # In an article, and in ids anywhere, a word cuts only a name that says nothing else.
        names = [(x, inside or tag in PROSE) for x in classes] + [(x, True) for x in slug if tag not in PROSE]
        words = set()
        for name, strict in names:
            found = {w.lower() for w in NAME_WORDS.findall(name)}
            if not strict or all(w in CUT_WORDS or w in FURNITURE_WORDS or w == "header" or w.isdigit() for w in found):
                words |= found
        if words & LIST_WORDS:
            return "list"
        if words & CUT_WORDS or "header" in words and not inside:
            return "name"
        return ""

    def ends_later(self, tag: str) -> int:
        """End tags of ``tag`` still to come, less those of elements that start later."""
        if self.whole is None:
            self.whole = {}
            for kind, what, _ in tokens(self.page):
                if kind != "text":
                    self.whole[what] = self.whole.get(what, 0) + (1 if kind == "start" else -1)
        return self.seen.get(tag, 0) - self.whole.get(tag, 0)

    def leave_unclosed(self, tag: str) -> None:
        """Ends cut elements that an article or main can't stand in: they were left open, or hold the whole page.

        Lists of comments, teasers and adverts, and menus, asides and the like
        that have an end tag, hold articles of their own.
        """
        last, inner = len(self.stack), {}
        for i in range(len(self.stack) - 1, 0, -1):
            e = self.stack[i]
            if not e.cut or e.tag in ("template", "noscript"):
                break
            inner[e.tag] = inner.get(e.tag, 0) + 1
            if e.why in ("tag", "list") and tag == "article" and (
                    e.tag in OPTIONAL_END or inner[e.tag] <= self.ends_later(e.tag)):
                break
            if e.why:
                last = i
        while len(self.stack) > last:
            self.pop()

    def handle_starttag(self, tag: str, attrs: dict) -> None:
        if tag in VOID:
            if tag in ("br", "img", "wbr") or self.stack[-1].cut:
                if tag == "br":
                    self.parts.append(" ")
            else:
                if tag == "hr":
                    self.close_to(("p",), ())
                self.flush()
            return
        if tag in SEMANTIC and self.stack[-1].cut:
            self.leave_unclosed(tag)
        self.seen[tag] = self.seen.get(tag, 0) + 1
        if tag == "body":
            self.close_to(("head",), ())
        if tag in CLOSES_P:
            self.close_to(("p",), ("td", "th", "button", "object", "table"))
        if tag in IMPLIED_END:
            self.close_to(*IMPLIED_END[tag])
        if tag not in INLINE:
            self.flush()
        parent = self.stack[-1]
        e = Element(tag, parent, self.boilerplate(tag, attrs), len(self.blocks))
        parent.children.append(e)
        self.stack.append(e)
        self.open[tag] = self.open.get(tag, 0) + 1
        if tag == "a":
            self.in_link += 1

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        self.seen[tag] = self.seen.get(tag, 0) - 1
        if not self.open.get(tag):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            at = self.stack[i].tag
            if at == tag:
                while len(self.stack) > i:
                    self.pop()
                return
            if tag in INLINE and at not in INLINE or tag == "p" and at in ("div", "article", "section", "td", "th"):
                return

    def handle_data(self, data: str) -> None:
        e = self.stack[-1]
        if e.cut:
            return
        self.parts.append(data)
        if self.in_link:
            self.link_chars += len(data)


def _score(root: Element, blocks: list[Block]) -> None:
    """Points of every block to the ancestors of its text, and link totals upwards."""
    for b in blocks:
        points = 1.0 + b.text.count(",") + min(len(b.text) / 100.0, 3.0)
        e = b.owner.parent if b.owner.tag in PARAGRAPH and b.owner.parent else b.owner
        distance = 1
        while e is not None and distance <= LEVELS:
            if e.tag not in SEMANTIC:
                e.score += points / distance
            e, distance = e.parent, distance + 1
    order, at = [root], 0
    while at < len(order):
        order.extend(order[at].children)
        at += 1
    for b in blocks:
        b.owner.chars += len(b.text)
        b.owner.link_chars += b.link_chars
        b.owner.links += b.link_chars > 0
    for b in blocks:  # articles get the points of all their blocks, without discount
        points = 1.0 + b.text.count(",") + min(len(b.text) / 100.0, 3.0)
        e = b.owner.semantic
        while e is not None:
            e.score += points
            e = e.parent.semantic
    for e in reversed(order):
        if e.parent is not None:
            e.parent.chars += e.chars
            e.parent.link_chars += e.link_chars
            e.parent.links += e.links
    for e in order:
        e.score *= 1.0 - e.link_chars / e.chars if e.chars else 0.0


def _best(root: Element) -> Element | None:
    """The element of the highest score; of equal ones the innermost."""
    best, stack = None, [(root, 0)]
    top = (0.0, -1)
    while stack:
        e, depth = stack.pop()
        if (e.score, depth) > top and e.score > 0:
            best, top = e, (e.score, depth)
        stack.extend((c, depth + 1) for c in e.children if not c.cut)
    return best


def _kept(best: Element, blocks: list[Block]) -> list[tuple[int, int]]:
    """Spans of blocks: the best container's, and what belongs with it."""
    def is_prose(chars: int, link_chars: int) -> bool:
        return chars > 0 and link_chars < LINKS * chars

    def belongs(e: Element) -> bool:
        """Beside a best article: other ones, and sections with a heading of their own."""
        return e is best or not e.cut and (e.tag == best.tag or e.tag == "section" and is_prose(e.chars, e.link_chars)
                                           and any(c.tag in PROSE - {"p"} for c in e.children))

    if best.tag in SEMANTIC and best.parent is not None:
        return [(x.first, x.last) for x in best.parent.children if belongs(x)]
    spans, e, above = [(best.first, best.last)], best, set()
    while e.parent is not None:
        e, inner = e.parent, e
        above.add(e)
        spans += [(x.first, x.last) for x in e.children
                  if x is not inner and not x.cut and is_prose(x.chars, x.link_chars)]
    return spans + [(i, i + 1) for i, b in enumerate(blocks) if b.owner in above and is_prose(len(b.text), b.link_chars)]


def _menus(root: Element, best: Element, blocks: list[Block]) -> list[tuple[int, int]]:
    """Spans of the lists of links outside the prose: none in articles, else those not after prose of the best container."""
    if best.tag in SEMANTIC:
        return []
    start = next((i for i in range(best.first, best.last) if blocks[i].owner.tag != "li"
                  and blocks[i].link_chars < LINKS * len(blocks[i].text)), best.last)
    menus, stack = [], [root]
    while stack:
        e = stack.pop()
        if not _is_menu(e):
            stack.extend(e.children)
        elif not start <= e.first < best.last:
            menus.append((e.first, e.last))
    return menus


def _is_menu(e: Element) -> bool:
    return e.tag in ("ul", "ol") and e.links >= 3 and e.chars > 0 and e.link_chars >= 0.9 * e.chars


def extract(html: str | None) -> str:
    """The main text of one page: its blocks joined by empty lines."""
    if not html:
        return ""
    for cut_forms in (True, False):  # some pages stand in one form as a whole
        tree = TreeBuilder(html, cut_forms).build()
        if tree.blocks:
            break
    blocks = tree.blocks
    if not blocks:
        return ""
    _score(tree.root, blocks)
    best = _best(tree.root)
    if best is None:
        return "\n\n".join(b.text for b in blocks)
    take = bytearray(len(blocks))
    for first, last in _kept(best, blocks):
        take[first:last] = b"\x01" * (last - first)
    for first, last in _menus(tree.root, best, blocks):
        take[first:last] = b"\x00" * (last - first)
    return "\n\n".join(b.text for b, keep in zip(blocks, take) if keep)


def _extract_batches(batches):
    import pyarrow as pa

    for batch in batches:
        html = batch.column("html")
        texts = [extract(html[i].as_py()) for i in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points)."""
    src = pick(pages, page_id=id_col, url=url_col, html=html_col)
    types = dict(src.dtypes)
    return src.mapInArrow(_extract_batches,
                          f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
