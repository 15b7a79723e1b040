"""Blocks of text of a web page, with the tree of block elements they lie in.

A tolerant reader in one pass over the page: unclosed and stray tags, cut off
pages, attributes without quotes, text with a bare ``<``. Its time is linear in
the page: open elements are kept down to ``MAX_DEPTH`` (deeper ones are not
told apart; their text counts to the last one kept).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

MAX_DEPTH = 512

# Element names of HTML by what they do here.
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "html body main article section div center p h1 h2 h3 h4 h5 h6 hgroup header footer nav aside address blockquote pre ul ol menu dir li dl dt dd "
    "table caption thead tbody tfoot tr td th form fieldset legend figure figcaption details summary dialog search hr".split()
)
HEAD = frozenset("meta link title base style script noscript template bgsound".split())
#: Elements that never hold the article.
ASIDE_TAGS = frozenset("nav footer aside menu form dialog search legend".split())
INLINE_ASIDE = frozenset("button select datalist svg canvas audio video object applet noscript template head label output progress meter".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
#: Words of class names and ids for what stands around an article.
ASIDE_WORDS = frozenset(
    "nav navbar navigation navi menu submenu breadcrumb breadcrumbs masthead topbar toolbar footer sidebar aside rail widget widgets "
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner leaderboard "
    "cookie cookies consent gdpr notice notices alert notification notifications popup modal overlay dialog "
    "newsletter subscribe subscription signup login search share sharing social related recommended recommendations "
    "comment comments reply replies respond discussion disqus form pagination pager copyright legal disclaimer sitemap".split()
)
#: Parts that name the same in words run together (sitefooter, cookiebar), and endings that do (topnav).
ASIDE_PARTS = ("sidebar", "footer", "comment", "cookie", "advert", "newsletter", "breadcrumb", "sponsor", "masthead", "pagination", "banner", "popup", "paywall")
ASIDE_ENDS = ("nav", "menu")
ARTICLE_PARTS = ("article", "post", "entry", "story", "content")
ARTICLE_ASIDE_WORDS = frozenset("comment comments reply replies respond ad ads advert advertisement sponsored promo related recommended".split())
ARTICLE_WORDS = frozenset("article articles post posts entry story content contents body text main page blog news".split())

_SCOPE = frozenset("html table td th caption".split())
_ENDS_ITEM = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "table tr"), "th": ("td th", "table tr")}
_ENDS_ITEM |= {t: ("thead tbody tfoot", "table") for t in ("thead", "tbody", "tfoot")}
ENDS_ITEM = {t: (frozenset(a.split()), frozenset(b.split())) for t, (a, b) in _ENDS_ITEM.items()}

_BARE_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)\s*>")
_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_STRAY = re.compile(r"[\s/=]*")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_DIGITS = re.compile(r"[0-9]+")


@dataclass
class Page:
    """Block elements in page order (a parent before its children) and the blocks of text between their tags."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["html"])
    label: list[str] = field(default_factory=lambda: [""])
    #: Whether the element's own tag, role or names say that it stands around an article.
    hinted: list[bool] = field(default_factory=lambda: [False])
    #: Whether the element holds the article whatever it looks like: article, main and their like.
    marked: list[bool] = field(default_factory=lambda: [False])
    #: (element, text, characters of it in links, links)
    blocks: list[tuple[int, str, int, int]] = field(default_factory=list)


def _name_words(names: str) -> list[str]:
    """Words of names, parted at other characters than letters and where small letters turn to capitals; sideBar is sidebar too."""
    whole = re.findall("[a-z]+", names.lower())
    parts = [w.lower() for w in _WORD.findall(names)]
    return whole if whole == parts else whole + parts


def _negative(tag: str, attributes: dict[str, str]) -> bool:
    if attributes.get("role", "").strip().lower() in ASIDE_ROLES or "hidden" in attributes:
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    words = _name_words(f"{attributes.get('class', '')} {attributes.get('id', '')}")
    words = [w for w, before in zip(words, ["", *words], strict=False) if before not in ("has", "with", "no", "without", "hide")]
    if tag in ("article", "main"):
        return any(w in ARTICLE_ASIDE_WORDS for w in words)
    if any(w in ASIDE_WORDS or w.endswith(ASIDE_ENDS) or any(part in w for part in ASIDE_PARTS) for w in words):
        return True
    return any(w.endswith("header") for w in words) and not any(w in ARTICLE_WORDS or any(part in w for part in ARTICLE_PARTS) for w in words)


def _generalised(tag: str, attributes: dict[str, str]) -> str:
    """Tag and class names in order of the alphabet, numbers in them replaced by #."""
    names = sorted({_DIGITS.sub("#", c) for c in attributes.get("class", "").lower().split()})
    return ".".join([tag, *names])


class _Reader:
    def __init__(self, html: str):
        self.html, self.page = html, Page()
        # Open elements: name, block element, whether its text is left out, whether it is a link.
        self.names, self.nodes, self.out, self.link = ["html"], [0], [False], [False]
        self.open = {"html": 1}
        self.deeper: dict[str, int] = {}
        self.pieces: list[str] = []
        self.link_chars = self.links = 0

    # -- text

    def text(self, raw: str) -> None:
        if self.out[-1]:
            if self.names[-1] == "head" and not raw.isspace():
                self.close("head")
                self.text(raw)
            return
        raw = unescape(raw) if "&" in raw else raw
        self.pieces.append(raw)
        if self.link[-1]:
            self.link_chars += len(raw.strip())

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.page.blocks.append((self.nodes[-1], text, min(self.link_chars, len(text)), self.links))
            self.pieces = []
        self.link_chars = self.links = 0

    # -- elements

    def pop(self) -> None:
        name = self.names.pop()
        if name in BLOCK:
            self.flush()
        self.open[name] -= 1
        self.nodes.pop(), self.out.pop(), self.link.pop()

    def pop_to(self, at: int) -> None:
        while len(self.names) > at:
            self.pop()

    def close(self, name: str) -> None:
        if self.deeper.get(name):
            self.deeper[name] -= 1
            if name in BLOCK:
                self.flush()
            return
        if not self.open.get(name) or name in ("html", "body"):
            return
        for at in range(len(self.names) - 1, 0, -1):
            here = self.names[at]
            if here == name:
                return self.pop_to(at)
            if here in _SCOPE and name not in _SCOPE and not (name in ("tr", "thead", "tbody", "tfoot") and here != "table"):
                return
            if here in BLOCK and (name not in BLOCK or name == "p"):
                return
            if name == "li" and here in ("ul", "ol", "menu", "dir"):
                return

    def close_implied(self, name: str) -> None:
        """What the start tag of a block closes: an open paragraph, the item before."""
        for at in range(len(self.names) - 1, 0, -1):
            if self.names[at] == "p":
                self.pop_to(at)
                break
            if self.names[at] in BLOCK:
                break
        if name in ENDS_ITEM:
            items, lists = ENDS_ITEM[name]
            for at in range(len(self.names) - 1, 0, -1):
                if self.names[at] in items:
                    return self.pop_to(at)
                if self.names[at] in lists or (self.names[at] in _SCOPE and name not in ("tr", "thead", "tbody", "tfoot")):
                    return

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if "head" in self.names[1:3] and name not in HEAD and name != "head":
            self.close("head")
        if name in ("html", "body") and self.open.get(name):
            return
        block = name in BLOCK
        if block:
            self.close_implied(name)
            self.flush()
        if name in VOID:
            if name == "br":
                self.text(" ")
            return
        if len(self.names) >= MAX_DEPTH:
            self.deeper[name] = self.deeper.get(name, 0) + 1
            return
        node, out = self.nodes[-1], self.out[-1]
        hinted = bool(attributes) and name not in ("html", "body") and _negative(name, attributes)
        if block:
            page = self.page
            page.parent.append(node)
            page.tag.append(name)
            page.label.append(_generalised(name, attributes) if "class" in attributes else name)
            page.hinted.append(hinted or name in ASIDE_TAGS)
            good = name in ("article", "main") or attributes.get("role", "").lower() in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody"
            page.marked.append(good and not hinted)
            node = len(page.tag) - 1
        else:
            out = out or hinted or name in INLINE_ASIDE
        if name == "a":
            self.links += 1
        self.names.append(name)
        self.nodes.append(node)
        self.out.append(out)
        self.link.append(self.link[-1] or name == "a")
        self.open[name] = self.open.get(name, 0) + 1

    # -- markup

    def attributes(self, at: int) -> tuple[dict[str, str], int]:
        """Attributes from ``at`` on, and the place behind the tag (the page's end if it is not closed)."""
        found: dict[str, str] = {}
        html = self.html
        while True:
            m = _ATTRIBUTE.match(html, at)
            if m is None:
                at = _STRAY.match(html, at).end()
                if at < len(html) and html[at] != ">":
                    continue
                return found, at + 1
            value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
            found.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
            at = m.end()

    def run(self) -> Page:
        html, at, n = self.html, 0, len(self.html)
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self.text(html[at:])
                break
            if lt > at:
                self.text(html[at:lt])
            bare = _BARE_TAG.match(html, lt)
            if bare:
                name, ends, attributes, at = bare[2].lower(), bool(bare[1]), {}, bare.end()
            else:
                ends = html.startswith("</", lt)
                m = _TAG_NAME.match(html, lt + 1 + ends)
                if m is None:
                    at = self.other(lt)
                    continue
                name = m[0].lower()
                attributes, at = self.attributes(m.end())
                if at > n:  # a tag that the page's end cuts off
                    break
            if ends:
                self.close(name)
                if name == "p" or name == "br":
                    self.flush() if name == "p" else self.text(" ")
            elif name in RAW:
                close = _RAW_END[name].search(html, at)
                at = close.start() if close else n
            else:
                self.start(name, attributes)
        self.pop_to(1)
        self.flush()
        return self.page

    def other(self, lt: int) -> int:
        """Comments, declarations, and a ``<`` that is text."""
        html = self.html
        if html.startswith("<!--", lt):
            if html.startswith((">", "->"), lt + 4):
                return html.index(">", lt + 4) + 1
            end = html.find("-->", lt + 4)
            return len(html) if end < 0 else end + 3
        if html.startswith(("<!", "<?", "</"), lt):
            end = html.find(">", lt)
            return len(html) if end < 0 else end + 1
        self.text("<")
        return lt + 1


def read_page(html: str) -> Page:
    """The blocks of a page and the elements around them."""
    return _Reader(html).run()
