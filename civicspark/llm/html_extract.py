"""Main text of web pages by consensus host paths.

One page alone can mislead: a short article among long adverts, a long
discussion below it. The pages of a host share their templates, so they vote.

Method. (1) Every page's containers (body, division, section, article, cell)
are scored by the text of their paragraphs that is not links; a container gets
half of what the containers in it have, so the tightest one around most of the
text wins, and elements that name themselves as article weigh more. (2) The
page votes for the generalised path of its best container: tag and class names
from the top down, numbers in names replaced. Spark adds the votes up per host
and path; a host's winning paths are those with a tenth of its votes, most
votes first. (3) Every page is read again: the best container on the first
winning path that it has is its article, or its own best one if it has none.
From it come all blocks of text but those in elements that stand around an
article (by tag, role, or words of class and id) and lists of links.

Scale. Votes are one narrow row per page, added up on the map side. Winning
paths (ten per host at most) come back to the pages by a broadcast if hosts
are few; else pages of hosts that hold many are split off, so the shuffle of
the others has no hot key.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.common import byte_slices, releasing
from civicspark.llm.page_blocks import Page, read_page
from civicspark.llm.url_filter import url_host
from civicspark.operators.joins import lookup
from civicspark.session import materialize, tuning

#: A path with this share of its host's votes wins.
SHARE = 0.1
#: Hosts whose winning paths may be broadcast.
BROADCAST_HOSTS = 20_000
#: Bytes of pages worked on at a time.
BATCH_BYTES = 4 << 20

#: What the text of inner containers counts for outer ones, and what marked, named and outermost containers weigh.
DECAY = 0.5
MARKED, NAMED, BODY = 1.5, 1.25, 0.8
#: A list is one of links from so many links and such a share of its text on.
MENU_LINKS, MENU_SHARE = 3, 0.8

_CONTAINERS = frozenset("html body div section article main td center".split())
_LISTS = frozenset("ul ol dl div section table".split())
_NAMES = frozenset("article post entry story content text body main".split())


# Headings of what stands around an article, in the languages of the pages this was made for.
_ASIDE_HEADING = re.compile(
    r"(\d+\s+)?(reader |user |all |leser)?"
    r"(comments?|replies|responses|discussion|leave a (comment|reply)|join the discussion|kommentare?|commentaires?|comentarios?|"
    r"related( articles| posts| stories| content)?|more stories|recommended( for you)?|you may also like|most read|"
    r"advertisement|sponsored|anzeige|werbung|publicité|publicidad|newsletter|share this|follow us)\W*(\(?\d+\)?)?\W*",
    re.IGNORECASE,
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 legend summary".split())


class Layout:
    """Scores of a page's containers."""

    def __init__(self, page: Page):
        self.page = page
        n = len(page.tag)
        self.gain, self.chars, self.link_chars, self.links = (np.zeros(n, np.int64) for _ in range(4))
        for node, text, linked, links in page.blocks:
            self.gain[node] += max(0, len(text) - 2 * linked)
            self.chars[node] += len(text)
            self.link_chars[node] += linked
            self.links[node] += links
        self.bad = self._around()
        self.mass = self._mass(self.gain)

    def _around(self) -> list[bool]:
        """Elements that stand around the article, with all that is in them."""
        page, whole = self.page, self.gain.copy()
        marks, titles = np.array(page.marked), np.array([t == "h1" for t in page.tag])
        for i in range(len(page.tag) - 1, 0, -1):
            up = page.parent[i]
            whole[up] += whole[i]
            marks[up] |= marks[i]
            titles[up] |= titles[i]
        titled = self._titled()
        bad = [False] * len(page.tag)
        for i in range(1, len(page.tag)):
            if bad[page.parent[i]]:
                bad[i] = True
            elif page.hinted[i] or titled[i]:
                # A form or a wrapper "page-with-sidebar" around the article itself is none of the things it is named after.
                holds = marks[i] or ((titles[i] or page.tag[i] == "form") and 2 * whole[i] > whole[0])
                bad[i] = page.tag[i] in ("nav", "footer", "aside") or not holds
            elif page.tag[i] == "header":
                bad[i] = not self._within(i)
        return bad

    def _titled(self) -> list[bool]:
        """Containers that begin with a heading for comments, related articles or adverts."""
        page, seen = self.page, [False] * len(self.page.tag)
        titled = [False] * len(page.tag)
        for node, text, _, _ in page.blocks:
            says_so = page.tag[node] in _HEADINGS and len(text) < 60 and _ASIDE_HEADING.fullmatch(text) is not None
            at = node
            while at > 0 and not seen[at]:  # elements of which this is the first block
                seen[at] = True
                titled[at] = says_so and at != node and page.tag[at] in ("div", "section", "article")
                at = page.parent[at]
        return titled

    def _within(self, i: int) -> bool:
        """Whether an element lies in a marked one (the header of an article is part of it)."""
        while i > 0:
            i = self.page.parent[i]
            if self.page.marked[i]:
                return True
        return False

    def _mass(self, own: np.ndarray) -> np.ndarray:
        mass = np.where(self.bad, 0, own).astype(np.float64)
        for i in range(len(mass) - 1, 0, -1):
            if not self.bad[i]:
                mass[self.page.parent[i]] += mass[i] * (DECAY if self.page.tag[i] in _CONTAINERS else 1)
        return mass

    def _weight(self, i: int) -> float:
        page = self.page
        if page.marked[i]:
            return MARKED
        if any(w in _NAMES for name in page.label[i].split(".")[1:] for w in name.replace("_", "-").split("-")):
            return NAMED
        return BODY if page.tag[i] in ("html", "body") else 1.0

    def best(self, among: list[int] | None = None) -> int | None:
        """The container with the highest score, the first of equals; if it lies in an article, that one."""
        candidates = [i for i in (range(len(self.mass)) if among is None else among) if not self.bad[i] and self.page.tag[i] in _CONTAINERS]
        for mass in (self.mass, None):
            if mass is None:  # nothing but links: by any text
                mass = self._mass(self.chars)
            scores = [(mass[i] * self._weight(i), -i) for i in candidates if mass[i] > 0]
            if scores:
                return self._article(-max(scores)[1])
        return None

    def _article(self, i: int) -> int:
        at = i
        while at > 0:
            if self.page.tag[at] == "article":
                return at
            at = self.page.parent[at]
        return i

    def path(self, i: int) -> str:
        """Tag and class names below the body; long paths by their digest."""
        labels = []
        while i > 0:
            labels.append(self.page.label[i])
            i = self.page.parent[i]
        whole = ">".join(reversed(labels))
        return whole if len(whole) <= 200 else hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest()

    def text(self, container: int) -> str:
        """Blocks of the container in page order, without what stands around and without lists of links."""
        page, n = self.page, len(self.page.tag)
        chars, linked, links = self.chars.copy(), self.link_chars.copy(), self.links.copy()
        for i in range(n - 1, 0, -1):
            up = page.parent[i]
            chars[up] += chars[i]
            linked[up] += linked[i]
            links[up] += links[i]
        inside = [False] * n
        inside[container] = True
        for i in range(container + 1, n):
            if inside[page.parent[i]] and not self.bad[i]:
                menu = page.tag[i] in _LISTS and links[i] >= MENU_LINKS and linked[i] >= MENU_SHARE * chars[i]
                inside[i] = not menu
        return "\n".join(text for node, text, _, _ in page.blocks if inside[node])


def vote(html: str) -> str | None:
    """The path of a page's best container, if it has any text."""
    layout = Layout(read_page(html))
    best = layout.best()
    return None if best is None else layout.path(best)


def main_text(html: str, paths: list[str] | None = None) -> str:
    """The article on the first of ``paths`` that the page has, else in its best container."""
    layout = Layout(read_page(html))
    best = layout.best()
    if best is None:
        return ""
    if paths:
        at: dict[str, list[int]] = {}
        for i, tag in enumerate(layout.page.tag):
            if tag in _CONTAINERS and layout.mass[i] > 0:
                at.setdefault(layout.path(i), []).append(i)
        for path in paths:
            if path in at:
                found = layout.best(at[path])
                if found is not None:
                    best = found
                    break
    return layout.text(best)


def host_paths(rows: DataFrame, share: float = SHARE) -> DataFrame:
    """``host, paths``: the winning paths of every host, most votes first, ties in order of the path.

    ``rows`` has ``host`` and ``html``. Pages without a host do not vote.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "html", BATCH_BYTES):
                paths = [vote(html) for html in batch.column("html").to_pylist()]
                yield pa.record_batch({"host": batch.column("host"), "path": pa.array(paths, pa.string())})

    votes = rows.where("host <> ''").select("host", "html").mapInArrow(releasing(run), "host string, path string")
    counted = materialize(votes.where("path IS NOT NULL").groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")), "host-votes")
    totals = materialize(counted.groupBy("host").agg(F.sum("n").alias("n_votes")), "host-totals")
    winners = lookup(counted, totals, ["host"], [], ["n_votes"]).where(F.col("n") >= share * F.col("n_votes"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))  # 1 / share paths at most
    return winners.groupBy("host").agg(F.transform(ranked, lambda r: r["path"]).alias("paths"))


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    share: float = SHARE,
) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text, n_chars`` (code points of ``text``).

    White space inside a block is one space, blocks are joined by line feeds.
    A null or empty page, or one without text, gives an empty text. A page
    whose url is null or has no host is read on its own. Repeated rows vote
    and are read each. Other columns, whatever their names, are ignored; an
    empty table gives an empty result. Pages may be as long as a task's memory
    allows; reading takes time in proportion.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), url_host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    winners = materialize(host_paths(rows, share), "host-paths")
    limit = tuning(spark, "htmlBroadcastHosts", BROADCAST_HOSTS)
    found = lookup(rows, winners, ["host"], [], ["paths"], broadcast_rows=limit, keys_from=rows.select("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in byte_slices(whole, "html", BATCH_BYTES):
                pairs = zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist(), strict=True)
                texts = [main_text(html, paths) for html, paths in pairs]
                yield pa.record_batch(
                    {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}
                )

    return found.select("page_id", "url", "html", "paths").mapInArrow(releasing(run), f"page_id {kind}, url string, text string, n_chars bigint")
