"""Operator 2: main text of HTML pages.

The standard library's streaming parser sends events; block-level tags cut the
text into blocks, which take the place of lines.  Each block has a text-to-tag
ratio; the ratios are smoothed along the page with a Gaussian, and a threshold
at a share of their mean clusters blocks into content and other blocks.  Blocks
inside menus, footers, sidebars, notices, adverts, forms and comments never
count, unless a labelled element holds half of the page's text or an article.  The content region is the container (article, main, else the body) that
holds most content text, with all that hold half as much or more; an article is
taken whole, so its short paragraphs and headings stay, but for lists and other blocks
of links that lie outside the content clusters.  In a bare body the blocks in or between
content clusters are taken, and the headings and paragraphs beside them under the same
parent.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kestrel.llm.store import columns

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search
    section summary table tbody td tfoot th thead tr ul""".split())
HIDDEN = frozenset("""script style noscript template iframe object svg math canvas audio video select button textarea
    head title datalist""".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog search".split())
#: Elements in which even an article or main is no content.
HARD = frozenset("nav footer aside menu dialog search".split())
HARD_ROLES = frozenset("navigation contentinfo complementary".split())
#: So are classes and ids that begin with these.
HARD_LABELS = frozenset("comment comments respond disqus related recommended".split())
#: A start tag of these ends an open p.
ENDS_P = BLOCKS - frozenset("body html caption legend tbody td tfoot th thead tr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new start tag (key) ends an open one (value) of the same list or table.
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table tbody thead tfoot tr article main section div body html aside nav footer".split())
LABELS = frozenset("""ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
    cookie cookies consent gdpr notice notices alert sidebar sidenav menu menus nav navbar navigation breadcrumb
    breadcrumbs footer masthead comment comments respond disqus share sharing social related recommended newsletter
    subscribe subscription popup modal overlay login signup toolbar pagination pager widget widgets disclaimer
    copyright skip""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
CONTAINERS = frozenset(["article", "main"])
#: Blocks that extend a body region beside them.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
#: Tags that may stand in a head; any other start tag ends it, as </head> may be left out.
IN_HEAD = frozenset("title meta link script style base noscript template head".split())
#: Hidden elements that the start tag of a block ends.
ENDED_BY_BLOCK = frozenset("button select option title datalist".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A section or div under such a heading holds what readers wrote.
COMMENT_HEADING = re.compile(r"(\d+ )?((reader|user) )?comments?( \(\d+\))?:?|leave a (comment|reply)|join the discussion", re.I)
COMPARABLE = 0.5  # share of the heaviest container's content
_SPACE = re.compile(r"\s+")
_LABEL = re.compile(r"[A-Za-z]+")


def _is_boilerplate(tag: str, attrs, in_container: bool) -> int:
    """0: no, 1: by a label, a form or a header, 2: also for an article inside."""
    found = 2 if tag in HARD else int(tag in BOILERPLATE or tag == "header" and not in_container)
    for name, value in attrs:
        if name in ("class", "id") and value and tag not in ("body", "html", *CONTAINERS):
            for part in value.split():
                # Names such as "ad-slot" or "page_footer" count; words inside longer ones do not.
                names = [w.lower() for w in _LABEL.findall(part)]
                if any(w in LABELS for w in names):
                    found = max(found, 2 if names[0] in HARD_LABELS else 1)
        elif name == "role" and value and value.strip().lower() in ROLES:
            found = max(found, 2 if value.strip().lower() in HARD_ROLES else 1)
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            found = 2
    return found


class PageParser(HTMLParser):
    """Collects (text, tags, container, hard, label, block tag, parent, characters in links) per block of a page.

    Nested containers have the outermost one's number.

    ``hard`` blocks are boilerplate.  ``label`` is the innermost labelled element around
    a block (0: none), whose parent in ``outer`` is the next one."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, bool, int, str, int, int]] = []
        self.open: list[tuple] = []  # tag, hidden, hard, container, label, block tag, block, parent
        self.outer = [0]
        self.parts: list[str] = []
        self.tags = 0
        self.containers = 0
        self.elements = 0
        self.in_link = False
        self.linked = 0

    def _state(self):
        return self.open[-1] if self.open else ("", False, False, 0, 0, "", 0, 0)

    def cut(self):
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            _, _, hard, container, label, block, _, parent = self._state()
            if block in HEADINGS and COMMENT_HEADING.fullmatch(text):
                hard = self._end_content(parent) or hard
            self.blocks.append((text, self.tags, container, hard, label, block, parent, self.linked))
            self.tags = 0
        self.parts, self.linked = [], 0

    def _end_content(self, element: int) -> bool:
        """What follows in the section or div of this number is boilerplate."""
        for k, (tag, hidden, _, *rest) in enumerate(self.open):
            if tag in ("section", "div") and rest[3] == element:
                self.open[k] = (tag, hidden, True, *rest)
                return True
        return False

    def _end(self, tags: frozenset, upto: frozenset) -> bool:
        """Close the innermost open element of ``tags`` that no element of ``upto`` is inside of."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                del self.open[k:]
                return True
            if self.open[k][0] in upto:
                return False
        return False

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD and any(x[0] == "head" for x in self.open[:3]):
            self._end(frozenset(["head"]), frozenset())
        if tag in BLOCKS:
            while self._end(ENDED_BY_BLOCK, BLOCKS):
                pass
            self.cut()
        if tag == "a":
            self.in_link = True
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in ENDS_P:
            self._end(frozenset(["p"]), BLOCKS)
        if tag in VOID:
            return
        if tag in IMPLIED:
            self._end(frozenset(IMPLIED[tag]), SCOPES - frozenset(IMPLIED[tag]))
        _, hidden, hard, container, label, block, at, parent = self._state()
        kind = _is_boilerplate(tag, attrs, container > 0)
        hard = hard or kind == 2
        if tag in CONTAINERS:
            if not container:
                self.containers += 1
                container = self.containers
            label = 0  # a label around an article is the layout's
        if kind == 1:
            self.outer.append(label)
            label = len(self.outer) - 1
        if tag in BLOCKS:
            self.elements += 1
            block, at, parent = tag, self.elements, at
        self.open.append((tag, hidden or tag in HIDDEN, hard, container, label, block, at, parent))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.cut()
        if tag in BLOCKS or tag == "a":
            self.in_link = False
        self.tags += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        if not self._state()[1]:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data.strip())


def labelled(blocks, outer: list[int]) -> np.ndarray:
    """Whether each block is boilerplate: hard, or inside a labelled element that does not
    hold half of the page's other text; one that does is a layout wrapper."""
    mass = [0] * len(outer)
    for text, _, _, hard, label, *_ in blocks:
        mass[label] += 0 if hard else len(text)
    total = sum(mass)
    for k in range(len(outer) - 1, 0, -1):
        if outer[k]:
            mass[outer[k]] += mass[k]
    counts = [False] * len(outer)
    for k in range(1, len(outer)):
        counts[k] = 2 * mass[k] < total or counts[outer[k]]
    return np.array([b[3] or counts[b[4]] for b in blocks], bool)


def smooth(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing along the page; the kernel is cut at three sigma and renormalised at the ends."""
    if not len(ratios):
        return ratios
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach:reach + len(ratios)] / weight


def main_text(html: str | None, sigma: float = 1.0, share: float = 0.5) -> str:
    """The main text of one page: blocks in page order joined by a newline."""
    if not html:
        return ""
    parser = PageParser()
    parser.feed(html)
    parser.close()
    parser.cut()
    blocks = parser.blocks
    if not blocks:
        return ""
    size = np.array([len(b[0]) for b in blocks], float)
    boilerplate = labelled(blocks, parser.outer)
    ratio = np.where(boilerplate, 0.0, size / np.maximum(1, [b[1] for b in blocks]))
    even = smooth(ratio, sigma)
    content = (even >= share * even.mean()) & ~boilerplate
    if not content.any():
        content = ~boilerplate
    container = np.array([b[2] for b in blocks])
    mass = np.bincount(container, weights=np.where(content, size, 0.0))
    if len(mass) > 1 and mass[1:].max() > 0:
        # Every article or main of comparable mass; one repeated word for word counts once.
        mass[0] = 0
        heavy = mass >= COMPARABLE * mass.max()
        # Outside the clusters, blocks made of links are menus that no label tells.
        links = np.array([2 * b[7] > len(b[0]) and b[5] not in PROSE for b in blocks])
        fits = heavy[container] & ~boilerplate & (content | ~links)
        members: dict[int, list[int]] = {}
        for i in np.flatnonzero(fits):
            members.setdefault(int(container[i]), []).append(i)
        take = np.zeros(len(blocks), bool)
        for own in {tuple(blocks[i][0] for i in m): m for m in reversed(members.values())}.values():
            take[own] = True
    else:
        # Smoothing lifts the neighbours of a region; it begins and ends with blocks that stand out themselves.
        at = np.flatnonzero(content & (ratio >= share * even.mean()))
        take = ~boilerplate
        if len(at):
            first, last = at[0], at[-1]
            parents = {b[6] for b, t in zip(blocks[first:last + 1], take[first:last + 1]) if t}

            def beside(i):
                return 0 <= i < len(blocks) and take[i] and blocks[i][5] in PROSE and blocks[i][6] in parents
            while beside(first - 1):
                first -= 1
            while beside(last + 1):
                last += 1
            take[:first] = take[last + 1:] = False
    return "\n".join(b[0] for b, t in zip(blocks, take) if t)


def extract(pages: DataFrame, sigma: float = 1.0, share: float = 0.5) -> DataFrame:
    """``pages(page_id, url, html)`` -> page_id, url, text, n_chars (code points).

    One page is parsed at a time, so memory follows the longest page.  Null and empty
    html, and pages without any content block, give an empty text; broken markup is
    read as browsers do it, as far as the parser follows; repeated rows give repeated
    results; extra columns are ignored.
    """
    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py(), sigma, share) for h in batch["html"]]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    own = pages.select(*columns(pages, "page_id", "url", "html"))
    kind = {f.name: f.dataType.simpleString() for f in own.schema.fields}
    return own.mapInArrow(run, f"page_id {kind['page_id']}, url string, text string, n_chars bigint")


def extract_query(pages: DataFrame) -> DataFrame:
    return extract(pages)
