"""Main text of web pages from parser events and text-to-tag ratios."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import ship, text_of

# Elements of HTML by what they hold.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul".split())
CONTAINERS = frozenset("article body div main section td".split())
NEVER_TEXT = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input label map menu nav noscript object "
    "option script select style svg template textarea title video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Whole class tokens and ids, such as sidebar, left-sidebar or sidebar-2; layout names such as has-sidebar, no-sidebar,
# content-with-header, comments-open and article-header are none of these.
_BEFORE = "site|global|top|bottom|left|right|primary|secondary|main|mobile|post|entry"
_AFTER = ("box|bar|list|links|buttons|items?|container|block|form|section|area|slot|unit|left|right|top|bottom|posts|"
          "articles|stories|inner|outer")
_COMMENTS = "comments?|disqus|replies|reply|respond"
_OTHERS = ("ads?|advert(?:s|isement|ising|orial)?|aside|banner|breadcrumbs?|byline-share|consent|cookies?|footer|gdpr|"
           "masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo|related|share|sharing|"
           "sidebar|sidenav|signup|social|sponsor(?:ed)?|subscribe|toolbar|topbar|widget")


def _names(words: str, before: str = _BEFORE) -> re.Pattern:
    return re.compile(rf"(?:(?:{before})[_-])?(?:{words})(?:[_-](?:{words}|{_AFTER}))*(?:[_-]?\d+)?", re.IGNORECASE)


COMMENTS = _names(_COMMENTS)
# The header of a post or an entry is its own.
NOT_CONTENT = (_names(f"{_COMMENTS}|{_OTHERS}"), _names("header", "site|global|top|bottom|mobile"))
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

SIGMA = 1.0


@dataclass
class Block:
    """A line of the page: its text, the tags met in it, the innermost container around it (-1: none)."""

    text: str
    tags: int
    within: int


@dataclass
class _Open:
    """An open element, and what holds for all inside it: whether it is hidden, its container, its named elements."""

    tag: str
    skipped: bool
    named: bool
    inside: bool
    hidden: bool
    within: int
    chain: int


_ROOT = _Open("", False, False, False, False, -1, -1)


@dataclass
class _Page(HTMLParser):
    """The lines of a page. Every event costs the same however deep the page is nested."""

    blocks: list[Block] = field(default_factory=list)
    semantic: set[int] = field(default_factory=set)
    parents: list[int] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self._open: list[_Open] = []
        # Where in the stack the open elements of each tag are.
        self._at: dict[str, list[int]] = {}
        # Elements named as something else: the one around each, and whether an article or main is inside.
        self._around: list[int] = []
        self._encloses: list[bool] = []
        # Text with the innermost such element around it, which is judged at the end.
        self._text: list[tuple[str, int]] = []
        self._read: list[tuple[list[tuple[str, int]], int, int]] = []
        self._free = False
        self._tags = 0

    def _top(self) -> _Open:
        return self._open[-1] if self._open else _ROOT

    def _within(self, *tags: str) -> int:
        """The place in the stack of the innermost open element with one of the tags, -1 if there is none."""
        return max((self._at[tag][-1] for tag in tags if self._at.get(tag)), default=-1)

    def _pop(self) -> None:
        self._at[self._open.pop().tag].pop()

    def _flush(self) -> None:
        if self._text:
            self._read.append((self._text, self._tags, self._top().within))
            self._text, self._tags = [], 0

    def _is_content(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in NEVER_TEXT or "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
            return False
        if tag == "header" and self._within("article", "main") < 0:
            return False
        if (attrs.get("role") or "").lower() in ROLES or HIDDEN.search(attrs.get("style") or ""):
            return False
        return True

    def _named(self, tag: str, attrs: dict[str, str | None]) -> tuple[bool, bool]:
        """Whether the names of an element say that it is no content, and whether they say comments."""
        if tag in ("html", "body", "main"):
            return False, False
        names = [token for name in ("class", "id") for token in (attrs.get(name) or "").split()]
        comments = any(COMMENTS.fullmatch(token) for token in names)
        return comments or (tag != "article" and any(p.fullmatch(t) for t in names for p in NOT_CONTENT)), comments

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self._text.append((" ", -1))
        self._tags += 1
        if tag in VOID:
            return
        last = self._top()
        nested = last.tag == tag and (last.skipped or last.named or last.inside)
        if nested and tag in ("p", "li"):
            self._pop()  # a new paragraph or item ends one that was left open
            nested = False
        held = dict(attrs)
        content = self._is_content(tag, held)
        named, comments = self._named(tag, held)
        # Comments stay out whatever they enclose; the rest is judged when the whole page is read.
        skipped, named = nested and last.skipped or not content or comments, named and not comments
        around = self._top()
        if tag in ("article", "main") and not skipped and not around.hidden:
            self._free = self._free or around.chain < 0
            chain = around.chain
            while chain >= 0 and not self._encloses[chain]:
                self._encloses[chain] = True
                chain = self._around[chain]
        if nested or tag in CONTAINERS or skipped or named:
            within, chain = around.within, around.chain
            if tag in CONTAINERS or named:
                self.parents.append(within)
                within = len(self.parents) - 1
            if named:
                self._around.append(chain)
                self._encloses.append(False)
                chain = len(self._around) - 1
            if tag in ("article", "main"):
                self.semantic.add(within)
            self._at.setdefault(tag, []).append(len(self._open))
            self._open.append(_Open(tag, skipped, named, nested, around.hidden or skipped, within, chain))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # Outside foreign elements a closing slash means nothing: <div/> opens a div.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        self._tags += 1
        at = self._within(tag)
        # What a closing tag leaves open inside it ends with it, unless it would end the article.
        if at >= 0 and tag not in ("body", "html") and self._within("article", "main") <= at:
            while len(self._open) > at:
                self._pop()

    def handle_data(self, data: str) -> None:
        last = self._top()
        if not last.hidden:
            self._text.append((data, last.chain))

    def close(self) -> None:
        super().close()
        self._flush()
        # An article or main stays with what encloses it; teasers in a named part go where another stands outside.
        stays = []
        for encloses, around in zip(self._encloses, self._around, strict=True):
            stays.append(encloses and not self._free and (around < 0 or stays[around]))
        tags = 0
        for parts, more, within in self._read:
            tags += more
            text = " ".join("".join(data for data, chain in parts if chain < 0 or stays[chain]).split())
            if text:
                self.blocks.append(Block(text, tags, within))
                tags = 0


def ratios(blocks: list[Block], sigma: float = SIGMA) -> np.ndarray:
    """Characters per tag of each line, smoothed with a Gaussian over its neighbours."""
    raw = np.array([len(block.text) / max(1, block.tags) for block in blocks], float)
    reach = max(1, int(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(raw, reach, mode="edge"), weights / weights.sum(), mode="valid")


def main_text(html: str) -> str:
    """The blocks of the main region of a page, one a line; empty if there is none.

    Parser events give the lines of the page. Lines whose smoothed text-to-tag ratio reaches the standard
    deviation of all ratios form the content cluster. The region is the innermost container that holds nine tenths
    of the cluster's text; of the containers that do, an article or main element is taken first, as its title belongs
    to it. A region is kept whole, so its short paragraphs stay, without what its own markup names as something
    else: menus, notices, forms, comments and the like.
    """
    page = _Page()
    page.feed(html)
    page.close()
    lines = page.blocks
    if not lines:
        return ""
    smoothed = ratios(lines)
    cluster = smoothed >= min(smoothed.std(), smoothed.max())
    held, total = [0] * len(page.parents), 0
    for block, inside in zip(lines, cluster.tolist(), strict=True):
        if inside:
            total += len(block.text)
            if block.within >= 0:
                held[block.within] += len(block.text)
    # A container has a higher number than the one around it.
    for number in range(len(held) - 1, 0, -1):
        if page.parents[number] >= 0:
            held[page.parents[number]] += held[number]
    most = [number for number, size in enumerate(held) if 10 * size >= 9 * total]
    region = max((number for number in most if number in page.semantic), default=max(most, default=None))
    if region is None:
        return "\n".join(block.text for block in lines)
    within = [False] * len(held)
    for number, parent in enumerate(page.parents):
        within[number] = number == region or parent >= 0 and within[parent]
    return "\n".join(block.text for block in lines if block.within >= 0 and within[block.within])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            texts = [main_text(html.as_py()) for html in part.column(2)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page; see `main_text`.

    A null or empty html gives an empty text, as does a page without content; null ids and urls stay null;
    repeated rows each get a row; an empty table gives an empty result. Broken markup is read as browsers do
    it, by ignoring it. Other columns are ignored. A page is worked off in its row, in time and memory in proportion
    to its length however deep its elements are nested; nothing is shuffled.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        text_of(html).alias("html"))
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
