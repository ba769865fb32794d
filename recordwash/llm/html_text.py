"""Main text of web pages: parser events, text-to-tag ratios, smoothing, threshold.

The standard library's parser streams a page's events into lines, one per block of text, each
with its number of tags and the region it lies in: the outermost article or main element, else
the nearest container. A line's ratio is its characters over its tags; ratios are smoothed
by a Gaussian over the lines of the page, and their standard deviation is the threshold that
parts content from the rest. A region is content if its lines' mean smoothed ratio, weighted by
length, reaches it; its lines are then kept whole, short ones too. An article or main element
needs only `ARTICLE_SHARE` of the threshold; regions outside it are judged like those of any page.
Lines in menus, forms, hidden parts and the like, told by their element or its role, count for
the threshold only.

Comments, notices and adverts are prose like an article, so their ratio can't tell them. A region
whose class or id is such a word, alone or with words of structure ("comments", "comment-body",
"cookie-notice"), is unwanted, articles included: its lines don't count for the threshold, and
they are content only if nothing else is and they hold most of the text. An id that names a
section with a heading inside an article ("cookies") is a heading's name, but for comments and
adverts.

Any other boilerplate word in a class or id only makes a region doubtful: inside an article
it becomes a region of its own, and it is content if it also reaches the mean of the smoothed
ratios, or if no other region reaches the threshold. Outside of articles doubtful
regions must also hold more text than what is sure, which counts 1 / `ARTICLE_SHARE` times.
A container around an article or main element isn't doubtful, and neither is a name that says
where the word's thing lacks or stands ("no-sidebar").

Character references are decoded, white space in a block becomes one space, and blocks are
joined by an empty line.

Defined results: null or empty html gives an empty text; a page whose regions all miss the
threshold gives its best region; broken markup is read as far as it goes; rows pass through
with all their columns, and a taken result name gets underscores before it.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import partial
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from recordwash.llm.common import add_column, free_name

SIGMA = 1.0
#: Of what other regions need, what an article or main element must reach.
ARTICLE_SHARE = 0.25

# Elements and words of HTML pages.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset(
    "article aside body dialog div footer form head header main nav ol section table td ul".split()
)
CONTENT = frozenset(["article", "main"])
NEVER_CONTENT = frozenset(
    "aside button canvas dialog footer form head iframe nav noscript object script select style"
    " svg template textarea title".split()
)
INLINE = NEVER_CONTENT - BLOCKS - CONTAINERS
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment"
    " comments consent cookie cookies disqus footer login menu modal nav navbar navigation"
    " newsletter notice pagination popup promo related respond share sharing sidebar signup"
    " social sponsor sponsored subscribe widget".split()
)
#: Of these words, what is prose of another kind than the article's: adverts and readers' comments,
#: and notices.
ADVERTS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus newsletter popup"
    " promo respond sponsor sponsored subscribe".split()
)
UNWANTED = ADVERTS | frozenset("banner consent cookie cookies notice signup".split())
#: Words that say how a thing is built, not what it is.
STRUCTURE_WORDS = frozenset(
    "area bar block body bottom box card container entry form group holder inner item items left"
    " list message outer panel right row section slot text thread top unit wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLEAR, DOUBTFUL, UNWANTED_REGION = 0, 1, 2
#: A name with one of these says where a boilerplate word stands or lacks, not what is inside.
LAYOUT_WORDS = frozenset("content has main no with wrap".split())
BOILERPLATE_ROLES = frozenset(
    "alert banner complementary contentinfo dialog form menu navigation search".split()
)
_WORD = re.compile(r"[a-z]+")
_CUT_TAG = re.compile(r"</?[A-Za-z][^<>]*\Z")


class Lines(HTMLParser):
    """A page as lines: text, number of tags, region, whether it can be content."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []
        self.in_content: list[bool] = [False]
        self._level: list[int] = [CLEAR]
        self._around: list[int] = [0]  # the region that a region lies in
        self._holds_content: list[bool] = [False]
        self._headed = 0  # a region that a heading next would make one of the article's
        self._depth: Counter[str] = Counter()  # how many of an element are open
        self._open: list[tuple[str, int, bool]] = []  # element, region, can be content
        self._text: list[str] = []
        self._tags = 0
        self._unseen = 0  # open elements inside a block of text that are not part of it

    def _here(self) -> tuple[int, bool]:
        return self._open[-1][1:] if self._open else (0, True)

    def _end_line(self) -> None:
        if text := " ".join("".join(self._text).split()):
            self.lines.append((text, self._tags, *self._here()))
        self._text, self._tags = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._end_line()
            if self._headed and tag in HEADINGS:
                self._level[self._headed] = DOUBTFUL
                self._headed = 0
        self._tags += 1
        if tag in VOID:
            if tag == "br":
                self._text.append(" ")
            return
        region, can = self._here()
        drop = tag in NEVER_CONTENT
        if tag in CONTAINERS or drop:
            inside = self.in_content[region]
            drop = drop or self._boilerplate(tag, attrs, inside)
            level, by_id = self._named(tag, attrs, inside) if can and not drop else (CLEAR, False)
            if not inside or level:
                self._around.append(region)
                region = len(self.in_content)
                starts = tag in CONTENT and can and not drop and level != UNWANTED_REGION
                self.in_content.append(inside or starts)
                self._level.append(level)
                self._holds_content.append(False)
                self._headed = region if by_id else 0
                at = region if starts and not inside else 0
                while at and not self._holds_content[at]:
                    self._holds_content[at] = True
                    at = self._around[at]
            if tag in CONTAINERS and tag not in BLOCKS:
                self._end_line()
            self._unseen += tag in INLINE
            self._open.append((tag, region, can and not drop))
            self._depth[tag] += 1

    @staticmethod
    def _boilerplate(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
        if tag == "body" or tag in CONTENT:
            return False
        if tag == "header":
            return not inside
        values = {k: (v or "").lower() for k, v in attrs}
        return (
            values.get("role") in BOILERPLATE_ROLES
            or "hidden" in values
            or values.get("aria-hidden") == "true"
            or "display:none" in values.get("style", "").replace(" ", "")
        )

    @staticmethod
    def _named(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> tuple[int, bool]:
        """What class and id say of an element, and whether a heading next would allay it."""
        if tag in ("body", "header", "main"):
            return CLEAR, False
        level, by_id = CLEAR, False
        for kind, value in attrs:
            if kind not in ("class", "id") or not value:
                continue
            for name in value.lower().split():
                words = set(_WORD.findall(name))
                if not LAYOUT_WORDS.isdisjoint(words):
                    continue
                if not UNWANTED.isdisjoint(words) and words <= BOILERPLATE_WORDS | STRUCTURE_WORDS:
                    slug = kind == "id" and inside and ADVERTS.isdisjoint(words)
                    by_id = slug and (by_id or level != UNWANTED_REGION)
                    level = UNWANTED_REGION
                elif tag not in CONTENT and (
                    not BOILERPLATE_WORDS.isdisjoint(words) or (not inside and "header" in words)
                ):
                    level = max(level, DOUBTFUL)
        return level, by_id

    def levels(self) -> list[int]:
        """What a region's name, or that of one around it, makes of it."""
        found: list[int] = []
        for own, holds, around in zip(self._level, self._holds_content, self._around):
            own = CLEAR if own == DOUBTFUL and holds else own
            found.append(max(own, found[around]) if found else own)
        return found

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        if not self._depth[tag]:
            return
        for depth in range(len(self._open) - 1, -1, -1):
            if self._open[depth][0] == tag:
                if tag in CONTAINERS:
                    self._end_line()
                for element, *_ in self._open[depth:]:
                    self._unseen -= element in INLINE
                    self._depth[element] -= 1
                del self._open[depth:]
                break

    def handle_data(self, data: str) -> None:
        if not self._unseen:
            self._text.append(data)
            if self._headed and not data.isspace():
                self._headed = 0

    def close(self) -> None:
        super().close()
        self._end_line()


def parse(html: str) -> Lines:
    html = _CUT_TAG.sub("", html)
    page = Lines()
    try:
        page.feed(html)
        page.close()
    except AssertionError:  # the parser rejects unknown marked sections; browsers skip them
        page = Lines()
        page.feed(html.replace("<![", "<!-["))
        page.close()
    return page


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """A Gaussian mean over neighbouring lines, with weights that add up at the ends too."""
    reach = max(1, int(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(values, weights)[reach : reach + len(values)]
    return total / np.convolve(np.ones(len(values)), weights)[reach : reach + len(values)]


def content_lines(page: Lines) -> list[str]:
    """The lines of the regions that are content."""
    lines = page.lines
    if not any(can for *_, can in lines):
        return []
    lengths = np.array([len(text) for text, *_ in lines], float)
    ratios = smoothed(lengths / np.array([max(1, tags) for _, tags, *_ in lines]))
    level = np.array(page.levels())
    wanted = level[[region for _, _, region, _ in lines]] != UNWANTED_REGION
    threshold = ratios[wanted].std() if wanted.any() else ratios.std()
    may = np.array([can for *_, can in lines])
    regions = np.array([region for _, _, region, _ in lines])
    size = len(page.in_content)
    weight = np.bincount(regions[may], lengths[may], size)
    total = np.bincount(regions[may], (lengths * ratios)[may], size)
    score = np.divide(total, weight, out=np.full(size, -1.0), where=weight > 0)
    inside = np.array(page.in_content)
    sure = level == CLEAR
    chosen = score >= np.where(inside & sure, ARTICLE_SHARE * threshold, threshold)
    unwanted = (level == UNWANTED_REGION) & (weight > 0)
    if (clear := chosen & sure).any():
        dense = chosen & (level == DOUBTFUL) & (score >= ratios.mean())
        beside = dense & ~inside
        if ARTICLE_SHARE * weight[beside].sum() <= weight[clear].sum():
            dense &= inside
        chosen = clear | dense
    elif (chosen & ~unwanted).any():
        chosen &= ~unwanted
    elif ARTICLE_SHARE * weight[unwanted].sum() > weight[~unwanted].sum():
        chosen = unwanted
    else:
        best = np.where(unwanted, -1.0, score)
        chosen = best >= best.max()
    return [text for (text, *_), ok in zip(lines, may & chosen[regions]) if ok]


def main_text(html: str) -> str:
    return "\n\n".join(content_lines(parse(html))) if html else ""


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """The rows with the main text of their whole page."""
    of = partial(_texts, pages.columns.index(html_col))
    return add_column(pages, free_name(pages, out), T.StringType(), of)


def _texts(at: int, batch: pa.RecordBatch) -> pa.Array:
    return pa.array((main_text(x.as_py() or "") for x in batch.column(at)), pa.string())
