"""Main text of HTML pages from parser events and text-to-tag ratios.

The standard library's parser streams events into lines: one line per block
element, with its text, the number of tags seen since the last line, the
landmark (``article`` or ``main``) and the container it stands in, and whether an
ancestor marks it as boilerplate (menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts, styles, hidden parts).  Words in class and id
say nothing on headings and articles or after a word like ``has`` or ``no``; an
element that only such a word or the tag ``form`` marks is a wrapper and stays when it holds most
of the page's text, unless the page's main heading or landmark stands outside it.

Each line's text-to-tag ratio is smoothed with a Gaussian over its
neighbours; lines above the threshold (the smaller of mean and standard
deviation of the smoothed ratios) form the content clusters.  A cluster selects its region: its
landmark where it stands in one, else its container, so that short paragraphs
and headings inside the region stay; where landmarks hold most of the clusters' text,
only they are selected.  All lines of selected regions are kept whole, in page order.

Defined results: a null or empty page, or one without text outside
boilerplate, gives an empty text; repeated rows give repeated results; an
empty table gives an empty table; other columns pass through, columns named
like the results are replaced.  Work is per row, in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

# Element kinds and the words that mark boilerplate in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot "
    "thead title tr ul".split())
SPACED = frozenset("br td th img wbr".split())
DROPPED = frozenset(
    "head script style noscript template nav footer aside button select textarea iframe object svg canvas audio video map menu dialog "
    "search math title".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
CONTAINERS = frozenset("body div section td article main blockquote center html".split())
LANDMARKS = frozenset(["article", "main"])
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}}
MARKS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr login masthead menu modal nav navbar navigation navi newsletter notice notices notification overlay pager "
    "pagination paywall popup promo promoted promotion recommended related reply replies respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe subscription teaser toolbar topbar widget widgets".split())
# Words before a mark that make it a word about the layout, and tags on which marks say nothing.
LAYOUT = frozenset("has have is no non not show with without".split())
UNMARKED = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
HARD, SOFT = 1, 2  # boilerplate in any case; boilerplate unless it is a wrapper
MOST = 0.6  # share of the page's text that makes a softly marked element a wrapper
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_TOKEN = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z0-9]+")
SIGMA = 1.0


def _has_mark(value: str) -> bool:
    """Whether a class or id has a word of ``MARKS`` that is not about the layout."""
    for name in value.split():
        words = [t.lower() for t in _TOKEN.findall(name)]
        if not MARKS.isdisjoint(words) and LAYOUT.isdisjoint(words[:next(i for i, w in enumerate(words) if w in MARKS)]):
            return True
    return False


class _Lines(HTMLParser):
    """Parser events to lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, landmark (0 none), container
        self._raw: list[tuple[list[tuple[int, str]], int, int, int]] = []  # lines with the soft mark (0 none) of every part
        self._outer = [0]  # per soft mark the one around it
        self._anchors: list[tuple[str, int]] = []  # tag and soft mark of main headings and landmarks
        self._stack: list[tuple[str, bool, int, int, int]] = []  # tag, dropped, landmark, container, soft mark
        self._open: dict[str, int] = {}
        self._parts: list[tuple[int, str]] = []
        self._tags = 0
        self._ids = 0
        self._dropped, self._landmark, self._container, self._soft = False, 0, 0, 0

    def _flush(self) -> None:
        if self._parts:
            self._raw.append((self._parts, self._tags, self._landmark, self._container))
            self._parts = []
            self._tags = 0

    def _marked(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag in DROPPED or tag == "header" and not self._landmark:
            return HARD
        mark = SOFT if tag == "form" else 0
        for name, value in attrs:
            if name in ("class", "id"):
                if value and tag not in UNMARKED and _has_mark(value):
                    mark = SOFT
            elif name == "role":
                if (value or "").strip().lower() in ROLES:
                    return HARD
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                return HARD
            elif name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return HARD
        return mark

    def _wrappers(self) -> list[bool]:
        """Per soft mark whether its element is a wrapper, as are all marked ones around it; 0 is."""
        chars = [0] * len(self._outer)
        for parts, *_ in self._raw:
            for soft, text in parts:
                chars[soft] += sum(map(len, text.split()))
        within = [[] for _ in self._outer]
        for tag, soft in self._anchors:
            within[soft].append(tag)
        for soft in range(len(self._outer) - 1, 0, -1):
            chars[self._outer[soft]] += chars[soft]
            within[self._outer[soft]] += within[soft]
        out = [True]
        for soft in range(1, len(self._outer)):
            own = "h1" in within[soft] or "main" in within[soft]
            out.append(out[self._outer[soft]] and chars[soft] > MOST * chars[0] and (own or len(within[soft]) == len(within[0])))
        return out

    def _close(self, at: int) -> None:
        """Close the element at this depth and all above it."""
        for tag, *_ in self._stack[at:]:
            self._open[tag] -= 1
        del self._stack[at:]
        self._dropped, self._landmark, self._container, self._soft = self._stack[-1][1:] if self._stack else (False, 0, 0, 0)

    def _close_open(self, tags: set[str], within: frozenset[str]) -> None:
        """Close the nearest open element of these tags that is not outside one of ``within``."""
        if any(self._open.get(t) for t in tags):
            for at in range(len(self._stack) - 1, -1, -1):
                if self._stack[at][0] in tags:
                    self._close(at)
                    return
                if self._stack[at][0] in within:
                    return

    def _close_head(self) -> None:
        """A head whose end tag is left out ends where the body begins."""
        self._close(next(at for at, one in enumerate(self._stack) if one[0] == "head"))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if self._open.get("head") and (tag == "body" or tag not in IN_HEAD and self._stack[-1][0] == "head"):
            self._close_head()
        if tag in BLOCKS:
            self._flush()
            self._close_open({"p"}, CONTAINERS)
        elif tag in SPACED and self._parts:
            self._parts.append((0, " "))
        if tag in CLOSED_BY:
            self._close_open(CLOSED_BY[tag], frozenset(["ul", "ol", "dl", "table", "select"]))
        if tag in VOID:
            return
        mark = 0 if self._dropped else self._marked(tag, attrs)
        dropped = self._dropped or mark == HARD
        landmark, container, soft = self._landmark, self._container, self._soft
        if mark == SOFT:
            self._outer.append(soft)
            soft = len(self._outer) - 1
        if not dropped and (tag == "h1" or tag in LANDMARKS):
            self._anchors.append((tag, soft))
        if tag in CONTAINERS:
            self._ids += 1
            container = self._ids
            if tag in LANDMARKS and not (landmark and tag == "main"):
                landmark = self._ids
        self._stack.append((tag, dropped, landmark, container, soft))
        self._open[tag] = self._open.get(tag, 0) + 1
        self._dropped, self._landmark, self._container, self._soft = dropped, landmark, container, soft

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:  # outside foreign content the slash means nothing
            self.handle_starttag(tag, attrs)
            if self._open.get("svg") or self._open.get("math"):
                self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag in BLOCKS:
            self._flush()
        if self._open.get(tag):
            for at in range(len(self._stack) - 1, -1, -1):
                if self._stack[at][0] == tag:
                    self._close(at)
                    break

    def handle_data(self, data: str) -> None:
        if self._dropped and self._stack[-1][0] == "head" and data.strip():
            self._close_head()
        if not self._dropped:
            self._parts.append((self._soft, data))

    def close(self) -> None:
        super().close()
        self._flush()
        stays, seen = self._wrappers(), 0
        for parts, tags, landmark, container in self._raw:
            seen += tags
            text = " ".join("".join(text for soft, text in parts if stays[soft]).split())
            if text:
                self.lines.append((text, seen, landmark, container))
                seen = 0


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing with a window of three deviations, renormalised at the ends."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    inside = np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach:reach + len(ratios)] / inside


def main_text(html: str | None) -> str:
    """The page's main text, one line per block."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    ratios = smooth(np.array([len(text) / max(tags, 1) for text, tags, _, _ in lines]))
    content = ratios >= min(ratios.mean(), max(ratios.std(), 1e-9))
    found = [line for line, yes in zip(lines, content) if yes]
    inside = sum(len(text) for text, _, landmark, _ in found if landmark)
    if 2 * inside > sum(len(text) for text, *_ in found):
        found = [line for line in found if line[2]]
    chosen = {line[2] or line[3] for line in found}  # landmarks are containers too: one numbering
    return "\n".join(line[0] for line in lines if (line[2] or line[3]) in chosen)


def with_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with all its columns plus the main text and ``n_chars``, its code points."""
    pages = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in (text_col, "n_chars") or c == html_col])
    keep = [c for c in pages.columns if c != text_col]
    schema = pages.select(*keep, F.lit("").cast("string").alias(text_col), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(t) for t in texts(batch.column(batch.schema.get_field_index(html_col)))]
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], [*keep, text_col, "n_chars"])

    return pages.mapInArrow(run, schema)


def html_digest(pages: DataFrame) -> DataFrame:
    """The contract's columns."""
    return with_main_text(pages.select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
