"""Main text of raw HTML pages, by text-to-tag ratios of the lines of a page.

The standard library's streaming parser is fed with one tag or one run of text at a time and
turns a page into lines, one per block, each with its characters, tags and enclosing elements.  Menus, notices, adverts, forms, comments and
the like are left out by element, role or class.  The text-to-tag ratio of the remaining
lines is smoothed with a Gaussian; lines over the standard deviation cluster into content
regions, and the elements around these are the article.  Short lines of the article have
low ratios, so all its lines are kept, not only those over the threshold.

Memory and time of a page grow with its length alone, however bad its markup: the ends of
tags are found before the parser sees them.  A tag with a quote that is never closed ends at
the next `>`, and so do all tags after it; a comment, script, style or tag that never ends
takes the rest of the page.  A `<` in front of no name is text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweft.llm import words as W
from linkweft.llm.frames import without

# Lines on each side that smooth a line, and the spread of their weights.
RADIUS, SPREAD = 3, 1.5

# An element left out by name is a layout if it holds this share of the content's characters.
MOST = 0.8

# Lines are links if these hold this share of the characters.
LINKED = 0.8

# Elements and names of HTML (fixed values).
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form head header iframe input label "
    "legend menu nav noembed noframes noscript object optgroup option script select style svg template textarea "
    "title video".split()
)
ARTICLES = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEFT_OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
LEFT_OUT_NAMES = frozenset(
    "ad ads advert advertisement advertising advertorial adsense alert aside banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies copyright disclaimer disqus dropdown foot footer gdpr header login "
    "masthead menu modal nav navbar navigation newsletter notice notification outbrain overlay pager pagination popup "
    "promo promoted promotion recommended related replies reply respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription taboola teaser toolbar topbar widget widgets".split()
)
# Words that say nothing of what an element holds: a name made of one above and these is left
# out, as in ad-label or site-footer, but not share-price or related-work.
PLAIN_NAMES = frozenset(
    "area article articles bar block body bottom box button buttons card cards col column container content desktop details "
    "entry feed form global group heading icon icons inner item items label left link links list main media message "
    "mobile more outer page panel popular post posts primary right row secondary section site slot stories story text thread "
    "title top unit wrap wrapper".split()
)
# Those that end a name of any other words, too, as in x-footer.
LAST_NAMES = frozenset(
    "ads advertisement breadcrumb breadcrumbs comments footer nav navbar navigation newsletter pagination popup sidebar sponsored".split()
)
# Those which an article inside does not undo: it is a comment or a teaser then.
KEPT_OUT = frozenset("aside comment comments disqus related recommended replies respond sidebar".split())
CLOSED_BY = {
    "p": BLOCKS,
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "tbody", "tfoot")),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
    "option": frozenset(("option",)),
}
MODIFIERS = frozenset("has hide is no not show with without".split())
RESULTS = frozenset(("result", "results"))
_NAME = re.compile(r"[a-z]+")

# A tag: its name, then attributes with quoted or bare values; none of its parts is tried twice.
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)(?:[\s/]++|[^\s/>=]++|=++\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))*+>""")
_MARKUP = re.compile(r"<(?=[a-zA-Z!?/])")
_RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in ("script", "style")}


def markup(html: str) -> Iterator[str]:
    """The tags and the runs of text of a page, one by one, in one pass; comments and the like are left out."""
    at, end, quotes = 0, len(html), True
    while found := _MARKUP.search(html, at):
        start = found.start()
        if start > at:
            yield html[at:start]
        mark = html[start + 1]
        if mark in "!?" or (mark == "/" and not html[start + 2 : start + 3].isalpha()):
            comment = html.startswith("<!--", start) and not html.startswith(("<!-->", "<!--->"), start)
            close = html.find("-->" if comment else ">", start + 4 if comment else start)
            if close < 0:
                return
            at = close + (3 if comment else 1)
            continue
        tag = _TAG.match(html, start) if quotes else None
        if tag:
            at, text, name = tag.end(), tag[0], tag[1].lower()
        else:
            quotes = False
            at = html.find(">", start) + 1
            if not at:
                return
            text = html[start:at].replace('"', " ").replace("'", " ")
            name = re.split(r"[\s/>]", text[1:], maxsplit=1)[0].lower()
        yield text
        if name in _RAW and mark != "/":
            close = _RAW[name].search(html, at)
            at = close.start() if close else end
    if at < end:
        yield html[at:]


class PageLines(HTMLParser):
    """Lines of a page: text, tags, characters in links, and the element around."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []
        self.parents, self.names = [-1], [""]
        # Elements left out by a name alone, and whether an article inside does not undo that.
        self.named: dict[int, bool] = {}
        # Open elements: name, number, whether left out, and whether an article cannot undo that.
        self.open: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]
        self.count: Counter[str] = Counter()
        self.parts: list[str] = []
        self.tags = self.links = self.linked = 0

    def read(self, html: str) -> PageLines:
        """Parse a whole page; each piece is finished before the next one comes."""
        for piece in markup(html):
            self.feed(piece)
            self.close()
        self.flush()
        return self

    def handle_starttag(self, tag: str, attrs: list) -> None:
        block = tag in BLOCKS
        if block:
            self.flush()
            while tag in CLOSED_BY.get(self.open[-1][0], ()):
                self.pop()
        self.tags += 1
        if tag == "br":
            self.parts.append("\n")
        self.links += tag == "a"
        if tag in VOID:
            return
        _, _, out, firm = self.open[-1]
        own, own_firm = self.left_out(tag, attrs)
        by_name, name_firm = (False, False) if own else self.left_out_name(tag, attrs)
        if by_name and not block:
            own, own_firm = True, name_firm
        if tag in ARTICLES and not own and not by_name:
            out = firm
        if block or (own and not out):
            self.parents.append(self.open[-1][1])
            self.names.append(tag)
            if by_name and block:
                self.named[len(self.parents) - 1] = name_firm
            self.open.append((tag, len(self.parents) - 1, out or own, firm or own_firm))
            self.count[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        if self.count[tag]:
            while self.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self.open[-1][2]:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data)

    def pop(self) -> str:
        tag = self.open.pop()[0]
        self.count[tag] -= 1
        if tag in BLOCKS:
            self.links = 0
        return tag

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            self.lines.append((text, max(1, self.tags), self.linked, self.open[-1][1]))
            self.tags = self.linked = 0

    def left_out(self, tag: str, attrs: list) -> tuple[bool, bool]:
        """Whether an element is no content, and whether that holds for articles inside, too."""
        if tag in ("html", "body"):
            return False, False
        inside_article = any(self.count[a] for a in ARTICLES)
        if tag in LEFT_OUT and not (tag == "header" and inside_article):
            return True, tag in KEPT_OUT
        for key, value in attrs:
            if key == "role" and (value or "").lower() in LEFT_OUT_ROLES:
                return True, False
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                return True, True
            if key == "style" and "display:none" in (value or "").replace(" ", "").lower():
                return True, True
        return False, False

    def left_out_name(self, tag: str, attrs: list) -> tuple[bool, bool]:
        """Whether class or id name an element no content, and whether that holds for articles inside, too."""
        if tag in ("html", "body"):
            return False, False
        out = firm = False
        for token in [t for key, value in attrs if key in ("class", "id") for t in (value or "").lower().split()]:
            runs = _NAME.findall(token)
            if not runs or runs[0] in MODIFIERS or (len(runs) > 1 and runs[-1] in RESULTS):
                continue
            names = [run for run in runs if run in LEFT_OUT_NAMES]
            # article-header and page-header may hold the article's own
            if names == ["header"] and (runs[0] != "header" or any(self.count[a] for a in ARTICLES)):
                continue
            if runs[-1] in LAST_NAMES or (names and all(run in LEFT_OUT_NAMES or run in PLAIN_NAMES for run in runs)):
                out, firm = True, firm or runs[0] in KEPT_OUT or runs[-1] == "comments"
        return out, firm


def smoothed(ratio: np.ndarray) -> np.ndarray:
    """Gaussian mean of each value and its neighbours; the ends have fewer neighbours."""
    weight = np.exp(-(np.arange(-RADIUS, RADIUS + 1) ** 2) / (2 * SPREAD**2))
    middle = slice(RADIUS, RADIUS + len(ratio))
    return np.convolve(ratio, weight)[middle] / np.convolve(np.ones(len(ratio)), weight)[middle]


def main_text(html: str | None) -> str:
    """The article's blocks, joined by newlines; empty for a page without any text."""
    page = PageLines().read(html or "")
    lines = _remaining(page)
    if not lines:
        return ""
    content, held = _clusters(page, lines)
    inside, articles = _article(page, lines, content, held)
    kept = [k for k, line in enumerate(lines) if inside[line[3]] or (articles.any() and page.names[line[3]] == "h1" and not _links(line))]
    # lines of links before or after all content are menus, unless they are in clusters themselves
    text_at = [k for k in kept if articles[lines[k][3]] or (content[k] and not _links(lines[k]))]
    if not text_at:
        return "\n".join(lines[k][0] for k in kept if not _links(lines[k]))
    first, last = text_at[0], text_at[-1]
    gone: set[int] = set()
    run: list[int] = []
    for k in [*kept, None]:
        if k is not None and _links(lines[k]) and not articles[lines[k][3]]:
            run.append(k)
            continue
        if run and not first < run[0] < last and 2 * sum(content[j] for j in run) <= len(run):
            gone.update(run)
        run = []
    return "\n".join(lines[k][0] for k in kept if k not in gone)


def _links(line: tuple[str, int, int, int]) -> bool:
    return line[2] >= LINKED * len(line[0])


def _clusters(page: PageLines, lines: list) -> tuple[np.ndarray, np.ndarray]:
    """Which lines are content by their smoothed ratio, and the characters of these in each element."""
    ratio = smoothed(np.array([len(text) / tags for text, tags, _, _ in lines]))
    content = ratio >= min(ratio.std(), ratio.max())
    held = np.zeros(len(page.parents))
    for (text, _, linked, element), chosen in zip(lines, content):
        if chosen:
            held[element] += max(1, len(text) - linked)
    for element in range(len(held) - 1, 0, -1):
        held[page.parents[element]] += held[element]
    return content, held


def _remaining(page: PageLines) -> list:
    """The lines outside elements left out by name; one that holds most of the content is a layout, not left out."""
    if not page.named or not page.lines:
        return page.lines
    _, held = _clusters(page, page.lines)
    loose = {k for k, firm in page.named.items() if not firm}
    layouts = {k for k in loose if held[k] >= MOST * held[0]}
    for taken_back in (layouts, loose, set(page.named)):
        # 1: left out, unless an article is inside; 2: left out with all that is inside
        out = np.zeros(len(page.parents), dtype=np.int8)
        for k in range(1, len(out)):
            out[k] = out[page.parents[k]]
            if k in page.named and k not in taken_back:
                out[k] = max(out[k], 1 + page.named[k])
            elif page.names[k] in ARTICLES and out[k] == 1:
                out[k] = 0
        lines, before = [], 0
        for text, tags, linked, element in page.lines:
            if out[element]:
                before += tags
            else:
                lines.append((text, tags + before, linked, element))
                before = 0
        if lines:
            break
    return lines


def _article(page: PageLines, lines: list, content: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Elements in what holds the content, and those in articles by name.

    All outermost articles by name that hold content; or else the least element around all
    content and headings, links apart.
    """
    n = len(held)
    inside, articles = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    for k in range(1, n):
        named = page.names[k] in ARTICLES and held[k] > 0
        inside[k] = inside[page.parents[k]] or named
        articles[k] = articles[page.parents[k]] or (named and page.names[k] == "article")
    if inside.any():
        # main without an article is the article
        return inside, articles if articles.any() else inside
    wanted = np.zeros(n, dtype=np.int64)
    for line, chosen in zip(lines, content):
        if not _links(line) and (chosen or page.names[line[3]] in HEADINGS):
            wanted[line[3]] += 1
    for k in range(n - 1, 0, -1):
        wanted[page.parents[k]] += wanted[k]
    around = max(np.flatnonzero(wanted == wanted[0])) if wanted[0] else 0
    inside[around] = True
    for k in range(around + 1, n):
        inside[k] = inside[page.parents[k]]
    return inside, articles


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the main text of each whole page in `out` instead of its html.

    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined by a newline.  A null or empty page, and one of links alone, gives an empty text.  Input columns
    named like `out` are replaced; equal pages give equal texts.
    """
    kept = without(pages, [out, html_col])
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), F.col(f"`{html_col}`").cast("string").alias("html"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "html"):
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return rows.mapInArrow(made, f"row {kept.schema.simpleString()}, text string").select("row.*", F.col("text").alias(out))
