"""Main text of web pages by tag-path ratios.

Every run of text has a root-to-leaf tag path. Per path, text length and
punctuation are divided by the number of runs; the two ratios are smoothed over
the page, fused and thresholded. What passes names the element that holds the
article, and the article is that element's blocks less boilerplate. A map over
rows; nothing is shuffled.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose content is no page text, those that have no content, those that are boilerplate, and those that
# begin and end a block (fixed values).
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "select", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "head", "label", "fieldset"}
BLOCK = set(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr
    ul""".split()
)
# Parts of class names, ids and roles that mark boilerplate (fixed values).
HINTS = set(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie
    cookies dialog discussion disqus footer form header menu menubar masthead modal nav navbar navigation newsletter
    notice notices notification overlay pager pagination popup promo promoted promotion related reply replies response
    responses respond share sharing sidebar sidenav signup social sponsor sponsored subscribe toolbar topbar widget
    contentinfo complementary search alert alertdialog""".split()
)
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
    "tfoot": {"tr", "td", "th", "thead", "tbody"},
}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


@dataclass
class Settings:
    """Width of the smoothing in text runs, the punctuation's weight, and the threshold in standard deviations."""

    width: float = 1.0
    punctuation: float = 10.0
    threshold: float = 0.5


@dataclass(eq=False)
class Element:
    tag: str
    parent: "Element | None"
    junk: bool
    path: str
    depth: int


@dataclass
class Block:
    element: Element
    path: str
    parts: list[str] = field(default_factory=list)

    @property
    def text(self) -> str:
        return _SPACE.sub(" ", "".join(self.parts)).strip()


def _junk(tag: str, attributes: str) -> bool:
    if tag in BOILERPLATE:
        return True
    for name, value in _NAMES.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif any(word.lower() in HINTS for word in _WORDS.findall(value)):
            return tag not in ("html", "body", "article", "main")
    return False


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order, each with its innermost element; boilerplate elements are marked.

    End tags that may be left out are implied, stray ones ignored. An unclosed
    inline element ends with its block. A line break is white space.
    """
    root = Element("", None, False, "", 0)
    here, out = root, []
    block: Block | None = None

    def add(text: str) -> None:
        nonlocal block
        if block is None:
            if not text.strip():
                return
            block = Block(here, here.path)
            out.append(block)
        block.parts.append(text)

    def close_to(element: Element) -> None:
        nonlocal here, block
        here, block = element, None

    def open_ancestor(tags: set[str], stop: set[str]) -> Element | None:
        at = here
        while at.parent is not None and at.tag not in stop:
            if at.tag in tags:
                return at
            at = at.parent
        return None

    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            start = n
        if start > at:
            add(html.unescape(page[at:start]))
        if start == n:
            break
        m = _MARK.match(page, start)
        if not m:
            add("<")
            at = start + 1
            continue
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        attributes = m[3] or m[6] or ""
        if m[1] or m[4]:
            found = open_ancestor({tag}, set())
            if found is None:
                if tag == "br":
                    add(" ")
            elif tag in BLOCK:
                close_to(found.parent)
            else:
                # An inline end tag does not reach out of its block.
                inner = here
                while inner is not found and inner.tag not in BLOCK:
                    inner = inner.parent
                if inner is found:
                    here = found.parent
            continue
        if tag in VOID:
            if tag == "hr":
                block = None
            elif tag in ("br", "wbr"):
                add(" " if tag == "br" else "")
            continue
        if tag in RAW and not attributes.rstrip().endswith("/"):
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = n if close is None else page.find(">", close.end() - 1) + 1 or n
            continue
        if tag in BLOCK:
            paragraph = open_ancestor({"p"}, BLOCK - {"p"})
            if paragraph is not None:
                close_to(paragraph.parent)
            while here.parent is not None and here.tag not in BLOCK:
                here = here.parent
            if tag in _CLOSES:
                found = open_ancestor(_CLOSES[tag], _SCOPES.get(tag, {"table"}))
                if found is not None:
                    close_to(found.parent)
            block = None
        elif block is not None and not out:
            block = None
        here = Element(tag, here, here.junk or _junk(tag, attributes), f"{here.path}/{tag}", here.depth + 1)
        if attributes.rstrip().endswith("/") and tag not in BLOCK:
            here = here.parent
    return [b for b in out if b.text]


def scores(found: list[Block], settings: Settings) -> np.ndarray:
    """The fused, smoothed ratio of each block's path: characters and punctuation per run on the path."""
    chars, marks, runs = defaultdict(int), defaultdict(int), defaultdict(int)
    for b in found:
        text = b.text
        chars[b.path] += len(text)
        marks[b.path] += len(_PUNCTUATION.findall(text))
        runs[b.path] += 1
    raw = np.array([(chars[b.path] + settings.punctuation * marks[b.path]) / runs[b.path] for b in found], float)
    reach = max(1, math.ceil(2 * settings.width))
    kernel = np.exp(-((np.arange(-reach, reach + 1) / settings.width) ** 2) / 2)
    # Blocks at an edge are smoothed over those that are there.
    weight = np.convolve(np.ones_like(raw), kernel)[reach : reach + len(raw)]
    return np.convolve(raw, kernel)[reach : reach + len(raw)] / weight


def _inside(element: Element | None, holder: Element) -> bool:
    while element is not None and element.depth >= holder.depth:
        if element is holder:
            return True
        element = element.parent
    return False


def main_text(page: str, settings: Settings = Settings()) -> str:
    """The article's blocks, joined by blank lines; empty if there is none.

    Blocks in boilerplate elements never count. The holder is the lowest element
    with nine tenths of the text that passes the threshold; an ``article`` or
    ``main`` around it is taken whole.
    """
    every = blocks(page)
    found = [b for b in every if not b.element.junk]
    if not found:
        return ""
    score = scores(found, settings)
    bar = settings.threshold * float(score.std())
    passed = [b for b, s in zip(found, score) if s >= bar] or found
    size: dict[Element, int] = defaultdict(int)
    total = 0
    for b in passed:
        n = len(b.text)
        total += n
        at: Element | None = b.element
        while at is not None:
            size[at] += n
            at = at.parent
    holder = max((e for e, n in size.items() if n >= 0.9 * total), key=lambda e: e.depth)
    at = holder
    while at is not None:
        if at.tag in ("article", "main"):
            holder = at
            break
        at = at.parent
    while holder.tag and holder.tag not in ("article", "main", "body", "div", "section", "td", "html"):
        holder = holder.parent
    return "\n\n".join(b.text for b in found if _inside(b.element, holder))


EXTRACTED = "page_id long, url string, text string, n_chars long"


def extract(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages (page_id, url, html)``.

    Null html is empty html, whose text is empty. Repeated rows give repeated
    rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "", settings) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(run, EXTRACTED)
