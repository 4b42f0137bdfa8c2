"""P22 / P23. Main text of an HTML page, as an Arrow-batched pandas UDF.

Spark has no HTML parser, so this is the one place where page bodies cross into
Python.  The per-row helper is a small stack machine over the stdlib
``html.parser`` tokenizer (no third-party parser is available):

* subtrees of ``script, style, nav, footer, header`` are dropped, and so is what stands in
  ``template``, ``rt`` and ``rp``;
* the text of the first ``article`` element is taken, else the first ``div``
  whose class list has ``article-text`` or ``content``, else the whole page;
* every text node is stripped and empty ones dropped; nodes are joined with
  ``separator`` ('' by default, so words from adjacent nodes join);
* text is flushed at every tag and comment; an end tag closes the nearest open
  element of that name (and what is open inside it), stray end tags are ignored;
  unclosed elements run to the end of their parent;
* the result is cut to ``limit`` characters inside the task, so long pages never
  travel back to the JVM.

``page_text`` is the whole-page form used as article body when no extraction is
wanted: all visible text (no head, script or style), one line per block element.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dropped subtrees and the fallback container classes.
DROPPED = ("script", "style", "nav", "footer", "header")
# Elements whose strings are no text of the page.
NO_TEXT = ("template", "rt", "rp")
CONTAINER_CLASSES = ("article-text", "content")
VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 "
    "hr li main ol p pre section table tr ul".split())


class _Extractor(HTMLParser):
    """Collects stripped text nodes of the page, the first article, and the first content div."""

    def __init__(self, dropped=DROPPED + NO_TEXT, skip_head=False):
        super().__init__(convert_charrefs=True)
        self.dropped = frozenset(dropped)
        self.skip_head = skip_head
        self.stack: list[list] = []  # [tag, is_dropped, capture_slot]
        self.buf: list[str] = []
        self.page: list[str] = []
        self.slots = {"article": None, "div": None}  # None = not seen, list = collecting/collected
        self.open_slots: set[str] = set()
        self.hidden = 0  # open dropped elements

    def _flush(self):
        if not self.buf:
            return
        text = "".join(self.buf).strip()
        self.buf = []
        if not text or self.hidden:
            return
        self.page.append(text)
        for name in self.open_slots:
            self.slots[name].append(text)

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in BLOCKS:
            self.page.append("\n")
        if tag in VOID:
            return
        slot = None
        if not self.hidden:
            if tag == "article" and self.slots["article"] is None:
                slot = "article"
            elif tag == "div" and self.slots["div"] is None:
                classes = " ".join(v or "" for k, v in attrs if k == "class").split()
                if any(c in CONTAINER_CLASSES for c in classes):
                    slot = "div"
        if slot:
            self.slots[slot] = []
            self.open_slots.add(slot)
        drop = tag in self.dropped or (self.skip_head and tag == "head")
        self.hidden += drop
        self.stack.append([tag, drop, slot])

    def handle_startendtag(self, tag, attrs):
        self._flush()
        if tag in BLOCKS:
            self.page.append("\n")

    def handle_endtag(self, tag):
        self._flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                for _, drop, slot in self.stack[i:]:
                    self.hidden -= drop
                    if slot:
                        self.open_slots.discard(slot)
                del self.stack[i:]
                break
        if tag in BLOCKS:
            self.page.append("\n")

    def handle_data(self, data):
        self.buf.append(data)

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def result(self):
        self._flush()
        return self.page, self.slots


def extract_main_text(html: str | None, limit: int | None = 2000, separator: str = "") -> str | None:
    """Plain-Python main text of one page (the rule stated in the module docstring)."""
    if html is None:
        return None
    p = _Extractor()
    p.feed(html)
    p.close()
    page, slots = p.result()
    if slots["article"] is not None:
        parts = slots["article"]
    elif slots["div"] is not None:
        parts = slots["div"]
    else:
        parts = [t for t in page if t != "\n"]
    text = separator.join(parts)
    return text[:limit] if limit is not None else text


def extract_page_text(html: str | None) -> str | None:
    """Whole-page visible text, one line per block element, blank lines removed."""
    if html is None:
        return None
    p = _Extractor(dropped=("script", "style"), skip_head=True)
    p.feed(html)
    p.close()
    page, _ = p.result()
    lines, cur = [], []
    for t in page + ["\n"]:
        if t == "\n":
            if cur:
                lines.append(" ".join(" ".join(cur).split()))
            cur = []
        else:
            cur.append(t)
    return "\n".join(line for line in lines if line)


def _guarded(fn, html):
    """One unparsable page gives null, not a failed job."""
    try:
        return fn(html)
    except Exception:  # noqa: BLE001
        return None


def main_text(c, limit: int | None = 2000, separator: str = "") -> Column:
    """P22 as a Column: ``pandas_udf`` over Arrow batches of pages."""

    @F.pandas_udf(T.StringType())
    def _main_text(s: pd.Series) -> pd.Series:
        return s.map(lambda h: _guarded(lambda x: extract_main_text(x, limit, separator), h))

    return _main_text(F.col(c) if isinstance(c, str) else c)


def page_text(c) -> Column:
    """P23 as a Column."""

    @F.pandas_udf(T.StringType())
    def _page_text(s: pd.Series) -> pd.Series:
        return s.map(lambda h: _guarded(extract_page_text, h))

    return _page_text(F.col(c) if isinstance(c, str) else c)
