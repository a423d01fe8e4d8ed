"""The elements of a page as flat rows, from one forward pass over its tokens.

Which elements lie inside which cannot be told by a pattern, so the tokens go through
Python once, in batches. What comes back is no tree: one row per element, in the order in
which they begin, with its place and how many elements lie inside it. As an element ends
all that began inside it, those are the rows that follow it, a slice; all selecting is
left to column expressions.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ROWS = (
    "array<struct<at int, size int, first int, last int, tag string, classes string, id string, href string, image string, gauge string,"
    " text string, spaced string>>"
)
# Tags that never hold anything, and those whose content is no text.
EMPTY_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset(("script", "style"))
# Elements that can be a label or a value. Only their text is sent on, not that of every holder above them.
TEXT_TAGS = frozenset(("p", "span", "h2", "h3"))
LABEL_CLASSES = re.compile(r"(?i)name|title|status|badge|stock|price|type|key|label|data|value|content")
ANY_CLASS = re.compile(r".")


class _Pass(HTMLParser):
    """Keeps the open elements as a stack; each is its row and the number of texts before it."""

    def __init__(self, text_of: re.Pattern) -> None:
        super().__init__(convert_charrefs=True)
        self.text_of = text_of
        self.token = 0
        self.open_tags: Counter = Counter()
        self.rows: list[dict] = []
        self.open: list[tuple[str, dict, int]] = []
        self.texts: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.token += 1
        given = {k: v or "" for k, v in reversed(attrs)}
        row = {
            "at": len(self.rows), "size": 0, "first": self.token, "last": self.token, "tag": tag, "classes": given.get("class", ""), "id": given.get("id", ""),
            "href": given.get("href", ""), "image": given.get("data-src") or given.get("src", ""),
            "gauge": given.get("data-text", ""), "text": "", "spaced": "",
        }
        self.rows.append(row)
        if tag not in EMPTY_TAGS:
            self.open.append((tag, row, len(self.texts)))
            self.open_tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY_TAGS:
            self._shut(len(self.open) - 1)

    def handle_endtag(self, tag):
        if self.open_tags[tag]:
            self._shut(next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag))

    def handle_data(self, data):
        if data.strip() and not (self.open and self.open[-1][0] in NO_TEXT):
            self.texts.append(data.strip())

    def _shut(self, at: int) -> None:
        """Ends the open elements from number ``at`` on."""
        self.token += 1
        for tag, row, before in self.open[at:]:
            self.open_tags[tag] -= 1
            row["last"], row["size"] = self.token, len(self.rows) - 1 - row["at"]
            if tag in TEXT_TAGS or self.text_of.search(row["classes"]):
                row["text"], row["spaced"] = "".join(self.texts[before:]), " ".join(self.texts[before:])
        del self.open[at:]


def outline(html: str | None, text_of: re.Pattern = ANY_CLASS) -> list[dict]:
    """Rows of one page in document order; a page that ends early ends its open elements.

    Text is kept of paragraphs, spans, headings and of elements whose classes match ``text_of``.
    """
    if not html:
        return []
    one = _Pass(text_of)
    one.feed(html)
    one.close()
    one._shut(0)
    return one.rows


#: Characters of pages whose rows are held at once; a longer page is held alone.
OUTLINED_AT_ONCE = 1 << 20


def _runs(pages: pd.Series) -> Iterator[pd.Series]:
    """The pages of a batch in runs of about ``OUTLINED_AT_ONCE`` characters."""
    first, held = 0, 0
    for i, html in enumerate(pages):
        held += len(html or "")
        if held >= OUTLINED_AT_ONCE:
            yield pages.iloc[first : i + 1]
            first, held = i + 1, 0
    if first < len(pages):
        yield pages.iloc[first:]


def _outlines(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Rows are many times as large as the page they come from, so they leave in runs and not by batch."""
    for pages in batches:
        for run in _runs(pages):
            yield run.map(lambda html: outline(html, LABEL_CLASSES))


def elements(html: Column, pattern: str) -> Column:
    """The elements of pages whose text matches a pattern; NULL pages and others have none.

    Declared non-deterministic, so that Spark copies it into no filter and reads a page once.
    """
    rows = F.pandas_udf(_outlines, ROWS)  # type hints make it an iterator UDF: one pass per batch
    return rows.asNondeterministic()(F.when(html.rlike(pattern), html))
