"""Sections of HTML bodies.

Only the reading of markup runs in Python, batch by batch through Arrow; matching, joining and
picking links are Spark expressions over its result.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from noticeworks.functions.text import blank_to_null, col

SECTIONS = ArrayType(
    StructType(
        [
            StructField("id", StringType()),
            StructField("text", StringType()),
            StructField("hrefs", ArrayType(StringType())),
        ]
    )
)

# Ship this module with the function, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# HTML elements that never have content.
_VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
_NO_TEXT = frozenset(("script", "style", "template"))


@dataclass(slots=True)
class _Part:
    """A paragraph, list or list item: where it begins and ends in what was read so far."""

    tag: str
    texts: tuple[int, int]
    hrefs: tuple[int, int]
    items: tuple[int, int]
    hidden: int  # unshown elements around it

    def end(self, at: _Reader) -> None:
        self.texts = (self.texts[0], len(at.texts))
        self.hrefs = (self.hrefs[0], len(at.hrefs))
        self.items = (self.items[0], len(at.items))


@dataclass(slots=True)
class _Open:
    tag: str
    part: _Part | None
    section: list[_Part] | None = None  # of the last heading right in this element


class _Reader(HTMLParser):
    """One pass over nested elements exactly as written: nothing is closed that the markup leaves open.

    Every text, link and list item is kept once, in order; a part knows from where to where it reaches. So what nests as
    deep as a page is long, or is closed without having been opened, takes no more time than anything else.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[tuple[str, int]] = []  # with the unshown elements around each
        self.hrefs: list[str] = []
        self.items: list[_Part] = []
        self.sections: dict[str, list[_Part]] = {}
        self.open = [_Open("", None)]
        self.times: Counter[str] = Counter()  # how often each tag is open
        self.hidden = 0

    def _begin(self, tag: str, attrs: list[tuple[str, str | None]]) -> _Open:
        above, given = self.open[-1], dict(attrs)
        if tag in ("h2", "h3"):
            above.section = None
            if tag == "h3" and given.get("id"):
                above.section = self.sections[given["id"]] = []  # of an id used again, the place stays and the content goes
        elif tag == "a" and "href" in given:
            self.hrefs.append(given["href"] or "")
        part = None
        if tag == "li" or tag in ("p", "ul") and above.section is not None:
            here = (len(self.texts),) * 2, (len(self.hrefs),) * 2, (len(self.items),) * 2
            part = _Part(tag, *here, self.hidden)
            (self.items if tag == "li" else above.section).append(part)
        return _Open(tag, part)

    def handle_starttag(self, tag, attrs):
        begun = self._begin(tag, attrs)
        if tag not in _VOID:
            self.open.append(begun)
            self.times[tag] += 1
            self.hidden += tag in _NO_TEXT

    def handle_startendtag(self, tag, attrs):
        self._begin(tag, attrs)

    def handle_endtag(self, tag):
        while self.times[tag]:
            if self._end_last() == tag:
                return

    def _end_last(self) -> str:
        last = self.open.pop()
        self.times[last.tag] -= 1
        self.hidden -= last.tag in _NO_TEXT
        if last.part:
            last.part.end(self)
        return last.tag

    def handle_data(self, data):
        if data.strip():
            self.texts.append((data.strip(), self.hidden))

    def close(self):
        super().close()
        while len(self.open) > 1:
            self._end_last()

    def _text(self, part: _Part, separator: str) -> str:
        return separator.join(t for t, hidden in self.texts[slice(*part.texts)] if hidden == part.hidden)

    def section(self, parts: list[_Part]) -> dict:
        texts, hrefs = [], []
        for p in parts:
            if p.tag == "p":
                texts.append(self._text(p, " "))
                hrefs += self.hrefs[slice(*p.hrefs)]
            else:
                texts.append(", ".join(self._text(i, "") for i in self.items[slice(*p.items)]))
        return {"text": " ".join(texts).strip(), "hrefs": hrefs}


def read_sections(html: str | None) -> list[dict]:
    """Sections of one body: what stands between an ``h3`` with an id and the next heading beside it.

    Paragraph texts and comma-joined list items make up the text; links come from paragraphs. An id
    used twice keeps its first place and its last content.
    """
    if not html or "<h3" not in html.lower():
        return []
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return [{"id": i, **reader.section(parts)} for i, parts in reader.sections.items()]


@F.pandas_udf(SECTIONS)
def html_sections(bodies: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in bodies:
        yield batch.map(read_sections)


def matching_sections(sections: Column | str, ids: tuple[str, ...]) -> Column:
    """Sections whose id is one of ``ids`` or starts with one of them and a hyphen."""

    def matches(s: Column) -> Column:
        hit = s["id"].isin(*ids)
        for i in ids:
            hit = hit | s["id"].startswith(i + "-")
        return hit

    return F.filter(col(sections), matches)


def section_text(sections: Column | str, ids: tuple[str, ...]) -> Column:
    """Non-empty texts of the matching sections in document order, joined by `` | ``."""
    texts = F.filter(
        F.transform(matching_sections(sections, ids), lambda s: s["text"]), lambda t: t != ""
    )
    return blank_to_null(F.array_join(texts, " | "))


def section_link(sections: Column | str, ids: tuple[str, ...]) -> Column:
    """First link of the matching sections that leads to another site."""
    hrefs = F.flatten(F.transform(matching_sections(sections, ids), lambda s: s["hrefs"]))
    return F.try_element_at(F.filter(hrefs, lambda h: h.startswith("http")), F.lit(1))
