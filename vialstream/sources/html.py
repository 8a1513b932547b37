"""Safety-change pages and plain page text, with the standard library's tolerant parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"p", "div", "li", "tr", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "br", "section", "article"}
# Headings under which a change's text stands.
HEADINGS = {"AE": ("6 Adverse Reactions", "6"), "BOX": ("Boxed Warning", "Boxed Warning")}


def squeeze(s: str) -> str:
    return re.sub(r"[\s ]+", " ", s).strip()


class _Text(HTMLParser):
    """(tag, text) pieces in order: headings as wholes, other text by block."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[tuple[str, str]] = []
        self.buffer: list[str] = []
        self.heading = ""
        self.skip = 0

    def cut(self, tag: str = "") -> None:
        if text := squeeze("".join(self.buffer)):
            self.pieces.append((self.heading, text))
        self.buffer = []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag in _BLOCK:
            self.cut()
            if re.fullmatch("h[1-6]", tag):
                self.heading = tag
        elif tag in ("td", "th"):
            self.buffer.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in _BLOCK:
            self.cut()
            if tag == self.heading:
                self.heading = ""

    def handle_data(self, data):
        if not self.skip:
            self.buffer.append(data)


def pieces(html: str | None) -> list[tuple[str, str]]:
    p = _Text()
    p.feed(html or "")
    p.close()
    p.cut()
    return p.pieces


def page_text(html: str | None) -> str:
    return "\n".join(t for _, t in pieces(html))


def change_sections(html: str | None) -> list[dict]:
    """(date, section, text): h3 dates, and under each the text below the section's h4 up to another section's h4.

    A later entry of a date takes the place of an earlier one.
    """
    out: dict[tuple[str, str], list[str]] = {}
    date, section = None, None
    for tag, text in pieces(html):
        if tag == "h3" and re.fullmatch(r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", text):
            date, section = text, None
            for s in HEADINGS:
                out.pop((date, s), None)
        elif tag == "h4":
            section = next((s for s, (exact, lead) in HEADINGS.items() if text == exact or (section == s and text.startswith(lead))), None)
        elif date and section:
            out.setdefault((date, section), []).append(text)
    return [{"date": d, "section": s, "text": " ".join(t)} for (d, s), t in out.items()]


CHANGES = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("date", "section", "text")]))


def change_rows(html: Column) -> Column:
    @F.pandas_udf(CHANGES)
    def rows(h: pd.Series) -> pd.Series:
        return h.map(change_sections)

    return rows(html)


def text_of(html: Column) -> Column:
    @F.pandas_udf(T.StringType())
    def texts(h: pd.Series) -> pd.Series:
        return h.map(page_text)

    return texts(html)
