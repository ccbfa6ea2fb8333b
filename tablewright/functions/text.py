"""Text expressions: passages, prompts, articles and site maps."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.columns import as_col

# fixed values: the prompt text and the passage format
PROMPT = (
    "You are an assistant that answers questions. Use the following pieces of retrieved context to answer "
    "the question. Some pieces of context may be irrelevant, in which case you should not use them to form "
    "the answer.\n\nContext: {context}"
)
PASSAGE = ("Passage: ", "\n")


def format_passages(texts: str | Column) -> Column:
    """All passages in a row, each with its label."""
    head, tail = PASSAGE
    return F.array_join(F.transform(as_col(texts), lambda t: F.concat(F.lit(head), t, F.lit(tail))), "")


def join_passages(texts: str | Column) -> Column:
    return F.array_join(as_col(texts), "\n\n")


def fill_template(template: str, **values: str | Column) -> Column:
    """Replace ``{name}`` by a column. Braces inside the values are left alone."""
    parts, rest = [], template
    while rest:
        found = [(rest.find("{" + name + "}"), name) for name in values]
        found = [(at, name) for at, name in found if at >= 0]
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = min(found)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(as_col(values[name]))
        rest = rest[at + len(name) + 2 :]
    return F.concat(*parts)


def last_content(messages: str | Column) -> Column:
    """Content of the last message, null without messages."""
    return F.try_element_at(as_col(messages), F.lit(-1))["content"]


def word_count(text: str | Column) -> Column:
    """Whitespace-separated words; none in a null."""
    return F.regexp_count(F.coalesce(as_col(text), F.lit("")), F.lit(r"\S+")).cast("long")


def article_markup(html: str | Column, tag: str = "article") -> Column:
    """Markup between the first ``<tag>`` and the next ``</tag>``, null when absent.

    Right for tags that do not nest; use :func:`extract_element` for those that do.
    """
    pattern = rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"
    value = as_col(html)
    return F.when(value.rlike(pattern), F.regexp_extract(value, pattern, 1))


def strip_tags(markup: str | Column) -> Column:
    return F.regexp_replace(as_col(markup), r"<[^>]*>", "")


def sitemap_urls(xml: str | Column) -> Column:
    """Text of every ``loc`` element, in any namespace."""
    return F.xpath(as_col(xml), F.lit("//*[local-name()='loc']/text()"))


class ElementFinder(HTMLParser):
    """Finds where the first element with a given tag and attributes starts and ends."""

    def __init__(self, tag: str, attributes: dict[str, str]):
        super().__init__(convert_charrefs=False)
        self.tag, self.attributes = tag, attributes
        self.depth, self.start, self.end = 0, None, None

    def position(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        if tag != self.tag or self.end is not None:
            return
        if self.start is not None:
            self.depth += 1
        elif self.attributes.items() <= dict(attrs).items():
            self.start, self.depth = self.position(), 1

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if tag == self.tag and self.depth:
            self.depth -= 1
            if not self.depth:
                self.end = self.tag_end()

    def tag_end(self) -> int:
        at = self.position()
        return self.html.index(">", at) + 1

    def find(self, html: str) -> str | None:
        self.html = html
        self.lines = [0]
        for line in html.split("\n"):
            self.lines.append(self.lines[-1] + len(line) + 1)
        self.feed(html)
        self.close()
        if self.start is None:
            return None
        return html[self.start : self.end].strip()


def extract_element(tag: str = "div", attributes: dict[str, str] | None = None):
    """Pandas UDF: markup of the first matching element, nested ones included; null when absent."""
    wanted = {"itemprop": "articleBody"} if attributes is None else attributes

    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pages.map(lambda html: ElementFinder(tag, wanted).find(html) if html else None)

    return extract
