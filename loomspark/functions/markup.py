"""HTML to Markdown, Markdown to sections, sections to passages: scanners with state, run in Arrow batches."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame


class _Writer(HTMLParser):
    """Writes Markdown while it reads HTML."""

    SKIPPED = {"script", "style", "noscript", "template", "svg", "head"}
    BLOCKS = {"p", "div", "section", "article", "ul", "ol", "table", "blockquote", "header", "footer", "main", "tr"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip, self.pre, self.links = 0, 0, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.SKIPPED:
            self.skip += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in self.BLOCKS:
            self.out.append("\n\n")
        elif tag == "li":
            self.out.append("\n- ")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "pre":
            self.pre += 1
            self.out.append("\n\n```\n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag in ("td", "th"):
            self.out.append(" | ")
        elif tag == "a":
            self.links.append(dict(attrs).get("href"))
            self.out.append("[")

    def handle_endtag(self, tag: str) -> None:
        if tag in self.SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif re.fullmatch("h[1-6]", tag) or tag in self.BLOCKS:
            self.out.append("\n\n")
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.out.append("\n```\n\n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "code" and not self.pre:
            self.out.append("`")
        elif tag == "a" and self.links:
            to = self.links.pop()
            self.out.append(f"]({to})" if to else "]")

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.out.append(data if self.pre else re.sub(r"\s+", " ", data))


def to_markdown(page: str) -> str:
    """A page as Markdown; scripts, styles and the head are dropped, blank lines folded."""
    writer = _Writer()
    writer.feed(page)
    writer.close()
    lines = [x.rstrip() if x.startswith("    ") else x.strip() for x in "".join(writer.out).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", html.unescape("\n".join(lines))).strip()


def decode_page(raw: bytes) -> str:
    """Bytes by their declared charset, else UTF-8, else Windows-1252."""
    named = re.search(rb"charset=[\"']?([\w-]+)", raw[:2048], re.I)
    declared = [named.group(1).decode("ascii", "replace")] if named else []
    for charset in [*declared, "utf-8", "cp1252"]:
        try:
            return raw.decode(charset)
        except (LookupError, UnicodeDecodeError):
            continue
    return raw.decode("latin-1")


def sections(text: str) -> list[tuple[str | None, int, int]]:
    """heading, start, stop (UTF-8 bytes) of the parts between Markdown headings; fenced lines are no headings."""
    out: list[tuple[str | None, int, int]] = []
    heading, start, at, fenced = None, 0, 0, False
    for line in text.splitlines(keepends=True):
        size = len(line.encode())
        if re.match(r"\s*(```|~~~)", line):
            fenced = not fenced
        found = None if fenced else re.match(r" {0,3}#{1,6}\s+(.*?)\s*#*\s*$", line)
        if found:
            if at > start:
                out.append((heading, start, at))
            heading, start = found.group(1), at
        at += size
    return out + [(heading, start, at)] if at > start else out


def passages(parts: list[str], target: int = 120, most: int = 260, least: int = 12) -> list[tuple[int, int]]:
    """first and last part of each passage: neighbours are merged up to the target, never beyond the most; a passage of
    fewer words than the least is dropped."""
    out, first, words = [], 0, 0
    for k, part in enumerate(parts):
        n = len(part.split())
        if words and (words >= target or words + n > most):
            out.append((first, k - 1, words))
            first, words = k, 0
        words += n
    if words:
        out.append((first, len(parts) - 1, words))
    return [(a, b) for a, b, n in out if n >= least]


def cut_sections(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, section, heading, start, stop for every text; NULL and empty texts give no rows."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(k, n, *s) for k, t in zip(batch[key], batch[text]) if t for n, s in enumerate(sections(t))]
            yield pd.DataFrame(out, columns=[key, "section", "heading", "start", "stop"])

    return rows.select(key, text).mapInPandas(run, f"`{key}` {kind}, section int, heading string, start bigint, stop bigint")
