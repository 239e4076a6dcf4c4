"""HTML to plain text, by the standard library's parser, in Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that begin and end a line, and elements left out with all they hold.
LINES = set("p div section article header footer li ul ol table tr h1 h2 h3 h4 h5 h6 br hr dt dd dl blockquote pre figure figcaption main aside td th".split())
LEFT_OUT = {"script", "style", "noscript", "svg", "iframe", "form", "template", "nav"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: What closes an open paragraph or item of the same kind.
CLOSES = {"p": LINES - {"br", "li", "td", "th", "dt", "dd", "tr"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}}


class Node:
    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self):
        """This element and all below it, in order."""
        yield self
        for child in self.children:
            if isinstance(child, Node):
                yield from child.walk()

    def text(self) -> str:
        return "".join(c.text() if isinstance(c, Node) else c for c in self.children)

    def matches(self, selector: str) -> bool:
        """A simple selector: name, #id, .class and [attribute] or [attribute='value'] together."""
        m = re.fullmatch(r"([a-z0-9]*)((?:[#.][\w-]+|\[[^\]]+\])*)", selector.strip(), re.I)
        if not m or (m[1] and m[1].lower() != self.name):
            return False
        for part in re.findall(r"[#.][\w-]+|\[[^\]]+\]", m[2]):
            if part[0] == "#":
                good = self.attrs.get("id") == part[1:]
            elif part[0] == ".":
                good = part[1:] in self.attrs.get("class", "").split()
            else:
                key, eq, value = part[1:-1].partition("=")
                good = key in self.attrs and (not eq or self.attrs[key] == value.strip("'\""))
            if not good:
                return False
        return True


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if self.at.name in CLOSES and tag in CLOSES[self.at.name]:
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node.parent and node.name != tag:
            node = node.parent
        if node.parent:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def links(html: str, base: str) -> list[tuple[str, str]]:
    """Absolute http links and their texts, in order."""
    out = []
    for node in parse(html).walk():
        href = node.attrs.get("href", "").strip() if node.name == "a" else ""
        if href:
            url = urljoin(base, href)
            if urlsplit(url).scheme in ("http", "https"):
                out.append((url, " ".join(node.text().split())))
    return out


def html_to_text(html: str, base: str, content: str | None = None, remove: tuple[str, ...] = ()) -> str:
    """Title, the content's lines with link targets and image texts inline, and any event's structured data."""
    root = parse(html)
    title = next((" ".join([n.text().strip()]) for n in root.walk() if n.name == "title"), "")
    data = [n.text().strip() for n in root.walk() if n.name == "script" and n.attrs.get("type") == "application/ld+json"]
    data = [re.sub(r"\s+", " ", d) for d in data if re.search(r'"@type"\s*:\s*"[^"]*Event"', d)]

    def out_of_it(n: Node) -> bool:
        return n.name in LEFT_OUT or n.attrs.get("aria-hidden") == "true" or "screen-reader-text" in n.attrs.get("class", "").split() or any(n.matches(s) for s in remove)

    def shown(n: Node) -> bool:
        while n is not None:
            if out_of_it(n):
                return False
            n = n.parent
        return True

    inside = [n for n in root.walk() if n.matches(content or "main") and shown(n)] or [n for n in root.walk() if n.name == "body"] or [root]
    out: list[str] = []

    def write(n: Node | str) -> None:
        if isinstance(n, str):
            out.append(re.sub(r"\s+", " ", n))
            return
        if out_of_it(n) or n.name in ("title", "head"):
            return
        if n.name == "img":
            if alt := n.attrs.get("alt", "").strip():
                out.append(f" [image: {alt}] ")
            return
        edge = "\n" if n.name in LINES else ""
        out.append(edge)
        for child in n.children:
            write(child)
        href = n.attrs.get("href", "").strip() if n.name == "a" else ""
        if href and not href.startswith("#") and not re.match(r"(javascript|mailto|tel):", href, re.I):
            url = urljoin(base, href)
            if urlsplit(url).scheme:
                out.append(f" <{url}>")
        out.append(edge)

    for n in inside:
        write(n)
    lines = (re.sub(r"[ \t ]+", " ", x).strip() for x in "".join(out).split("\n"))
    parts = [f"PAGE TITLE: {title}"] if title else []
    parts.append("\n".join(x for x in lines if x))
    if data:
        parts.append("STRUCTURED DATA (schema.org JSON-LD):\n" + "\n".join(data))
    return "\n\n".join(parts).strip() + "\n"


def as_text(html: Column, base: Column, content: str | None = None, remove: tuple[str, ...] = ()) -> Column:
    """html_to_text() of a column of pages and their addresses."""

    @F.pandas_udf("string")
    def run(pages: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else html_to_text(p, b or "", content, remove) for p, b in zip(pages, bases, strict=True)])

    return run(html, base)


def as_links(html: Column, base: Column) -> Column:
    """links() of a column of pages: array of (url, text)."""

    @F.pandas_udf("array<struct<url:string,text:string>>")
    def run(pages: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([[{"url": u, "text": t} for u, t in links(p or "", b or "")] for p, b in zip(pages, bases, strict=True)])

    return run(html, base)
