"""Fields of review pages, read with the standard library's HTML parser in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Node:
    """An element with its attributes, children and text."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children, self.pieces = tag, attrs, parent, [], []

    def walk(self) -> Iterator[Node]:
        yield self
        for c in self.children:
            yield from c.walk()

    def find(self, test: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.walk() if n is not self and test(n)), None)

    def text(self) -> str | None:
        joined = re.sub(r"\s+", " ", "".join(p if isinstance(p, str) else (p.raw()) for p in self.pieces)).strip()
        return joined or None

    def raw(self) -> str:
        return "".join(p if isinstance(p, str) else p.raw() for p in self.pieces)

    def has(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()


# Fixed values below: the names of elements, classes and properties that review pages use.


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.at = self.root

    def handle_starttag(self, tag, attrs):
        n = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(n)
        self.at.pieces.append(n)
        if tag not in _VOID:
            self.at = n

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.pieces.append(data)


def parse(page: str) -> Node:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


def _attr(name: str, value: str) -> Callable[[Node], bool]:
    return lambda n: n.attrs.get(name) == value


def _text(root: Node, *tests: Callable[[Node], bool]) -> str | None:
    for t in tests:
        if (n := root.find(t)) is not None and (s := n.text()):
            return s
    return None


def _int(s: str | None) -> int | None:
    return int(s) if s and re.fullmatch(r"\s*[+-]?\d+\s*", s) else None


def metadata(root: Node) -> dict:
    pairs: dict[str, str] = {}
    for dl in root.walk():
        if dl.tag == "dl" and dl.has("tea-description"):
            key = None
            for c in dl.children:
                if c.tag == "dt":
                    key = c.text()
                elif c.tag == "dd" and key:
                    if (v := c.text()) and key not in pairs:
                        pairs[key] = v
                    key = None
    prep: dict[str, str] = {}
    if (box := root.find(lambda n: n.has("prep-details") and _inside(n, "tea-prep"))) is not None:
        for s in box.walk():
            if s.tag == "span" and s.attrs.get("class") and (v := s.text()):
                prep.setdefault(s.attrs["class"], v)
    count = root.find(lambda n: n.tag == "meta" and n.attrs.get("itemprop") == "reviewCount")
    shelf = root.find(_attr("id", "availability"))
    head = shelf.find(lambda n: n.tag == "h4") if shelf else None
    return {
        "name": _text(root, lambda n: n.tag == "h1" and n.attrs.get("itemprop") == "name"),
        "average_rating": _int(_text(root, _attr("id", "rating-average"))),
        "rating_count": _int(count.attrs.get("content") if count else None),
        "description": _text(root, lambda n: n.has("description"), _attr("id", "tea-description")),
        "description_pairs": pairs,
        "prep": prep,
        "availability": head.text() if head else None,
    }


def _inside(n: Node, name: str) -> bool:
    while (n := n.parent) is not None:
        if n.has(name):
            return True
    return False


def notes(root: Node) -> list[dict]:
    """Reviews in page order. One without a numbered id or an author is left out."""
    out = []
    for n in root.walk():
        if n.tag != "div" or not n.has("note"):
            continue
        number = re.fullmatch(r"note_(\d+)", n.attrs.get("id", ""))
        author = n.find(lambda x: x.tag == "meta" and x.attrs.get("itemprop") == "name")
        name = (author.attrs.get("content") or "").strip() if author else None
        if not name:
            who = n.find(_attr("itemprop", "author"))
            name = (_text(who, _attr("itemprop", "name")) or who.text()) if who else None
        if not number or not name:
            continue
        time = n.find(lambda x: x.tag == "abbr" and x.attrs.get("itemprop") == "datePublished")
        said = n.find(lambda x: x.has("show-inline-comments"))
        out.append({"note_id": int(number[1]), "author": name, "rating": _int(_text(n, _attr("itemprop", "ratingValue"))), "body": _text(n, _attr("itemprop", "description")), "posted_at": (time.attrs.get("content") or None) if time else None, "likes": _int(_text(n, lambda x: x.has("likes-count"))), "comments": _int(said.attrs.get("data-pluralize-count")) if said else None})
    return out


def item_links(root: Node, pattern: str) -> list[str]:
    """Distinct link targets that match, in the order they come first."""
    return list(dict.fromkeys(n.attrs["href"] for n in root.walk() if n.tag == "a" and re.fullmatch(pattern, n.attrs.get("href", ""))))


def has_next(root: Node) -> bool:
    return any(n.tag == "a" and n.text() == "Next" and re.search(r"[?&]page=\d+", n.attrs.get("href", "")) for n in root.walk())


PAGE = (
    "name string, average_rating int, rating_count int, description string, description_pairs map<string,string>, prep map<string,string>, availability string, "
    "notes array<struct<note_id:long,author:string,rating:int,body:string,posted_at:string,likes:int,comments:int>>, has_next boolean"
)


def _read_pages(pages: pd.Series) -> pd.DataFrame:
    rows = []
    for p in pages:
        root = parse(p or "")
        rows.append({**metadata(root), "notes": notes(root), "has_next": has_next(root)})
    out = pd.DataFrame(rows)
    for c in ("average_rating", "rating_count"):
        out[c] = out[c].astype("Int32")
    return out


def read_page(page: Column) -> Column:
    """A review page as one struct; fields that the page lacks are null, lists empty."""
    return F.pandas_udf(_read_pages, PAGE)(page)


def page_links(page: Column, pattern: str) -> Column:
    @F.pandas_udf("array<string>")
    def links(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: item_links(parse(p or ""), pattern))

    return links(page)
