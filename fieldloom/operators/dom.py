"""A small HTML tree with the selectors that pages need, on the standard library's tokenizer.

Selectors: type, ``.class``, ``#id``, ``[name="v"]``, ``[name^="v"]``, ``:contains("v")``, descendants, ``+``, comma lists,
and ``::text`` or ``::attr(name)`` at the end. Results are in document order. A text is a node's own child, blanks
included; ``:contains`` looks at all text below an element.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache
from html.parser import HTMLParser

#: Fixed values of HTML: elements without content, and those that an opening tag ends.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"
}
ENDED_BY = {
    "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option"}
}
#: An implied end doesn't reach out of these.
SCOPES = {"ul", "ol", "dl", "table", "select", "div", "td", "th", "body"}


class Element:
    """order, end: the element's place in the document and that of the last one below it; previous: the element just before it among its siblings."""

    __slots__ = ("tag", "attrs", "classes", "children", "parent", "order", "end", "previous", "page", "_last", "_text")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None, order: int, page: Page):
        self.tag, self.attrs, self.parent, self.order, self.page = tag, attrs, parent, order, page
        self.classes = frozenset(attrs["class"].split()) if "class" in attrs else frozenset()
        self.children: list[Element | str] = []
        self._text: str | None = None
        self._last: Element | None = None
        self.previous = None if parent is None else parent._last
        if parent is not None:
            parent._last = self

    def text(self) -> str:
        """All text below."""
        if self._text is None:
            out, todo = [], [self]
            while todo:
                x = todo.pop()
                if type(x) is str:
                    out.append(x)
                else:
                    todo += reversed(x.children)
            self._text = "".join(out)
        return self._text


class Page:
    """All elements in document order, and their places by tag (``p``), class (``.c``) and id (``#i``)."""

    def __init__(self) -> None:
        self.elements: list[Element] = []
        self.places: dict[str, list[int]] = {}

    def close(self) -> None:
        for e in self.elements:
            e.end = e.order
            for k in (e.tag, *["." + c for c in e.classes], *(["#" + e.attrs["id"]] if "id" in e.attrs else [])):
                self.places.setdefault(k, []).append(e.order)
        for e in reversed(self.elements):
            if e.parent is not None and e.parent.end < e.end:
                e.parent.end = e.end

    def below(self, top: Element, key: str | None) -> list[Element]:
        """The elements below ``top`` that bear a tag, class or id, in document order."""
        if key is None:
            return self.elements[top.order + 1 : top.end + 1]
        at = self.places.get(key, [])
        return [self.elements[k] for k in at[bisect_right(at, top.order) : bisect_right(at, top.end)]]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.root = self.at = self.made("#root", {}, None)

    def made(self, tag: str, attrs: dict[str, str], parent: Element | None) -> Element:
        e = Element(tag, attrs, parent, len(self.page.elements), self.page)
        self.page.elements.append(e)
        return e

    def handle_starttag(self, tag: str, attrs: list) -> None:
        x = self.at
        while x.parent is not None:
            if tag in ENDED_BY.get(x.tag, ()):
                self.at = x.parent
                if tag not in ENDED_BY.get(self.at.tag, ()):  # a cell ends, and its row with it
                    break
            elif x.tag in SCOPES:
                break
            x = x.parent
        own: dict[str, str] = {}
        for k, v in attrs:
            own.setdefault(k, v or "")
        e = self.made(tag, own, self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag: str) -> None:
        x = self.at
        while x is not None and x.tag != tag:
            x = x.parent
        if x is not None and x.parent is not None:
            self.at = x.parent
        elif tag == "p":  # a paragraph's end without one is an empty paragraph
            self.handle_starttag("p", [])
            self.at = self.at.parent

    def handle_data(self, data: str) -> None:
        kids = self.at.children
        if kids and type(kids[-1]) is str:
            kids[-1] += data
        else:
            kids.append(data)


def parse(html: str) -> Element:
    b = _Builder()
    b.feed(html)
    b.close()
    b.page.close()
    return b.root


_PART = re.compile(
    r"""(?P<tag>[a-zA-Z][\w-]*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>\^?=)"(?P<val>[^"]*)")?\]|:contains\("(?P<has>[^"]*)"\)"""
)


def _compound(text: str) -> list[tuple]:
    tests, at = [], 0
    while at < len(text):
        m = _PART.match(text, at)
        if not m:
            raise ValueError(f"selector: {text}")
        tests.append((m["tag"], m["cls"], m["id"], m["attr"], m["op"], m["val"], m["has"]))
        at = m.end()
    return tests


@lru_cache(512)
def _compiled(selector: str) -> tuple[tuple, ...]:
    """For each alternative: ([(combinator, compound)...] from left to right, pseudo-element)."""
    out = []
    for one in re.split(r",(?![^\[(]*[\])])", selector):
        body, _, pseudo = one.strip().partition("::")
        steps, join = [], " "
        for token in re.findall(r"\+|(?:[^\s+\"]|\"[^\"]*\")+", body):
            if token == "+":
                join = "+"
            else:
                steps.append((join, tuple(_compound(token))))
                join = " "
        out.append((tuple(steps), pseudo))
    return tuple(out)


def _fits(e: Element, compound: tuple) -> bool:
    for tag, cls, id_, attr, op, val, has in compound:
        if tag is not None:
            if e.tag != tag.lower():
                return False
        elif cls is not None:
            if cls not in e.classes:
                return False
        elif id_ is not None:
            if e.attrs.get("id") != id_:
                return False
        elif attr is not None:
            have = e.attrs.get(attr.lower())
            if have is None or op == "=" and have != val or op == "^=" and not (val and have.startswith(val)):
                return False
        elif has not in e.text():
            return False
    return True


def _matches(e: Element, steps: tuple, k: int, top: Element) -> bool:
    """Whether step k holds at ``e`` and the steps before it around it. Ancestors may lie outside of ``top``."""
    if not _fits(e, steps[k][1]):
        return False
    if k == 0:
        return True
    if steps[k][0] == "+":
        return e.previous is not None and _matches(e.previous, steps, k - 1, top)
    a = e.parent
    while a is not None and a.parent is not None:
        if _matches(a, steps, k - 1, top):
            return True
        a = a.parent
    return False


def _key(compound: tuple) -> str | None:
    """The tag, class or id by which a page finds the elements that a compound may fit: a class or an id, if it has one."""
    for tag, cls, id_, *_ in compound:
        if cls is not None or id_ is not None:
            return "." + cls if cls is not None else "#" + id_
    return next((t.lower() for t, *_ in compound if t is not None), None)


def select(top: Element, selector: str) -> list:
    """Elements, texts or attribute values, in document order."""
    found: dict[int, tuple[Element, str]] = {}
    ways = _compiled(selector)
    for steps, pseudo in ways:
        for e in top.page.below(top, _key(steps[-1][1])) if steps else [top]:
            if e.order not in found and (not steps or _matches(e, steps, len(steps) - 1, top)):
                found[e.order] = (e, pseudo)
    out = []
    for _, (e, pseudo) in sorted(found.items()) if len(ways) > 1 else found.items():
        if pseudo == "text":
            out += [x for x in e.children if type(x) is str]
        elif pseudo.startswith("attr("):
            if (v := e.attrs.get(pseudo[5:-1])) is not None:
                out.append(v)
        else:
            out.append(e)
    return out


def first(top: Element, selector: str, default: str | None = None) -> str | None:
    found = select(top, selector)
    return found[0] if found else default
