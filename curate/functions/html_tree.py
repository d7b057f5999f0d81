"""Main text of one page by way of a tag-by-tag reading.

The column expressions in `html` handle pages whose containers do not nest. This reading serves
the rest: nested containers, unclosed ones, rare entities.
"""

import sys
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle

# Workers get this module with the function, so that they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, elements whose strings are not text, and what is
# left out of a page that has no container.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
NOT_TEXT = {"script", "style", "template", "rt", "rp"}
LEFT_OUT = {"nav", "header", "footer", "aside", "script", "style"}


class Page(HTMLParser):
    """Strings of a page in order, and for each element the range of strings inside it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.strings = []
        self.elements = []
        self.open = []
        self.open_tags = Counter()
        self.fresh = True

    def handle_starttag(self, tag, attrs):
        self.fresh = True
        found = {name: value or "" for name, value in attrs}
        element = [tag, found, len(self.strings), None]
        self.elements.append(element)
        if tag not in VOID:
            self.open.append(element)
            self.open_tags[tag] += 1
        else:
            element[3] = len(self.strings)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.fresh = True
        while self.open_tags[tag]:
            element = self.open.pop()
            element[3] = len(self.strings)
            self.open_tags[element[0]] -= 1
            if element[0] == tag:
                break

    def handle_data(self, data):
        if any(self.open_tags[tag] for tag in NOT_TEXT):
            return
        if self.fresh:
            self.strings.append("")
            self.fresh = False
        self.strings[-1] += data

    def handle_comment(self, data):
        self.fresh = True

    handle_decl = handle_pi = unknown_decl = handle_comment

    def text(self, element, without=()):
        end = len(self.strings) if element[3] is None else element[3]
        gone = set()
        for inner in without:
            gone.update(range(inner[2], len(self.strings) if inner[3] is None else inner[3]))
        parts = (self.strings[i].strip() for i in range(element[2], end) if i not in gone)
        return "\n".join(part for part in parts if part)


def matches(selector, element):
    """Whether an element answers `tag`, `.class`, `#id` or `[name="value"]`."""
    tag, attrs = element[0], element[1]
    if selector.startswith("."):
        return selector[1:] in attrs.get("class", "").split()
    if selector.startswith("#"):
        return selector[1:] == attrs.get("id")
    if selector.startswith("["):
        name, _, value = selector[1:-1].partition("=")
        return attrs.get(name) == value.strip('"')
    return tag == selector


def page_text(html, selectors):
    page = Page()
    page.feed(html)
    page.close()
    for selector in selectors:
        for element in page.elements:
            if matches(selector, element):
                return page.text(element)
    for element in page.elements:
        if element[0] == "body":
            without = [
                inner for inner in page.elements
                if inner[0] in LEFT_OUT or matches(".sidebar", inner) or matches("#sidebar", inner)
            ]
            return page.text(element, without)
    return None


def reader(selectors):
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda html: page_text(html, selectors), na_action="ignore").astype(object)

    return read
