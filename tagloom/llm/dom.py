"""A small DOM: elements in page order, with their text, attributes and statistics."""

from __future__ import annotations

import html as entities
import re

import numpy as np

# Elements without content, elements whose content is no markup, elements whose content is
# code, data or a control and never text of the page, and elements that stand within a line.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes template".split())
UNSHOWN = frozenset(
    "head script style textarea title iframe noembed noframes template select datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section "
    "summary table ul".split()
)
# An opening tag that ends the open elements on the left, up to a container on the right.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "tr": (("tr",), ("table", "thead", "tbody", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
SCOPE = frozenset("table td th caption button object html body".split())

_tag = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_attribute = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_token = re.compile(r"[a-z]+")

GROUPS = {
    "content": "article content main post entry story body text paragraph blog news".split(),
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs pagination pager toc tabs".split(),
    "advert": "ad ads advert adverts advertisement banner sponsor sponsored promo promotion "
    "affiliate".split(),
    "side": "sidebar aside side widget related recommended trending popular teaser".split(),
    "notice": "cookie cookies consent notice alert modal popup overlay gdpr privacy disclaimer "
    "message warning".split(),
    "comment": "comment comments reply replies respond discussion disqus".split(),
    "form": "form search login signup subscribe newsletter register contact".split(),
    "edge": "header footer foot masthead copyright legal bottom top share social meta byline "
    "tags".split(),
}
TAGS = {
    "article": 0, "main": 0, "section": 1, "div": 1, "body": 2, "nav": 3, "menu": 3,
    "header": 4, "footer": 5, "aside": 6, "form": 7, "button": 7, "input": 7, "label": 7,
    "fieldset": 7, "p": 8, "pre": 8, "blockquote": 8, "ul": 9, "ol": 9, "li": 9, "dl": 9,
    "dt": 9, "dd": 9, "a": 10, "h1": 11, "h2": 11, "h3": 11, "h4": 11, "h5": 11, "h6": 11,
    "table": 12, "tbody": 12, "thead": 12, "tr": 12, "td": 12, "th": 12, "figure": 13,
    "figcaption": 13, "dialog": 14,
}
N_TAGS = 16
_group_of = {word: i for i, words in enumerate(GROUPS.values()) for word in words}


class Page:
    """The elements of a page in order; text as (element, text) in order, with a line break
    for each element that makes one."""

    def __init__(self, html: str | None):
        self.tags: list[str] = ["#page"]
        self.parents: list[int] = [-1]
        self.attributes: list[str] = [""]
        self.texts: list[tuple[int, str]] = []
        self._parse(html or "")

    def _add(self, tag: str, attributes: str, parent: int) -> int:
        self.tags.append(tag)
        self.parents.append(parent)
        self.attributes.append(attributes)
        return len(self.tags) - 1

    def _parse(self, html: str) -> None:
        stack, at, size = [0], 0, len(html)

        def text(start: int, end: int) -> None:
            if end > start:
                self.texts.append((stack[-1], entities.unescape(html[start:end])))

        while at < size:
            opening = html.find("<", at)
            found = None
            while opening >= 0 and not (found := _tag.match(html, opening)):
                opening = html.find("<", opening + 1)
            if not found:
                text(at, size)
                return
            text(at, opening)
            at = found.end()
            name = (found[2] or "").lower()
            if not name or not found[0].endswith(">"):
                continue  # a comment, a declaration, or a tag that the page ends in
            if found[1]:
                self._close(stack, name)
                continue
            if name in CLOSES_PARAGRAPH:
                self._end(stack, ("p",), SCOPE)
            if name in ENDS:
                self._end(stack, *ENDS[name])
            node = self._add(name, found[3], stack[-1])
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(html, at)
                stop = end.start() if end else size
                self.texts.append((node, html[at:stop]))
                after = html.find(">", stop) if end else -1
                at = after + 1 if after >= 0 else size
            elif name in ("br", "hr"):
                self.texts.append((stack[-1], "\n"))
            elif name not in VOID:
                stack.append(node)

    def _end(self, stack: list[int], names: tuple[str, ...], scope) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[depth]]
            if tag in names:
                del stack[depth:]
                return
            if tag in scope:
                return

    def _close(self, stack: list[int], name: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[depth]]
            if tag == name:
                del stack[depth:]
                return
            if name in INLINE or name == "p":
                if tag not in INLINE:
                    return
            elif tag in ("td", "th", "table") and name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                return

    def shown(self) -> np.ndarray:
        """Whether the text in an element can be text of the page at all."""
        out = np.ones(len(self.tags), bool)
        for i in range(1, len(self.tags)):
            out[i] = out[self.parents[i]] and self.tags[i] not in UNSHOWN
        return out

    def text(self, kept: np.ndarray) -> str:
        """The text of the elements ``kept``: references decoded, white space as one space,
        one space between blocks. What is left out parts the text around it only where a block stood."""
        parts, block = [], None
        blocks, shown = self.blocks(), self.shown()
        for node, text in self.texts:
            if kept[node]:
                if blocks[node] != block and parts:
                    parts.append(" ")
                block = blocks[node]
                parts.append(text)
            elif shown[node] and blocks[node] != block:
                block = None
        return " ".join("".join(parts).split())

    def blocks(self) -> list[int]:
        """The nearest element of each that stands on lines of its own, itself included."""
        out: list[int] = []
        for i, tag in enumerate(self.tags):
            out.append(out[self.parents[i]] if tag in INLINE and i else i)
        return out


FEATURES = (
    "depth chars words link_share tags density punctuation own_share children place siblings "
    "alike page_share start paragraphs items controls headings parent_density sibling_density "
    "nearest_landmark"
).split()
N_FEATURES = len(FEATURES) + N_TAGS + 3 * len(GROUPS)


def features(page: Page) -> np.ndarray:
    """A row of statistics for each element: its subtree's size, density, links and kinds of
    elements, its depth, its place among its siblings and what they are like, its tag, and
    the words of its own, its ancestors' and its parent's class, id and role."""
    n = len(page.tags)
    parents = np.array(page.parents)
    own = np.zeros((n, 4))  # characters, words, punctuation marks, characters in links
    shown = page.shown()
    starts = np.zeros(n)
    seen, in_link = 0.0, np.zeros(n, bool)
    depth = np.zeros(n)
    groups = np.zeros((n, len(GROUPS)))
    above = np.zeros((n, len(GROUPS)))
    landmark = np.zeros(n)
    kind = np.full(n, 15)
    for i in range(1, n):
        p = parents[i]
        tag = page.tags[i]
        kind[i] = TAGS.get(tag, 15)
        depth[i] = depth[p] + 1
        in_link[i] = in_link[p] or tag == "a"
        if page.attributes[i]:
            for m in _attribute.finditer(page.attributes[i]):
                if m[1].lower() in ("class", "id", "role", "aria-label", "itemprop"):
                    for word in _token.findall((m[2] or m[3] or m[4] or "").lower()):
                        if (g := _group_of.get(word)) is not None:
                            groups[i, g] = 1
        above[i] = np.maximum(above[p], groups[p]) if p else 0
        landmark[i] = kind[i] + 1 if kind[i] in (0, 3, 4, 5, 6, 7) else landmark[p]
    first = np.full(n, -1.0)
    for node, text in page.texts:
        if not shown[node]:
            continue
        words = text.split()
        chars = sum(map(len, words))
        first[node] = seen if first[node] < 0 else first[node]
        seen += chars
        marks = sum(text.count(c) for c in ".,;:!?")
        own[node] += (chars, len(words), marks, chars if in_link[node] else 0)
    total = own.copy()
    count = np.ones(n)
    para, item, control, heading = (
        np.isin(kind, k).astype(float) for k in ([8], [9], [7], [11])
    )
    children = np.zeros(n)
    place = np.zeros(n)
    for i in range(1, n):
        place[i] = children[parents[i]]
        children[parents[i]] += 1
    starts = first
    for i in range(n - 1, 0, -1):
        p = parents[i]
        total[p] += total[i]
        count[p] += count[i]
        para[p] += para[i]
        item[p] += item[i]
        control[p] += control[i]
        heading[p] += heading[i]
        if starts[i] >= 0 and (starts[p] < 0 or starts[i] < starts[p]):
            starts[p] = starts[i]
    up = np.maximum(parents, 0)
    density = total[:, 0] / count
    siblings = children[up]
    same = np.zeros(n)
    sums = np.zeros(n)
    np.add.at(sums, up[1:], density[1:])
    pairs = up * N_TAGS + kind
    numbers = np.bincount(pairs[1:], minlength=n * N_TAGS) if n > 1 else np.zeros(n * N_TAGS)
    same = numbers[pairs] / np.maximum(siblings, 1)
    chars = np.maximum(total[:, 0], 1)
    whole = max(total[0, 0], 1.0)
    columns = [
        depth, np.log1p(total[:, 0]), np.log1p(total[:, 1]), total[:, 3] / chars, np.log1p(count),
        np.log1p(density), total[:, 2] / np.maximum(total[:, 1], 1), own[:, 0] / chars,
        np.log1p(children), place / np.maximum(siblings - 1, 1), np.log1p(siblings), same,
        total[:, 0] / whole, np.maximum(starts, 0) / whole, np.log1p(para), np.log1p(item),
        np.log1p(control), np.log1p(heading), np.log1p(density[up]),
        np.log1p(sums[up] / np.maximum(siblings, 1)), landmark,
    ]
    tags = np.zeros((n, N_TAGS))
    tags[np.arange(n), kind] = 1
    return np.concatenate([np.stack(columns, axis=1), tags, groups, above, groups[up]], axis=1)
