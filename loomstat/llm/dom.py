"""Pages as trees of block nodes and runs of text, and what a node looks like in numbers.

Tag soup is read as browsers do where it matters for blocks: raw text of scripts and styles is
skipped, a quote in an attribute hides ``>``, paragraphs, list items and cells close each other,
end tags that match nothing are passed over, and what isn't closed ends with its parent. Inline
elements make no node; a line break is white space.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import numpy as np

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base col embed hr img input link meta param source track".split())
RAW = frozenset("script style noscript template textarea title xmp".split())
CONTROLS = frozenset("button input label option select textarea".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: A start tag ends the open elements of these names, up to the next that holds them apart.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
MARK = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>=]|=)*+)>|<[!?/][^>]*>|<[A-Za-z/!?][^>]*\Z", re.S
)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|itemprop|aria-label)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
TEXT = "#text"

#: Siblings and places are counted up to here, places from the nearer end.
MOST = 20
#: Elements that an ancestor flag stands for.
FLAGS = ("article", "main", "nav", "header", "footer", "aside", "form", "table", "ul", "head", "section", "figure")


@lru_cache(maxsize=50_000)
def attribute_tokens(attrs: str) -> tuple[str, ...]:
    """The distinct words of class, id, role, style and the like, in order."""
    found: dict[str, None] = {}
    for name, value in ATTRIBUTE.findall(attrs):
        for word in WORD.findall(value) if value else [name]:
            found[word.lower()] = None
    return tuple(found)


class Trees:
    """The nodes of several pages in page order; children follow their parents."""

    def __init__(self):
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.attrs: list[str] = []
        self.depth: list[int] = []
        self.page: list[int] = []
        self.controls: list[int] = []
        self.texts: dict[int, str] = {}
        self.stats: dict[int, tuple[int, ...]] = {}
        self.roots: list[int] = []

    def _node(self, parent: int, tag: str, attrs: str = "") -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.page.append(len(self.roots) - 1)
        self.controls.append(0)
        return len(self.parent) - 1

    def add(self, source: str) -> None:
        """One page."""
        self.roots.append(len(self.parent))
        root = self._node(-1, "#page")
        stack, names, open_ = [root], ["#page"], {"#page": 1}
        run: list[str] = []
        linked = links = 0  # characters of the run inside links, links that are open
        at = 0

        def flush() -> None:
            nonlocal linked
            if run:
                words = html.unescape("".join(run)).split()
                if words:
                    text = " ".join(words)
                    leaf = self._node(stack[-1], TEXT)
                    self.texts[leaf] = text
                    stops = text.count(".") + text.count("!") + text.count("?")
                    self.stats[leaf] = (len(text), len(words), min(linked, len(text)), text.count(",") + text.count(";") + text.count(":"), stops, text[-1] in ".!?\"'”)…。")
                run.clear()
                linked = 0

        def pop() -> None:
            stack.pop()
            open_[names.pop()] -= 1

        for mark in MARK.finditer(source):
            if mark.start() < at:
                continue
            if mark.start() > at:
                piece = source[at : mark.start()]
                run.append(piece)
                linked += len(piece) if links else 0
            at = mark.end()
            tag = mark["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if tag in INLINE:
                if tag == "a":
                    links = 0 if mark["end"] else 1
                continue
            if tag in ("br", "wbr"):
                run.append(" " if tag == "br" else "")
                continue
            flush()
            if mark["end"]:
                if tag not in ("body", "html") and open_.get(tag):
                    while names[-1] != tag:
                        pop()
                    pop()
                    links = 0
                continue
            if tag in RAW:
                ended = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = ended.start() if ended else len(source)
                continue
            if tag in CONTROLS:
                self.controls[stack[-1]] += 1
            if tag in VOID:
                continue
            if names[-1] == "head" and tag not in IN_HEAD:
                pop()
            if open_.get("p") and names[-1] == "p":
                pop()
            if tag in CLOSES:
                ends, until = CLOSES[tag]
                depth = len(names) - 1
                while depth > 0 and names[depth] not in until and names[depth] not in ends and depth > len(names) - 8:
                    depth -= 1
                if names[depth] in ends:
                    while len(names) > depth:
                        pop()
                    while names[-1] in ends:
                        pop()
            stack.append(self._node(stack[-1], tag, mark["attrs"]))
            names.append(tag)
            open_[tag] = open_.get(tag, 0) + 1
            links = 0
        if at < len(source):
            run.append(source[at:])
            linked += len(source) - at if links else 0
        flush()


FEATURES = (
    "tag", "own_sum", "own_low", "own_high", "above_sum", "above_low", "above_high", "tokens", "depth", "is_text", *(f"in_{f}" for f in FLAGS),
    "chars", "words", "link_share", "marks", "stops", "ended", "leaves", "nodes", "chars_a_leaf", "chars_a_node", "controls", "words_a_stop",
    "siblings", "place", "alike", "share_of_parent", "chars_before", "chars_after", "links_before", "links_after", "parent_links", "parent_chars_a_leaf", "parent_stops",
)


class Odds:
    """Log odds of main text for tags and attribute tokens, learned from labelled nodes; 0 for what wasn't seen."""

    def __init__(self, tags: dict[str, float], tokens: dict[str, float]):
        self.tags, self.tokens = tags, tokens

    @staticmethod
    def learned(trees: Trees, label: np.ndarray, weight: np.ndarray) -> Odds:
        def odds(pairs) -> dict[str, float]:
            seen: dict[str, list[float]] = {}
            for name, k in pairs:
                seen.setdefault(name, [0.0, 0.0])[int(label[k])] += weight[k]
            return {name: float(np.log((yes + 1) / (no + 1))) for name, (no, yes) in seen.items()}

        tokens = ((token, k) for k, attrs in enumerate(trees.attrs) if attrs for token in attribute_tokens(attrs))
        return Odds(odds((tag, k) for k, tag in enumerate(trees.tag)), odds(tokens))


def features(trees: Trees, odds: Odds) -> np.ndarray:
    """A row of numbers per node: subtree density, attribute tokens, depth and sibling statistics.

    Numbers that grow with the page are logarithms or end at ``MOST``: a very long article looks like a long one.
    """
    n = len(trees.parent)
    parent, depth = np.array(trees.parent), np.array(trees.depth)
    text = np.zeros((n, 9))  # chars, words, linked, marks, stops, ended, leaves, nodes, controls
    leaf = np.fromiter(trees.texts, dtype=np.int64, count=len(trees.texts))
    text[leaf, :6] = np.array(list(trees.stats.values()), dtype=float).reshape(-1, 6)
    text[leaf, 6] = 1
    text[:, 7] = 1
    text[:, 8] = trees.controls
    own = np.zeros((n, 4))
    scores = odds.tokens
    for k, attrs in enumerate(trees.attrs):
        if attrs:
            known = [scores.get(t, 0.0) for t in attribute_tokens(attrs)]
            if known:
                own[k] = sum(known), min(known), max(known), len(known)
    flags = np.zeros((n, len(FLAGS)))
    which = {f: k for k, f in enumerate(FLAGS)}
    for k, tag in enumerate(trees.tag):
        if tag in which:
            flags[k, which[tag]] = 1
    above = np.zeros((n, 3))
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(depth.max(initial=0) + 2))
    levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for level in levels[1:]:
        up = parent[level]
        flags[level] = np.maximum(flags[level], flags[up])
        above[level, 0] = above[up, 0] + own[up, 0]
        above[level, 1] = np.minimum(above[up, 1], own[up, 1])
        above[level, 2] = np.maximum(above[up, 2], own[up, 2])
    for level in reversed(levels[1:]):
        np.add.at(text, parent[level], text[level])
    up = np.maximum(parent, 0)
    chars, leaves = np.maximum(text[:, 0], 1), np.maximum(text[:, 6], 1)
    links = text[:, 2] / chars
    # siblings stand next to each other when nodes are sorted by parent
    by = np.argsort(parent, kind="stable")
    first, last = np.ones(n, bool), np.ones(n, bool)
    first[1:] = last[:-1] = parent[by][1:] != parent[by][:-1]
    before, after = np.full(n, -1), np.full(n, -1)
    before[by[1:][~first[1:]]] = by[:-1][~first[1:]]
    after[by[:-1][~last[:-1]]] = by[1:][~last[:-1]]
    group = np.cumsum(first) - 1
    size = np.bincount(group)[group]
    place = np.arange(n) - np.flatnonzero(first)[group]
    siblings, places = np.empty(n), np.empty(n)
    siblings[by], places[by] = size, np.minimum(place, size - 1 - place)
    code = {t: k for k, t in enumerate(dict.fromkeys(trees.tag))}
    kind = np.array([code[t] for t in trees.tag])
    alike = ((before >= 0) & (kind[before] == kind)) * 1.0 + ((after >= 0) & (kind[after] == kind))
    side = lambda where, values: np.where(where >= 0, values[where], -1)
    return np.column_stack(
        [
            [odds.tags.get(t, 0.0) for t in trees.tag], own[:, 0], own[:, 1], own[:, 2], above, own[:, 3], depth, kind == code.get(TEXT, -1), flags,
            np.log1p(text[:, 0]), np.log1p(text[:, 1]), links, text[:, 3] / chars, text[:, 4] / chars, text[:, 5] / leaves, np.log1p(text[:, 6]), np.log1p(text[:, 7]),
            np.log1p(text[:, 0] / leaves), np.log1p(text[:, 0] / text[:, 7]), text[:, 8] / text[:, 7], text[:, 1] / (text[:, 4] + 1),
            np.minimum(siblings, MOST), np.minimum(places, MOST), alike, text[:, 0] / np.maximum(text[up, 0], 1), np.log1p(np.maximum(side(before, text[:, 0]), 0)), np.log1p(np.maximum(side(after, text[:, 0]), 0)),
            side(before, links), side(after, links), links[up], np.log1p(text[up, 0] / leaves[up]), text[up, 4] / chars[up],
        ]
    ).astype(np.float32)
