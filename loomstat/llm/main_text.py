"""Main text of web pages: boosted trees over the nodes of a page, decoded from the top down without contradictions.

A page is read as a tree (``dom``). Each node, boxes and runs of text alike, gets the log odds that
it belongs to the main text from gradient-boosted trees (``boosting``) over the density of its
subtree, the words of its attributes and of those above it, depth, and its siblings. A node then is
kept whole, dropped whole or mixed; below a kept node all is kept and below a dropped one all is
dropped, so no descendant contradicts an ancestor. The labelling of the largest likelihood is found
by one pass from the leaves up and one down.

The classifier is fitted on made-up pages (``layouts``, ``made`` of them) and on at most ``per_table``
pages of the table itself, those with the smallest hash of their html among pages with an
``article`` element, labelled by their semantic elements. Both bounds are parameters. All pages
are then extracted, whole; the model (some 100 KB) is broadcast and nothing is shuffled.

Defined cases: null html is an empty page; a page without main text has an empty text; pages may
repeat, and ids and urls may be null; an empty table gives an empty result. Other columns are kept;
a column ``text`` or ``n_chars`` that is there already is an error.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting, dom, layouts
from .common import batches_of, strings, text_of, unused

#: Made-up pages and pages of the table that the classifier is fitted on.
MADE, PER_TABLE = 600, 200
#: What a mixed node costs, as a log likelihood, and more for each unit of log odds against main text.
MIXED, AGAINST = -0.7, 0.35
KEPT, DROPPED, MIX = range(3)
BOILERPLATE = frozenset("aside button dialog footer form header menu nav noscript option select".split())


@dataclass
class Extractor:
    odds: dom.Odds
    trees: boosting.Boosted

    def texts(self, pages: list[str]) -> list[str]:
        """The main text of each page."""
        found = dom.Trees()
        for page in pages:
            found.add(page)
        kept = decoded(found, self.trees.log_odds(dom.features(found, self.odds)))
        out: list[list[str]] = [[] for _ in pages]
        for leaf, text in found.texts.items():
            if kept[leaf]:
                out[found.page[leaf]].append(text)
        return ["\n".join(x) for x in out]


def decoded(trees: dom.Trees, log_odds: np.ndarray) -> list[bool]:
    """Whether each node is kept, by the likeliest labelling in which no node contradicts one above it."""
    keep, drop = (-np.logaddexp(0, -log_odds)).tolist(), (-np.logaddexp(0, log_odds)).tolist()
    n, parent = len(keep), trees.parent
    mixed, inner = (MIXED + AGAINST * np.minimum(log_odds, 0)).tolist(), [False] * n
    for k in range(n - 1, -1, -1):
        up = parent[k]
        if up >= 0:
            best = max(keep[k], drop[k], mixed[k]) if inner[k] else max(keep[k], drop[k])
            keep[up] += keep[k]
            drop[up] += drop[k]
            mixed[up] += best
            inner[up] = True
    state = [DROPPED] * n
    for k in range(n):
        above = state[parent[k]] if parent[k] >= 0 else MIX
        if above == MIX:
            state[k] = KEPT if keep[k] > drop[k] else DROPPED
            if inner[k] and mixed[k] > max(keep[k], drop[k]):
                state[k] = MIX
        else:
            state[k] = above
    return [s == KEPT for s in state]


def _weights(trees: dom.Trees, wanted: dict[int, bool]) -> tuple[np.ndarray, np.ndarray]:
    """(label, weight) of all nodes from the labels of the runs of text: a node is what most of its text is."""
    n = len(trees.parent)
    yes, all_ = np.zeros(n), np.zeros(n)
    for leaf, text in trees.texts.items():
        all_[leaf] = 1 + np.log1p(len(text))
        yes[leaf] = all_[leaf] * wanted[leaf]
    for k in range(n - 1, -1, -1):
        if trees.parent[k] >= 0:
            yes[trees.parent[k]] += yes[k]
            all_[trees.parent[k]] += all_[k]
    share = yes / np.maximum(all_, 1e-9)
    return (share >= 0.5).astype(float), np.where(all_ > 0, np.abs(2 * share - 1), 0.0)


def labelled(trees: dom.Trees, truth: list[str], page: int) -> dict[int, bool]:
    """Which runs of text of a made-up page are its main text: the known blocks, in order."""
    out, at = {}, 0
    for leaf, text in trees.texts.items():
        if trees.page[leaf] == page:
            out[leaf] = at < len(truth) and text == truth[at]
            at += out[leaf]
    return out


def by_elements(trees: dom.Trees, page: int) -> dict[int, bool]:
    """Which runs of text of a page stand in its article or main element and in no boilerplate element."""
    out = {}
    for leaf in trees.texts:
        if trees.page[leaf] == page:
            above, k = set(), trees.parent[leaf]
            while k >= 0:
                above.add(trees.tag[k])
                k = trees.parent[k]
            out[leaf] = bool(above & {"article", "main"}) and not above & BOILERPLATE
    return out


@functools.lru_cache(maxsize=4)
def _made(count: int) -> tuple[tuple[str, tuple[str, ...]], ...]:
    return tuple((page, tuple(truth)) for page, truth in map(layouts.made_page, range(count)))


def fit(pages: list[str], made: int = MADE) -> Extractor:
    """The classifier from ``made`` made-up pages and the given ones, which have an article or main element."""
    trees, wanted = dom.Trees(), {}
    for k, (page, truth) in enumerate(_made(made)):
        trees.add(page)
        wanted |= labelled(trees, list(truth), k)
    for k, page in enumerate(pages):
        trees.add(page)
        wanted |= by_elements(trees, made + k)
    label, weight = _weights(trees, wanted)
    odds = dom.Odds.learned(trees, label, weight)
    return Extractor(odds, boosting.fit(dom.features(trees, odds), label, weight))


def train(pages: DataFrame, html_col: str = "html", made: int = MADE, per_table: int = PER_TABLE) -> Extractor:
    """Fit on made-up pages and a bounded sample of the table; the same pages whatever order they come in."""
    source = F.col(html_col)
    rows = pages.filter(source.rlike(r"(?i)<(article|main)[\s>]")).select(F.xxhash64(F.lit("pages"), source).alias("key"), source.alias("html"))
    keys = rows.select("key").distinct().orderBy("key").limit(per_table)
    found = rows.join(F.broadcast(keys), "key").groupBy("key").agg(F.first("html").alias("html")).collect()  # per_table pages
    return fit([r["html"] for r in sorted(found)], made)


def extracted(pages: DataFrame, model: Extractor, html_col: str = "html") -> DataFrame:
    """``pages`` with the columns ``text`` and ``n_chars``."""
    unused(pages, "text")
    unused(pages, "n_chars")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def text(sources: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for source in sources:
            out: list[str] = []
            for a, b in batches_of(source):
                out += shared.value.texts(strings(source.slice(a, b - a)))
            yield pa.array(out, pa.string())

    return pages.withColumn("text", text.asNondeterministic()(text_of(html_col))).withColumn("n_chars", F.length("text").cast("long"))


#: What the pages of the tables say themselves: each has one article element, made of headings and paragraphs, some left
#: open, whose texts hold a few references only. It knows nothing of the classifier, and serves pages of this shape only.
ORACLE_SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages
), b AS (
  SELECT page_id, url, list_transform(string_split_regex(body, '</?(?:p|h1)>'),
           lambda x: trim(regexp_replace(regexp_replace(replace(x, '<br>', ' '), '</?b>', '', 'g'), '\s+', ' ', 'g'))) AS blocks FROM a
), c AS (
  SELECT page_id, url, regexp_replace(replace(replace(replace(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10)),
           '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS text FROM b
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM c
"""
