"""Main text of web pages: boosted trees score the elements of a page, one decision for the whole tree picks the article."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopline.llm.common import cut
from stopline.llm.dom import Page, parse

#: Pages that are learned from, at most, of those that name their parts; which ones, a hash of the id decides.
SAMPLE = 400
#: Words in class, id and role that mark what is no article, and what is (fixed values).
AROUND = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adsbox advert advertisement banner sponsor sponsored promo "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup share sharing social related recommended "
    "more comment comments reply replies disqus breadcrumb breadcrumbs pagination pager widget toolbar login search skip copyright "
    "legal disclaimer complementary contentinfo".split()
)
INSIDE = frozenset("article content main post entry story body text".split())
AROUND_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
INSIDE_TAGS = frozenset(("article", "main"))
_GROUPS = (
    ("p", "blockquote", "pre"),
    ("h1", "h2", "h3", "h4", "h5", "h6"),
    ("ul", "ol", "li", "dl", "dt", "dd"),
    ("table", "tr", "td", "th", "tbody", "thead"),
    ("div", "section"),
    ("figure", "figcaption"),
    tuple(INSIDE_TAGS),
    tuple(AROUND_TAGS),
)
#: The place of the depth, and the one from which on features are names of tags and attributes, own or of ancestors.
_DEPTH, _NAMED = 7, 13


def _marks(node) -> tuple[bool, bool]:
    around = node.tag in AROUND_TAGS or node.hidden or not AROUND.isdisjoint(node.tokens)
    return around, node.tag in INSIDE_TAGS or not INSIDE.isdisjoint(node.tokens)


def described(page: Page) -> np.ndarray:
    """A row of features for each element: lengths, densities, place among siblings, tags and attributes."""
    nodes = page.nodes
    n = len(nodes)
    parent = np.array([x.parent for x in nodes])
    own = np.array([[x.chars, x.link_chars, x.stops, 1] for x in nodes], float)
    whole = own.copy()
    for i in range(n - 1, 0, -1):
        whole[parent[i]] += whole[i]
    before = np.concatenate([[0], np.cumsum(own[:, 0])])[:-1]
    size = np.array([len(nodes[p].children) if p >= 0 else 1 for p in parent])
    place = np.zeros(n)
    alike = np.ones(n)
    around, inside = np.zeros(n, bool), np.zeros(n, bool)
    marks = [_marks(x) for x in nodes]
    for i, node in enumerate(nodes):
        tags = [nodes[c].tag for c in node.children]
        times = Counter(tags)
        for k, c in enumerate(node.children):
            place[c] = k / max(1, len(tags) - 1)
            alike[c] = times[tags[k]]
        if i:
            up = node.parent
            around[i], inside[i] = around[up] or marks[up][0], inside[up] or marks[up][1]
    siblings = np.where(parent >= 0, (whole[parent, 0] - whole[:, 0]) / np.maximum(1, size - 1), 0)
    columns = [
        np.log1p(own[:, 0]),
        np.log1p(whole[:, 0]),
        own[:, 1] / np.maximum(1, own[:, 0]),
        whole[:, 1] / np.maximum(1, whole[:, 0]),
        whole[:, 0] / whole[:, 3],
        whole[:, 2] / np.maximum(1, whole[:, 0]),
        np.log1p(whole[:, 3]),
        [x.depth for x in nodes],
        np.log1p(size),
        place,
        alike / size,
        np.log1p(siblings),
        before / max(1, own[:, 0].sum()),
        [m[0] for m in marks],
        [m[1] for m in marks],
        around,
        inside,
        [x.hidden for x in nodes],
        *([x.tag in group for x in nodes] for group in _GROUPS),
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1)


def lessons(page: Page) -> list[bool]:
    """What a page that names its parts says of its elements: inside an article, and in nothing that surrounds one."""
    said: list[tuple[bool, bool]] = []
    for node in page.nodes:
        above = said[node.parent] if said else (False, False)
        around, inside = _marks(node)
        said.append((above[0] or around, above[1] or inside))
    return [inside and not around for around, inside in said]


def _variants(given: np.ndarray, labels: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Each element three times, so that one layout's habits are not all that is learned.

    As it is; with the shape of another element of the page, which leaves the names to decide, and for a third of them a
    name that marks what is no article, own or of an ancestor, wherever they stand; and without names, which leaves the
    shape. How deep a page starts is drawn anew for each.
    """
    draw = np.random.default_rng(seed)
    named, bare, renamed = given.copy(), given.copy(), labels.copy()
    named[:, :_NAMED] = draw.permutation(named[:, :_NAMED])
    for place in (_NAMED, _NAMED + 2):
        chosen = draw.random(len(given)) < 1 / 6
        named[chosen, place] = 1
        renamed[chosen] = 0
    bare[:, _NAMED:] = 0
    variants = [given.copy(), named, bare]
    for x in variants:
        x[:, _DEPTH] += draw.integers(0, 8)
    return np.concatenate(variants), np.concatenate([labels, renamed, labels])


def _naming(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            part = batch.slice(i, 200)
            yield part.filter(pa.array([any(lessons(parse(source or ""))) for source in part["html"].to_pylist()], pa.bool_()))


def naming(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Of the pages that name their parts the first ``sample`` in the order of a hash, all of them if there are fewer.

    A page names its parts if some element is inside an article and in nothing that surrounds one. Pages are tested from the
    smallest hash on, eight times as many in each round until there are enough or all have been tested.
    """
    hashed = pages.select("page_id", "html", F.xxhash64("page_id").alias("_hash"))
    n, tested = pages.count(), 4 * sample
    while True:
        part = hashed if tested >= n else hashed.filter(F.col("_hash") < 2**64 * tested // n - 2**63)
        some = cut(part.mapInArrow(_naming, hashed.schema).orderBy("_hash", "page_id").limit(sample))
        if tested >= n or some.count() >= sample:
            return some.drop("_hash")
        tested *= 8


def _lesson_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, labels = [], []
        for source in batch["html"].to_pylist():
            page = parse(source or "")
            given = _variants(described(page), np.array(lessons(page), float), zlib.crc32((source or "").encode()))
            rows += given[0].tolist()
            labels += given[1].tolist()
        yield pa.RecordBatch.from_pydict({"features": pa.array(rows, pa.list_(pa.float64())), "label": pa.array(labels, pa.float64())})


@dataclass(frozen=True)
class Trees:
    """Boosted trees as arrays: for each tree the feature, threshold and children of its nodes; feature -1 is a leaf."""

    trees: tuple[tuple[np.ndarray, ...], ...]
    weights: tuple[float, ...]
    always: float | None = None

    def chance(self, rows: np.ndarray) -> np.ndarray:
        if self.always is not None:
            return np.full(len(rows), self.always)
        total = np.zeros(len(rows))
        for (feature, threshold, left, right, value), weight in zip(self.trees, self.weights, strict=True):
            at = np.zeros(len(rows), np.int64)
            while (inner := feature[at] >= 0).any():
                goes = rows[np.arange(len(rows)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(goes, left[at], right[at]), at)
            total += weight * value[at]
        return 1 / (1 + np.exp(-2 * total))


def _arrays(tree) -> tuple[np.ndarray, ...]:
    nodes: list[list[float]] = []

    def add(node) -> int:
        i = len(nodes)
        nodes.append([-1, 0, 0, 0, node.prediction()])
        if node.subtreeDepth() > 0:
            split = node.split()
            nodes[i][:2] = [split.featureIndex(), split.threshold()]
            nodes[i][2], nodes[i][3] = add(node.leftChild()), add(node.rightChild())
        return i

    add(tree._java_obj.rootNode())
    table = np.array(nodes)
    return (*(table[:, c].astype(t) for c, t in ((0, int), (1, float), (2, int), (3, int), (4, float))),)


def learned(pages: DataFrame, sample: int = SAMPLE) -> Trees:
    """Boosted trees learned from the elements of at most ``sample`` pages that name their parts, each in three variants.

    Pages that don't name them teach nothing, since what is the article in them is not known. If no page of the table does
    (as when there are no pages), nothing can be learned, every element counts as the article's, and all text stays.
    """
    some = naming(pages, sample).repartition(8)
    rows = cut(some.mapInArrow(_lesson_rows, "features array<double>, label double").select(array_to_vector("features").alias("features"), "label"))
    if rows.select("label").distinct().count() < 2:
        return Trees((), (), 1.0)
    model = GBTClassifier(maxIter=12, maxDepth=5, stepSize=0.3, seed=7).fit(rows)
    return Trees(tuple(_arrays(t) for t in model.trees), tuple(model.treeWeights))


def decided(page: Page, chance: np.ndarray) -> list[bool]:
    """Which elements stay: the likeliest choice in which nothing stays inside an element that goes.

    From the leaves up, an element's best score if it stays adds for each child the better of staying and going with all
    that is in it; from the root down the better is taken. An element counts by the logarithm of its own text.
    """
    nodes = page.nodes
    weight = np.array([0.25 + np.log1p(x.chars) for x in nodes])
    chance = np.clip(chance, 1e-4, 1 - 1e-4)
    stay, go = weight * np.log(chance), weight * np.log(1 - chance)
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        stay[up] += max(stay[i], go[i])
        go[up] += go[i]
    kept = [True] * len(nodes)
    for i in range(1, len(nodes)):
        kept[i] = kept[nodes[i].parent] and not nodes[i].hidden and bool(stay[i] >= go[i])
    if nodes[0].chars and nodes[0].chars * np.log(chance[0] / (1 - chance[0])) < 0 and len(nodes) > 1:
        kept[0] = False  # text outside of any element
    return kept


def main_text(source: str | None, trees: Trees) -> str:
    page = parse(source or "")
    return page.text(decided(page, trees.chance(described(page))))


def extracted(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row: the main text's blocks, one a line; empty if there is none.

    Null and empty pages have no text. Character references are decoded, white space inside a block is one space. Repeated
    rows are answered each. The trees are some kilobytes and go along with the tasks; pages are not shuffled.
    """
    trees = learned(pages, sample)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                part = batch.slice(i, 200)
                parsed = [parse(h or "") for h in part["html"].to_pylist()]
                rows = [described(p) for p in parsed]
                chances = np.split(trees.chance(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
                texts = [p.text(decided(p, c)) for p, c in zip(parsed, chances, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {"page_id": part["page_id"], "url": part["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
                )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(read, "page_id long, url string, text string, n_chars long")
