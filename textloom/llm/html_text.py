"""HTML extraction: a linear-chain conditional random field tells the blocks of an article from the rest of a page.

Tags are 0 (rest) and 1 (article). A block's features are the elements above it
and the form of its text; neighbouring blocks are joined by transition weights.
The best sequence of tags of a page is found by the Viterbi recursion.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.dom_blocks import Block, Path, leaf_blocks
from textloom.llm.labelled_pages import MARK, labelled_pages

#: Pages of the table to learn from, on average, and the longest such page in characters: together the sample's bound.
TRAIN_PAGES = 400
TRAIN_CHARS = 20_000
#: Pages of usual layouts to learn from.
LAYOUT_PAGES = 1200
LAYOUT_SEED = 12
#: A feature of fewer training blocks is not learned.
LEAST_BLOCKS = 3
ROUNDS = 150
PENALTY = 0.1

#: Elements whose blocks are no article text even within an article.
ASIDE_TAGS = frozenset("nav aside footer form button noscript dialog menu".split())
#: The same by words of class, id and role.
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement banner comment comments cookie consent footer menu modal nav navigation newsletter notice "
    "popup promo related reply responses share sidebar social sponsor sponsored subscribe widget".split()
)
ONE_ARTICLE = re.compile(r"<(article|main)[\s>]", re.IGNORECASE)
SENTENCE_ENDS = tuple(".!?…。！？;:\"'”»")
SIGNS = "©|·•»›→@%"

RESULT = "page_id long, url string, text string, n_chars long"


class Model(NamedTuple):
    """Log weights of tag 1 against tag 0 per feature, and for a block whatever it is; of transitions; of a first tag 1."""

    weight: dict[str, float]
    bias: float
    move: np.ndarray
    start: float


def element_features(path: Path) -> list[str]:
    """Of one element above a block."""
    tag, names = path.element
    return [f"t:{tag}", *[f"n:{name}" for name in names]]


def leaf_features(path: Path | None) -> list[str]:
    """Of the innermost element."""
    if path is None:
        return ["l:"]
    tag = path.element.tag
    above = path.above.element.tag if path.above else ""
    return [f"l:{tag}", f"p:{above}>{tag}", *[f"o:{name}" for name in path.element.names]]


def text_features(block: Block, number: int, blocks: int, headed: bool) -> list[str]:
    """Of a block's text and of its place in the page."""
    text = block.text
    n = text.count(" ") + 1
    length = min(n.bit_length(), 8)
    share = block.linked / len(text)
    links = 0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3
    out = [
        f"w:{length}",
        f"k:{links}",
        f"wk:{length},{links}",
        f"e:{text.endswith(SENTENCE_ENDS)}",
        f"c:{min(text.count(','), 2)}",
        f"h:{headed}",
    ]
    if number == 0:
        out.append("first")
    if number == blocks - 1:
        out.append("last")
    out += [f"s:{sign}" for sign in SIGNS if sign in text]
    return out


def _is_heading(block: Block) -> bool:
    return block.path is not None and block.path.element.tag == "h1"


def block_features(blocks: list[Block]) -> list[list[str]]:
    """All features of each block of a page."""
    out, headed = [], False
    for i, block in enumerate(blocks):
        headed = headed or _is_heading(block)
        found, at = dict.fromkeys(leaf_features(block.path) + text_features(block, i, len(blocks), headed)), block.path
        while at is not None:
            found.update(dict.fromkeys(element_features(at)))
            at = at.above
        out.append(list(found))
    return out


def labels_of_article(page: str) -> tuple[list[Block], list[int]] | None:
    """The blocks of a page that names its article by an element, and which of them that article has.

    None for a page without such an element, or with several: these may be
    teasers or comments.
    """
    tags = [t.lower() for t in ONE_ARTICLE.findall(page)]
    if tags.count("article") != 1 and (tags.count("article") or tags.count("main") != 1):
        return None
    wanted = "article" if "article" in tags else "main"
    blocks = leaf_blocks(page)
    labels = []
    for block in blocks:
        at, inside, aside = block.path, False, False
        while at is not None:
            inside |= at.element.tag == wanted
            aside |= at.element.tag in ASIDE_TAGS or not ASIDE_NAMES.isdisjoint(at.element.names)
            at = at.above
        labels.append(int(inside and not aside))
    return blocks, labels


def labels_of_layout(page: str) -> tuple[list[Block], list[int]]:
    """The same for a page in which article blocks are marked."""
    blocks = leaf_blocks(page)
    labels = [int(b.text.startswith(MARK)) for b in blocks]
    return [b._replace(text=b.text.replace(MARK, "").strip() or " ") for b in blocks], labels


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def expectations(emission: np.ndarray, lengths: np.ndarray, move: np.ndarray, start: float):
    """Of sequences in rows (``emission`` of tag 1, padded): log of the sum over all taggings, and what is expected.

    Returns the logs, the probability of tag 1 per place, and the expected
    transitions, added up over all sequences. Forward and backward sums are kept
    as logs, so no length overflows.
    """
    n, longest = emission.shape
    e = np.stack([np.zeros_like(emission), emission], axis=2)
    forward, backward = np.empty((n, longest, 2)), np.zeros((n, longest, 2))
    forward[:, 0] = e[:, 0] + np.array([0.0, start])
    for t in range(1, longest):
        forward[:, t] = _log_sum(forward[:, t - 1, :, None] + move, 1) + e[:, t]
    for t in range(longest - 2, -1, -1):
        after = _log_sum(move + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
        backward[:, t] = np.where((t + 1 < lengths)[:, None], after, 0.0)
    rows = np.arange(n)
    total = _log_sum(forward[rows, lengths - 1], 1)
    inside = np.arange(longest) < lengths[:, None]
    one = np.where(inside, np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None]), 0.0)
    pairs = forward[:, :-1, :, None] + move + (e + backward)[:, 1:, None, :] - total[:, None, None, None]
    return total, one, np.exp(np.where(inside[:, 1:, None, None], pairs, -np.inf)).sum(axis=(0, 1))


def fit(pages: list[tuple[list[Block], list[int]]]) -> Model:
    """The field that makes the labels of these pages likeliest, weights penalised by their squares; Adam steps."""
    pages = [p for p in pages if p[0]]
    if not pages:
        return Model({}, -1.0, np.zeros((2, 2)), 0.0)
    features = [block_features(blocks) for blocks, _ in pages]
    counts = Counter(f for page in features for block in page for f in block)
    names = sorted(f for f, n in counts.items() if n >= LEAST_BLOCKS)
    number = {f: i for i, f in enumerate(names)}
    lengths = np.array([len(page) for page in features])
    flat = np.concatenate([labels for _, labels in pages]).astype(float)  # of all blocks in a row
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    page_of = np.repeat(np.arange(len(pages)), lengths)
    rows, columns = [], []  # block and feature
    for block, found in enumerate(f for page in features for f in page):
        own = [number[f] for f in found if f in number]
        rows += [block] * len(own)
        columns += own
    rows, columns = np.array(rows, np.int64), np.array(columns, np.int64)
    # Pages of like length go through the passes together, padded to the longest of them.
    order = np.argsort(lengths, kind="stable")
    groups = []
    for own in np.split(order, np.flatnonzero(np.diff(np.ceil(np.log2(lengths[order] + 1)))) + 1):
        member = np.full(len(pages), -1)
        member[own] = np.arange(len(own))
        at = np.flatnonzero(member[page_of] >= 0)
        groups.append((lengths[own], at, (member[page_of[at]], place[at])))
    first = place == 0
    seen = np.bincount(columns, weights=flat[rows], minlength=len(names))
    seen_pairs = np.zeros((2, 2))
    right = np.flatnonzero(~first)
    np.add.at(seen_pairs, (flat[right - 1].astype(int), flat[right].astype(int)), 1)
    m, n = len(names), len(pages)
    theta, speed, power = np.zeros(m + 6), np.zeros(m + 6), np.zeros(m + 6)
    for step in range(1, ROUNDS + 1):
        emission = theta[m] + np.bincount(rows, weights=theta[columns], minlength=len(flat))
        one, pairs = np.empty(len(flat)), np.zeros((2, 2))
        for size, at, cell in groups:
            padded = np.zeros((len(size), int(size.max())))
            padded[cell] = emission[at]
            _, likely, moves = expectations(padded, size, theta[m + 1 : m + 5].reshape(2, 2), theta[m + 5])
            one[at] = likely[cell]
            pairs += moves
        expected = np.bincount(columns, weights=one[rows], minlength=m)
        gradient = np.concatenate(
            [seen - expected, [flat.sum() - one.sum()], (seen_pairs - pairs).ravel(), [flat[first].sum() - one[first].sum()]]
        )
        gradient = (gradient - PENALTY * theta) / n
        speed = 0.9 * speed + 0.1 * gradient
        power = 0.99 * power + 0.01 * gradient**2
        theta = theta + 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.99**step)) + 1e-8)
    return Model(dict(zip(names, theta[:m].tolist())), float(theta[m]), theta[m + 1 : m + 5].reshape(2, 2), float(theta[m + 5]))


class Reader:
    """A model's view of blocks: weights of elements are looked up once per page and element."""

    def __init__(self, model: Model):
        self.model = model

    def _above(self, path: Path | None) -> tuple[float, frozenset]:
        """Sum over the distinct known features of all elements above, and these; kept at the element."""
        missing = []
        while path is not None and path.known is None:
            missing.append(path)
            path = path.above
        total, known = path.known if path is not None else (0.0, frozenset())
        weight = self.model.weight
        for p in reversed(missing):
            new = [f for f in dict.fromkeys(element_features(p)) if f in weight and f not in known]
            if new:
                total, known = total + sum(weight[f] for f in new), known.union(new)
            p.known = total, known
        return total, known

    def emissions(self, blocks: list[Block]) -> list[float]:
        """Log weight of tag 1 against tag 0 per block."""
        weight, out, headed = self.model.weight.get, [], False
        for i, block in enumerate(blocks):
            headed = headed or _is_heading(block)
            own = leaf_features(block.path) + text_features(block, i, len(blocks), headed)
            out.append(self.model.bias + self._above(block.path)[0] + sum(weight(f, 0.0) for f in own))
        return out

    def article(self, page: str | None) -> str:
        """The blocks tagged as article, joined by line feeds."""
        blocks = leaf_blocks(page)
        if not blocks:
            return ""
        tags = viterbi(self.emissions(blocks), self.model.move, self.model.start)
        return "\n".join(b.text for b, t in zip(blocks, tags) if t)


def viterbi(emission: list[float], move: np.ndarray, start: float) -> list[int]:
    """The likeliest tags of a sequence; of equally likely ones the smaller tag, from the last place on."""
    (m00, m01), (m10, m11) = move.tolist()
    zero, one = 0.0, start + emission[0]
    back = []
    for e in emission[1:]:
        from_zero = (zero + m00 < one + m10, zero + m01 < one + m11)
        back.append(from_zero)
        zero, one = max(zero + m00, one + m10), max(zero + m01, one + m11) + e
    tag = int(one > zero)
    tags = [tag]
    for step in reversed(back):
        tag = int(step[tag])
        tags.append(tag)
    return tags[::-1]


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES, train_chars: int = TRAIN_CHARS, layout_pages: int = LAYOUT_PAGES) -> Model:
    """Learn from pages of usual layouts, and from about ``train_pages`` rows of ``pages (html)`` that name their article.

    The rows are chosen by a hash of their text among those of at most
    ``train_chars`` characters, so the driver gets a bounded sample; the labels of
    a row are those of its ``article`` or ``main`` element.
    """
    known = [labels_of_layout(p) for p in labelled_pages(layout_pages, LAYOUT_SEED)]
    html = F.col("html").cast("string")
    rows = pages.select(html.alias("html")).where(F.length("html").between(1, train_chars)).where(F.col("html").rlike("(?i)<(article|main)[ >]"))
    total = rows.count()
    draw = F.pmod(F.xxhash64("html", F.lit(LAYOUT_SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.where(draw < train_pages / max(1, total)).orderBy("html").limit(2 * train_pages) if total else rows.limit(0)
    named = [labels_of_article(r["html"]) for r in drawn.collect()]
    return fit(known + [p for p in named if p is not None])


def main_texts(pages: DataFrame, model: Model) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages (page_id, url, html)``: the article of each page.

    Pages are read where they lie, whole and one by one. A block is a run of text
    between block tags, with character references decoded and white space
    (as ``\\s`` has it, no-break spaces too) joined to one blank; a line break is
    white space. Blocks that the field tags as article are joined by line feeds in
    page order.

    A null or empty page, or one without article blocks, has an empty text. Every
    row gives a row, repeated ones and those without page_id too. An empty table
    gives an empty one. Other columns are not looked at.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def extract(batches):
        reader = Reader(shared.value)
        for batch in batches:
            texts = [reader.article(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), *[F.col(c).cast("string").alias(c) for c in ("url", "html")])
    return rows.mapInArrow(extract, RESULT)
