"""Main text of HTML pages: a linear-chain conditional random field over the leaf blocks of a page.

A page is read into its leaf blocks, each with its ancestor elements and their names.  The field has two labels,
article and rest; a block's features (ancestor tags, names, length, share of link text, place) score its label, and
label pairs score neighbours.  It is trained to the maximum of the conditional likelihood on labelled pages, and a
page's best labelling is decoded by Viterbi's algorithm.  Training is a few seconds of numpy on a fixed number of
labelled pages; pages are extracted where they lie, without a shuffle.

The given tables hold no labels, so the labelled pages come from the grammar in ``html_pages``, in which every block
knows the part of the page it belongs to; ``train`` takes any other labelled pages as well.

Defined results: null and empty pages, and pages without an article, give the empty text with 0 characters; very long
pages are read whole; of two labellings of equal weight the one with fewer article blocks at the end is taken; repeated
rows give repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map
from .html_pages import Block, blocks, features, labelled_pages

PAGES, SEED = 600, 11


class Field:
    """Feature weights for label 1 against label 0, and the 2 x 2 weights of neighbours."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, pairs: np.ndarray):
        self.names, self.weights, self.pairs = names, weights, pairs

    def decode(self, page: list[Block]) -> list[int]:
        score = [sum(float(self.weights[self.names[n]]) for n in set(f) if n in self.names) for f in features(page)]
        (a, b), (c, d) = self.pairs.tolist()
        zero, one, back = 0.0, score[0], []
        for s in score[1:]:
            from_zero, from_one = zero + a >= one + c, zero + b > one + d
            zero, one = (zero + a if from_zero else one + c), s + (zero + b if from_one else one + d)
            back.append((0 if from_zero else 1, 0 if from_one else 1))
        labels = [int(one > zero)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 120, shrink: float = 0.5, least: int = 3) -> Field:
    """Maximum conditional likelihood with an L2 prior, by gradient steps with momentum over all pages at once."""
    rows = [[set(f) for f in features(page)] for page, _ in pages if page]
    labels = [y for page, y in pages if page]
    counts: dict[str, int] = {}
    for page in rows:
        for f in page:
            for n in f:
                counts[n] = counts.get(n, 0) + 1
    names = {n: i for i, n in enumerate(sorted(n for n, k in counts.items() if k >= least))}
    n_pages, longest = len(rows), max(map(len, rows))
    at_page, at_block, at_feature = [], [], []
    y, there = np.zeros((n_pages, longest), int), np.zeros((n_pages, longest), bool)
    for p, page in enumerate(rows):
        y[p, : len(page)], there[p, : len(page)] = labels[p], True
        for t, f in enumerate(page):
            own = [names[n] for n in f if n in names]
            at_page += [p] * len(own)
            at_block += [t] * len(own)
            at_feature += own
    where, at_feature = np.array(at_page) * longest + np.array(at_block), np.array(at_feature)
    size = len(names)
    theta, first, second = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    for step in range(1, rounds + 1):
        unary = np.zeros((n_pages, longest, 2))
        unary[..., 1] = np.bincount(where, theta[at_feature], n_pages * longest).reshape(n_pages, longest)
        pairs = theta[size:].reshape(2, 2)
        ahead, behind = np.zeros_like(unary), np.zeros_like(unary)
        ahead[:, 0] = unary[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(ahead[:, t - 1, 0, None] + pairs[0], ahead[:, t - 1, 1, None] + pairs[1]) + unary[:, t]
            ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        for t in range(longest - 2, -1, -1):
            later = unary[:, t + 1] + behind[:, t + 1]
            new = np.logaddexp(later[:, 0, None] + pairs[:, 0], later[:, 1, None] + pairs[:, 1])
            behind[:, t] = np.where(there[:, t + 1, None], new, 0.0)
        marginal = np.exp(ahead + behind - total[:, None, None])[..., 1] * there
        both = np.exp(np.minimum(0, ahead[:, :-1, :, None] + pairs + (unary + behind)[:, 1:, None, :] - total[:, None, None, None])) * there[:, 1:, None, None]
        gradient = np.empty(size + 4)
        gradient[:size] = np.bincount(at_feature, ((y - marginal) * there).reshape(-1)[where], size)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[:, :-1][there[:, 1:]], y[:, 1:][there[:, 1:]]), 1)
        gradient[size:] = (seen - both.sum((0, 1))).reshape(-1)
        gradient -= shrink * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        theta += 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Field(names, theta[:size], theta[size:].reshape(2, 2))


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return "\n\n".join(b.text for b, label in zip(found, field.decode(found), strict=True) if label)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    model = field or train(labelled_pages(PAGES, SEED))

    def one(batch):
        text = [main_text(h, model) for h in batch.column("html").to_pylist()]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": text, "n_chars": [len(t) for t in text]}

    return arrow_map(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), one, "page_id long, url string, text string, n_chars long")
