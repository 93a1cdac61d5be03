"""Ranked lexical search against a plain score of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from marelake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, n int, row string, shard double", "item_id long, text string, rank int"


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, k=10):
    counts = [(i, Counter(words(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(w for _, c, _ in counts for w in c)
    out = []
    for item_id, text in items:
        scored = []
        for i, c, n in counts:
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m)) for w in set(words(text)) if c[w]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item_id, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def search(spark, docs, items, **how):
    d = spark.createDataFrame([(i, t, 1, "x", 0.5) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    return sorted(map(tuple, lexical.search(d.repartition(5), q, **how).collect()), key=repr)


@pytest.fixture(scope="module")
def odd():
    r = random.Random(5)
    vocabulary = [f"w{int(r.paretovariate(0.8)) % 400}" for _ in range(5000)]
    docs = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 3, 20, 60])))) for i in range(700)]
    docs += [(1000 + i, "Common passage W1 of W2; many-copies é É") for i in range(300)]  # ties
    docs += [(7, docs[7][1]), (7, "w3 w3 w3"), (None, "w3 w4 only"), (None, None), (5000, None), (5001, ""), (5002, " \n--_!"), (5003, "\0w1\0ÉÄ\x7f" * 3)]
    docs += [(6000, "w1 w5 " * 60_000 + "rareword")]
    items = [(i, " ".join(r.choices(vocabulary, k=r.choice([1, 5, 30])))) for i in range(25)]
    items += [(100, "common PASSAGE many copies"), (101, None), (102, ""), (103, "absentword"), (104, "rareword w5"), (3, "w3 w4"), (None, "éÄ É"), (105, "É w1 w1 w1")]
    return docs, items


@pytest.mark.parametrize("how", [{}, {"shard_postings": 300}, {"block_terms": 40, "shard_postings": 2000}, {"k": 3}])
def test_search(spark, odd, how):
    docs, items = odd
    assert search(spark, docs, items, **how) == by_hand(docs, items, how.get("k", 10))


def test_nothing_to_search(spark):
    assert search(spark, [], [(1, "a")]) == [] and search(spark, [(1, "a b"), (2, None)], []) == []
    assert search(spark, [(1, ""), (2, None)], [(1, "a")]) == [] and search(spark, [(1, "a")], [(1, None)]) == []


def shard_of(seed, n_docs, n_terms, skew):
    r = np.random.default_rng(seed)
    pairs = np.unique(np.column_stack([r.integers(0, n_docs, 6 * n_docs), (r.pareto(skew, 6 * n_docs) * 2).astype(int) % n_terms]), axis=0)
    return pairs[:, 0], pairs[:, 1], r.integers(1, 40 if seed % 2 else 900_000, len(pairs))


@pytest.mark.parametrize("seed", range(12))
def test_best_positions_stop_no_later_and_lose_nothing(seed):
    r = random.Random(seed)
    doc, term, imp = shard_of(seed, r.choice([3, 50, 4000]), 40, 0.7)
    shard = lexical.Shard(doc, term, imp, int(doc.max()) + 1)
    for _ in range(10):
        query = [(t, r.choice([0, 1, 700, 9000])) for t in r.sample(range(45), r.choice([1, 3, 8]))]
        scores = Counter()
        for d, t, x in zip(doc.tolist(), term.tolist(), imp.tolist(), strict=True):
            scores[d] += dict(query).get(t, 0) * x
        want = sorted(((-s, d) for d, s in scores.items() if s > 0))[:10]
        found, got, read = shard.top(query, 10, block=4)
        assert [(-s, d) for d, s in zip(found.tolist(), got.tolist(), strict=True)] == want
        other, _, last_read = shard.top(query, 10, block=4, best_positions=False)
        assert other.tolist() == found.tolist() and read <= last_read


def test_bound_leaves_positions_unread():
    """One list falls steeply, so most of it is never read; a tie with the k-th score is read on."""
    n = 5000
    doc = np.arange(n)
    shard = lexical.Shard(doc, np.zeros(n, np.int64), n - doc, n)
    assert shard.top([(0, 1)], 10, block=16)[2] < 100
    level = lexical.Shard(doc, np.zeros(n, np.int64), np.full(n, 9), n)
    found, _, read = level.top([(0, 1)], 10, block=16)
    assert found.tolist() == list(range(10)) and read == n


def test_direct_accesses_push_the_best_position_on():
    """The upper half of both lists holds the same documents, in opposite order: looking up one list's block sees the other's."""
    n = 1000
    doc = np.concatenate([np.arange(n), np.arange(n)])
    term = np.repeat([0, 1], n)
    up = np.concatenate([np.arange(n), np.concatenate([np.arange(n // 2), n // 2 + np.arange(n // 2)[::-1]])])
    shard = lexical.Shard(doc, term, up + 1, n)
    best, last = shard.top([(0, 1), (1, 1)], 10, block=8), shard.top([(0, 1), (1, 1)], 10, block=8, best_positions=False)
    assert best[0].tolist() == last[0].tolist() and best[2] <= last[2]
