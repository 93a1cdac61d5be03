"""Line dedup's stream, cut into batches and tasks at every place, against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from marelake.llm import line_dedup


def streamed(tasks, batch):
    """Dropped (hash, document, position) of sorted rows that lie in ``tasks``, read ``batch`` rows at a time."""
    seen = []
    for rows in tasks:
        held = line_dedup._Held(3)
        for at in range(0, len(rows), batch):
            seen += held.take(np.array(rows[at : at + batch], np.int64))
        seen += held.end()
    assert all(x.shape[1] == 5 for x in seen)
    seen = np.concatenate([np.empty((0, 5), np.int64), *seen]).tolist()
    heads = defaultdict(set)
    for h1, h2, doc, _, kind in seen:
        if kind == line_dedup.SUMMARY:
            heads[h1, h2].add(doc)
    dropped = [(h1, h2, d, p) for h1, h2, d, p, kind in seen if kind == line_dedup.DROP]
    dropped += [(h1, h2, d, p) for h1, h2, d, p, kind in seen if kind == line_dedup.OPEN and len(heads[h1, h2]) >= 3 and d < max(heads[h1, h2])]
    return sorted(dropped)


def by_hand(rows):
    docs = defaultdict(set)
    for h1, h2, d, _ in rows:
        docs[h1, h2].add(d)
    return sorted((h1, h2, d, p) for h1, h2, d, p in rows if len(docs[h1, h2]) >= 3 and d < max(docs[h1, h2]))


@pytest.mark.parametrize("seed", range(30))
def test_any_cut_gives_the_same(seed):
    r = random.Random(seed)
    rows = {(r.randint(1, 3), r.randint(1, 2), r.randint(1, 6), r.randint(0, 2)) for _ in range(r.choice([1, 4, 12, 40]))}
    rows = sorted(rows, key=lambda x: (x[0], x[1], -x[2], x[3]))
    for n in range(1, min(len(rows), 6) + 1):
        cuts = [0, *sorted(r.sample(range(1, len(rows)), n - 1)), len(rows)] if n > 1 else [0, len(rows)]
        tasks = [rows[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        for batch in (1, 2, 3, 1000):
            assert streamed(tasks, batch) == by_hand(rows)


def test_first_boundary_with_one_change():
    rows = [(1, 1, 9, 0), (1, 1, 8, 0), (2, 2, 7, 0)]
    assert streamed([rows], 1000) == by_hand(rows) == []
