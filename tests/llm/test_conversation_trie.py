"""The conversation trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from marelake.llm import conversation_trie as ct

ROWS = "conv_id long, turn long, role string, text string, level int, block string"


def by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, key, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + mine[h:]
    nodes = defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
    children, below, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    for p, held in nodes.items():
        for d in range(len(p) + 1):
            below[p[:d]] += (len(held) - 1) * (words(p[-1][1]) if p else 0)
            leaves[p[:d]] += not children[p]
    out = []
    for p, held in nodes.items():
        ends = ",".join(str(c) for c in sorted(held) if len(built[c]) == len(p))
        out.append((min(held), len(p), min(nodes[p[:-1]]) if p else None, len(held), children[p], leaves[p], below[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], ROWS)
    return sorted(map(tuple, ct.trie(df.repartition(4), **how).collect()), key=repr)


@pytest.fixture(scope="module")
def odd():
    r = random.Random(11)
    lines = ["hello there", "how are you", "", "  ", "fine\tthanks\n a lot", "x", "é ü", None]
    rows = []
    for c in range(130):
        for t in range(r.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, r.choice(["user", "assistant", None]) if t > 1 else "user", r.choice(lines[: 2 + t])))
    for c in range(200, 290):  # one conversation that many repeat, with its first turns at 200
        rows += [(c, t, "user", f"the same {t}") for t in range(4)]
    rows += [(300, None, "user", "first"), (300, 5, "a", "tie 1"), (300, 5, "a", "tie 2"), (300, 5, "a", "tie 1"), (300, -3, None, "early")]
    rows += [(-7, 0, "user", "below zero"), (-7, 1, "user", "more"), (-20, 0, "u", "a b c"), (-25, 1, "u", "z"), (None, 0, "user", "nobody")]
    rows += [(511, 0, "user", "its opening conversation is absent"), (512, 0, "u", "a"), (513, 0, "u", "a"), (514, 0, "u", "a"), (515, 0, "u", "a")]
    for c in (600, 601, 602, 640, 641):  # long ones, equal up to somewhere
        rows += [(c, t, "user", "long " * (t % 3) + str(t if t < 37 or c < 602 else -c)) for t in range(60 if c % 2 else 48)]
    rows += [(700, 0, "user", "w " * 200_000), (701, 0, "user", "w " * 200_000)]
    return rows


@pytest.mark.parametrize("how", [{}, {"turns_per_row": 4}, {"turns_per_row": 7, "block_turns": 5}, {"turns_per_row": 1, "block_turns": 30}, {"block_turns": 1}])
def test_trie(spark, odd, how):
    assert trie(spark, odd, **how) == by_hand(odd)


def test_few(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "a", "b")]) == []
    for rows in ([(1, 0, "a", "b")], [(4, 0, "a", "b"), (4, 0, "a", "b")], [(1, 0, "u", "x"), (2, 0, "u", "x"), (3, 0, "u", "x"), (5, 0, "u", "x")]):
        assert trie(spark, rows) == by_hand(rows)


def test_one_conversation_over_many_tasks(spark):
    rows = [(40, t, "user", f"turn {t % 5}") for t in range(220)] + [(41, t, "user", f"turn {t % 5}") for t in range(90)]
    assert trie(spark, rows, turns_per_row=16, block_turns=40) == by_hand(rows)


def test_extents_against_a_walk():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 65):
        values = r.integers(-1, 4, n)
        table = ct.RangeMin(values)
        at, d = np.repeat(np.arange(n), 5), np.tile(np.arange(5), n)
        values[0] = -1
        table = ct.RangeMin(values)
        for i, x, left, right in zip(at, d, table.left(at, d), table.right(at, d), strict=True):
            a = b = i
            while values[a] >= x:
                a -= 1
            while b + 1 < n and values[b + 1] >= x:
                b += 1
            assert (left, right) == (a, b)
        a, b = np.triu_indices(n)
        assert table.least(a, b + 1).tolist() == [values[i : j + 1].min() for i, j in zip(a, b, strict=True)]
