"""SimHash near-duplicates through a forest of vantage-point trees over Hamming distance.

Fingerprints that differ in at most ``radius`` bits are linked.  Documents first fold into different fingerprints,
so exact copies, however many, are one row of the search.  A bounded sample of fingerprints fits the trees; every
fingerprint is then sent to its shard of each tree, and within a shard all pairs within the radius are found.

In a space of 64 fair bits nearly all distances lie near 32, so a ball of radius 2 crosses about half of all
splits of a single tree and every fingerprint would visit most shards.  The bits are therefore parted in
``radius + 1`` blocks: two linked fingerprints agree in at least one whole block.  The tree of a block measures
distance in that block only, where the query radius is 0 and the triangle bound prunes every other branch.  Where a
block no longer tells fingerprints apart (a group of near copies), the tree goes on with the whole distance and the
whole radius; there a fingerprint also visits the shards whose boundary its ball crosses.

Defined results: null and empty texts have fingerprint zero and are linked; rows that repeat a ``doc_id`` are linked
when their fingerprints are; a document without ``doc_id`` gets a fingerprint, and a component only from documents
that have one; very long texts are hashed in chunks of ``CHUNK`` shingles; an empty table gives an empty result; other
columns are ignored, and stay in ``keep_one``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, documents, store, to_numpy
from .components import components

#: shingles hashed before their bits are counted, which bounds the memory of very long texts
CHUNK = 50_000


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """The SimHash of UTF-8 text over hashes of its word shingles; ``bytes`` splits and lower-cases ASCII only."""
    from xxhash import xxh64_intdigest as digest

    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    first = np.cumsum(size + 1) - size - 1
    n = max(1, len(tokens) - words + 1)
    last = (first + size)[-n:].tolist()
    first = first[:n].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = [digest(joined[a:b], seed) for a, b in zip(first[at : at + CHUNK], last[at : at + CHUNK], strict=True)]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) with the 64 bits as a signed long."""

    def one(batch):
        found = [fingerprint(t.as_buffer().to_pybytes(), words, seed) for t in batch.column("text")]
        return {"doc_id": batch.column("doc_id"), "fp": np.array(found, np.uint64).view(np.int64)}

    return arrow_map(documents(docs), one, "doc_id long, fp long")


def _blocks(n: int) -> list[int]:
    cuts = [64 * i // n for i in range(n + 1)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


class Tree:
    """A vantage-point tree as arrays; a node is (mask, vantage point, distance of the split, slack), leaves are shards.

    ``slack`` is the query radius in the node's metric: a point goes left within the split distance, and a query
    goes to each side that the triangle bound cannot rule out.
    """

    def __init__(self, sample: np.ndarray, mask: int, radius: int, leaf: int, seed: int):
        self.nodes: list[tuple[np.uint64, np.uint64, int, int, int, int]] = []
        self.leaves = 0
        self.random = np.random.default_rng(seed)
        self.root = self._grow(sample, np.uint64(mask), 0, radius, leaf)

    def _grow(self, points, mask, slack, radius, leaf) -> int:
        """A node's number, or a shard's as its complement."""
        if len(points) > leaf:
            for vantage in self.random.choice(points, 4):
                far = np.bitwise_count((points ^ vantage) & mask)
                split = int(np.median(far))
                left = far <= split
                if left.all():
                    split -= 1
                    left = far <= split
                if left.any():
                    node = len(self.nodes)
                    self.nodes.append(())
                    below = [self._grow(points[side], mask, slack, radius, leaf) for side in (left, ~left)]
                    self.nodes[node] = (mask, vantage, split, slack, *below)
                    return node
            if slack < radius:
                return self._grow(points, np.uint64(2**64 - 1), radius, radius, leaf)
        self.leaves += 1
        return ~(self.leaves - 1)

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the point, shard, whether the shard is its home) for all shards that its ball may touch."""
        out, todo = [], [(self.root, np.arange(len(points)), np.ones(len(points), bool))]
        while todo:
            node, at, home = todo.pop()
            if not len(at):
                continue
            if node < 0:
                out.append((at, np.full(len(at), ~node), home))
                continue
            mask, vantage, split, slack, left, right = self.nodes[node]
            far = np.bitwise_count((points[at] ^ vantage) & mask).astype(np.int64)
            inside = far <= split
            to = inside | (far <= split + slack)
            todo.append((left, at[to], home[to] & inside[to]))
            to = ~inside | (far + slack > split)
            todo.append((right, at[to], home[to] & ~inside[to]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` points."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _flips(mask: int, radius: int) -> tuple[int, Iterator[np.uint64]]:
    """How many values differ from one in 1 to ``radius`` bits outside ``mask``, and the bits that differ."""
    bits = [1 << b for b in range(64) if not mask >> b & 1]
    number = sum(comb(len(bits), d) for d in range(1, radius + 1))
    return number, (np.uint64(sum(some)) for d in range(1, radius + 1) for some in combinations(bits, d))


def shard_links(fp: np.ndarray, home: np.ndarray, radius: int, mask: np.uint64, longest: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all points of a shard within the radius, at least one of a pair at home here.

    Points are ordered by the bits of the shard's metric when its query radius is 0: only equal ones can be
    linked.  Neighbours at ever larger steps are compared as long as any such pair is left.  In a run of more than
    ``longest`` equal ones, such as a dense group that no vantage point splits, every point instead looks up the
    values its ball holds, so the work grows with the points and not with their pairs.  Links are folded to their
    components on the way, so a dense group never holds all of its pairs.
    """
    order = np.argsort(fp & mask, kind="stable")
    fp, key = fp[order], (fp & mask)[order]
    at_home = home[order]
    a, b, n_links = [], [], 0

    def link(one: np.ndarray, other: np.ndarray) -> None:
        nonlocal a, b, n_links
        held = at_home[one] | at_home[other]
        if held.any():
            a.append(one[held])
            b.append(other[held])
            n_links += len(a[-1])
        if n_links > 2_000_000:
            root = _roots(len(fp), np.concatenate(a), np.concatenate(b))
            moved = np.flatnonzero(root != np.arange(len(fp)))
            a, b, n_links = [moved], [root[moved]], len(moved)

    number, flips = _flips(int(mask), radius)
    _, run, size = np.unique(key, return_inverse=True, return_counts=True)
    # a look-up costs about as much as 16 comparisons, and a pair is compared once
    long = size[run] > (32 * number if longest is None else longest)
    live = np.flatnonzero(~long)
    step = 1
    while len(live := live[live + step < len(fp)]):
        live = live[key[live] == key[live + step]]
        near = live[np.bitwise_count(fp[live] ^ fp[live + step]) <= radius]
        link(near, near + step)
        step += 1
    dense = np.flatnonzero(long)
    dense = dense[np.argsort(fp[dense])]
    for bits in flips if len(dense) else ():
        value = fp[dense] ^ bits
        up = np.flatnonzero(value > fp[dense])
        at = np.minimum(np.searchsorted(fp[dense], value[up]), len(dense) - 1)
        there = fp[dense[at]] == value[up]
        link(dense[up[there]], dense[at[there]])
    if not a:
        return fp[:0], fp[:0]
    root = _roots(len(fp), np.concatenate(a), np.concatenate(b))
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return fp[moved], fp[root[moved]]


def links(fps: DataFrame, radius: int = 2, leaf: int = 4000, sample: int = 100_000) -> DataFrame:
    """(a, b) fingerprints whose links have the same components as all pairs within ``radius``.

    ``fps`` has different values of ``fp``.  ``sample`` bounds what the trees are fitted on; ``leaf`` is the aim
    for the fingerprints of a shard.  A shard holds eight sampled ones at least, so beyond ``leaf * sample / 8``
    fingerprints a larger sample keeps the shards small.
    """
    n = fps.count()
    # at most ``sample`` values: those with the smallest hashes, by a threshold on the hash
    picked = fps if n <= sample else fps.where(F.pmod(F.xxhash64("fp"), F.lit(1_000_003)) < int(1_000_003 * 0.9 * sample / n))
    points = np.array([r["fp"] for r in picked.limit(sample).collect()], np.int64).view(np.uint64)
    in_leaf = max(8, int(leaf * len(points) / max(n, 1)))
    blocks = _blocks(radius + 1)
    trees = [Tree(points, mask, radius, in_leaf, seed) for seed, mask in enumerate(blocks)]

    def route(batch):
        fp = to_numpy(batch.column("fp")).view(np.uint64)
        out = [tree.route(fp) for tree in trees]
        tree = np.repeat(np.arange(len(trees), dtype=np.int64), [len(x[0]) for x in out])
        at, shard, home = (np.concatenate(x) for x in zip(*out, strict=True))
        return {"shard": (shard * len(trees) + tree).astype(np.int64), "fp": fp[at].view(np.int64), "home": home}

    sent = arrow_map(fps.select("fp"), route, "shard long, fp long, home boolean")

    def search(key, group):
        import pyarrow as pa

        shard = key[0].as_py()
        fp = to_numpy(group.column("fp").combine_chunks()).view(np.uint64)
        home = to_numpy(group.column("home").combine_chunks())
        whole = whole_metric[shard % len(trees)]
        mask = np.uint64(0) if shard // len(trees) in whole else np.uint64(blocks[shard % len(trees)])
        a, b = shard_links(fp, home, radius, mask)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    # shards below a split by the whole distance hold linked points that agree in the block or not
    whole_metric = [_whole_shards(t) for t in trees]
    return sent.groupBy("shard").applyInArrow(search, "a long, b long")


def _whole_shards(tree: Tree) -> set[int]:
    """Shards under a node that splits by the whole distance."""
    found: set[int] = set()
    todo = [(tree.root, False)]
    while todo:
        node, whole = todo.pop()
        if node < 0:
            if whole:
                found.add(~node)
            continue
        _, _, _, slack, left, right = tree.nodes[node]
        todo += [(left, whole or slack > 0), (right, whole or slack > 0)]
    return found


def _rooted(classes: DataFrame, radius: int) -> DataFrame:
    """Adds ``root``, one fingerprint per component, to a table of different fingerprints."""
    classes = store(classes, "classes")
    found = components(links(classes, radius))
    return classes.join(found, classes["fp"] == found["node"], "left").select(*classes.columns, F.coalesce("root", "fp").alias("root"))


def keep_one(docs: DataFrame, radius: int = 2, words: int = 3, seed: int = 42) -> DataFrame:
    """One row of each component: that of the smallest id, of rows with one id that of the smallest text digest.

    Rows are told apart by id and text, so a row that shares its id with a copy elsewhere stays on its own account, and
    rows without an id come after those with one.  Of rows equal in both, one stays.
    """
    own = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.col("text"), F.lit(""))).cast("binary"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), own.alias("row_key"))

    def one(batch):
        found = [fingerprint(t.as_buffer().to_pybytes(), words, seed) for t in batch.column("text")]
        return {"doc_id": batch.column("doc_id"), "row_key": batch.column("row_key"), "fp": np.array(found, np.uint64).view(np.int64)}

    rows = store(arrow_map(keyed, one, "doc_id long, row_key string, fp long"), "row_fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")
    named = _rooted(rows.groupBy("fp").agg(first), radius)
    kept = named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row_key").alias("row_key"))
    gone = rows.select("row_key").distinct().join(kept, "row_key", "left_anti").select(F.col("row_key").alias("_gone"))
    left = docs.withColumn("_own", own).join(gone, F.col("_own") == F.col("_gone"), "left_anti")
    if rows.groupBy("row_key").count().where("count > 1").limit(1).count():
        left = left.dropDuplicates(["_own"])
    return left.select(docs.columns)


def near_duplicates(docs: DataFrame, radius: int = 2, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    fps = store(fingerprints(docs, words, seed), "fingerprints")
    named = _rooted(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), radius)
    heads = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = named.join(heads, "root").select("fp", "component_id")
    return fps.join(component, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
