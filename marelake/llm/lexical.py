"""Ranked lexical search: the Best Position Algorithm over impact lists, document shard by document shard.

One scan turns every whole text into its number of terms and the counts of those terms that the items ask for.  From
this table come the statistics over all documents: N, L and the document frequencies.  Documents are dealt into shards of
about ``shard_postings`` postings by a hash of their row, so no document, term or id makes a shard large.  A shard sorts
a list per term by falling impact and keeps beside it, for direct access, the postings by document and their positions.

An item reads its lists from the top, a block of positions at a time.  A document that appears in one list is looked up
in all others at once, which gives its whole score and marks its position in each of them as seen.  The best position of
a list is the end of its seen run from the top: a document not yet seen lies below it in every list, so the weighted
impacts at the best positions bound its score.  Direct accesses push the best positions further than reading alone, so
this bound is never above that of the last-read positions.  Reading stops when the bound is strictly below the k-th score
(a document that ties could still win by its id) or all lists are read.  The shards' best rows are then ranked together.

Every document that scores is thus either looked up whole or proven to lie below ``k`` others; nothing is estimated.

Defined results: a null text has no terms and counts nowhere; a null item has none and gets no rows; very long texts are
counted whole; a document without id counts and ranks, after all with an id among equal scores; rows that repeat an id
are documents of their own; rows of ``items`` that repeat an id are ranked each; a term that an item repeats counts once;
without documents or items the result is empty; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, store, to_numpy

# What the score is made of.
SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
ONE, SLOPE, BASE, SHARE = 1_000_000_000, 8, 10, 90

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_FOLD = bytes.maketrans(bytes(SEPARATORS) + _UPPER, b" " * len(SEPARATORS) + _UPPER.lower())


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order: runs of letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return BASE + (SHARE * n * n_docs) // n_terms


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (ONE * tf) // (1000 * tf + SLOPE * norm)


# one shard


class Shard:
    """Impact lists of some documents, and their postings by document."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impacts: np.ndarray, n_docs: int):
        """``doc`` numbers the shard's documents in the order that breaks ties."""
        order = np.lexsort((doc, term))
        self.doc, term, self.impact, self.n_docs = doc[order].astype(np.int32), term[order], impacts[order], n_docs
        self.terms, self.start = np.unique(term, return_index=True)
        self.end = np.append(self.start[1:], len(term))
        #: by term and falling impact: which posting; and for each posting its position in its list
        self.by_impact = np.lexsort((self.doc, -self.impact, term))
        self.position = np.empty(len(term), np.int32)
        self.position[self.by_impact] = np.arange(len(term)) - np.repeat(self.start, self.end - self.start)
        self.dense: dict[int, np.ndarray] = {}

    def slot(self, term: int) -> int:
        at = int(np.searchsorted(self.terms, term))
        return at if at < len(self.terms) and self.terms[at] == term else -1

    def direct(self, slot: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``docs`` the list holds, and their postings."""
        a, b = self.start[slot], self.end[slot]
        if (b - a) * 8 >= self.n_docs:  # a long list answers from an array over all documents
            if slot not in self.dense:
                held = np.full(self.n_docs, -1, np.int32)
                held[self.doc[a:b]] = np.arange(a, b)
                self.dense[slot] = held
            found = self.dense[slot][docs]
            hit = found >= 0
            return hit, found[hit]
        at = np.searchsorted(self.doc[a:b], docs)
        at[at == b - a] = 0
        hit = self.doc[a:b][at] == docs
        return hit, a + at[hit]

    def top(self, query: list[tuple[int, int]], k: int, block: int = 64, best_positions: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``k`` best documents of (term, weight) pairs with their scores, and how many positions were read.

        Without ``best_positions`` the bound comes from the last-read positions, for comparison.
        """
        lists = [(s, w) for t, w in query if w > 0 and (s := self.slot(t)) >= 0]
        size = np.array([self.end[s] - self.start[s] for s, _ in lists], np.int64)
        seen = [np.zeros(n, bool) for n in size]
        best = np.zeros(len(lists), np.int64)  # so many positions from the top are seen
        known = np.zeros(self.n_docs, bool)
        docs, scores, read, depth = np.empty(0, np.int64), np.empty(0, np.int64), 0, 0
        while (best < size).any():
            upto = np.minimum(depth + block, size)
            fresh = [self.doc[self.by_impact[self.start[s] + depth : self.start[s] + u]] for (s, _), u in zip(lists, upto, strict=True) if u > depth]
            read += int(np.maximum(upto - depth, 0).sum())
            new = np.unique(np.concatenate(fresh)) if fresh else np.empty(0, np.int32)
            new = new[~known[new]]
            known[new] = True
            total = np.zeros(len(new), np.int64)
            for i, (s, w) in enumerate(lists):
                hit, posting = self.direct(s, new)
                total[hit] += w * self.impact[posting]
                seen[i][self.position[posting]] = True
            docs, scores = np.append(docs, new), np.append(scores, total)
            keep = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[keep], scores[keep]
            depth, block = depth + block, block * 2
            bound = 0
            for i, (s, w) in enumerate(lists):
                unseen = np.flatnonzero(~seen[i][best[i] : best[i] + 2 * block])
                while not len(unseen) and best[i] + 2 * block < size[i]:
                    best[i] += 2 * block
                    unseen = np.flatnonzero(~seen[i][best[i] : best[i] + 2 * block])
                best[i] = best[i] + unseen[0] if len(unseen) else size[i]
                last = best[i] if best_positions else min(depth, size[i])
                if last < size[i]:
                    bound += w * int(self.impact[self.by_impact[self.start[s] + last - 1]])
            if len(docs) == k and bound < scores[-1]:
                break
        return docs[scores > 0], scores[scores > 0], read


# all documents


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with terms: how many, which of the vocabulary, and how often each."""

    def count(batch):
        out = {"doc_id": [], "n": [], "terms": [], "tfs": []}
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
            words = terms(text or b"")
            if words:
                held = [(vocabulary[w], c) for w, c in Counter(words).items() if w in vocabulary]
                out["doc_id"].append(doc_id)
                out["n"].append(len(words))
                out["terms"].append([t for t, _ in held])
                out["tfs"].append([c for _, c in held])
        return out

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(narrow, count, "doc_id long, n long, terms array<int>, tfs array<long>")


def _shard_rows(queries: list[list[tuple[int, int]]], n_docs: int, n_terms: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("doc_id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        held = table.column("terms").combine_chunks()
        sizes = np.diff(to_numpy(held.offsets))
        tf = to_numpy(table.column("tfs").combine_chunks().flatten()).astype(np.int64)
        norm = np.repeat(length_norm(to_numpy(table.column("n")), n_docs, n_terms), sizes)
        shard = Shard(np.repeat(rank, sizes), to_numpy(held.flatten()).astype(np.int64), impact(tf, norm), len(ids))
        out = {"item": [], "doc_id": [], "score": []}
        for item, query in enumerate(queries):
            found, scores, _ = shard.top(query, k)
            out["item"] += [item] * len(found)
            out["doc_id"] += [ids[order[d]] for d in found]
            out["score"] += scores.tolist()
        return pa.table({"item": pa.array(out["item"], pa.int32()), "doc_id": pa.array(out["doc_id"], pa.int64()), "score": pa.array(out["score"], pa.int64())})

    return run


def _rank_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int, shard_postings: int) -> DataFrame | None:
    """Ranks for some items, whose terms fit into a task."""
    spark = docs.sparkSession
    names = sorted({t for _, held in items for t in held})
    vocabulary = {t: i for i, t in enumerate(names)}
    counted = store(count_terms(docs, vocabulary).withColumn("row", F.monotonically_increasing_id()), "term_counts")
    n_docs, n_terms, postings = counted.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.size("terms").cast("long"))).first()
    if not n_docs:
        return None
    # one row per term of the block
    df = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    queries = [[(t, weight(n_docs, df[t])) for t in sorted({vocabulary[x] for x in held}) if t in df] for _, held in items]
    shards = max(1, -(-postings // shard_postings))
    dealt = counted.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).drop("row")
    local = dealt.groupBy("shard").applyInArrow(_shard_rows(queries, n_docs, n_terms, k), "item int, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    named = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = 200_000, shard_postings: int = 500_000) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of each item; score 0 is no match.

    Items go out in blocks of at most ``block_terms`` terms (one longer item is a block of its own), so what the driver and a task
    hold of them is bounded; each block reads the documents once.
    """
    spark, found, block, held = docs.sparkSession, [], [], 0
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    for row in wanted.toLocalIterator():
        own = sorted(set(terms(row.text.encode())))
        if block and held + len(own) > block_terms:
            found.append(_rank_block(docs, block, k, shard_postings))
            block, held = [], 0
        if own:
            block.append((row.item_id, own))
            held += len(own)
    if block:
        found.append(_rank_block(docs, block, k, shard_postings))
    found = [x for x in found if x is not None]
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = found[0]
    for x in found[1:]:
        out = out.unionAll(x)
    return out
