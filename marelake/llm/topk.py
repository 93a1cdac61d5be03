"""Exact top-k inner products in three phases with a uniform threshold.

Vectors are parted by rows over the tasks, and each vector in ``slices`` runs of components, those with most energy
first, whose partial inner products sum to the score.  Queries come in blocks of bounded size; for a block:

1. every task gathers, per query, the k largest exact scores of the rows that are best by the first slice (k of every
   1,024).  They belong to different vectors, so the k-th largest of all lists is a score that the answer reaches: a safe cutoff;
2. the cutoffs, one number for each query of the block, go to all tasks.  A vector whose partial scores all lie
   below cutoff / slices cannot reach it, so only pairs are collected whose first slice lies at or above this uniform
   threshold or whose norms let a later slice do so, and whose first slice plus the norms' bound on the others
   reaches the cutoff;
3. the remaining slices of the collected pairs are added one by one, and a pair goes as soon as what it has plus the
   bound on the rest stays below the cutoff.  What reaches the cutoff is the full score list from which each query
   takes its k largest.

Where more than a tenth of the pairs of a piece is collected, the remaining slices are one matrix product, as that
costs less than picking the pairs; the result is the same.

Components become integers floor(scale * x), so scores are exact in doubles as long as they stay below 2 ** 52;
beyond that whole numbers are used, without slices.

Defined results: vectors that are null or hold null or non-finite components take no part, as query or as candidate;
shorter vectors count as filled with zeros; equal scores go by the smaller id; rows that repeat an id are separate
candidates for other queries, and each repeated query row has its own list; scores beyond 64 bits count as the largest
or smallest number of 64 bits; a table without queries gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, store, to_numpy

#: queries of one block, queries and rows multiplied at once, and numbers of a block's or a product's largest array
QUERIES, GROUP, ROWS, CELLS = 16_384, 256, 1024, 4_194_304
#: share of collected pairs from which a matrix product costs less than the pairs alone
DENSE = 0.1
MOST = np.iinfo(np.int64).max
#: stands where a list has no score
NONE = np.iinfo(np.int64).min


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) with the components as doubles."""
    v = F.col("embedding").cast("array<double>")
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & fine).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _matrix(column: pa.ListArray, dim: int, scale: int) -> np.ndarray:
    flat, ends = to_numpy(column.flatten()), column.offsets.to_numpy() - column.offsets[0].as_py()
    size = np.diff(ends)
    out = np.zeros((len(column), dim))
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(scale * flat), -1e300, 1e300)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(ends[:-1], size)] = whole
    return out


def _scan(batches: Iterator[pa.RecordBatch], order: np.ndarray, scale: int):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield to_numpy(part.column("vec_id")), _matrix(part.column("v"), len(order), scale)[:, order]


def _runs(dim: int, slices: int) -> list[slice]:
    cuts = [dim * i // slices for i in range(slices + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def _groups(n: int) -> list[slice]:
    return [slice(i, min(i + GROUP, n)) for i in range(0, n, GROUP)]


def _largest(q: np.ndarray, v: np.ndarray) -> float:
    """A bound on every sum of products of the two."""
    return max(1.0, float(np.abs(q).max(initial=0))) * max(1.0, float(np.abs(v).max(initial=0))) * max(1, q.shape[1])


def _whole(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """All scores in whole numbers, for components too large for doubles."""
    if _largest(q, v) < 2**62:
        return q.astype(np.int64) @ v.astype(np.int64).T
    integers = np.frompyfunc(int, 1, 1)
    return np.clip(integers(q) @ integers(v).T, -MOST, MOST).astype(np.int64)


def _pairs(q: np.ndarray, v: np.ndarray, at_q: np.ndarray, at_v: np.ndarray) -> np.ndarray:
    """The inner products of some pairs of rows."""
    step = max(1, CELLS // (4 * max(1, q.shape[1])))
    out = np.empty(len(at_q))
    for i in range(0, len(at_q), step):
        out[i : i + step] = np.einsum("ij,ij->i", q[at_q[i : i + step]], v[at_v[i : i + step]])
    return out


def collect(q: np.ndarray, v: np.ndarray, other: np.ndarray, cutoff: np.ndarray, runs: list[slice]):
    """Phases 2 and 3 for some queries and rows: (query, row, score) of the pairs that reach the query's cutoff.

    ``other`` marks the pairs that count.  Also returns how many products of components followed the first slice.
    """
    least = np.where(cutoff > NONE, cutoff / len(runs), -np.inf)[:, None]
    goal = np.where(cutoff > NONE, cutoff.astype(float), -np.inf)
    # a little above the norms, for their rounding
    bounds = [np.linalg.norm(q[:, r], axis=1)[:, None] * np.linalg.norm(v[:, r], axis=1)[None] * (1 + 1e-9) + 1e-6 for r in runs]
    score = q[:, runs[0]] @ v[:, runs[0]].T
    rest = sum(bounds[1:], np.zeros_like(score))
    reach = score >= least
    for b in bounds[1:]:
        reach |= b >= least
    reach &= other & (score + rest >= goal[:, None])
    if reach.mean() > DENSE:
        score = score + q[:, runs[0].stop :] @ v[:, runs[0].stop :].T
        at_q, at_v = np.nonzero(reach & (score >= goal[:, None]))
        return at_q, at_v, score[at_q, at_v], score.size * (q.shape[1] - runs[0].stop)
    at_q, at_v = np.nonzero(reach)
    score, rest, done = score[at_q, at_v], rest[at_q, at_v], 0
    for r, b in zip(runs[1:], bounds[1:], strict=True):
        score = score + _pairs(q[:, r], v[:, r], at_q, at_v)
        rest = rest - b[at_q, at_v]
        done += len(at_q) * (r.stop - r.start)
        # what is subtracted may round below what is left
        on = score + np.maximum(rest, 0) + 1e-3 >= goal[at_q]
        at_q, at_v, score, rest = at_q[on], at_v[on], score[on], rest[on]
    on = score >= goal[at_q]
    return at_q[on], at_v[on], score[on], done


def _local_scores(ids: np.ndarray, q: np.ndarray, k: int, order: np.ndarray, scale: int, slices: int):
    """Phase 1: exact scores of a task's best rows by the first slice, as (query number, scores)."""
    first = _runs(len(order), slices)[0]
    schema = arrow_schema(T._parse_datatype_string("q int, scores array<long>"))

    def run(batches):
        best = np.full((len(q), k), NONE)
        for vec_id, v in _scan(batches, order, scale):
            n = min(k, len(vec_id))
            for g in _groups(len(q)):
                exact = _largest(q[g], v) < 2**52
                whole = None if exact else _whole(q[g], v)
                local = q[g, first] @ v[:, first].T if exact else whole.astype(float)
                local[ids[g][:, None] == vec_id[None]] = -np.inf
                top = np.argpartition(-local, n - 1, axis=1)[:, :n]
                at_q = np.repeat(np.arange(len(top)), n)
                score = _pairs(q[g], v, at_q, top.ravel()).astype(np.int64) if exact else whole[at_q, top.ravel()]
                score[local[at_q, top.ravel()] == -np.inf] = NONE
                best[g] = np.sort(np.concatenate([best[g], score.reshape(-1, n)], 1), 1)[:, -k:]
        held = best > NONE
        if held.any():
            scores = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], held.sum(1).cumsum()]), pa.int32()), pa.array(best[held]))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(q)), pa.int32()), scores.cast(schema.field(1).type)], schema=schema)

    return run


def _collected(ids: np.ndarray, q: np.ndarray, cutoff: np.ndarray, order: np.ndarray, scale: int, slices: int):
    """Phases 2 and 3 over a task's rows: the pairs that reach the cutoff."""
    runs = _runs(len(order), slices)
    schema = arrow_schema(T._parse_datatype_string("q int, query_id long, vec_id long, score long"))

    def run(batches):
        for vec_id, v in _scan(batches, order, scale):
            for g in _groups(len(q)):
                other = ids[g][:, None] != vec_id[None]
                if _largest(q[g], v) < 2**52:
                    at_q, at_v, score, _ = collect(q[g], v, other, cutoff[g], runs)
                else:
                    whole = _whole(q[g], v)
                    at_q, at_v = np.nonzero(other & (whole >= cutoff[g][:, None]))
                    score = whole[at_q, at_v]
                if len(at_q):
                    at_q = at_q + g.start
                    columns = [at_q.astype(np.int32), ids[at_q], vec_id[at_v], score.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def _energies(table: DataFrame, scale: int) -> dict[int, float]:
    """The sum of squares of every component; tasks send one row for each."""
    schema = arrow_schema(T._parse_datatype_string("pos int, energy double"))

    def run(batches):
        total = np.zeros(0)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                column = batch.column("v").slice(at, ROWS)
                dim = max((len(x) for x in column), default=0)
                with np.errstate(over="ignore"):
                    energy = (_matrix(column, dim, scale) ** 2).sum(0)
                total = np.pad(total, (0, max(0, dim - len(total))))
                total[:dim] += energy
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], schema=schema)

    rows = table.select("v").mapInArrow(run, "pos int, energy double").groupBy("pos").agg(F.sum("energy").alias("energy"))
    return {r["pos"]: r["energy"] for r in rows.collect()}


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, slices: int = 2, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query, the ``k`` largest scores among all other vectors."""
    spark, found = vectors.sparkSession, None
    table = store(valid(vectors), "vectors")
    asked = store(valid(queries).withColumn("at", F.monotonically_increasing_id()), "queries")
    energy = _energies(table, scale)
    dim = max(1, len(energy), asked.agg(F.max(F.size("v"))).first()[0] or 0)
    order = np.array(sorted(range(dim), key=lambda i: -energy.get(i, 0.0)))
    for ids, q in _blocks(asked, min(block, max(1, CELLS // dim)), order, scale):
        scores = table.mapInArrow(_local_scores(ids, q, k, order, scale, slices), "q int, scores array<long>")
        merged = scores.groupBy("q").agg(F.slice(F.sort_array(F.flatten(F.collect_list("scores")), False), 1, k).alias("s"))
        cutoff = np.full(len(ids), NONE)
        for row in merged.where(F.size("s") == k).select("q", F.element_at("s", k).alias("low")).collect():
            cutoff[row["q"]] = row["low"]
        hits = table.mapInArrow(_collected(ids, q, cutoff, order, scale, slices), "q int, query_id long, vec_id long, score long")
        # equal scores at the cutoff may be many: the limit holds below the shuffle too
        rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
        ranked = hits.withColumn("rank", rank).where(F.col("rank") <= k)
        part = store(ranked.select("query_id", "rank", "vec_id", "score"), "top_k")
        found = part if found is None else found.unionAll(part)
    return found if found is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def _blocks(asked: DataFrame, block: int, order: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of ``block`` queries, cut by the numbers in ``at``: a partition's rows count up from its own start."""
    sizes = asked.groupBy(F.shiftright("at", 33).alias("p")).agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"))
    cuts, room = [], 0
    for r in sorted(sizes.collect(), key=lambda r: r["low"]):
        cuts += range(r["low"] + room, r["low"] + r["n"], block)
        room = (room - r["n"]) % block
    for low, high in zip(cuts, [*cuts[1:], None], strict=False):
        part = asked.where(F.col("at") >= low)
        if high is not None:
            part = part.where(F.col("at") < high)
        rows = part.select("vec_id", "v").toArrow().combine_chunks()
        v = rows.column("v").combine_chunks()
        v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        yield to_numpy(rows.column("vec_id")), _matrix(v, len(order), scale)[:, order]
