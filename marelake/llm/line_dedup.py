"""Line dedup: range-partitioned line hashes, streamed in (hash, document, position) order.

The text never moves with the lines.  A line becomes 28 bytes: a 128-bit hash of its key, its document and its
position.  These rows are range-partitioned by (hash, document, position), so the rows of a line that a third of
all documents hold spread over many tasks, and are sorted inside the task with the largest document first.  A task
streams its rows and holds one hash at a time: the first document keeps the line, later ones drop it once a third
document has been seen.  Only the first and the last hash of a task can go on in a neighbour; for these the task
emits its rows undecided, with its three largest documents, and a join with at most six such rows per task decides.

The result is one compressed bitmap per document that loses lines, not text.  ``apply`` puts it to a text.

Defined results: null text is one empty line; very long texts are split where they are read and only 28 bytes a line
go on; a line that one document repeats is one document's line, and keeps all its copies in the largest document; a document without ``doc_id`` keeps all its lines and counts for no
line; rows that repeat a ``doc_id`` count as one document; an empty table gives an empty result; other columns pass
through ``apply`` unless they are named like its results.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANKS, arrow_map, arrow_schema, documents, lower_ascii, partitions, store, to_numpy

ROWS = "h1 long, h2 long, doc_id long, pos int, kind int"
DROP, OPEN, SUMMARY = 0, 1, 2


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return lower_ascii(F.trim(line, F.lit(BLANKS)))


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """The hash of every long enough line; the second hash sees the key shifted, so both do not collide together."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.select("doc_id", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keys.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.concat(F.lit("\x01"), "key")).alias("h2"), "doc_id", "pos")


class _Held:
    """Rows of one hash that may go on in the next batch, and what earlier batches left."""

    def __init__(self, min_docs: int):
        self.min_docs, self.parts, self.first = min_docs, [], True

    def take(self, rows: np.ndarray) -> list[np.ndarray]:
        """All hashes that have ended, decided; the last one stays."""
        change = (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)
        ends = np.flatnonzero(change) + 1
        if self.parts and (rows[0, :2] != self.parts[0][0, :2]).any():
            ends = np.insert(ends, 0, 0)
        if not len(ends):
            self.parts.append(rows)
            return []
        out = []
        if self.first:
            out += self.undecided(np.concatenate([*self.parts, rows[: ends[0]]]))
            self.first, done = False, rows[ends[0] : ends[-1]]
        else:
            done = np.concatenate([*self.parts, rows[: ends[-1]]])
        self.parts = [rows[ends[-1] :]]
        return [*out, self.decided(done)]

    def decided(self, rows: np.ndarray) -> np.ndarray:
        """Of whole hashes, the rows to drop: not of the first document, where enough documents hold the line."""
        if not len(rows):
            return np.empty((0, 5), np.int64)
        new_hash = np.append(True, (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0))
        document = np.cumsum(new_hash | np.append(True, np.diff(rows[:, 2]) != 0))
        first = np.flatnonzero(new_hash)
        size = np.diff(np.append(first, len(rows)))
        order = document - np.repeat(document[first], size)
        n_docs = np.repeat(np.maximum.reduceat(order, first) + 1, size)
        return np.column_stack([rows, np.full(len(rows), DROP)])[(order > 0) & (n_docs >= self.min_docs)]

    def undecided(self, rows: np.ndarray) -> list[np.ndarray]:
        if not len(rows):
            return []
        largest = np.unique(rows[:, 2])[::-1][: self.min_docs]
        heads = np.column_stack([np.repeat(rows[:1, :2], len(largest), 0), largest, np.zeros_like(largest), np.full(len(largest), SUMMARY)])
        return [np.column_stack([rows, np.full(len(rows), OPEN)]), heads]

    def end(self) -> list[np.ndarray]:
        return self.undecided(np.concatenate(self.parts)) if self.parts else []


def _stream(min_docs: int):
    schema = arrow_schema(T._parse_datatype_string(ROWS))

    def run(batches):
        held = _Held(min_docs)

        def emit(parts):
            rows = np.concatenate(parts) if parts else np.empty((0, 5), np.int64)
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(rows.T, schema, strict=True)], schema=schema)

        for batch in batches:
            if batch.num_rows:
                yield from emit(held.take(np.column_stack([to_numpy(batch.column(i)).astype(np.int64) for i in range(4)])))
        yield from emit(held.end())

    return run


def _bitmap(batch):
    out = {"doc_id": batch.column("doc_id"), "n_dropped": [], "dropped": []}
    for where in batch.column("where"):
        at = np.asarray(where.values)
        bits = np.zeros(int(at.max()) + 1, np.uint8)
        bits[at] = 1
        out["n_dropped"].append(int(bits.sum()))
        out["dropped"].append(zlib.compress(np.packbits(bits).tobytes()))
    return out


def drop_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, n_dropped, dropped) of every document that loses lines; all other lines stay.

    ``dropped`` is the complement of the keep bitmap (one bit per line, zlib-compressed, lines past its end stay),
    so that documents which keep everything need no row.
    """
    rows = line_rows(documents(docs).where("doc_id IS NOT NULL"), min_chars)
    ordered = rows.repartitionByRange(partitions(docs.sparkSession), "h1", "h2", F.desc("doc_id"), "pos")
    ordered = ordered.sortWithinPartitions("h1", "h2", F.desc("doc_id"), "pos")
    seen = store(ordered.mapInArrow(_stream(min_docs), ROWS), "line_rows")
    heads = seen.where(F.col("kind") == SUMMARY).groupBy("h1", "h2").agg(F.max("doc_id").alias("keeper"), F.size(F.collect_set("doc_id")).alias("n"))
    heads = heads.where(F.col("n") >= min_docs).drop("n")
    # six rows for each task at most
    late = seen.where(F.col("kind") == OPEN).join(F.broadcast(heads), ["h1", "h2"]).where(F.col("doc_id") < F.col("keeper"))
    drops = seen.where(F.col("kind") == DROP).select("doc_id", "pos").unionAll(late.select("doc_id", "pos"))
    per_doc = drops.groupBy("doc_id").agg(F.collect_set("pos").alias("where"))
    return arrow_map(per_doc, _bitmap, "doc_id long, n_dropped long, dropped binary")


def kept_lines(text: str, dropped: bytes | None) -> tuple[str, int]:
    """The text without its dropped lines, and its number of lines before."""
    lines = text.split("\n")
    if dropped is None:
        return text, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(dropped), np.uint8))
    gone = set(np.flatnonzero(bits).tolist())
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines)


def apply(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` less its dropped lines, ``n_lines`` (before) and ``n_dropped``."""
    named = {"n_lines", "n_dropped", "dropped"}
    joined = docs.select([c for c in docs.columns if c not in named]).join(bitmaps, "doc_id", "left")
    fields = [f for f in joined.schema if f.name not in named]
    schema = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def cut(batch):
        out = {f.name: batch.column(f.name) for f in fields}
        results = [kept_lines(t or "", b) for t, b in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist(), strict=True)]
        n = batch.column("n_dropped").fill_null(0)
        return out | {"text": [r[0] for r in results], "n_lines": [r[1] for r in results], "n_dropped": n}

    return arrow_map(joined, cut, schema)


def digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Counts and the digest of each document's remaining text."""

    def digest(batch):
        out = {"doc_id": batch.column("doc_id"), "n_lines": [], "n_dropped": batch.column("n_dropped").fill_null(0), "kept_sha256": []}
        for text, dropped in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist(), strict=True):
            kept, n = kept_lines(text, dropped)
            out["n_lines"].append(n)
            out["kept_sha256"].append(hashlib.sha256(kept.encode()).hexdigest())
        return out

    return arrow_map(documents(docs).join(bitmaps, "doc_id", "left"), digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
