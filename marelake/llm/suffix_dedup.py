"""Removal of every byte under a repeated string of ``WINDOW`` bytes, by suffix order with common prefixes.

Only few windows can repeat, so the suffix sort sees a reduced text that loses none of them:

1. a window's anchor is the least hash of its 32-byte grams (the left-most of equal ones).  Equal windows have equal
   anchors at equal offsets; the windows of a text fall into runs with one anchor each.  Runs whose anchor hash
   occurs nowhere else hold no repeated window and end here;
2. the context of a run, its windows' bytes from the first to the last, goes with its anchor.  A context that occurs
   twice is repeated as a whole.  A hot passage is one context per anchor: a task ships a context once, so a passage
   that a third of all texts hold costs a row per task;
3. anchors with several different contexts are dealt into shards by hash.  A shard's contexts are put in suffix order
   by external induced sorting (``induced``), and windows whose neighbour in that order shares ``WINDOW`` bytes are
   repeated.  The windows of an anchor with more than ``hot`` contexts are compared from coarse to fine instead, so
   that no task holds its group: stretches of 16 windows that are equal as a whole, then, only where the bytes common
   to a stretch occur in different stretches, single windows by hash;
4. repeated windows return to their texts and the union of their bytes is cut.

Exact copies of a text are one text in all steps; with two or more of them, all of their bytes go.

Defined results: null text is empty; texts shorter than a window keep everything; rows that repeat are copies of each
other, whatever their ``doc_id``, which may be null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, arrow_schema, documents, partitions, store
from .induced import suffix_order

WINDOW, GRAM = 200, 32
#: windows of a long text that are looked at together
STRETCH = 1 << 22
LOW = np.uint64((1 << 24) - 1)
ROWS = "doc_id long, row_key long, t1 long, t2 long, sha string, n_bytes long"
#: ``at`` is the first window of a run, shifted by 8 bits, and how many windows follow it
ANCHORS = "row_key long, h long, at long"
CONTEXTS = "row_key long, at long, h long, c1 long, c2 long, bytes binary"
FOUND = "c1 long, c2 long, a int, b int"
#: a stretch of windows of a context: the hash of the bytes all of them share, and of the whole stretch
STRETCHES = "c1 long, c2 long, a int, b int, k1 long, k2 long, f1 long, f2 long, bytes binary"
SINGLE = "c1 long, c2 long, a int, w1 long, w2 long"
STEP = 16


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 32 bytes at each place, from hashes of 1, 2, 4, 8 and 16 bytes."""
    odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
    h = (data.astype(np.uint64) + np.uint64(1)) * odd[0]
    for step in (1, 2, 4, 8, 16):
        late = h[step:]
        h = h[:-step] * odd[1] + (late ^ (late >> np.uint64(29))) * odd[2]
    h ^= h >> np.uint64(32)
    h *= odd[0]
    return h ^ (h >> np.uint64(29))


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, last window) of each run of windows with one anchor."""
    out = []
    for at in range(0, len(data) - WINDOW + 1, STRETCH):
        h = gram_hashes(data[at : at + STRETCH + WINDOW - 1])
        least = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
        span, grams = 1, WINDOW - GRAM + 1
        while 2 * span <= grams:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        rest = grams - span
        least = np.minimum(least[: len(least) - rest], least[rest:])
        place = (least & LOW).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        out.append((h[place[first]].view(np.int64), first + at, np.append(first[1:], len(place)) - 1 + at))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:16], "big", signed=True)


def _described(batch):
    out: dict[str, list] = {f: [] for f in ("doc_id", "row_key", "t1", "t2", "sha", "n_bytes")}
    for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("row_key").to_pylist(), batch.column("text"), strict=True):
        raw = text.as_buffer().to_pybytes()
        digest = hashlib.sha256(raw).digest()
        for name, value in zip(out, (doc, key, *_halves(digest), digest.hex(), len(raw)), strict=True):
            out[name].append(value)
    return out


def _packed(batch):
    """Texts of a window and more, compressed: they move smaller."""
    import zstandard

    press = zstandard.ZstdCompressor(level=3).compress
    out: dict[str, list] = {f: [] for f in ("row_key", "packed")}
    for key, text in zip(batch.column("row_key").to_pylist(), batch.column("text"), strict=True):
        raw = text.as_buffer().to_pybytes()
        if len(raw) >= WINDOW:
            for name, value in zip(out, (key, press(raw)), strict=True):
                out[name].append(value)
    return out


def _anchors():
    schema = arrow_schema(T._parse_datatype_string(ANCHORS))

    def run(batches):
        import zstandard

        open_ = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            parts, size = [], 0
            for i, (key, packed) in enumerate(zip(batch.column("row_key").to_pylist(), batch.column("packed").to_pylist(), strict=True), 1):
                h, lo, hi = runs(np.frombuffer(open_(packed), np.uint8))
                parts.append((np.full(len(h), key), h, (lo << 8) + hi - lo))
                size += len(h)
                if size > 200_000 or i == batch.num_rows:
                    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)
                    parts, size = [], 0

    return run


def _contexts():
    """The contexts of texts; a task ships the bytes of a context once."""
    schema = arrow_schema(T._parse_datatype_string(CONTEXTS))

    def run(batches):
        import zstandard
        from xxhash import xxh3_128_digest

        open_ = zstandard.ZstdDecompressor().decompress
        seen: set[bytes] = set()
        rows: list[tuple] = []

        def flush():
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        size = 0
        for batch in batches:
            for key, packed, anchors in zip(*(batch.column(c).to_pylist() for c in ("row_key", "packed", "anchors")), strict=True):
                raw = open_(packed)
                for a in anchors:
                    lo = a["at"] >> 8
                    context = raw[lo : lo + (a["at"] & 255) + WINDOW]
                    digest = xxh3_128_digest(context)
                    if len(seen) > 300_000:
                        seen.clear()
                    new = digest not in seen
                    seen.add(digest)
                    rows.append((key, a["at"], a["h"], *_halves(digest), context if new else None))
                    size += 64 + len(context) * new
                if size > 8_000_000:
                    yield flush()
                    rows.clear()
                    size = 0
        if rows:
            yield flush()

    return run


def repeated_windows(contexts: list[bytes], memory: int) -> list[list[tuple[int, int]]]:
    """Of each context, the stretches (first, last) of windows that occur elsewhere in these contexts."""
    # 255 is no byte of UTF-8, so no window with it equals one inside a context
    joined = b"\xff".join(contexts) + b"\xff"
    order, shared = suffix_order(joined, WINDOW, memory)
    like = shared >= WINDOW
    again = np.zeros(len(joined), bool)
    again[order[like]] = True
    again[order[:-1][like[1:]]] = True
    size = np.array([len(c) for c in contexts])
    start = np.cumsum(size + 1) - size - 1
    valid = np.zeros(len(joined) + 1, np.int8)
    np.add.at(valid, start, 1)
    np.add.at(valid, start + size - WINDOW + 1, -1)
    again &= np.cumsum(valid)[:-1] > 0
    edge = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    out: list[list[tuple[int, int]]] = [[] for _ in contexts]
    for j, a, b in zip(np.searchsorted(start, first, side="right") - 1, first, last, strict=True):
        out[j].append((int(a - start[j]), int(b - start[j])))
    return out


def _shard(memory: int):
    schema = arrow_schema(T._parse_datatype_string(FOUND))

    def search(group: pa.Table) -> pa.Table:
        by_id, anchors = {}, Counter()
        for h, a, b, c in zip(*(group.column(x).to_pylist() for x in ("h", "c1", "c2", "bytes")), strict=True):
            anchors[h] += (a, b) not in by_id
            by_id[a, b] = (h, c)
        # an anchor with one context only has no other window to be compared with
        by_id = {k: x for k, x in by_id.items() if anchors[x[0]] > 1}
        rows = []
        if by_id:
            found = repeated_windows([c for _, c in by_id.values()], memory)
            rows = [(*k, a, b) for k, stretches in zip(by_id, found, strict=True) for a, b in stretches]
        columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return search


def _stretches(batch):
    """Contexts of heavy anchors cut where a window's distance to its anchor passes a multiple of ``STEP``."""
    from xxhash import xxh3_128_digest

    out: dict[str, list] = {f: [] for f in ("c1", "c2", "a", "b", "k1", "k2", "f1", "f2", "bytes")}
    for h, c1, c2, context in zip(*(batch.column(x).to_pylist() for x in ("h", "c1", "c2", "bytes")), strict=True):
        last = len(context) - WINDOW
        # no earlier gram of a context has the hash of its anchor
        anchor = int(np.flatnonzero(gram_hashes(np.frombuffer(context, np.uint8)) == np.uint64(h % 2**64))[0])
        a = 0
        while a <= last:
            level = (anchor - a) // STEP
            b = min(last, anchor - level * STEP)
            whole, tag = context[a : b + WINDOW], b"%d %d " % (h, level)
            # what every window of the level holds, also where the context has only some of them
            core = context[anchor - level * STEP : anchor - (level + 1) * STEP + 1 + WINDOW]
            for name, value in zip(out, (c1, c2, a, b, *_halves(xxh3_128_digest(tag + core)), *_halves(xxh3_128_digest(tag + whole)), whole), strict=True):
                out[name].append(value)
            a = b + 1
    return out


def _single(batch):
    from xxhash import xxh3_128_digest

    rows = [(c1, c2, a + i, *_halves(xxh3_128_digest(whole[i : i + WINDOW]))) for c1, c2, a, whole in zip(*(batch.column(x).to_pylist() for x in ("c1", "c2", "a", "bytes")), strict=True) for i in range(len(whole) - WINDOW + 1)]
    return dict(zip(("c1", "c2", "a", "w1", "w2"), zip(*rows, strict=True), strict=True)) if rows else None


def _coarse_to_fine(sent: DataFrame) -> DataFrame:
    """Repeated windows among the contexts of heavy anchors, by grouping hashes; (c1, c2, a, b)."""
    cut = store(arrow_map(sent.select("h", "c1", "c2", "bytes").dropDuplicates(["c1", "c2"]), _stretches, STRETCHES), "stretches")
    whole = cut.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("f1", "f2")
    equal = cut.join(whole, ["f1", "f2"]).select("c1", "c2", "a", "b")
    mixed = cut.groupBy("k1", "k2").agg(F.min("f1").alias("least"), F.max("f1").alias("most")).where("least <> most").select("k1", "k2")
    # equal stretches are one: their windows are found with it, and a stretch that is equal as a whole is done
    open_ = cut.select("c1", "c2", "a", "f1", "f2", "k1", "k2", "bytes").join(mixed, ["k1", "k2"])
    single = store(arrow_map(open_.select("c1", "c2", "a", "bytes"), _single, SINGLE), "single_windows")
    again = single.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2")
    return equal.unionAll(single.join(again, ["w1", "w2"]).select("c1", "c2", "a", F.col("a").alias("b")))


def _cut(batch):
    import zstandard

    out: dict[str, list] = {f: [] for f in ("row_key", "n_removed", "n_spans", "kept")}
    open_ = zstandard.ZstdDecompressor().decompress
    for key, packed, spans in zip(*(batch.column(c).to_pylist() for c in ("row_key", "packed", "spans")), strict=True):
        raw = np.frombuffer(open_(packed), np.uint8)
        cover = np.zeros(len(raw) + 1, np.int64)
        np.add.at(cover, [s["a"] for s in spans], 1)
        np.add.at(cover, [s["b"] + WINDOW for s in spans], -1)
        gone = np.cumsum(cover)[:-1] > 0
        n_spans = int(np.count_nonzero(np.diff(np.append(0, gone.astype(np.int8))) == 1))
        for name, value in zip(out, (key, int(gone.sum()), n_spans, raw[~gone].tobytes()), strict=True):
            out[name].append(value)
    return out


def _bodies(texts: DataFrame, keyed: DataFrame) -> DataFrame:
    """(row_key, packed) of one row per different text, bucketed: no later join moves the texts again."""
    spark = texts.sparkSession
    packed = arrow_map(keyed, _packed, "row_key long, packed binary")
    one = packed.join(texts.select("row_key"), "row_key")
    name, n = f"bodies_{uuid.uuid4().hex}", partitions(spark)
    # the join has dealt the rows by the same hash into as many parts
    one.write.format("parquet").option("compression", "none").bucketBy(n, "row_key").saveAsTable(name)
    return spark.table(name)


def remove_repeats(docs: DataFrame, shard_bytes: int = 3_000_000, hot: int = 8_000, memory: int = 200_000_000) -> DataFrame:
    """(doc_id, n_bytes, sha, n_removed, n_spans, kept) of every document.

    ``kept`` holds the remaining bytes; it is null where nothing goes, so that such texts need not move.  ``sha`` is
    the digest of the whole text.
    """
    keyed = documents(docs).withColumn("row_key", F.coalesce("doc_id", F.xxhash64("text")))
    rows = store(arrow_map(keyed, _described, ROWS), "texts")
    texts = rows.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n_copies"), F.min("row_key").alias("row_key"))
    twins = rows.groupBy("row_key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("t1", "t2").alias("n_texts")).where("n > 1").agg(F.max("n_texts")).first()[0]
    if twins:
        # rows share an id: their texts tell them apart, and equal rows are one
        keyed = keyed.withColumn("row_key", F.xxhash64("row_key", "text")).distinct()
        rows = rows.withColumn("row_key", F.lit(None).cast("long"))
        texts = texts.drop("row_key").join(store(arrow_map(keyed, _described, ROWS), "texts").groupBy("t1", "t2").agg(F.min("row_key").alias("row_key")), ["t1", "t2"])
    texts = store(texts, "classes")
    bodies = _bodies(texts, keyed)
    each = bodies.mapInArrow(_anchors(), ANCHORS)
    # written, so that both sides of the join are plain shuffles, whose hot keys AQE can split
    repeated = store(each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated")
    wanted = each.join(repeated, "h").groupBy("row_key").agg(F.collect_list(F.struct("h", "at")).alias("anchors"))
    contexts = store(bodies.join(wanted, "row_key").select("row_key", "packed", "anchors").mapInArrow(_contexts(), CONTEXTS), "contexts")
    twice = contexts.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c1", "c2", F.lit(0).alias("a"), F.lit(255).alias("b"))
    sent = contexts.where("bytes IS NOT NULL").select("h", "c1", "c2", "bytes")
    total = sent.agg(F.sum(F.length("bytes"))).first()[0] or 0
    n_shards = max(1, -(-total // shard_bytes))
    heavy = store(sent.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("h"), "heavy")
    some = heavy.limit(1).count()
    light = sent.join(heavy, "h", "left_anti") if some else sent
    # a shard is a bounded piece of the contexts
    dealt = light.withColumn("shard", F.pmod("h", F.lit(n_shards)))
    stretches = dealt.groupBy("shard").applyInArrow(_shard(memory), FOUND)
    if some:
        stretches = stretches.unionAll(_coarse_to_fine(sent.join(heavy, "h", "left_semi")))
    stretches = store(stretches, "windows")
    hits = contexts.select("row_key", "at", "c1", "c2").join(twice.unionAll(stretches), ["c1", "c2"])
    lo, hi = F.shiftright("at", 8), F.shiftright("at", 8) + F.col("at").bitwiseAND(255)
    spans = hits.groupBy("row_key").agg(F.collect_list(F.struct((lo + F.col("a")).alias("a"), F.least(lo + F.col("b"), hi).alias("b"))).alias("spans"))
    cut = arrow_map(bodies.join(spans, "row_key").select("row_key", "packed", "spans"), _cut, "row_key long, n_removed long, n_spans long, kept binary")
    per_text = texts.join(cut, "row_key", "left").drop("row_key")
    all_gone = (F.col("n_copies") > 1) & (F.col("n_bytes") >= WINDOW)
    return rows.select("doc_id", "t1", "t2", "sha", "n_bytes").join(per_text, ["t1", "t2"]).select(
        "doc_id", "n_bytes", "sha",
        F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
