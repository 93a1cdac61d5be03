"""Prefix trie of conversations: range minima over the sorted conversations' common prefixes, no stack, no trie in memory.

*Rows.*  A turn becomes a 128-bit key and a number of words; the text goes no further.  A conversation is cut into rows
of ``turns_per_row`` keys, each with a hash of all turns before the row, so that a conversation of any length is many
short rows.  Rows are range-partitioned and sorted by (level, hash of the turns before, keys, whether it goes on, id):
members of a node are then neighbours, however many there are, and a conversation that a third of all repeat spreads over
tasks.

*Extents.*  A task cuts its rows into blocks, and takes the common prefix (LCP) of each row with the one before.  A sparse
table of LCP minima answers how far a prefix reaches: every candidate (row, depth) searches its left and its right end by
halving steps, independently of all others.  A candidate whose left end is its own row is a node's piece; a second sparse
table gives its smallest member.  Of each block two numbers are kept, the LCP with the block before and the least inside;
a sparse table over these finds the first block of a node that crosses blocks, and that names the node in all its blocks.

*Subtrees.*  With X the words of a conversation up to the deepest node that also holds a smaller conversation, and C the
words above a node, the tokens saved below it are the sum of X - C over its members but the smallest.  Leaves count the
conversations that are the smallest of a childless node.  Both are sums over members, so a prefix sum per block gives
them for every piece, and adding up the pieces gives the nodes.

Members that end in a node lie at its start, in order of their ids.  Where a node crosses blocks the ids go on as packed
blocks and are hashed one block after the other, as a digest can't be put together from parts.

Defined results: a null turn comes first; turns of equal number (repeated rows too) follow each other by the hash of
role and text; null role or text is empty; rows without ``conv_id`` take no part; very long texts are hashed and counted
where they are read; an empty table gives no node; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, arrow_schema, partitions, store, to_numpy

# Every group of so many ids opens with the conversation whose first turns the others take over.
GROUP, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
KEY_BYTES = 16

PIECE, ROW, BLOCK = 0, 1, 2
PARTS = (
    "kind int, block long, l int, r int, n int, d long, up_l int, up_r int, rep long, w long, c long, ends binary, sha string, "
    "up_p1 long, up_p2 long, next_p1 long, next_p2 long, conv_id long, words long, lcp long, least long, "
    "first_level int, first_p1 long, first_p2 long, first_seq binary, last_level int, last_p1 long, last_p2 long, last_seq binary"
)


# rebuilding conversations


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, words) of every turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id IS NOT NULL")
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def _numbered(batches):
    """Adds the task, and the position among the task's rows of the same conversation."""
    task, conv, n = TaskContext.get().partitionId(), None, 0
    for b in batches:
        ids = to_numpy(b.column("conv_id"))
        if not len(ids):
            continue
        change = np.flatnonzero(np.diff(ids) != 0) + 1
        start = np.concatenate([[0], change])
        at = np.arange(len(ids)) - np.repeat(start, np.diff(np.append(start, len(ids))))
        if ids[0] == conv:
            at[: start[1] if len(start) > 1 else len(ids)] += n
        conv, n = ids[-1], int(at[-1]) + 1
        columns = [b.column("conv_id"), b.column("key"), b.column("words"), pa.array(np.full(len(ids), task), pa.int32()), pa.array(at, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "key", "words", "task", "at"])


def positions(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, key, words): turns numbered from 0 per conversation, also one that many tasks share."""
    order = ["conv_id", F.asc_nulls_first("turn"), "key", "_row"]
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(partitions(rows.sparkSession), *order)
    local = store(dealt.sortWithinPartitions(*order).mapInArrow(_numbered, "conv_id long, key string, words long, task int, at long"), "turn_rows")
    counts = local.groupBy("conv_id", "task").agg(F.max("at").alias("top"))
    before = F.sum(F.col("top") + 1).over(Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    # only the first conversation of a task can have begun in an earlier one: one row per task at most
    late = counts.withColumn("before", before).where("before IS NOT NULL").select("conv_id", "task", "before")
    return local.join(F.broadcast(late), ["conv_id", "task"], "left").select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "key", "words")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns after the first h come after the first h turns of the group's opening conversation; and ids left without turns.

    h is the crc32 of the id written as text, modulo 4.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h")
    convs = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("*", h, (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    heads = rows.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < HEADS - 1)).select(F.col("conv_id").alias("base"), "pos", "key", "words")
    sizes = heads.groupBy("base").agg(F.count(F.lit(1)).alias("there"))
    convs = convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    taken = convs.where("taken > 0").join(heads, "base").where("pos < taken").select("conv_id", "pos", "key", "words")
    own = rows.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "words")
    return taken.unionAll(own), convs.where("taken = 0 AND n <= h").select("conv_id")


def sequence_rows(sequences: DataFrame, without: DataFrame, turns_per_row: int) -> DataFrame:
    """Conversations in rows of ``turns_per_row`` keys, with hashes of the turns before and up to the row's end."""
    turn = F.sort_array(F.collect_list(F.struct("pos", "key", "words")))
    rows = sequences.groupBy("conv_id", F.floor(F.col("pos") / turns_per_row).cast("int").alias("level")).agg(turn.alias("t"))
    rows = rows.select("conv_id", "level", F.unhex(F.array_join("t.key", "")).alias("seq"), F.col("t.words").alias("words"))
    none = without.select("conv_id", F.lit(0).alias("level"), F.lit(b"").alias("seq"), F.array().cast("array<bigint>").alias("words"))
    rows = rows.unionAll(none)
    of_conv = Window.partitionBy("conv_id").orderBy("level")
    before = of_conv.rowsBetween(Window.unboundedPreceding, -1)
    total = F.aggregate("words", F.lit(0).cast("bigint"), lambda a, x: a + x)

    def so_far(salt: int, frame) -> Column:
        """A hash of the turns up to a row: sums of row hashes that know their place."""
        each = F.xxhash64(F.lit(salt), "level", "seq").cast("decimal(38,0)")
        return F.xxhash64(F.coalesce(F.sum(each).over(frame), F.lit(0).cast("decimal(38,0)")).cast("string"))

    upto = of_conv.rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(
        "conv_id", "level", "seq", "words", so_far(1, before).alias("p1"), so_far(2, before).alias("p2"), so_far(1, upto).alias("q1"), so_far(2, upto).alias("q2"),
        F.coalesce(F.sum(total).over(before), F.lit(0)).alias("above"), F.lead("level").over(of_conv).isNotNull().alias("more"),
    )


# blocks of sorted rows


class RangeMin:
    """Sparse table of range minima: ``tables[k][i]`` is the least of ``values[i : i + 2**k]``."""

    def __init__(self, values: np.ndarray):
        self.tables, width = [np.asarray(values)], 1
        while 2 * width <= len(values):
            t = self.tables[-1]
            self.tables.append(np.minimum(t[: len(t) - width], t[width:]))
            width *= 2

    def least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minima of ``values[a:b]``, none of them empty."""
        k = np.frexp(b - a)[1] - 1
        out = np.empty(len(a), self.tables[0].dtype)
        for j, t in enumerate(self.tables):
            at = k == j
            out[at] = np.minimum(t[a[at]], t[b[at] - (1 << j)])
        return out

    def left(self, at: np.ndarray, d: np.ndarray) -> np.ndarray:
        """How far each ``at`` can go down while ``values[at] >= d``: the smallest place reached."""
        at = at.copy()
        for k in range(len(self.tables) - 1, -1, -1):
            start = at - (1 << k) + 1
            go = np.flatnonzero(start >= 0)
            go = go[self.tables[k][start[go]] >= d[go]]
            at[go] -= 1 << k
        return at

    def right(self, at: np.ndarray, d: np.ndarray) -> np.ndarray:
        """How far each ``at`` can go up while ``values[at + 1] >= d``."""
        at = at.copy()
        for k in range(len(self.tables) - 1, -1, -1):
            go = np.flatnonzero(at + 1 < len(self.tables[k]))
            go = go[self.tables[k][at[go] + 1] >= d[go]]
            at[go] += 1 << k
        return at


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` items in a row: which row, and which item of it."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def common_prefixes(level, p1, p2, seqs: list[bytes], turns_per_row: int) -> np.ndarray:
    """Common depth of each row with the one before it; -1 where they share no prefix row (and for the first)."""
    keys = np.frombuffer(b"".join(seqs), np.uint64).reshape(-1, 2)
    size = np.array([len(s) // KEY_BYTES for s in seqs], np.int64)
    start = np.cumsum(size) - size
    both = np.minimum(size, np.append(0, size[:-1]))
    both[0] = 0
    row, item = _spread(both)
    differ = (keys[start[row] + item] != keys[start[row - 1] + item]).any(axis=1)
    shared = both.copy()
    np.minimum.at(shared, row[differ], item[differ])
    same = np.append(False, (np.diff(level) == 0) & (np.diff(p1) == 0) & (np.diff(p2) == 0))
    return np.where(same, level.astype(np.int64) * turns_per_row + shared, -1)


def ids_text(ids) -> bytes:
    return ",".join(map(str, ids)).encode()


def _block(block: int, rows: pa.Table, edge: tuple | None, turns_per_row: int) -> dict:
    """The pieces, rows and edges of one block; ``edge`` is the last row of the task's block before."""
    get = lambda c: to_numpy(rows.column(c).combine_chunks())
    level, p1, p2, conv, above, q1, q2 = (get(c).astype(np.int64) for c in ("level", "p1", "p2", "conv_id", "above", "q1", "q2"))
    more, seqs, n = get("more").astype(bool), rows.column("seq").to_pylist(), len(conv)
    words = to_numpy(rows.column("words").combine_chunks().flatten()).astype(np.int64)
    size = np.array([len(s) // KEY_BYTES for s in seqs], np.int64)
    start, cum = np.cumsum(size) - size, np.append(0, np.cumsum(words))
    lcp = common_prefixes(level, p1, p2, seqs, turns_per_row)
    top = level * turns_per_row
    reach, smallest = RangeMin(lcp), RangeMin(conv)

    # candidates: every depth of every row; the root is depth 0 of level 0
    ci, item = _spread(size + (level == 0))
    cd = top[ci] + item + (level[ci] > 0)
    first = reach.left(ci, cd) == ci
    l, d = ci[first], cd[first]
    r = reach.right(l, d) + 1
    up_l, up_r = reach.left(l, d - 1), reach.right(l, d - 1) + 1
    at = d - top[l]  # turns of the row that the node holds
    none = d == 0
    w = np.where(none, 0, words[np.maximum(start[l] + at - 1, 0)] if len(words) else 0)
    c = np.where(none, 0, above[l] + cum[start[l] + np.maximum(at - 1, 0)] - cum[start[l]])

    # rows that end in the same place follow each other
    depth = top + size
    step = np.append(True, (lcp[1:] != depth[1:]) | (depth[1:] != depth[:-1]) | (more[1:] != more[:-1]))
    run_end = np.append(np.flatnonzero(step)[1:], n)[np.cumsum(step) - 1]
    n_ends = np.where((depth[l] == d) & ~more[l], np.minimum(run_end[l], r) - l, 0)
    inside = (l > 0) & (r < n)
    ends, sha = [None] * len(l), [None] * len(l)
    for k in range(len(l)):
        if inside[k]:
            sha[k] = hashlib.sha256(ids_text(conv[l[k] : l[k] + n_ends[k]].tolist())).hexdigest()
        elif n_ends[k]:
            ends[k] = zlib.compress(conv[l[k] : l[k] + n_ends[k]].tobytes())

    goes_on = (d == top[l] + turns_per_row) & more[r - 1]
    from_row = (level[l] > 0) & (d == top[l] + 1)
    mask = lambda x, keep: pa.array(x, pa.int64(), mask=~keep)
    whole = (int(level[0]), int(p1[0]), int(p2[0]), seqs[0]), (int(level[-1]), int(p1[-1]), int(p2[-1]), seqs[-1])
    pieces = {
        "kind": np.full(len(l), PIECE), "block": np.full(len(l), block), "l": l, "r": r, "n": np.full(len(l), n), "d": d, "up_l": up_l, "up_r": up_r,
        "rep": smallest.least(l, r), "w": w, "c": c, "ends": ends, "sha": sha,
        "up_p1": mask(p1[l], from_row), "up_p2": mask(p2[l], from_row), "next_p1": mask(q1[r - 1], goes_on), "next_p2": mask(q2[r - 1], goes_on),
    }
    members = {"kind": np.full(n, ROW), "block": np.full(n, block), "l": np.arange(n), "conv_id": conv, "words": cum[start + size] - cum[start]}
    facts = {"kind": [BLOCK], "block": [block], "n": [n], "lcp": [between(edge, whole[0], turns_per_row) if edge else None], "least": [int(lcp[1:].min()) if n > 1 else None]}
    for name, side in zip(("first", "last"), whole, strict=True):
        facts |= {f"{name}_{k}": [v] for k, v in zip(("level", "p1", "p2", "seq"), side, strict=True)}
    return {"parts": [pieces, members, facts], "edge": whole[1]}


def between(a: tuple, b: tuple, turns_per_row: int) -> int:
    """Common depth of two rows (level, p1, p2, seq)."""
    column = [np.array([x[i] for x in (a, b)], np.int64) for i in range(3)]
    return int(common_prefixes(*column, [a[3], b[3]], turns_per_row)[1])


def _blocks(turns_per_row: int, rows_per_block: int):
    schema = arrow_schema(T._parse_datatype_string(PARTS))

    def run(batches):
        task, number, edge, held, size = TaskContext.get().partitionId(), 0, None, [], 0

        def emit():
            nonlocal number, edge, held, size
            out = _block((task << 32) + number, pa.Table.from_batches(held), edge, turns_per_row)
            number, edge, held, size = number + 1, out["edge"], [], 0
            for part in out["parts"]:
                n = len(part["block"])
                yield pa.RecordBatch.from_arrays([pa.array(part[f.name], f.type) if f.name in part else pa.nulls(n, f.type) for f in schema], schema=schema)

        for b in batches:
            # a block holds a bounded number of turns, a row counts as one at least
            cost = np.cumsum(np.maximum(to_numpy(pc.binary_length(b.column("seq"))) // KEY_BYTES, 1))
            at = 0
            while at < b.num_rows:
                done = int(cost[at - 1]) if at else 0
                upto = max(at + 1, int(np.searchsorted(cost, done + rows_per_block - size, "right")))
                held.append(b.slice(at, upto - at))
                size += int(cost[upto - 1]) - done
                at = upto
                if size >= rows_per_block or at < b.num_rows:
                    yield from emit()
        if held:
            yield from emit()

    return run


# nodes of all blocks


class Places:
    """Two numbers per block, and from them the first block of any piece's node."""

    def __init__(self, facts: DataFrame, turns_per_row: int):
        blocks = sorted(facts.select("block", "lcp", "least").collect())
        self.block = np.array([b.block for b in blocks], np.int64)
        # where two tasks meet, their outer rows are compared here: two rows per task
        meet = [(a.block, b.block) for a, b in zip(blocks, blocks[1:], strict=False) if b.lcp is None]
        outer = {r.block: r for r in facts.where(F.col("block").isin(sorted({x for pair in meet for x in pair}))).drop("least").collect()} if meet else {}
        side = lambda b, s: tuple(outer[b][f"{s}_{k}"] for k in ("level", "p1", "p2", "seq"))
        met = {b: between(side(a, "last"), side(b, "first"), turns_per_row) for a, b in meet}
        joint = [-1] + [b.lcp if b.lcp is not None else met[b.block] for b in blocks[1:]]
        self.joint = np.array(joint[: len(blocks)], np.int64)
        inside = np.array([np.iinfo(np.int64).max if b.least is None else b.least for b in blocks], np.int64)
        self.through = RangeMin(np.minimum(self.joint, inside))

    def node(self, block: np.ndarray, l: np.ndarray, open_right: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, place) that name a node together with its depth: place -1 says that it goes on beyond its first block."""
        at = np.searchsorted(self.block, block)
        comes = (l == 0) & (self.joint[at] >= d)
        first = at.copy()
        first[comes] = self.through.left(at[comes] - 1, d[comes])
        return self.block[first], np.where(comes | open_right, -1, l)


def _named(places: Places):
    """Names the node of each piece and its parent; a parent in another level is named by the hash of its turns."""

    def run(batch):
        get = lambda c: to_numpy(batch.column(c)).astype(np.int64)
        block, l, r, n, d, up_l, up_r = map(get, ("block", "l", "r", "n", "d", "up_l", "up_r"))
        b, place = places.node(block, l, r == n, d)
        ub, uplace = places.node(block, up_l, up_r == n, d - 1)
        other = batch.column("up_p1").is_valid().to_numpy(zero_copy_only=False)
        up1, up2 = (to_numpy(batch.column(c).fill_null(0)).astype(np.int64) for c in ("up_p1", "up_p2"))
        out = {c: batch.column(c) for c in ("block", "l", "r", "d", "rep", "w", "c", "ends", "sha", "next_p1", "next_p2")}
        up_d = np.where(other, up2, d - 1)
        return out | {"nb": b, "np": place, "ub": np.where(other, -1, ub), "up": np.where(other, up1, uplace), "ud": up_d}

    return run


NAMED = "block long, l int, r int, d long, rep long, w long, c long, ends binary, sha string, next_p1 long, next_p2 long, nb long, np long, ub long, up long, ud long"


def _sums(pieces: pa.Table, rows: pa.Table) -> pa.Table:
    """Sums of X and leaves over the members of each piece of one block."""
    get = lambda t, c: to_numpy(t.column(c).combine_chunks()).astype(np.int64)
    order = np.argsort(get(rows, "l"))
    x, leaf, conv = (get(rows, c)[order] for c in ("x", "leaf", "conv_id"))
    l, r, rep = get(pieces, "l"), get(pieces, "r"), get(pieces, "rep")
    by_conv = np.argsort(conv, kind="stable")
    of_rep = x[by_conv[np.searchsorted(conv[by_conv], rep)]]
    total = lambda v: (s := np.append(0, np.cumsum(v)))[r] - s[l]
    return pa.table({"nb": pieces.column("nb"), "np": pieces.column("np"), "d": pieces.column("d"), "rep": rep, "x": total(x), "leaves": total(leaf), "rep_x": of_rep})


def _ends(batches):
    """The digest of each node's ids, whose packed parts come in order."""
    node, digest, begun = None, None, False

    def row():
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in node] + [pa.array([digest.hexdigest()])], ["nb", "np", "d", "sha"])

    for b in batches:
        for key, packed in zip(zip(*(b.column(c).to_pylist() for c in ("nb", "np", "d")), strict=True), b.column("ends"), strict=True):
            if key != node:
                if node is not None:
                    yield row()
                node, digest, begun = key, hashlib.sha256(), False
            ids = np.frombuffer(zlib.decompress(packed.as_py()), np.int64)
            digest.update((b"," if begun else b"") + ids_text(ids.tolist()))
            begun = True
    if node is not None:
        yield row()


def trie(conversations: DataFrame, turns_per_row: int = 512, block_turns: int = 1 << 16) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The driver holds two numbers per block of ``block_turns`` turns and the outer rows of each task.
    """
    parts_number = partitions(conversations.sparkSession)
    sequences, without = rebuilt(store(positions(turns(conversations)), "turns"))
    rows = sequence_rows(sequences, without, turns_per_row)
    order = ["level", "p1", "p2", "seq", "more", "conv_id"]
    ordered = rows.repartitionByRange(parts_number, *order).sortWithinPartitions(*order)
    parts = store(ordered.mapInArrow(_blocks(turns_per_row, block_turns), PARTS), "trie_parts")

    edges = [c for c in parts.columns if c.startswith(("first_", "last_"))]
    places = Places(parts.where(F.col("kind") == BLOCK).select("block", "lcp", "least", *edges), turns_per_row)
    pieces = store(arrow_map(parts.where(F.col("kind") == PIECE), _named(places), NAMED), "trie_pieces")
    name = ["nb", "np", "d"]
    size = (F.col("r") - F.col("l")).cast("long")
    nodes = pieces.groupBy(*name).agg(F.sum(size).alias("n_convs"), F.min("rep").alias("conv_id"), *[F.max(c).alias(c) for c in ("w", "c", "ub", "up", "ud", "next_p1", "next_p2")])
    nodes = store(nodes, "trie_nodes")

    # parents in an earlier row of the conversation are found by the hash of the turns up to there
    goes_on = nodes.where("next_p1 IS NOT NULL").select(F.col("next_p1").alias("up"), F.col("next_p2").alias("ud"), F.col("nb").alias("to_b"), F.col("np").alias("to_p"), F.col("d").alias("to_d"))
    across = nodes.where("ub = -1").join(goes_on, ["up", "ud"]).where("to_d = d - 1").withColumns({"ub": F.col("to_b"), "up": F.col("to_p"), "ud": F.col("to_d")})
    linked = nodes.where("ub <> -1").unionAll(across.select(nodes.columns))
    parent = nodes.select(F.col("nb").alias("ub"), F.col("np").alias("up"), F.col("d").alias("ud"), F.col("conv_id").alias("parent_conv_id"))
    above = linked.where("d > 0")
    counts = above.groupBy("ub", "up", "ud").agg(F.count(F.lit(1)).alias("n_children")).select(F.col("ub").alias("nb"), F.col("up").alias("np"), F.col("ud").alias("d"), "n_children")
    held = above.join(parent, ["ub", "up", "ud"]).unionByName(linked.where("d = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    held = held.join(counts, name, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    held = store(held.select(*name, "n_convs", "conv_id", "w", "c", "parent_conv_id", "n_children"), "trie_linked")

    members = parts.where(F.col("kind") == ROW).select("block", "l", "conv_id", "words")
    own = held.groupBy("conv_id").agg(F.sum("w").alias("own"), F.max((F.col("n_children") == 0).cast("int")).alias("leaf"))
    of_conv = members.groupBy("conv_id").agg(F.sum("words").alias("all")).join(own, "conv_id", "left")
    of_conv = of_conv.select("conv_id", (F.col("all") - F.coalesce("own", F.lit(0))).alias("x"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    valued = members.select("block", "l", "conv_id").join(of_conv, "conv_id")
    sums = pieces.select("block", "l", "r", "rep", *name).groupBy("block").cogroup(valued.groupBy("block")).applyInArrow(_sums, "nb long, np long, d long, rep long, x long, leaves long, rep_x long")
    sums = sums.groupBy(*name).agg(F.sum("x").alias("x"), F.sum("leaves").alias("n_leaves"), F.min(F.struct("rep", "rep_x")).alias("least"))

    inside = pieces.where("sha IS NOT NULL").select(*name, "sha")
    packed = pieces.where("ends IS NOT NULL").select(*name, "block", "ends").repartition(parts_number, *name).sortWithinPartitions(*name, "block")
    shas = inside.unionAll(packed.mapInArrow(_ends, "nb long, np long, d long, sha string"))
    out = held.join(sums, name).join(shas, name, "left")
    saved = F.col("x") - F.col("least.rep_x") - (F.col("n_convs") - 1) * F.col("c")
    return out.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
