"""Packing of tokenized documents into sequences: shortest-pack-first over the length histogram.

Three steps, of which only the first touches text:

1. every document is tokenized once, its ids are cut into pieces of ``max_len`` and a rest, and only
   (document, start, length, checksum) leaves the task;
2. the histogram of piece lengths, at most ``max_len`` numbers however many documents there are, is packed:
   lengths are placed longest first, each into the pack with the most room, and equal packs are kept as one
   pattern with a count;
3. pieces get a rank within their length.  Rows are range-partitioned by (length, document, start, row), so a length
   that a third of all pieces share is spread over many tasks, whatever their documents; the rank is the row's place in its task plus the count of
   that length in earlier tasks.  The rank tells pattern, copy of the pattern, and offset.

Defined results: null text is the empty text, an empty document is the one end id; rows that repeat a ``doc_id``
are documents of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, documents, partitions, store, to_numpy

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"
#: longest word kept in the cache of a Python worker, and how many words it holds
WORD_BYTES, CACHE_WORDS = 40, 1_000_000
STOPS = b".,;:!?"
#: documents tokenized at once
SLICE = 2000


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet of these vocabularies: printable bytes as they are, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of the texts of an Arrow array, with their end id, as one flat array and each text's bounds.

    The tokenizer's pattern never joins across white space and drops it, so a text's ids are those of its
    words in turn, and words repeat.  Arrow splits the texts and finds the different words; each is tokenized
    once, and numpy puts the ids of all words in a row.  A bounded cache of words lasts as long as the worker.
    Stops after a word are a token of their own, so a word is cached without them.
    """

    workers: dict[str, WordTokenizer] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.letters, self.cores = Tokenizer.from_file(path), _byte_letters(), {}

    @classmethod
    def of_worker(cls, path: str) -> WordTokenizer:
        if path not in cls.workers:
            cls.workers[path] = cls(path)
        return cls.workers[path]

    def _ids(self, word: bytes) -> bytes:
        text = word.decode()
        if len(word) <= WORD_BYTES and text.isalpha() and max(text) <= "\xff" and (text := text.lower()).isalpha():
            # one word of Latin-1 letters: no normalizing or splitting is left to do
            ids = [t.id for t in self.tokenizer.model.tokenize(text.encode().decode("latin-1").translate(self.letters))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _cached(self, part: bytes) -> bytes:
        if (found := self.cores.get(part)) is None:
            found = self._ids(part)
            if len(part) <= WORD_BYTES:
                self.cores[part] = found
        return found

    def word(self, word: bytes) -> bytes:
        core = word.rstrip(STOPS)
        if not core or len(core) == len(word) or not core[-1:].isalpha():
            return self._cached(word)  # stops after a digit or a sign may join what is before them
        return self._cached(core) + self._cached(word[len(core) :])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.cores) > CACHE_WORDS:
            self.cores.clear()
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        words = split.flatten().dictionary_encode()
        each = [self.word(w) for w in words.dictionary.cast(pa.large_binary()).to_pylist()]
        size = np.array([len(x) // 4 for x in each], np.int64)
        flat, first = np.frombuffer(b"".join(each), "<u4"), np.cumsum(size) - size
        at = to_numpy(words.indices)
        n = size[at]
        before = np.cumsum(n) - n
        ids = flat[np.repeat(first[at] - before, n) + np.arange(n.sum())] if len(at) else flat
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        return ids, np.append(before, len(ids))[offsets]


def pieces(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: full pieces of ``max_len`` ids, then the rest."""
    end = np.array([end_id], "<u4").tobytes()

    class Cut:
        def __init__(self):
            self.tokenize = WordTokenizer.of_worker(tokenizer_path)

        def __call__(self, batch):
            out: dict[str, list] = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
            for at in range(0, batch.num_rows, SLICE):
                self.some(batch.slice(at, SLICE), out)
            return out

        def some(self, batch, out):
            ids, bounds = self.tokenize(batch.column("text"))
            view = memoryview(ids).cast("B")
            for doc, lo, hi in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                n = hi - lo + 1
                for at in range(0, n, max_len):
                    to = min(at + max_len, n)
                    crc = zlib.crc32(view[4 * (lo + at) : 4 * min(lo + to, hi)])
                    out["doc_id"].append(doc)
                    out["start"].append(at)
                    out["length"].append(to - at)
                    out["ids_crc32"].append(zlib.crc32(end, crc) if to == n else crc)
                    out["doc_tokens"].append(n)

    return arrow_map(documents(docs), Cut, PIECES)


def pack_histogram(counts: dict[int, int], max_len: int) -> list[tuple[int, tuple[int, ...]]]:
    """Patterns (count, lengths) that hold every length of the histogram as often as it occurs.

    The number of patterns depends on ``max_len``, not on the counts: a step uses up a length or a pattern.
    """
    room: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = max((s for s, packs in room.items() if packs), default=0)
            if space < length:
                fits = max_len // length
                # a new pack takes the length as often as it fits, which is where one-by-one placing ends
                packs, over = divmod(left, fits)
                if packs:
                    room[max_len - fits * length].append((packs, (length,) * fits))
                if over:
                    room[max_len - over * length].append((1, (length,) * over))
                break
            n, pattern = room[space].pop()
            used = min(n, left)
            if n > used:
                room[space].append((n - used, pattern))
            room[space - length].append((used, (*pattern, length)))
            left -= used
    return [pack for space in sorted(room) for pack in room[space]]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """For each (length, first rank): the sequence of that rank, and the offset in it.  Sorted."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T.copy(), strict=True))


def _places(df: DataFrame) -> DataFrame:
    """Adds ``part`` and ``place``, a row's place among the rows of its length in its task."""

    class Count:
        def __init__(self):
            self.length, self.n = None, 0

        def __call__(self, batch):
            length = to_numpy(batch.column("length"))
            first = np.flatnonzero(np.diff(length, prepend=length[0] - 1))
            place = np.arange(len(length)) - np.repeat(first, np.diff(np.append(first, len(length))))
            if length[0] == self.length:
                place[: first[1] if len(first) > 1 else len(place)] += self.n
            self.length, self.n = length[-1], int(place[-1]) + 1
            return {f: batch.column(f) for f in batch.schema.names} | {"place": place}

    return arrow_map(df, Count, PIECES + ", part int, place long")


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1) -> DataFrame:
    """``pieces`` of all documents with their ``sequence_id`` and ``offset``."""
    spark = docs.sparkSession
    # the stored row number tells apart pieces of equal length, document and start, such as those without doc_id
    cut = store(pieces(docs, tokenizer_path, max_len, end_id).withColumn("row", F.monotonically_increasing_id()), "pieces")
    by = ("length", "doc_id", "start", "row")
    ranged = cut.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by).drop("row")
    placed = store(_places(ranged.withColumn("part", F.spark_partition_id())), "places")
    # at most one row for each task and length, and only neighbouring tasks share a length
    per_task = sorted((r["length"], r["part"], r["n"]) for r in placed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, counts = {}, defaultdict(int)
    for length, part, n in per_task:
        before[length, part] = counts[length]
        counts[length] += n
    at = slots(pack_histogram(dict(counts), max_len))
    start_keys = np.array([(part << 32) + length for length, part in before], dtype=np.int64)
    order = np.argsort(start_keys)
    start_keys, starts = start_keys[order], np.array(list(before.values()), dtype=np.int64)[order]
    # length and rank as one sorted number; a rank is below 2 ** 50
    slot_keys = (at["length"] << 50) + at["rank"]

    def assign(batch):
        length, part = to_numpy(batch.column("length")), to_numpy(batch.column("part")).astype(np.int64)
        rank = to_numpy(batch.column("place")) + starts[np.searchsorted(start_keys, (part << 32) + length)]
        slot = np.searchsorted(slot_keys, (length << 50) + rank, side="right") - 1
        out = {f: batch.column(f) for f in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
        return out | {"sequence_id": at["sequence"][slot] + rank - at["rank"][slot], "offset": at["offset"][slot]}

    return arrow_map(placed, assign, PACKED)
