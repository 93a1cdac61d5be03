"""Benchmark decontamination: passages of a text within a bounded edit distance of a test item.

Texts and items are read as letters and digits in lower case with single blanks between words.  An item of m
characters forgives k = floor(rate * m) edits and is split into k + 1 pieces.  A passage within k edits holds at least
one piece unchanged (pigeonhole), at about the place the piece has in the item; exact piece hits come from one
Aho-Corasick pass over the text.  Each hit names a window that any such passage must lie in, and Myers' bit-parallel
algorithm, on one integer of m bits, finds the least distance inside it.

An item of fewer than ``whole_below`` characters forgives nothing and counts only where its words stand whole: its one
piece goes through the same automaton, and a hit inside a longer word is none.

Items are searched in blocks of at most ``block`` characters in all, so what a task is sent is bounded however large
the benchmark grows; the text is read once for each block.

Defined results: null and empty texts hold nothing; null items, and items without a letter or digit, are not searched;
repeated items are separate items; of passages at equal distance the first counts; very long texts are searched whole,
in one pass; repeated rows give repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, documents

HITS = "doc_id long, item_id long, distance int, item_chars int, start int, end int"
_OTHER = re.compile(r"[\W_]+")


def plain(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def edits(length: int, rate: float) -> int:
    return int(length * rate)


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget`` + 1 pieces (offset, text) of nearly equal length."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Myers:
    """The least distance of an item to any stretch of a text, and where that stretch ends."""

    def __init__(self, item: str):
        self.size, self.masks = len(item), {}
        for i, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << i
        self.full, self.top = (1 << len(item)) - 1, 1 << (len(item) - 1)

    def search(self, text: str, budget: int) -> tuple[int, int] | None:
        plus, minus, score, best = self.full, 0, self.size, None
        full, top, masks = self.full, self.top, self.masks
        for i, c in enumerate(text):
            eq = masks.get(c, 0)
            down = eq | minus
            across = (((eq & plus) + plus) ^ plus) | eq
            more = minus | (full & ~(across | plus))
            less = plus & across
            if more & top:
                score += 1
            elif less & top:
                score -= 1
            # the item may begin anywhere in the text: nothing is shifted in at the bottom
            more, less = (more << 1) & full, (less << 1) & full
            plus, minus = less | (full & ~(down | more)), more & down
            if score <= budget and (best is None or score < best[0]):
                best = (score, i + 1)
        return best


class Matcher:
    """All items of one block over one Aho-Corasick automaton of their pieces."""

    def __init__(self, items: list[tuple[int, str]], rate: float, whole_below: int):
        import ahocorasick

        self.items = items
        self.whole = [len(text) < whole_below for _, text in items]
        self.budget = [0 if whole else edits(len(text), rate) for (_, text), whole in zip(items, self.whole, strict=True)]
        self.myers = [Myers(text) for _, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(items):
            for at, piece in pieces(text, self.budget[number]):
                places.setdefault(piece, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in places.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item, distance, item length, start of the window, end of the passage): the best passage of every item found."""
        windows: dict[int, list[tuple[int, int]]] = {}
        words: dict[int, tuple[int, int]] = {}
        for last, (size, owners) in self.automaton.iter(text):
            for number, at in owners:
                if self.whole[number]:
                    a, b = last + 1 - size, last + 1
                    if number not in words and text[a - 1 : a] in ("", " ") and text[b : b + 1] in ("", " "):
                        words[number] = (a, b)
                    continue
                budget, start = self.budget[number], last + 1 - size - at
                window = (max(0, start - budget), start + len(self.items[number][1]) + budget)
                mine = windows.setdefault(number, [])
                if mine and window[0] <= mine[-1][1] and window[1] >= mine[-1][0]:
                    # hits of one passage, and of passages that overlap, share a window
                    window = (min(window[0], mine[-1][0]), max(window[1], mine.pop()[1]))
                mine.append(window)
        out = [(self.items[number][0], 0, b - a, a, b) for number, (a, b) in words.items()]
        for number, mine in windows.items():
            best = None
            for a, b in mine:
                if (hit := self.myers[number].search(text[a:b], self.budget[number])) and (best is None or hit[0] < best[0]):
                    best = (hit[0], a, a + hit[1])
                    if not hit[0]:
                        break
            if best:
                item_id, item = self.items[number]
                out.append((item_id, best[0], len(item), max(best[1], best[2] - len(item) - self.budget[number]), best[2]))
        return out


def _blocks(benchmark: DataFrame, block: int):
    """Items in turn, at most ``block`` characters of them at once."""
    some, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        if text := plain(row["text"]):
            if some and size + len(text) > block:
                yield some
                some, size = [], 0
            some.append((row["item_id"], text))
            size += len(text)
    if some:
        yield some


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, whole_below: int = 30, block: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, distance, item_chars, start, end): each document's best passage for each item it holds.

    ``start`` and ``end`` count characters of the plain text; the passage lies between them.
    """
    found = None
    texts = documents(docs)
    for items in _blocks(benchmark, block):
        part = arrow_map(texts, _search(items, rate, whole_below), HITS)
        if found is not None:
            found = found.unionAll(part)
        else:
            found = part
    return found if found is not None else docs.sparkSession.createDataFrame([], HITS)


def _search(items: list[tuple[int, str]], rate: float, whole_below: int):
    class Search:
        def __init__(self):
            self.matcher = Matcher(items, rate, whole_below)

        def __call__(self, batch):
            rows = [(doc, *hit) for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for hit in self.matcher.find(plain(text))]
            names = ("doc_id", "item_id", "distance", "item_chars", "start", "end")
            return dict(zip(names, zip(*rows, strict=True), strict=True)) if rows else None

    return Search


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = 0.08, whole_below: int = 30, block: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows that hold a passage of an item; all columns stay."""
    fields: T.StructType = docs.schema
    for items in _blocks(benchmark, block):

        class Keep:
            def __init__(self, items=items):
                self.matcher = Matcher(items, rate, whole_below)

            def __call__(self, batch):
                import pyarrow as pa

                keep = [not self.matcher.find(plain(t or "")) for t in batch.column("text").to_pylist()]
                kept = batch.filter(pa.array(keep, pa.bool_()))
                return {f.name: kept.column(f.name) for f in fields} if kept.num_rows else None

        docs = arrow_map(docs, Keep, fields)
    return docs

