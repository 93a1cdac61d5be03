"""Toxicity by misspelling-tolerant lexicon hits and the context they stand in.

The lexicon is mined from labelled rows: words, and stems that many words begin with, which stand in toxic texts and
hardly in others.  Terms form a trie, and Levenshtein automata walk it: a state of the walk is the set of (trie node,
errors so far) a word may have reached.  States and their steps are built once as words need them, so a word costs a
few table look-ups, and nearly all words end in the dead state after two or three letters.  The number of errors a
term forgives grows with its length.

A hit's weight is the smoothed log odds of its term and error count on the labelled rows.  Its context window tells
quotation from abuse: quotation marks that open before and close after it, or words of reporting; against that, words
that address someone.  A logistic model over the summed weights of both kinds gives the score.

Only a bounded sample of labelled rows fits the model (``max_labelled``); every text is scored whole.

Defined results: null and empty texts, and texts without a letter, get the score of a text without hits; without
labelled rows of both classes every score is the share of toxic labels, 0 without labels; repeated rows give repeated
results, and a document labelled twice counts twice; null labels teach nothing; of equally near terms the first in alphabetical order is hit; very long texts
are scored whole; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, documents, remainder, store

WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"[^\W_]+(?:[@$!][^\W_]+)*")
#: digits and signs read as letters, and letters written three times or more
LEET = str.maketrans("013457@$!", "oieastasi")
RUNS = re.compile(r"(.)\1{2,}")
#: fixed values: marks of quotation, and words of reporting and of address in the languages at hand
OPEN_MARKS, CLOSE_MARKS = "\"“„«‹'‘‚", "\"”“»›'’‘"
REPORTS = frozenset("said says wrote called quoted quote quotes word term sagte schrieb nannte wort dit écrit mot dijo escribió palabra".split())
ADDRESS = frozenset("you your you're youre u du dich dein ihr euch tu toi te vous usted tú eres".split())
WINDOW = 8
#: different words (of 63 classes) that a term must follow: near copies of one text repeat their context
#: at least the first number, and half of its texts up to the second
CONTEXTS = 5, 16
#: times the rate of the clean texts that a term's rate among toxic texts must reach
STANDS_OUT = 25


class Lexicon:
    """Trie of terms with the lazily built product of their Levenshtein automata.

    ``terms`` holds (text, whole): a whole word, or a stem that the word goes on from.
    """

    def __init__(self, terms: list[tuple[str, bool]]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, list[int]] = defaultdict(list)
        self.reach: list[int] = [0]
        for number, (text, whole) in enumerate(terms):
            node, allowed = 0, forgiven(text, whole)
            self.reach[0] = max(self.reach[0], allowed)
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.reach.append(0)
                node = self.children[node][letter]
                self.reach[node] = max(self.reach[node], allowed)
            self.ends[node].append(number)
        self.steps: dict[frozenset, dict[str, frozenset]] = {}
        self.start = self._closed({0: 0})
        self.known: dict[str, tuple[int, int] | None] = {}

    def _closed(self, states: dict[int, int]) -> frozenset:
        """With the letters a word may have left out; no node with more errors than a term below it forgives."""
        todo = list(states)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                errors = states[node] + 1
                if errors <= self.reach[child] and errors < states.get(child, 99):
                    states[child] = errors
                    todo.append(child)
        return frozenset(states.items())

    def _step(self, at: frozenset, letter: str) -> frozenset:
        after: dict[int, int] = {}

        def put(node, errors):
            if errors <= self.reach[node] and errors < after.get(node, 99):
                after[node] = errors

        for node, errors in at:
            put(node, errors + 1)
            for edge, child in self.children[node].items():
                put(child, errors + (edge != letter))
        return self._closed(after)

    def _walk(self, word: str) -> tuple[int, int] | None:
        """(errors, term) of the best term for a word."""
        at, best = self.start, (9, -1)
        for i, letter in enumerate(word, 1):
            known = self.steps.setdefault(at, {})
            if letter not in known:
                known[letter] = self._step(at, letter)
            at = known[letter]
            if not at:
                break
            for node, errors in at:
                for term in self.ends.get(node, ()):
                    text, whole = self.terms[term]
                    if errors <= forgiven(text, whole) and (not whole or i == len(word)):
                        best = min(best, (errors, term))
        return best if best[1] >= 0 else None

    def find(self, token: str) -> tuple[int, int] | None:
        """The best hit among the readings of a token as it stands in the text."""
        best = None
        for part in TOKEN.findall(token.lower()):
            plain = part if part.isalpha() else part.translate(LEET) if any(map(str.isalpha, part)) else ""
            for word in {plain, RUNS.sub(r"\1", plain)}:
                if len(word) >= 3 and (hit := self._walk(word)) and (best is None or hit < best):
                    best = hit
        return best


def forgiven(text: str, whole: bool) -> int:
    """Errors a term forgives: none in short ones, whose neighbours are other words."""
    return (len(text) >= 5) + (len(text) >= 8) if whole else int(len(text) >= 6)


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """At most about ``max_labelled`` rows (doc_id, text, toxic), as many toxic ones as there are up to half."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {c: min(1.0, max_labelled / 2 / n[c]) for c in n}
    wanted = F.when(F.col("toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < wanted * 1_000_003)
    # bounded by max_labelled ids, so no text moves
    return documents(docs).join(F.broadcast(picked.limit(2 * max_labelled)), "doc_id")


def _mine(labelled: DataFrame, lengths: range, least: int, n_clean: int, n_toxic: int) -> tuple[dict[str, list[int]], dict[str, list[int]]]:
    """Document counts (clean, toxic) of words and of word beginnings that toxic texts hold often enough.

    Rates are evened for the classes' sizes.  ``choose_terms`` compares a term that stands out with terms that hold
    at least 0.9 of its toxic texts and no clean text more, so nothing below 0.9 of the factor is looked at.
    """

    def count(batch):
        counts: dict[tuple[str, bool], list[int]] = defaultdict(lambda: [0, 0, 0])
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words: dict[str, int] = defaultdict(int)
            before = ""
            for token in text.lower().split():
                for w in WORD.findall(token):
                    words[w] |= 1 << zlib.crc32(before.encode()) % 63
                before = token
            stems: dict[str, int] = defaultdict(int)
            for w, follows in words.items():
                for n in lengths:
                    if len(w) >= n:
                        stems[w[:n]] |= follows
            for whole, found in ((True, words), (False, stems)):
                for term, follows in found.items():
                    n = counts[term, whole]
                    n[toxic] += 1
                    n[2] |= follows if toxic else 0
        kept = [(t, w, *n) for (t, w), n in counts.items()]
        return dict(zip(("term", "whole", "clean", "toxic", "follows"), zip(*kept, strict=True), strict=True)) if kept else None

    parts = arrow_map(labelled.select("text", "toxic"), count, "term string, whole boolean, clean long, toxic long, follows long")
    sums = parts.groupBy("term", "whole").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.expr("bit_count(bit_or(follows))").alias("contexts"))
    even = (F.col("toxic") + 0.5) / (n_toxic + 1) >= 0.9 * STANDS_OUT * (F.col("clean") + 0.5) / (n_clean + 1)
    rows = sums.where((F.col("toxic") >= least) & even & (F.col("contexts") >= F.greatest(F.lit(CONTEXTS[0]), F.least(F.lit(CONTEXTS[1]), F.col("toxic") / 2)))).collect()
    return tuple({r["term"]: [r["clean"], r["toxic"]] for r in rows if r["whole"] is whole} for whole in (True, False))


def choose_terms(words: dict, stems: dict, n_clean: int, n_toxic: int, lengths: range) -> list[tuple[str, bool]]:
    """Words and stems whose toxic share, evened for the classes' sizes, stands out.

    A beginning is lengthened as long as it loses almost none of its texts; it is a whole word when that word
    alone accounts for it.
    """

    def good(clean: int, toxic: int) -> bool:
        return (toxic + 0.5) / (n_toxic + 1) >= STANDS_OUT * (clean + 0.5) / (n_clean + 1)

    longer_stems, own_words = defaultdict(list), defaultdict(list)
    for s in stems:
        longer_stems[s[:-1]].append(s)
    for w in words:
        for n in lengths:
            if len(w) >= n:
                own_words[w[:n]].append(w)
    chosen: dict[str, bool] = {}
    for stem in sorted((s for s, n in stems.items() if good(*n)), key=len):
        if any(stem.startswith(stem[:n]) and stem[:n] in chosen for n in lengths if n < len(stem)):
            continue
        long = stem
        while True:
            longer = [s for s in longer_stems[long] if stems[s][1] >= 0.97 * stems[stem][1]]
            if not longer:
                break
            long = longer[0]
        main = max(own_words[stem], key=lambda w: words[w][1], default=None)
        if main and words[main][1] >= 0.9 * stems[stem][1]:
            chosen[main] = True
        else:
            chosen[long] = False
    covered = {t for t, whole in chosen.items() if not whole}
    for word, n in words.items():
        if word not in chosen and len(word) >= 4 and good(*n) and not any(word[:n] in covered for n in lengths):
            chosen[word] = True
    return sorted(chosen.items())


def _quoted(tokens: list[str], at: int) -> bool:
    """A mark that opens before the hit and closes behind it, inside the window."""
    for i in range(at, max(-1, at - WINDOW - 1), -1):
        if tokens[i][:1] in OPEN_MARKS and tokens[i]:
            for j in range(i, min(len(tokens), at + WINDOW + 1)):
                if tokens[j].rstrip(".,;:!?")[-1:] in CLOSE_MARKS and len(tokens[j]) > 1 and tokens[j].rstrip(".,;:!?"):
                    return j >= at
    return False


def contexts(text: str, hits: dict[str, tuple[int, int]]) -> list[tuple[int, int, bool, bool]]:
    """(term, errors, quoted, addressed) of every hit of a text."""
    tokens, out = text.split(), []
    for i, token in enumerate(tokens):
        if (hit := hits.get(token)) is not None:
            near = {t.strip(".,;:!?\"'").lower() for t in tokens[max(0, i - WINDOW) : i + WINDOW + 1]}
            addressed = not near.isdisjoint(ADDRESS)
            reported = not addressed and not near.isdisjoint(REPORTS)
            out.append((hit[1], hit[0], reported or _quoted(tokens, i), addressed))
    return out


def text_hits(texts: pa.Array, lexicon: Lexicon) -> list[list[tuple[int, int, bool, bool]]]:
    """The hits of each text: different tokens are looked up once, and only texts with a hit are read again."""
    split = pc.utf8_split_whitespace(texts.cast(pa.large_string()))
    tokens = split.flatten().dictionary_encode()
    found = {t: hit for t in tokens.dictionary.to_pylist() if (hit := lexicon.find(t))}
    out: list[list] = [[] for _ in range(len(texts))]
    if found:
        is_hit = np.array([t in found for t in tokens.dictionary.to_pylist()], bool)[tokens.indices.to_numpy(zero_copy_only=False)]
        counted = np.append(0, np.cumsum(is_hit))[split.offsets.to_numpy() - split.offsets[0].as_py()]
        for i in np.flatnonzero(np.diff(counted)):
            out[i] = contexts(texts[int(i)].as_py(), found)
    return out


class Model:
    """Term weights and the logistic model over a text's summed hits."""

    def __init__(self, terms, weights, coefficients, base):
        self.terms, self.weights, self.coefficients, self.base = terms, weights, coefficients, base

    def features(self, hits) -> list[float]:
        abuse = quoted = addressed = 0.0
        for term, errors, in_quotes, to_someone in hits:
            weight = self.weights.get((term, errors), 0.0)
            if in_quotes:
                quoted += weight
            else:
                abuse += weight
                addressed += weight if to_someone else 0.0
        return [1.0, min(1.0, abuse / 2), math.log1p(abuse), math.log1p(quoted), math.log1p(addressed)]

    def score(self, hits) -> float:
        if self.coefficients is None:
            return self.base
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, float(np.dot(self.coefficients, self.features(hits)))))))


#: what the coefficients are drawn to where the labelled rows say little: abuse counts, quotation hardly does
PRIOR = np.array([-3.0, 4.0, 1.0, 0.2, 0.2])


def _logistic(x: np.ndarray, y: np.ndarray, sample_weight: np.ndarray, pull: float = 1.0) -> np.ndarray:
    beta = PRIOR.copy()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = sample_weight * p * (1 - p)
        step = np.linalg.solve((x * w[:, None]).T @ x + pull * np.eye(len(beta)), x.T @ (sample_weight * (y - p)) - pull * (beta - PRIOR))
        beta += np.clip(step, -1.0, 1.0)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 16_000, least: int = 5) -> Model:
    """Lexicon, weights and score from labelled rows.

    A term stands in at least ``least`` toxic texts of the sample, however large that is, so that a language with few
    of the labels has terms too; of exact copies with one label a single text counts.
    """
    rates = labels.where("toxic IN (0, 1)").agg(F.avg("toxic")).first()[0]
    labelled = store(labelled_sample(docs, labels, max_labelled).dropDuplicates(["text", "toxic"]), "labelled")
    n = Counter({r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()})
    if not n[0] or not n[1]:
        return Model([], {}, None, float(rates or 0.0))
    lengths = range(4, 9)
    terms = choose_terms(*_mine(labelled, lengths, least, n[0], n[1]), n[0], n[1], lengths)
    lexicon = Lexicon(terms)

    def hits(batch):
        found = text_hits(batch.column("text"), lexicon)
        return {"toxic": batch.column("toxic"), "hits": [[dict(zip(("term", "errors", "quoted", "addressed"), h, strict=True)) for h in one] for one in found]}

    # the bounded sample: a few numbers for each labelled text
    kind = "toxic int, hits array<struct<term:int,errors:int,quoted:boolean,addressed:boolean>>"
    rows = [(r["toxic"], [tuple(h) for h in r["hits"]]) for r in arrow_map(labelled.select("text", "toxic"), hits, kind).collect()]
    seen: dict[tuple[int, int], list[int]] = defaultdict(lambda: [0, 0])
    for toxic, one in rows:
        for key in {(term, errors) for term, errors, *_ in one}:
            seen[key][toxic] += 1
    weights = {}
    for term, (text, whole) in enumerate(terms):
        for errors in range(forgiven(text, whole) + 1):
            clean, toxic = seen[term, errors]
            # misspellings not seen in labelled rows keep a share of the term's weight
            prior = 3.0 * 0.6**errors
            odds = math.log((toxic + 0.2 * math.exp(prior)) / (n[1] + 1) * (n[0] + 1) / (clean + 0.2))
            weights[term, errors] = max(0.0, min(prior + 1, odds))
    model = Model(terms, weights, None, float(rates))
    x = np.array([model.features(one) for _, one in rows])
    y = np.array([toxic for toxic, _ in rows], float)
    # the sample's classes are weighed as they are in all labelled rows
    even = np.where(y == 1, rates / y.mean(), (1 - rates) / (1 - y.mean()))
    return Model(terms, weights, _logistic(x, y, even), float(rates))


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every document."""

    class Score:
        def __init__(self):
            self.lexicon = Lexicon(model.terms)

        def __call__(self, batch):
            scores = []
            for at in range(0, batch.num_rows, 2000):
                scores += [model.score(h) for h in text_hits(batch.column("text").slice(at, 2000), self.lexicon)]
            return {"doc_id": batch.column("doc_id"), "score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return arrow_map(documents(docs), Score, "doc_id long, score double, predicted int")


def train_labels(labels: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    return labels.where(remainder(F.col("doc_id"), modulus) != held_out)


def train_and_score(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, **settings) -> DataFrame:
    """Learns from labels outside the held-out fold; scores all documents."""
    model = fit(docs, train_labels(labels, modulus, held_out), **settings)
    fold = remainder(F.col("doc_id"), modulus)
    return score(docs, model).select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more; all columns stay."""
    fields = docs.schema

    class Keep:
        def __init__(self):
            self.lexicon = Lexicon(model.terms)

        def __call__(self, batch):
            texts = pc.fill_null(batch.column("text"), "")
            keep = [model.score(h) < threshold for h in text_hits(texts, self.lexicon)]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            return {f.name: kept.column(f.name) for f in fields} if kept.num_rows else None

    return arrow_map(docs, Keep, fields)
