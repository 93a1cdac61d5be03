"""The training-data operators against brute force, on nulls, empty and long texts, ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marelake.llm import (
    components, decontaminate, html_extract, html_pages, induced, language_id, line_dedup, packing, pii, queries, simhash,
    suffix_dedup, topk, toxicity,
)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_lines long, score double, H string"
WORDS = "stone river over walking under yellow candle basket morning winter garden silver quick letters anchor".split()


def frame(spark, rows):
    """Documents with other columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, 7, 0.5, "x") for i, t in rows], DOCS)


def prose(r, n):
    return " ".join(r.choice(WORDS) + r.choice(["", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    """Null, empty, blank, very long, repeated and shared texts; ids repeat and one is missing."""
    r = random.Random(3)
    shared, long = prose(r, 60), prose(r, 6000)
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, long), (5, shared), (6, shared), (6, shared), (7, prose(r, 20) + "\n" + shared), (None, shared)]
    rows += [(i, prose(r, r.randint(1, 80)) + "\n" + "A line that many texts hold\n" * r.randint(0, 3)) for i in range(10, 40)]
    rows += [(50, "aaaa " * 400), (51, "aaaa " * 300), (52, "\0" * 300), (53, "ünï " * 120), (54, prose(r, 20) + " " + shared[:250])]
    return rows


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


# line dedup


def lines_by_hand(rows):
    held = defaultdict(set)
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    for i, t in rows:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= 20:
                held[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(held[key(x)]) < 3 or i == max(held[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_line_dedup(spark, odd_rows, empty):
    docs = frame(spark, odd_rows)
    bitmaps = line_dedup.drop_bitmaps(docs)
    assert Counter(tuple(r) for r in line_dedup.digests(docs, bitmaps).collect()) == lines_by_hand(odd_rows)
    applied = line_dedup.apply(docs, bitmaps)
    assert applied.count() == len(odd_rows) and "H" in applied.columns
    assert not line_dedup.digests(empty, line_dedup.drop_bitmaps(empty)).collect()


def test_line_dedup_hot_line_over_many_tasks(spark):
    """One line in every document, spread over all range partitions: only the largest id keeps it."""
    rows = [(i, f"the very same line in all texts\nown line number {i} of this text") for i in range(3000)]
    got = line_dedup.digests(frame(spark, rows), line_dedup.drop_bitmaps(frame(spark, rows)))
    assert {r["doc_id"]: r["n_dropped"] for r in got.collect()} == {i: int(i != 2999) for i in range(3000)}


# packing


def test_packing_round_trip(spark, odd_rows, empty):
    from tokenizers import Tokenizer

    rows = [*odd_rows, (90, "It's <|endoftext|> a TEST... of 12.5% signs, ŒUVRE İstanbul ﬁ é don't")]
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    got = packing.pack(frame(spark, rows), queries.tokenizer_file()).collect()
    want = Counter()
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for at in range(0, len(ids), 2048):
            want[i, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes()), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048
    assert not packing.pack(empty, queries.tokenizer_file()).collect()


def test_pieces_without_an_id_are_spread_over_tasks(spark):
    rows = [(None, "same words")] * 400 + [(1, "same words")] * 5
    spread = packing.pack(frame(spark, rows).repartition(8), queries.tokenizer_file()).groupBy(F.input_file_name().alias("f")).count().collect()
    assert sum(r["count"] for r in spread) == 405 and max(r["count"] for r in spread) < 200


def test_histogram_packing_is_tight():
    r = random.Random(5)
    counts = Counter(min(2048, max(1, int(r.expovariate(1 / 500)))) for _ in range(5000))
    patterns = packing.pack_histogram(dict(counts), 2048)
    placed = Counter()
    for n, pattern in patterns:
        assert sum(pattern) <= 2048
        for length in pattern:
            placed[length] += n
    assert placed == counts
    assert sum(n * sum(p) for n, p in patterns) / (2048 * sum(n for n, _ in patterns)) > 0.98


# SimHash


def fingerprint_by_hand(text):
    from xxhash import xxh64

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    hashes = [xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, odd_rows, empty):
    got = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(frame(spark, odd_rows)).collect()}
    assert set(got) == {(i, f"{fingerprint_by_hand(t or ''):016x}") for i, t in odd_rows}
    assert got[2, "0" * 16] == got[3, "0" * 16] == 1
    assert {c for (i, _), c in got.items() if i in (5, 6, None)} == {5}
    assert not simhash.near_duplicates(empty).collect()


def roots_by_hand(points, radius):
    points = np.array(points, np.uint64)
    a, b = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= radius)
    return simhash._roots(len(points), a, b)


@pytest.mark.parametrize("leaf,sample", [(20, 5000), (200, 300), (100000, 100)])
def test_forest_finds_every_link(spark, leaf, sample):
    """Random points, pairs at distance 1 and 2, chains, and a dense ball that no block tells apart."""
    r = random.Random(leaf)
    points = {r.getrandbits(64) for _ in range(1500)}
    for p in list(points)[:200]:
        points.add(p ^ 1 << r.randrange(64) ^ 1 << r.randrange(64))
    chain = r.getrandbits(64)
    for _ in range(60):
        chain ^= 1 << r.randrange(64)
        points.add(chain)
    centre = r.getrandbits(64)
    points |= {centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for _ in range(800)}
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = components.components(simhash.links(fps, 2, leaf, sample))
    group = {r["node"]: r["root"] for r in found.collect()}
    got, want = defaultdict(set), defaultdict(set)
    for i, (p, root) in enumerate(zip(signed, roots_by_hand(points, 2), strict=True)):
        got[group.get(p, p)].add(i)
        want[root].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("mask", [0, 0xFFFF])
@pytest.mark.parametrize("longest", [0, 40, 10_000, None])
def test_links_of_a_dense_shard(mask, longest):
    """Look-ups and comparisons name the same groups, also where only some points are at home."""
    r = random.Random(mask + 5)
    centres = [r.getrandbits(64) for _ in range(4)]
    points = sorted({c ^ sum(1 << b for b in r.sample(range(16, 64), r.randint(0, 3))) for c in centres for _ in range(400)} | {r.getrandbits(64) for _ in range(300)})
    home = [r.random() < 0.5 for _ in points]
    a, b = simhash.shard_links(np.array(points, np.uint64), np.array(home), 2, np.uint64(mask), longest)

    def groups(pairs):
        root = {p: p for p in points}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        for x, y in pairs:
            x, y = sorted((find(x), find(y)))
            root[y] = x
        return [find(p) for p in points]

    near = [(p, q) for i, p in enumerate(points) for j, q in enumerate(points[:i]) if (p ^ q).bit_count() <= 2 and (home[i] or home[j]) and not (p ^ q) & mask]
    assert groups(zip(a.tolist(), b.tolist(), strict=True)) == groups(near) and near


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1002), (1002, 1000)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 1001: 1000, 1002: 1000}


# top-k


def topk_by_hand(vectors, k):
    fine = [(i, np.floor(64 * np.array(v, float)).astype(object)) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in fine:
        if q % 20 == 0:
            scores = sorted((-int(sum(x * y for x, y in zip(a, b, strict=False))), i) for i, b in fine if i != q)
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_top_k(spark, block):
    r = random.Random(8)
    vectors = [(i, [r.uniform(-1, 1) for _ in range(12)]) for i in range(160)]
    vectors += [(i, [0.5] * 12) for i in range(200, 260)]  # ties
    vectors += [(300, None), (320, [float("nan")] * 12), (340, [float("inf"), *[0.0] * 11]), (360, [None] * 12), (380, []), (400, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, score int")
    vectors = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), k=20, block=block)
    assert {tuple(x) for x in got.select("query_id", "rank", "vec_id", "score").collect()} == topk_by_hand(vectors, 20)
    few = df.limit(5)
    assert topk.top_k(few, few.where("vec_id % 20 = 0")).count() == 4
    assert not topk.top_k(df.limit(0), df.limit(0)).collect()


def test_top_k_of_repeated_rows_and_large_components(spark):
    r = random.Random(9)
    vectors = [(20, [r.uniform(-1, 1) for _ in range(6)])] * 9 + [(40, [1.5] * 6)] * 3 + [(i, [r.uniform(-1, 1) for _ in range(6)]) for i in range(1, 9)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    for block in (1, 4, 16):
        got = topk.top_k(df, df.where("vec_id % 20 = 0"), k=5, block=block).groupBy("query_id", "rank").count().collect()
        assert {(x["query_id"], x["rank"], x["count"]) for x in got} == {(q, n, c) for q, c in ((20, 9), (40, 3)) for n in range(1, 6)}
    for size in (1e6, 1e7, 1e30, 1e306):
        large = [(i, [r.choice([-1, 1]) * size * (1 + i), float(i), size]) for i in range(0, 60)]
        df = spark.createDataFrame(large, "vec_id long, embedding array<double>")
        got = topk.top_k(df, df.where("vec_id % 20 = 0"), k=7)
        most = 2**63 - 1
        want = set()
        whole = [(i, [int(np.clip(np.floor(64.0 * float(x)), -1e300, 1e300)) for x in v]) for i, v in large]
        for q, a in whole[::20]:
            scores = sorted((-max(-most, min(most, sum(x * y for x, y in zip(a, b, strict=True)))), i) for i, b in whole if i != q)
            want |= {(q, n, i, -x) for n, (x, i) in enumerate(scores[:7], 1)}
        assert {tuple(x) for x in got.collect()} == want, size


@pytest.mark.parametrize("slices", [1, 2, 3, 5])
def test_top_k_leaves_out_most_later_slices(slices):
    """Groups of near vectors: few pairs are summed beyond the first slice, and none that reaches the cutoff is lost."""
    r = np.random.default_rng(4)
    centres = r.normal(size=(100, 48))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    v = np.floor(64 * (centres[np.arange(1000) % 100] + r.normal(size=(1000, 48)) * 0.03))
    q = v[:40]
    scores = q @ v.T
    other = np.arange(40)[:, None] != np.arange(1000)[None]
    cutoff = np.sort(np.where(other, scores, -1e9), axis=1)[:, -5].astype(np.int64)
    cutoff[7] = topk.NONE
    for some in (cutoff, np.delete(cutoff, 7)):
        keep = np.ones(40, bool) if len(some) == 40 else np.arange(40) != 7
        at_q, at_v, got, done = topk.collect(q[keep], v, other[keep], some, topk._runs(48, slices))
        want = other[keep] & ((scores[keep] >= some[:, None]) | (some == topk.NONE)[:, None])
        assert set(zip(at_q, at_v, got, strict=True)) == {(a, b, scores[keep][a, b]) for a, b in zip(*np.nonzero(want), strict=True)}
        assert done <= want.size * (48 - 48 // slices) * (0.05 if slices == 2 else 1)


# decontamination


def test_myers_against_the_full_table():
    r = random.Random(1)
    for _ in range(200):
        item, text = ("".join(r.choice("abc ") for _ in range(r.randint(1, n))) for n in (90, 120))
        row = [0] * (len(text) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, d in enumerate(text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        got = decontaminate.Myers(item).search(text, len(item))
        assert min(row) == (got[0] if got else len(item))


def test_decontaminate(spark, odd_rows, empty):
    r = random.Random(2)
    item = prose(r, 40).lower()
    plain = decontaminate.plain(item)
    k = decontaminate.edits(len(plain), 0.08)
    places = r.sample(range(3, len(item) - 3), 3 * k)
    near, far = list(item), list(item)
    for n, at in enumerate(places):
        if n < k - 2 and item[at].isalpha():
            near[at] = "q"
        far[at] = "q" if item[at].isalpha() else item[at]
    rows = [*odd_rows, (100, prose(r, 30) + "\n" + item.upper() + "! " + prose(r, 9)), (101, prose(r, 9) + " " + "".join(near)), (102, "".join(far))]
    benchmark = spark.createDataFrame([(1, item, 1), (2, None, 1), (3, "", 1), (4, "short", 1), (5, item, 1)], "item_id long, text string, doc_id int")
    for block in (1_000_000, 10):
        got = {(x["doc_id"], x["item_id"]): x["distance"] for x in decontaminate.contaminated(frame(spark, rows), benchmark, block=block).collect()}
        assert set(got) == {(i, n) for i in (100, 101) for n in (1, 5)} and got[100, 1] == 0 < got[101, 5] <= k
    kept = decontaminate.keep_clean(frame(spark, rows), benchmark)
    assert kept.count() == len(rows) - 2 and kept.columns == frame(spark, rows).columns
    assert not decontaminate.contaminated(empty, benchmark).collect()
    assert not decontaminate.contaminated(frame(spark, rows), benchmark.limit(0)).collect()


def test_short_items_are_found_as_whole_words(spark):
    texts = {1: "Say (Yes)!", 2: "yesterday; eyes", 3: "what is\nthe CAPITAL of France?", 4: "the capital of Francesca what is", 5: "ten letter", 6: "tenletters", 7: None, 8: "x " * 400_000 + "yes"}
    items = [(1, "yes"), (2, "What is the capital of France?"), (3, "ten-letter"), (4, " ?! "), (5, None), (6, "é"), (7, "yes")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, list(texts.items()))
    got = {(x["doc_id"], x["item_id"]): (x["distance"], x["start"], x["end"]) for x in decontaminate.contaminated(docs, benchmark).collect()}
    want = set()
    for i, t in texts.items():
        for n, q in items:
            if (q := decontaminate.plain(q or "")) and f" {q} " in f" {decontaminate.plain(t or '')} ":
                want.add((i, n))
    assert set(got) == want == {(1, 1), (1, 7), (3, 2), (5, 3), (8, 1), (8, 7)} and got[1, 1] == (0, 4, 7)
    assert {x["doc_id"] for x in decontaminate.keep_clean(docs, benchmark).collect()} == {2, 4, 6, 7}


def test_passages_against_every_stretch(spark):
    """Distances of all items in all texts, by a plain table over every stretch."""
    def distance(item, text):
        row = list(range(len(item) + 1))
        best = row[-1]
        for c in text:
            new = [0]
            for j, d in enumerate(item, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row, best = new, min(best, new[-1])
        return best

    r = random.Random(8)
    items = [(n, prose(r, r.randint(6, 14))) for n in range(6)]
    rows = []
    for i in range(40):
        text = list(prose(r, 8) + " " + r.choice(items)[1] + " " + prose(r, 8))
        for _ in range(r.choice([0, 2, 5, 9])):
            text[r.randrange(len(text))] = r.choice("qz ")
        rows.append((i, "".join(text)))
    got = {(x["doc_id"], x["item_id"]): x["distance"] for x in decontaminate.contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for i, t in rows:
        for n, q in items:
            q = decontaminate.plain(q)
            if (k := distance(q, decontaminate.plain(t))) <= decontaminate.edits(len(q), 0.08):
                want[i, n] = k
    assert got == want and want


# toxicity


def test_lexicon_matches_by_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            new = [i]
            for j, d in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return row

    r = random.Random(4)
    terms = [("monster", True), ("dreadful", True), ("foul", True), ("wicked", False), ("vile", False)]
    lexicon = toxicity.Lexicon(terms)
    for _ in range(3000):
        text, _ = r.choice(terms)
        word = list(text)
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(word) + 1)
            word[at : at + r.randint(0, 1)] = r.choice(["", "x", "e"])
        word = "".join(word) + r.choice(["", "", "s", "en"])
        want = None
        for n, (term, whole) in enumerate(terms):
            ends = [len(word)] if whole else range(len(word) + 1)
            errors = min(distance(term, word)[e] for e in ends)
            if errors <= toxicity.forgiven(term, whole):
                want = min(want or (9, 9), (errors, n))
        assert lexicon._walk(word) == want, word
    assert lexicon.find("M0NSTER!!!") == (0, 0) and lexicon.find("foooul") == (0, 2) and lexicon.find("12") is None


def test_toxicity(spark, odd_rows, empty):
    r = random.Random(6)
    bad = ["dreadful", "monster", "wretched"]
    rows, labels = list(odd_rows), []
    for i in range(1000, 1400):
        words = prose(r, 40).split()
        toxic = int(i % 4 == 0)
        for _ in range(3 * toxic):
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(2000, "stone river over you dreadfull m0nster garden"), (2001, "he wrote the word “monster” in yellow letters over the garden")]
    known = spark.createDataFrame([*labels, (1, None), (None, 1), (1, 0)], "doc_id long, toxic int")
    docs = frame(spark, rows)
    found = toxicity.train_and_score(docs, known).collect()
    got = {x["doc_id"]: x for x in found}
    assert len(found) == len(rows)
    assert all(got[i]["predicted"] == y for i, y in labels)
    assert all(x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1) for x in found)
    assert got[2000]["predicted"] == 1 and got[2001]["predicted"] == 0 and got[1]["score"] == got[2]["score"] < 0.5
    model = toxicity.fit(docs, known)
    assert toxicity.keep_clean(docs, model).count() == sum(1 for x in found if x["score"] < 0.7)
    assert {x["score"] for x in toxicity.train_and_score(docs, known.limit(0)).collect()} == {0.0}
    assert not toxicity.train_and_score(empty, known).collect()


def test_lexicon_keeps_rare_terms_of_a_large_sample(spark):
    """Terms of a language with under 1 % of the toxic texts, and terms that clean texts quote when toxic labels are few."""
    r, rows, marks = random.Random(5), [], []
    for i in range(5200):
        toxic = i < 2000
        word = ("grobian" if i < 15 else "scumbag") if toxic else "neighbour"
        rows.append((i, f"{prose(r, 6)} {word} {prose(r, 6)} {i}"))
        marks.append((i, 1, int(toxic)))
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert any("grobian".startswith(t) for t, _ in model.terms) and any("scumbag".startswith(t) for t, _ in model.terms)
    rows, marks = [], []
    for i in range(3300):
        word = "scumbag" if i < 250 else "wretch" if i < 300 else "wretch" if i < 313 else "neighbour"
        rows.append((i, f"{prose(r, 6)} {word} {prose(r, 6)} {i}"))
        marks.append((i, 1, int(i < 300)))
    model = toxicity.fit(frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert any("wretch".startswith(t) for t, _ in model.terms)



# personal data


def spans_by_hand(text):
    def luhn(d):
        return sum(v - 9 * (v > 9) for i, c in enumerate(reversed(d)) for v in [int(c) * (1 + i % 2)]) % 10 == 0

    def fine(kind, hit):
        digits = re.sub(r"\D", "", hit)
        return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in hit.split(".")), "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()

    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    found = sorted((m.start(), n, k, m.end()) for n, (k, p) in enumerate(patterns.items()) for m in re.finditer(p, text) if fine(k, m[0]))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in found)


def test_pii_base_spans(spark, odd_rows, empty):
    odd = [
        "mail a.b+c@d-e.fr, x@y.z@w.v and @no.one or a@b", "1.2.3.4.5 256.1.1.1 001.02.3.255 1.1.1.1000 9.9.9", "é4111 1111 1111 1111 and 4111-1111-1111-1112, 4111  1111",
        "+1 (743) 555-3824 +12 +49.30.12345678- +999999999999999999", "12345678901234567890123 " * 40, "5" * 9000, "𝒳 a@b.co 10.0.0.1 𝒳 a@b.c", "a@b.co_x@y.zz", "+4111111111111111",
    ]
    rows = [*odd_rows, *enumerate(odd, 200)]
    got = pii.find(frame(spark, rows)).select("doc_id", pii.written(F.col("base")).alias("base"), "spans", "base").collect()
    assert Counter((r[0], r[1]) for r in got) == Counter((i, spans_by_hand(t or "")) for i, t in rows)
    assert all(set(r["spans"]) >= set(r[3]) for r in got)
    assert not pii.find(empty).collect()


def test_pii_base_spans_of_random_texts(spark):
    """Runs, restarts after a match and broken patterns, from an alphabet of what the patterns are made of."""
    r = random.Random(6)
    texts = ["".join(r.choice("ab1.2@+- _(9)é0") for _ in range(r.randint(1, 120))) for _ in range(1500)]
    texts += ["".join(r.choice(["a@b.c", "_d", "@", ".", "1.2.3.4", "5", "+1 234567890", " ", "4111111111111111"]) for _ in range(r.randint(1, 30))) for _ in range(1500)]
    got = {x["doc_id"]: x["b"] for x in pii.find(frame(spark, list(enumerate(texts)))).select("doc_id", pii.written(F.col("base")).alias("b")).collect()}
    assert got == {i: spans_by_hand(t) for i, t in enumerate(texts)}


def test_pii_sweep_against_all_pairs(spark):
    r = random.Random(7)
    def spans(n):
        return [(a, a + r.randint(1, 9)) for a in (r.randint(0, 60) for _ in range(n))]

    rows = [(i, spans(r.choice([0, 1, 5, 300])), spans(r.choice([0, 1, 4, 600]))) for i in range(60)]
    kind = "struct<start:int,end:int>"
    df = spark.createDataFrame(rows, f"id int, base array<{kind}>, cs array<{kind}>")
    for x in df.select("id", F.expr(pii._free("cs", "base", kind)).alias("free")).collect():
        base, cs = rows[x["id"]][1:]
        want = [c for c in cs if not any(a < c[1] and c[0] < b for a, b in base)]
        assert Counter(map(tuple, x["free"])) == Counter(want)


def test_pii_of_long_runs_and_many_spans(spark):
    """Work grows with the text: unbroken runs of a megabyte and ten thousand spans take seconds, not hours."""
    n, many = 1_000_000, 10_000
    texts = {
        1: "a" * n + " x@y.zz", 2: "A1b." * (n // 4) + "@ x@y.zz", 3: "7" * n + " 1.2.3.4", 4: "+" * n, 5: "-@" * (n // 2),
        6: "1.2.3.4 " * many, 7: "a@b.cc " * many, 8: "john at host dot com, " * 4000 + "a@b.cc " * 4000,
    }
    began = time.time()
    got = {x["doc_id"]: x["b"] for x in pii.find(frame(spark, list(texts.items()))).select("doc_id", pii.written(F.col("base")).alias("b")).collect()}
    took = time.time() - began
    assert got[1] == f"email:{n + 1}:{n + 7}" and got[2] == f"email:{n + 2}:{n + 8}" and got[3] == f"ip:{n + 1}:{n + 8}" and got[4] == got[5] == ""
    assert all(got[i] == spans_by_hand(texts[i]) for i in (6, 7, 8))
    assert took < 120


def test_pii_adds_what_looks_alike(spark):
    """National telephone numbers share format and context with base ones, numbers in other contexts do not."""
    r = random.Random(9)
    rows = []
    for i in range(400):
        number = f"({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}"
        rows.append((i, f"please call +1 {number} now" if i % 2 else f"{prose(r, 9)} item {r.randint(100, 999)}{r.randint(100, 999)} {prose(r, 5)}"))
    rows.append((900, "please call (743) 555-3824 now"))
    got = {x["doc_id"]: x["spans"] for x in pii.find(frame(spark, rows), precision=0.9).collect()}
    assert all(not got[i] for i in range(0, 400, 2))
    assert all(len(got[i]) == 1 for i in range(1, 400, 2))


@pytest.mark.parametrize("copies", [1, 300])
def test_pii_adds_forms_without_a_base_span(spark, copies):
    """At the production precision, and whatever the number of rows."""
    added = [
        "please write to jane.doe (at) example (dot) com today", "my mail is jane [at] example.org, thanks", "please call 0049 30 12345678 now", "Telefon 0171/1234567 abends",
        "my visa card 4111.1111.1111.1111 is lost", "card 4111 / 1111 / 1111 / 1111 here", "please call (743) 555-3824 now", "server fe80::1ff:fe23:4567:890a is up",
    ]
    none = ["contact us at example.com for more", "order 4111.1111.1111.1112 shipped", "item 123456789 in stock", "isbn 978-3-16-148410-0 sold", "on 2024-05-12 1030 people at home. Then", "version 10.12.20345 is out"]
    rows = [(i, t) for i, t in enumerate((added + none) * copies)]
    for x in pii.find(frame(spark, rows)).collect():
        n = x["doc_id"] % (len(added) + len(none))
        assert len(x["spans"]) == (n < len(added)), (rows[n], x["spans"])


# language


def test_language_id(spark, odd_rows, empty):
    r = random.Random(7)
    tongues = {"xx": "kala mira tolu sana wiku".split(), "yy": "grot brek stiv plonk drum".split()}
    rows = [(i, " ".join(r.choice(tongues[lang]) + r.choice(["", "s", "n"]) for _ in range(r.randint(5, 90))), lang) for i in range(300) for lang in [r.choice(["xx", "yy"])]]
    rows += [(1000, None, "xx"), (1001, "", "xx"), (1002, "12 34 !?", None), (1003, "KALA MIRA! TOLU SANA WIKU KALA MIRA! TOLU", None), (None, "grot brek stiv plonk drum " * 3, "yy")]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, lang string, lang_pred int")
    found = language_id.train_and_identify(docs).collect()
    got = {x["doc_id"]: x for x in found}
    assert len(found) == len(rows) and all(0 <= x["score"] <= 1 for x in found)
    right = [got[i]["lang_pred"] == lang for i, _, lang in rows[:300] if got[i]["held_out"]]
    assert np.mean(right) > 0.95
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "xx", "yy"]
    unknown = language_id.train_and_identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {x["lang_pred"] for x in unknown} == {"und"}
    assert not language_id.train_and_identify(docs.limit(0)).collect()


def test_language_by_plain_sizes(spark):
    """The whole prediction from the sizes that zstandard's one-call interface gives."""
    import zstandard as z

    r = random.Random(3)
    tongues = {"xx": "kala mira tolu sana wiku".split(), "yy": "grot brek stiv plonk drum".split(), "zz": "kala brek ün tolu drum".split()}
    rows = [(i, " ".join(r.choice(tongues[lang]) for _ in range(r.choice([1, 2, 9, 300, 4000]))), lang) for i in range(60) for lang in [r.choice(sorted(tongues))]]
    docs = spark.createDataFrame([*rows, (99, "", None)], "doc_id long, text string, lang string")
    learned = language_id.learn_dictionaries(docs)
    got = {x["doc_id"]: x for x in language_id.identify(docs, learned).collect()}
    for i, t, _ in rows:
        raw, sizes = language_id.letters(t), []
        for lang, content in learned.items():
            press = z.ZstdCompressor(level=6, dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes.append((sum(len(press.compress(raw[at : at + 1024])) for at in range(0, len(raw), 1024)), len(sizes), lang))
        sizes.sort()
        assert got[i]["lang_pred"] == sizes[0][2] and got[i]["rejected"] == ((sizes[1][0] - sizes[0][0]) / sizes[1][0] < 0.01)
        shares = [2 ** (-40 * (n - sizes[0][0]) / sizes[0][0]) for n, _, _ in sizes]
        assert abs(got[i]["score"] - 1 / sum(shares)) < 1e-9


# suffix order


def test_suffix_order():
    r = random.Random(1)
    for _ in range(250):
        text = "".join(r.choice(r.choice(["a", "ab", "abcdef"])) for _ in range(r.randint(0, 160)))
        data, cap = (text + text[: r.randint(0, 90)]).encode(), r.choice([8, 200])
        order, shared = induced.suffix_order(data, cap, memory=r.choice([40, 10**9]))
        assert sorted(order.tolist()) == list(range(len(data)))
        for i in range(1, len(data)):
            a, b = data[order[i - 1] :][:cap], data[order[i] :][:cap]
            n = next((j for j, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert a <= b and shared[i] == n


def cut_by_hand(rows):
    size, seen = suffix_dedup.WINDOW, Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raws:
        seen.update(b[s : s + size] for s in range(len(b) - size + 1))
    out = Counter()
    for i, b in raws:
        gone = np.zeros(len(b) + 1, int)
        for s in range(len(b) - size + 1):
            if seen[b[s : s + size]] > 1:
                gone[s] += 1
                gone[s + size] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out[i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()] += 1
    return out


@pytest.mark.parametrize("settings", [{}, {"shard_bytes": 2000, "hot": 3, "memory": 1000}])
def test_suffix_dedup(spark, odd_rows, empty, settings):
    r = random.Random(12)
    hot = prose(r, 70)
    rows = [*odd_rows, *((400 + i, prose(r, 30) + hot[i % 7 :] + prose(r, 30)) for i in range(25)), (7, "another text under an id that is taken " + hot)]
    cut = suffix_dedup.remove_repeats(frame(spark, rows), **settings)
    digest = F.when(F.col("kept").isNull(), F.col("sha")).otherwise(F.sha2("kept", 256))
    got = Counter(tuple(x) for x in cut.select("doc_id", "n_bytes", "n_removed", "n_spans", digest).collect())
    assert got == cut_by_hand(rows)
    assert not suffix_dedup.remove_repeats(empty, **settings).collect()


# pages


def test_html_extract(spark):
    pages = [
        ("<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies. Accept?</div><article><h1>A &amp; B</h1><p><b>One\n\t two.<br><p>Three&nbsp;&lt;four&gt; five."
         "<div class=ad>Buy this now.</div></article><section id=comments><p>I liked it very much, thanks for it.</p></section><footer>&copy; x &middot; y</footer>", "A & B\n\nOne two.\n\nThree <four> five."),
        (None, ""), ("", ""), ("<nav><a>x</a></nav>", ""), ("<!-- <article> --><script>var a='<p>no</p>'</script><style>p{}</style>", ""),
    ]
    rows = spark.createDataFrame([(i, "u", h, "t") for i, (h, _) in enumerate(pages)], "page_id long, url string, html string, text string")
    got = {x["page_id"]: (x["text"], x["n_chars"]) for x in html_extract.extract(rows).collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in enumerate(pages)}
    assert not html_extract.extract(rows.limit(0)).collect()


def test_field_on_held_out_pages():
    field = html_extract.train(html_pages.labelled_pages(300, 1), rounds=80)
    pairs = [(a, b) for page, y in html_pages.labelled_pages(100, 2) if page for a, b in zip(field.decode(page), y, strict=True)]
    assert np.mean([a == b for a, b in pairs]) > 0.96


def test_viterbi_is_the_best_labelling():
    r = np.random.default_rng(3)
    page = html_pages.blocks("<div>a</div><p>b c</p><nav>d</nav><p>e.</p><li>f</li>")
    names = {n: i for i, n in enumerate(sorted({n for f in html_pages.features(page) for n in f}))}
    for _ in range(30):
        field = html_extract.Field(names, r.normal(size=len(names)), r.normal(size=(2, 2)))
        unary = [sum(field.weights[names[n]] for n in set(f)) for f in html_pages.features(page)]

        def value(y):
            return sum(u * v for u, v in zip(unary, y, strict=True)) + sum(field.pairs[a, b] for a, b in zip(y, y[1:], strict=False))

        best = max(([int(b) for b in f"{n:05b}"] for n in range(32)), key=value)
        assert field.decode(page) == best


def test_drawings_formulas_and_fallbacks_are_kept():
    def texts(page):
        return [b.text for b in html_pages.blocks(page)]

    assert texts("<article><p>One</p><svg><p>Two</p><p>Three</p></article><p>Four") == ["One", "Two", "Three", "Four"]
    assert texts("<p>so <math><mi>E</mi><mo>=</mo><mi>m</mi></math> holds</p><p>on") == ["so E=m holds", "on"]
    assert texts("<p>a <svg><g><title>no</title><text>label</text></g></svg> b</p>") == ["a label b"]
    assert texts("<object data=x><p>instead</p></object><noscript>no <b>script</b></noscript><canvas>drawn") == ["instead", "no scriptdrawn"]
    assert texts("<p>a</p><noscript><p>b</p><p>c") == ["a", "b", "c"] and texts("<p>a<math><mi>x<p>b</p></p><div>c</div>") == ["ax", "b", "c"]
    assert texts("<p>a</p><script>if (1 < 2) b()") == ["a"] and texts("<p>a<template><p>b</p></template>c") == ["ac"]
    assert len(texts("<p>" + "long " * 400_000 + "<svg>" * 50 + "<p>end")) == 2


def test_keep_one_of_each_group(spark):
    """By row, not by id: repeated ids, missing ids and repeated rows."""
    r = random.Random(21)
    a, b, c = (prose(r, 80) for _ in range(3))
    rows = [(1, a), (5, a + " "), (5, b), (7, b), (None, a), (None, c), (None, c), (None, prose(r, 50)), (9, c), (9, c), (10, None), (11, "")]
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    got = sorted(((x["doc_id"], x["text"] or "") for x in kept.collect()), key=repr)
    assert got == sorted([(1, a), (5, b), (9, c), (None, rows[7][1]), (10, "")], key=repr)
    assert simhash.keep_one(frame(spark, [])).collect() == []


# registered queries and the pipeline


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb

    from tools.check_queries import TABLES, compare

    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.SQL[name])
    assert not compare(df.columns, df.collect(), [c[0] for c in cur.description], cur.fetchall())


def test_pipeline_on_odd_rows(spark, odd_rows, tmp_path):
    """Null and empty texts, repeated and missing ids, very long texts, columns of other names, and no rows at all."""
    import corpus_pipeline as cp

    for name, rows in (("odd", odd_rows), ("none", [])):
        folder = str(tmp_path / name)
        frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(5, 0, 1)], "doc_id long, quality int, toxic int").limit(len(rows)).write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, prose(random.Random(1), 30)), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        docs = cp.table(spark, folder, "documents")
        for i, (_, stage) in enumerate(cp.STAGES):
            before, docs = docs, cp.store(stage(spark, docs, folder), "stage")
            if i < 4:
                assert docs.columns == before.columns and docs.count() <= before.count()
        assert (docs.count() > 0) == bool(rows)


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for i, (_, stage) in enumerate(cp.STAGES):
        before, docs = docs, stage(spark, docs, SF)
        if i < 4:
            assert docs.columns == names and docs.count() <= before.count()
    assert cp.run(spark, SF).agg(F.countDistinct("doc_id")).first()[0] == before.count()
