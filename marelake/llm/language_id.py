"""Language identification by compression: the language whose dictionary shortens a text most.

Per language a zstandard raw-content dictionary is cut from a bounded sample of labelled texts.  A text is cut into
blocks, each block is compressed with every dictionary, and the sizes are summed over the whole text: a block is too
short to serve as its own dictionary, so long texts are told apart as well as short ones.  The score is the best
language's share when every byte saved against the worst one counts; a text whose two best sizes lie closer than
``margin`` is ``rejected`` (its best guess is still given).

Defined results: very long texts are compressed whole, block by block; equal sizes go to the commoner language; a null text or one without a letter is ``und`` with score 0; null ``lang`` values teach nothing;
without any labelled text every result is ``und``; repeated rows give repeated results; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, documents, remainder

UNKNOWN = "und"
#: bytes compressed at once, and the compression level
BLOCK, LEVEL = 1024, 6
#: lower-case letters, apostrophes and all bytes beyond ASCII stay, the rest is blank
LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 or c == 39 else 32 for c in range(256))


def letters(text: str) -> bytes:
    """What is compressed: case, digits and signs say little of a language."""
    return text.lower().encode().translate(LETTERS)


def learn_dictionaries(labelled: DataFrame, samples: int = 256, chars: int = 400) -> dict[str, bytes]:
    """A dictionary of at most ``samples`` x ``chars`` characters per language, from (doc_id, text, lang) rows.

    The texts of a language are dealt into ``samples`` groups by hash and the one with the least hash speaks for
    its group, so the sample is bounded at any size of the table and one partial aggregate finds it.  Languages
    come commonest first, which decides ties.
    """
    keyed = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", F.xxhash64("doc_id", F.lit(7)).alias("h"), F.length("text").alias("n"), "text")
    # a stretch from the inside of a text, placed by its hash
    start = F.pmod("h", F.greatest(F.col("n") - chars, F.lit(1))) + 1
    piece = keyed.select("lang", F.pmod("h", F.lit(samples)).alias("g"), F.xxhash64("h").alias("o"), F.col("text").substr(start.cast("int"), F.lit(chars)).alias("piece"))
    rows = piece.groupBy("lang", "g").agg(F.min_by("piece", "o").alias("piece"), F.count(F.lit(1)).alias("n")).collect()
    texts, n = defaultdict(list), Counter()
    for r in sorted(rows, key=lambda r: (r["lang"], r["g"])):
        texts[r["lang"]].append(r["piece"])
        n[r["lang"]] += r["n"]
    return {lang: letters("\n".join(texts[lang])) for lang in sorted(texts, key=lambda x: (-n[x], x))}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], margin: float):
        import zstandard as z

        self.langs, self.margin, self.by = list(dictionaries), margin, []
        for lang in self.langs:
            kept = z.ZstdCompressionDict(dictionaries[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            kept.precompute_compress(level=LEVEL)
            self.by.append(z.ZstdCompressor(level=LEVEL, dict_data=kept, write_checksum=False, write_content_size=False, write_dict_id=False).compress)

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        if not self.langs or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        raw = letters(text)
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = np.array([sum(len(press(b)) for b in blocks) for press in self.by], float)
        order = np.argsort(sizes, kind="stable")
        best = sizes[order[0]]
        if len(sizes) == 1:
            return self.langs[0], 1.0, False
        gain = np.exp2(-(sizes - best) / best * 40)
        lead = (sizes[order[1]] - best) / sizes[order[1]]
        return self.langs[order[0]], float(gain[order[0]] / gain.sum()), bool(lead < self.margin)


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = 0.01) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every document."""

    class Predict:
        def __init__(self):
            self.classify = Classifier(dictionaries, margin)

        def __call__(self, batch):
            found = [self.classify(t) for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id")} | dict(zip(("lang_pred", "score", "rejected"), zip(*found, strict=True), strict=True))

    return arrow_map(documents(docs), Predict, "doc_id long, lang_pred string, score double, rejected boolean")


def train_and_identify(docs: DataFrame, modulus: int = 4, held_out: int = 2, **settings) -> DataFrame:
    """Learns from the documents outside the held-out fold; predicts all."""
    fold = remainder(F.col("doc_id"), modulus)
    train = docs.select("doc_id", "text", "lang").where(fold != held_out)
    found = identify(docs, learn_dictionaries(train), **settings)
    return found.select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
