"""Personal data: candidate spans, gradient-boosted trees over format and context, calibrated thresholds.

Everything runs as DataFrame expressions, in one pass over the text and without a shuffle of it:

1. base patterns find e-mail addresses, network addresses, cards and telephone numbers; what fails its check
   (parts, Luhn, number of digits) is dropped;
2. generators with wide patterns propose spans for the same kinds: written-out addresses, numbers without a plus
   or with 00, IPv6, cards in odd groups.  What fails its check is dropped too.  A candidate's features are small
   classes: digits, groups, separators, form, the characters around it, and whether a word near it names its kind;
3. boosted trees are fitted to generated texts whose personal data is known (``examples``): the label is what was
   written into the text, look-alikes (orders, dates, books, versions, prose with "at") are the rest.  Model and
   thresholds are thereby the same for every table, whatever its size and however often a format occurs in it;
4. per kind, the lowest score whose generated candidates held out of the fit are personal data in a share of
   ``precision`` is the threshold.  Candidates that reach it and touch no base span are added; of added spans of two
   kinds that overlap the first kind's stays; base spans always stay.

Offsets count code points, ends are exclusive.

Work grows with a text's length: a pattern is tried where a run of its characters begins and nowhere inside, positions
are running sums, and overlaps are found by sorting.

Defined results: null and empty texts have no spans; very long texts, unbroken runs and any number of spans are read
whole; added spans of one kind never overlap, as one pattern finds them; repeated rows give repeated results; a table without candidates
adds nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

KINDS = ("email", "ip", "card", "phone")
# Loops over groups are possessive: nothing follows them, and Java runs them without recursion.
BASE = {
    # a match begins where its run of characters does, or where the last match ended: no run is tried from within
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a run of fewer digits fails its check, and no later start in it can have more
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: what the text must hold for a pattern to be tried at all
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
WIDE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+(?:\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?|\x20at\x20)[a-z0-9-]{1,63}+(?:(?:\.|\x20\.\x20|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)[a-z0-9-]{1,63}+){1,6}+",
    "ip": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "card": r"(?<![\p{L}0-9_])(?:[0-9]{4}(?:[\x20./-]{1,3}[0-9]{4}){2}[\x20./-]{1,3}[0-9]{1,7}|[0-9]{4}[\x20./-]{1,3}[0-9]{6}[\x20./-]{1,3}[0-9]{4,5})(?![\p{L}0-9_])",
    # 15 digits at most, and back to the last group that ends by then
    "phone": r"(?<![\p{L}0-9_+])(?:\+|\((?=[0-9]{1,5}\)))?[0-9](?:[\x20()./-]{0,3}[0-9]){6,14}(?![\p{L}0-9_])",
}
WIDE_NEEDS = {"email": r"(?i)@|[(\[{]at[)\]}]|\x20at\x20", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f:]", "card": r"[0-9][\x20./-]{1,3}[0-9]", "phone": r"[0-9][\x20()./-]{0,3}[0-9]"}
#: fixed values: words that name a kind, in the languages at hand
NEAR = {
    "email": r"e-?mails?|mail|correo|courriel|contact|contacto|write|address|adresse|schreib\w*|escr[ií]be\w*|écri\w*",
    "ip": r"ip|ipv6|address|host|server|adresse|servidor|serveur",
    "card": r"card|karte|kreditkarte|tarjeta|carte|visa|mastercard|amex|payment",
    "phone": r"tel|tél|phone|telephone|telefon\w*|teléfono|téléphone|fon|call|mobil\w*|móvil|portable|fax|whatsapp|anruf\w*|rufen|ruf|llama\w*|appel\w*",
}
NEAR = {k: rf"(?i)(?<![\p{{L}}_])(?:{v})(?![\p{{L}}_])" for k, v in NEAR.items()}
FEATURES = ("digits", "groups", "marks", "before", "after", "near", "lead", "form")
WINDOW = 24


SPAN = "struct<kind:string,start:int,end:int,hit:string,pre:string,post:string>"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(items: str, zero: str, step: str, emit: str, kind: str) -> str:
    """``emit`` for each of ``items`` (a name), where ``s`` is the state before it and ``x`` the item.

    Items go in runs of 256: an array that grows by one element is copied each time, so only short ones grow.
    """
    return f"""IF(size({items}) = 0, CAST(array() AS array<{kind}>), flatten(transform(aggregate(
      sequence(0, (size({items}) - 1) div 256), array(named_struct('s', {zero}, 'o', CAST(array() AS array<{kind}>))),
      (runs, i) -> array_append(runs, aggregate(
        slice({items}, i * 256 + 1, 256), named_struct('s', element_at(runs, -1).s, 'o', CAST(array() AS array<{kind}>)),
        (r, x) -> {_let('r.s', 's', f"named_struct('s', {step}, 'o', array_append(r.o, {emit}))")}))), run -> run.o)))"""


def _found(kind: str, patterns: dict[str, str]) -> Column:
    """Spans of a pattern, with the characters around them: the text between matches tells where each match begins."""
    pattern = patterns[kind].replace("\\", "\\\\")
    parts = f"""zip_with(zip_with(m.gaps, m.hits, (g, h) -> named_struct('gap', g, 'hit', h)),
      zip_with(slice(m.gaps, 2, size(m.gaps)), slice(m.hits, 2, size(m.gaps)), (g, h) -> IF(g <> '', left(g, 1), left(h, 1))),
      (p, n) -> named_struct('gap', p.gap, 'hit', p.hit, 'post', n))"""
    zero = "named_struct('at', 0, 'tail', '')"
    step = f"""named_struct('at', s.at + length(x.gap) + coalesce(length(x.hit), 0),
      'tail', right(concat(s.tail, right(x.gap, {WINDOW}), coalesce(right(x.hit, {WINDOW}), '')), {WINDOW}))"""
    emit = f"""named_struct('kind', '{kind}', 'start', s.at + length(x.gap), 'end', s.at + length(x.gap) + length(x.hit), 'hit', x.hit,
      'pre', right(concat(s.tail, right(x.gap, {WINDOW})), {WINDOW}), 'post', coalesce(x.post, ''))"""
    matches = f"named_struct('gaps', split(text, '{pattern}', -1), 'hits', regexp_extract_all(text, '{pattern}', 0))"
    spans = _let(matches, "m", _let(parts, "items", _running("items", zero, step, emit, SPAN)))
    return F.filter(F.expr(spans), lambda x: x["hit"].isNotNull())


def _none() -> Column:
    return F.expr(f"CAST(array() AS array<{SPAN}>)")


def _valid(x: Column) -> Column:
    kind, hit = x["kind"], x["hit"]
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    # a part of more than three digits counts only if the surplus is zeros
    parts = F.forall(F.split(hit, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
        F.split(hit, r"\."), lambda p: F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(0)) <= 255)
    return (
        F.when(kind == "email", True).when(kind == "ip", parts)
        .when(kind == "card", n.between(12, 19) & F.call_function("luhn_check", digits)).otherwise(n.between(9, 15))
    )


def _plausible(x: Column) -> Column:
    """The check of a wide pattern's span."""
    kind, hit = x["kind"], x["hit"]
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == "email", hit.rlike(r"[A-Za-z]{2,}$")).when(kind == "ip", n > 0)
        .when(kind == "card", n.between(12, 19) & F.call_function("luhn_check", digits)).otherwise(n.between(7, 15))
    )


def base_spans() -> Column:
    """All base spans of the column ``text`` that pass their check."""
    each = [F.when(F.col("text").rlike(NEEDS[k]), _found(k, BASE)).otherwise(_none()) for k in KINDS]
    return F.filter(F.concat(*each), _valid)


def _class(c: Column) -> Column:
    """0 edge, 1 blank, 2 digit, 3 letter, 4 quotation or bracket, 5 other."""
    return (
        F.when(F.length(c) == 0, 0).when(c.rlike(r"\s"), 1).when(c.rlike("[0-9]"), 2).when(c.rlike(r"\p{L}|_"), 3)
        .when(c.rlike("[\"'“”()\\[\\]<>{}]"), 4).otherwise(5)
    )


def candidates() -> Column:
    """Spans of the wide patterns that pass their check, with their feature classes."""
    each = [F.when(F.col("text").rlike(WIDE_NEEDS[k]), _found(k, WIDE)).otherwise(_none()) for k in KINDS]

    def described(x: Column) -> Column:
        digits = F.length(F.regexp_replace(x["hit"], "[^0-9]", ""))
        groups = F.size(F.split(F.trim(F.regexp_replace(x["hit"], "[^0-9A-Za-z]+", " ")), " "))
        near = x["pre"]
        named = F.lit(False)
        for k in KINDS:
            named = F.when(x["kind"] == k, near.rlike(NEAR[k])).otherwise(named)
        return F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
            F.least(digits, F.lit(20)).alias("digits"), F.least(groups, F.lit(6)).alias("groups"),
            (F.when(x["hit"].contains("("), 1).otherwise(0) + F.when(x["hit"].rlike("[-/]"), 2).otherwise(0) + F.when(x["hit"].contains(" "), 4).otherwise(0) + F.when(x["hit"].contains("."), 8).otherwise(0)).alias("marks"),
            _class(F.right(x["pre"], F.lit(1))).alias("before"),
            _class(x["post"]).alias("after"),
            named.cast("int").alias("near"),
            F.when(x["hit"].startswith("00"), 1).when(x["hit"].startswith("0"), 2).when(x["hit"].startswith("("), 3).when(x["hit"].startswith("+"), 4).otherwise(0).alias("lead"),
            # how an address is written out: 1 in brackets, 2 both words, 3 and 4 "at" alone before a part with and without signs
            F.when(x["kind"] != "email", 0).when(x["hit"].rlike(r"(?i)[(\[{](?:at|dot)[)\]}]"), 1).when(x["hit"].rlike(r"(?i)\x20at\x20.*\x20dot\x20"), 2)
            .when(x["hit"].rlike(r"(?i)^[a-z]+\x20at\x20"), 4).when(x["hit"].rlike(r"(?i)\x20at\x20"), 3).otherwise(5).alias("form"),
        )

    return F.transform(F.filter(F.concat(*each), _plausible), described)


def boost(x: np.ndarray, good: np.ndarray, bad: np.ndarray, rounds: int = 40, rate: float = 0.3, shrink: float = 1.0) -> tuple[float, list]:
    """Trees of depth two on counted feature classes, by Newton steps on the logistic loss.

    Returns the base score and trees (feature, cut, left, right), where a side is (feature, cut, value, value).
    """
    n = good + bad
    start = math.log((good.sum() + 1) / (bad.sum() + 1))
    score, trees = np.full(len(n), start), []

    def split(rows):
        """The best cut of some rows: (gain, feature, cut, values)."""
        p = 1 / (1 + np.exp(-score[rows]))
        g, h = good[rows] - n[rows] * p, n[rows] * p * (1 - p)
        best = (0.0, 0, -1, 0.0, float(g.sum() / (h.sum() + shrink)))
        for f in range(x.shape[1]):
            values = np.unique(x[rows, f])
            for cut in values[:-1]:
                left = x[rows, f] <= cut
                gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
                gain = gl**2 / (hl + shrink) + gr**2 / (hr + shrink) - g.sum() ** 2 / (h.sum() + shrink)
                if gain > best[0] + 1e-9:
                    best = (float(gain), f, int(cut), float(gl / (hl + shrink)), float(gr / (hr + shrink)))
        return best

    for _ in range(rounds):
        everything = np.arange(len(n))
        gain, f, cut, *_ = split(everything)
        if gain < 1e-3:
            break
        sides = []
        for rows in (everything[x[:, f] <= cut], everything[x[:, f] > cut]):
            _, f2, cut2, low, high = split(rows)
            sides.append((f2, cut2, rate * low, rate * high, rows))
        for f2, cut2, low, high, rows in sides:
            score[rows] += np.where(x[rows, f2] <= cut2, low, high)
        trees.append((f, cut, *(s[:4] for s in sides)))
    return start, trees


def _score(x: Column, start: float, trees: list) -> Column:
    total = F.lit(start)
    names = ("kind_no", *FEATURES)

    def value(f):
        return _kind_no(x["kind"]) if names[f] == "kind_no" else x[names[f]]

    for f, cut, left, right in trees:
        branch = [F.when(value(f2) <= cut2, low).otherwise(high) for f2, cut2, low, high in (left, right)]
        total = total + F.when(value(f) <= cut, branch[0]).otherwise(branch[1])
    return total


def _kind_no(kind: Column) -> Column:
    c = F.lit(len(KINDS))
    for i, k in enumerate(KINDS):
        c = F.when(kind == F.lit(k), i).otherwise(c)
    return c


def _predict(x: np.ndarray, start: float, trees: list) -> np.ndarray:
    score = np.full(len(x), start)
    for f, cut, left, right in trees:
        for mask, (f2, cut2, low, high) in ((x[:, f] <= cut, left), (x[:, f] > cut, right)):
            score[mask] += np.where(x[mask, f2] <= cut2, low, high)
    return score


def _luhn(digits: str) -> str:
    """The digits with their check digit."""
    total = sum(n if i % 2 else n * 2 - 9 * (n > 4) for i, n in enumerate(map(int, reversed(digits))))
    return digits + str(-total % 10)


INTRO = {
    "email": ("e-mail", "mail me:", "my address is", "contact", "write to", "correo:", "courriel", "Adresse:", "schreib an"),
    "ip": ("host", "the server", "ip address", "IP", "adresse ip", "servidor"),
    "card": ("card", "my card no.", "visa", "Karte", "tarjeta", "carte", "payment by"),
    "phone": ("tel.", "tel:", "phone", "call", "please call me at", "Telefon", "mobil", "móvil", "téléphone", "fax", "whatsapp"),
}
#: words before numbers that are none of the kinds
OTHER = ("order", "item", "invoice", "isbn", "ref", "serial", "no.", "Artikel", "pedido", "facture", "version", "id", "part", "total")


def _personal(r: random.Random, kind: str) -> tuple[str, float]:
    """Personal data in a form without a base span, and how often a word that names it stands before it."""

    def n(k):
        return "".join(r.choice("0123456789") for _ in range(k))

    def word(low, high):
        return "".join(r.choice("abcdefghijklmnoprstuvwz") for _ in range(r.randint(low, high)))

    if kind == "email":
        local = r.choice([word(3, 8), f"{word(3, 7)}{r.choice('._-')}{word(3, 8)}", f"{word(3, 7)}{r.randint(1, 99)}"])
        host, top = word(4, 9) + r.choice(["", "", f"-{word(2, 5)}"]), r.choice("com org net de fr es".split())
        left, right = r.choice([("(", ")"), ("[", "]"), ("{", "}")])
        gap = r.choice(["", " "])
        form = r.choice(["both", "at", "words", "words", "blank", "plain"])
        if form == "both":
            return f"{local}{gap}{left}at{right}{gap}{host}{gap}{left}dot{right}{gap}{top}", 0.5
        if form == "at":
            return f"{local}{gap}{left}at{right}{gap}{host}.{top}", 0.5
        if form == "words":
            return f"{local} at {host} dot {top}", 0.6
        return (f"{local} @ {host}.{top}", 0.6) if form == "blank" else (f"{local} at {host}.{top}", 1.0)
    if kind == "ip":
        parts = [f"{r.randrange(65536):x}" for _ in range(8)]
        if r.random() < 0.5:
            return ":".join(parts), 0.5
        head, tail = r.randint(2, 4), r.randint(1, 3)
        return ":".join(parts[:head]) + "::" + ":".join(parts[-tail:]), 0.6
    if kind == "card":
        digits = _luhn(r.choice("3456") + n(r.choice([14, 14, 14, 13])))
        cuts = (0, 4, 8, 12, 16) if len(digits) == 16 else (0, 4, 10, 15)
        return r.choice([".", "/", "  ", " - ", " / ", "--"]).join(digits[a:b] for a, b in zip(cuts, cuts[1:], strict=False)), 0.8
    area, code = str(r.randint(200, 999)), r.choice(["1", "33", "34", "44", "49"])
    return r.choice([
        (f"({area}) {n(3)}-{n(4)}", 0.7), (f"({area}) {n(3)} {n(4)}", 0.7), (f"{area}-{n(3)}-{n(4)}", 0.8), (f"{area}.{n(3)}.{n(4)}", 0.9), (f"{area} {n(3)} {n(4)}", 0.9),
        (f"0{n(3)}{r.choice(' /-')}{n(r.randint(6, 8))}", 0.9), (f"0{n(1)} {n(2)} {n(2)} {n(2)} {n(2)}", 0.8), (f"0{n(1)}.{n(2)}.{n(2)}.{n(2)}.{n(2)}", 0.8),
        (f"6{n(2)} {n(3)} {n(3)}", 0.9), (f"00{code} {n(2)} {n(r.randint(6, 8))}", 0.7), (f"00{code}-{n(3)}-{n(6)}", 0.7), (f"00{code}{n(9)}", 0.8), (f"00 {code} {n(3)} {n(3)} {n(3)}", 0.7),
        (f"{area}{n(7)}", 1.0), (f"0{n(r.randint(8, 10))}", 1.0),
    ])


def _alike(r: random.Random, kind: str, word) -> tuple[str, float]:
    """What the wide patterns find but is no personal data, and how often a word that names the kind stands before it."""

    def n(k):
        return r.choice("123456789") + "".join(r.choice("0123456789") for _ in range(k - 1))

    if kind == "email":
        return r.choice([
            (f"{word()} at {word()}.{r.choice(['com', 'org', word()])}", 0.5), (f"us at {word()}.{r.choice(['com', 'org'])}", 0.8),
            (f"{word()} at the dot com", 0.1), (f"{word()} at {word()} . {word()}", 0.2), (f"{n(2)} @ {n(2)}.{n(2)}", 0.1), (f"{n(1)} @ {n(2)}.{n(2)}eur", 0.1),
        ])
    if kind == "ip":
        return r.choice([(f"{r.choice('abcdef')}{n(1)}::{r.choice('abcdef')}{n(1)}", 0.1), (f"{n(2)}:{n(2)}::{n(2)}", 0.1)])
    if kind == "card":
        digits = _luhn(n(15))
        return r.choice([" ", ".", "/", "  ", " - ", " / ", "--"]).join(digits[a : a + 4] for a in range(0, 16, 4)), 0.0
    return r.choice([
        (n(r.randint(7, 15)), 0.02), (n(r.randint(7, 15)), 0.02), (f"0{n(r.randint(6, 12))}", 0.0), (f"000{n(r.randint(5, 9))}", 0.02), (f"20{n(2)}-0{n(1)}-1{n(1)}", 0.02), (f"1{n(1)}.0{n(1)}.20{n(2)}", 0.02), (f"0{n(1)}/1{n(1)}/20{n(2)}", 0.02), (f"20{n(2)}-0{n(1)}-1{n(1)} 1{n(1)}", 0.02),
        (f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", 0.0), (f"{n(2)}.{n(3)}.{n(3)}", 0.0), (f"{n(1)} {n(3)} {n(3)}", 0.0), (f"{n(3)} {n(3)} {n(3)}", 0.0), (f"19{n(2)} 20{n(2)}", 0.02), (f"19{n(2)}-20{n(2)}", 0.02),
        (f"{n(3)}-{n(4)}-{n(3)}", 0.0), (f"{n(4)}/{n(5)}", 0.0), (f"{n(1)}.{n(2)}.{n(5)}", 0.0), (f"{n(4)} {n(4)} {n(4)}", 0.0), (f"{n(5)}-{n(5)}", 0.0),
    ])


def examples(count: int = 12_000, seed: int = 4) -> list[tuple[int, str, str, int, int]]:
    """(number, text, kind, start, end) of generated texts, three look-alikes for each text with personal data.

    ``start`` is -1 where the text has none.
    """
    r = random.Random(seed)

    def word():
        return "".join(r.choice("aeiou" if i % 2 else "bcdfglmnprstvw") for i in range(r.randint(2, 8)))

    out = []
    for i in range(count):
        kind, real = KINDS[i % len(KINDS)], i // len(KINDS) % 4 == 0
        span, named = _personal(r, kind) if real else _alike(r, kind, word)
        before = [word() for _ in range(r.randint(5, 9))]
        if r.random() < named:
            before.append(r.choice(INTRO[kind]))
        elif not real and r.random() < 0.5 and kind != "email":
            before.append(r.choice(OTHER))
        text = " ".join(before) + r.choice([" ", " ", " ", " (", ": ", ' "'])
        start = len(text)
        out.append((i, text + span + r.choice([" ", " ", ", ", ". ", ")", "\n"]) + " ".join(word() for _ in range(5)), kind, start if real else -1, start + len(span)))
    return out


def fit(spark: SparkSession, precision: float) -> tuple[float, list, list[float]]:
    """Trees and a threshold per kind, from the feature classes of generated candidates: half for each."""
    texts = spark.createDataFrame(examples(), "number int, text string, kind string, start int, end int")
    texts = texts.select("number", "text", F.struct("kind", "start", "end").alias("real"))
    found = _with_candidates(texts, "number", "real").select("number", "real", F.explode("candidates").alias("c"))
    is_real = ((F.col("c.kind") == F.col("real.kind")) & (F.col("c.start") == F.col("real.start")) & (F.col("c.end") == F.col("real.end"))).cast("int")
    held_out = F.floor(F.col("number") / (4 * len(KINDS))) % 2
    counts = found.select("c.kind", *(f"c.{f}" for f in FEATURES), is_real.alias("real"), held_out.alias("half")).groupBy("kind", *FEATURES, "half").agg(
        F.sum("real").alias("good"), F.count(F.lit(1)).alias("n")).collect()
    counts = sorted(counts, key=lambda c: (KINDS.index(c["kind"]), *(c[f] for f in FEATURES), c["half"]))
    x = np.array([[KINDS.index(c["kind"]), *(c[f] for f in FEATURES)] for c in counts], int)
    good = np.array([c["good"] for c in counts], float)
    bad = np.array([c["n"] for c in counts], float) - good
    half = np.array([c["half"] for c in counts], int)
    start, trees = boost(x[half == 0], good[half == 0], bad[half == 0], rounds=60)
    score, cuts = _predict(x, start, trees), []
    for k in range(len(KINDS)):
        own = np.flatnonzero((x[:, 0] == k) & (half == 1))
        # classes of one score are taken together
        steps = np.unique(score[own])[::-1]
        share = [good[own][score[own] >= s].sum() / (good + bad)[own][score[own] >= s].sum() for s in steps]
        fine = [s for s, p in zip(steps, share, strict=True) if p >= precision]
        # the executors add the same numbers, maybe in another order
        cuts.append(float(fine[-1]) - 1e-9 if fine else math.inf)
    return start, trees, cuts


def _free(spans: str, base: str, kind: str) -> str:
    """The spans (of type ``kind``) that touch no base span; both are names or short expressions.

    Both are sorted together and run through twice: forwards with the furthest end of a base span so far, backwards with
    the nearest start of one.
    """
    both = f"""concat(
      transform({base}, b -> named_struct('start', b.start, 'no', 0, 'end', b.end, 'span', CAST(NULL AS {kind}))),
      transform({spans}, c -> named_struct('start', c.start, 'no', 1, 'end', c.end, 'span', c)))"""
    from_left = _running("rows", "-1", "IF(x.no = 0, greatest(s, x.end), s)", "s > x.start", "boolean")
    from_right = _let("reverse(rows)", "back", _running("back", "2147483647", "IF(x.no = 0, least(s, x.start), s)", "s < x.end", "boolean"))
    touched = f"zip_with({from_left}, reverse({from_right}), (a, b) -> a OR b)"
    kept = f"transform(filter(zip_with(rows, {touched}, (r, t) -> named_struct('r', r, 't', t)), z -> z.r.no = 1 AND NOT z.t), z -> z.r.span)"
    return f"IF(size({base}) = 0 OR size({spans}) = 0, {spans}, {_let(f'array_sort({both})', 'rows', kept)})"


def _with_candidates(texts: DataFrame, *others: str) -> DataFrame:
    """``base``, and the ``candidates`` that touch none of it."""
    found = texts.select(*others, base_spans().alias("base"), candidates().alias("candidates"))
    kind = found.schema["candidates"].dataType.elementType.simpleString()
    return found.select(*others, "base", F.expr(_free("candidates", "base", kind)).alias("candidates"))


def find(docs: DataFrame, precision: float = 0.97) -> DataFrame:
    """(doc_id, base, spans): arrays of (kind, start, end), by start and then kind."""
    start, trees, cuts = fit(docs.sparkSession, precision)

    def chosen(x: Column) -> Column:
        cut = F.lit(math.inf)
        for k, value in zip(KINDS, cuts, strict=True):
            cut = F.when(x["kind"] == k, value).otherwise(cut)
        return _score(x, start, trees) >= cut

    def bare(spans) -> Column:
        return F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    def ordered(c: Column) -> Column:
        keyed = F.transform(c, lambda s: F.struct(s["start"].alias("start"), _kind_no(s["kind"]).alias("no"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    found = _with_candidates(documents(docs), "doc_id").select("doc_id", bare("base").alias("base"), bare(F.filter("candidates", chosen)).alias("added"))
    first = f"filter(added, a -> a.kind = '{KINDS[0]}')"
    later = [
        _free(f"filter(added, a -> a.kind = '{k}')", f"filter(added, a -> a.kind IN ({', '.join(map(repr, KINDS[:i]))}))", "struct<kind:string,start:int,end:int>")
        for i, k in enumerate(KINDS) if i
    ]
    single = F.expr(f"IF(size(added) < 2, added, concat({', '.join([first, *later])}))")
    return found.select("doc_id", ordered(F.col("base")).alias("base"), ordered(F.concat("base", single)).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
