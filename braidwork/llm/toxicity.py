"""Toxicity: misspelled lexicon terms in context.

A lexicon of terms (words and word beginnings) is learned from labelled rows and kept in
a trie. Each distinct word of a text is read by a Levenshtein automaton of one edit that
walks the trie, so a term is caught when a letter is wrong, missing or added; a digit or
sign inside a word is a wrong letter. Terms of fewer than five letters are met without
edits only. A hit is judged in its window of words: between a pair of quotation marks of the
same line that both stand in the window, or beside a word of reporting, it counts as
quotation, else as abuse. Words of reporting, in whatever language, are learned: near a
term they stand in clean rows far oftener than the term itself does.

A term is a word or word beginning whose presence in toxic rows is beyond chance (a
likelihood-ratio test, not a number of rows); where several share their beginning, the one
whose different words tell the two kinds of rows apart best stays. How often a text holds
a term (once, twice, oftener, for each 2,000 words) weighs the log ratio of the toxic and
clean rows that hold it so, by kind of spelling (exact, edited, with a digit or sign
inside) and context: a stem that clean texts hold once by chance is evidence only when it
comes back. Rare spellings lean on the term's exact one, quotations on what all quoted terms
show together. Weights of different terms add up, and with a prior give the probability.

The learning rows are a bounded sample: at most ``per_label`` rows of each label, drawn
by a hash of the id among the rows that aren't held out. What is gathered from it, the
lexicon and its weights, is bounded by it too. Near copies
among them (one of four MinHashes of five-word shingles in common) share one vote. A word
is met by its first 32 letters.

Defined results for unusual rows: null and empty text score as a text without a hit; a
null doc_id is scored, never trained on and not held out; repeated rows score alike; an
empty table gives an empty result, a table without labels of both kinds scores 0; labels
that name an id twice count as toxic once one of them does; equal texts under several ids
share one vote, by their labels; of equally good terms the longest, then the last by its
letters is taken; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidwork.llm.common import materialise
from braidwork.llm.language import bounded_sample

# A word begins and ends with a letter; digits and signs may stand in it.
_WORD = regex.compile(r"\p{L}(?:[\p{L}\p{N}*@$!+#]*\p{L})?")
# Quotation marks; an apostrophe between letters is none.
_MARK = regex.compile(r"[\"`«»“”„]|(?<!\p{L})['‘’]|['‘’](?!\p{L})|\n")
# The marks that close each opening mark.
CLOSES = {'"': '"', "`": "`", "«": "»", "»": "«", "“": "”", "„": "“”", "'": "'", "‘": "’", "’": "’"}

# Kinds of spelling: as the term, an edit of letters, an edit with a digit or sign in the word.
EXACT, EDITED, MASKED = 0, 1, 2
# Letters of a term, and the least log ratio that counts as evidence.
LONGEST, LEAST_WEIGHT = 32, 1.0


def quoted_spans(text: str) -> list[tuple[int, int]]:
    """Places of the pairs of quotation marks, each on one line, in order and not nested."""
    out, opened = [], None
    for m in _MARK.finditer(text):
        c, at = m.group(), m.start()
        if c == "\n":
            opened = None
        elif opened is not None and c in CLOSES[text[opened]]:
            out.append((opened, at))
            opened = None
        # A single mark opens only before a letter and after none.
        elif opened is None and c in CLOSES and (c not in "'’" or (at + 1 < len(text) and text[at + 1].isalpha() and (at == 0 or not text[at - 1].isalpha()))):
            opened = at
    return out


class Lexicon:
    """Terms in a trie, walked by an automaton that allows one edit."""

    def __init__(self, terms, shortest_fuzzy: int = 5):
        self.root: dict = {}
        self.shortest_fuzzy = shortest_fuzzy
        for t in terms:
            node = self.root
            for c in t:
                node = node.setdefault(c, {})
            node[""] = t

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the best term at the start of the word: fewest edits, longest."""
        best = None
        states, seen = [(self.root, 0, 0)], set()
        while states:
            node, at, edits = states.pop()
            term = node.get("")
            if term is not None and (edits == 0 or len(term) >= self.shortest_fuzzy):
                found = (-edits, len(term), term)
                if best is None or found > best:
                    best = found
            if at < len(word) and (n := node.get(word[at])) is not None:
                states.append((n, at + 1, edits))
            if not edits and len(word) >= self.shortest_fuzzy - 1:
                for c, n in node.items():
                    if c:
                        if at < len(word) and c != word[at]:
                            states.append((n, at + 1, 1))  # a wrong letter
                        if (id(n), at) not in seen:
                            seen.add((id(n), at))
                            states.append((n, at, 1))  # a missing letter
                if at < len(word):
                    states.append((node, at + 1, 1))  # an added letter
        return None if best is None else (best[2], -best[0])


class Scanner:
    """Hits of a text, remembering what up to ``cache`` words gave."""

    def __init__(self, terms, reporting=(), cache: int = 400_000, window: int = 4):
        self.lexicon, self.cache, self.window = Lexicon(terms), cache, window
        self.reporting = frozenset(reporting)
        self.known: dict[str, tuple[str, int] | None] = {}

    def hits(self, text: str | None) -> set[tuple[str, int, bool]]:
        """Distinct (term, edits, quoted) of a text."""
        return {(t, min(kind, 1), q) for t, kind, q in self.count(text)[0]}

    def count(self, text: str | None, near: bool = False) -> tuple[Counter, int, set[tuple[str, str]]]:
        """How often each (term, kind of spelling, quoted) stands in the text, its number of
        words, and on demand each term with the other words of its windows."""
        text = (text or "").lower()
        known, match = self.known, self.lexicon.match
        found = _WORD.findall(text)
        words = set(found)
        if len(known) + len(words) > self.cache:
            known.clear()
        some = set()
        for w in words:
            if w not in known:
                known[w] = match(w)
            if known[w] is not None:
                some.add(w)
        out, around = Counter(), set()
        if some:
            spans = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(text)]
            quotes = quoted_spans(text)
            starts = [a for a, _ in quotes]
            for k, (w, a, b) in enumerate(spans):
                if w in some:
                    window = spans[max(0, k - self.window) : k + self.window + 1]
                    q = bisect_right(starts, a) - 1
                    marked = q >= 0 and quotes[q][1] >= b and quotes[q][0] >= window[0][1] - 1 and quotes[q][1] <= window[-1][2]
                    term, edits = known[w]
                    kind = EXACT if not edits else EDITED if w.isalpha() else MASKED
                    out[term, kind, marked or any(x in self.reporting for x, _, _ in window)] += 1
                    if near:
                        around |= {(term, x) for x, _, _ in window if x not in some}
        return out, len(found), around


def levels(counts: Counter, n_words: int, span: int = 2000) -> set[tuple[str, int, bool, int]]:
    """Each (term, kind, quoted) with 1, 2 or 3: once, twice or oftener for each ``span`` words."""
    return {(*h, min(3, math.ceil(n / max(1, n_words / span)))) for h, n in counts.items()}


class Model(NamedTuple):
    """What ``fit`` learns; ``none`` is the weight of a text without evidence."""

    terms: list[str]
    reporting: list[str]
    weights: dict[tuple[str, int, bool, int], float]
    none: float

    def score(self, counts: Counter, n_words: int, prior: float = 0.1) -> float:
        z = math.fsum(self.weights.get(h, 0.0) for h in levels(counts, n_words)) or self.none
        z += math.log(prior / (1 - prior))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """doc_id, text, toxic and vote of the sampled labelled rows."""
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    ids = bounded_sample(known.filter(~held_out()), "toxic", per_label)
    # At most per_label ids of each of two labels: a bound that doesn't grow with the data.
    return with_votes(docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("text")).join(F.broadcast(ids), "doc_id"))


def with_votes(rows: DataFrame, n_hashes: int = 4) -> DataFrame:
    """Adds ``vote``: one over the most rows that share a MinHash of the row's five-word shingles."""
    runs = lambda ws: F.transform(F.sequence(F.lit(1), F.greatest(F.size(ws) - 4, F.lit(1))), lambda k: F.xxhash64(F.array_join(F.slice(ws, k, 5), " ")))
    # As an argument of the outer function the words are split once a row, not once a shingle.
    shingles = F.element_at(F.transform(F.array(F.split("text", "\\s+")), runs), 1)
    minima = lambda s: F.array(*[F.array_min(F.transform(s, lambda x, seed=seed: F.xxhash64(x, F.lit(seed)))) for seed in range(n_hashes)])
    least = F.element_at(F.transform(F.array(shingles), minima), 1)
    keyed = rows.select(*rows.columns, F.explode(F.array(least)).alias("_least"))
    keyed = keyed.select(*rows.columns, *[F.col("_least")[k].alias(f"_least{k}") for k in range(n_hashes)])
    sizes = [F.count("*").over(Window.partitionBy(f"_least{k}")) for k in range(n_hashes)]
    return keyed.withColumn("vote", F.lit(1.0) / F.greatest(*sizes)).select(*rows.columns, "vote")


def surprise(seen: Column, expected: Column) -> Column:
    """One part of the likelihood-ratio statistic; 0 where nothing was seen."""
    return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)


# The value that the statistic passes by chance once in ten million tries.
BEYOND_CHANCE = 28.4


def learn_terms(train: DataFrame, shortest: int = 2, longest: int = LONGEST, least_weight: float = LEAST_WEIGHT) -> list[str]:
    """Words and word beginnings whose presence marks toxic rows beyond chance; of those
    that share a beginning, the one whose different words tell the kinds of rows apart best."""
    words = F.array_distinct(F.regexp_extract_all("text", F.lit("(\\p{L}+)"), F.lit(1)))
    heads = lambda w: F.transform(F.sequence(F.lit(shortest), F.least(F.length(w), F.lit(longest))), lambda n: F.substring(w, F.lit(1), n))
    terms = F.flatten(F.transform(F.filter(words, lambda w: F.length(w) >= shortest), heads))
    rows = train.select("doc_id", F.xxhash64("text").alias("h"), "toxic", "vote", F.explode(terms).alias("term"))
    per_row = rows.groupBy("doc_id", "h", "toxic", "vote", "term").agg(F.count("*").alias("words"))
    toxic, clean = F.col("vote") * F.col("toxic"), F.col("vote") * (1 - F.col("toxic"))
    counts = per_row.groupBy("term").agg(
        F.sum(toxic).alias("t"), F.sum(clean).alias("n"), F.sum(toxic * F.col("words")).alias("tw"), F.sum(clean * F.col("words")).alias("nw")
    )
    sizes = train.groupBy().agg(F.sum(toxic).alias("t"), F.sum(clean).alias("n")).first()
    if not sizes["t"] or not sizes["n"]:
        return []
    share = sizes["t"] / (sizes["t"] + sizes["n"])
    g = lambda t, n: F.round(surprise(F.col(t), (F.col(t) + F.col(n)) * share) + surprise(F.col(n), (F.col(t) + F.col(n)) * (1 - share)), 6)
    ratio = (F.col("t") + 0.5) / (F.col("n") + 0.5) * (sizes["n"] / sizes["t"])
    rows = counts.filter((g("t", "n") >= BEYOND_CHANCE) & (ratio >= math.exp(least_weight))).select("term", g("tw", "nw").alias("g")).collect()
    kept: set[str] = set()
    inner: set[str] = set()  # beginnings of kept terms
    for _, _, t in sorted(((r["g"], len(r["term"]), r["term"]) for r in rows), reverse=True):
        if t not in inner and not any(t[:k] in kept for k in range(shortest, len(t) + 1)):
            kept.add(t)
            inner |= {t[:k] for k in range(shortest, len(t))}
    return sorted(kept)


def learn_reporting(train: DataFrame, terms: list[str], purity: float = 0.95) -> list[str]:
    """Words that stand in the windows of terms in clean rows, beyond what those terms'
    own share of clean rows lets expect, and hardly in toxic ones."""

    def run(batches):
        scanner = Scanner(terms)
        near = pa.list_(pa.struct([("term", pa.string()), ("w", pa.string())]))
        for b in batches:
            found = [scanner.count(x, near=True) for x in b.column(2).to_pylist()]
            pairs = [[{"term": t, "w": w} for t, w in sorted(around | {(t, "") for t, _, _ in hits})] for hits, _, around in found]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pairs, near)], names=["toxic", "vote", "near"])

    vote = F.col("vote") if "vote" in train.columns else F.lit(1.0)
    near = train.select(F.col("toxic").cast("int").alias("toxic"), vote.alias("vote"), "text").mapInArrow(
        run, "toxic int, vote double, near array<struct<term:string,w:string>>"
    )
    pairs = near.select("toxic", "vote", F.inline("near")).groupBy("term", "w").agg(
        F.sum(F.col("vote") * (1 - F.col("toxic"))).alias("n"), F.sum(F.col("vote") * F.col("toxic")).alias("t")
    )
    pairs = materialise(pairs, "toxic-near")
    # The empty word stands for the rows that hold the term; one row a term.
    usual = pairs.filter("w = ''").select("term", (F.col("n") / (F.col("n") + F.col("t"))).alias("usual"))
    both = F.col("n") + F.col("t")
    words = pairs.filter("w != ''").join(F.broadcast(usual), "term").groupBy("w").agg(
        F.sum("n").alias("n"), F.sum("t").alias("t"), F.sum(both * F.col("usual")).alias("e"), F.sum(both * (1 - F.col("usual"))).alias("f")
    )
    rate, other = F.col("n") / F.col("e"), F.coalesce(F.col("t") / F.nullif(F.col("f"), F.lit(0.0)), F.lit(1.0))
    g = surprise(F.col("n"), F.col("e")) + surprise(F.col("t"), F.col("f"))
    found = words.filter((F.col("e") > 0) & (F.round(g, 6) >= BEYOND_CHANCE)).filter(rate / (rate + other) >= purity)
    return sorted(r["w"] for r in found.select("w").collect())


_HIT = pa.list_(pa.struct([("term", pa.string()), ("kind", pa.int32()), ("quoted", pa.bool_()), ("level", pa.int32())]))


def _hits(train: DataFrame, terms: list[str], reporting: list[str]) -> DataFrame:
    """toxic, vote and the hits of each row by level."""

    def run(batches):
        scanner = Scanner(terms, reporting)
        for b in batches:
            found = [scanner.count(x) for x in b.column(2).to_pylist()]
            hits = [[{"term": t, "kind": k, "quoted": q, "level": n} for t, k, q, n in sorted(levels(c, size))] for c, size, _ in found]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(hits, _HIT)], names=["toxic", "vote", "hits"])

    source = train.select(F.col("toxic").cast("int").alias("toxic"), "vote", "text")
    return source.mapInArrow(run, "toxic int, vote double, hits array<struct<term:string,kind:int,quoted:boolean,level:int>>")


def weigh_hits(seen: dict, terms: list[str], ratio: float, least_weight: float = LEAST_WEIGHT, lean: float = 1.0, edited: float = 0.75, quoted: float = 0.25) -> dict:
    """Weights from ``seen``, (toxic, clean) rows of each (term, kind, quoted, level), where
    the sample has ``ratio`` toxic rows for each clean one.

    A level leans, with the force of ``lean`` rows, on the level below it, and an edited
    spelling on ``edited`` times the exact one's weight; a quotation on a part of the plain hit's, which all terms' quotations
    settle together and which is ``quoted`` where there are none. Less than
    ``least_weight`` is no evidence and weighs 0.
    """
    lift = lambda z: 1 / (1 + math.exp(-z))

    def weigh(t: float, n: float, prior: float) -> float:
        p = (t + lean * lift(prior)) / (t + n * ratio + lean)
        return math.log(p / (1 - p))

    plain: dict[tuple[str, int, int], float] = {}
    for term in terms:
        exact = 0.0
        for level in (1, 2, 3):
            exact = plain[term, EXACT, level] = weigh(*seen.get((term, EXACT, False, level), (0.0, 0.0)), max(0.0, exact))
            for kind in (EDITED, MASKED):
                plain[term, kind, level] = weigh(*seen.get((term, kind, False, level), (0.0, 0.0)), edited * exact)
    marked = {(term, kind, level): v for (term, kind, q, level), v in seen.items() if q}
    strong = {k: v for k, v in sorted(marked.items()) if plain[k] >= least_weight}
    part = quoted
    if strong:
        usual = math.fsum(plain[k] for k in strong) / len(strong)
        shown = weigh(math.fsum(t for t, _ in strong.values()), math.fsum(n for _, n in strong.values()), quoted * usual)
        part = min(1.0, max(0.0, shown / usual))
    weights = {}
    for (term, kind, level), z in plain.items():
        cited = weigh(*marked.get((term, kind, level), (0.0, 0.0)), part * z)
        for q, w in ((False, z), (True, cited)):
            weights[term, kind, q, level] = w if w >= least_weight else 0.0
    return weights


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 4000) -> Model:
    """Terms, words of reporting and weights, from the sampled rows."""
    train = materialise(training_rows(docs, labels, per_label), "toxic-train")
    toxic, clean = F.col("vote") * F.col("toxic"), F.col("vote") * (1 - F.col("toxic"))
    sums = (F.sum(toxic).alias("t"), F.sum(clean).alias("n"))
    sizes = train.groupBy().agg(*sums).first()
    if not sizes["t"] or not sizes["n"]:
        return Model([], [], {}, -50.0)
    terms = learn_terms(train)
    reporting = learn_reporting(train, terms)
    found = materialise(_hits(train, terms, reporting), "toxic-hits")
    rows = found.select("toxic", "vote", F.inline("hits")).groupBy("term", "kind", "quoted", "level").agg(*sums)  # at most 18 rows a term
    seen = {(r["term"], r["kind"], r["quoted"], r["level"]): (round(r["t"], 6), round(r["n"], 6)) for r in rows.collect()}
    ratio = sizes["t"] / sizes["n"]
    weights = weigh_hits(seen, terms, ratio)
    proofs = [F.struct(F.lit(t).alias("term"), F.lit(k).alias("kind"), F.lit(q).alias("quoted"), F.lit(n).alias("level")) for (t, k, q, n), w in weights.items() if w]
    without = found.filter(~F.arrays_overlap("hits", F.array(*proofs))) if proofs else found
    rest = without.groupBy().agg(*sums).first()
    none = math.log(((rest["t"] or 0.0) + 0.5) / ((rest["n"] or 0.0) * ratio + 0.5))
    return Model(terms, reporting, weights, min(0.0, round(none, 9)))


def predict(docs: DataFrame, model: Model, cut: float = 0.7) -> DataFrame:
    source = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))

    def run(batches):
        scanner = Scanner(model.terms, model.reporting)
        for b in batches:
            found = [scanner.count(x) for x in b.column(2).to_pylist()]
            scores = [model.score(c, n) for c, n, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= cut) for s in scores], pa.int32()),
                    pa.array([sum(c.values()) for c, _, _ in found], pa.int64()),
                ],
                names=["doc_id", "held_out", "score", "predicted", "n_hits"],
            )

    return source.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, n_hits long")


def score_toxicity(docs: DataFrame, labels: DataFrame, per_label: int = 4000) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of hits of every row."""
    return predict(docs, fit(docs, labels, per_label))
