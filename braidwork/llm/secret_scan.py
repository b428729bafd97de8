"""Secrets in texts: fixed patterns, and random strings told from identifiers.

Three kinds of span are found by pattern: ``assign`` (a secret's name with a value of 8
characters or more), ``access`` (a key id of 16 or more) and ``hex`` (32 hexadecimal digits
or more). Of each kind the matches are the leftmost that don't overlap, judged before the
short ones are dropped. A span is the whole match, in code points, end exclusive.

The method adds spans of kind ``random``: strings that no pattern finds, told by two
Markov models of characters, one of random strings and one of ordinary identifiers. In a
run of characters that keys are made of, the stretch with the greatest log-likelihood ratio is found; it is a
secret if the ratio exceeds the prior odds against one (``odds``) and the stretch has
``least_length`` characters, and what lies left and right of it is judged alike. It never
touches a span of the patterns, and digits alone are a number, not a key.

Labelled samples: values of up to 256 characters that the patterns find are random strings, and the other runs
of 8 characters or more, but too short to be judged, are identifiers: what is judged is never learned from. From all documents the ``per_label`` distinct ones of each label with the least hash are
taken, so the samples are bounded and depend neither on copies nor on how rows are dealt;
a value that stands under both labels counts as random. Where no value is known the random
model is uniform, and without identifiers nothing is added.

Defined results for unusual rows: a null or empty text has no spans, zero counts and the hash of
an empty string; repeated rows are judged alike; a null doc_id is returned as null; an empty
table gives no rows; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The three patterns and the least lengths of what they find.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "random")

_CHARS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_IS_KEY = np.isin(np.arange(256), list(_CHARS))
_PLACE = np.zeros(256, dtype=np.int64)
_PLACE[list(_CHARS)] = np.arange(len(_CHARS))
START = len(_CHARS)  # the state before the first character
WEIGHTS = (1.0, 4.0, 16.0, 64.0, 256.0, 1024.0, 4096.0)

SAMPLE = "label int, hash long, value string"
FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def key_runs(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of key characters of ``least`` or more bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], _IS_KEY[codes], [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def pattern_spans(text: bytes, runs) -> list[tuple[int, int, str, bytes]]:
    """(start, end, kind, value) in bytes. Key ids and hexadecimal digits lie inside one
    run of key characters, so only the long runs are searched for them."""
    out = []
    small = text.lower()
    if any(n in small for n in NAMES):
        out += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for a, b in runs:
        if b - a < LEAST["access"]:
            continue
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            out += [(m.start(), m.end(), kind, m[0]) for m in pattern.finditer(text, a, b) if m.end() - m.start() >= LEAST[kind]]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _pair_counts(values: list[bytes]) -> np.ndarray:
    n = np.zeros((START + 1, START))
    for v in values:
        at = _PLACE[np.frombuffer(v, dtype=np.uint8)]
        np.add.at(n, (np.concatenate(([START], at[:-1])), at), 1)
    return n


def _logs(n: np.ndarray, weight: float) -> np.ndarray:
    """Pairs lean on single characters as ``weight`` more pairs would, these on the uniform
    model."""
    single = (n.sum(axis=0) + 0.5) / (n.sum() + 0.5 * START)
    return np.log((n + weight * single) / (n.sum(axis=1, keepdims=True) + weight))


def log_model(values: list[bytes]) -> np.ndarray:
    """Log-probabilities of one character after another. How far pairs lean on single
    characters is what makes the odd values likeliest under a model of the even ones."""
    even, odd = _pair_counts(values[::2]), _pair_counts(values[1::2])
    weight = max(WEIGHTS, key=lambda w: float((odd * _logs(even, w)).sum()))
    return _logs(even + odd, weight)


class Models:
    """Log-likelihood ratios of one character after another: random over ordinary."""

    def __init__(self, random: list[bytes], ordinary: list[bytes]):
        self.ratio = log_model(random) - log_model(ordinary)
        self.known = bool(ordinary)

    def ratios(self, codes: np.ndarray) -> np.ndarray:
        at = _PLACE[codes]
        return self.ratio[np.concatenate(([START], at[:-1])), at]


def best_stretch(x: np.ndarray) -> tuple[float, int, int]:
    """The greatest sum of neighbours, its start and end; the first of equals."""
    sums = np.concatenate(([0.0], np.cumsum(x)))
    low = np.minimum.accumulate(sums[:-1])
    gain = sums[1:] - low
    end = int(np.argmax(gain))
    start = int(np.argmin(sums[: end + 1]))
    return float(gain[end]), start, end + 1


def random_stretches(x: np.ndarray, least: float, length: int) -> list[tuple[int, int]]:
    """Stretches whose sum exceeds ``least``, of ``length`` or more, in order."""
    out, todo = [], [(0, len(x))]
    while todo:
        a, b = todo.pop()
        if b - a < length:
            continue
        gain, s, e = best_stretch(x[a:b])
        if gain <= least:
            continue
        if e - s >= length:
            out.append((a + s, a + e))
        todo += [(a, a + s), (a + e, b)]
    return sorted(out)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def labelled_samples(docs: DataFrame, per_label: int, least_length: int) -> DataFrame:
    """(label, hash, value): 1 for values that the patterns find, 0 for other short runs. Each
    task sends at most ``per_label`` of a label."""

    def run(batches):
        least: tuple[list, list] = ([], [])  # heaps of (-hash, value)
        inside: tuple[set, set] = (set(), set())

        def offer(label: int, value: bytes) -> None:
            heap, seen = least[label], inside[label]
            h = xxhash.xxh64_intdigest(value, 7) >> 1
            if value in seen or (len(heap) == per_label and -h <= heap[0][0]):
                return
            seen.add(value)
            heapq.heappush(heap, (-h, value))
            if len(heap) > per_label:
                seen.discard(heapq.heappop(heap)[1])

        for b in batches:
            words = set()
            for cell in b.column(1):
                text = cell.as_py()
                codes = np.frombuffer(text, dtype=np.uint8)
                starts, ends = key_runs(codes, 8)
                runs = list(zip(starts.tolist(), ends.tolist(), strict=True))
                spans = pattern_spans(text, runs)
                for *_, value in spans:
                    if len(value) <= 256:
                        offer(1, value)
                words.update(text[s:e] for s, e in runs if e - s < least_length and not any(s < y and x < e for x, y, *_ in spans))
            for w in words:
                offer(0, w)
        rows = [(label, -h, v.decode()) for label in (0, 1) for h, v in least[label]]
        cells = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, (pa.int32(), pa.int64(), pa.string()), strict=True)], names=["label", "hash", "value"])

    return _texts(docs).mapInArrow(run, SAMPLE)


def fit(docs: DataFrame, per_label: int = 5000, least_length: int = 16, parts: int = 16) -> Models:
    """The models of the bounded samples."""
    # Of the tasks' samples the label 1 wins, so a value has one label.
    sample = labelled_samples(docs, per_label, least_length).groupBy("value").agg(F.max("label").alias("label"), F.first("hash").alias("hash"))
    # Each part sends its least values to the driver, so there are few parts.
    sample = sample.coalesce(parts).persist()
    take = lambda label: [r["value"].encode() for r in sample.filter(F.col("label") == label).orderBy("hash", "value").limit(per_label).collect()]
    out = Models(take(1), take(0))
    sample.unpersist()
    return out


def scan(text: bytes, models: Models, least: float, length: int) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The spans of the patterns and those that the method adds, in code points."""
    codes = np.frombuffer(text, dtype=np.uint8)
    starts, ends = key_runs(codes, min(LEAST["access"], length))
    runs = list(zip(starts.tolist(), ends.tolist(), strict=True))
    base = [s[:3] for s in pattern_spans(text, runs)]
    added = []
    if models.known:
        taken = sorted((a, b) for a, b, _ in base)
        for a, b in runs:
            # What the patterns leave of the run.
            for x, y in _gaps(a, b, taken):
                if y - x >= length:
                    found = [(x + s, x + e) for s, e in random_stretches(models.ratios(codes[x:y]), least, length)]
                    added += [(s, e, "random") for s, e in found if not text[s:e].isdigit()]
    if (base or added) and not text.isascii():
        before = np.concatenate(([0], np.cumsum((codes & 0xC0) != 0x80)))
        base, added = ([(int(before[a]), int(before[b]), k) for a, b, k in spans] for spans in (base, added))
    return base, added


def _gaps(a: int, b: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for x, y in taken:
        if y <= a or x >= b:
            continue
        if x > a:
            out.append((a, x))
        a = max(a, y)
    if a < b:
        out.append((a, b))
    return out


def _shown(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))


def secret_scan(docs: DataFrame, per_label: int = 5000, odds: float = 1e6, least_length: int = 16) -> DataFrame:
    """doc_id, the number of spans of each kind, the hash of the patterns' spans and all
    spans as kind:start:end."""
    models, least = fit(docs, per_label, least_length), math.log(odds)

    def run(batches):
        for b in batches:
            rows = []
            for cell in b.column(1):
                base, added = scan(cell.as_py(), models, least, least_length)
                n = [sum(k == kind for *_, k in base) for kind in KINDS[:3]]
                rows.append((*n, hashlib.sha256(_shown(base).encode()).hexdigest(), _shown(base + added), len(added)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            cells = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, t) for c, t in zip(cells, kinds, strict=True)]], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]
            )

    return _texts(docs).mapInArrow(run, FOUND)
