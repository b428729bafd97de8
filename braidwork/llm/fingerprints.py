"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs (lines, their sentences, and the parts of long sentences) and
each distinct one into a 64-bit digest. A long sentence is cut where its own letters say so,
so a changed letter changes the part it stands in and no other. A sketch has three tables of
cells; a digest is added to one cell of each table, where a cell keeps a count, the sum of
its digests and the sum of their checks. The sketch of one version minus that of another
leaves their difference; cells with a single digest are read and taken out in turn
(peeling), which gives the digests that only one version has. If cells are left, larger
sketches are built, of twice the size or of the size that the counts of the cells call for,
until the peeling ends. A sum of several digests can pass for one of them; it doesn't belong
to its cell or is read again when it has been taken out, and then a larger sketch is built.

The fingerprint is a sketch whose size follows the number of digests, printed with that
number, so equal texts have equal fingerprints. A wide sketch folds to a narrower one, since
widths are powers of two: two fingerprints are folded to the narrower width and subtracted,
and versions that differ by up to a tenth or so of their paragraphs are settled from the two printed
strings alone (``compare``). The likeness of two versions is 1 - d / (a + b) for d
recovered digests of a and b; two empty texts are alike.

Defined results for unusual rows: a null text is empty; a null doc_id comes last in the
descending order; rows with one doc_id follow each other by text hash, and rows equal in
both as they are read; a table of one row is its own next document; an empty table gives an
empty result; other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidwork.llm.common import materialise
from braidwork.llm.grams import mix

U = np.uint64
C = np.uint32
TABLES = 3
# Between sentences: white space after a full stop, which isn't part of it, or line ends. Both
# patterns begin with a class of characters, which a search looks for first.
_SENTENCE = re.compile(r"[.!?\n](?:(?<=\n)\n*|(?<!\n)\s+)")
# Within a long sentence: a space between letters that a third of the places or so have.
_PART = re.compile(r"\s(?<=[adghklnsy,;:]\s)\s*(?=[\Wa-m])")
_BLACK = re.compile(r"\S")


class Cut(NamedTuple):
    """The sentences of a text: where they start and stop, how many paragraph digests come
    before each (and in all), and these digests, in the order of the text."""

    starts: np.ndarray
    stops: np.ndarray
    before: np.ndarray
    keys: np.ndarray


def cut(text: str, long: int = 64) -> Cut:
    starts, stops, before, keys = [], [], [0], []
    digest, start = xxhash.xxh3_64_intdigest, 0
    for m in chain(_SENTENCE.finditer(text), [None]):
        stop, end = m.span() if m else (len(text), 0)
        if m and text[stop] != "\n":
            stop += 1
        s = text[start:stop]
        if len(s) <= long:
            if s and not s.isspace():
                keys.append(digest(s))
        else:
            parts = _PART.split(s)
            if len(s) > 4 * long and max(map(len, parts)) > 4 * long:
                # Text without such places, in scripts without spaces, is cut by length.
                parts = chain.from_iterable([p] if len(p) <= 4 * long else [p[k : k + long] for k in range(0, len(p), long)] for p in parts)
            keys += map(digest, parts)
        starts.append(start)
        stops.append(stop)
        before.append(len(keys))
        start = end
    return Cut(*(np.array(x, dtype=np.int64) for x in (starts, stops, before)), np.array(keys, dtype=U))


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new]


def digests(text: str | None) -> np.ndarray:
    """The distinct paragraph digests of a text, in order."""
    return _distinct(cut(text or "").keys)


def _checks(keys: np.ndarray) -> np.ndarray:
    return (mix(keys * U(0xD1B54A32D192ED03) + U(0x632BE59BD9B4E019)) >> U(32)).astype(C)


def _cells(keys: np.ndarray, width: np.ndarray) -> list[np.ndarray]:
    """The cell of each digest within each of the tables, ``width`` cells wide."""
    return [_cell(keys, k, width) for k in range(TABLES)]


def _cell(keys: np.ndarray, table, width: np.ndarray) -> np.ndarray:
    k = np.asarray(table).astype(U)
    return (mix(keys * (U(2) * k + U(3)) + k + U(1)) & (width - U(1)) | k * width).astype(np.int64)


class Sketches:
    """Sketches of many documents side by side; document k has 3 * width[k] cells. Widths
    are powers of two."""

    def __init__(self, width: np.ndarray):
        self.width = width
        size = TABLES * width
        self.offset = np.cumsum(size) - size
        total = int(size.sum())
        self.count = np.zeros(total, dtype=np.int64)
        self.keys = np.zeros(total, dtype=U)
        self.checks = np.zeros(total, dtype=C)

    def add(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray) -> np.ndarray:
        """Adds (sign 1) or takes out (sign -1) digests; the sums wrap around. Gives the
        cells that they are in."""
        signed = sign.astype(np.int64).astype(U)
        keys, checks, offset = keys * signed, _checks(keys) * signed.astype(C), self.offset[owner]
        cells = [offset + cell for cell in _cells(keys * signed, self.width[owner].astype(U))]
        for at in cells:
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, keys)
            np.add.at(self.checks, at, checks)
        return np.concatenate(cells)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(digest, owner, sign) read from the cells, and whether each document is done."""
        owner_of = np.repeat(np.arange(len(self.width)), TABLES * self.width)
        room = TABLES * self.width  # each digest that is read empties a cell for good
        found = ([], [], [])
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            sign, owner = self.count[look], owner_of[look]
            keys = self.keys[look] * sign.astype(U)
            good = np.flatnonzero((self.checks[look] * sign.astype(C) == _checks(keys)) & (room[owner] > 0))
            keys, sign, owner, at = keys[good], sign[good], owner[good], look[good] - self.offset[owner[good]]
            own = _cell(keys, at // self.width[owner], self.width[owner].astype(U)) == at
            keys, sign, owner = keys[own], sign[own], owner[own]
            pick = _firsts(keys, owner)  # a digest is read once, though up to three cells show it
            for out, x in zip(found, (keys[pick], owner[pick], sign[pick]), strict=True):
                out.append(x)
            room = room - np.bincount(owner[pick], minlength=len(room))
            look = _distinct(self.add(keys[pick], owner[pick], -sign[pick]))  # other cells are as before
            look = look[np.abs(self.count[look]) == 1]
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        undone = np.zeros(len(self.width), dtype=bool)
        undone[owner_of[left]] = True
        keys, owner, sign = (np.concatenate([np.empty(0, dtype=t), *x]) for x, t in zip(found, (U, np.int64, np.int64), strict=True))
        again = np.ones(len(keys), dtype=bool)
        again[_firsts(keys, owner)] = False
        undone[owner[again]] = True
        return keys, owner, sign, ~undone

    def guess(self) -> np.ndarray:
        """About how many digests each document's cells hold, by the squares of their counts:
        in a table they come to that number, and signs that don't cancel to 1 / width of the
        square of their sum."""
        squares, sums = (np.add.reduceat(x, self.offset) / TABLES if len(x) else np.zeros(0) for x in (self.count**2, self.count))
        return np.maximum(np.abs(sums), (squares - sums**2 / self.width) / (1 - 1 / np.maximum(self.width, 2)))


def _firsts(keys: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The place of each different (digest, owner)."""
    by = np.argsort(keys ^ mix(owner.astype(U) + U(1)))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (keys[by][1:] != keys[by][:-1]) | (owner[by][1:] != owner[by][:-1])
    return by[new]


def widths(sizes) -> np.ndarray:
    """Cells a table of the fingerprint for each number of digests: a power of two, at
    least 4, and 3/32 to 3/16 of the digests in all three tables beyond that."""
    n = np.maximum(np.asarray(sizes, dtype=np.int64), 1)
    return 4 << np.maximum(0, np.ceil(np.log2(n / 128)).astype(np.int64))


def sketch(sets: list[np.ndarray], width: np.ndarray, sign: int = 1, out: Sketches | None = None) -> Sketches:
    """One sketch for each set of digests; or the sets are added to (sign -1: taken from) ``out``."""
    out, sizes = out or Sketches(width), [len(x) for x in sets]
    if sum(sizes):
        keys = np.concatenate(sets)
        out.add(keys, np.repeat(np.arange(len(sets)), sizes), np.full(len(keys), sign, dtype=np.int64))
    return out


def subtract(a: Sketches, b: Sketches) -> Sketches:
    """a[k] minus b[k], each folded to the narrower of the two widths."""
    out = Sketches(np.minimum(a.width, b.width))
    for s, sign in ((a, 1), (b, -1)):
        cells = TABLES * s.width
        owner = np.repeat(np.arange(len(s.width)), cells)
        within = np.arange(len(owner)) - s.offset[owner]
        table, place = within // s.width[owner], within % s.width[owner]
        at = out.offset[owner] + table * out.width[owner] + place % out.width[owner]
        np.add.at(out.count, at, sign * s.count)
        np.add.at(out.keys, at, s.keys * U(sign & 0xFFFFFFFFFFFFFFFF))
        np.add.at(out.checks, at, s.checks * C(sign & 0xFFFFFFFF))
    return out


def differences(a: list[np.ndarray], b: list[np.ndarray], first: tuple[Sketches, Sketches] | None = None) -> tuple[np.ndarray, list]:
    """The number of digests that only one of a[k], b[k] has, and those digests. ``first``
    has the sketches of the fingerprints; those that don't peel are built again, larger."""
    n = len(a)
    one, two = first or (sketch(a, widths([len(x) for x in a])), sketch(b, widths([len(x) for x in b])))
    count, recovered = np.zeros(n, dtype=np.int64), [None] * n
    todo, left = np.arange(n), subtract(one, two)
    while len(todo):
        guess = left.guess()
        keys, owner, sign, done = left.peel()
        by = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[by], np.arange(len(todo) + 1))
        for j in np.flatnonzero(done):
            part = by[cuts[j] : cuts[j + 1]]
            count[todo[j]] = len(part)
            recovered[todo[j]] = (keys[part], sign[part])
        # Retried larger: twice as wide, or with cells for 1.4 times the digests.
        todo, width, guess = todo[~done], 2 * left.width[~done], guess[~done]
        if len(todo):
            sides = [[side[k] for k in todo] for side in (a, b)]
            most = np.array([len(x) + len(y) for x, y in zip(*sides, strict=True)])
            cells = 1.4 * np.minimum(guess, most) / TABLES
            left = sketch(sides[0], np.maximum(width, 1 << np.ceil(np.log2(np.maximum(cells, 1))).astype(np.int64)))
            sketch(sides[1], left.width, -1, left)
    return count, recovered


def likeness(a: list[np.ndarray], b: list[np.ndarray], first: tuple[Sketches, Sketches] | None = None) -> np.ndarray:
    d, _ = differences(a, b, first)
    both = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)])
    return np.where(both > 0, 1 - d / np.maximum(both, 1), 1.0)


def printed(s: Sketches, sizes: list[int]) -> list[str]:
    """The number of digests, the width and the cells of each sketch, as text."""
    out = []
    for k, size in enumerate(sizes):
        cells = slice(s.offset[k], s.offset[k] + TABLES * s.width[k])
        raw = s.count[cells].astype("<i2").tobytes() + s.keys[cells].astype("<u8").tobytes() + s.checks[cells].astype("<u4").tobytes()
        out.append(f"{size}:{s.width[k]}:{base64.b64encode(raw).decode()}")
    return out


def parsed(fingerprints: list[str]) -> tuple[Sketches, list[int]]:
    """The sketches of printed fingerprints and their numbers of digests."""
    fields = [f.split(":") for f in fingerprints]
    out = Sketches(np.array([int(f[1]) for f in fields], dtype=np.int64))
    for k, (_, width, cells) in enumerate(fields):
        n, raw = TABLES * int(width), base64.b64decode(cells)
        at = slice(out.offset[k], out.offset[k] + n)
        out.count[at] = np.frombuffer(raw, "<i2", n)
        out.keys[at] = np.frombuffer(raw, "<u8", n, 2 * n)
        out.checks[at] = np.frombuffer(raw, "<u4", n, 10 * n)
    return out, [int(f[0]) for f in fields]


def compare(a: list[str], b: list[str]) -> list[float | None]:
    """Likeness from printed fingerprints alone; None where they differ by more than their
    sketches hold and larger ones are needed."""
    (one, sizes), (two, others) = parsed(a), parsed(b)
    _, owner, _, done = subtract(one, two).peel()
    d = np.bincount(owner, minlength=len(a))
    return [(1 - int(d[k]) / (m + n) if m + n else 1.0) if done[k] else None for k, (m, n) in enumerate(zip(sizes, others, strict=True))]


FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_paragraphs long"


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the next document's."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edited_digests(text: str, one: Cut, following: str, two: Cut) -> np.ndarray:
    """digests(edited(text, following)) from the cuts of both. Only the sentence where the
    two meet and the last one are cut anew: a gap between sentences that has a character of
    the same side after it, and of the second side one other than white space before it, is
    where it was."""
    half = len(text) // 2
    end = len(text) - half
    if not end:
        return one.keys
    k = int(np.searchsorted(one.starts, end)) - 1  # the sentence that the first side ends in
    keys, first = one.keys[: one.before[k]], text[one.starts[k] : end]
    black = _BLACK.search(following, 0, half)
    j = int(np.searchsorted(two.starts, black.start(), side="right")) if black else len(two.starts)
    if j == len(two.starts) or two.starts[j] >= min(half, len(following)):
        return _distinct(np.concatenate([keys, cut(first + following[:half]).keys]))
    last = int(np.searchsorted(two.starts, min(half, len(following)))) - 1
    middle, rest = cut(first + following[: two.stops[j - 1]]), cut(following[two.starts[last] : half])
    return _distinct(np.concatenate([keys, middle.keys, two.keys[two.before[j] : two.before[last]], rest.keys]))


def compared(ids: list, texts: list[str], following: list[str]) -> list[list]:
    """The columns of FIELDS for documents with their next ones."""
    new = [edited(t, x) for t, x in zip(texts, following, strict=True)]
    cuts = {}  # equal texts, and a text that is also a next one, are cut once
    for t in (*texts, *following):
        if t not in cuts:
            cuts[t] = cut(t)
    own = {t: _distinct(c.keys) for t, c in cuts.items()}
    sets = [[own[t] for t in texts], [edited_digests(t, cuts[t], x, cuts[x]) for t, x in zip(texts, following, strict=True)], [own[t] for t in following]]
    sizes = [[len(x) for x in side] for side in sets]
    own, changed, after = (sketch(side, widths(n)) for side, n in zip(sets, sizes, strict=True))
    return [
        ids, [len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in new], printed(own, sizes[0]), printed(changed, sizes[1]),
        likeness(sets[0], sets[1], (own, changed)), likeness(sets[0], sets[2], (own, after)), sizes[0],
    ]


def _batch(columns: list, extra: dict) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    fields = [f.split() for f in FIELDS.split(", ")]
    arrays = {name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns, strict=True)}
    return pa.RecordBatch.from_pydict(arrays | extra)


def _line(rows: int):
    """Pairs each row of a sorted partition with the next, as they are read. The first and
    the last text of the partition go out as they are (end 1 and 2)."""

    def out(ids, texts, following):
        n = len(ids)
        return _batch(compared(ids, texts, following), {"part": pa.nulls(n, pa.int32()), "end": pa.array([0] * n, pa.int32()), "text": pa.nulls(n, pa.string())})

    def edge(end: int, ident, text: str):
        blank = [[ident], *([None] for _ in FIELDS.split(", ")[1:])]
        return _batch(blank, {"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "end": pa.array([end], pa.int32()), "text": pa.array([text])})

    def run(batches):
        last = None
        for big in batches:
            for k in range(0, big.num_rows, rows):
                b = big.slice(k, rows)
                ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                if last is None:
                    yield edge(1, ids[0], texts[0])
                else:
                    ids, texts = [last[0], *ids], [last[1], *texts]
                last = ids[-1], texts[-1]
                if len(ids) > 1:
                    yield out(ids[:-1], texts[:-1], texts[1:])
        if last is not None:
            yield edge(2, *last)

    return run


def compare_versions(docs: DataFrame, rows: int = 512) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edit replaces the last half of the code points by as many of the next document's.
    Rows are dealt by ranges of (doc_id, text hash) and sorted, and every task pairs its rows
    as it reads them, ``rows`` at a time, so a null or repeated doc_id fills no task, and no
    range is gathered. Of each partition one text is sent on, to the partition before it.
    Ranges aren't merged by their bytes, since a task computes for long on few of them: there
    is one for 1,024 rows, or for as few as 64 where a slot would have less than four, and
    spark.sql.shuffle.partitions at most.
    """
    text = F.coalesce("text", F.lit(""))
    # The row number only says where rows equal in id and text may be cut.
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    by = [F.desc_nulls_last("doc_id"), F.col("_hash"), F.col("_row")]
    spark, n = docs.sparkSession, docs.count()
    slots = spark.sparkContext.defaultParallelism
    ranges = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(n // 1024, min(4 * slots, n // 64), 1))
    line = keyed.repartitionByRange(ranges, *by).sortWithinPartitions(*by).select("doc_id", "text")
    found = materialise(line.mapInArrow(_line(rows), f"{FIELDS}, part int, end int, text string"), "fingerprints")
    names = [f.split()[0] for f in FIELDS.split(", ")]
    ends = found.filter("end > 0").select("part", "end", "doc_id", "text")
    # The numbers of the partitions that hold rows: as many as the shuffle has tasks.
    parts = sorted(r["part"] for r in ends.filter("end = 1").select("part").collect())
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, next int")
    firsts = ends.filter("end = 1").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    lasts = ends.filter("end = 2").join(follows, "part").join(firsts, "next").select("doc_id", "text", "next_text")

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield _batch(compared(*(b.column(k).to_pylist() for k in range(3))), {})

    return found.filter("end = 0").select(*names).unionByName(lasts.mapInArrow(run, FIELDS))

