"""Substring dedup by level-wise doubling of repeated word windows.

Windows of ``size`` words are judged through levels of ``seed`` words, twice that, and so on
(13, 26 and 50 for the defaults). At the first level every window is represented by an anchor, a ``seed``-word string that the
window's own words choose (see grams), so equal windows have equal anchors and only one
position in about ten has to be shuffled. Windows whose anchor stands in one text alone
are done. The survivors are extended to twice the length, and again, until no candidates
are left or the full length is judged; at the full length a window counts if the same
words start in a document with a smaller doc_id.

Copies of a whole text are one text with the smallest of their ids: a task sends a text's
anchors once, and the anchors of copies in other tasks fall together where they arrive. An
anchor with more
than ``run_limit`` occurrences is judged window by window in Spark instead of in a task.

Defined results for unusual rows: null or blank text has no words; a null doc_id counts
as the largest; rows that share a doc_id are not smaller than each other, and equal rows
get equal results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidwork.llm.common import count_words, materialise, words_of
from braidwork.llm.grams import Rolling, anchors, signed
from braidwork.llm.heads import distinct_texts, order_id, text_key, texts_with
from braidwork.llm.runs import batch, complete_runs, run_starts, unseen

U = np.uint64


def level_lengths(size: int, seed: int) -> list[int]:
    out = [seed]
    while out[-1] < size:
        out.append(min(size, 2 * out[-1]))
    return out


def word_values(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=U, count=len(words))


def _anchor_rows(size: int, seed: int, order: int):
    """(key, t1, place) of every anchor; a place packs the first window start, the number
    of further windows and the anchor's distance from the first start."""

    def run(batches):
        new = unseen()
        for b in batches:
            keys, texts, places = [], [], []
            for t1, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if not new(t1):
                    continue
                words = text.as_py().split()
                if len(words) < size:
                    continue
                roll = Rolling(word_values(words))
                at, first, last = anchors(roll, len(words), size, size - seed + 1, order)
                keys.append(signed(roll.spans(at, seed)))
                texts.append(np.full(len(at), t1, dtype=np.int64))
                places.append(first << 16 | (last - first) << 8 | (at - first))
            if keys:
                yield batch(key=np.concatenate(keys), t1=np.concatenate(texts), place=np.concatenate(places))

    return run


def _in_two_texts(batches):
    """t1 and place of the anchors whose key stands in more than one text."""
    for crowded, t in complete_runs(batches):
        key, t1, place = (t.column(k).to_numpy() for k in range(3))
        if crowded:
            yield batch(t1=t1, place=place)
            continue
        starts = np.flatnonzero(run_starts(key))
        ends = np.r_[starts[1:], len(key)]
        keep = np.repeat(t1[starts] != t1[ends - 1], ends - starts)
        fresh = keep & run_starts(key, t1, place)
        yield batch(t1=t1[fresh], place=place[fresh])


def _extend(seed: int, length: int):
    """Rows (key, ord, t1, place, mask, hashes): the ``length``-word hash of each window
    that is still a candidate (bit of mask)."""

    def run(batches):
        for b in batches:
            out = {"key": [], "ord": [], "t1": [], "place": [], "mask": [], "hashes": []}
            for t1, order, text, cands in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                values = word_values(text.as_py().split())
                near, far = Rolling(values), Rolling(values, 1)
                place = np.array([c["place"] for c in cands], dtype=np.int64)
                keys = signed(near.spans((place >> 16) + (place & 255), seed))
                for k, (p, c) in enumerate(zip(place.tolist(), cands, strict=True)):
                    first, more, mask = p >> 16, p >> 8 & 255, c["mask"]
                    every = np.arange(more + 1)
                    live = every[(mask >> every) & 1 == 1]
                    out["key"].append(int(keys[k]))
                    out["hashes"].append(far.spans(first + live, length).tobytes())
                    out["mask"].append(mask)
                out["ord"] += [order] * len(place)
                out["t1"] += [t1] * len(place)
                out["place"] += place.tolist()
            yield batch(**{n: pa.array(v, pa.binary() if n == "hashes" else pa.int64()) for n, v in out.items()})

    return run


def _match(last: bool, run_limit: int):
    """Marks of candidate windows, from rows sorted by key. Kind 0: the windows of a place
    that also stand elsewhere, as bits. Kind 1: single windows of crowded keys."""

    def run(batches):
        for crowded, t in complete_runs(batches, run_limit, run_limit):
            key, order, t1, place, mask = (t.column(k).to_numpy() for k in range(5))
            lists = t.column(5).to_pylist()
            hashes = np.frombuffer(b"".join(lists), dtype=np.int64)
            counts = np.array([len(x) // 8 for x in lists], dtype=np.int64)
            row = np.repeat(np.arange(len(lists)), counts)
            bits = (mask[:, None] >> np.arange(63)) & 1
            bit = np.nonzero(bits)[1]
            if crowded:
                yield batch(kind=np.ones(len(row), np.int32), t1=t1[row], place=place[row], mask=bit, key=key[row], hash=hashes, ord=order[row])
                continue
            by = np.lexsort((order[row] if last else t1[row], hashes, key[row]))
            r = row[by]
            starts = np.flatnonzero(run_starts(key[r], hashes[by]))
            sizes = np.diff(np.r_[starts, len(r)])
            if last:
                hit = order[r] > np.repeat(order[r][starts], sizes)
            else:
                hit = np.repeat(t1[r][starts] != t1[r][starts + sizes - 1], sizes)
            found = np.zeros(len(lists), dtype=np.int64)
            np.bitwise_or.at(found, r[hit], np.int64(1) << bit[by][hit])
            some = found != 0
            none = np.zeros(int(some.sum()), dtype=np.int64)
            yield batch(kind=none.astype(np.int32), t1=t1[some], place=place[some], mask=found[some], key=none, hash=none, ord=none)

    return run


def _removed(size: int):
    """n_removed and the hash of the kept words of each text, from its marked windows."""

    def run(batches):
        for b in batches:
            removed, digests = [], []
            for text, marks in zip(b.column(2), b.column(3).to_pylist(), strict=True):
                words = text.as_py().split()
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                for m in marks:
                    starts = (m["place"] >> 16) + np.flatnonzero((m["mask"] >> np.arange(63)) & 1)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + size, -1)
                gone = np.cumsum(edge)[:-1] > 0
                removed.append(int(gone.sum()))
                digests.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])).hexdigest())
            yield batch(t1=b.column(0), ord=b.column(1), n_removed=pa.array(removed, pa.int64()), kept_sha256=pa.array(digests, pa.string()))

    return run


def _packed(marks: DataFrame) -> DataFrame:
    """Places of one text in one row; their number is bounded by the text's length."""
    return marks.groupBy("t1").agg(F.collect_list(F.struct("place", "mask")).alias("places"))


def substring_dedup(docs: DataFrame, size: int = 50, seed: int = 13, order: int = 12, run_limit: int = 32768) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 for every row."""
    if not 1 <= size - seed < 62:
        raise ValueError("the seed must be shorter than the window by less than 62 words")
    order = min(order, seed)
    text, (t1, t2) = F.col("text"), text_key(F.col("text"))
    heads = materialise(
        docs.select(
            "doc_id", order_id().alias("ord"), t1.alias("t1"), t2.alias("t2"), count_words(text).alias("n_words"),
            F.sha2(F.array_join(words_of(text), " ").cast("binary"), 256).alias("whole_sha256"),
        ),
        "heads",
    )
    groups = materialise(distinct_texts(heads), "texts")
    seeds = docs.select(t1.alias("t1"), F.coalesce(text, F.lit("")).cast("binary").alias("text")).mapInArrow(
        _anchor_rows(size, seed, order), "key long, t1 long, place long"
    )
    survivors = seeds.repartition("key").sortWithinPartitions("key", "t1", "place").mapInArrow(_in_two_texts, "t1 long, place long")
    every = F.expr("shiftleft(1L, cast((shiftright(place, 8) & 255) + 1 as int)) - 1")
    marks = survivors.select("t1", "place", every.alias("mask"))
    texts = materialise(texts_with(docs, groups, _packed(marks)), "candidates")
    cands = texts
    for length in level_lengths(size, seed)[1:]:
        last = length == size
        rows = cands.mapInArrow(_extend(seed, length), "key long, ord long, t1 long, place long, mask long, hashes binary")
        found = materialise(
            rows.repartition("key").sortWithinPartitions("key").mapInArrow(
                _match(last, run_limit), "kind int, t1 long, place long, mask long, key long, hash long, ord long"
            ),
            f"level-{length}",
        )
        single = found.filter("kind = 1")
        if last:
            least = single.groupBy("key", "hash").agg(F.min("ord").alias("least"))
            met = single.join(least, ["key", "hash"]).filter("ord > least")
        else:
            least = single.groupBy("key", "hash").agg(F.min("t1").alias("least"), F.max("t1").alias("most"))
            met = single.join(least, ["key", "hash"]).filter("least < most")
        bits = met.groupBy("t1", "place").agg(F.bit_or(F.expr("shiftleft(1L, cast(mask as int))")).alias("mask"))
        marks = found.filter("kind = 0").select("t1", "place", "mask").unionByName(bits)
        cands = texts.drop("places").join(_packed(marks), "t1")
        if not last:
            cands = materialise(cands, f"candidates-{length}")
            if cands.isEmpty():
                break
    done = cands.mapInArrow(_removed(size), "t1 long, ord long, n_removed long, kept_sha256 string")
    result = groups.join(done, ["t1", "ord"], "left").select("t1", "t2", F.col("ord").alias("first"), "n_removed", "kept_sha256")
    later = (F.col("ord") > F.col("first")) & (F.col("n_words") >= size)  # a copy of a smaller document
    return heads.join(result, ["t1", "t2"]).select(
        "doc_id",
        "n_words",
        F.when(later, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(later, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )
