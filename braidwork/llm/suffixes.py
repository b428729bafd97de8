"""Suffix-array dedup: bytes covered by a repeated ``size``-byte string are removed.

Spark deals the corpus out so that equal windows meet, and prefix-free parsing finds them
in each task. A window is named by a trigger, the place in it where a rolling hash is
least (see grams); windows that start in a row and share a trigger form one stretch. The
stretches of the whole corpus are shuffled by the bytes after their trigger, as hashes.
A trigger that stands once is done. Stretches that stand twice as they are need no more.
What is left, the edges of repeated passages, is sent with its bytes, and there the
suffix arrays of dictionary and parse are combined into corpus order (see parsing), in
which repeated windows are neighbours.

A text that occurs twice or more is wholly repeated; one copy stands for it: a task sends a
text's stretches once, and the stretches of copies in other tasks fall together where they
arrive. A trigger with more than ``run_limit`` edge stretches is judged window by
window in Spark instead of in a task.

Defined results for unusual rows: null text is empty; texts shorter than the window keep
all bytes; a null doc_id passes through; equal rows are two documents, so both lose what
they share; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidwork.llm.common import materialise
from braidwork.llm.grams import BYTE_VALUES, Rolling, anchors, signed
from braidwork.llm.heads import distinct_texts, order_id, text_key, texts_with
from braidwork.llm.parsing import repeated
from braidwork.llm.runs import batch, complete_runs, run_starts, unseen

U = np.uint64
WHOLE, SENT = 1, 2  # bits of a stretch: repeated as it is; its bytes take part in the sort


def _stretches(size: int, reach: int, order: int):
    """Rows (key, whole, t1, place): the trigger's name, the stretch's hash and where the
    stretch is: first window start, number of further windows, trigger's distance."""

    def run(batches):
        new = unseen()
        for b in batches:
            out = {"key": [], "whole": [], "t1": [], "place": []}
            for t1, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                if len(data) < size or not new(t1):
                    continue
                roll = Rolling(BYTE_VALUES[data])
                at, first, last = anchors(roll, len(data), size, reach, order)
                shape = (last - first) << 8 | (at - first)
                out["key"].append(signed(roll.spans(at, size - reach + 1)))
                out["whole"].append(signed(roll.spans(first, last - first + size) ^ shape.astype(U) * U(0x9E3779B97F4A7C15)))
                out["t1"].append(np.full(len(at), t1, dtype=np.int64))
                out["place"].append(first << 16 | shape)
            if out["key"]:
                yield batch(**{n: np.concatenate(v) for n, v in out.items()})

    return run


def _repeats(batches):
    """(t1, place, state) of the stretches whose trigger stands more than once."""
    for crowded, t in complete_runs(batches):
        key, whole, t1, place = (t.column(k).to_numpy() for k in range(4))
        fresh = run_starts(key, whole, t1, place)
        key, whole, t1, place = key[fresh], whole[fresh], t1[fresh], place[fresh]
        starts = np.flatnonzero(run_starts(key))
        sizes = np.diff(np.r_[starts, len(key)])
        head = run_starts(key, whole)
        heads = np.flatnonzero(head)
        counts = np.diff(np.r_[heads, len(key)])
        full = np.repeat(counts > 1, counts)
        edge = np.repeat(np.logical_or.reduceat(~full, starts), sizes)
        state = np.where(full, WHOLE | np.where(head & (edge | crowded), SENT, 0), SENT)
        keep = np.repeat(sizes > 1, sizes) | crowded
        yield batch(t1=t1[keep], place=place[keep], state=state[keep])


def _contexts(size: int, reach: int):
    """Rows (key, t1, place, state, bytes) of the stretches whose bytes are to be sorted."""

    def run(batches):
        for b in batches:
            out = {"key": [], "t1": [], "place": [], "state": [], "bytes": []}
            for t1, text, (place, state) in zip(b.column(0).to_pylist(), b.column(2), _states(b.column(3)), strict=True):
                sent = (state & SENT) > 0
                if not sent.any():
                    continue
                place, raw = place[sent], text.as_py()
                roll = Rolling(BYTE_VALUES[np.frombuffer(raw, dtype=np.uint8)])
                out["key"].append(signed(roll.spans((place >> 16) + (place & 255), size - reach + 1)))
                out["t1"].append(np.full(len(place), t1, dtype=np.int64))
                out["place"].append(place)
                out["state"].append(state[sent])
                out["bytes"] += [raw[p >> 16 : (p >> 16) + (p >> 8 & 255) + size] for p in place.tolist()]
            if out["bytes"]:
                data = pa.array(out.pop("bytes"), pa.binary())
                yield batch(**{n: np.concatenate(v) for n, v in out.items()}, bytes=data)

    return run


def _slices(column: pa.ListArray, *values: np.ndarray):
    """Of each row of a list column: its part of each of the flat ``values``."""
    cut = column.offsets.to_pylist()
    for a, b in pairwise(cut):
        yield tuple(v[a:b] for v in values)


def _states(column: pa.ListArray):
    """Of each row: its distinct places, and all bits that each was given."""
    flat = column.values
    for place, state in _slices(column, flat.field("place").to_numpy(), flat.field("state").to_numpy()):
        if len(place):
            by = np.argsort(place, kind="stable")
            place, state = place[by], state[by]
            starts = np.flatnonzero(run_starts(place))
            place, state = place[starts], np.bitwise_or.reduceat(state, starts)
        yield place, state


FOUND = "kind int, t1 long, place long, mask binary, h1 long, h2 long, start long, edge boolean"


def _sort_contexts(size: int, run_limit: int):
    """Kind 0: the repeated windows of an edge stretch, as bits. Kind 1: the windows of a
    crowded trigger, one by one."""

    def run(batches):
        for crowded, t in complete_runs(batches, min(2048, run_limit), run_limit):
            key, t1, place, state = (t.column(k).to_numpy() for k in range(4))
            fresh = np.flatnonzero(run_starts(key, t1, place))
            t1, place, state = t1[fresh], place[fresh], state[fresh]
            texts = t.column(4).take(pa.array(fresh)).to_pylist()
            data = np.frombuffer(b"".join(texts), dtype=np.uint8)
            length = np.array([len(x) for x in texts], dtype=np.int64)
            starts = np.cumsum(length) - length
            windows = length - size + 1
            row = np.repeat(np.arange(len(texts)), windows)
            within = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
            at = starts[row] + within
            edge = (state & WHOLE) == 0
            if crowded:
                one, two = Rolling(BYTE_VALUES[data]), Rolling(BYTE_VALUES[data ^ np.uint8(0x5A)], 1)
                n = len(row)
                yield batch(
                    kind=np.ones(n, np.int32), t1=t1[row], place=place[row], mask=pa.nulls(n, pa.binary()),
                    h1=signed(one.spans(at, size)), h2=signed(two.spans(at, size)), start=(place[row] >> 16) + within, edge=edge[row],
                )
                continue
            hit = repeated(data, starts, starts + length, at, size)
            some = [k for k in np.unique(row[hit]).tolist() if edge[k]]
            cut = np.r_[0, np.cumsum(windows)]
            masks = [np.packbits(hit[cut[k] : cut[k + 1]], bitorder="little").tobytes() for k in some]
            zero = np.zeros(len(some), dtype=np.int64)
            yield batch(
                kind=zero.astype(np.int32), t1=t1[some], place=place[some], mask=pa.array(masks, pa.binary()),
                h1=zero, h2=zero, start=zero, edge=np.ones(len(some), dtype=bool),
            )

    return run


def _removed(size: int):
    """n_removed, n_spans and the hash of the kept bytes of each text."""

    def run(batches):
        for b in batches:
            rows = [[], [], []]
            marks = b.column(4).values
            lists = _slices(b.column(4), marks.field("place").to_numpy(), marks.field("mask")), _slices(b.column(5), b.column(5).values.to_numpy())
            for text, (place, state), (at, masks), (single,) in zip(b.column(2), _states(b.column(3)), *lists, strict=True):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                whole = place[(state & WHOLE) > 0]
                np.add.at(edge, whole >> 16, 1)
                np.add.at(edge, (whole >> 16) + (whole >> 8 & 255) + size, -1)
                for p, m in zip(at.tolist(), masks, strict=True):
                    bits = np.frombuffer(m.as_buffer(), dtype=np.uint8)
                    starts = (p >> 16) + np.flatnonzero(np.unpackbits(bits, bitorder="little"))
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + size, -1)
                np.add.at(edge, single, 1)
                np.add.at(edge, single + size, -1)
                gone = np.cumsum(edge)[:-1] > 0
                rows[0].append(int(gone.sum()))
                rows[1].append(int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0]))
                rows[2].append(data[~gone].tobytes())
            digest = [hashlib.sha256(x).hexdigest() for x in rows[2]]
            yield batch(
                t1=b.column(0), ord=b.column(1), n_removed=pa.array(rows[0], pa.int64()), n_spans=pa.array(rows[1], pa.int64()),
                kept_sha256=pa.array(digest, pa.string()), kept=pa.array([x.decode(errors="replace") for x in rows[2]], pa.string()),
            )

    return run


def _prepare(docs: DataFrame, size: int, reach: int, order: int, run_limit: int) -> tuple[DataFrame, DataFrame]:
    """Distinct texts, and the kept bytes of those that lose some."""
    t1, t2 = text_key(F.col("text"))
    text = F.coalesce("text", F.lit(""))
    heads = docs.select(order_id().alias("ord"), t1.alias("t1"), t2.alias("t2"))
    groups = materialise(distinct_texts(heads), "texts")
    stretches = docs.select(t1.alias("t1"), text.cast("binary").alias("text")).mapInArrow(
        _stretches(size, reach, order), "key long, whole long, t1 long, place long"
    )
    states = stretches.repartition("key").sortWithinPartitions("key", "whole", "t1", "place").mapInArrow(_repeats, "t1 long, place long, state long")
    places = states.groupBy("t1").agg(F.collect_list(F.struct("place", "state")).alias("places"))  # bounded by the text's length
    texts = materialise(texts_with(docs, groups, places), "candidates")
    contexts = texts.mapInArrow(_contexts(size, reach), "key long, t1 long, place long, state long, bytes binary")
    found = materialise(contexts.repartition("key").sortWithinPartitions("key", "t1", "place").mapInArrow(_sort_contexts(size, run_limit), FOUND), "windows")
    masks = found.filter("kind = 0").groupBy("t1").agg(F.collect_list(F.struct("place", "mask")).alias("masks"))
    single = found.filter("kind = 1")
    spot = F.struct("t1", "start")
    met = single.groupBy("h1", "h2").agg(F.min(spot).alias("a"), F.max(spot).alias("b"), F.bool_or(~F.col("edge")).alias("more")).filter("a <> b or more")
    singles = single.filter("edge").join(met, ["h1", "h2"], "left_semi").groupBy("t1").agg(F.collect_set("start").alias("single"))
    done = (
        texts.join(masks, "t1", "left").join(singles, "t1", "left").select("t1", "ord", "text", "places", "masks", "single")
        .mapInArrow(_removed(size), "t1 long, ord long, n_removed long, n_spans long, kept_sha256 string, kept string")
    )
    return groups, done


def suffix_dedup(docs: DataFrame, size: int = 200, reach: int = 137, order: int = 16, run_limit: int = 4096, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, n_bytes, n_removed, n_spans and kept_sha256 for every row."""
    _check(size, reach, order)
    groups, done = _prepare(docs, size, reach, order, run_limit)
    t1, t2 = text_key(F.col("text"))
    raw = F.coalesce("text", F.lit("")).cast("binary")
    heads = docs.select(*keep, t1.alias("t1"), t2.alias("t2"), F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("whole_sha256"))
    result = groups.join(done.drop("kept"), ["t1", "ord"], "left").select("t1", "t2", "copies", "n_removed", "n_spans", "kept_sha256")
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= size)
    return heads.join(result, ["t1", "t2"]).select(
        *keep,
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )


def _check(size: int, reach: int, order: int) -> None:
    if not (order <= size - reach + 1 and 1 < reach <= 256):
        raise ValueError("a window must hold its trigger's bytes, and at most 256 starts may share a trigger")


def without_repeats(docs: DataFrame, size: int = 200, reach: int = 137, order: int = 16, run_limit: int = 4096) -> DataFrame:
    """``docs`` with the kept bytes as text; rows left with no word go.

    Every occurrence of a repeat is cut, the first one too, as in ``suffix_dedup``: text that
    stands in several documents is taken for boilerplate. Cuts may split a character; its
    torn bytes become the replacement character. Columns of any names pass through.
    """
    _check(size, reach, order)
    groups, done = _prepare(docs, size, reach, order, run_limit)
    t1, t2 = text_key(F.col("text"))
    result = groups.join(done.select("t1", "ord", "kept"), ["t1", "ord"], "left").select("t1", "t2", "copies", "kept")
    # The row is packed, so that its columns can't clash with those of the join.
    packed = docs.select(F.struct("*").alias("row"), t1.alias("t1"), t2.alias("t2"))
    whole = (F.col("copies") > 1) & (F.octet_length(F.coalesce("row.text", F.lit(""))) >= size)
    text = F.when(whole, F.lit("")).otherwise(F.coalesce("kept", "row.text"))
    out = packed.join(result, ["t1", "t2"]).select("row", text.alias("left_over")).filter(F.col("left_over").rlike("[^ \\t-\\r]"))
    return out.select(*[F.col("left_over").alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
