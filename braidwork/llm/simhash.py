"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, a Hamming check.

A fingerprint is cut into ``blocks`` parts. Two fingerprints at most ``distance`` bits
apart agree on at least ``blocks - distance`` whole parts, so every choice of that many
parts is a join key, and each close pair shares one. Equal fingerprints are one class
before the join, so copies never meet each other.

Within a key the classes are compared in bounded runs and a run yields a star for each
connected part, never all pairs. A key with more than ``run_limit`` classes is linked
another exact way: every fingerprint is sent to all values one bit away and all values
two bits away. Two fingerprints three or fewer bits apart meet at such a value, one of
them as a one-bit neighbour (or the value itself), and whatever meets at a value links to
its smallest one-bit neighbour. That work is linear in the number of fingerprints.

Defined results for unusual rows: null or blank text has fingerprint zero and links like
any other; a null doc_id gets its group's component and is never the smallest unless all
are null; repeated rows give one row each; an empty table gives an empty result; other
columns are ignored. Texts are read whole. Components settle in a number of rounds that
grows with the logarithm of the largest; after 60 rounds an error is raised.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.llm.common import materialise
from braidwork.llm.components import connected_components


def simhash64(text: bytes | None) -> int:
    """Majority bits of the XXH64 (seed 42) of the 3-word shingles, as a signed long."""
    words = (text or b"").lower().split()  # on bytes both treat ASCII only
    if not words:
        return 0
    if len(words) < 3:
        shingles = [b" ".join(words)]
    else:
        shingles = [b"%b %b %b" % x for x in zip(words, words[1:], words[2:], strict=False)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 65536):
        part = hashes[k : k + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the fingerprint ``fp`` of each row."""
    source = docs.select(*keep, F.col("text").cast("binary").alias("_text"))

    def run(batches):
        for b in batches:
            fp = pa.array([simhash64(t.as_py()) for t in b.column(len(keep))], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], fp], names=[*keep, "fp"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(keep)])
    return source.mapInArrow(run, f"{schema}, fp long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """A 64-bit mask (as signed long) for every choice of blocks - distance parts."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(parts, blocks - distance)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _stars(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each value to the smallest of its connected part of the run."""
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= distance
    label = np.arange(len(values))
    while True:
        lower = np.where(near, label[None, :], len(values)).min(axis=1)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    moved = label != np.arange(len(values))
    return values[moved], values[label[moved]]


def _run_links(distance: int, run_limit: int):
    """mapInArrow function over rows (key, fp) sorted by key and fp: kind 0 rows are
    links; kind 1 rows are the members of runs over the limit, passed on as they come."""

    def out(kind: int, a: np.ndarray, b: np.ndarray):
        k = np.full(len(a), kind, dtype=np.int32)
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["kind", "a", "b"])

    def run(batches):
        held_key, held, over = None, np.empty(0, np.uint64), False
        for batch in batches:
            key = batch.column(0).to_numpy()
            fp = batch.column(1).to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.r_[0, cuts], np.r_[cuts, len(key)]
            # The first run may go on with the one that is held.
            for first in (0,) if len(key) else ():
                piece = fp[starts[first] : ends[first]]
                if held_key is not None and key[0] == held_key:
                    held = np.r_[held, piece]
                else:
                    if len(held) > 1 and not over:
                        yield out(0, *_stars(held, distance))
                    held_key, held, over = key[0], piece, False
                if over or len(held) > run_limit:
                    over = True
                    yield out(1, held, held)
                    held = held[:0]
            if len(starts) < 2:
                continue
            if len(held) > 1 and not over:
                yield out(0, *_stars(held, distance))
            sizes = ends - starts
            middle = np.arange(1, len(starts) - 1)
            two = middle[sizes[middle] == 2]
            x, y = fp[starts[two]], fp[starts[two] + 1]
            close = np.bitwise_count(x ^ y) <= distance
            yield out(0, y[close], x[close])
            for k in middle[sizes[middle] > 2]:
                piece = fp[starts[k] : ends[k]]
                yield out(0, *_stars(piece, distance)) if len(piece) <= run_limit else out(1, piece, piece)
            held_key, held, over = key[-1], fp[starts[-1] : ends[-1]], False
            if len(held) > run_limit:
                over = True
                yield out(1, held, held)
                held = held[:0]
        if len(held) > 1 and not over:
            yield out(0, *_stars(held, distance))

    return run


def _neighbour_links(crowded: DataFrame, distance: int) -> DataFrame:
    """Exact links among the fingerprints ``a`` of crowded keys by shared neighbours."""
    if distance != 3:
        raise ValueError("the neighbour way is for a distance of 3")
    signed = lambda m: m - (1 << 64) if m >= 1 << 63 else m
    ones = [0, *(1 << k for k in range(64))]
    twos = [(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]
    masks = F.array(*[F.lit(signed(m)) for m in (*ones, *twos)])  # 2081 values, fixed
    spread = crowded.select("a").distinct().select("a", F.posexplode(masks).alias("n", "mask"))
    spread = spread.select("a", (F.col("n") < len(ones)).alias("one"), F.col("a").bitwiseXOR(F.col("mask")).alias("value"))
    hubs = spread.filter("one").groupBy("value").agg(F.min("a").alias("b"))
    met = spread.join(hubs, "value").filter("a <> b")
    return met.select("a", "b").distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)


def near_links(classes: DataFrame, distance: int = 3, blocks: int = 6, run_limit: int = 1024) -> DataFrame:
    """(a, b) fingerprint links that connect exactly what links within ``distance``."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(block_masks(blocks, distance))])
    keyed = classes.select(F.explode(keys).alias("key"), "fp")
    runs = keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_run_links(distance, run_limit), "kind int, a long, b long")
    found = materialise(runs, "simhash-runs")
    links = found.filter("kind = 0").select("a", "b").distinct()
    crowded = found.filter("kind = 1")
    return links if crowded.isEmpty() else links.unionByName(_neighbour_links(crowded, distance)).distinct()


def near_duplicates(docs: DataFrame, distance: int = 3, blocks: int = 6, run_limit: int = 1024, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, fingerprint (16 hex digits) and component_id for every row."""
    if "doc_id" not in keep:
        raise ValueError("keep must name doc_id")
    printed = materialise(fingerprints(docs, keep), "simhash-prints")
    classes = printed.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = connected_components(near_links(classes, distance, blocks, run_limit))
    joined = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
    members = joined.join(smallest, "root").select("fp", "component_id")
    return printed.join(members, "fp").select(*keep, _hex(F.col("fp")).alias("fingerprint"), "component_id")


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs``, one for each near-duplicate group: the smallest doc_id, and
    among rows that share it the smallest text hash. Columns of any names pass through."""
    # The row is packed, so that its columns can't clash with those of the joins.
    marked = docs.select(F.struct("*").alias("_row"), "doc_id", "text", F.xxhash64("text").alias("_hash"))
    groups = near_duplicates(marked, keep=("doc_id", "_hash"), **params)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("_id"), F.col("_hash").alias("_h")))
    # Groups without any doc_id have no component id of their own; they stay as they are.
    chosen = groups.groupBy(F.coalesce(F.col("component_id").cast("string"), F.col("fingerprint"))).agg(first.alias("f")).select("f._id", "f._h")
    kept = marked.join(chosen, marked["doc_id"].eqNullSafe(chosen["_id"]) & (marked["_hash"] == chosen["_h"]))
    return kept.dropDuplicates(["_id", "_h"]).select("_row.*")
