"""Ranked lexical search: the best documents for each item of a query set.

A document's score for an item is the sum, over the item's distinct terms, of the term's
weight times the term's impact in the document, both integers. The sums are products of
dense float64 matrices, made in blocks: a tile of items' weights over a compact vocabulary
(the terms of these items alone) times a tile of documents' impacts. A vocabulary tile is
so narrow that a partial sum stays below 2**53, where float64 is exact; partial sums of
several tiles are added as 64-bit integers. Each task keeps the best documents of every
item over its tiles, with equal scores settled by the smaller doc_id, and the few that are
left of each task meet in one ranking.

The query set is taken in blocks of bounded size (``block_items`` and ``block_terms``; an
item with more terms is a block of its own). A block's vocabulary and weights are what the
tasks are sent. For each block the documents are read once, and the counts of the block's
terms are written to the shared folder; document frequencies are counted over all of them.

Defined results for unusual rows: a null text has no term, and a document without a term
counts in neither N nor L; a null doc_id ranks after every other of its score and is
returned as null; rows that repeat a doc_id are documents of their own, so it can stand twice in a
ranking; each row of the query set is an item of its own, and one without terms, or without
a document that holds one, has no rows; empty tables give no rows; other columns are
ignored. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from braidwork.llm.common import materialise

# Bytes outside terms become spaces and A to Z small letters. Every byte of a character
# beyond ASCII belongs to a term, so a text can be cut as UTF-8.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

IMPACT_BOUND = 10**6  # an impact is below this
EXACT = 2**53
COUNTS = "doc_id long, n long, ids array<int>, tfs array<long>"
FOUND = "item int, item_id long, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text with repeats."""
    return text.translate(_TERM_BYTES).split()


class Block:
    """Items with their compact vocabulary."""

    def __init__(self):
        self.item_ids: list[int | None] = []
        self.items: list[list[int]] = []
        self.vocabulary: dict[bytes, int] = {}

    def add(self, item_id: int | None, terms: set[bytes]) -> None:
        self.item_ids.append(item_id)
        self.items.append([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in sorted(terms)])

    def weights(self, df: np.ndarray, n_docs: int) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)

    def tiles(self, weights: np.ndarray, width: int) -> list[np.ndarray]:
        """Items by vocabulary, dense, cut by vocabulary."""
        width = min(width, max(1, (EXACT - 1) // (IMPACT_BOUND * max(1, int(weights.max(initial=0))))))
        out = [np.zeros((len(self.items), min(width, len(weights) - a))) for a in range(0, len(weights), width)]
        for k, ids in enumerate(self.items):
            for i in ids:
                out[i // width][k, i % width] = weights[i]
        return out


def blocks_of(items: DataFrame, block_items: int, block_terms: int) -> Iterator[Block]:
    """The query set as blocks; one block at a time is held."""
    rows = items.select(F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    block = Block()
    for item_id, text in rows.toLocalIterator():
        terms = set(terms_of(bytes(text)))
        if not terms:
            continue
        if block.items and (len(block.items) >= block_items or len(block.vocabulary) + len(terms) > block_terms):
            yield block
            block = Block()
        block.add(item_id, terms)
    if block.items:
        yield block


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms, and the places in the vocabulary of the document's terms
    with their counts."""

    def run(batches):
        for b in batches:
            n, sizes, ids, tfs = [], [0], [], []
            for text in b.column(1):
                terms = terms_of(text.as_py() or b"")
                n.append(len(terms))
                for t, tf in Counter(terms).items():
                    if (at := vocabulary.get(t)) is not None:
                        ids.append(at)
                        tfs.append(tf)
                sizes.append(len(ids))
            lists = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(x, kind)) for x, kind in ((ids, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "ids", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, COUNTS)


class Best:
    """The best ``k`` documents of each item among those seen."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in range(items)]
        self.least = np.ones(items, dtype=np.int64)  # a document below it can't enter

    def take(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """scores: items by documents."""
        enters = scores >= self.least[:, None]
        for q in np.flatnonzero(enters.any(axis=1)):
            new = enters[q]
            s, i, z = (np.concatenate(x) for x in zip(self.found[q], (scores[q, new], ids[new], null[new]), strict=True))
            first = np.lexsort((i, z, -s))[: self.k]
            self.found[q] = s[first], i[first], z[first]
            if len(first) == self.k:
                self.least[q] = self.found[q][0][-1]

    def rows(self, item_ids: list[int | None]) -> pa.RecordBatch:
        sizes = [len(s) for s, _, _ in self.found]
        item = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        s, i, z = (np.concatenate(x) if x else np.empty(0, np.int64) for x in zip(*self.found, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array([item_ids[k] for k in item], pa.int64()), pa.array(i, pa.int64(), mask=z.astype(bool)), pa.array(s, pa.int64())],
            names=["item", "item_id", "doc_id", "score"],
        )


def _scores(tiles: list[np.ndarray], doc: np.ndarray, ids: np.ndarray, impacts: np.ndarray, n: int) -> np.ndarray:
    """Items by documents, as integers: ``n`` documents whose cells are (doc, id, impact)."""
    out = np.zeros((len(tiles[0]), n), dtype=np.int64)
    low = 0
    for w in tiles:
        own = (ids >= low) & (ids < low + w.shape[1])
        if own.any():
            dense = np.zeros((w.shape[1], n))
            dense[ids[own] - low, doc[own]] = impacts[own]
            out += (w @ dense).astype(np.int64)
        low += w.shape[1]
    return out


def best_documents(counts: DataFrame, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, k: int, tile_docs: int, tile_terms: int) -> DataFrame:
    """The best ``k`` documents of each item among those of one task."""

    def run(batches):
        tiles, best = block.tiles(weights, tile_terms), Best(len(block.items), k)
        for whole in batches:
            for at in range(0, whole.num_rows, tile_docs):
                b = whole.slice(at, tile_docs)
                m = np.array([10 + 90 * n * n_docs // n_terms for n in b.column(1).to_pylist()], dtype=np.int64)
                sizes = np.diff(b.column(2).offsets.to_numpy())
                ids, tf = (b.column(c).flatten().to_numpy(zero_copy_only=False) for c in (2, 3))
                doc = np.repeat(np.arange(b.num_rows), sizes)
                impacts = 10**9 * tf // (1000 * tf + 8 * m[doc])
                names = b.column(0)
                best.take(_scores(tiles, doc, ids, impacts, b.num_rows), names.fill_null(0).to_numpy(zero_copy_only=False), names.is_null().to_numpy(zero_copy_only=False))
        yield best.rows(block.item_ids)

    return counts.mapInArrow(run, FOUND)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_items: int = 256, block_terms: int = 32_768, tile_docs: int = 512, tile_terms: int = 2048) -> DataFrame:
    """item_id, rank, doc_id and score of the best ``k`` documents of each item."""
    parts = []
    for number, block in enumerate(blocks_of(items, block_items, block_terms)):
        counts = materialise(term_counts(docs, block.vocabulary), "term-counts")
        total = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not total[1]:
            continue
        df = np.zeros(len(block.vocabulary), dtype=np.int64)
        # One row a term of the block.
        for r in counts.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("df")).collect():
            df[r["id"]] = r["df"]
        found = best_documents(counts.filter(F.size("ids") > 0), block, block.weights(df, total[0]), total[0], total[1], k, tile_docs, tile_terms)
        parts.append(found.select(F.lit(number).alias("block"), "*"))
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    by = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(by))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
