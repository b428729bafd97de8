"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed letter n-grams (one to three bytes of lower-case letters and
single breaks), weighted by TF-IDF and scaled to length one. Each language has several
centroids, found by spherical k-means, and a text takes the language of the centroid with
the highest cosine. A text farther from that centroid than nearly all of the training
texts of the centroid is marked as rejected; it keeps its nearest language.

Document frequencies are counted over all training rows. The centroids are fitted on a
bounded sample: at most ``per_language`` rows of each language, drawn by a hash of the id.

Defined results for unusual rows: a text that is null or has no letter is ``und`` with
score 0; a null doc_id or lang is never trained on, and a row with a null id isn't held
out; repeated rows are scored alike; an empty table, or one without labels, gives ``und``;
other columns are ignored. Of centroids with one cosine the first by language and number is
taken. The centroids are one set a language, gathered on the driver: their number grows with
the distinct values of ``lang``, not with the rows. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIMS = 4096
_LETTER = regex.compile(r"\p{L}")
# Bytes of letters stay; every other byte is a break.
_KEEP = np.array([c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], dtype=np.uint32)


def gram_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a text."""
    b = _KEEP[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), dtype=np.uint8)]
    solid = b != 32
    solid[1:] |= solid[:-1].copy()  # of several breaks in a row the first stays
    b = b[solid | (np.arange(len(b)) == 0)]
    two = b[:-1] << np.uint32(8) | b[1:]
    three = two[:-1] << np.uint32(8) | b[2:]
    codes = np.concatenate([b, two + np.uint32(1 << 25), three + np.uint32(1 << 26)])
    return np.bincount((codes * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMS).astype(np.float32)


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    m = np.stack([gram_counts(t) for t in texts]) if texts else np.zeros((0, DIMS), np.float32)
    m = m * idf
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm > 0, norm, 1)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Unit centroids; the start is the mean and then the farthest rows in turn."""
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=-1, keepdims=True), 1e-12)
    c = unit(x.mean(axis=0))[None, :]
    while len(c) < min(k, len(x)):
        c = np.vstack([c, x[np.argmin((x @ c.T).max(axis=1))]])
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        c = np.stack([unit(x[near == j].mean(axis=0)) if (near == j).any() else c[j] for j in range(len(c))])
    return c


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter("lang is not null and text is not null and doc_id is not null").filter(~held_out()).select("doc_id", "text", "lang")


def inverse_frequencies(train: DataFrame) -> np.ndarray:
    """IDF over all training rows; each task sends one fixed-size row."""

    def run(batches):
        total, n = np.zeros(DIMS, dtype=np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                total += gram_counts(t) > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64())), pa.array([n], pa.int64())], names=["df", "n"])

    parts = train.select("text").mapInArrow(run, "df array<long>, n long")
    sums = parts.select("n", F.posexplode("df").alias("dim", "df")).groupBy("dim").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).collect()
    df, n = np.zeros(DIMS), 0
    for r in sums:
        df[r["dim"]], n = r["df"], r["n"]
    return (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)


def bounded_sample(rows: DataFrame, by: str, bound: int) -> DataFrame:
    """About ``bound`` rows, and never more, of each value of ``by``, by a hash of the id.

    One count a value is gathered; a hash threshold thins the rows in the scan itself.
    """
    counts = {r[by]: r["count"] for r in rows.groupBy(by).count().collect()}
    if not counts:
        return rows
    part = F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, min(1_000_000, 1_000_000 * bound // n))])
    order = F.xxhash64("doc_id", F.lit(5))
    thin = rows.filter(F.pmod(order, F.lit(1_000_000)) <= F.element_at(part, F.col(by)))
    first = Window.partitionBy(by).orderBy(order)
    return thin.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= bound).drop("_n")


def fit(docs: DataFrame, per_language: int = 400, per_centroids: int = 4) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Languages and radii of the centroids, the centroids and the IDF weights."""
    train = training_rows(docs)
    idf = inverse_frequencies(train)

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "text"])
        x = vectors([t for t in group["text"] if has_letter(t)], idf)
        if not len(x):
            return pd.DataFrame({"lang": [], "k": [], "radius": [], "centroid": []})
        c = spherical_kmeans(x, per_centroids)
        near = (x @ c.T).argmax(axis=1)
        radius = [float(np.quantile((x @ c[j])[near == j], 0.001)) if (near == j).any() else 0.0 for j in range(len(c))]
        return pd.DataFrame({"lang": group["lang"].iloc[0], "k": range(len(c)), "radius": radius, "centroid": [v.tolist() for v in c]})

    sample = bounded_sample(train, "lang", per_language)
    rows = sample.groupBy("lang").applyInPandas(cluster, "lang string, k int, radius double, centroid array<float>").collect()
    rows.sort(key=lambda r: (r["lang"], r["k"]))
    centroids = np.array([r["centroid"] for r in rows], dtype=np.float32).reshape(len(rows), DIMS)
    return [r["lang"] for r in rows], np.array([r["radius"] for r in rows]), centroids, idf


def predict(docs: DataFrame, model) -> DataFrame:
    langs, radius, centroids, idf = model

    def run(batches):
        for b in batches:
            texts = b.column(2).to_pylist()
            lang, score, reject = ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
            todo = [k for k, t in enumerate(texts) if langs and has_letter(t)]
            for a in range(0, len(todo), 256):
                part = todo[a : a + 256]
                cosine = vectors([texts[k] for k in part], idf) @ centroids.T
                best = cosine.argmax(axis=1)
                for k, j, c in zip(part, best.tolist(), cosine, strict=True):
                    value = min(1.0, max(0.0, float(c[j])))
                    lang[k], score[k], reject[k] = langs[j], value, bool(value < radius[j])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(reject, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )


def identify_languages(docs: DataFrame, per_language: int = 400, per_centroids: int = 4) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for every row."""
    return predict(docs, fit(docs, per_language, per_centroids))
