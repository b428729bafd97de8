import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from braidwork.llm.language import gram_counts, identify_languages, spherical_kmeans
from braidwork.llm.queries import op10_language

WORDS = {"xx": "lora mipo tarel senu vika".split(), "yy": "qwest brunz kjolt stromp grift".split()}


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = op10_language(spark, sf_dir).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)


def test_unusual_rows(spark):
    rng = random.Random(1)
    rows = []
    for k in range(200):
        lang = rng.choice(list(WORDS))
        rows.append((k, " ".join(rng.choice(WORDS[lang]) for _ in range(30)), lang, "s"))
    rows += [(900, None, "xx", "s"), (901, "", None, "s"), (902, "123 !!", "yy", "s"), (None, "lora mipo", None, "s"), (903, "Qwest Brunz " * 20_000, None, "s"), (903, "Qwest Brunz", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumnRenamed("source", "score")
    got = identify_languages(docs, per_language=50).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert all(by[k][0].lang_pred == "und" and by[k][0].score == 0 for k in (900, 901, 902))
    assert [r.lang_pred for r in by[903]] == ["yy", "yy"] and by[None][0].lang_pred == "xx" and not by[None][0].held_out
    assert all(by[k][0].lang_pred == rows[k][2] for k in range(200)) and all(0 <= r.score <= 1 for r in got)
    empty = identify_languages(docs.limit(0))
    assert empty.count() == 0
    nothing = identify_languages(docs.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def slow_grams(text):
    """Counts of the cells of all runs of one to three bytes, breaks in a row taken as one."""
    run = [32]
    for c in text.lower().encode("utf-8", "replace") + b" ":
        c = c if 97 <= c <= 122 or c >= 128 else 32
        if c != 32 or run[-1] != 32:
            run.append(c)
    cells = Counter()
    for n, mark in ((1, 0), (2, 1 << 25), (3, 1 << 26)):
        for k in range(len(run) - n + 1):
            code = mark + int.from_bytes(bytes(run[k : k + n]), "big")
            cells[(code * 2654435761 % 2**32) >> 20] += 1
    return cells


def cosine(a, b):
    return sum(v * b.get(k, 0.0) for k, v in a.items())


def unit(v):
    n = math.sqrt(math.fsum(x * x for x in v.values()))
    return {k: x / n for k, x in v.items()} if n else {}


def mean(vs):
    out = Counter()
    for v in vs:
        for k, x in v.items():
            out[k] += x
    return unit(out)


def slow_predictions(rows, n_centroids):
    """(language, cosine, lead over the best other language) by dictionaries alone; rows are (doc_id, text, lang)."""
    train = [r for r in rows if r[1] is not None and r[2] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5]
    df = Counter(c for r in train for c in slow_grams(r[1]))
    vector = lambda t: unit({c: n * (math.log((1 + len(train)) / (1 + df[c])) + 1) for c, n in slow_grams(t).items()})
    centroids = []
    for lang in sorted({r[2] for r in train}):
        x = [vector(t) for _, t, _ in sorted(r for r in train if r[2] == lang) if any(c.isalpha() for c in t)]
        c = [mean(x)]
        while len(c) < min(n_centroids, len(x)):
            c.append(min(x, key=lambda v: max(cosine(v, m) for m in c)))
        for _ in range(10):
            near = [max(range(len(c)), key=lambda j: (cosine(v, c[j]), -j)) for v in x]
            c = [mean([v for v, n in zip(x, near, strict=True) if n == j]) if j in near else c[j] for j in range(len(c))]
        centroids += [(lang, m) for m in c]
    out = []
    for _, text, _ in rows:
        if text is None or not any(c.isalpha() for c in text):
            out.append(("und", 0.0, 1.0))
            continue
        v = vector(text)
        best: dict = {}
        for lang, m in centroids:
            best[lang] = max(best.get(lang, -1.0), cosine(v, m))
        order = sorted(best, key=lambda s: (-best[s], s))
        out.append((order[0], best[order[0]], best[order[0]] - max((best[s] for s in order[1:]), default=-1.0)))
    return out


@pytest.mark.parametrize("n_centroids", [1, 3])
def test_against_a_slow_version(spark, sf_dir, n_centroids):
    """Learning and prediction over the table's first texts and odd ones, without a bound on the sample."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(120)
    rows = [(r.doc_id, r.text, r.lang) for r in table.collect()]
    rows += [(5001, None, "en"), (5002, "12 - 3", None), (None, "The end of it", "en"), (5003, "ΑΒΓ Ünder über", None), (5004, "", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
    got = {(r.doc_id): r for r in identify_languages(docs, per_language=10**6, per_centroids=n_centroids).collect()}
    expected = slow_predictions(rows, n_centroids)
    assert len(got) == len(rows)
    for (ident, _, _), (lang, score, lead) in zip(rows, expected, strict=True):
        assert abs(got[ident].score - max(0.0, score)) < 1e-3, ident
        assert got[ident].lang_pred == lang or lead < 1e-4, ident
        assert got[ident].held_out == (ident is not None and zlib.crc32(str(ident).encode()) % 5 == 0)


def test_vectors():
    assert gram_counts("A,,b!").tolist() == gram_counts("a b").tolist()
    assert gram_counts("ab").sum() == 4 + 3 + 2 and gram_counts("a b").sum() == 5 + 4 + 3
    x = np.array([[1, 0.01], [1, 0], [0, 1], [0.01, 1]], dtype=np.float32)
    c = spherical_kmeans(x / np.linalg.norm(x, axis=1, keepdims=True), 2)
    assert sorted(np.round(c).astype(int).tolist()) == [[0, 1], [1, 0]]
