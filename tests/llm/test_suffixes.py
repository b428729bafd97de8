import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from braidwork.llm import suffixes
from braidwork.llm.parsing import corpus_order, repeated
from braidwork.llm.queries import op6_suffixes
from braidwork.llm.suffixes import suffix_dedup, without_repeats


def brute_spans(texts, size):
    count = Counter()
    for t in texts:
        count.update(t[k : k + size] for k in range(len(t) - size + 1))
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=int)
        for k in range(len(t) - size + 1):
            if count[t[k : k + size]] > 1:
                gone[k] += 1
                gone[k + size :][:1] -= 1
        yield np.cumsum(gone)[:-1] > 0


def brute(rows, size):
    texts = [(t or "").encode() for _, t in rows]
    out = Counter()
    for (i, _), t, gone in zip(rows, texts, brute_spans(texts, size), strict=True):
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def strings(seed, n, alphabet="ab"):
    rng = random.Random(seed)
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(5)]
    return ["".join(rng.choice(shared) if rng.random() < 0.6 else rng.choice(alphabet) for _ in range(rng.randrange(12))) + "b" for _ in range(n)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh", "a"])
def test_corpus_order_is_the_suffix_order(alphabet):
    texts = [t.encode() for t in strings(1, 30, alphabet)]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    places = np.arange(len(data))
    owner = np.searchsorted(starts, places, side="right") - 1
    order, _ = corpus_order(data, starts, ends, places, trigger=3, spacing=4)
    suffixes_in_order = [data[k : ends[owner[k]]].tobytes() for k in order]
    assert suffixes_in_order == sorted(suffixes_in_order)
    size = 9
    fits = places[places + size <= ends[owner]]
    windows = [data[k : k + size].tobytes() for k in fits]
    counts = Counter(windows)
    assert repeated(data, starts, ends, fits, size, trigger=3, spacing=4).tolist() == [counts[w] > 1 for w in windows]


@pytest.mark.parametrize(("size", "reach"), [(12, 7), (20, 13)])
@pytest.mark.parametrize("crowd", [False, True])
def test_small_windows(spark, make_docs, monkeypatch, size, reach, crowd):
    if crowd:
        whole = suffixes.complete_runs
        monkeypatch.setattr(suffixes, "complete_runs", lambda b, *a: whole(b, 4, 4))
    texts = strings(2, 50, "abcdé")
    rows = [(k, t) for k, t in enumerate(texts)] + [(90 + k, t) for k, t in enumerate(texts[:6])]
    rows += [(None, "ab" * 30), (7, None), (8, ""), (9, "z" * 400), (9, "z" * 400), (9, "short"), (9, "short"), (10, "qwertzuiopasdfghjkl" * 2)]
    got = Counter(map(tuple, suffix_dedup(make_docs(rows), size=size, reach=reach, order=3).collect()))
    assert got == brute(rows, size)


def test_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, op6_suffixes(spark, sf_dir).collect())) == brute(rows, 200)


def test_texts_without_repeats(make_docs):
    rows = [(1, "one two three four five six X"), (2, "Y one two three four five six"), (3, "alone"), (4, None), (5, "same text twice"), (6, "same text twice")]
    got = without_repeats(make_docs(rows), size=12, reach=7, order=3)
    assert got.columns == make_docs(rows).columns
    assert sorted((r.doc_id, r.text.strip()) for r in got.collect()) == [(1, "X"), (2, "Y"), (3, "alone")]
    assert suffix_dedup(make_docs([])).count() == 0
