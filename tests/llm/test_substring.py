import hashlib
import random
from collections import Counter

import pytest

from braidwork.llm import substring
from braidwork.llm.queries import op5_substring
from braidwork.llm.substring import level_lengths, substring_dedup


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(rows, size):
    big = 1 << 63
    least = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            least[g] = min(least.get(g, big), big if i is None else i)
    out = Counter()
    for i, t in rows:
        w = words_of(t)
        gone = set()
        for k in range(len(w) - size + 1):
            if least[tuple(w[k : k + size])] < (big if i is None else i):
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def passages(seed, n=60):
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(5, 30))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(20))) for _ in range(5)]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(parts)))
    return [*rows, *[(100 + i, t) for i, t in rows[:8]]]


def test_levels():
    assert level_lengths(50, 25) == [25, 50] and level_lengths(8, 2) == [2, 4, 8] and level_lengths(7, 2) == [2, 4, 7]


@pytest.mark.parametrize(("size", "seed"), [(8, 2), (10, 5)])
@pytest.mark.parametrize("crowd", [False, True])
def test_small_windows(spark, make_docs, monkeypatch, size, seed, crowd):
    if crowd:
        whole = substring.complete_runs
        monkeypatch.setattr(substring, "complete_runs", lambda b, *a: whole(b, 4, 4))
    rows = [*passages(size), (None, "a b c d e f g h a b c d e f g h"), (5, None), (6, ""), (7, "z " * 3000), (7, "z " * 2000), (300, "z " * 100)]
    got = Counter(map(tuple, substring_dedup(make_docs(rows), size=size, seed=seed, order=2).collect()))
    assert got == brute(rows, size)


def test_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, op5_substring(spark, sf_dir).collect())) == brute(rows, 50)


def test_empty(make_docs):
    assert substring_dedup(make_docs([])).count() == 0
