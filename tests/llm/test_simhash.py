import random
from collections import Counter

import numpy as np
import xxhash

from braidwork.llm.queries import op7_simhash
from braidwork.llm.simhash import near_duplicates, near_links, one_of_each, simhash64


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """Smallest id reachable over links of at most three bits; prints: (id, value)."""
    parent = list(range(len(prints)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                parent[top(i)] = top(j)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [(i, least.get(top(k))) for k, (i, _) in enumerate(prints)]


def test_fingerprint():
    for t in ["", None, " \n", "One", "a b", "A b C d E f g", "é ß É x y z é ß", "x " * 5000]:
        assert simhash64(t and t.encode()) % (1 << 64) == brute_print(t), t


def test_query_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in docs]
    expected = Counter((i, f"{p:016x}", c) for (i, p), (_, c) in zip(prints, brute_components(prints), strict=True))
    assert Counter(map(tuple, op7_simhash(spark, sf_dir).collect())) == expected


def links_of(spark, values, **params):
    rows = [(int(np.uint64(v).view(np.int64)),) for v in set(values)]
    return [(int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64))) for a, b in near_links(spark.createDataFrame(rows, "fp long"), **params).collect()]


def test_crowded_keys_give_the_same_components(spark):
    rng = random.Random(3)
    values = []
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            v = centre
            for _ in range(rng.randrange(6)):
                v ^= 1 << rng.randrange(64)
            values.append(v)
    values += [rng.getrandbits(64) for _ in range(50)]
    values = sorted(set(values))
    expected = dict(brute_components([(v, v) for v in values]))
    for limit in (1024, 3):
        links = links_of(spark, values, run_limit=limit)
        assert all((a ^ b).bit_count() <= 64 for a, b in links)
        parent = {v: v for v in values}

        def top(v, parent=parent):
            while parent[v] != v:
                v = parent[v]
            return v

        for a, b in links:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
        assert {v: top(v) for v in values} == expected


def test_unusual_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (None, "q w e r t y"), (9, "z" * 300_000)]
    got = Counter((r.doc_id, r.component_id) for r in near_duplicates(make_docs(rows)).collect())
    assert got == Counter({(1, 1): 1, (2, 1): 1, (3, 1): 1, (4, 4): 2, (None, 4): 1, (None, None): 1, (9, 9): 1})
    kept = one_of_each(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted((r.doc_id or 0, r.text and r.text[:3]) for r in kept.collect()) == sorted([(1, None), (4, "a b"), (0, "q w"), (9, "zzz")], key=lambda x: x[0])
    assert near_duplicates(make_docs([])).count() == 0
