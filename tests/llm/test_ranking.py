import math
import random
from collections import Counter

import duckdb
import numpy as np

from braidwork.llm.oracle import SQL
from braidwork.llm.queries import op11_ranking
from braidwork.llm.ranking import EXACT, IMPACT_BOUND, Best, Block, rank_documents, terms_of


def slow_terms(text):
    """Maximal runs of ASCII letters, digits and everything beyond ASCII, character by character."""
    out, word = [], ""
    for c in (text or "") + " ":
        if "A" <= c <= "Z":
            c = c.lower()
        if "0" <= c <= "9" or "a" <= c <= "z" or c >= "\x80":
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def slow_ranking(docs, items, k=10):
    words = [(i, Counter(slow_terms(t))) for i, t in docs]
    words = [(i, c, sum(c.values())) for i, c in words if c]
    n_docs, total = len(words), sum(n for *_, n in words)
    df = Counter(t for _, c, _ in words for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in words:
            m = 100 - 90 + 90 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(slow_terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_terms():
    for text in ("", "Ab-cD é_É x\x00y Z9!", "ÀÉ日本 語", "a" * 9):
        assert [t.decode() for t in terms_of(text.encode())] == slow_terms(text)


def test_against_slow_version(make_docs, spark):
    r = random.Random(8)
    words = [f"w{k}" for k in range(60)] + ["É", "日本", "Ab"]
    docs = [(k, " ".join(r.choice(words) for _ in range(r.randrange(0, 60)))) for k in range(200)]
    docs += [(k, docs[3][1]) for k in range(300, 340)]  # ties at the edge of the ranking
    docs += [(None, docs[3][1]), (3, docs[3][1]), (400, None), (401, ""), (402, " -!"), (403, "w1 " * 30_000)]
    items = [(k, " ".join(r.choice(words) for _ in range(6))) for k in range(30)] + [(30, docs[3][1]), (None, "W1"), (31, "absent"), (32, None), (5, "w2 w2")]
    table = spark.createDataFrame([(*x, "x") for x in items], "item_id long, text string, doc_id string").repartition(2)
    want = slow_ranking(docs, items)
    assert rows_of(rank_documents(make_docs(docs), table)) == want
    # Other tiles and blocks give the same rows.
    assert rows_of(rank_documents(make_docs(docs), table, block_items=4, block_terms=9, tile_docs=7, tile_terms=3)) == want
    empty = make_docs(docs).limit(0)
    assert rank_documents(empty, table).count() == 0 and rank_documents(make_docs(docs), table.limit(0)).count() == 0


def test_partial_sums_stay_exact():
    block = Block()
    block.add(1, {b"t%d" % k for k in range(5000)})
    heavy = np.full(5000, 10**7, dtype=np.int64)
    tiles = block.tiles(heavy, 2048)
    assert sum(t.shape[1] for t in tiles) == 5000
    assert all(t.shape[1] * IMPACT_BOUND * 10**7 < EXACT for t in tiles)


def test_best_keeps_the_smaller_of_equals():
    r = np.random.default_rng(2)
    best, scores, ids = Best(1, 5), r.integers(0, 4, 400), r.permutation(400)
    for at in range(0, 400, 37):
        best.take(scores[None, at : at + 37], ids[at : at + 37], np.zeros(len(ids[at : at + 37]), bool))
    want = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if s > 0)[:5]
    assert [(-s, i) for s, i, _ in zip(*best.found[0], strict=True)] == want


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    assert rows_of(op11_ranking(spark, sf_dir)) == sorted(con.sql(SQL["op11_ranking"]).fetchall(), key=str)
