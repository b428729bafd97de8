import random

from pyspark.sql import functions as F

from braidwork.llm.mixing import fill_targets, mix_sources, mixed_documents, sainte_lague, shard_quotas


def by_quotients(weights, seats, limits):
    got = [0] * len(weights)
    for _ in range(min(seats, sum(m for w, m in zip(weights, limits, strict=True) if w > 0))):
        k = max((k for k in range(len(weights)) if weights[k] > 0 and got[k] < limits[k]), key=lambda k: (weights[k] / (2 * got[k] + 1), -k))
        got[k] += 1
    return got


def test_apportionment():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 7)
        weights = [rng.choice([0, 1, 1, 2, 5, rng.random() * 9]) for _ in range(n)]
        seats = rng.randrange(60)
        limits = [rng.randrange(30) for _ in range(n)]
        assert sainte_lague([float(w) for w in weights], seats, limits) == by_quotients(weights, seats, limits)


def test_apportionment_in_spark(spark):
    """The aggregation gives the seats of the quotients, with ties and limits."""
    rng = random.Random(9)
    rows, seats, expected = [], {}, {}
    for s in ("a", "b", None, "empty", "equal", "huge"):
        n = 400 if s == "equal" else rng.randrange(1, 60)
        weights = [{"empty": 0, "equal": 250, "huge": 10 ** (1 + k % 7)}.get(s, rng.choice([0, 1, 3, 3, 9, rng.randrange(9000)])) for k in range(n)]
        limits = [rng.randrange(1, 90) for _ in range(n)]
        seats[s] = {"equal": 777, "b": 10**6}.get(s, rng.randrange(900))
        rows += [(s, k, float(w), m) for k, (w, m) in enumerate(zip(weights, limits, strict=True))]
        expected |= {(s, k): q for k, q in enumerate(by_quotients(weights, seats[s], limits))}
    shards = spark.createDataFrame(rows, "source string, shard int, weight double, limit long").repartition(5)
    assert {(r.source, r.shard): r.quota for r in shard_quotas(shards, seats).collect()} == expected


def brute_taken(docs, block=64, shard_words=250_000):
    """(doc_id, size, taken) by laying every shard's documents end to end."""
    hashed = docs.select("doc_id", "text", "source", F.xxhash64("doc_id", "text", F.lit(17)).alias("h"))
    rows = [(*r, len((r.text or "").split())) for r in hashed.withColumn("b", F.hash("h")).collect()]
    sizes: dict = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + r[5]
    targets = brute_targets([r[:3] for r in rows])
    names = list(targets)
    blocks = by_quotients([targets[s][1] for s in names], round(sum(t for _, t in targets.values()) / block), [10**9] * len(names))
    out = []
    for s, n in zip(names, blocks, strict=True):
        parts: dict = {}
        for r in rows:
            if r[2] == s:
                parts.setdefault(r[4] % max(1, -(-sizes[s] // shard_words)), []).append(r)
        keys = sorted(parts)
        weights = [sum(r[5] for r in parts[k]) for k in keys]
        for k, w, q in zip(keys, weights, by_quotients(weights, n, [-(-2 * w // block) for w in weights]), strict=True):
            line = sorted(parts[k], key=lambda r: (r[3], (r[0] is not None, r[0] or 0), r[5]))
            words, at = min(q * block, 2 * w), 0
            for r in line:
                taken = (words // w) * r[5] + max(0, min(r[5], words % w - at)) if w else 0
                out.append((r[0], r[5], taken))
                at += r[5]
    return sorted(out)


def test_query_matches_a_slow_version(spark, sf_dir):
    from braidwork.llm.queries import op8_mixing

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert sorted((r.doc_id, r.size, r.taken) for r in op8_mixing(spark, sf_dir).collect()) == brute_taken(docs)
    assert sorted((r.doc_id, r.size, r.taken) for r in mix_sources(docs, shard_words=700).collect()) == brute_taken(docs, shard_words=700)


def test_repeated_rows_are_spread(spark, make_docs):
    """Rows equal in id and text go to all shards alike, those without words too."""
    rows = [(None, "one two three", "a")] * 2000 + [(k, "four five", "a") for k in range(2000)] + [(None, None, "a")] * 500
    docs = make_docs(rows)
    got = mix_sources(docs, shard_words=700, block_words=8)
    shards: dict = {}
    for r in got.filter("doc_id is null and size = 3").groupBy("shard").count().collect():
        shards[r.shard] = r["count"]
    assert len(shards) == 15 and max(shards.values()) - min(shards.values()) <= 1
    taken = lambda d: sorted((str(r.doc_id), r.size, r.taken) for r in mix_sources(d, shard_words=700, block_words=8).collect())
    assert taken(docs) == taken(docs.repartition(11)) == taken(docs.coalesce(1))
    assert got.count() == len(rows)
    copies = mixed_documents(docs, shard_words=700, block_words=8)
    assert copies.columns == docs.columns
    assert sum(len(r.text.split()) for r in copies.collect()) == sum(x[2] for x in taken(docs))


def test_targets():
    assert fill_targets([100, 100], [1, 1], 150, 2) == [75, 75]
    assert fill_targets([10, 1000], [5, 1], 1515, 2) == [20, 1495]
    assert fill_targets([0, 5], [5, 2], 7.5, 2) == [0, 7.5]
    assert fill_targets([], [], 0, 2) == []


def brute_targets(rows):
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    target = fill_targets([sizes[s] for s in names], [[5, 2, 1][k % 3] for k in range(len(names))], 1.5 * sum(sizes.values()), 2)
    return {s: (sizes[s], t) for s, t in zip(names, target, strict=True)}


def test_mix(make_docs):
    rng = random.Random(5)
    rows = [(k, "w " * rng.randrange(60), rng.choice(["b", "a", "é", "zz", None])) for k in range(300)]
    rows += [(3, "same text", "a"), (3, "same text", "a"), (None, "no id", "b"), (5, None, "b"), (6, "", "only")]
    expected = brute_targets(rows)
    for params in ({}, {"block_words": 16, "shard_words": 300}):
        got = mix_sources(make_docs(rows), **params).collect()
        again = mix_sources(make_docs(rows).repartition(7), **params).collect()
        key = lambda r: (str(r.doc_id), r.size, r.taken)
        assert sorted(map(key, got)) == sorted(map(key, again))
        assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
        taken: dict = {}
        sources = {k: s for k, _, s in rows[:300]}
        for r in got:
            if r.doc_id in sources and r.doc_id not in (3, 5, 6):
                assert (r.source_size, round(r.target, 6)) == (expected[sources[r.doc_id]][0], round(expected[sources[r.doc_id]][1], 6))
            at = (r.source_size, round(r.target, 6))
            taken[at] = taken.get(at, 0) + r.taken
        for size, target in expected.values():
            shards = max(1, -(-size // params.get("shard_words", 250_000)))
            assert abs(taken[size, round(target, 6)] - target) <= params.get("block_words", 64) * (1 + shards) or size == 0
    copies = mixed_documents(make_docs(rows)).collect()
    assert sum(len(r.text.split()) for r in copies) == sum(r.taken for r in mix_sources(make_docs(rows)).collect())
    assert mix_sources(make_docs([])).count() == 0
