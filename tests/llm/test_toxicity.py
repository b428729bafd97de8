import math
import random

import regex

from braidwork.llm import toxicity
from braidwork.llm.queries import op2_toxicity
from braidwork.llm.toxicity import Lexicon, Scanner, score_toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_brute_force():
    rng = random.Random(6)
    terms = ["abcde", "abcab", "cabba", "ddccb", "abc"]
    lexicon = Lexicon(terms)
    for _ in range(3000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))
        best = None
        for t in terms:
            for k in range(len(word) + 1):
                d = distance(word[:k], t)
                if d == 0 or d == 1 and len(t) >= 5 and len(word) >= 4:
                    best = max(filter(None, (best, (-d, len(t), t))))
        got = lexicon.match(word)
        assert (got and (-got[1], len(got[0]), got[0])) == best, word


def test_context():
    s = Scanner(["idiot"])
    assert s.hits("you idiot there") == {("idiot", 0, False)}
    assert s.hits('the "idiot" there') == {("idiot", 0, True)}
    assert s.hits('he wrote «you idiot» and "more"') == {("idiot", 0, True)} and s.hits("‘idiot’, 'an idiot here'") == {("idiot", 0, True)}
    assert s.hits("people said idiot once") == {("idiot", 0, False)}
    assert Scanner(["idiot"], ["said"]).hits("people said idiot once") == {("idiot", 0, True)}
    for abuse in ("I'm sure you're an idiot and you'll lose it's done", "don't be an idiot, that's it", "in other words you idiot", 'so "far" an idiot is "near"', 'an "open\nidiot" line', "the students' idiot friends' car"):
        assert s.hits(abuse) == {("idiot", 0, False)}, abuse
    assert s.hits("id1ot st*ff") == s.hits("an i*iot") == {("idiot", 1, False)}
    assert s.hits("an idioot and IDIOTS") == {("idiot", 1, False), ("idiot", 0, False)} and s.hits(None) == set()


def test_held_out_rows(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet")
    rows = op2_toxicity(spark, sf_dir.replace("sf0.001", "sf0.01")).join(labels, "doc_id").filter("held_out").collect()
    hit = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 50 and hit >= 0.95 * len(rows)


def test_unusual_rows(spark, make_docs):
    rng = random.Random(3)
    clean = lambda: " ".join(rng.choice(["lora", "mipo", "tarel", "senu", "vika", "doran"]) + str(rng.randrange(50)) for _ in range(20))
    rows = [(k, clean() + (" grumblar" if k % 4 == 0 else "")) for k in range(400)]
    marks = [(k, int(k % 4 == 0)) for k in range(400)] + [(0, 0), (None, 1), (7, None)]
    rows += [(900, None), (901, ""), (None, "grumblar"), (902, "grumblr here"), (903, "x " * 100_000), (903, "grumblar")]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    got = score_toxicity(make_docs(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in got if r.doc_id is not None and r.doc_id < 400)
    late = sorted((str(r.doc_id), r.predicted) for r in got if r.doc_id is None or r.doc_id >= 900)
    assert late == [("900", 0), ("901", 0), ("902", 1), ("903", 0), ("903", 1), ("None", 1)]
    assert score_toxicity(make_docs([]), labels).count() == 0
    again = score_toxicity(make_docs(rows).repartition(11), labels).collect()
    assert sorted((str(r.doc_id), r.score) for r in again) == sorted((str(r.doc_id), r.score) for r in got)
    assert {r.predicted for r in score_toxicity(make_docs(rows[:3]), labels.limit(0)).collect()} == {0}


def slow_hits(text, terms, reporting):
    """(term, kind, quoted, level) by distances to every term, window by window."""
    text = (text or "").lower()
    words = [(m.group(), m.start(), m.end()) for m in toxicity._WORD.finditer(text)]
    quotes, times = toxicity.quoted_spans(text), {}
    for k, (w, a, b) in enumerate(words):
        found = []
        for t in terms:
            for n in range(max(0, len(t) - 1), min(len(w), len(t) + 1) + 1):
                d = 0 if w[:n] == t else distance(w[:n], t) if len(t) >= 5 and len(w) >= 4 else 9
                if d < 2:
                    found.append((-d, len(t), t))
        if found:
            d, _, t = max(found)
            window = words[max(0, k - 4) : k + 5]
            marked = any(x <= a and y >= b and x >= window[0][1] - 1 and y <= window[-1][2] for x, y in quotes)
            hit = (t, 0 if d == 0 else 1 if w.isalpha() else 2, marked or any(x in reporting for x, _, _ in window))
            times[hit] = times.get(hit, 0) + 1
    return {(*h, 3 if n / max(1, len(words) / 2000) > 2 else 2 if n / max(1, len(words) / 2000) > 1 else 1) for h, n in times.items()}


def slow_score(hits, weights, none):
    z = sum(weights.get(h, 0) for h in hits) or none
    return 1 / (1 + math.exp(-(math.log(0.1 / 0.9) + z)))


def g_test(a, b, share):
    e, f = (a + b) * share, (a + b) * (1 - share)
    return 2 * ((a * math.log(a / e) if a else 0) + (b * math.log(b / f) if b else 0))


def slow_terms(rows):
    """Terms from (text, toxic, vote) rows, every beginning of every word tried."""
    total = [sum(v for _, y, v in rows if y == k) for k in (0, 1)]
    share, sums = total[1] / sum(total), {}
    for text, y, v in rows:
        heads = {}
        for w in set(regex.findall(r"\p{L}+", text)):
            for n in range(2, min(len(w), 32) + 1):
                heads[w[:n]] = heads.get(w[:n], 0) + 1
        for h, k in heads.items():
            s = sums.setdefault(h, [0, 0, 0, 0])
            s[y] += v
            s[2 + y] += v * k
    found = [
        (round(g_test(d, c, share), 6), len(h), h)
        for h, (n, t, c, d) in sums.items()
        if g_test(t, n, share) >= 28.4 and (t + 0.5) / (n + 0.5) * total[0] / total[1] >= math.e
    ]
    kept = []
    for _, _, h in sorted(found, reverse=True):
        if not any(h.startswith(k) or k.startswith(h) for k in kept):
            kept.append(h)
    return sorted(kept)


def test_query_matches_a_slow_version(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    few = model._replace(terms=(model.terms or ["loser", "trash"])[:12], weights=model.weights or {("loser", 0, False, 1): 4.0})
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if len(r.text or "") < 1500}
    got = {r.doc_id: r.score for r in toxicity.predict(docs, few).collect()}
    assert texts and all(abs(got[i] - slow_score(slow_hits(t, few.terms, few.reporting), few.weights, few.none)) < 1e-9 for i, t in texts.items())
    assert {r.doc_id: r.score for r in op2_toxicity(spark, sf_dir).collect()} == {r.doc_id: r.score for r in toxicity.predict(docs, model).collect()}


def test_learning_matches_a_slow_version(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    train = toxicity.training_rows(docs, labels, 4000)
    rows = [(r.text, r.toxic, r.vote) for r in train.collect()]
    assert any(v < 1 for _, _, v in rows) and all(0 < v <= 1 for _, _, v in rows)
    terms = slow_terms(rows)
    model = toxicity.fit(docs, labels)
    assert terms and model.terms == terms and toxicity.fit(docs.repartition(7), labels.repartition(3)) == model
    seen, total, without = {}, [0.0, 0.0], [0.0, 0.0]
    hits = [(slow_hits(t, terms, model.reporting), y, v) for t, y, v in rows]
    for found, y, v in hits:
        total[1 - y] += v
        for h in found:
            seen.setdefault(h, [0.0, 0.0])[1 - y] += v
    weights = toxicity.weigh_hits(seen, terms, total[0] / total[1])
    assert weights.keys() == model.weights.keys() and all(abs(w - model.weights[h]) < 1e-4 for h, w in weights.items())
    for found, y, v in hits:
        if not any(weights[h] for h in found):
            without[1 - y] += v
    assert abs(model.none - min(0, math.log((without[0] + 0.5) / (without[1] * total[0] / total[1] + 0.5)))) < 1e-4


def test_words_of_reporting_are_learned(spark, make_docs):
    rows = [(k, f"filler {k} grumblar you") for k in range(60)] + [(100 + k, f"filler {k} dijeron grumblar") for k in range(40)]
    train = make_docs(rows).selectExpr("doc_id", "lower(text) as text", "cast(doc_id < 60 as int) as toxic")
    assert toxicity.learn_reporting(train, ["grumblar"]) == ["dijeron"]


def test_rare_words_and_stems_are_terms_and_copies_have_one_vote(spark, make_docs):
    rng = random.Random(8)
    filler = lambda: " ".join(rng.choice("abcdefgh") * 3 + str(rng.randrange(10**6)) for _ in range(12))
    rows = [(k, filler() + f" schimpf{'abcdefghij'[k % 10]}x schimpf{'klmnopqrst'[k % 10]}y") for k in range(16)]
    rows += [(100 + k, filler()) for k in range(400)]
    rows += [(600 + k, f"{copied} number{k % 3}") for copied in [filler() + " bystander" + filler()] for k in range(40)]
    toxic = {*range(16), *range(600, 640)}
    train = make_docs(rows).select("doc_id", "text").rdd.map(lambda r: (r.doc_id, r.text, int(r.doc_id in toxic))).toDF("doc_id long, text string, toxic int")
    voted = toxicity.with_votes(train)
    assert sum(r.vote for r in voted.filter("doc_id >= 600").collect()) < 4
    assert toxicity.learn_terms(voted) == ["schimpf"]


def test_quotations_weigh_what_all_terms_show():
    plain = {(t, 0, False, 1): (40.0, 0.0) for t in ("aaaaa", "bbbbb", "ccccc")}
    quoted = {("aaaaa", 0, True, 1): (0.0, 200.0), ("bbbbb", 0, True, 1): (0.0, 100.0)}
    w = toxicity.weigh_hits(plain | quoted, ["aaaaa", "bbbbb", "ccccc"], 0.2)
    assert w["ccccc", 0, False, 1] > 3 and w["ccccc", 0, True, 1] == 0 == w["aaaaa", 0, True, 1]
    assert toxicity.weigh_hits(plain, ["ccccc"], 0.2)["ccccc", 2, False, 1] > 3
