import hashlib
import itertools
import random
import zlib
from collections import Counter

from braidwork.llm.conversations import GONE, INSERTS, TERMINALS, Grammar, advance, damaged, product, read, repair_audits, repaired_rows
from braidwork.llm.queries import op13_conversations

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, present string, `a.b` string"


def slow_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def legal(initials):
    if initials[:1] == "s":
        initials = initials[1:]
    return initials == "ua" * (len(initials) // 2)


def slow_repair(rows):
    """Cheapest edits by a search over all states, row by row, with whole rows in hand."""
    seen, faults = set(), []
    for role, text in rows:
        solid = text.rstrip(SPACES)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    # state: last role's initial (or ""): best (cost, audit, repaired)
    ways = {"": (0, "", [])}

    def inserted(ways):
        todo = list(ways)
        while todo:
            s = todo.pop()
            cost, audit, made = ways[s]
            role = "assistant" if s == "u" else "user"
            new = (cost + 2, audit + "I", [*made, (role, "")])
            if role[0] not in ways or new[:2] < ways[role[0]][:2]:
                ways[role[0]] = new
                todo.append(role[0])
        return ways

    for (role, text), fault in zip(rows, faults, strict=True):
        ways, out = inserted(dict(ways)), {}
        for s, (cost, audit, made) in ways.items():
            moves = [(s, 3, "D", [])]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                right = "assistant" if s == "u" else "user"
                if role[:1] == right[0] or (role[:1] == "s" and s == ""):
                    moves.append((role[0], more, "K", [(role, text)]))
                moves.append((right[0], 2 + more, "R", [(right, text)]))
            for to, price, letter, rest in moves:
                new = (cost + price, audit + letter, made + rest)
                if to not in out or new[:2] < out[to][:2]:
                    out[to] = new
        ways = out
    ways = inserted(dict(ways))
    cost, audit, made = min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])
    assert legal("".join(r[:1] for r, _ in made))
    n = Counter(faults)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, made


def slow(rows, conversations):
    out = {}
    for conv in conversations:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        *n, made = slow_repair([r[2:] for r in own])
        out[conv] = (gaps, *n, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()), made
    return out


def conversations(r, n):
    texts = ["Fine.", "Well?", "so", "", " \t", "Done!\n", "é日本", "Fine."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "superuser"]
    rows = []
    for conv in range(n):
        for turn in range(r.randrange(0, 9)):
            rows.append((conv, None if r.random() < 0.03 else turn + r.choice([0, 0, 0, 1, 5]), r.choice(roles[:5] if r.random() < 0.8 else roles), None if r.random() < 0.03 else r.choice(texts)))
        rows += rows[-2:] if r.random() < 0.1 else []
    rows += [(None, None, None, None), (None, 3, "user", "Hm."), (n, -(2**63), "user", "A."), (n, 2**63 - 1, "assistant", "B.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, "e", "e") for x in rows], SCHEMA).repartition(3)


def test_against_slow_version(spark):
    rows = conversations(random.Random(2), 250)
    df = frame(spark, rows)
    ids = {x[0] for x in rows}
    want = slow([tuple(x) for x in rows if x[2] is not None and x[3] is not None], ids)
    whole = frame(spark, [x for x in rows if x[2] is not None and x[3] is not None])
    got = {x[0]: tuple(x)[1:] for x in repair_audits(whole).collect()}
    assert {k: v for k, v in got.items() if k != 250} == {k: want[k][0] for k in got if k != 250} and got[250][0] == 2**63 - 1
    made = {}
    for x in repaired_rows(whole).orderBy("conv_id", "place").collect():
        made.setdefault(x["conv_id"], []).append((x["role"], x["text"]))
    assert made == {k: want[k][1] for k in got if want[k][1]}
    # Damaged, with nulls; conversations of which no row is left stay.
    want = slow(slow_damage(rows), ids)
    got = {x[0]: tuple(x)[1:] for x in repair_audits(damaged(df), least_uses=2, present="present").collect()}
    assert set(got) == ids
    assert {k: v for k, v in got.items() if k != 250} == {k: v[0] for k, v in want.items() if k != 250}
    assert repair_audits(df.limit(0)).count() == 0


def test_long_conversation_in_small_batches(spark):
    r = random.Random(6)
    rows = [(7, k // 2, r.choice(["user", "assistant", "system", "tool"]), r.choice([f"Text {k}.", f"cut {k}", "", "Same."])) for k in range(3000)]
    rows += [(k, t, ["user", "assistant"][t], "Yes.") for k in range(20, 90) for t in range(2)]
    rows += [(8, k, "user", "Same again.") for k in range(1500)]  # one text all along
    want = slow(rows, {x[0] for x in rows})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = {x[0]: tuple(x)[1:] for x in repair_audits(frame(spark, rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {k: v[0] for k, v in want.items()}


def test_products_are_exact():
    """Matrices of joined words are those of one row after another, ropes and ties included."""
    import numpy as np

    r = random.Random(1)
    for _ in range(60):
        word = [r.randrange(9) for _ in range(r.randrange(1, 40))] * r.choice([1, 3])
        packed, matrices = Grammar(2).compress(np.array([*word, -1]))
        start = [(0, "", k) if k == 0 else None for k in range(4)]
        show = lambda es: [None if e is None else (e[0], read(e[1])) for e in es]
        assert show(advance(start, packed[:-1].tolist(), matrices)) == show(advance(start, word, TERMINALS))
        left, right = word[: len(word) // 2], word[len(word) // 2 :]
        a, b = INSERTS, INSERTS
        for k in left:
            a = product(a, TERMINALS[k])
        for k in right:
            b = product(b, TERMINALS[k])
        whole = INSERTS
        for k in word:
            whole = product(whole, TERMINALS[k])
        for x, y in zip(product(a, b), whole, strict=True):
            assert [e and e[0] for e in x] == [e and e[0] for e in y]
    assert [e and read(e[1]) for e in TERMINALS[GONE][0]] == ["D", None, "ID", "IID"]


def test_query(spark, sf_dir):
    rows = [tuple(x) for x in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = slow(slow_damage(rows), {x[0] for x in rows})
    assert {x[0]: tuple(x)[1:] for x in op13_conversations(spark, sf_dir).collect()} == {k: v[0] for k, v in want.items()}


def test_query_matches_sql(spark, sf_dir):
    import duckdb

    from braidwork.llm.oracle import SQL

    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    want = con.sql(SQL["op13_conversations"])
    got = op13_conversations(spark, sf_dir).select(*want.columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())
