"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is allotted in equal blocks of words. Blocks go to sources, then within a source
to shards, by highest quotients w/1, w/3, w/5, ... (Sainte-Lague), which gives every
shard an integer quota. In a shard the documents are laid end to end in a seeded order
and the quota's blocks are cut from the front; whole passes come first, so a document is
taken at most ``max_repeats`` times its size.

Shards split every source by a hash of the document, so a source with a third of all rows
is spread over as many tasks as it has shards. Blocks are apportioned among shards in Spark:
an aggregation counts the seats above a grid of thresholds, a few rounds close in on the
threshold quotient, and the shards at the threshold are ranked. One row per source is
gathered, never one per shard or document.

Rows equal in id, text and source are numbered and dealt to the shards in turn, so a
group of repeated rows fills no shard, and how many of them are taken how often is the
same however the rows are partitioned.

Defined results for unusual rows: null text has size 0 and takes 0; a null source is a
source of its own that comes last; a null doc_id or repeated rows are taken like any
others; an empty table gives an empty result. ``mix_sources`` ignores columns beyond
doc_id, text and source, ``mixed_documents`` passes them on unread, whatever their names;
rows equal but for them are taken as equal ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidwork.llm.common import count_words, materialise

WEIGHTS = (5.0, 2.0, 1.0)


def fill_targets(sizes: list[int], weights: list[float], total: float, cap: float) -> list[float]:
    """Shares of ``total`` by weight; none above ``cap`` times its size, the excess
    shared again by weight among the rest."""
    target, open_ = [0.0] * len(sizes), [k for k, s in enumerate(sizes) if s > 0]
    left = float(total)
    while open_ and left > 0:
        unit = left / sum(weights[k] for k in open_)
        full = [k for k in open_ if weights[k] * unit >= cap * sizes[k]]
        if not full:
            for k in open_:
                target[k] = weights[k] * unit
            break
        for k in full:
            target[k] = cap * sizes[k]
            left -= target[k]
        open_ = [k for k in open_ if k not in set(full)]
    return target


def sainte_lague(weights: list[float], seats: int, limits: list[int] | None = None) -> list[int]:
    """Seats by highest quotients w/(2k+1); ties go to the earlier entry. ``limits``
    bounds the seats of an entry; what it can't hold goes on to the next quotients.

    The threshold quotient is found by bisection, so the work doesn't grow with seats.
    """
    n = len(weights)
    limits = [seats] * n if limits is None else limits
    seats = min(seats, sum(m for w, m in zip(weights, limits, strict=True) if w > 0))
    if seats <= 0:
        return [0] * n
    held = lambda q: [min(m, int((w / q + 1) // 2)) if w > 0 else 0 for w, m in zip(weights, limits, strict=True)]
    low, high = 0.0, 2.0 * max(weights)  # at high nobody has a seat
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if sum(held(middle)) <= seats:
            high = middle
        else:
            low = middle
    out = held(high)
    while (missing := seats - sum(out)) > 0:
        order = sorted((k for k in range(n) if weights[k] > 0 and out[k] < limits[k]), key=lambda k: (-weights[k] / (2 * out[k] + 1), k))
        for k in order[:missing]:
            out[k] += 1
    return out


def shard_quotas(shards: DataFrame, seats: dict, spread: int = 32, rounds: int = 16) -> DataFrame:
    """``shards`` (source, shard, weight, limit) with the quota of each: within a source the
    same seats as ``sainte_lague`` gives. ``seats`` has the seats of each source.

    Held seats fall as the threshold rises. Each round counts them at ``spread`` thresholds
    of every source in one aggregation and keeps the interval that holds the last seat.
    Where several shards share the threshold, the earlier ones get the seats that are left.
    """
    spark = shards.sparkSession
    held = lambda q: F.when(F.col("weight") > 0, F.least(F.col("limit"), F.floor((F.col("weight") / q + 1) / 2))).otherwise(F.lit(0)).cast("long")
    some = F.col("weight") > 0
    sums = shards.filter(some).groupBy("source").agg(F.max("weight").alias("top"), F.min("weight").alias("least"), F.sum("limit").alias("room"), F.max("limit").alias("most"), F.sum("weight").alias("all"), F.count("*").alias("n")).collect()
    want = {r["source"]: min(seats.get(r["source"], 0), r["room"]) for r in sums}
    # At ``floor`` every shard has all that it can hold, at twice the largest weight nobody has
    # a seat. Rounding moves the seats of n shards by n / 2 at most, which tells more: the
    # higher bound always holds, the lower one unless limits bind.
    floor = {r["source"]: r["least"] / (2 * r["most"] + 1) for r in sums}
    span = {}
    for r in sums:
        if seats_of := want[r["source"]]:
            high = r["all"] / (2 * seats_of - r["n"]) if 2 * seats_of > r["n"] else math.inf
            span[r["source"]] = [r["all"] / (2 * seats_of + r["n"]) * (1 - 1e-9), min(2 * r["top"], high * (1 + 1e-9))]
    kinds = "q_source string, low double, high double"
    open_ = set(span)  # sources whose threshold isn't settled
    for _ in range(rounds):
        open_ = {s for s in open_ if span[s][1] / span[s][0] > 1 + 1e-9}
        if not open_:
            break
        state = spark.createDataFrame([(s, *span[s]) for s in open_], kinds)
        # One row a source, as in the plan of the sources.
        both = shards.join(F.broadcast(state), F.col("source").eqNullSafe(F.col("q_source"))).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
        counts = both.withColumn("q", F.col("low") * F.pow(F.col("high") / F.col("low"), F.col("k") / spread)).groupBy("source", "k", "q").agg(F.sum(held(F.col("q"))).alias("n"))
        grid: dict = {s: {0: span[s][0], spread: span[s][1]} for s in open_}
        first, exact = dict.fromkeys(open_, -1), set()
        for r in counts.collect():
            grid[r["source"]][r["k"]] = r["q"]
            if r["n"] > want[r["source"]]:  # too many seats: the threshold is higher
                first[r["source"]] = max(first[r["source"]], r["k"])
            elif r["n"] == want[r["source"]]:  # nobody is left out above it
                exact.add((r["source"], r["k"]))
        span |= {s: [grid[s].get(k, floor[s]), grid[s][k + 1]] for s, k in first.items()}
        open_ -= {s for s, k in first.items() if (s, k + 1) in exact}
    state = spark.createDataFrame([(s, span[s][0], span[s][1], want[s]) for s in span], kinds + ", want long")
    both = shards.join(F.broadcast(state), F.col("source").eqNullSafe(F.col("q_source")), "left")
    sure = both.select("source", "shard", "weight", "limit", "low", "want", F.when(F.col("high").isNull(), F.lit(0)).otherwise(held(F.col("high"))).cast("long").alias("held"))
    sure = sure.withColumn("next", F.col("weight") / (2 * F.col("held") + 1))
    left = {r["source"]: r["want"] - r["n"] for r in sure.filter("want is not null").groupBy("source").agg(F.first("want").alias("want"), F.sum("held").alias("n")).collect()}
    rest = spark.createDataFrame(list(left.items()), "r_source string, missing long")
    # Ranked are the shards at the threshold alone.
    at = sure.filter((F.col("next") >= F.col("low") * (1 - 1e-9)) & (F.col("held") < F.col("limit")))
    ranked = at.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("next"), "shard")))
    more = ranked.join(F.broadcast(rest), F.col("source").eqNullSafe(F.col("r_source"))).filter("rank <= missing")
    more = more.select(F.col("source").alias("m_source"), F.col("shard").alias("m_shard"), F.lit(1).alias("_one"))
    out = sure.join(more, F.col("source").eqNullSafe(F.col("m_source")) & (F.col("shard") == F.col("m_shard")), "left")
    return out.select("source", "shard", (F.col("held") + F.coalesce("_one", F.lit(0))).alias("quota"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    max_repeats: float = 2.0,
    block_words: int = 64,
    shard_words: int = 250_000,
    seed: int = 17,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row, and ``keep`` columns."""
    spark = docs.sparkSession
    order = F.xxhash64("doc_id", "text", F.lit(seed))
    stored = materialise(
        docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), order.alias("_order"), F.monotonically_increasing_id().alias("_at"), *keep),
        "mix-sizes",
    )
    sized = numbered(stored.select("doc_id", "source", "size", "_order", "_at"))
    totals = {r["source"]: r["n"] for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    names = sorted((s for s in totals if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in totals)
    sizes = [totals[s] for s in names]
    target = fill_targets(sizes, [weights[k % len(weights)] for k in range(len(names))], share * sum(sizes), max_repeats)
    seats = sainte_lague(target, round(sum(target) / block_words))
    shards = [max(1, -(-s // shard_words)) for s in sizes]
    plan = spark.createDataFrame(
        [(s, *x) for s, *x in zip(names, sizes, target, seats, shards, strict=True)],
        "p_source string, source_size long, target double, seats long, shards int",
    )
    # One row a source: the same bound as the gathered totals.
    placed = sized.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("p_source"))).withColumn(
        "shard", F.pmod(F.hash("_order").cast("long") + F.col("_rank"), F.col("shards")).cast("int")
    )
    limit = F.ceil((F.col("cell_size") * max_repeats).cast("long") / block_words)
    cells = placed.groupBy(F.col("p_source").alias("q_source"), F.col("shard").alias("q_shard")).agg(F.sum("size").alias("cell_size"))
    cells = materialise(cells.withColumn("limit", limit.cast("long")), "mix-shards")
    shares = shard_quotas(cells.select(F.col("q_source").alias("source"), F.col("q_shard").alias("shard"), F.col("cell_size").cast("double").alias("weight"), "limit"), dict(zip(names, seats, strict=True)))
    same = F.col("q_source").eqNullSafe(F.col("source")) & (F.col("q_shard") == F.col("shard"))
    quota = materialise(cells.join(shares, same).select("q_source", "q_shard", "cell_size", "quota"), "mix-quotas")
    full = placed.join(quota, F.col("p_source").eqNullSafe(F.col("q_source")) & (F.col("shard") == F.col("q_shard")))
    # Rows without words take none wherever they lie; they are kept apart, in as many lines as they need.
    apart = F.when(F.col("size") == 0, F.col("_at") % 4096 + 1).otherwise(F.lit(0))
    line = Window.partitionBy("p_source", "shard", apart).orderBy("_order", "doc_id", "size", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    columns = ("doc_id", "size", "source_size", "target", "taken", "seats", "quota", "shard")
    out = full.withColumn("_start", F.coalesce(F.sum("size").over(line), F.lit(0))).withColumn("taken", _taken(block_words, max_repeats).cast("long"))
    if not keep:
        return out.select(*columns)
    # The texts don't go through the lines; they meet their rows again by place.
    return out.select(*columns, "_at").join(stored.select("_at", *keep), "_at").select(*columns, *keep)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_rank``, which numbers rows equal in ``_order`` and source from 0.

    ``_at`` is the row's number in a stored table. Rows are numbered within each of its
    partitions, and those before it are counted by an aggregation, so no task gets a whole group.
    """
    keyed = rows.withColumn("_same", F.xxhash64("_order", "source", F.col("source").isNull())).withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.partitionBy("_same").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = keyed.groupBy("_same", "_part").agg(F.count("*").alias("n"))
    before = counts.select("_same", "_part", F.sum("n").over(earlier).alias("_before")).filter("_before > 0")
    place = F.row_number().over(Window.partitionBy("_same", "_part").orderBy("_at")) - 1
    ranked = keyed.withColumn("_place", place).join(before, ["_same", "_part"], "left")
    return ranked.select(*rows.columns, (F.col("_place") + F.coalesce("_before", F.lit(0))).alias("_rank"))


def _taken(block_words: int, max_repeats: float) -> Column:
    """Words of the shard's blocks that fall on the document: whole passes, then the part
    of the last pass that reaches over its place in the shard."""
    words = F.least(F.col("quota") * block_words, (F.col("cell_size") * max_repeats).cast("long"))
    passes = F.when(F.col("cell_size") > 0, F.floor(words / F.col("cell_size"))).otherwise(F.lit(0))
    rest = words - passes * F.col("cell_size")
    return passes * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start")))


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: a whole copy for each whole time
    a document is taken, and a copy cut after the last taken word for a part."""
    columns = docs.columns
    packed = docs.select("doc_id", "text", "source", F.struct("*").alias("_row"))
    taken = mix_sources(packed, keep=("_row",), **params).filter("taken > 0")
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    spread = taken.select("_row", F.explode(copies).alias("_words"))
    pieces = F.slice(F.split(F.btrim("_row.text", F.lit(" \t\n\x0b\x0c\r")), "(?<=[^ \\t-\\r])(?=[ \\t-\\r])"), 1, F.col("_words"))
    cut = F.when(F.col("_words") == 0, F.col("_row.text")).otherwise(F.array_join(pieces, ""))
    return spread.select(*[cut.alias("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in columns])
