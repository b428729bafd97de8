"""A fold reads its batch twice: once for the ends, once for the edges."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from braidwork.operators import fold
from braidwork.plans import store
from braidwork.plans.schema import Graph

GRAPH = Graph.of(
    {"Farm": {"id": "farmId", "properties": ["trade"]}, "Plot": {"id": "plotId", "properties": [{"size": "double"}]}},
    {"HOLDS": {"pairs": [["Farm", "Plot"], ["Farm", "Farm"]], "properties": ["share"]}},
)


def test_each_edge_is_computed_twice_a_fold(session, tmp_path):
    seen = session.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        seen.add(1)
        return x

    at, n = str(tmp_path / "store"), 200
    nodes = {"Farm": session.range(100).select(F.concat(F.lit("f"), "id").alias("farmId")), "Plot": session.range(50).select(F.concat(F.lit("p"), "id").alias("plotId"))}
    text = lambda head, x: F.concat(F.lit(head), x.cast("string"))
    links = session.range(n).select(counted.asNondeterministic()(text("f", F.col("id"))).alias("startId"), text("p", F.col("id") % 80).alias("endId"), F.lit("Farm").alias("startLabel"), F.lit("Plot").alias("endLabel"), F.lit("1").alias("share"))
    store.create_store(session, GRAPH, at, nodes, {"HOLDS": links}, buckets=4)
    assert seen.value == 2 * n
    kept = [k for k in range(n) if k < 100 and k % 80 < 50]
    assert Counter(r.startId for r in store.read_store(session, at)[1]["HOLDS"].collect()) == Counter(f"f{k}" for k in kept)
    assert store.dropped(session, at).count() == n - len(kept)


@pytest.mark.parametrize("starts, ends, lost", [(["f1"], ["p1", "p9"], 1), (["f1", "f9"], ["p1"], 1), (["f1", "f9", None, ""], ["p1", "p9", None], 11), (["f1"], ["p1"], 0)])
def test_unknown_ends_of_either_side(session, tmp_path, starts, ends, lost):
    at = str(tmp_path / "store")
    nodes = {"Farm": session.createDataFrame([("f1",), ("f2",)], "farmId string"), "Plot": session.createDataFrame([("p1",)], "plotId string")}
    links = session.createDataFrame([(a, b, "Farm", "Plot", "1") for a in starts for b in ends], "startId string, endId string, startLabel string, endLabel string, share string")
    report = {r.name: r for r in store.create_store(session, GRAPH, at, nodes, {"HOLDS": links}, buckets=4).collect()}
    assert report["HOLDS"].n_dropped == lost and report["HOLDS"].n_rows == 1
    assert [(r.startId, r.endId) for r in store.read_store(session, at)[1]["HOLDS"].collect()] == [("f1", "p1")]


def test_numbers_stay_numbers_until_they_are_settled(session, tmp_path):
    at = str(tmp_path / "store")
    plots = lambda *v: {"Plot": session.createDataFrame([("p1", x) for x in v], "plotId string, size long")}
    store.create_store(session, GRAPH, at, plots(9, 10), {}, buckets=4)
    assert store.read_store(session, at)[0]["Plot"].first().size == "10"
    store.fold_batch(session, GRAPH, at, plots(2, None), {}, "b")
    assert store.read_store(session, at)[0]["Plot"].first().size == "2"


def _settling(session, deal):
    """Group keys of the last step of a fold's plan, and the number of its tasks."""
    rows = session.createDataFrame([("Farm", f"f{k % 90}", "Plot", f"p{k}", "1", k % 7) for k in range(180)], "startLabel string, startId string, endLabel string, endId string, share string, _bucket int")
    out = fold.fold_rows(None, rows, ["_bucket", *fold.EDGE_KEY], deal=deal)
    plan = out._jdf.queryExecution().executedPlan().toString()
    return out, [c.split("#")[0] for c in re.search(r"Sort \[(.*?)\]", plan)[1].split(", ")]


def test_a_bucket_is_one_task_and_ids_are_sorted_first(session):
    out, sorted_by = _settling(session, ("_bucket", 7))
    assert sorted_by == ["endId", "endLabel", "startId", "startLabel", "_bucket"]
    at = out.select("_bucket", F.spark_partition_id().alias("task")).distinct().collect()
    assert sorted((r._bucket, r.task) for r in at) == [(k, k) for k in range(7)]
    assert out.columns == ["_bucket", *fold.EDGE_KEY, "share"] and out.count() == 180


def test_ends_are_known_by_side_and_blank_ones_are_lost_without_a_lookup(session):
    links = session.createDataFrame([("f1", "p1", "Farm", "Plot"), ("f1", "f2", "Farm", "Farm"), ("f2", "", "Farm", "Plot"), (None, "p1", "Farm", "Plot"), ("f1", "p1", None, "Plot")], "startId string, endId string, startLabel string, endLabel string")
    ends = {(r.label, r.id): r.sides for r in fold.edge_ends(links, sides=True).collect() if r.id}
    assert ends == {("Farm", "f1"): 1, ("Farm", "f2"): 3, ("Plot", "p1"): 2, (None, "f1"): 1}
    none = session.createDataFrame([], "label string, id string")
    lost = [r._lost for r in fold.mark_lost(links, none, ()).orderBy(F.monotonically_increasing_id()).collect()]
    assert lost == [False, False, True, True, True]
