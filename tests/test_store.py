import csv
import os
from collections import Counter

import pytest

from braidwork.operators import audit, fold
from braidwork.plans import store
from braidwork.plans.schema import Graph
from braidwork.sources import readers, writers

GRAPH = Graph.of(
    {"Farm": {"id": "farmId", "properties": ["trade", "soil"]}, "Plot": {"id": "plotId", "properties": [{"size": "double"}]}},
    {"HOLDS": {"pairs": [["Farm", "Plot"], ["Farm", "Farm"]], "properties": [{"share": "float"}, "note"]}},
)


def farms(session, ids, value):
    return session.createDataFrame([(f"f{k}", value, None if k % 2 else "clay") for k in ids], "farmId string, trade string, soil string")


def plots(session, ids):
    return session.createDataFrame([(f"p{k}", f"{k}") for k in ids], "plotId string, size string")


def holds(session, rows):
    return session.createDataFrame(rows, "startId string, endId string, startLabel string, endLabel string, share string, note string")


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).na.fill("").collect())


def files(folder):
    """Every data file with its time and size."""
    out = {}
    for at, _, names in os.walk(folder):
        out.update({f"{at}/{n}": (os.stat(f"{at}/{n}").st_mtime_ns, os.stat(f"{at}/{n}").st_size) for n in names if n.startswith("part-")})
    return out


def test_a_fold_leaves_other_buckets_alone_and_equals_the_full_fold(session, tmp_path):
    at = str(tmp_path / "store")
    old = {"Farm": farms(session, range(1000), "dairy"), "Plot": plots(session, range(1000))}
    links = {"HOLDS": holds(session, [(f"f{k}", f"p{k}", "Farm", "Plot", "1", f"n{k}") for k in range(1000)])}
    store.create_store(session, GRAPH, at, old, links, buckets=32)
    before = files(at)
    assert len([f for f in before if "/nodes/Farm.parquet/" in f]) == 32  # one file a bucket
    # One in a hundred ids, and two new ones; edges to unknown and blank ends.
    new = {"Farm": session.createDataFrame([(f"f{k}", "wool", "") for k in [*range(0, 1000, 100), 2000, 2001]] + [("", "x", "y")], "farmId string, trade string, soil string")}
    more = {"HOLDS": holds(session, [("f5", "p5", "Farm", "Plot", "", "again"), ("f2000", "p7", "Farm", "Plot", "0.5", ""), ("f5", "p5000", "Farm", "Plot", "", ""), ("", "p1", "Farm", "Plot", "", ""), ("f5", "f2001", "Farm", "Farm", "", "")])}
    report = {r["name"]: r for r in store.fold_batch(session, GRAPH, at, new, more, "b1").collect()}
    assert 1 <= report["Farm"].n_buckets <= 12 and report["HOLDS"].n_buckets <= 3 and report["HOLDS"].n_dropped == 2
    after = files(at)
    kept = [f for f in before if after.get(f) == before[f]]
    touched = {f.split("/_bucket=")[1].split("/")[0] for f in after if "/nodes/Farm.parquet/" in f and f not in before}
    assert len(touched) == report["Farm"].n_buckets
    assert all(f in kept for f in before if "/nodes/Farm.parquet/" in f and f.split("/_bucket=")[1].split("/")[0] not in touched)
    assert all(f in kept for f in before if "/nodes/Plot.parquet/" in f)
    nodes, edges = store.read_store(session, at)
    whole = fold.upsert_nodes(old["Farm"], new["Farm"], "farmId")
    assert rows(nodes["Farm"]) == rows(whole)
    ids = audit.known_ids({"Farm": whole, "Plot": old["Plot"]}, GRAPH)
    full, lost = fold.upsert_edges(links["HOLDS"], more["HOLDS"], ids)
    assert rows(edges["HOLDS"]) == rows(full)
    assert Counter(r.batch for r in store.dropped(session, at).collect()) == {"b1": 2} and lost.count() == 2
    # Again: nothing changes, and the dropped edges of the batch aren't doubled.
    store.fold_batch(session, GRAPH, at, new, more, "b1")
    again, links_again = store.read_store(session, at)
    assert rows(again["Farm"]) == rows(whole) and rows(links_again["HOLDS"]) == rows(full) and store.dropped(session, at).count() == 2


def test_columns_and_tables_that_come_later(session, tmp_path):
    at = str(tmp_path / "store")
    store.create_store(session, GRAPH, at, {"Farm": farms(session, range(5), "dairy").drop("soil")}, {}, buckets=4)
    store.fold_batch(session, GRAPH, at, {"Farm": farms(session, [7], "wool").selectExpr("*", "trade as `odd name`"), "Plot": plots(session, [1]), "Nowhere": plots(session, [1])}, {}, "b")
    nodes, edges = store.read_store(session, at)
    assert edges == {} and set(nodes) == {"Farm", "Plot"} and set(nodes["Farm"].columns) == {"farmId", "trade", "soil", "odd name"}
    assert rows(nodes["Farm"].select("farmId", "soil")) == Counter([(f"f{k}", "") for k in (0, 1, 2, 3, 4, 7)])
    assert store.fold_batch(session, GRAPH, at, {"Farm": farms(session, [], "x")}, {}, "c").first().n_buckets == 0
    with pytest.raises(ValueError):
        store.create_store(session, GRAPH, at, {}, {})


@pytest.mark.parametrize("n", [1, 7])
def test_a_popular_id_and_a_batchs_order(session, tmp_path, n):
    at = str(tmp_path / "store")
    batch = session.createDataFrame([("f1", f"v{k:04}", k) for k in range(3000)], "farmId string, trade string, at long").repartition(n)
    store.create_store(session, GRAPH, at, {"Farm": farms(session, range(3), "dairy")}, {}, buckets=4)
    store.fold_batch(session, GRAPH, at, {"Farm": batch}, {}, "b", order="at")
    got = {r.farmId: r.trade for r in store.read_store(session, at)[0]["Farm"].collect()}
    assert got == {"f0": "dairy", "f1": "v2999", "f2": "dairy"}


def test_fold_of_a_folder(session, tmp_path):
    at = str(tmp_path / "store")
    (tmp_path / "b" / "nodes").mkdir(parents=True)
    (tmp_path / "b" / "edges").mkdir()
    (tmp_path / "b" / "nodes" / "Farm.csv").write_text("farmId,trade\nf1,a\nf2,b\nf1,c\n")
    (tmp_path / "b" / "edges" / "HOLDS.csv").write_text("startId,endId,startLabel,endLabel,share\nf1,f2,Farm,Farm,\nf1,f9,Farm,Farm,\n")
    store.create_store(session, GRAPH, at, {}, {}, buckets=8)
    report = {r["name"]: r for r in store.fold_folder(session, GRAPH, at, str(tmp_path / "b"), "b").collect()}
    nodes, edges = store.read_store(session, at)
    assert {tuple(r) for r in nodes["Farm"].select("farmId", "trade").collect()} == {("f1", "c"), ("f2", "b")}
    assert edges["HOLDS"].count() == 1 and report["HOLDS"].n_dropped == 1 and report["HOLDS"].n_rows == 1


def test_plans_read_only_touched_buckets(session, tmp_path):
    at = str(tmp_path / "store")
    store.create_store(session, GRAPH, at, {"Farm": farms(session, range(100), "dairy")}, {}, buckets=16)
    part = store._stored(session, at, store.Layout.read(session, at), "nodes", "Farm", [3, 5])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan and part.rdd.getNumPartitions() >= 1
    assert {r[0] for r in part.select("_bucket").distinct().collect()} <= {3, 5}


def test_bulk_files_hold_a_header_and_the_listed_rows(session, tmp_path):
    folder = str(tmp_path / "bulk")
    links = holds(session, [(f"f{k}", f"p{k}", "Farm", "Plot", "0.5", 'say "so", twice') for k in range(50)] + [("f1", "f2", "Farm", "Farm", "", ""), ("p1", "f1", "Plot", "Farm", "", "")]).repartition(5)
    nodes = {"Farm": farms(session, range(20), "dairy").union(farms(session, [1], "x").selectExpr("' '", "trade", "soil")).repartition(3), "Odd": plots(session, [1])}
    written = writers.write_bulk(nodes, {"HOLDS": links, "ODD": links}, GRAPH, folder)
    listed = {(r.kind, r.name, r.path): r.n_rows for r in writers.written_manifest(session, {"d": written}).collect()}
    assert listed == {("node", "Farm", "d/nodes/Farm"): 20, ("edge", "HOLDS", "d/edges/HOLDS/startLabel=Farm/endLabel=Plot"): 50, ("edge", "HOLDS", "d/edges/HOLDS/startLabel=Farm/endLabel=Farm"): 1}
    planned = writers.bulk_manifest(session, {"d": (nodes, {"HOLDS": links})}, GRAPH)[0]
    assert {(r.kind, r.name, r.path): r.n_rows for r in planned.collect()} == listed
    for f in written:
        at = f"{folder}/{f.path}"
        assert [n for n in os.listdir(at) if n == writers.HEADER] == [writers.HEADER]
        head = next(csv.reader(open(f"{at}/{writers.HEADER}")))
        lines = [r for n in sorted(os.listdir(at)) if n.startswith("part-") for r in csv.reader(open(f"{at}/{n}"))]
        assert len(lines) == f.n_rows and all(len(r) == len(head) for r in lines)
    assert next(csv.reader(open(f"{folder}/edges/HOLDS/startLabel=Farm/endLabel=Plot/{writers.HEADER}"))) == [":START_ID(Farm)", ":END_ID(Plot)", "share:float", "note"]
    assert session.read.csv(f"{folder}/edges/HOLDS/startLabel=Farm/endLabel=Plot", escape='"').count() == 50
    assert writers.write_bulk({"Farm": farms(session, [], "x")}, {"HOLDS": links.limit(0)}, GRAPH, str(tmp_path / "none")) == [writers.BulkFile("node", "Farm", "nodes/Farm", 0)]


def test_counts_come_from_the_write(session, tmp_path):
    counts = writers.write_graph({"Farm": farms(session, range(9), "x"), "Plot": plots(session, [])}, {}, str(tmp_path / "g"))
    assert counts == {("node", "Farm"): 9, ("node", "Plot"): 0}
    assert readers.read_graph(session, str(tmp_path / "g"), GRAPH)[0]["Farm"].count() == 9
