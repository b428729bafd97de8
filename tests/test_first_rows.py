"""Reports of patterns start their optional paths from the first rows alone."""

import pytest
from pyspark.sql import functions as F

from braidwork import record_queries
from braidwork.operators import match
from braidwork.plans.schema import Graph

FOLDER = "/root/testdata/sf0.001"
GRAPH = Graph.of(
    {"Farm": {"id": "farmId", "properties": ["trade"]}, "Plot": {"id": "plotId", "properties": ["soil"]}, "Tool": {"id": "toolId", "properties": ["maker"]}},
    {"HOLDS": {"pairs": [["Farm", "Plot"]]}, "USES": {"pairs": [["Farm", "Tool"]]}},
)


@pytest.fixture(scope="module")
def farms(session):
    frame = lambda names, data: session.createDataFrame(data, ", ".join(f"{n} string" for n in names.split()))
    edge = lambda kind, pairs: frame("startId endId startLabel endLabel", [(a, b, "Farm", kind) for a, b in pairs])
    nodes = {
        "Farm": frame("farmId trade", [("f1", "wool"), ("f1", "wool"), ("f2", None), ("f3", "dairy"), ("f4", "wool")]),
        "Plot": frame("plotId soil", [(f"p{k}", f"s{k % 3}") for k in range(40)]), "Tool": frame("toolId maker", [("t1", "x"), ("t2", None)]),
    }
    holds = [(f, f"p{k}") for f in ("f1", "f3") for k in range(40)] + [("f2", "p99")]
    return match.Tables(GRAPH, nodes, {"HOLDS": edge("Plot", holds), "USES": edge("Tool", [("f1", "t1"), ("f1", "t2"), ("f3", "t2")])})


TOOL, PLOT = match.Hop("f", "USES", "Tool", "t", optional=True), [match.Hop("f", "HOLDS", "Plot", "p")]


@pytest.mark.parametrize("hops, columns, limits", [
    ([TOOL, PLOT], ["f.farmId", "f.trade", "t.toolId", "p.soil", "p.plotId"], 3),
    ([PLOT], ["f.trade", "f.farmId", "p.plotId"], 2),
    ([PLOT], ["f.trade", "p.plotId"], 1),  # equal trades can have other plots
    ([PLOT], ["f.farmId", "p.plotId", "f.trade"], 1),
    ([match.Hop("f", "USES", "Tool", "t"), PLOT], ["f.farmId", "t.maker", "p.plotId"], 2),
])
@pytest.mark.parametrize("limit", [1, 3, 50, 500])
def test_the_same_report_as_of_all_rows(farms, hops, columns, limits, limit):
    named = {c.rpartition(".")[2]: c for c in columns}
    got = match.first_rows(farms, "Farm", "f", hops, named, limit)
    assert got.collect() == match.report(match.match(farms, "Farm", "f", hops), named, limit).collect()
    assert got._jdf.queryExecution().optimizedPlan().toString().count("GlobalLimit") == limits


@pytest.mark.parametrize("name, limits", [("single_cell_metadata", 3), ("perturbation_phenotypes", 2), ("diagnosis_detail", 3), ("drug_agents", 2), ("cell_sets", 2)])
def test_documented_patterns_take_first_rows_along(session, name, limits):
    df = record_queries.QUERIES[f"pattern_{name}"](session, FOLDER)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("GlobalLimit") == limits


def test_names_are_not_dealt_with_the_lines(session):
    """Sample, line and perturbation: the lines are dealt by sample and then, with ids alone, by perturbation."""
    kept = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = record_queries._pattern_tables(session, FOLDER)
        rows = match.match(t, "Sample", "s", [match.Hop("s", "UNDERWENT_PERTURBATION", "Perturbation", "pert")])
        plan = rows.select(F.col("`s.id`"), F.col("`pert.perturbationName`"))._jdf.queryExecution().executedPlan().toString()
    finally:
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("Exchange hashpartitioning") == 4
