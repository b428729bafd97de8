from collections import Counter

import pytest

from braidwork.operators import bind
from braidwork.plans import pipeline
from braidwork.plans.schema import Graph, Profile
from braidwork.sources import readers

GRAPH = Graph.of(
    {
        "Farm": {"id": "farmId", "properties": ["trade"]}, "Sample": {"id": "sampleId", "properties": ["soil"]},
        "ExpressionObservation": {"id": "expressionObservationId", "properties": [{"expressionValue": "float"}]}, "Gene": {"id": "geneId", "properties": []},
        "Variant": {"id": "variantId", "properties": ["chromosome"]}, "VariantObservation": {"id": "variantObservationId", "properties": []},
    },
    {
        "HOLDS_PLOT": {"pairs": [["Farm", "Sample"]]}, "HAS_EXPRESSION_OBSERVATION": {"pairs": [["Sample", "ExpressionObservation"]]},
        "MEASURES_GENE": {"pairs": [["ExpressionObservation", "Gene"]]}, "OBSERVED_VARIANT": {"pairs": [["VariantObservation", "Variant"]]},
        "IS_WITHIN_GENE": {"pairs": [["Variant", "Gene"]]},
    },
)

PROFILE = {
    "aliases": {"work": "trade"},
    "reshape": [
        {"type": "matrix", "input": "crop.tsv", "output": "expression_observation.tsv", "observation": "expression", "feature_id_column": "gene_id", "feature_id_type": "ensembl", "unit": "TPM"},
        {"type": "vcf", "input": "calls.vcf", "output": "variation_observation.tsv", "gene_edge_output": "variant_gene.tsv"},
        {"type": "matrix", "input": "lost.tsv", "output": "methylation_observation.tsv", "observation": "methylation", "feature_id_column": "x"},
    ],
    "nodes": {
        "Farm": {"file": "fields.tsv", "key": "subject_id"}, "Sample": {"file": "fields.tsv", "key": "sample_id"},
        "ExpressionObservation": {"file": "expression_observation.tsv", "key": "expression_observation_id", "dedup": False},
        "Gene": {"file": ["expression_observation.tsv", "variant_gene.tsv"], "key": "gene_id"},
        "Variant": {"file": "variation_observation.tsv", "key": "variant_id"}, "VariantObservation": {"file": "variation_observation.tsv", "key": "variant_observation_id"},
    },
    "edges": {
        "HOLDS_PLOT": {"file": "fields.tsv", "pair": ["Farm", "Sample"], "start_key": "subject_id", "end_key": "sample_id"},
        "HAS_EXPRESSION_OBSERVATION": {"file": "expression_observation.tsv", "pair": ["Sample", "ExpressionObservation"], "start_key": "sample_id", "end_key": "expression_observation_id", "dedup": False},
        "MEASURES_GENE": {"file": "expression_observation.tsv", "pair": ["ExpressionObservation", "Gene"], "start_key": "expression_observation_id", "end_key": "gene_id"},
        "OBSERVED_VARIANT": {"file": "variation_observation.tsv", "pair": ["VariantObservation", "Variant"], "start_key": "variant_observation_id", "end_key": "variant_id"},
        "IS_WITHIN_GENE": {"file": "variant_gene.tsv", "pair": ["Variant", "Gene"], "start_key": "variant_id", "end_key": "gene_id"},
    },
}


def test_from_files_to_a_clean_graph(session, tmp_path):
    raw, interim, out = (str(tmp_path / n) for n in ("raw", "interim", "out"))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "fields.tsv").write_text("sample_id\tsubject_id\twork\tground\nnorth\tK4\tdairy\tclay\nsouth\tK4\tunknown\tnone\n")
    (tmp_path / "raw" / "crop.tsv").write_text("gene_id\tnorth\tsouth\tunlisted\nENSG71.5\t0\t3.25\t4\nENSG86.3\t11\t\t4\n")
    (tmp_path / "raw" / "calls.vcf").write_text(
        '##INFO=<ID=CSQ,Description="Format: Allele|Gene">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tnorth\tsouth\n7\t940\t.\tC\tT,A\t.\tPASS\tCSQ=T|ENSG55.2,A|ENSG56\tGT\t0|1\t0/0\n'
    )
    profile = Profile.of("p", {"p": PROFILE}.__getitem__)
    summary = {(r.kind, r.name): (r.status, r.n_rows) for r in pipeline.standardise_dataset(session, GRAPH, profile, "D", raw, interim, out).collect()}
    # The zero of ENSG71 in north is no observation; the unlisted sample and the allele nobody carries are gone.
    assert summary["node", "ExpressionObservation"] == ("bound", 2) and summary["node", "Gene"] == ("bound", 3)
    assert summary["node", "Farm"] == ("bound", 1) and summary["edge", "IS_WITHIN_GENE"] == ("bound", 1) and summary["node", "Variant"] == ("bound", 1)
    assert summary["reshape", "lost.tsv"][0] == "skipped" and summary["reshape", "crop.tsv"][0] == "reshaped"
    report = pipeline.validate_dataset(session, GRAPH, out).first()
    assert report.problems == 0 and report.node_types == 6 and report.unknown_tables == ""
    store = str(tmp_path / "store")
    dropped = pipeline.fold_dataset(session, GRAPH, out, out, store)
    assert dropped.count() == 0
    again = pipeline.validate_dataset(session, GRAPH, store).first()
    assert Counter(again.asDict()) == Counter(report.asDict())


@pytest.mark.parametrize("split", ["64", "128m"])
def test_row_order_of_several_files(session, tmp_path, split):
    """First-wins and later-overrides follow file and line, however the files are cut."""
    raw, interim, out = (str(tmp_path / n) for n in ("raw", "interim", "out"))
    (tmp_path / "raw" / "fields.tsv").mkdir(parents=True)
    for name in ("b", "a"):
        lines = "".join(f"s{k % 5}\tK{k % 3}\t{name}{k:02}\tsand\n" for k in range(40))
        (tmp_path / "raw" / "fields.tsv" / f"{name}.tsv").write_text("sample_id\tsubject_id\twork\tground\n" + lines)
    base = {"aliases": {"work": "trade"}, "nodes": {"Farm": {"file": "fields.tsv", "key": "subject_id"}}}
    before = session.conf.get("spark.sql.files.maxPartitionBytes")
    session.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pipeline.standardise_dataset(session, GRAPH, Profile.of("p", {"p": base}.__getitem__), "D", raw, interim, out).collect()
        got = {tuple(r) for r in session.read.parquet(f"{out}/nodes/Farm.parquet").select("farmId", "trade").collect()}
        assert got == {("K0", "a00"), ("K1", "a01"), ("K2", "a02")}
        every = Profile.of("p", {"p": {**base, "nodes": {"Farm": {**base["nodes"]["Farm"], "dedup": False}}}}.__getitem__)
        nodes, _, _ = bind.standardise(session, GRAPH, every, lambda name: readers.resolve_source(session, name, interim, raw, ordered=True))
        batch = str(tmp_path / "batch")
        (tmp_path / "batch" / "nodes" / "Farm.csv").mkdir(parents=True)
        (tmp_path / "batch" / "edges").mkdir()
        for name in ("b", "a"):
            (tmp_path / "batch" / "nodes" / "Farm.csv" / f"{name}.csv").write_text("farmId,trade\n" + "".join(f"K{k % 3},{name}{k:02}\n" for k in range(40)) + "K9,\n")
        pipeline.fold_dataset(session, GRAPH, out, batch, str(tmp_path / "store"))
        assert nodes["Farm"].count() == 80
        got = {tuple(r) for r in session.read.parquet(str(tmp_path / "store" / "nodes" / "Farm.parquet")).select("farmId", "trade").collect()}
        assert got == {("K0", "b39"), ("K1", "b37"), ("K2", "b38"), ("K9", None)}
    finally:
        session.conf.set("spark.sql.files.maxPartitionBytes", before)
