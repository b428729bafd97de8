import gzip
from collections import Counter

import pytest
from pyspark.sql import functions as F

from braidwork.functions import text as fx
from braidwork.operators import audit, bind, flatten, fold, match, omics, reshape
from braidwork.plans.schema import Binding, Graph, Profile
from braidwork.sources import readers, writers

GRAPH = Graph.of(
    {
        "Farm": {"id": "farmId", "properties": ["ownerKind"]},
        "Plot": {"id": "plotId", "properties": ["soil", {"acidity": "float"}]},
        "Tool": {"id": "toolId", "properties": ["maker"], "subtypeLabels": ["Digger", "Cutter"], "subtypeFrom": "uses"},
        "Condition": {"id": "conditionId", "properties": []},
    },
    {"HOLDS_PLOT": {"pairs": [["Farm", "Plot"]], "properties": ["tenure"]}, "USED_ON": {"pairs": [["Plot", "Tool"], ["Farm", "Tool"]], "properties": [{"wear": "double"}]}},
)


def rows(df):
    return Counter(map(tuple, df.collect()))


def frame(session, names, *data):
    return session.createDataFrame(list(data), ", ".join(f"`{n}` string" for n in names.split()))


def test_text_functions(session):
    cells = ["  a b \t", "N/A", None, "--", " Not Reported", "x"]
    out = session.createDataFrame([(c,) for c in cells], "c string").select(fx.scrub(F.col("c"))).collect()
    assert [r[0] for r in out] == ["a b", "", "", "", "", "x"]
    zero = {"0": True, "0.000": True, "-0.0e5": True, " 0 ": True, "0d": False, "0x0": False, "": False, "1": False, "NA": False}
    got = session.createDataFrame([(k,) for k in zero], "c string").select("c", fx.is_zero(F.col("c"))).collect()
    assert {r[0]: r[1] for r in got} == zero
    pairs = [("1", "32", "0.0312"), ("1", "160", "0.0063"), ("3", "0", ""), ("x", "5", ""), ("1", "y", ""), ("5", "10", "0.5000"), ("1", "-4", "")]
    vaf = session.createDataFrame(pairs, "a string, d string, w string").select("w", fx.ratio_text(F.col("a"), F.col("d"))).collect()
    assert all(r[0] == r[1] for r in vaf)
    ids = frame(session, "a b", ("x", "y"), ("x", " NA "), (None, "y")).select(fx.mint_id([F.col("a"), F.col("b")]), fx.fallback_id([F.col("a"), F.col("b")])).collect()
    assert [tuple(r) for r in ids] == [("x:y", "x:y"), ("", "x: NA "), ("", "unknown:y")]
    assert frame(session, "a", ("C-1",), ("D-1",)).select(fx.strip_prefix(F.col("a"), "C-")).collect()[0][0] == "1"


CASE = (
    "case_id string, submitter_id string, primary_site string, project struct<project_id:string,name:string,program:struct<name:string,program_id:string>>, "
    "demographic struct<vital_status:string,age_at_index:int>, diagnoses array<struct<diagnosis_id:string,stage:string,treatments:array<struct<treatment_id:string,ok:boolean>>,"
    "pathology_details:array<struct<pathology_detail_id:string>>>>, follow_ups array<struct<follow_up_id:string>>, exposures array<struct<exposure_id:string>>, "
    "samples array<struct<sample_id:string,submitter_id:string,sample_type:string,portions:array<struct<analytes:array<struct<aliquots:array<struct<aliquot_id:string,submitter_id:string,sample_type:string>>>>>>>>"
)


@pytest.fixture(scope="module")
def cases(session):
    portions = [([([("a1", "b1", "own"), ("a2", "b2", None)],)],)]
    full = ("c1", "s1", "lung", ("P1", "Project", ("PR", "x")), ("alive", 50), [("d1", "II", [("t1", True)], [("p1",)]), ("d2", None, None, [])], [("f1",)], [("e1",)], [("sm1", "sub1", "Primary", portions)])
    return session.createDataFrame([full, ("c2", None, None, None, None, [("d3", "I", [("t2", None)], None)], None, [("e2",)], []), ("c3", "s3", None, None, None, None, None, [("e3",)], None)], CASE)


def test_flatten(cases):
    assert {n: df.count() for n, df in flatten.emit_all(cases).items()} == {
        "subject": 3, "diagnosis": 3, "pathology_detail": 1, "follow_up": 1, "exposure": 3, "other_clinical_attribute": 0, "sample": 2, "treatment": 3, "program": 1, "study": 1,
    }
    t = flatten.treatments(cases).select("case_id", "treatment_id", "sample_id", "diagnosis_id")
    assert rows(t) == Counter([("c1", "t1", "a1", "d1"), ("c1", "t1", "a2", "d1"), ("c2", "t2", "", "d3")])
    s = {r.sample_id: r.asDict() for r in flatten.samples(cases).collect()}
    assert s["a1"]["sample_type"] == "own" and s["a2"]["sample_type"] == "" and s["a1"]["gdc_sample_id"] == "sm1" and s["a1"]["sample_submitter_id"] == "b1"
    assert {r.exposure_id: r.diagnosis_id for r in flatten.exposures(cases).collect()} == {"e1": "d1", "e2": "d3", "e3": ""}
    subject = {r.case_id: r.asDict() for r in flatten.subjects(cases).collect()}
    assert subject["c1"]["project.program.name"] == "PR" and subject["c1"]["demographic.age_at_index"] == "50" and subject["c2"]["case_submitter_id"] == ""
    assert flatten.studies(cases).first().asDict()["program_name"] == "PR"


def test_per_sample_files(session, tmp_path):
    head = "gene_id\tgene_name\tgene_type\tunstranded\tstranded_first\tstranded_second\ttpm_unstranded\tfpkm_unstranded\tfpkm_uq_unstranded\n"
    for k, body in enumerate(("G1.2\tA\tx\t1\t1\t1\t2.5\t1\t1\nG2.1\tB\tx\t1\t1\t1\t0.0000\t1\t1\nshort\n", "G1.2\tA\tx\t1\t1\t1\t\t1\t1\n")):
        d = tmp_path / "expr" / f"f{k}"
        d.mkdir(parents=True)
        (d / f"x{k}.tsv").write_text("# note\n" + "N_unmapped\t1\t1\n" * 1 + head + body)
    leaf = [([([([([(f"al{k}",)],)],)],)],) for k in range(2)]
    schema = "file_id string, file_name string, platform string, experimental_strategy string, analysis struct<workflow_type:string>, cases array<struct<samples:array<struct<portions:array<struct<analytes:array<struct<aliquots:array<struct<aliquot_id:string>>>>>>>>>>"
    files = session.createDataFrame([(f"f{k}", f"x{k}.tsv", None, "RNA-Seq", ("STAR",), [([([([([(f"al{k}",)],)],)],)],)]) for k in range(2)], schema)
    assert leaf
    prov = omics.file_provenance(files)
    got = omics.expression_observations(readers.read_star_counts(session, str(tmp_path / "expr" / "*")), prov, "D")
    assert got.columns == omics.EXPRESSION
    assert rows(got.select("expression_observation_id", "expression_value", "assay_id")) == Counter([("al0:G1", "2.5", "unknown:RNA-Seq:STAR"), ("al1:G1", "", "unknown:RNA-Seq:STAR")])
    beta = tmp_path / "beta"
    for k, text in enumerate(("Composite Element REF\tBeta_value\tChromosome\tStart\tEnd\tGene_Symbol\ncg1\t0\t.\t.\t5\tTP53\n", "cg2\t0.5\nbad\n")):
        (beta / f"f{k}").mkdir(parents=True)
        (beta / f"f{k}" / "b.txt").write_text(text)
    m = omics.methylation_observations(readers.read_beta_values(session, str(beta / "*")), prov)
    assert rows(m.select("cpg_id", "beta_value", "chromosome", "gene_symbol")) == Counter([("unknown:cg1", "0", "", "TP53"), ("unknown:cg2", "0.5", "", "")])
    maf = tmp_path / "maf" / "f0"
    maf.mkdir(parents=True)
    names = list(readers.MAF_FIELDS.values())
    line = lambda **kw: "\t".join(kw.get(n, "") for n in names)
    one = dict(Chromosome="1", Start_Position="5", Reference_Allele="A", Tumor_Seq_Allele2="-", Tumor_Sample_Barcode="B1", Gene="G.1", t_depth="32", t_alt_count="1")
    with gzip.open(maf / "m.maf.gz", "wt") as f:
        f.write("#v\n" + "\t".join(names) + "\n" + "\n".join([line(**one), line(**(one | {"Tumor_Sample_Barcode": "B2"})), line(**(one | {"Chromosome": ""})), line(**(one | {"Tumor_Sample_Barcode": ""}))]) + "\n")
    v = omics.variation_observations(readers.read_maf(session, str(maf)), prov, frame(session, "barcode uuid", ("B1", "U1")))
    assert rows(v.select("variant_observation_id", "variant_allele_frequency", "gene_id")) == Counter([("U1:1:5:A:-", "0.0312", "G"), ("B2:1:5:A:-", "0.0312", "G")])


def test_survival(session):
    p = frame(session, "PATIENT_ID OS_STATUS OS_MONTHS DFS_STATUS DFS_MONTHS", ("p1", "1:DEAD", "2", "0:FREE", ""), ("p2", "0:ALIVE", "1", "", "3"), ("p9", "1:X", "1", "", ""))
    cross = frame(session, "case_id case_submitter_id", ("c1", "p1"), ("c2", "p2"))
    assert rows(omics.survival_endpoints(p, cross)) == Counter([("c1", "p1", "c1:OS", "OS", "1", "61"), ("c2", "p2", "c2:OS", "OS", "0", "30")])
    assert omics.unmatched_patients(p, cross).count() == 1


def test_matrix(session, tmp_path):
    # A header row that stands again among the data is data: only the first line is the header.
    (tmp_path / "yield.tsv").write_text('crop\tnorth\tsouth\t"far field"\tremark\nENSG77.3\t0\t4.75\t6\tdry\nENSG81.2\t\t12\nbarley\t8\ncrop\tnorth\tsouth\t"far field"\tremark\n\t5\t5\n')
    spec = dict(type="matrix", input="yield.tsv", observation="expression", feature_id_column="crop", feature_id_type="ensembl", unit="t", ignore_columns=["remark"], assay={"assay_id": "scale", "platform": "trailer"})
    known = frame(session, "sample_id", ("south",), ("north",))
    got, lost, why = reshape.reshape(session, spec, str(tmp_path), known, "D")
    assert why == "" and got.columns == [*omics.EXPRESSION, "platform"]
    assert rows(got.select("expression_observation_id", "expression_value")) == Counter([
        ("north:ENSG77", "0"), ("south:ENSG77", "4.75"), ("south:ENSG81", "12"), ("north:barley", "8"), ("north:crop", "north"), ("south:crop", "south"),
    ])
    assert rows(lost) == Counter([("far field",)])
    assert reshape.reshape(session, spec | {"input": "none.tsv"}, str(tmp_path))[2] == "source not found"
    assert "not in header" in reshape.reshape(session, spec | {"feature_id_column": "id"}, str(tmp_path))[2]
    (tmp_path / "turned.tsv").write_text("field\twheat\trye\nnorth\t0.35\t\nsouth\t0.6\t0.9\n")
    turned = dict(type="matrix", input="turned.tsv", observation="methylation", orientation="samples_x_genes", feature_id_column="field")
    m, _, _ = reshape.reshape(session, turned, str(tmp_path))
    assert rows(m.select("methylation_observation_id", "source_cpg_id", "beta_value")) == Counter([("north:unknown:wheat", "wheat", "0.35"), ("south:unknown:wheat", "wheat", "0.6"), ("south:unknown:rye", "rye", "0.9")])
    assert rows(reshape.odd_features(frame(session, "g", (" ENSG1 ",), ("oat",), ("",), ("oat",)), "g")) == Counter([("oat",)])
    with pytest.raises(ValueError):
        reshape.reshape(session, {"type": "x", "input": "yield.tsv"}, str(tmp_path))


def test_vcf(session, tmp_path):
    text = (
        '##INFO=<ID=CSQ,Number=.,Description="x Format: Allele|Consequence|Gene">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2\n'
        "1\t10\t.\tAT\tG,C\t.\tPASS\tDP=3;CSQ=G|m|E1.2,C|m|E2.1,G|n|E1.3,T|m|E9\tDP:GT\t3:1/2\t1:0|1\n1\t20\t.\tA\tT\t.\tq10\tCSQ=T|m|E5\tGT\t0/0\t./.\n1\t30\t.\tA\tT\t.\tPASS\tX\tDP\t1\t1\nshort\t1\n"
    )
    (tmp_path / "v.vcf").write_text(text)
    obs, genes, _ = reshape.reshape(session, {"type": "vcf", "input": "v.vcf", "assay": {"assay_id": "w"}}, str(tmp_path))
    assert rows(obs.select("variant_observation_id", "position_end", "assay_id")) == Counter([("S1:1-10-AT-G", "11", "w"), ("S1:1-10-AT-C", "11", "w"), ("S2:1-10-AT-G", "11", "w")])
    assert rows(genes) == Counter([("1-10-AT-G", "E1"), ("1-10-AT-C", "E2")])


PROFILE = Profile.of("p", {"p": {"aliases": {"trade": "ownerKind"}, "nodes": {
    "Farm": {"file": "farms", "key": "farm_no", "strip_prefix": "F/"}, "Plot": {"file": "plots", "key": "plot_no", "props": {"soil": "ground"}},
    "Tool": {"file": "shed", "key": "t"}, "Barn": {"file": "farms", "key": "farm_no"}, "Condition": {"file": "farms", "key": None},
}, "edges": {"HOLDS_PLOT": {"file": "plots", "pair": ["Farm", "Plot"], "start_key": "farm_no", "end_key": "plot_no", "strip_start_prefix": "F/"}}}}.__getitem__)


def test_standardise_and_audit(session):
    tables = {
        "farms": frame(session, "farm_no trade icd_10_code", ("F/31", "unknown", "Q7"), ("F/31", "dairy", ""), ("\t", "mixed", "Q9"), ("58", "  fruit", "Q7")),
        "plots": frame(session, "plot_no farm_no ground tenure", ("p4", "F/31", "N/A", "owned"), ("p4", "F/31", "clay", "let"), ("p9", "77", "sand", "")),
    }
    for n in (1, 3):
        dealt = {k: v.coalesce(1).withColumn("at", F.monotonically_increasing_id()).repartition(n) for k, v in tables.items()}
        nodes, edges, status = bind.standardise(session, GRAPH, PROFILE, dealt.get, order="at")
        assert rows(nodes["Farm"]) == Counter([("31", ""), ("58", "fruit")])
        assert rows(nodes["Plot"].select("plotId", "soil")) == Counter([("p4", ""), ("p9", "sand")])
        assert rows(nodes["Condition"]) == Counter([("ICD10:Q7",), ("ICD10:Q9",)])
        assert rows(edges["HOLDS_PLOT"]) == Counter([("31", "p4", "Farm", "Plot", "owned"), ("77", "p9", "Farm", "Plot", "")])
    assert {(n, r) for _, n, s, r in status if s == "skipped"} == {("Tool", "no source"), ("Barn", "not in the graph")}
    assert {r.name: r.n_rows for r in bind.summary(session, nodes, edges, status).collect()}["Farm"] == 2
    report = audit.validation_report(GRAPH, nodes, edges).first()
    assert (report.node_types, report.node_ids, report.edges, report.problems) == (3, 6, 2, 1)
    assert audit.validation_report(GRAPH, nodes, edges, {"Farm": frame(session, "farmId", ("77",))}, strict=True).first().problems == 0
    with pytest.raises(ValueError):
        audit.validation_report(GRAPH, nodes, edges, strict=True)
    found = bind.binding_report(GRAPH, PROFILE, tables).collect()
    assert {r.entry for r in found} == {"property", "key", "unused", "skipped"}
    filled = {(r["name"], r.item): (r.column, r.how, r.fill_rate) for r in found if r.entry == "property"}
    assert filled["Farm", "ownerKind"] == ("trade", "rename", 0.75) and filled["Plot", "soil"] == ("ground", "choice", 2 / 3) and filled["Plot", "acidity"] == (None, "unmatched", None)


def test_zero_rows_and_no_dedup(session):
    g = Graph.of({"Gene": {"id": "geneId"}}, {})
    src = frame(session, "gene_id expression_value", ("a", "0.0"), ("b", "1"), ("b", "2"), ("c", ""))
    b = Binding("Gene", ("x",), ("gene_id",), dedup=False)
    assert rows(bind.bind_nodes(g, b, [src])) == Counter({("b",): 2, ("c",): 1})
    assert bind.bind_nodes(g, b, [frame(session, "other", ("x",))]) is None


def test_fold(session):
    old = frame(session, "farmId ownerKind", ("12", "dairy"), ("40", "wool"))
    new = frame(session, "farmId ownerKind", ("12", ""), ("40", "goats"), ("53", ""), ("", "bees"))
    once = fold.upsert_nodes(old, new, "farmId")
    assert rows(once) == rows(fold.upsert_nodes(once, new, "farmId")) == Counter([("12", "dairy"), ("40", "goats"), ("53", None)])
    edges = frame(session, "startId endId startLabel endLabel tenure", ("12", "p4", "Farm", "Plot", "let"), ("12", "p4", "Farm", "Plot", ""), ("88", "p4", "Farm", "Plot", ""), ("", "p4", "Farm", "Plot", ""), ("12", "p5", "Farm", "Plot", ""))
    ids = audit.known_ids({"Farm": old, "Plot": frame(session, "plotId", ("p4",))}, GRAPH)
    kept, lost = fold.upsert_edges(None, edges, ids)
    assert [r.tenure for r in kept.collect()] == ["let"] and lost.count() == 3 and lost.columns == edges.columns
    w = frame(session, "toolId maker uses", ("x1", "Ash", "Digger; Flyer"), ("x2", "Elm", ""), ("x3", "Oak", "Cutter,Digger"))
    assert rows(fold.group_by_labels(w, GRAPH.nodes["Tool"])) == Counter([("Tool", "Digger", 1), ("Tool", "", 1), ("Tool", "Cutter:Digger", 1)])
    assert fold.unique_key_check(w.union(w), "toolId").count() == 3


@pytest.mark.parametrize("n", [1, 8])
def test_repeated_ids_of_a_batch_follow_its_order(session, n):
    batch = session.createDataFrame([(k, f"{k % 3}", f"v{k:03}") for k in range(60)], "at long, farmId string, ownerKind string").repartition(n)
    assert rows(fold.upsert_nodes(None, batch, "farmId", "at")) == Counter([("0", "v057"), ("1", "v058"), ("2", "v059")])
    # Without an order the greatest value stays, on any number of partitions.
    assert rows(fold.upsert_nodes(None, batch.drop("at"), "farmId")) == Counter([("0", "v057"), ("1", "v058"), ("2", "v059")])


def test_bulk_and_graph_files(session, tmp_path):
    w = frame(session, "toolId maker uses", ("x1", "Ash", "Cutter"), (" ", "Elm", ""))
    out = writers.bulk_nodes(w, GRAPH, "Tool")
    assert out.columns == ["toolId:ID(Tool)", "maker", ":LABEL"] and rows(out) == Counter([("x1", "Ash", "Tool;Cutter")])
    links = frame(session, "startId endId startLabel endLabel wear", ("p4", "x1", "Plot", "Tool", "0.25"), ("31", "x1", "Farm", "Tool", ""))
    assert writers.bulk_edges(links, GRAPH, "USED_ON", "Plot", "Tool").columns == [":START_ID(Plot)", ":END_ID(Tool)", "wear:double"]
    assert rows(writers.edge_pairs(links)) == Counter([("Plot", "Tool", 1), ("Farm", "Tool", 1)])
    folder = str(tmp_path / "g")
    writers.write_graph({"Tool": w, "Odd": w}, {"USED_ON": links}, folder)
    nodes, edges, unknown = readers.read_graph(session, folder, GRAPH)
    assert set(nodes) == {"Tool"} and set(edges) == {"USED_ON"} and unknown == ["nodes/Odd"]
    manifest, constraints = writers.bulk_manifest(session, {"d1": (nodes, edges), "d2": (nodes, {})}, GRAPH)
    assert manifest.count() == 4 and constraints == [("Tool", "toolId")]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "t.csv").write_text('note,rest\n"a ""low"" shed",\n')
    assert rows(readers.resolve_source(session, "t.csv", str(tmp_path / "interim"), str(tmp_path / "raw"))) == Counter([('a "low" shed', "")])
    assert readers.resolve_source(session, "no.csv", folder, folder) is None


def test_entities_observations_and_metadata_files(session, cases, tmp_path):
    writers.write_entities(flatten.emit_all(cases), str(tmp_path / "e"))
    assert session.read.parquet(str(tmp_path / "e" / "diagnosis.parquet")).count() == 3
    writers.write_entities({"study": flatten.studies(cases)}, str(tmp_path / "t"), as_text=True)
    assert session.read.csv(str(tmp_path / "t" / "study.tsv"), sep="\t", header=True).columns[:3] == ["case_id", "case_submitter_id", "project_id"]
    obs = frame(session, "sample_id expression_value source_dataset extra", ("s", "2", "D", "x"), ("s", "3", "E", "y"))
    writers.write_observations(obs, omics.EXPRESSION, str(tmp_path / "o"))
    back = session.read.parquet(str(tmp_path / "o"))
    assert {p.name for p in (tmp_path / "o").iterdir() if p.is_dir()} == {"source_dataset=D", "source_dataset=E"} and set(back.columns) == {*omics.EXPRESSION, "extra"}
    (tmp_path / "page.json").write_text('{"data": {"hits": [{"case_id": "k1", "project": {"project_id": "P", "program": {"name": "G"}}}, {"case_id": "k2", "project": {"project_id": "Q", "program": {"name": "G"}}}]}}\n')
    page = str(tmp_path / "page.json")
    assert readers.read_cases(session, page, project="Q").first().case_id == "k2" and readers.read_cases(session, page, program="G").count() == 2
    (tmp_path / "files.json").write_text('{"file_id": "f1", "file_name": "n1", "md5sum": "m", "file_size": 7, "access": "open"}\n')
    files = readers.read_file_metadata(session, str(tmp_path / "files.json"))
    assert rows(writers.file_manifest(files)) == Counter([("f1", "n1", "m", 7, "validated")])
    known = frame(session, "file_id sample_id assay_id pipeline_version", ("f1", "s", "a", "v"))
    assert rows(writers.file_metadata(files, known)) == Counter([("f1", "n1", "s", "a", "v")]) and "sample_id" not in writers.file_metadata(files, known, False).columns
    (tmp_path / "surv.txt").write_text("# c\nPATIENT_ID\tOS_STATUS\tOS_MONTHS\np1\t1:DEAD\t\n")
    assert rows(readers.read_patient_survival(session, str(tmp_path / "surv.txt"))) == Counter([("p1", "1:DEAD", "")])
    assert rows(audit.endpoint_preflight(GRAPH, {"Farm": frame(session, "farmId", ("1",))}, {"HOLDS_PLOT": None})) == Counter([("Plot",)])


def test_manifest(session, tmp_path):
    for name in ("ok", "short"):
        (tmp_path / "f" / name).mkdir(parents=True)
        (tmp_path / "f" / name / "x").write_text("hello")
    m = session.createDataFrame([("ok", "x", "5d41402abc4b2a76b9719d911017c592", 5), ("short", "x", "bad", 5), ("gone", "x", "", 1)], "id string, filename string, md5 string, size long")
    assert rows(audit.verify_manifest(session, str(tmp_path / "f"), m, True).select("id", "status")) == Counter([("ok", "ok"), ("short", "md5 mismatch"), ("gone", "missing")])
    assert rows(audit.verify_manifest(session, str(tmp_path / "f"), m).select("status")) == Counter({("ok",): 2, ("missing",): 1})


def test_files_and_maps(session):
    schema = "n int, access string, cases array<struct<case_id:string,project:struct<project_id:string>,samples:array<struct<portions:array<struct<analytes:array<struct<aliquots:array<struct<aliquot_id:string,submitter_id:string>>>>>>>>>>"
    leaf = lambda a, b: [([([([(a, b)],)],)],)]
    files = session.createDataFrame([(1, "open", [("c1", ("P",), leaf("u1", "b1"))]), (2, "open", [("c1", ("P",), leaf("u2", "b1")), ("c2", ("Q",), leaf("", "b2"))]), (3, "closed", None)], schema)
    assert rows(flatten.aliquot_map(files, "n")) == Counter([("b1", "u2")])
    assert readers.file_selection(files, {"access": "open"}, project="Q").count() == 1
    assert readers.file_selection(files, {"access": "open"}, case_id="c1").count() == 2
    a, b = frame(session, "case_id", ("1",), ("2",), ("",)), frame(session, "case_id", ("2",), ("2",), ("",))
    assert rows(flatten.cohort_intersection({"x": a, "y": b}, ["case_id"])) == Counter([("2",)])


def test_patterns(session):
    g = Graph.of(
        {n: {"id": f"{n[0].lower()}{n[1:]}Id", "properties": p} for n, p in {
            "Gene": ["symbol"], "Variant": [], "VariantObservation": ["variantCaller"], "Sample": ["sampleClass"], "Subject": [], "Intervention": ["interventionName", "_subtypeLabel"], "ChemicalEntity": ["name"], "Survival": ["survivalType"],
        }.items()},
        {
            "IS_WITHIN_GENE": {"pairs": [["Variant", "Gene"]], "properties": ["geneRegion"]}, "OBSERVED_VARIANT": {"pairs": [["VariantObservation", "Variant"]]},
            "HAS_VARIANT_OBSERVATION": {"pairs": [["Sample", "VariantObservation"]]}, "PAIRED_WITH": {"pairs": [["Sample", "Sample"]], "properties": ["pairingType"]},
            "PROVIDED_SAMPLE": {"pairs": [["Subject", "Sample"]]}, "UNDERWENT_INTERVENTION": {"pairs": [["Sample", "Intervention"]]},
            "USES_AGENT": {"pairs": [["Intervention", "ChemicalEntity"]], "properties": ["agentRole"]}, "HAS_SURVIVAL_RECORD": {"pairs": [["Subject", "Survival"]]},
        },
    )
    edge = lambda a, b, la, lb: frame(session, "startId endId startLabel endLabel", (a, b, la, lb))
    nodes = {
        "Gene": frame(session, "geneId symbol", ("g1", "TP53"), ("g2", "X")), "Variant": frame(session, "variantId", ("v1",)), "VariantObservation": frame(session, "variantObservationId", ("o1",)),
        "Sample": frame(session, "sampleId sampleClass", ("s1", "tumor"), ("s2", "normal")), "Subject": frame(session, "subjectId", ("u1",)),
        "Intervention": frame(session, "interventionId _subtypeLabel", ("i1", "Drug"), ("i2", "Radiation")), "ChemicalEntity": frame(session, "chemicalEntityId name", ("e1", "aspirin")), "Survival": frame(session, "survivalId", ("v",)),
    }
    edges = {
        "IS_WITHIN_GENE": edge("v1", "g1", "Variant", "Gene").withColumn("geneRegion", F.lit("exon")), "OBSERVED_VARIANT": edge("o1", "v1", "VariantObservation", "Variant"),
        "HAS_VARIANT_OBSERVATION": edge("s1", "o1", "Sample", "VariantObservation"), "PAIRED_WITH": edge("s1", "s2", "Sample", "Sample").withColumn("pairingType", F.lit("barcode_match")),
        "PROVIDED_SAMPLE": edge("u1", "s1", "Subject", "Sample"), "UNDERWENT_INTERVENTION": edge("s1", "i1", "Sample", "Intervention").union(edge("s1", "i2", "Sample", "Intervention")),
        "USES_AGENT": edge("i9", "e1", "Intervention", "ChemicalEntity"), "HAS_SURVIVAL_RECORD": edge("u1", "v", "Subject", "Survival"),
    }
    t = match.Tables(g, nodes, edges)
    assert match.variants_within_gene(t, "TP53").first()[:3] == ("s1", "v1", "o1") and match.variants_within_gene(t, "TP53").first().geneRegion == "exon"
    assert match.paired_samples(t).first()[:4] == ("s1", "s2", "tumor", "normal") and match.paired_samples(t, ("other",)).count() == 0
    drug = match.drug_agents(t).collect()
    assert len(drug) == 1 and drug[0].interventionId == "i1" and drug[0].agentName is None
    assert match.survival_records(t).first().survivalId == "v"
    low, links = match.classify_methylation(frame(session, "methylationObservationId betaValue", ("1", "0.1"), ("2", "0.5"), ("3", "x")), "r", 0.2, 0.8)
    assert rows(low.select("methylationStatus")) == Counter([("hypomethylated",), ("intermediate",), ("",)]) and links.count() == 2
