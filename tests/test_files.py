"""Readers of files that differ from each other, bad records, rules and landed files."""

import hashlib
import random
import tracemalloc
from collections import Counter

import pytest

from braidwork.operators import audit, match, omics, reshape
from braidwork.sources import readers


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_genotype_files_with_other_samples(session, tmp_path):
    line = "##INFO=<ID=CSQ,Number=.,Description=\"Format: {}\">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{}\n1\t{}\t.\tA\tG\t.\tPASS\tCSQ={}\tGT\t{}\n"
    folder = tmp_path / "calls"
    folder.mkdir()
    (folder / "a.vcf").write_text(line.format("Allele|Gene", "S1\tS2", 5, "G|E1", "0/1\t0/0"))
    (folder / "b.vcf").write_text(line.format("Allele|x|Gene", "S3\tS1", 6, "G|no|E2", "1/1\t0/1"))
    (folder / "c.vcf").write_text("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS4\n1\t7\t.\tA\tG\t.\tPASS\tX\tGT\t1\n")
    obs, genes, why = reshape.reshape(session, {"type": "vcf", "input": "calls"}, str(tmp_path))
    assert why == "" and rows(obs.select("sample_id", "position_start")) == Counter([("S1", "5"), ("S3", "6"), ("S1", "6"), ("S4", "7")])
    assert rows(genes) == Counter([("1-5-A-G", "E1"), ("1-6-A-G", "E2")])


def test_matrices_with_other_headers(session, tmp_path):
    folder = tmp_path / "m"
    folder.mkdir()
    (folder / "a.tsv").write_text("id\tn\ts\nENSG1.2\t1\t2\nid\tn\ts\n")
    (folder / "b.tsv").write_text("s\t\"id\"\tfar\n3\tENSG9\t4\n")
    (folder / "c.tsv").write_text("id\tn\ts\nENSG3\t5\n")
    (folder / "d.tsv").write_text("other\tn\nx\t1\n")
    spec = dict(type="matrix", input="m", observation="expression", feature_id_column="id", feature_id_type="ensembl", unit="t")
    got, _, why = reshape.reshape(session, spec, str(tmp_path))
    assert rows(got.select("expression_observation_id", "expression_value")) == Counter([("n:ENSG1", "1"), ("s:ENSG1", "2"), ("n:id", "n"), ("s:id", "s"), ("s:ENSG9", "3"), ("far:ENSG9", "4"), ("n:ENSG3", "5")])
    assert "1 file" in why and "d.tsv" in why
    turned = spec | {"observation": "methylation", "orientation": "samples_x_genes"}
    assert ("ENSG9:unknown:far", "4") in rows(reshape.reshape(session, turned, str(tmp_path))[0].select("methylation_observation_id", "beta_value"))


@pytest.mark.parametrize("split", ["64", "128m"])
def test_headers_by_position_and_cut_files(session, tmp_path, split):
    before = session.conf.get("spark.sql.files.maxPartitionBytes")
    session.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for n, head in (("f1", "gene_id\ttpm_unstranded\tgene_name"), ("f2", "tpm_unstranded\tgene_id")):
            (tmp_path / "e" / n).mkdir(parents=True)
            cells = lambda k, h=head: "\t".join({"gene_id": f"G{k}", "tpm_unstranded": f"{k}", "gene_name": "n"}[c] for c in h.split("\t"))
            (tmp_path / "e" / n / "c.tsv").write_text(f"# note\nN_x\t1\n{head}\n" + "".join(cells(k) + "\n" for k in range(1, 60)) + "short\n")
        got = readers.read_star_counts(session, str(tmp_path / "e" / "*"))
        assert rows(got.select("gene_id", "tpm_unstranded", "gene_name")) == Counter([(f"G{k}", f"{k}", g) for k in range(1, 60) for g in ("n", "")])
    finally:
        session.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_over_several_lines(session, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    (folder / "a b.csv").write_text('id,note\n1,"two\nlines, ""quoted"""\n2,plain\n3,"a\n\nb"\n')
    (folder / "z.csv").write_text("id,note\n" + "".join(f"{k},n{k}\n" for k in range(10, 40)))
    plain, quoted = readers.files_by_line_ends(session, str(folder))
    assert [p.rsplit("/", 1)[1] for p in plain] == ["z.csv"] and [p.rsplit("/", 1)[1] for p in quoted] == ["a b.csv"]
    got = readers.read_raw_table(session, str(folder), ordered=True).orderBy(readers.ORDER_AT).select("id", "note").collect()
    assert [tuple(r) for r in got] == [("1", 'two\nlines, "quoted"'), ("2", "plain"), ("3", "a\n\nb"), *[(f"{k}", f"n{k}") for k in range(10, 40)]]
    assert readers.read_raw_table(session, str(folder / "z.csv")).count() == 30
    assert readers.read_raw_table(session, str(folder / "a b.csv")).count() == 3
    (tmp_path / "u.tsv").write_text('id\tnote\n1\t5" wide\n2\tx\n')  # a lone quote inside a cell is text
    assert rows(readers.read_raw_table(session, str(tmp_path / "u.tsv"))) == Counter([("1", '5" wide'), ("2", "x")])


def test_pages_by_a_declared_schema(session, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "one.json").write_text(
        '{"data": {"hits": [{"case_id": "a", "diagnoses": [{"diagnosis_id": "d1", "age_at_diagnosis": 7}], "unknown": 1}, {"case_id": "b", "project": {"project_id": "P", "program": {"name": "G"}}}]}}\n'
        '{"data": {"hits": [{"case_id": "c"\n\n{"data": {"hits": []}}\n'
    )
    (tmp_path / "p" / "two.json").write_text('{"case_id": "e", "samples": [{"portions": [{"analytes": [{"aliquots": [{"aliquot_id": "q"}]}]}]}]}\n{"case_id": "f", "demographic": {"days_to_birth": "soon"}}\nnot json\n')
    cases, bad = readers.read_pages(session, str(tmp_path / "p"), readers.case_schema({"diagnoses[]": ["stage"], "odd.part[]": ["x int"]}))
    assert {r.case_id for r in cases.collect()} == {"a", "b", "e"}
    assert cases.filter("case_id = 'a'").first().diagnoses[0].asDict()["age_at_diagnosis"] == 7
    assert cases.filter("case_id = 'e'").first().samples[0].portions[0].analytes[0].aliquots[0].aliquot_id == "q"
    assert {r.file.rsplit("/", 1)[1]: r.n_bad for r in readers.bad_report(bad).collect()} == {"one.json": 1, "two.json": 2}
    assert readers.of_project(cases, program="G").count() == 1
    assert "diagnoses[].treatments[]" in readers.CASE_PARTS and len(readers.CASE_PARTS) == 13
    assert set(readers.case_schema().names) >= {"case_id", "project", "demographic", "samples", "follow_ups"}


def slow_status(v, rule):
    h, t, a, b = rule
    if h is not None and v <= h:
        return "hypomethylated"
    if t is not None and v >= t:
        return "hypermethylated"
    if (h is None and a is None) or (t is None and b is None) or (a is not None and v < a) or (b is not None and v > b):
        return None
    return "intermediate"


@pytest.mark.parametrize("cells", [1, 7, 64])
def test_many_rules_against_all_pairs(session, cells):
    r = random.Random(cells)
    pick = lambda: r.choice([None, *[k / 8 for k in range(-1, 10)]])
    rules = [(f"r{k:02}", r.choice(["x", "y", None]), (pick(), pick(), pick(), pick())) for k in range(30)]
    values = [k / 16 for k in range(-4, 22)]
    obs = [(f"o{n}", "NA" if n % 11 == 0 else str(values[n % len(values)]), r.choice(["x", "y", "z", None])) for n in range(150)]
    show = lambda x: None if x is None else str(x)
    rule_table = session.createDataFrame([(i, p, *map(show, b)) for i, p, b in rules], "methylationStatusRuleId string, platformCode string, hypoThreshold string, hyperThreshold string, intermediateLowerBound string, intermediateUpperBound string")
    table = session.createDataFrame([(*o, "") for o in obs], "methylationObservationId string, betaValue string, platformCode string, methylationStatus string")
    out, edges = match.classify_by_rules(table, rule_table, cells=cells)
    want = [(o, i, s) for o, v, p in obs if v != "NA" and p is not None for i, q, b in rules if q == p and (s := slow_status(float(v), b))]
    assert rows(edges.select("startId", "endId", "status")) == Counter(want)
    first = {}
    for o, i, s in sorted(want, key=lambda w: w[1]):
        first.setdefault(o, s)
    assert {r.methylationObservationId: r.methylationStatus for r in out.collect()} == {o: first.get(o, "") for o, *_ in obs}
    assert out.columns[:3] == table.columns[:3] and out.count() == 150


def test_sums_of_large_files_are_streamed(session, tmp_path):
    big = bytes(range(256)) * 4096 * 20  # 20 MB
    for name, data in (("ok", b"hello"), ("big", big), ("bad", b"hellO"), ("short", b"hell"), ("empty", b"")):
        (tmp_path / "f" / name).mkdir(parents=True)
        (tmp_path / "f" / name / "x y").write_bytes(data)
    md5 = lambda b: hashlib.md5(b).hexdigest()
    m = session.createDataFrame([(n, "x y", md5(d), len(d)) for n, d in (("ok", b"hello"), ("big", big), ("bad", b"hello"), ("short", b"hello"), ("empty", b""), ("gone", b"x"))], "id string, filename string, md5 string, size long")
    want = {"ok": "ok", "big": "ok", "bad": "md5 mismatch", "short": "size mismatch", "empty": "ok", "gone": "missing"}
    got = audit.verify_manifest(session, str(tmp_path / "f"), m, True)
    assert {r.id: r.status for r in got.collect()} == want
    tracemalloc.start()
    with audit.open_landed(f"file:{tmp_path}/f/big/x y") as f:
        h = hashlib.md5()
        while part := f.read(1 << 20):
            h.update(part)
    assert tracemalloc.get_traced_memory()[1] < 8 << 20 and h.hexdigest() == md5(big)
    tracemalloc.stop()
    assert omics.EXPRESSION  # the contract's columns
