"""Registered queries over measurement lines, nested records and the documented patterns,
built from the star-schema tables, each with the DuckDB SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.operators import audit, bind, flatten, fold, match, omics, reshape
from braidwork.plans.schema import Graph, Profile
from braidwork.sources import readers, writers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _join(*parts) -> Column:
    return F.concat_ws("\t", *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _lines(body: DataFrame, suppliers: DataFrame, value: Column, heads: list[tuple[Column, Column]]) -> DataFrame:
    """Lines of one file a supplier: the head lines, each for the suppliers it is for, and
    one line for each row of lineitem."""
    path = lambda c: F.concat(F.lit("landed/f"), F.col(c), F.lit("/part.txt"))
    at = lambda n: F.struct(F.lit(0).cast("long").alias("block"), n.cast("long").alias("line"))
    out = body.select(value.alias("value"), path("l_suppkey").alias("file_path"), at(F.col("l_orderkey") * 10 + F.col("l_linenumber") + 10).alias("at"))
    for k, (line, where) in enumerate(heads):
        out = out.unionByName(suppliers.filter(where).select(line.alias("value"), path("s_suppkey").alias("file_path"), at(F.lit(k)).alias("at")))
    return out


def _files(spark, sf_dir) -> DataFrame:
    """File records, one a supplier, with nested cases down to aliquots."""
    s = F.col("s_suppkey")
    aliquot = F.struct(F.concat(F.lit("al"), s).alias("aliquot_id"), F.concat(F.lit("b"), s).alias("submitter_id"))
    nested = F.array(F.struct(F.array(F.struct(F.when(s % 5 == 0, F.array().cast("array<struct<aliquot_id:string,submitter_id:string>>")).otherwise(F.array(aliquot)).alias("aliquots"))).alias("analytes")))
    sample = F.struct(nested.alias("portions"))
    platform = F.when(s % 4 == 0, "Illumina Human Methylation 450").when(s % 4 == 1, "Illumina Methylation Epic").when(s % 4 == 2, "NovaSeq")
    return _table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("f"), s).alias("file_id"), F.concat(F.lit("n"), s).alias("file_name"), F.md5(_text("s_suppkey")).alias("md5sum"), (s * 7).alias("file_size"),
        platform.alias("platform"), F.lit("RNA-Seq").alias("experimental_strategy"), F.struct(F.lit("STAR").alias("workflow_type")).alias("analysis"),
        F.array(F.struct(F.array(sample).alias("samples"))).alias("cases"), s.alias("at"),
    )


def expression_lines(spark, sf_dir):
    items, sup = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "supplier")
    tpm = F.when(F.col("l_linenumber") == 3, "0.00").when(F.col("l_linenumber") == 4, "").otherwise(F.col("l_quantity").cast("long").cast("string"))
    value = F.when(F.col("l_linenumber") == 2, "short").otherwise(_join(F.concat(F.lit("ENSG"), "l_partkey", F.lit(".2")), "n", "x", "1", tpm))
    heads = [(F.lit("# note"), F.lit(True)), (_join("N_unmapped", "1"), F.lit(True)), (_join("gene_id", "gene_name", "gene_type", "unstranded", "tpm_unstranded"), F.lit(True))]
    rows = omics.expression_observations(readers.star_counts(_lines(items, sup, value, heads)), omics.file_provenance(_files(spark, sf_dir)), "D")
    return rows.select("expression_observation_id", "expression_value", "expression_unit", "assay_id", "source_file", "pipeline_version")


def methylation_lines(spark, sf_dir):
    items, sup = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "supplier")
    probe, beta = F.concat(F.lit("cg"), "l_partkey"), F.format_string("%.2f", "l_discount")
    chrom = F.when(F.col("l_linenumber") % 2 == 0, ".").otherwise(F.concat(F.lit("chr"), "l_linenumber"))
    value = F.when(F.col("l_suppkey") % 2 == 0, _join(probe, beta, chrom, ".", "e", F.concat(F.lit("G"), "l_partkey"))).otherwise(_join(probe, beta))
    head = _join("Composite Element REF", "Beta_value", "Chromosome", "Start", "End", "Gene_Symbol")
    rows = readers.beta_values(_lines(items, sup, value, [(head, F.col("s_suppkey") % 2 == 0)]))
    out = omics.methylation_observations(rows, omics.file_provenance(_files(spark, sf_dir), F.lit("beta")), "D")
    return out.select("methylation_observation_id", "source_cpg_id", "beta_value", "platform_code", "chromosome", "start_position", "gene_symbol", "assay_id")


def variation_lines(spark, sf_dir):
    items, sup = _table(spark, sf_dir, "lineitem"), _table(spark, sf_dir, "supplier")
    barcode = F.concat(F.lit("b"), F.col("l_orderkey") % 200)
    chrom = F.when(F.col("l_linenumber") == 2, "").otherwise("7")
    value = _join(chrom, _text("l_orderkey"), "A", "T", barcode, F.concat(F.lit("G"), "l_partkey", F.lit(".1")), F.col("l_quantity").cast("long").cast("string"), _text("l_linenumber"))
    head = _join("Chromosome", "Start_Position", "Reference_Allele", "Tumor_Seq_Allele2", "Tumor_Sample_Barcode", "Gene", "t_depth", "t_alt_count")
    calls = readers.maf_calls(_lines(items, sup, value, [(F.lit("#v"), F.lit(True)), (head, F.lit(True))]))
    files = _files(spark, sf_dir)
    keep = calls.select("barcode").distinct().filter("barcode <> 'b7'")
    out = omics.variation_observations(calls, omics.file_provenance(files), flatten.aliquot_map(files, "at"), keep)
    return out.select("variant_observation_id", "sample_id", "gene_id", "variant_allele_frequency", "somatic_status", "source_file")


def aliquot_map(spark, sf_dir):
    return flatten.aliquot_map(_files(spark, sf_dir), "at")


def melt_samples(spark, sf_dir):
    """Suppliers as lines of a matrix of samples, one column a return flag."""
    flags = ("A", "N", "R")
    rows = _table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(*[F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity").cast("long"))).cast("string").alias(f) for f in flags])
    lines = rows.select(_join(F.concat(F.lit("S"), "l_suppkey"), *[F.coalesce(f, F.lit("")) for f in flags]).alias("value"))
    long = reshape.melt_lines(lines, ["sample_id", *flags], "sample_id", rows_are="samples")
    return reshape.observations(long, "methylation", assay={"platform_code": "450k"}).select("methylation_observation_id", "cpg_id", "source_cpg_id", "beta_value")


def odd_features(spark, sf_dir):
    p = _table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("ENSG"), "p_partkey")).otherwise(F.concat(F.lit(" "), "p_brand")).alias("g"))
    return reshape.odd_features(p, "g")


def _cases(spark, sf_dir):
    key = F.lpad(_text("o_orderkey"), 12, "0")
    details = F.when(F.col("o_orderstatus") == "F", F.array(F.struct(F.concat(F.lit("pd"), "o_orderkey").alias("pathology_detail_id"), F.col("o_orderpriority").alias("grade"))))
    diagnosis = F.struct(key.alias("diagnosis_id"), details.alias("pathology_details"))
    follow = F.struct(key.alias("follow_up_id"), (F.col("o_orderkey") % 900).alias("days"))
    o = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(diagnosis)).alias("diagnoses"), F.sort_array(F.collect_list(follow)).alias("follow_ups"))
    c, k = _table(spark, sf_dir, "customer"), F.col("c_custkey")
    project = F.struct(F.when(k % 4 > 0, F.concat(F.lit("P"), "c_nationkey")).alias("project_id"), F.col("c_mktsegment").alias("name"), F.lit("open").alias("state"), F.struct(F.lit("G").alias("name")).alias("program"))
    return c.join(o, k == F.col("o_custkey"), "left").select(
        _text("c_custkey").alias("case_id"), F.col("c_name").alias("submitter_id"), project.alias("project"), "diagnoses", "follow_ups",
        F.array(F.struct(F.concat(F.lit("e"), k).alias("exposure_id"), F.col("c_acctbal").cast("decimal(18,2)").alias("dose"))).alias("exposures"),
        F.array(F.struct(F.concat(F.lit("x"), k).alias("attribute_id")), F.struct(F.lit(None).cast("string").alias("attribute_id"))).alias("other_clinical_attributes"),
    )


def flatten_pathology(spark, sf_dir):
    return flatten.pathology_details(_cases(spark, sf_dir))


def flatten_follow_ups(spark, sf_dir):
    return flatten.follow_ups(_cases(spark, sf_dir))


def flatten_exposures(spark, sf_dir):
    return flatten.exposures(_cases(spark, sf_dir))


def flatten_attributes(spark, sf_dir):
    return flatten.other_clinical_attributes(_cases(spark, sf_dir))


def flatten_studies(spark, sf_dir):
    return flatten.studies(_cases(spark, sf_dir))


def file_manifest(spark, sf_dir):
    return writers.file_manifest(_files(spark, sf_dir))


def file_metadata(spark, sf_dir):
    files = _files(spark, sf_dir)
    return writers.file_metadata(files, omics.file_provenance(files))


def manifest_audit(spark, sf_dir):
    """Documents as landed files against a manifest with wrong sizes, sums and absent ones."""
    d, k = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), F.col("doc_id")
    ident = [_text("doc_id").alias("id"), F.lit("text").alias("filename")]
    landed = d.filter(k % 11 > 0).select(*ident, F.octet_length("text").alias("landed_size"), F.md5("text").alias("landed_md5"))
    manifest = d.select(*ident, F.when(k % 7 == 0, "0").otherwise(F.upper(F.md5("text"))).alias("md5"), (F.octet_length("text") + F.when(k % 5 == 0, 1).otherwise(0)).alias("size"))
    return audit.compare_manifest(manifest, landed, True).groupBy("status").agg(F.count("*").alias("n_rows"))


STAR = Graph.of(
    {"Order": {"id": "orderId"}, "Part": {"id": "partId", "properties": ["name", {"size": "int"}], "subtypeLabels": ["Brand#11", "Brand#22"], "subtypeFrom": "labels"}, "Customer": {"id": "customerId", "properties": ["name", "segment"]}},
    {"HAS_PART": {"pairs": [["Order", "Part"]]}, "PLACED": {"pairs": [["Customer", "Order"]], "properties": ["orderPriority"]}},
)


def _nodes(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(_text("o_orderkey").alias("orderId"))
    p = _table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 9 > 0, _text("p_partkey")).otherwise(" ").alias("partId"), F.col("p_name").alias("name"), _text("p_size").alias("size"), F.concat_ws(":", "p_brand", "p_type").alias("labels"))
    return {"Order": o, "Part": p}


def _edges(spark, sf_dir):
    placed = _table(spark, sf_dir, "orders").select(_text("o_custkey").alias("startId"), _text("o_orderkey").alias("endId"), F.lit("Customer").alias("startLabel"), F.lit("Order").alias("endLabel"))
    return {"PLACED": placed}


def bulk_part_nodes(spark, sf_dir):
    return writers.bulk_nodes(_nodes(spark, sf_dir)["Part"], STAR, "Part")


def bulk_manifest(spark, sf_dir):
    nodes, edges = _nodes(spark, sf_dir), _edges(spark, sf_dir)
    return writers.bulk_manifest(spark, {"one": (nodes, edges), "two": ({"Part": nodes["Part"]}, {})}, STAR)[0]


def endpoint_preflight(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    return audit.endpoint_preflight(STAR, {"Order": nodes["Order"], "Part": nodes["Part"].filter("partId = 'none'")}, {**_edges(spark, sf_dir), "HAS_PART": None})


def audit_undeclared(spark, sf_dir):
    nodes, placed = _nodes(spark, sf_dir), _edges(spark, sf_dir)["PLACED"]
    found = audit.problems(STAR, {"Order": nodes["Order"], "Ship": nodes["Order"], "Part": nodes["Part"].drop("partId")}, {"PLACED": placed, "SAILS": placed})
    return found.groupBy("table", "key", "kind").agg(F.sum("n").alias("n"))


def unique_keys(spark, sf_dir):
    return fold.unique_key_check(_table(spark, sf_dir, "lineitem").select(_text("l_suppkey").alias("id")), "id")


PROFILES = {
    "star": {"include": ["base", "star"], "aliases": {"o_orderpriority": "orderPriority"}, "edges": {"PLACED": {"file": "orders", "pair": ["Customer", "Order"], "start_key": "o_custkey", "end_key": "o_orderkey"}, "HAS_PART": {"file": "gone", "start_key": "a", "end_key": "b"}, "SAILS": {"file": "orders", "start_key": "a", "end_key": "b"}}},
    "base": {"nodes": {"Customer": {"file": ["none", "customer"], "key": "c_custkey", "props": {"segment": "c_mktsegment"}, "strip_header_prefix": "c_"}, "Order": {"file": "orders", "key": "o_orderkey"}, "Part": {"file": "orders", "key": "p_partkey"}}},
}


def standardise_star(spark, sf_dir):
    """The summary of a profile with an include, a missing source and an undeclared type."""
    tables = {n: _table(spark, sf_dir, n) for n in ("customer", "orders")}
    nodes, edges, status = bind.standardise(spark, STAR, Profile.of("star", PROFILES.__getitem__), tables.get)
    return bind.summary(spark, nodes, edges, status)


def binding_report(spark, sf_dir):
    tables = {"customer": _table(spark, sf_dir, "customer").withColumn("c_name", F.when(F.col("c_custkey") % 4 > 0, F.col("c_name")).otherwise(" n/a ")), "orders": _table(spark, sf_dir, "orders").withColumn("o-orderdate", F.lit("a header that reads like another"))}
    found = bind.binding_report(STAR, Profile.of("star", PROFILES.__getitem__), tables)
    return found.select("kind", "name", "source", "entry", "item", "column", "how", F.round("fill_rate", 6).alias("fill_rate"))


# The star schema under the labels of the documented patterns.
_NODES = {
    "Gene": ("region", "r_regionkey", {"symbol": "r_name"}), "CpGSite": ("nation", "n_nationkey", {"sourceCpgId": "n_name"}), "Variant": ("nation", "n_nationkey", {}),
    "MethylationObservation": ("customer", "c_custkey", {"betaValue": "c_mktsegment"}), "VariantObservation": ("customer", "c_custkey", {"variantCaller": "c_mktsegment"}),
    "MethylationStatusRule": ("region", "r_regionkey", {"ruleName": "r_name"}), "Sample": ("orders", "o_orderkey", {"sampleClass": "o_orderstatus"}),
    "Subject": ("customer", "c_custkey", {}), "Study": ("nation", "n_nationkey", {}), "Evidence": ("nation", "n_nationkey", {"claimText": "n_name"}),
    "Publication": ("supplier", "s_suppkey", {"title": "s_name"}), "Protein": ("region", "r_regionkey", {"uniprotId": "r_name", "proteinName": "r_name"}),
    "Intervention": ("part", "p_partkey", {"interventionName": "p_name", "_subtypeLabel": "p_brand"}), "ChemicalEntity": ("supplier", "s_suppkey", {"name": "s_name"}),
    "Assay": ("customer", "c_custkey", {"assayType": "c_mktsegment", "isSingleCellAssay": "flag"}), "LibraryPreparation": ("nation", "n_nationkey", {"libraryStrategy": "n_name"}),
    "SingleCellDataset": ("supplier", "s_suppkey", {}), "Repository": ("region", "r_regionkey", {"repositoryName": "r_name"}),
    "CellSet": ("part", "p_partkey", {"cellSetType": "p_type", "cellCount": "p_size"}), "CellType": ("region", "r_regionkey", {"cellTypeName": "r_name"}), "CellState": ("nation", "n_nationkey", {"cellStateName": "n_name"}),
    "Perturbation": ("part", "p_partkey", {"perturbationName": "p_name", "perturbationType": "p_type"}), "PhenotypeObservation": ("supplier", "s_suppkey", {"phenotypeName": "s_name"}),
    "Diagnosis": ("orders", "o_orderkey", {"conditionId": "o_orderstatus"}), "Condition": ("nation", "n_nationkey", {"conditionName": "n_name"}), "PathologyDetail": ("part", "p_partkey", {"morphologyDescription": "p_name"}),
    "Survival": ("orders", "o_orderkey", {"survivalType": "o_orderpriority"}),
}
_LINES = ("lineitem", "l_orderkey", "l_partkey", None)
_EDGES = {  # type: start label, end label, (table, start key, end key, condition)
    "MAPS_TO_GENE": ("CpGSite", "Gene", ("nation", "n_nationkey", "n_regionkey", None)), "MEASURES_CPG": ("MethylationObservation", "CpGSite", ("customer", "c_custkey", "c_nationkey", None)),
    "HAS_METHYLATION_OBSERVATION": ("Sample", "MethylationObservation", ("orders", "o_orderkey", "o_custkey", None)),
    "CLASSIFIED_USING": ("MethylationObservation", "MethylationStatusRule", ("customer", "c_custkey", "c_custkey % 5", "c_custkey % 2 = 0")),
    "SUPPORTS_ASSOCIATION_WITH": ("Evidence", "MethylationStatusRule", ("nation", "n_nationkey", "n_regionkey", "n_nationkey % 2 = 0")),
    "PROVIDES_EVIDENCE_FOR": ("Publication", "Evidence", ("supplier", "s_suppkey", "s_nationkey", None)),
    "IS_WITHIN_GENE": ("Variant", "Gene", ("nation", "n_nationkey", "n_regionkey", None)), "OBSERVED_VARIANT": ("VariantObservation", "Variant", ("customer", "c_custkey", "c_nationkey", None)),
    "HAS_VARIANT_OBSERVATION": ("Sample", "VariantObservation", ("orders", "o_orderkey", "o_custkey", None)), "PAIRED_WITH": ("Sample", "Sample", ("orders", "o_orderkey", "o_orderkey + 1", None)),
    "CONTRIBUTES_TO": ("Sample", "CellSet", _LINES), "ANNOTATED_AS_CELL_TYPE": ("CellSet", "CellType", ("part", "p_partkey", "p_partkey % 5", None)),
    "HAS_CELL_STATE": ("CellSet", "CellState", ("part", "p_partkey", "p_size % 25", "p_size % 2 = 0")), "HAS_SUBJECT": ("Study", "Subject", ("customer", "c_nationkey", "c_custkey", None)),
    "PROVIDED_SAMPLE": ("Subject", "Sample", ("orders", "o_custkey", "o_orderkey", None)), "ASSAYED_BY": ("Sample", "Assay", ("orders", "o_orderkey", "o_custkey", None)),
    "USED_LIBRARY": ("Assay", "LibraryPreparation", ("customer", "c_custkey", "c_nationkey", "c_custkey % 3 = 0")), "REPRESENTS_STUDY": ("SingleCellDataset", "Study", ("supplier", "s_suppkey", "s_nationkey", None)),
    "HOSTS_DATASET": ("Repository", "SingleCellDataset", ("supplier", "s_suppkey % 5", "s_suppkey", None)), "UNDERWENT_INTERVENTION": ("Sample", "Intervention", _LINES),
    "USES_AGENT": ("Intervention", "ChemicalEntity", ("part", "p_partkey", "p_partkey % 50 + 1", "p_partkey % 3 = 0")), "UNDERWENT_PERTURBATION": ("Sample", "Perturbation", _LINES),
    "TARGETS": ("Perturbation", "Protein", ("part", "p_partkey", "p_size % 5", None)), "HAS_PHENOTYPE_OBSERVATION": ("Perturbation", "PhenotypeObservation", ("part", "p_partkey", "p_partkey % 50 + 1", "p_size % 2 = 0")),
    "HAS_DIAGNOSIS": ("Subject", "Diagnosis", ("orders", "o_custkey", "o_orderkey", None)), "OF_CONDITION": ("Diagnosis", "Condition", ("orders", "o_orderkey", "o_orderkey % 25", None)),
    "HAS_PATHOLOGY": ("Diagnosis", "PathologyDetail", ("lineitem", "l_orderkey", "l_partkey", "l_partkey % 2 = 0")), "HAS_SURVIVAL_RECORD": ("Subject", "Survival", ("orders", "o_custkey", "o_orderkey", None)),
}
_PROPERTY = {"PAIRED_WITH": {"pairingType": "if(o_orderkey % 2 = 0, 'barcode_match', 'none')"}, "IS_WITHIN_GENE": {"geneRegion": "n_name"}, "USES_AGENT": {"agentRole": "p_type"}}


def _id(label: str) -> str:
    return {"CpGSite": "cpgId"}.get(label, label[0].lower() + label[1:] + "Id")


PATTERNS = Graph.of(
    {n: {"id": _id(n), "properties": list(props)} for n, (_, _, props) in _NODES.items()},
    {e: {"pairs": [[a, b], *([["Evidence", "Protein"]] if e == "SUPPORTS_ASSOCIATION_WITH" else []), *([["Diagnosis", "PhenotypeObservation"]] if e == "HAS_PHENOTYPE_OBSERVATION" else [])], "properties": list(_PROPERTY.get(e, {}))} for e, (a, b, _) in _EDGES.items()},
)


def _pattern_tables(spark, sf_dir) -> match.Tables:
    def node(label, name, key, props):
        df = _table(spark, sf_dir, name)
        if "flag" in props.values():
            df = df.withColumn("flag", F.expr("if(c_custkey % 2 = 0, 'True', 'false')"))
        return df.select(_text(key).alias(_id(label)), *[_text(c).alias(p) for p, c in props.items()])

    def edge(kind, a, b, rows):
        name, start, end, where = rows
        # Rows outside the condition stay edges, to an id that no node has.
        df, ends = _table(spark, sf_dir, name), {"startId": f"cast({start} as string)", "endId": f"cast({end} as string)"}
        if where:
            ends["endId"] = f"if({where}, {ends['endId']}, concat('no ', {ends['endId']}))"
        cols = [F.expr(x).alias(n) for n, x in ends.items()]
        out = df.select(*cols, F.lit(a).alias("startLabel"), F.lit(b).alias("endLabel"), *[F.expr(x).alias(p) for p, x in _PROPERTY.get(kind, {}).items()])
        # Dealt by one end, which the hop from it can use as it is.
        return out.repartition("startId").distinct() if name == "lineitem" else out

    nodes = {n: node(n, *spec) for n, spec in _NODES.items()}
    edges = {e: edge(e, *spec) for e, spec in _EDGES.items()}
    edges["SUPPORTS_ASSOCIATION_WITH"] = edges["SUPPORTS_ASSOCIATION_WITH"].unionByName(edge("SUPPORTS_ASSOCIATION_WITH", "Evidence", "Protein", ("nation", "n_nationkey", "n_regionkey", None)))
    edges["HAS_PHENOTYPE_OBSERVATION"] = edges["HAS_PHENOTYPE_OBSERVATION"].unionByName(edge("HAS_PHENOTYPE_OBSERVATION", "Diagnosis", "PhenotypeObservation", ("orders", "o_orderkey", "o_orderkey % 50 + 1", "o_orderkey % 3 = 0")))
    return match.Tables(PATTERNS, nodes, edges)


def _pattern(build: Callable, *args) -> Callable[[SparkSession, str], DataFrame]:
    """The query of a documented pattern; columns that the tables leave null are dropped."""
    name = f"pattern_{build.__name__}"

    def run(spark, sf_dir):
        return build(_pattern_tables(spark, sf_dir), *args).select(*SHOWN[name])

    run.__name__ = name
    return run


SHOWN = {
    "pattern_methylation_by_gene": ["sampleId", "symbol", "cpgId", "sourceCpgId", "betaValue", "methylationStatusRuleId"],
    "pattern_evidence_for_rule": ["methylationObservationId", "betaValue", "methylationStatusRuleId", "ruleName", "publicationId", "title"],
    "pattern_variants_within_gene": ["sampleId", "variantId", "variantObservationId", "variantCaller", "geneRegion"],
    "pattern_paired_samples": ["sourceSample", "pairedSample", "sourceClass", "pairedClass", "pairingType"],
    "pattern_cell_sets": ["sampleId", "cellSetId", "cellSetType", "totalCellSetCount", "cellTypeName", "cellStateName"],
    "pattern_single_cell_metadata": ["studyId", "subjectId", "sampleId", "assayId", "assayType", "libraryStrategy", "libraryPreparationId", "repositoryName", "singleCellDatasetId"],
    "pattern_drug_agents": ["subjectId", "sampleId", "interventionId", "interventionName", "agentName", "agentRole"],
    "pattern_protein_evidence": ["proteinId", "proteinName", "evidenceId", "claimText", "publicationId", "title"],
    "pattern_protein_perturbations": ["sampleId", "perturbationId", "perturbationType", "proteinId", "proteinName"],
    "pattern_perturbation_phenotypes": ["sampleId", "perturbationId", "perturbationName", "perturbationType", "phenotypeObservationId", "phenotypeName"],
    "pattern_diagnosis_detail": ["subjectId", "diagnosisId", "diagnosisConditionId", "conditionId", "conditionName", "pathologyDetailId", "morphologyDescription", "phenotypeObservationId", "phenotypeName"],
    "pattern_survival_records": ["subjectId", "survivalId", "survivalType"],
}
_ALL = (
    expression_lines, methylation_lines, variation_lines, aliquot_map, melt_samples, odd_features, flatten_pathology, flatten_follow_ups, flatten_exposures, flatten_attributes,
    flatten_studies, file_manifest, file_metadata, manifest_audit, bulk_part_nodes, bulk_manifest, endpoint_preflight, audit_undeclared, unique_keys, standardise_star, binding_report,
    _pattern(match.methylation_by_gene, "ASIA"), _pattern(match.evidence_for_rule, "4"), _pattern(match.variants_within_gene, "EUROPE"), _pattern(match.paired_samples), _pattern(match.cell_sets, "asi"),
    _pattern(match.single_cell_metadata), _pattern(match.drug_agents, "Brand#11"), _pattern(match.protein_evidence, "AMERICA"), _pattern(match.protein_perturbations),
    _pattern(match.perturbation_phenotypes), _pattern(match.diagnosis_detail), _pattern(match.survival_records),
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

_PLATFORM = "CASE {0} % 4 WHEN 0 THEN 'Illumina Human Methylation 450' WHEN 1 THEN 'Illumina Methylation Epic' WHEN 2 THEN 'NovaSeq' ELSE 'unknown' END"
_SAMPLE = "CASE WHEN {0} % 5 = 0 THEN '' ELSE 'al' || {0} END"
_CASE = "c_custkey::VARCHAR AS case_id, c_name AS case_submitter_id"
_OKEY = "lpad(o_orderkey::VARCHAR, 12, '0')"
_PAIRS = "(SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)"


def _limited(name: str, columns: str, rows: str, limit: int = 50) -> str:
    """The first rows in the order of all columns of the report."""
    return f"SELECT {columns} FROM {rows} ORDER BY " + ", ".join(f"{k} NULLS FIRST" for k in range(1, len(SHOWN[name]) + 1)) + f" LIMIT {limit}"


SQL: dict[str, str] = {
    "expression_lines": f"""SELECT {_SAMPLE.format('l_suppkey')} || ':ENSG' || l_partkey AS expression_observation_id, CASE WHEN l_linenumber = 4 THEN '' ELSE l_quantity::BIGINT::VARCHAR END AS expression_value, 'TPM' AS expression_unit,
{_PLATFORM.format('l_suppkey')} || ':RNA-Seq:STAR' AS assay_id, 'n' || l_suppkey AS source_file, 'STAR' AS pipeline_version FROM lineitem WHERE l_linenumber NOT IN (2, 3)""",
    "methylation_lines": f"""WITH v AS (SELECT *, CASE l_suppkey % 4 WHEN 0 THEN '450k' WHEN 1 THEN 'epic' ELSE 'unknown' END AS code FROM lineitem)
SELECT {_SAMPLE.format('l_suppkey')} || ':' || code || ':cg' || l_partkey AS methylation_observation_id, 'cg' || l_partkey AS source_cpg_id, printf('%.2f', l_discount) AS beta_value, code AS platform_code,
CASE WHEN l_suppkey % 2 = 1 OR l_linenumber % 2 = 0 THEN '' ELSE 'chr' || l_linenumber END AS chromosome, '' AS start_position, CASE WHEN l_suppkey % 2 = 0 THEN 'G' || l_partkey ELSE '' END AS gene_symbol,
{_PLATFORM.format('l_suppkey')} || ':RNA-Seq:beta' AS assay_id FROM v""",
    "variation_lines": """WITH v AS (SELECT *, l_orderkey % 200 AS b FROM lineitem WHERE l_linenumber <> 2 AND l_orderkey % 200 <> 7), s AS (SELECT v.*, CASE WHEN s_suppkey IS NULL THEN 'b' || b ELSE 'al' || s_suppkey END AS sample
FROM v LEFT JOIN supplier ON s_suppkey = b AND s_suppkey % 5 <> 0)
SELECT sample || ':7:' || l_orderkey || ':A:T' AS variant_observation_id, sample AS sample_id, 'G' || l_partkey AS gene_id, printf('%.4f', l_linenumber / l_quantity::BIGINT) AS variant_allele_frequency, 'Somatic' AS somatic_status, 'n' || l_suppkey AS source_file FROM s""",
    "aliquot_map": "SELECT 'b' || s_suppkey AS barcode, 'al' || s_suppkey AS uuid FROM supplier WHERE s_suppkey % 5 <> 0",
    "melt_samples": """SELECT 'S' || l_suppkey || ':450k:' || l_returnflag AS methylation_observation_id, '450k:' || l_returnflag AS cpg_id, l_returnflag AS source_cpg_id, sum(l_quantity::BIGINT)::VARCHAR AS beta_value FROM lineitem GROUP BY l_suppkey, l_returnflag""",
    "odd_features": "SELECT DISTINCT p_brand AS feature FROM part WHERE p_partkey % 3 <> 0",
    "flatten_pathology": f"SELECT {_CASE}, {_OKEY} AS diagnosis_id, 'pd' || o_orderkey AS pathology_detail_id, o_orderpriority AS grade FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'",
    "flatten_follow_ups": f"SELECT {_CASE}, {_OKEY} AS follow_up_id, (o_orderkey % 900)::VARCHAR AS days FROM customer JOIN orders ON o_custkey = c_custkey",
    "flatten_exposures": f"SELECT {_CASE}, coalesce(min({_OKEY}), '') AS diagnosis_id, 'e' || c_custkey AS exposure_id, c_acctbal::DECIMAL(18,2)::VARCHAR AS dose FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name, c_acctbal",
    "flatten_attributes": f"SELECT {_CASE}, CASE k WHEN 1 THEN 'x' || c_custkey ELSE '' END AS attribute_id FROM customer, (VALUES (1), (2)) v(k)",
    "flatten_studies": f"SELECT {_CASE}, 'P' || c_nationkey AS project_id, c_mktsegment AS project_name, 'G' AS program_name, 'open' AS state FROM customer WHERE c_custkey % 4 > 0",
    "file_manifest": "SELECT 'f' || s_suppkey AS id, 'n' || s_suppkey AS filename, md5(s_suppkey::VARCHAR) AS md5, s_suppkey * 7 AS size, 'validated' AS state FROM supplier",
    "file_metadata": f"SELECT 'f' || s_suppkey AS file_id, 'n' || s_suppkey AS file_name, {_SAMPLE.format('s_suppkey')} AS sample_id, {_PLATFORM.format('s_suppkey')} || ':RNA-Seq:STAR' AS assay_id, 'STAR' AS pipeline_version FROM supplier",
    "manifest_audit": """SELECT CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN doc_id % 5 = 0 THEN 'size mismatch' WHEN doc_id % 7 = 0 THEN 'md5 mismatch' ELSE 'ok' END AS status, count(*)::BIGINT AS n_rows FROM documents GROUP BY 1""",
    "bulk_part_nodes": """SELECT p_partkey::VARCHAR AS "partId:ID(Part)", p_name AS name, p_size::VARCHAR AS "size:int", CASE WHEN p_brand IN ('Brand#11', 'Brand#22') THEN 'Part;' || p_brand ELSE 'Part' END AS ":LABEL" FROM part WHERE p_partkey % 9 > 0""",
    "bulk_manifest": """SELECT 'one' AS dataset, 'node' AS kind, 'Order' AS name, 'one/nodes/Order' AS path, count(*)::BIGINT AS n_rows FROM orders UNION ALL SELECT 'one', 'edge', 'PLACED', 'one/edges/PLACED/startLabel=Customer/endLabel=Order', count(*) FROM orders
UNION ALL SELECT 'one', 'node', 'Part', 'one/nodes/Part', count(*) FROM part WHERE p_partkey % 9 > 0 UNION ALL SELECT 'two', 'node', 'Part', 'two/nodes/Part', count(*) FROM part WHERE p_partkey % 9 > 0""",
    "endpoint_preflight": "SELECT label FROM (VALUES ('Customer'), ('Part')) v(label) WHERE EXISTS (SELECT 1 FROM orders)",
    "audit_undeclared": """SELECT 'Ship' AS "table", '' AS key, 'label not declared' AS kind, 1::BIGINT AS n UNION ALL SELECT 'Part', 'partId', 'id column missing', 1 UNION ALL SELECT 'SAILS', '', 'edge type not declared', 1
UNION ALL SELECT t, 'startId', 'label not loaded', (SELECT count(*) FROM orders) FROM (VALUES ('PLACED'), ('SAILS')) v(t)""",
    "unique_keys": "SELECT l_suppkey::VARCHAR AS id, count(*)::BIGINT AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "standardise_star": """SELECT 'node' AS kind, 'Customer' AS name, 'bound' AS status, '' AS reason, count(*)::BIGINT AS n_rows FROM customer UNION ALL SELECT 'node', 'Order', 'bound', '', count(*) FROM orders UNION ALL SELECT 'node', 'Part', 'skipped', 'key column absent', 0
UNION ALL SELECT 'edge', 'PLACED', 'bound', '', count(*) FROM orders UNION ALL SELECT 'edge', 'HAS_PART', 'skipped', 'no source', 0 UNION ALL SELECT 'edge', 'SAILS', 'skipped', 'not in the graph', 0""",
    "binding_report": """SELECT * FROM (SELECT 'node' AS kind, 'Customer' AS name, 'customer' AS source, 'property' AS entry, 'name' AS item, 'c_name' AS "column", 'camel' AS how, round(avg(CASE WHEN c_custkey % 4 > 0 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS fill_rate FROM customer
UNION ALL SELECT 'node', 'Customer', 'customer', 'property', 'segment', 'c_mktsegment', 'choice', 1.0 UNION ALL SELECT 'node', 'Customer', 'customer', 'key', 'c_custkey', 'c_custkey', 'present', NULL
UNION ALL SELECT 'node', 'Order', 'orders', 'key', 'o_orderkey', 'o_orderkey', 'present', NULL UNION ALL SELECT 'node', 'Part', 'orders', 'property', 'name', NULL, 'unmatched', NULL UNION ALL SELECT 'node', 'Part', 'orders', 'property', 'size', NULL, 'unmatched', NULL
UNION ALL SELECT 'node', 'Part', 'orders', 'key', 'p_partkey', NULL, 'absent', NULL UNION ALL SELECT 'edge', 'PLACED', 'orders', 'property', 'orderPriority', 'o_orderpriority', 'rename', 1.0
UNION ALL SELECT 'edge', 'PLACED', 'orders', 'key', 'o_custkey', 'o_custkey', 'present', NULL UNION ALL SELECT 'edge', 'PLACED', 'orders', 'key', 'o_orderkey', 'o_orderkey', 'present', NULL
UNION ALL SELECT 'edge', 'HAS_PART', NULL, 'skipped', '', NULL, 'no source', NULL UNION ALL SELECT 'edge', 'SAILS', 'orders', 'skipped', '', NULL, 'not in the graph', NULL)
UNION ALL SELECT kind, name, source, 'unused', c, c, '', CASE WHEN c = 'o_orderpriority' THEN 1.0 END
FROM (VALUES ('node', 'Customer', 'customer', ['c_nationkey', 'c_acctbal']), ('node', 'Order', 'orders', ['o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority', 'o-orderdate']),
 ('node', 'Part', 'orders', ['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority', 'o-orderdate']),
 ('edge', 'PLACED', 'orders', ['o_orderstatus', 'o_totalprice', 'o_orderdate', 'o-orderdate'])) v(kind, name, source, cs), unnest(cs) u(c)
UNION ALL SELECT kind, name, 'orders', 'ambiguous', 'oOrderdate', 'o_orderdate,o-orderdate', '', NULL FROM (VALUES ('node', 'Order'), ('node', 'Part'), ('edge', 'PLACED')) w(kind, name)""",
    "pattern_methylation_by_gene": _limited("pattern_methylation_by_gene", 'o_orderkey::VARCHAR AS "sampleId", r_name AS symbol, n_nationkey::VARCHAR AS "cpgId", n_name AS "sourceCpgId", c_mktsegment AS "betaValue", CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 5)::VARCHAR END AS "methylationStatusRuleId"', "region JOIN nation ON n_regionkey = r_regionkey AND r_name = 'ASIA' JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey"),
    "pattern_evidence_for_rule": _limited("pattern_evidence_for_rule", 'c_custkey::VARCHAR AS "methylationObservationId", c_mktsegment AS "betaValue", r.r_regionkey::VARCHAR AS "methylationStatusRuleId", r_name AS "ruleName", s_suppkey::VARCHAR AS "publicationId", s_name AS title', "customer JOIN region r ON r_regionkey = c_custkey % 5 AND c_custkey = 4 LEFT JOIN (nation JOIN supplier ON s_nationkey = n_nationkey AND n_nationkey % 2 = 0) ON n_regionkey = r_regionkey", 20),
    "pattern_variants_within_gene": _limited("pattern_variants_within_gene", 'o_orderkey::VARCHAR AS "sampleId", n_nationkey::VARCHAR AS "variantId", c_custkey::VARCHAR AS "variantObservationId", c_mktsegment AS "variantCaller", n_name AS "geneRegion"', "region JOIN nation ON n_regionkey = r_regionkey AND r_name = 'EUROPE' JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey"),
    "pattern_paired_samples": _limited("pattern_paired_samples", """a.o_orderkey::VARCHAR AS "sourceSample", b.o_orderkey::VARCHAR AS "pairedSample", a.o_orderstatus AS "sourceClass", b.o_orderstatus AS "pairedClass", 'barcode_match' AS "pairingType\"""", "orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 AND a.o_orderkey % 2 = 0"),
    "pattern_cell_sets": _limited("pattern_cell_sets", 'l_orderkey::VARCHAR AS "sampleId", p_partkey::VARCHAR AS "cellSetId", p_type AS "cellSetType", p_size::VARCHAR AS "totalCellSetCount", r_name AS "cellTypeName", CASE WHEN p_size % 2 = 0 THEN n_name END AS "cellStateName"', f"region JOIN part ON p_partkey % 5 = r_regionkey AND lower(r_name) LIKE '%asi%' JOIN {_PAIRS} ON l_partkey = p_partkey JOIN orders ON o_orderkey = l_orderkey JOIN nation ON n_nationkey = p_size % 25"),
    "pattern_single_cell_metadata": _limited("pattern_single_cell_metadata", 'c_nationkey::VARCHAR AS "studyId", c_custkey::VARCHAR AS "subjectId", o_orderkey::VARCHAR AS "sampleId", c_custkey::VARCHAR AS "assayId", c_mktsegment AS "assayType", CASE WHEN c_custkey % 3 = 0 THEN n_name END AS "libraryStrategy", CASE WHEN c_custkey % 3 = 0 THEN n_nationkey::VARCHAR END AS "libraryPreparationId", r_name AS "repositoryName", s_suppkey::VARCHAR AS "singleCellDatasetId"', "customer JOIN nation ON n_nationkey = c_nationkey AND c_custkey % 2 = 0 JOIN orders ON o_custkey = c_custkey LEFT JOIN (supplier JOIN region ON r_regionkey = s_suppkey % 5) ON s_nationkey = c_nationkey"),
    "pattern_drug_agents": _limited("pattern_drug_agents", 'o_custkey::VARCHAR AS "subjectId", o_orderkey::VARCHAR AS "sampleId", p_partkey::VARCHAR AS "interventionId", p_name AS "interventionName", s_name AS "agentName", CASE WHEN s_suppkey IS NOT NULL THEN p_type END AS "agentRole"', f"customer JOIN orders ON o_custkey = c_custkey JOIN {_PAIRS} ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey AND p_brand = 'Brand#11' LEFT JOIN supplier ON s_suppkey = p_partkey % 50 + 1 AND p_partkey % 3 = 0"),
    "pattern_protein_evidence": _limited("pattern_protein_evidence", 'r_regionkey::VARCHAR AS "proteinId", r_name AS "proteinName", n_nationkey::VARCHAR AS "evidenceId", n_name AS "claimText", s_suppkey::VARCHAR AS "publicationId", s_name AS title', "region JOIN nation ON n_regionkey = r_regionkey AND r_name = 'AMERICA' JOIN supplier ON s_nationkey = n_nationkey"),
    "pattern_protein_perturbations": _limited("pattern_protein_perturbations", 'o_orderkey::VARCHAR AS "sampleId", p_partkey::VARCHAR AS "perturbationId", p_type AS "perturbationType", r_regionkey::VARCHAR AS "proteinId", r_name AS "proteinName"', f"orders JOIN {_PAIRS} ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey JOIN region ON r_regionkey = p_size % 5"),
    "pattern_perturbation_phenotypes": _limited("pattern_perturbation_phenotypes", 'o_orderkey::VARCHAR AS "sampleId", p_partkey::VARCHAR AS "perturbationId", p_name AS "perturbationName", p_type AS "perturbationType", s_suppkey::VARCHAR AS "phenotypeObservationId", s_name AS "phenotypeName"', f"orders JOIN {_PAIRS} ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = p_partkey % 50 + 1 AND p_size % 2 = 0"),
    "pattern_diagnosis_detail": _limited("pattern_diagnosis_detail", 'c_custkey::VARCHAR AS "subjectId", o_orderkey::VARCHAR AS "diagnosisId", o_orderstatus AS "diagnosisConditionId", n_nationkey::VARCHAR AS "conditionId", n_name AS "conditionName", p_partkey::VARCHAR AS "pathologyDetailId", p_name AS "morphologyDescription", s_suppkey::VARCHAR AS "phenotypeObservationId", s_name AS "phenotypeName"', f"customer JOIN orders ON o_custkey = c_custkey JOIN nation ON n_nationkey = o_orderkey % 25 LEFT JOIN ({_PAIRS} JOIN part ON p_partkey = l_partkey AND p_partkey % 2 = 0) ON l_orderkey = o_orderkey LEFT JOIN supplier ON s_suppkey = o_orderkey % 50 + 1 AND o_orderkey % 3 = 0"),
    "pattern_survival_records": _limited("pattern_survival_records", 'c_custkey::VARCHAR AS "subjectId", o_orderkey::VARCHAR AS "survivalId", o_orderpriority AS "survivalType"', "customer JOIN orders ON o_custkey = c_custkey"),
}
