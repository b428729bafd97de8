"""Registered queries that write files of the star-schema tables' rows and read them back,
each with the DuckDB SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.operators import audit, flatten, match, omics, reshape
from braidwork.plans import store
from braidwork.plans.schema import Graph
from braidwork.sources import readers, writers
from braidwork.sources.shared import scratch_folder

SHOP = Graph.of(
    {
        "Customer": {"id": "customerId", "properties": ["name", "marketSegment"]},
        "Supplier": {"id": "supplierId", "properties": ["name"]},
        "Nation": {"id": "nationId", "properties": ["name"]},
        "Order": {"id": "orderId", "properties": [{"total": "double"}]},
        "Part": {"id": "partId", "properties": ["name"]},
    },
    {
        "LIVES_IN": {"pairs": [["Customer", "Nation"], ["Supplier", "Nation"]]},
        "HAS_PART": {"pairs": [["Order", "Part"]], "properties": [{"quantity": "long"}]},
    },
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What a store has of the customers, and a later batch: some new, some with a new name,
    some with an empty one. Together they are all customers."""
    c, k = _table(spark, sf_dir, "customer"), F.col("c_custkey")
    key = k.cast("string").alias("customerId")
    old = c.filter(k % 5 != 0).select(key, F.col("c_name").alias("name"), F.col("c_mktsegment").alias("marketSegment"))
    name = F.when(k % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("new "), "c_name"))
    new = c.filter((k % 5 == 0) | (k % 50 == 1)).select(key, name.alias("name"), F.lit(None).cast("string").alias("marketSegment"))
    return old, new


def fold_into_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of customers folded into a store in buckets."""
    at = scratch_folder(spark, "store")
    old, new = _customers(spark, sf_dir)
    store.create_store(spark, SHOP, at, {"Customer": old}, {}, buckets=32)
    store.fold_batch(spark, SHOP, at, {"Customer": new}, {}, "second")
    return store.read_store(spark, at)[0]["Customer"]


def _folded_edges(spark: SparkSession, sf_dir: str) -> str:
    at = scratch_folder(spark, "store")
    text = lambda c, n: F.col(c).cast("string").alias(n)
    parts = _table(spark, sf_dir, "part").filter("p_partkey % 4 <> 0").select(text("p_partkey", "partId"), F.col("p_name").alias("name"))
    orders = _table(spark, sf_dir, "orders").select(text("o_orderkey", "orderId"), text("o_totalprice", "total"))
    lines = _table(spark, sf_dir, "lineitem")
    edges = lines.select(
        text("l_orderkey", "startId"), text("l_partkey", "endId"), F.lit("Order").alias("startLabel"), F.lit("Part").alias("endLabel"),
        F.col("l_quantity").cast("long").cast("string").alias("quantity"), (F.col("l_quantity").cast("long") * 10 + F.col("l_linenumber")).alias("at"), "l_linenumber",
    )
    first, second = (edges.filter(w).drop("l_linenumber") for w in ("l_linenumber <= 5", "l_linenumber > 5"))
    store.create_store(spark, SHOP, at, {"Part": parts, "Order": orders}, {"HAS_PART": first}, buckets=32, order="at")
    store.fold_batch(spark, SHOP, at, {}, {"HAS_PART": second}, "second", order="at")
    return at


def fold_edges_into_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines folded in two batches; lines of parts that the store lacks are dropped."""
    return store.read_store(spark, _folded_edges(spark, sf_dir))[1]["HAS_PART"].drop("at")


def store_dropped_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = store.dropped(spark, _folded_edges(spark, sf_dir))
    return lost.groupBy("batch", "endId").agg(F.count("*").alias("n_rows"))


def _lives_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda table, key, nation, label: _table(spark, sf_dir, table).select(
        F.col(key).cast("string").alias("startId"), F.col(nation).cast("string").alias("endId"), F.lit(label).alias("startLabel"), F.lit("Nation").alias("endLabel")
    )
    return part("customer", "c_custkey", "c_nationkey", "Customer").unionByName(part("supplier", "s_suppkey", "s_nationkey", "Supplier"))


def bulk_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every file set of a bulk layout as they are read back, each with the path
    and rows that the manifest lists for it."""
    at = scratch_folder(spark, "bulk")
    nations = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("nationId"), F.col("n_name").alias("name"))
    written = writers.write_bulk({"Nation": nations}, {"LIVES_IN": _lives_in(spark, sf_dir)}, SHOP, at)
    listed = writers.written_manifest(spark, {"shop": written})
    out = None
    for f in written:
        rows = spark.read.schema("first string, second string").csv(f"{at}/{f.path}", escape='"').select(F.lit(f"shop/{f.path}").alias("path"), "first", "second")
        out = rows if out is None else out.unionByName(rows)
    return out.join(listed.select("path", "kind", "n_rows"), "path")


def two_genotype_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carriers in a folder of two genotype files whose headers name other samples and other places of
    Gene: parts with an odd key are in the first."""
    at = scratch_folder(spark, "calls")
    k = F.col("p_partkey")
    for n, (samples, form) in enumerate((("S1\tS2", "Allele|Gene"), ("S3\tS1\tS4", "Allele|Consequence|Gene"))):
        meta = [f'##INFO=<ID=CSQ,Number=.,Description="Format: {form}">', f"#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t{samples}"]
        csq = F.concat(F.lit("CSQ=G|" + "x|" * n), "p_brand")
        calls = [F.concat((k % 2).cast("string"), F.lit("|"), ((k + s) % 3 % 2).cast("string")) for s in range(len(samples.split("\t")))]
        record = F.concat_ws("\t", F.lit("chr1"), k.cast("string"), F.lit("."), F.lit("A"), F.lit("G"), F.lit("."), F.lit("PASS"), csq, F.lit("GT"), *calls)
        own = _table(spark, sf_dir, "part").filter(k % 2 == 1 - n).select(record.alias("value"), k.alias("at"))
        head = spark.createDataFrame([(m, i - 2) for i, m in enumerate(meta)], "value string, at long")
        head.unionByName(own).coalesce(1).sortWithinPartitions("at").select("value").write.mode("append").text(at)
    spec = {"type": "vcf", "input": at.rsplit("/", 1)[1]}
    rows, genes, _ = reshape.reshape(spark, spec, at.rsplit("/", 1)[0])
    named = rows.select("sample_id", "variant_id", "position_end").join(genes, "variant_id", "left")
    return named.select("variant_id", "sample_id", "position_end", "gene_id")


def two_matrix_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of quantities by part and flag from a folder of two matrices whose columns stand in
    another order and whose label column is elsewhere; a third file has no label column."""
    at = scratch_folder(spark, "matrix")
    flags = ("A", "N", "R")
    sums = _table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(*[F.sum(F.when(F.col("l_returnflag") == f, F.col("l_quantity").cast("long"))).cast("string").alias(f) for f in flags])
    cell = {f: F.coalesce(f, F.lit("")) for f in flags} | {"gene_id": F.concat(F.lit("ENSG"), "l_partkey", F.lit(".1"))}
    for n, columns in enumerate((["gene_id", "A", "N", "R"], ["R", "gene_id", "A"], ["x", "A"])):
        own = sums.filter(F.col("l_partkey") % 3 == n).select(F.concat_ws("\t", *[cell.get(c, F.lit("y")) for c in columns]).alias("value"), F.lit(1).alias("at"))
        head = spark.createDataFrame([("\t".join(columns), 0)], "value string, at int")
        head.unionByName(own).coalesce(1).sortWithinPartitions("at").select("value").write.mode("append").text(at)
    spec = {"type": "matrix", "input": at.rsplit("/", 1)[1], "observation": "expression", "feature_id_column": "gene_id", "feature_id_type": "ensembl", "unit": "TPM", "ignore_columns": ["N"]}
    rows, _, why = reshape.reshape(spark, spec, at.rsplit("/", 1)[0])
    return rows.select("expression_observation_id", "expression_value", "expression_unit", F.lit(why != "").alias("some_skipped"))


def raw_table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line ends and quotes, written as a text table in several files and read
    back as records; files without such texts are read in parts."""
    at = scratch_folder(spark, "raw") + ".csv"
    d = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.translate(F.coalesce("text", F.lit("")), "\r", "").alias("text"))
    d.filter("instr(text, '\n') = 0").write.csv(f"{at}/plain", **writers.CSV)
    d.filter("instr(text, '\n') > 0").write.csv(f"{at}/quoted", **writers.CSV)
    both = [readers.read_raw_table(spark, f"{at}/{part}", ordered=True) for part in ("plain", "quoted")]
    rows = both[0].unionByName(both[1])
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_rows"), F.min(F.md5("text")).alias("text_md5"))


def _pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as case records in response pages of one market segment and nation, some lines of them
    cut off, and their orders as diagnoses."""
    at = scratch_folder(spark, "pages")
    key = lambda c: F.col(c).cast("string")
    o = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct(key("o_orderkey").alias("diagnosis_id"), F.col("o_orderkey").alias("age_at_diagnosis")))).alias("diagnoses"))
    project = F.struct(F.concat(F.lit("P"), "c_nationkey").alias("project_id"), F.struct(F.col("c_mktsegment").alias("name")).alias("program"))
    c = _table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    case = F.struct(key("c_custkey").alias("case_id"), F.col("c_name").alias("submitter_id"), project.alias("project"), "diagnoses", F.lit("more").alias("not_declared"))
    page = c.groupBy("c_nationkey", "c_mktsegment").agg(F.to_json(F.struct(F.struct(F.collect_list(case).alias("hits")).alias("data"))).alias("value"))
    cut = F.when((F.col("c_nationkey") == 3) & (F.col("c_mktsegment") == "BUILDING"), F.substring("value", 1, 40)).otherwise(F.col("value"))
    page.select(cut.alias("value")).write.text(at)
    return readers.read_pages(spark, at, readers.case_schema())


def read_case_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnoses of the cases that pages hold, read by the declared schema."""
    cases = readers.of_project(_pages(spark, sf_dir)[0], project="P3")
    return flatten.diagnoses(cases).select("case_id", "diagnosis_id", "age_at_diagnosis")


def bad_case_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cases the pages gave, and how many lines were bad."""
    cases, bad = _pages(spark, sf_dir)
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    lines = readers.bad_report(bad).agg(F.coalesce(F.sum("n_bad"), F.lit(0)).alias("n")).select(F.lit("bad").alias("kind"), "n")
    return count(cases, "cases").unionByName(lines)


def _rules(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as observations on four platforms, one of them without rules, and the nations as
    rules whose ranges overlap and some of whose thresholds are missing."""
    k, n = F.col("o_orderkey"), F.col("n_nationkey")
    platform = lambda c: F.element_at(F.array(*[F.lit(x) for x in ("450k", "epic", "27k", "other")]), (c % 4 + 1).cast("int"))
    beta = F.when(k % 53 == 0, "NA").otherwise(F.format_string("%.3f", (k % 1103) / 1000.0))
    obs = _table(spark, sf_dir, "orders").select(k.cast("string").alias("methylationObservationId"), beta.alias("betaValue"), platform(k).alias("platformCode"))
    text = lambda x: F.format_string("%.2f", x)
    rules = _table(spark, sf_dir, "nation").filter(n % 4 != 3).select(
        F.concat(F.lit("r"), F.lpad(n.cast("string"), 2, "0")).alias("methylationStatusRuleId"), platform(n).alias("platformCode"),
        F.when(n % 5 != 0, text(n / 50.0)).alias("hypoThreshold"), F.when(n % 7 != 0, text(0.9 - n / 60.0)).alias("hyperThreshold"),
        F.when(n % 3 == 0, F.lit("0.25")).alias("intermediateLowerBound"), F.when(n % 3 == 0, F.lit("0.55")).alias("intermediateUpperBound"),
    )
    return obs, rules


def rule_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of every observation by the first rule of its platform."""
    return match.classify_by_rules(*_rules(spark, sf_dir))[0].select("methylationObservationId", "methylationStatus")


def rule_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many observations each rule gives each status."""
    return match.classify_by_rules(*_rules(spark, sf_dir))[1].groupBy("endId", "status").agg(F.count("*").alias("n_rows"))


def landed_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the customers of each nation, one a nation, with size and sum read as
    streams."""
    at = scratch_folder(spark, "landed")
    c = _table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.col("c_name").alias("value"))
    c.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").select("c_nationkey", "value").write.partitionBy("c_nationkey").text(at)
    files = audit.landed_files(spark, at, checksums=True).filter("path like '%/part-%'")
    nation = F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int").alias("nation")
    return files.select(nation, "landed_size", "landed_md5")


def selected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File records as landed lines, of which one layer's, one program's and one case's are
    selected."""
    at = scratch_folder(spark, "hits")
    k = F.col("o_orderkey")
    strategy = F.when(k % 2 == 0, "RNA-Seq").otherwise("WXS")
    project = F.struct(F.concat(F.lit("P"), k % 5).alias("project_id"), F.struct(F.concat(F.lit("G"), k % 3).alias("name")).alias("program"))
    cases = F.array(F.struct(F.concat(F.lit("c"), "o_custkey").alias("case_id"), project.alias("project")), F.struct(F.lit("c0").alias("case_id"), F.lit(None).cast(project_type()).alias("project")))
    hits = _table(spark, sf_dir, "orders").select(
        k.cast("string").alias("file_id"), strategy.alias("experimental_strategy"), F.lit("Gene Expression Quantification").alias("data_type"), F.lit("Transcriptome Profiling").alias("data_category"),
        F.struct(F.when(k % 4 == 0, "STAR - Counts").otherwise("other").alias("workflow_type")).alias("analysis"), F.when(k % 8 == 4, "controlled").otherwise("open").alias("access"), cases.alias("cases"),
    )
    hits.select(F.to_json(F.struct("*")).alias("value")).write.text(at)
    files = readers.read_file_metadata(spark, at, schema=hits.schema)
    layer = readers.file_selection(files, "expression")
    one = lambda df, name: df.select(F.lit(name).alias("selection"), "file_id")
    some = one(layer, "layer").unionByName(one(readers.file_selection(files, "expression", project="P3", program="G1"), "program"))
    return some.unionByName(one(readers.file_selection(files, {"access": "controlled"}, case_id="c7"), "case"))


def project_type() -> str:
    return "struct<project_id:string,program:struct<name:string>>"


def patient_survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survival lines with a comment, landed as a text table, and their endpoints for the
    cases of a crosswalk; patients that it lacks are counted."""
    at = scratch_folder(spark, "survival")
    k = F.col("c_custkey")
    event = F.when(k % 3 == 0, "1:DECEASED").when(k % 3 == 1, "0:LIVING").otherwise("")
    line = F.concat_ws("\t", F.concat(F.lit("b"), k), event, F.when(k % 7 == 0, "").otherwise(F.format_string("%.2f", (k % 200) / 4.0)), F.lit("0:NO"), F.lit("12.5"))
    body = _table(spark, sf_dir, "customer").select(line.alias("value"), k.alias("at"))
    head = spark.createDataFrame([("# landed", -2), ("PATIENT_ID\tOS_STATUS\tOS_MONTHS\tDFS_STATUS\tDFS_MONTHS", -1)], "value string, at long")
    head.unionByName(body).coalesce(1).sortWithinPartitions("at").select("value").write.text(at)
    crosswalk = _table(spark, sf_dir, "customer").filter(k % 4 != 0).select(F.concat(F.lit("b"), k).alias("case_submitter_id"), F.concat(F.lit("u"), k).alias("case_id"))
    patients = readers.read_patient_survival(spark, at)
    rows = omics.survival_endpoints(patients, crosswalk).select("case_id", "survival_type", "event", "time_days")
    lost = omics.unmatched_patients(patients, crosswalk).groupBy().agg(F.count("*").cast("string").alias("n"))
    return rows.unionByName(lost.select(F.lit("unmatched").alias("case_id"), F.lit("").alias("survival_type"), F.lit("").alias("event"), F.col("n").alias("time_days")))


def graph_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node and edge tables written as a graph folder and read back, with a table that the
    graph doesn't declare left out; the rows that were counted as they were written."""
    at = scratch_folder(spark, "graph")
    nations = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("nationId"), F.col("n_name").alias("name"))
    counts = writers.write_graph({"Nation": nations, "Odd": nations}, {"LIVES_IN": _lives_in(spark, sf_dir)}, at)
    nodes, edges, unknown = readers.read_graph(spark, at, SHOP)
    part = lambda df, kind, name, id_: df.select(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.col(id_).alias("id"), F.lit(counts[kind, name]).cast("long").alias("n_written"))
    out = part(nodes["Nation"], "node", "Nation", "nationId").unionByName(part(edges["LIVES_IN"], "edge", "LIVES_IN", "startId"))
    return out.withColumn("unknown", F.lit(",".join(unknown)))


def entity_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of the cases written as tables and as text, found again by name with interim
    before raw, and observations partitioned by their dataset."""
    at = scratch_folder(spark, "entities")
    cases = _pages(spark, sf_dir)[0]
    writers.write_entities({"study": flatten.studies(cases)}, f"{at}/interim")
    writers.write_entities({"study": flatten.studies(cases).limit(0), "diagnosis": flatten.diagnoses(cases)}, f"{at}/raw", as_text=True)
    observed = flatten.diagnoses(cases).select(F.col("case_id").alias("sample_id"), F.col("diagnosis_id").alias("gene_id"), F.concat(F.lit("D"), F.length("case_id")).alias("source_dataset"))
    writers.write_observations(observed, omics.EXPRESSION, f"{at}/raw/observed.parquet")
    find = lambda name: readers.resolve_source(spark, name, f"{at}/interim", f"{at}/raw")
    rows = lambda df, name, *by: df.groupBy(F.lit(name).alias("name"), F.concat_ws(":", *by).alias("key")).agg(F.count("*").alias("n_rows"))
    return rows(find("study"), "study", "project_id").unionByName(rows(find("diagnosis.tsv"), "diagnosis", "case_id")).unionByName(rows(find("observed"), "observed", "source_dataset"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        fold_into_store, fold_edges_into_store, store_dropped_edges, bulk_written, two_genotype_files, two_matrix_files, raw_table_lines, read_case_pages,
        bad_case_pages, rule_statuses, rule_edges, landed_digests, graph_round_trip, entity_files, selected_files,
        patient_survival,
    )
}

_CUT = "NOT (c_nationkey = 3 AND c_mktsegment = 'BUILDING')"
_RULES = """
WITH o AS (SELECT o_orderkey::VARCHAR AS id, CASE WHEN o_orderkey % 53 <> 0 THEN printf('%.3f', (o_orderkey % 1103) / 1000.0)::DOUBLE END AS v, o_orderkey % 4 AS p FROM orders),
r AS (SELECT 'r' || lpad(n_nationkey::VARCHAR, 2, '0') AS id, n_nationkey % 4 AS p,
             CASE WHEN n_nationkey % 5 <> 0 THEN printf('%.2f', n_nationkey / 50.0)::DOUBLE END AS h, CASE WHEN n_nationkey % 7 <> 0 THEN printf('%.2f', 0.9 - n_nationkey / 60.0)::DOUBLE END AS t,
             CASE WHEN n_nationkey % 3 = 0 THEN 0.25 END AS a, CASE WHEN n_nationkey % 3 = 0 THEN 0.55 END AS b FROM nation WHERE n_nationkey % 4 <> 3),
e AS (SELECT o.id AS s, r.id AS e, CASE WHEN v <= h THEN 'hypomethylated' WHEN v >= t THEN 'hypermethylated'
             WHEN coalesce(h, a) IS NOT NULL AND coalesce(t, b) IS NOT NULL AND (a IS NULL OR v >= a) AND (b IS NULL OR v <= b) THEN 'intermediate' END AS status
      FROM o JOIN r USING (p) WHERE v IS NOT NULL)"""

SQL: dict[str, str] = {
    "fold_into_store": """
SELECT c_custkey::VARCHAR AS "customerId",
       CASE WHEN (c_custkey % 5 = 0 OR c_custkey % 50 = 1) AND c_custkey % 3 <> 0 THEN 'new ' || c_name WHEN c_custkey % 5 <> 0 THEN c_name END AS name,
       CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS "marketSegment"
FROM customer""",
    "fold_edges_into_store": """
SELECT 'Order' AS "startLabel", l_orderkey::VARCHAR AS "startId", 'Part' AS "endLabel", l_partkey::VARCHAR AS "endId",
       coalesce(max(l_quantity::BIGINT) FILTER (l_linenumber > 5), max(l_quantity::BIGINT))::VARCHAR AS quantity
FROM lineitem WHERE l_partkey % 4 <> 0 GROUP BY l_orderkey, l_partkey""",
    "store_dropped_edges": """
SELECT CASE WHEN l_linenumber <= 5 THEN 'first' ELSE 'second' END AS batch, l_partkey::VARCHAR AS "endId", count(*)::BIGINT AS n_rows
FROM lineitem WHERE l_partkey % 4 = 0 GROUP BY ALL""",
    "bulk_written": """
WITH r AS (SELECT 'shop/nodes/Nation' AS path, 'node' AS kind, n_nationkey::VARCHAR AS first, n_name AS second FROM nation
           UNION ALL SELECT 'shop/edges/LIVES_IN/startLabel=Customer/endLabel=Nation', 'edge', c_custkey::VARCHAR, c_nationkey::VARCHAR FROM customer
           UNION ALL SELECT 'shop/edges/LIVES_IN/startLabel=Supplier/endLabel=Nation', 'edge', s_suppkey::VARCHAR, s_nationkey::VARCHAR FROM supplier)
SELECT path, first, second, kind, count(*) OVER (PARTITION BY path)::BIGINT AS n_rows FROM r""",
    "two_genotype_files": """
WITH p AS (SELECT *, p_partkey AS k, p_partkey % 2 = 0 AS second FROM part),
c AS (SELECT k, p_brand, s FROM p, (VALUES ('S1', false, 0), ('S2', false, 1), ('S3', true, 0), ('S1', true, 1), ('S4', true, 2)) h(s, f, i)
      WHERE f = second AND (k % 2 = 1 OR (k + i) % 3 % 2 = 1))
SELECT 'chr1-' || k || '-A-G' AS variant_id, s AS sample_id, k::VARCHAR AS position_end, p_brand AS gene_id FROM c""",
    "two_matrix_files": """
SELECT l_returnflag || ':ENSG' || l_partkey AS expression_observation_id, sum(l_quantity::BIGINT)::VARCHAR AS expression_value, 'TPM' AS expression_unit, true AS some_skipped
FROM lineitem WHERE (l_partkey % 3 = 0 OR l_partkey % 3 = 1) AND l_returnflag IN ('A', 'R') GROUP BY l_partkey, l_returnflag""",
    "raw_table_lines": """
SELECT doc_id::VARCHAR AS doc_id, count(*)::BIGINT AS n_rows, min(md5(replace(coalesce(text, ''), chr(13), ''))) AS text_md5 FROM documents GROUP BY 1""",
    "read_case_pages": f"""
SELECT c_custkey::VARCHAR AS case_id, o_orderkey::VARCHAR AS diagnosis_id, o_orderkey::BIGINT AS age_at_diagnosis
FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey = 3 AND {_CUT}""",
    "bad_case_pages": f"""
SELECT 'cases' AS kind, count(*)::BIGINT AS n FROM customer WHERE {_CUT}
UNION ALL SELECT 'bad', count(DISTINCT c_nationkey)::BIGINT FROM customer WHERE NOT ({_CUT})""",
    "rule_statuses": _RULES + """
SELECT id AS "methylationObservationId", coalesce(min_by(status, e), '') AS "methylationStatus" FROM o LEFT JOIN (SELECT * FROM e WHERE status IS NOT NULL) ON s = id GROUP BY id""",
    "rule_edges": _RULES + """
SELECT e AS "endId", status, count(*)::BIGINT AS n_rows FROM e WHERE status IS NOT NULL GROUP BY ALL""",
    "landed_digests": """
SELECT c_nationkey::INTEGER AS nation, strlen(string_agg(c_name || chr(10), '' ORDER BY c_custkey))::BIGINT AS landed_size, md5(string_agg(c_name || chr(10), '' ORDER BY c_custkey)) AS landed_md5
FROM customer GROUP BY c_nationkey""",
    "graph_round_trip": """
WITH r AS (SELECT 'node' AS kind, 'Nation' AS name, n_nationkey::VARCHAR AS id FROM nation
           UNION ALL SELECT 'edge', 'LIVES_IN', c_custkey::VARCHAR FROM customer UNION ALL SELECT 'edge', 'LIVES_IN', s_suppkey::VARCHAR FROM supplier)
SELECT *, count(*) OVER (PARTITION BY kind)::BIGINT AS n_written, 'nodes/Odd' AS unknown FROM r""",
    "entity_files": f"""
WITH c AS (SELECT * FROM customer WHERE {_CUT}), d AS (SELECT c_custkey::VARCHAR AS id FROM c JOIN orders ON o_custkey = c_custkey)
SELECT 'study' AS name, 'P' || c_nationkey AS key, count(*)::BIGINT AS n_rows FROM c GROUP BY ALL
UNION ALL SELECT 'diagnosis', id, count(*) FROM d GROUP BY ALL UNION ALL SELECT 'observed', 'D' || length(id), count(*) FROM d GROUP BY ALL""",
    "selected_files": """
WITH f AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)
SELECT 'layer' AS selection, k::VARCHAR AS file_id FROM f WHERE k % 4 = 0 AND k % 8 <> 4
UNION ALL SELECT 'program', k::VARCHAR FROM f WHERE k % 4 = 0 AND k % 8 <> 4 AND k % 5 = 3 AND k % 3 = 1
UNION ALL SELECT 'case', k::VARCHAR FROM f WHERE k % 8 = 4 AND c = 7""",
    "patient_survival": """
WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' END AS e, CASE WHEN c_custkey % 7 <> 0 THEN printf('%.2f', (c_custkey % 200) / 4.0)::DOUBLE END AS m FROM customer)
SELECT 'u' || k AS case_id, 'OS' AS survival_type, e AS event, round_even(m * 30.4368, 0)::BIGINT::VARCHAR AS time_days FROM c WHERE k % 4 <> 0 AND e IS NOT NULL AND m IS NOT NULL
UNION ALL SELECT 'u' || k, 'DFI', '0', round_even(12.5 * 30.4368, 0)::BIGINT::VARCHAR FROM c WHERE k % 4 <> 0
UNION ALL SELECT 'unmatched', '', '', count(*)::VARCHAR FROM c WHERE k % 4 = 0""",
}
