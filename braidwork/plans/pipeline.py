"""Whole datasets: reshape, bind, check and fold from folders to graph folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.operators import audit, bind, fold, reshape
from braidwork.plans.schema import Graph, Profile
from braidwork.sources.readers import ORDER_AT, path_exists, read_graph, resolve_source
from braidwork.sources.writers import write_graph


def known_samples(spark: SparkSession, graph: Graph, profile: Profile, raw: str, label: str = "Sample") -> DataFrame | None:
    """Sample ids of the raw metadata, or None if the profile has no sample table there."""
    b = profile.nodes.get(label)
    if b is None or label not in graph.nodes:
        return None
    sources = [df for df in (resolve_source(spark, s, raw, raw) for s in b.sources if path_exists(spark, f"{raw}/{s}")) if df is not None]
    nodes = bind.bind_nodes(graph, b, sources, profile) if sources else None
    return None if nodes is None else nodes.select(F.col(graph.nodes[label].key).alias("sample_id"))


def reshape_dataset(spark: SparkSession, graph: Graph, profile: Profile, dataset: str, raw: str, interim: str) -> list[tuple[str, str, str]]:
    """Runs the reshape steps of a profile and writes their tables as Parquet to interim:
    (input, status, reason) of each. A step that is skipped clears what it wrote before."""
    out = []
    known = known_samples(spark, graph, profile, raw)
    for spec in profile.reshape:
        main = spec.get("output") or f"{spec.get('observation', 'variation')}_observation.tsv"
        rows, second, why = reshape.reshape(spark, spec, raw, known, dataset)
        skipped = rows is None
        if skipped:
            rows = spark.createDataFrame([], "sample_id string")
        rows.write.mode("overwrite").parquet(f"{interim}/{main}.parquet")
        if spec["type"] == "vcf" and spec.get("gene_edge_output"):
            genes = second if second is not None else spark.createDataFrame([], "variant_id string, gene_id string")
            genes.write.mode("overwrite").parquet(f"{interim}/{spec['gene_edge_output']}.parquet")
        out.append((spec["input"], "skipped" if skipped else "reshaped", why))
    return out


def standardise_dataset(spark: SparkSession, graph: Graph, profile: Profile, dataset: str, raw: str, interim: str, out: str, order=None) -> DataFrame:
    """Reshapes, binds and writes a dataset's graph tables; returns the summary with the
    rows of every table and why others were skipped. Without ``order`` the first row of an
    id is the first by source, file and place in the file."""
    steps = reshape_dataset(spark, graph, profile, dataset, raw, interim)
    nodes, edges, status = bind.standardise(spark, graph, profile, lambda name: resolve_source(spark, name, interim, raw, ordered=True), order)
    counts = write_graph(nodes, edges, out)
    return bind.counted_summary(spark, counts, [("reshape", name, state, why) for name, state, why in steps] + status)


def validate_dataset(spark: SparkSession, graph: Graph, folder: str, references: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    nodes, edges, unknown = read_graph(spark, folder, graph)
    others = [read_graph(spark, r, graph)[0] for r in references]
    out = audit.validation_report(graph, nodes, edges, *others, strict=strict)
    return out.withColumn("unknown_tables", F.lit(",".join(unknown)))


def fold_dataset(spark: SparkSession, graph: Graph, store: str, batch: str, out: str) -> DataFrame:
    """Folds a dataset's graph folder into a stored graph and writes the result to ``out``:
    nodes first, then edges between nodes that exist. Of a batch's rows with one id the
    later by file and place wins. Returns the dropped edges."""
    old_nodes, old_edges, _ = read_graph(spark, store, graph)
    new_nodes, new_edges, _ = read_graph(spark, batch, graph, ordered=True)
    nodes = {n: fold.upsert_nodes(old_nodes.get(n), new_nodes[n], graph.nodes[n].key, ORDER_AT) if n in new_nodes else old_nodes[n] for n in dict.fromkeys([*old_nodes, *new_nodes])}
    ids = audit.known_ids(nodes, graph)
    edges, dropped = dict(old_edges), spark.createDataFrame([], "type string, startId string, endId string, startLabel string, endLabel string")
    for name, df in new_edges.items():
        edges[name], lost = fold.upsert_edges(old_edges.get(name), df, ids, ORDER_AT)
        dropped = dropped.unionByName(lost.select(F.lit(name).alias("type"), "startId", "endId", "startLabel", "endLabel"))
    write_graph(nodes, edges, out)
    return dropped
