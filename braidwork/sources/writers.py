"""Writers of entity, observation and graph tables and of bulk import layouts."""

from __future__ import annotations

import csv
import io
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from braidwork.functions.text import blank, scrub
from braidwork.plans.schema import Edge, Graph

CSV = {"header": True, "escape": '"', "quote": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def counted(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict[str, int]:
    """Writes a table and returns its rows as ``n`` and other aggregates, gathered by the
    write's own job."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in metrics.items()]))
    return {k: v or 0 for k, v in seen.get.items()}


def write_entities(tables: dict[str, DataFrame], folder: str, as_text: bool = False) -> None:
    for name, df in tables.items():
        if as_text:
            df.write.mode("overwrite").csv(f"{folder}/{name}.tsv", sep="\t", **CSV)
        else:
            df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def write_observations(df: DataFrame, columns: list[str], path: str) -> None:
    """The contract's columns in order, partitioned by source_dataset."""
    have = [c if c in df.columns else F.lit("").alias(c) for c in columns]
    df.select(*have, *[c for c in df.columns if c not in columns]).write.mode("overwrite").partitionBy("source_dataset").parquet(path)


def write_graph(nodes: dict[str, DataFrame], edges: dict[str, DataFrame], folder: str) -> dict[tuple[str, str], int]:
    """Each label and type once, from the union of its sources; the rows of each table as
    (kind, name), counted as they are written."""
    counts = {}
    for kind, tables in (("node", nodes), ("edge", edges)):
        for name, df in tables.items():
            counts[kind, name] = counted(df, lambda x, at=f"{folder}/{kind}s/{name}.parquet": x.write.mode("overwrite").parquet(at))["n"]
    return counts


def bulk_nodes(df: DataFrame, graph: Graph, label: str) -> DataFrame:
    """A node table under bulk import headers; rows without an id go."""
    node = graph.nodes[label]
    props = [blank(F.col(p)).alias(p if t == "string" else f"{p}:{t}") for p, t in node.properties.items() if p in df.columns]
    labels = []
    if node.subtype_from and node.subtype_from in df.columns:
        labels = [F.array_join(F.concat(F.array(F.lit(label)), declared_subtypes(F.col(node.subtype_from), node.subtypes)), ";").alias(":LABEL")]
    return df.filter(scrub(F.col(node.key), ()) != "").select(F.col(node.key).alias(f"{node.key}:ID({label})"), *props, *labels)


def declared_subtypes(cell, allowed) -> Column:
    """The declared labels of a cell split at : ; and comma, in order."""
    parts = F.transform(F.split(blank(cell), "[:;,]"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x.isin(list(allowed)))


def _edge_properties(df: DataFrame, edge: Edge) -> list[Column]:
    return [blank(F.col(p)).alias(p if t == "string" else f"{p}:{t}") for p, t in edge.properties.items() if p in df.columns]


def bulk_edges(df: DataFrame, graph: Graph, name: str, start: str, end: str) -> DataFrame:
    """The edges of one label pair under bulk import headers."""
    ends = F.col("startId").alias(f":START_ID({start})"), F.col("endId").alias(f":END_ID({end})")
    return df.filter(_is_pair(start, end)).select(*ends, *_edge_properties(df, graph.edges[name]))


def edge_pairs(df: DataFrame) -> DataFrame:
    """Rows of each label pair: what a split by pair writes."""
    return df.groupBy("startLabel", "endLabel").agg(F.count("*").alias("n_rows"))


HEADER = "_header.csv"


@dataclass(frozen=True)
class BulkFile:
    """A folder of headless CSV files of one label, or one type and label pair, with its
    header file beside them. Readers of folders skip names that start with an underscore."""

    kind: str
    name: str
    path: str
    n_rows: int


def _put_header(spark: SparkSession, folder: str, columns: list[str]) -> None:
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerow(columns)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{folder}/{HEADER}")
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(text.getvalue().encode())
    out.close()


def pair_path(name: str, start: str, end: str) -> str:
    return f"edges/{name}/startLabel={start}/endLabel={end}"


def _is_pair(start: str, end: str) -> Column:
    return (F.col("startLabel") == start) & (F.col("endLabel") == end)


def write_bulk(nodes: dict[str, DataFrame], edges: dict[str, DataFrame], graph: Graph, folder: str) -> list[BulkFile]:
    """Writes the bulk layout, one job a table: an edge type is split by label pair as it is
    written, and rows are counted by the same job. Rows of pairs that the graph doesn't
    declare, and pairs without rows, are left out. Returns what was written."""
    plain, out = CSV | {"header": False}, []
    for label, df in nodes.items():
        if label in graph.nodes:
            data, path = bulk_nodes(df, graph, label), f"nodes/{label}"
            n = counted(data, lambda x, at=path: x.write.mode("overwrite").csv(f"{folder}/{at}", **plain))["n"]
            _put_header(df.sparkSession, f"{folder}/{path}", data.columns)
            out.append(BulkFile("node", label, path, n))
    for name, df in edges.items():
        pairs = graph.edges[name].pairs if name in graph.edges else []
        declared = [(s, e) for s, e in pairs if s in graph.nodes and e in graph.nodes]
        if not declared:
            continue
        some = F.lit(False)
        for s, e in declared:
            some = some | _is_pair(s, e)
        data = df.filter(some).select("startId", "endId", *_edge_properties(df, graph.edges[name]), "startLabel", "endLabel")
        n = counted(
            data, lambda x, at=name: x.write.mode("overwrite").partitionBy("startLabel", "endLabel").csv(f"{folder}/edges/{at}", **plain),
            **{f"n{k}": F.count_if(_is_pair(s, e)) for k, (s, e) in enumerate(declared)},
        )
        for k, (s, e) in enumerate(declared):
            if n[f"n{k}"]:
                _put_header(df.sparkSession, f"{folder}/{pair_path(name, s, e)}", bulk_edges(df, graph, name, s, e).columns)
                out.append(BulkFile("edge", name, pair_path(name, s, e), n[f"n{k}"]))
    return out


def written_manifest(spark: SparkSession, datasets: dict[str, list[BulkFile]]) -> DataFrame:
    """(dataset, kind, name, path, n_rows) of what write_bulk returned for each dataset."""
    rows = [(d, f.kind, f.name, f"{d}/{f.path}", f.n_rows) for d, files in datasets.items() for f in files]
    return spark.createDataFrame(rows, "dataset string, kind string, name string, path string, n_rows long")


def constraints_of(graph: Graph, datasets: dict[str, list[str]]) -> list[tuple[str, str]]:
    """(label, key) of the labels of several datasets, each once, in order of first use."""
    return list(dict.fromkeys((name, graph.nodes[name].key) for names in datasets.values() for name in names if name in graph.nodes))


def bulk_manifest(spark: SparkSession, datasets: dict[str, tuple[dict, dict]], graph: Graph) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(dataset, kind, name, path, n_rows) of what writing the tables of several datasets
    would make, each edge type by label pair, and the uniqueness constraints."""
    out = spark.createDataFrame([], "dataset string, kind string, name string, path string, n_rows long")
    for dataset, (nodes, edges) in datasets.items():
        for name, df in nodes.items():
            if name in graph.nodes:
                counts = bulk_nodes(df, graph, name).agg(F.count("*").alias("n_rows"))
                out = out.unionByName(counts.select(F.lit(dataset).alias("dataset"), F.lit("node").alias("kind"), F.lit(name).alias("name"), F.lit(f"{dataset}/nodes/{name}").alias("path"), "n_rows"))
        for name, df in edges.items():
            if name in graph.edges:
                pairs = spark.createDataFrame([(s, e, f"{dataset}/{pair_path(name, s, e)}") for s, e in graph.edges[name].pairs], "startLabel string, endLabel string, path string")
                counts = edge_pairs(df).join(pairs, ["startLabel", "endLabel"])
                out = out.unionByName(counts.select(F.lit(dataset).alias("dataset"), F.lit("edge").alias("kind"), F.lit(name).alias("name"), "path", "n_rows"))
    return out, constraints_of(graph, {d: list(nodes) for d, (nodes, _) in datasets.items()})


def file_manifest(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("file_id").alias("id"), F.col("file_name").alias("filename"), F.col("md5sum").alias("md5"), F.col("file_size").alias("size"), F.lit("validated").alias("state")
    )


def file_metadata(files: DataFrame, provenance: DataFrame, with_sample: bool = True) -> DataFrame:
    """file_id, file_name, sample_id, assay_id and pipeline_version of each file; layers
    whose files hold several samples leave sample_id out."""
    rows = files.select("file_id", "file_name").join(provenance, "file_id")
    return rows.select("file_id", "file_name", *(["sample_id"] if with_sample else []), "assay_id", "pipeline_version")
