"""Checks of keys, references and files. A problem row says table, key, kind, value, count."""

from __future__ import annotations

import re
from urllib.parse import quote, unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.functions.text import blank
from braidwork.plans.schema import Graph

PROBLEM = "table string, key string, kind string, value string, n long"


def _problem(rows: DataFrame, table: str, key: str, kind: str, value: Column, n: Column) -> DataFrame:
    return rows.select(F.lit(table).alias("table"), F.lit(key).alias("key"), F.lit(kind).alias("kind"), value.alias("value"), n.cast("long").alias("n"))


def blank_ids(df: DataFrame, table: str, key: str) -> DataFrame:
    rows = df.filter(F.trim(blank(F.col(key))) == "").agg(F.count("*").alias("c")).filter("c > 0")
    return _problem(rows, table, key, "blank", F.lit(""), F.col("c"))


def duplicate_ids(df: DataFrame, table: str, key: str) -> DataFrame:
    """Each repeated id with its rows after the first."""
    ident = F.trim(blank(F.col(key)))
    rows = df.filter(ident != "").groupBy(ident.alias("v")).agg(F.count("*").alias("c")).filter("c > 1")
    return _problem(rows, table, key, "duplicate", F.col("v"), F.col("c") - 1)


def known_ids(nodes: dict[str, DataFrame], graph: Graph, *references: dict[str, DataFrame]) -> DataFrame | None:
    """Distinct (label, id) of the node tables and of reference datasets."""
    out = None
    for tables in (nodes, *references):
        for label, df in tables.items():
            if label in graph.nodes and graph.nodes[label].key in df.columns:
                part = df.select(F.lit(label).alias("label"), F.trim(blank(F.col(graph.nodes[label].key))).alias("id"))
                out = part if out is None else out.unionByName(part)
    return None if out is None else out.filter("id <> ''").distinct()


def dangling_endpoints(edges: DataFrame, name: str, ids: DataFrame, loaded: set[str] | None = None) -> DataFrame:
    """Ends of edges whose label has no table, or whose id that table lacks. Ends are
    counted before they are joined, so a popular id is looked up once a task. ``loaded``
    names the labels that have a table; without it they are read from ``ids``."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.lit("startId").alias("key"), F.col("startLabel").alias("label"), blank(F.col("startId")).alias("id")),
                F.struct(F.lit("endId").alias("key"), F.col("endLabel").alias("label"), blank(F.col("endId")).alias("id")),
            )
        ).alias("e")
    ).select("e.*")
    counted = ends.groupBy("key", "label", "id").agg(F.count("*").alias("c"))
    lost = counted.join(ids, ["label", "id"], "left_anti")
    if loaded is None:
        labels = ids.select("label").distinct().withColumn("loaded", F.lit(True))
        out = lost.join(labels, "label", "left")
    else:
        out = lost.withColumn("loaded", F.col("label").isin(sorted(loaded)) if loaded else F.lit(False))
    kind = F.when(F.col("loaded"), F.lit("dangling")).otherwise(F.lit("label not loaded"))
    return out.select(F.lit(name).alias("table"), "key", kind.alias("kind"), F.concat_ws(":", "label", "id").alias("value"), F.col("c").alias("n"))


def problems(graph: Graph, nodes: dict[str, DataFrame], edges: dict[str, DataFrame], *references: dict[str, DataFrame]) -> DataFrame:
    """All problems of a graph's tables."""
    spark = SparkSession.active()
    fixed, parts = [], []
    for label, df in nodes.items():
        if label not in graph.nodes:
            fixed.append((label, "", "label not declared", "", 1))
        elif graph.nodes[label].key not in df.columns:
            fixed.append((label, graph.nodes[label].key, "id column missing", "", 1))
        else:
            parts += [blank_ids(df, label, graph.nodes[label].key), duplicate_ids(df, label, graph.nodes[label].key)]
    ids = known_ids(nodes, graph, *references)
    if ids is None:
        ids = spark.createDataFrame([], "label string, id string")
    loaded = {label for t in (nodes, *references) for label, df in t.items() if label in graph.nodes and graph.nodes[label].key in df.columns}
    for name, df in edges.items():
        if name not in graph.edges:
            fixed.append((name, "", "edge type not declared", "", 1))
        parts.append(dangling_endpoints(df, name, ids, loaded))
    out = spark.createDataFrame(fixed, PROBLEM)
    for p in parts:
        out = out.unionByName(p)
    return out


def validation_report(graph: Graph, nodes: dict[str, DataFrame], edges: dict[str, DataFrame], *references: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """node_types, node_ids, edges and problems as one row; strict raises on a problem."""
    found = problems(graph, nodes, edges, *references)
    spark = found.sparkSession
    ids = known_ids(nodes, graph)
    parts = [
        spark.createDataFrame([("node_types", len(nodes))], "name string, n long"),
        (ids if ids is not None else spark.createDataFrame([], "id string")).agg(F.count("*").alias("n")).select(F.lit("node_ids").alias("name"), "n"),
        found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("problems").alias("name"), "n"),
    ]
    parts += [df.agg(F.count("*").alias("n")).select(F.lit("edges").alias("name"), "n") for df in edges.values()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    total = lambda name: F.coalesce(F.sum(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).cast("long").alias(name)
    out = rows.agg(*[total(n) for n in ("node_types", "node_ids", "edges", "problems")])
    if strict and out.first()["problems"]:
        raise ValueError("the graph has problems")
    return out


def endpoint_preflight(graph: Graph, nodes: dict[str, DataFrame], edges: dict[str, DataFrame]) -> DataFrame:
    """Endpoint labels that the edges expect and that have no rows."""
    spark = SparkSession.active()
    wanted = sorted({end for e in edges if e in graph.edges for p in graph.edges[e].pairs for end in p})
    out = spark.createDataFrame([(w,) for w in wanted], "label string")
    have = known_ids(nodes, graph)
    return out if have is None else out.join(have.select("label").distinct(), "label", "left_anti")


#: Stores that tasks can open by themselves.
STREAMED = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def open_landed(path: str):
    """A stream of a landed file, opened in a task."""
    from pyarrow import fs

    scheme = urlsplit(path).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_stream("/" + path.removeprefix("file:").lstrip("/"))
    store, name = fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe=":/"))
    return store.open_input_stream(name)


def landed_files(spark: SparkSession, folder: str, checksums: bool = False, opener=None, chunk: int = 1 << 20) -> DataFrame:
    """(path, landed_size, landed_md5) of the files below a folder.

    Files are listed without their contents. Sums are read in chunks by the task that the file
    is dealt to, so a file of any size takes bounded memory. ``opener`` gives a stream for a
    path; by default files in stores named in STREAMED are opened so, and those of other stores
    are read by Spark whole, which holds up to 2 GB a file.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    read = _with_sums(spark, files, folder, opener, chunk) if checksums else files.select("path", F.col("length").alias("landed_size"), F.lit(None).cast("string").alias("landed_md5"))
    # A scan skips files without a byte; they are known from the listing, which the driver has made for it.
    listed = [(re.sub("^file:/+", "file:/", unquote(p)),) for p in files.inputFiles()]
    empty = spark.createDataFrame(listed, "path string").join(files.select("path"), "path", "left_anti")
    return read.unionByName(empty.select("path", F.lit(0).cast("long").alias("landed_size"), F.md5(F.lit("")).alias("landed_md5")))


def _with_sums(spark: SparkSession, files: DataFrame, folder: str, opener, chunk: int) -> DataFrame:
    jvm = spark.sparkContext._jvm
    full = jvm.org.apache.hadoop.fs.Path(folder)
    scheme = urlsplit(full.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(full).toString()).scheme
    if opener is None and scheme not in STREAMED:
        return files.select("path", F.col("length").alias("landed_size"), F.md5("content").alias("landed_md5"))
    get = opener or open_landed

    def run(batches):
        import hashlib

        import pyarrow as pa

        for b in batches:
            sums = []
            for path in b.column(0).to_pylist():
                h = hashlib.md5()
                with get(path) as f:
                    while part := f.read(chunk):
                        h.update(part)
                sums.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sums, pa.string())], names=["path", "landed_size", "landed_md5"])

    return files.select("path", F.col("length").alias("landed_size")).mapInArrow(run, "path string, landed_size long, landed_md5 string")


def verify_manifest(spark: SparkSession, folder: str, manifest: DataFrame, checksums: bool = False, opener=None) -> DataFrame:
    """The status of each manifest entry against the files below a folder."""
    part = lambda k: F.element_at(F.split("path", "/"), k)
    landed = landed_files(spark, folder, checksums, opener).select(part(-2).alias("id"), part(-1).alias("filename"), "landed_size", "landed_md5")
    return compare_manifest(manifest, landed, checksums)


def compare_manifest(manifest: DataFrame, landed: DataFrame, checksums: bool = False) -> DataFrame:
    """id, filename and status of each entry; ``landed`` has id, filename, landed_size and
    landed_md5."""
    status = (
        F.when(F.col("landed_size").isNull(), "missing")
        .when(F.col("landed_size") != F.col("size").cast("long"), "size mismatch")
        .when(F.lit(checksums) & (F.col("landed_md5") != F.lower("md5")), "md5 mismatch")
        .otherwise("ok")
    )
    return manifest.join(landed, ["id", "filename"], "left").select("id", "filename", status.alias("status"))
