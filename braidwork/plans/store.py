"""A stored graph in buckets of its keys, into which batches are folded.

Each node table is cut by a hash of the id and each edge table by a hash of its whole key, so
a popular end doesn't fill one bucket. A bucket is a partition folder. A fold reads and
rewrites only the buckets that the batch's keys fall in, by dynamic partition overwrite: what a small batch
costs follows the batch and the size of a bucket, not the store. Folding a batch again
changes nothing, so a fold that failed between two tables is repeated whole.

The number of buckets and the columns of the tables stand in a small layout beside them; each
change adds a version, the greatest holds. Stored columns are text. Rows dealt by bucket make one
file a bucket, so ``buckets`` should be chosen to hold some hundred MB each.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.functions.text import blank
from braidwork.operators import fold
from braidwork.plans.schema import Graph
from braidwork.sources.readers import ORDER_AT, path_exists, read_graph
from braidwork.sources.writers import counted

BUCKET = "_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


class Layout:
    """Number of buckets, and columns of each (kind, name)."""

    def __init__(self, buckets: int, columns: dict[tuple[str, str], list[str]] | None = None, version: int = 0):
        self.buckets, self.columns, self.version = buckets, columns or {}, version

    @classmethod
    def read(cls, spark: SparkSession, store: str) -> Layout:
        r = spark.read.schema("version int, buckets int, columns string").json(f"{store}/layout").orderBy(F.desc("version")).first()
        return cls(r["buckets"], {(k, n): c for k, n, c in json.loads(r["columns"])}, r["version"])

    def write(self, spark: SparkSession, store: str) -> None:
        self.version += 1
        row = (self.version, self.buckets, json.dumps([(k, n, c) for (k, n), c in self.columns.items()]))
        spark.createDataFrame([row], "version int, buckets int, columns string").coalesce(1).write.mode("append").json(f"{store}/layout")

    def widen(self, kind: str, name: str, columns: list[str]) -> bool:
        """Adds columns that a table lacks; whether any was new."""
        known = self.columns.setdefault((kind, name), [])
        new = [c for c in columns if c not in known]
        known += new
        return bool(new)


def _path(store: str, kind: str, name: str) -> str:
    return f"{store}/{kind}/{name}.parquet"


def _stored(spark: SparkSession, store: str, layout: Layout, kind: str, name: str, buckets: list[int] | None = None) -> DataFrame | None:
    """A stored table with its bucket; only the given buckets' folders are read."""
    if (kind, name) not in layout.columns or not path_exists(spark, _path(store, kind, name)):
        return None
    schema = T.StructType([T.StructField(c, T.StringType()) for c in layout.columns[kind, name]] + [T.StructField(BUCKET, T.IntegerType())])
    df = spark.read.schema(schema).parquet(_path(store, kind, name))
    return df if buckets is None else df.filter(F.col(BUCKET).isin(buckets))


def _fold_in(spark: SparkSession, store: str, layout: Layout, kind: str, name: str, batch: DataFrame, keys: list[str], order: str | None) -> tuple[int, int]:
    """Folds a batch, with its buckets, into a table; rows written and buckets touched. Rows of one key
    are settled together with the stored one, where all are dealt by bucket."""
    touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # at most the number of buckets
    if not touched:
        return 0, 0
    old = _stored(spark, store, layout, kind, name, touched)
    out = fold.fold_rows(old, batch, [BUCKET, *keys], order, deal=(BUCKET, layout.buckets))
    write = lambda df: df.write.partitionBy(BUCKET).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(_path(store, kind, name))
    return counted(out, write)["n"], len(touched)


def _as_stored(df: DataFrame, keys: list[str], order: str | None, buckets: int) -> tuple[DataFrame, str | None]:
    """A batch as text with its buckets, and the column of its order. Values of other types are settled among
    themselves before they become text, since the greatest number isn't the greatest text."""
    if any(kind != "string" for c, kind in df.dtypes if c not in keys and c != order):
        df, order = fold.fold_rows(None, df, keys, order), None
    text = [F.col(f"`{c}`") if c == order else F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]
    return df.select(*text, bucket_of(keys, buckets).alias(BUCKET)), order


def _unknown_ends(spark: SparkSession, graph: Graph, store: str, layout: Layout, batch: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """The (label, id) of the batch's ends that the store lacks, without blank ones, and the sides that have
    any. Only the buckets they fall in are read."""
    ends = fold.edge_ends(batch, sides=True).filter("id <> '' AND label IS NOT NULL").persist()
    try:
        places: dict[str, list[int]] = {}
        for label, bucket in ends.select("label", bucket_of(["id"], layout.buckets)).distinct().collect():  # labels times buckets at most
            places.setdefault(label, []).append(bucket)
        known = spark.createDataFrame([], "label string, id string")
        for label, buckets in places.items():
            table = _stored(spark, store, layout, "nodes", label, buckets) if label in graph.nodes else None
            if table is not None:
                known = known.unionByName(table.select(F.lit(label).alias("label"), F.col(graph.nodes[label].key).alias("id")))
        unknown = ends.join(known.filter("id <> ''"), ["id", "label"], "left_anti").persist()
        # Read once, so that Spark knows its size from here on, and the ends are needed no more.
        bits = unknown.agg(F.bit_or("sides")).first()[0] or 0
        return unknown, tuple(s for s, bit in (("start", 1), ("end", 2)) if bits & bit)
    finally:
        ends.unpersist()


def create_store(spark: SparkSession, graph: Graph, store: str, nodes: dict[str, DataFrame], edges: dict[str, DataFrame], buckets: int = 256, order: str | None = None) -> DataFrame:
    """A new store with its first tables; the report of their fold."""
    if path_exists(spark, f"{store}/layout"):
        raise ValueError(f"{store} is a store already")
    Layout(buckets).write(spark, store)
    return fold_batch(spark, graph, store, nodes, edges, "first", order)


def fold_batch(spark: SparkSession, graph: Graph, store: str, nodes: dict[str, DataFrame], edges: dict[str, DataFrame], batch: str, order: str | None = None) -> DataFrame:
    """Folds node tables and then edge tables into a store: (kind, name, n_rows, n_buckets,
    n_dropped), the rows and number of the buckets that were rewritten and the edges that were
    dropped because an end is blank or unknown. Those stand in ``dropped`` by type and ``batch``.
    Tables that the graph doesn't declare are left out."""
    layout, report = Layout.read(spark, store), []
    own_order = lambda df: order if order and order in df.columns else None
    tables = [("nodes", n, df) for n, df in nodes.items() if n in graph.nodes] + [("edges", n, df) for n, df in edges.items() if n in graph.edges]
    if any([layout.widen(kind, name, [c for c in df.columns if c != own_order(df)]) for kind, name, df in tables]):
        layout.write(spark, store)
    for name, df in nodes.items():
        if name in graph.nodes:
            key = graph.nodes[name].key
            rows, at = _as_stored(df.filter(blank(F.col(key)) != ""), [key], own_order(df), layout.buckets)
            rows = rows.persist()
            try:
                report.append(("node", name, *_fold_in(spark, store, layout, "nodes", name, rows, [key], at), 0))
            finally:
                rows.unpersist()
    for name, df in edges.items():
        if name in graph.edges:
            df = df.withColumns({k: F.col(k).cast("string") for k in fold.EDGE_KEY})
            unknown, sides = _unknown_ends(spark, graph, store, layout, df)
            marked = fold.mark_lost(df, unknown, sides).persist()  # both the kept and the dropped come from it
            try:
                kept, at = _as_stored(marked.filter("not _lost").drop("_lost"), fold.EDGE_KEY, own_order(df), layout.buckets)
                done = _fold_in(spark, store, layout, "edges", name, kept, fold.EDGE_KEY, at)
                lost = marked.filter("_lost").select("startId", "endId", "startLabel", "endLabel", F.lit(name).alias("type"), F.lit(batch).alias("batch"))
                put = lambda x: x.write.partitionBy("type", "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{store}/dropped")
                report.append(("edge", name, *done, counted(lost, put)["n"]))
            finally:
                marked.unpersist()
                unknown.unpersist()
    return spark.createDataFrame(report, "kind string, name string, n_rows long, n_buckets int, n_dropped long")


def fold_folder(spark: SparkSession, graph: Graph, store: str, folder: str, batch: str) -> DataFrame:
    """Folds a dataset's graph folder; of rows with one id the later by file and place wins."""
    nodes, edges, _ = read_graph(spark, folder, graph, ordered=True)
    return fold_batch(spark, graph, store, nodes, edges, batch, ORDER_AT)


def read_store(spark: SparkSession, store: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Node and edge tables of a store."""
    layout, out = Layout.read(spark, store), {"nodes": {}, "edges": {}}
    for kind, name in layout.columns:
        table = _stored(spark, store, layout, kind, name)
        if table is not None:
            out[kind][name] = table.drop(BUCKET)
    return out["nodes"], out["edges"]


def dropped(spark: SparkSession, store: str) -> DataFrame:
    """The edges that folds dropped, by type and batch."""
    return spark.read.schema("startId string, endId string, startLabel string, endLabel string, type string, batch string").parquet(f"{store}/dropped")
