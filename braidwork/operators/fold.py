"""Batches folded into graph tables: upserts that are safe to repeat."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.functions.text import blank
from braidwork.operators.bind import quoted
from braidwork.plans.schema import Graph, Node
from braidwork.sources.writers import declared_subtypes

EDGE_KEY = ["startLabel", "startId", "endLabel", "endId"]


def fold_rows(existing: DataFrame | None, batch: DataFrame, keys: list[str], order: str | None = None, deal: tuple[str, int] | None = None) -> DataFrame:
    """Per key and property the last non-empty value; the batch comes after what exists.
    ``deal``: a key that numbers the tasks from 0, and how many there are, for a writer that needs the rows so.

    ``order`` is a column of the batch that says which of its rows is later. Values that
    share a place, or have none because no order was given, are settled by the greatest, so
    the result never depends on how the rows are dealt out.
    """
    own = [c for c in batch.columns if c not in keys and c != order]
    props = list(dict.fromkeys([*([c for c in existing.columns if c not in keys and c != order] if existing is not None else []), *own]))
    at = quoted(order) if order else F.lit(None).cast("long")
    kind = batch.schema[order].dataType if order else "long"

    def part(df: DataFrame, number: int, place: Column) -> DataFrame:
        cells = [(quoted(p) if p in df.columns else F.lit(None).cast("string")).alias(p) for p in props]
        return df.select(*keys, *cells, F.lit(number).alias("_part"), place.alias("_at"))

    rows = part(batch, 1, at)
    if existing is not None:
        rows = part(existing, 0, F.lit(None).cast(kind)).unionByName(rows)
    rows = rows.repartitionById(deal[1], deal[0]) if deal else rows
    last = lambda p: F.max(F.when(blank(quoted(p)) != "", F.struct("_part", "_at", quoted(p).alias("_value"))))["_value"].alias(p)
    # Texts are settled in sorted rows, which the first bytes of the first key tell apart: an id, not a bucket or label.
    return rows.groupBy(*keys[::-1]).agg(*[last(p) for p in props]).select(*keys, *props) if props else rows.select(*keys).distinct()


def upsert_nodes(existing: DataFrame | None, batch: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row for each id: empty values never overwrite, later ones win."""
    return fold_rows(existing, batch.filter(blank(F.col(key)) != ""), [key], order)


def edge_ends(edges: DataFrame, sides: bool = False) -> DataFrame:
    """The distinct (label, id) that edges name, blank ids included. They are reduced
    before the shuffle, so a popular end is sent once a task. ``sides``: with a number
    whose bit 1 says that it is a start of any, bit 2 an end."""
    end = lambda side, *own: F.struct(F.col(f"{side}Label").alias("label"), F.col(f"{side}Id").alias("id"), *own)
    if not sides:
        return edges.select(F.inline(F.array(end("start"), end("end")))).distinct()
    bit = lambda n: F.lit(n).cast("tinyint").alias("sides")
    ends = edges.select(F.inline(F.array(end("start", bit(1)), end("end", bit(2)))))
    return ends.groupBy("id", "label").agg(F.bit_or("sides").alias("sides"))


def mark_lost(batch: DataFrame, unknown: DataFrame, sides: tuple[str, ...] = ("start", "end")) -> DataFrame:
    """The batch with ``_lost``: whether an end is blank or among the unknown (label, id).

    Edges aren't joined with all ids but with the ends that turn out unknown; where those
    are few, Spark broadcasts them and the edges aren't shuffled for it at all. ``sides``: those that can have any.
    """
    out = batch
    for side in sides:
        named = unknown.select(F.col("id").alias(f"{side}Id"), F.col("label").alias(f"{side}Label"), F.lit(True).alias(f"_{side}_no"))
        out = out.join(named, [f"{side}Id", f"{side}Label"], "left")
    lost = [F.col(f"{s}Label").isNull() | (blank(F.col(f"{s}Id")) == "") for s in ("start", "end")] + [F.col(f"_{s}_no").isNotNull() for s in sides]
    return out.select(*[quoted(c) for c in batch.columns], reduce(or_, lost).alias("_lost"))


def _marked(batch: DataFrame, ids: DataFrame) -> DataFrame:
    """The batch with ``_lost``: whether an end is blank or unknown."""
    return mark_lost(batch, edge_ends(batch).join(ids, ["label", "id"], "left_anti"))


def upsert_edges(existing: DataFrame | None, batch: DataFrame, ids: DataFrame, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The folded edges and the edges that were dropped because an end is blank or
    unknown. ``ids`` has the distinct (label, id) of the graph."""
    marked = _marked(batch, ids)
    return fold_rows(existing, marked.filter("not _lost").drop("_lost"), EDGE_KEY, order), marked.filter("_lost").drop("_lost")


def dropped_edges(batch: DataFrame, ids: DataFrame) -> DataFrame:
    return _marked(batch, ids).filter("_lost").drop("_lost")


def extra_labels(node: Node) -> Column:
    """The declared subtypes that a node's subtype cell names, in order."""
    return declared_subtypes(F.col(node.subtype_from), node.subtypes) if node.subtype_from else F.array().cast("array<string>")


def group_by_labels(df: DataFrame, node: Node) -> DataFrame:
    return df.groupBy(F.lit(node.label).alias("label"), F.array_join(extra_labels(node), ":").alias("extra_labels")).agg(F.count("*").alias("n_rows"))


def load_plan(graph: Graph, nodes: dict[str, DataFrame], edges: dict[str, DataFrame]) -> DataFrame:
    """What a load would do: constraints, rows of each label set, rows of each edge type."""
    spark = SparkSession.active()
    out = spark.createDataFrame([("constraint", "", len([n for n in nodes if n in graph.nodes]))], "kind string, name string, n long")
    for label, df in nodes.items():
        if label in graph.nodes:
            part = group_by_labels(df, graph.nodes[label])
            out = out.unionByName(part.select(F.lit("node").alias("kind"), F.concat_ws(":", "label", F.nullif("extra_labels", F.lit(""))).alias("name"), F.col("n_rows").alias("n")))
    for name, df in edges.items():
        if name in graph.edges:
            whole = df.filter((blank(F.col("startId")) != "") & (blank(F.col("endId")) != ""))
            out = out.unionByName(whole.agg(F.count("*").alias("n")).select(F.lit("edge").alias("kind"), F.lit(name).alias("name"), "n"))
    return out


def unique_key_check(nodes: DataFrame, key: str) -> DataFrame:
    return nodes.groupBy(key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
