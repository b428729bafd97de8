"""Raw tables bound to node and edge tables of a declared graph."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from braidwork.functions.text import PLACEHOLDERS, blank, is_zero, mint_id, scrub, strip_prefix
from braidwork.plans.names import Columns
from braidwork.plans.schema import Binding, Graph, Profile
from braidwork.sources.readers import ORDER_AT

#: Label: the source columns of its minted id and the function that builds it from their
#: scrubbed cells.
KEY_BUILDERS: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {
    "ExpressionObservation": (("sample_id", "gene_id"), lambda *c: mint_id(list(c), placeholders=None)),
    "MethylationObservation": (("sample_id", "cpg_id"), lambda *c: mint_id(list(c), placeholders=None)),
    "VariantObservation": (("sample_id", "variant_id"), lambda *c: mint_id(list(c), placeholders=None)),
    "Survival": (("case_id", "survival_type"), lambda *c: mint_id(list(c), placeholders=None)),
    "Condition": (("icd_10_code",), lambda c: mint_id([F.lit("ICD10"), c], placeholders=None)),
}

#: A source with one of these columns loses the rows where it is zero.
ZERO_COLUMNS = ("expression_value",)


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def cell(df: DataFrame, name: str, placeholders=PLACEHOLDERS) -> Column:
    """A column's scrubbed text. Numbers and dates have nothing to trim and no placeholders."""
    return scrub(quoted(name), placeholders) if isinstance(df.schema[name].dataType, StringType) else blank(quoted(name))


def exclude_zero_rows(df: DataFrame, columns=ZERO_COLUMNS) -> DataFrame:
    for c in columns:
        if c in df.columns:
            df = df.filter(~is_zero(quoted(c)))
    return df


def dedup_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key by ``order``. Aggregated before the shuffle, so a key
    with very many rows sends at most one row a task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min_by(F.struct(*[quoted(c) for c in rest]) if rest else F.lit(1), F.struct(*[quoted(c) for c in order]))
    out = df.groupBy(*[quoted(k) for k in keys]).agg(first.alias("_first"))
    return out.select(*keys, *[F.col("_first")[c].alias(c) for c in rest])


def _key(df: DataFrame, label: str, column: str | None, prefix: str | None, placeholders, builders) -> Column | None:
    """The id of a label from a source, or None if the source lacks a column for it."""
    if label in builders:
        columns, build = builders[label]
        return build(*[cell(df, c, placeholders) for c in columns]) if set(columns) <= set(df.columns) else None
    if column is None or column not in df.columns:
        return None
    return strip_prefix(cell(df, column, placeholders), prefix)


def _columns(df: DataFrame, binding: Binding, profile: Profile | None) -> Columns:
    headers = [c for c in df.columns if not c.startswith("_order")]
    return Columns(
        headers, binding.overrides, binding.aliases, profile.aliases if profile else None, profile.shared_aliases if profile else None,
        binding.header_prefixes or (profile.header_prefixes if profile else ()),
    )


def _properties(df: DataFrame, names, binding: Binding, profile: Profile | None, placeholders) -> list[Column]:
    found = _columns(df, binding, profile)
    out = []
    for p in names:
        raw = found.find(p).column
        out.append((cell(df, raw, placeholders) if raw else F.lit("")).alias(p))
    return out


def _union(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def _ordered(df: DataFrame, number: int, order: str | list[str] | None) -> tuple[DataFrame, list[str]]:
    """Adds the order of a source's rows: its place in the list, then ``order``, or the
    place in its file of a table read with ``ordered``, or else the order in which Spark
    reads the rows."""
    names = [order] if isinstance(order, str) else list(order or ())
    if not names and ORDER_AT in df.columns:
        names = [ORDER_AT]
    by = [quoted(c) for c in names] or [F.monotonically_increasing_id()]
    return df.withColumns({"_order0": F.lit(number), "_order1": F.struct(*[b.alias(f"o{k}") for k, b in enumerate(by)])}), ["_order0", "_order1"]


def bind_nodes(graph: Graph, binding: Binding, sources: list[DataFrame], profile: Profile | None = None, order=None, placeholders=PLACEHOLDERS, builders=KEY_BUILDERS) -> DataFrame | None:
    """The node table of ``binding.name``; None if no source has the key."""
    node = graph.nodes[binding.name]
    parts, by = [], []
    for k, df in enumerate(sources):
        df, by = _ordered(exclude_zero_rows(df), k, order)
        key = _key(df, node.label, binding.keys[0], binding.strip[0], placeholders, builders)
        if key is None:
            continue
        names = [*node.properties, *([node.subtype_from] if node.subtype_from else [])]
        parts.append(df.select(key.alias(node.key), *_properties(df, names, binding, profile, placeholders), *by).filter(F.col(node.key) != ""))
    out = _union(parts)
    if out is None:
        return None
    return dedup_first(out, [node.key], by) if binding.dedup else out.drop(*by)


def bind_edges(graph: Graph, binding: Binding, sources: list[DataFrame], profile: Profile | None = None, order=None, placeholders=PLACEHOLDERS, builders=KEY_BUILDERS) -> DataFrame | None:
    """The edge table of ``binding.name``. The label pair must be one of the type's."""
    edge = graph.edges[binding.name]
    pair = binding.pair or edge.pairs[0]
    if tuple(pair) not in edge.pairs:
        raise ValueError(f"{binding.name}: {pair} is not a declared pair")
    parts, by = [], []
    for k, df in enumerate(sources):
        df, by = _ordered(exclude_zero_rows(df), k, order)
        ends = [_key(df, label, column, prefix, placeholders, builders) for label, column, prefix in zip(pair, binding.keys, binding.strip, strict=True)]
        if any(e is None for e in ends):
            continue
        rows = df.select(ends[0].alias("startId"), ends[1].alias("endId"), F.lit(pair[0]).alias("startLabel"), F.lit(pair[1]).alias("endLabel"), *_properties(df, edge.properties, binding, profile, placeholders), *by)
        parts.append(rows.filter("startId <> '' and endId <> ''"))
    out = _union(parts)
    if out is None:
        return None
    if not binding.dedup:
        return out.drop(*by)
    return dedup_first(out, ["startId", "endId"], by).select(*edge.columns)


def sample_values(df: DataFrame, columns: list[str], most: int = 5) -> DataFrame:
    """(column, value) of the smallest distinct non-empty values of each column."""
    from pyspark.sql import Window

    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), blank(quoted(c)).alias("value")) for c in columns])).alias("x")).select("x.*")
    seen = cells.filter("value <> ''").distinct()
    return seen.withColumn("n", F.row_number().over(Window.partitionBy("column").orderBy("value"))).filter(F.col("n") <= most).drop("n")


def binding_report(graph: Graph, profile: Profile, sources: dict[str, DataFrame], placeholders=PLACEHOLDERS) -> DataFrame:
    """One row for each property, unused column and ambiguous header of every binding."""
    rows, spark = [], None
    filled: dict[tuple[str, str], None] = {}
    for kind, bindings in (("node", profile.nodes), ("edge", profile.edges)):
        for b in bindings.values():
            declared = (graph.nodes if kind == "node" else graph.edges).get(b.name)
            source = next((s for s in b.sources if s in sources), None)
            if declared is None or source is None:
                rows.append((kind, b.name, source, "skipped", "", None, "not in the graph" if declared is None else "no source"))
                continue
            df = sources[source]
            spark = df.sparkSession
            found = _columns(df, b, profile)
            used = {k for k in b.keys if k}
            for p in declared.properties:
                m = found.find(p)
                rows.append((kind, b.name, source, "property", p, m.column, m.strategy))
                if m.column:
                    used.add(m.column)
                    filled[source, m.column] = None
            for k in b.keys:
                rows.append((kind, b.name, source, "key", k or "", k if k in df.columns else None, "present" if k in df.columns else "minted" if b.name in KEY_BUILDERS else "absent"))
            rows += [(kind, b.name, source, "unused", c, c, "") for c in df.columns if c not in used]
            rows += [(kind, b.name, source, "ambiguous", name, ",".join(cs), "") for name, cs in found.collisions.items()]
    spark = spark or SparkSession.active()
    report = spark.createDataFrame(rows, "kind string, name string, source string, entry string, item string, column string, how string")
    rates = None
    for source in dict.fromkeys(s for s, _ in filled):
        columns = [c for s, c in filled if s == source]
        parts = [F.struct(F.lit(c).alias("column"), F.avg((scrub(quoted(c), placeholders) != "").cast("int")).alias("fill_rate")) for c in columns]
        part = sources[source].agg(F.array(*parts).alias("x")).select(F.lit(source).alias("source"), F.inline("x"))
        rates = part if rates is None else rates.unionByName(part)
    return report.withColumn("fill_rate", F.lit(None).cast("double")) if rates is None else report.join(rates, ["source", "column"], "left")


def standardise(spark: SparkSession, graph: Graph, profile: Profile, source: Callable[[str], DataFrame | None], order=None) -> tuple[dict[str, DataFrame], dict[str, DataFrame], list[tuple[str, str, str, str]]]:
    """Node and edge tables of a profile, and (kind, name, status, reason) of each entry.

    ``source`` gives the table of a name or None. What can't be bound is recorded.
    """
    nodes: dict[str, DataFrame] = {}
    edges: dict[str, DataFrame] = {}
    status = []
    for kind, bindings, declared, bind, out in (("node", profile.nodes, graph.nodes, bind_nodes, nodes), ("edge", profile.edges, graph.edges, bind_edges, edges)):
        for b in bindings.values():
            reason = ""
            tables = [t for t in map(source, b.sources) if t is not None]
            if b.name not in declared:
                reason = "not in the graph"
            elif not tables:
                reason = "no source"
            elif kind == "edge" and b.pair and tuple(b.pair) not in declared[b.name].pairs:
                reason = "label pair not declared"
            elif b.name not in KEY_BUILDERS and any(k is None for k in b.keys) and not (kind == "edge" and all(k or e in KEY_BUILDERS for k, e in zip(b.keys, b.pair or ("", ""), strict=True))):
                reason = "no key"
            else:
                df = bind(graph, b, tables, profile, order)
                if df is None:
                    reason = "key column absent"
                else:
                    out[b.name] = df
            status.append((kind, b.name, "skipped" if reason else "bound", reason))
    return nodes, edges, status


def summary(spark: SparkSession, nodes: dict[str, DataFrame], edges: dict[str, DataFrame], status) -> DataFrame:
    """kind, name, status, n_rows and reason of every entry, counted in one job."""
    counts = _union([df.agg(F.count("*").alias("n_rows")).select(F.lit(k).alias("kind"), F.lit(n).alias("name"), "n_rows") for k, t in (("node", nodes), ("edge", edges)) for n, df in t.items()])
    out = spark.createDataFrame(status, "kind string, name string, status string, reason string")
    return out.withColumn("n_rows", F.lit(0).cast("long")) if counts is None else out.join(counts, ["kind", "name"], "left").na.fill(0, ["n_rows"])


def counted_summary(spark: SparkSession, counts: dict[tuple[str, str], int], status) -> DataFrame:
    """As ``summary``, from counts that a write has gathered."""
    rows = [(kind, name, state, why, counts.get((kind, name), 0)) for kind, name, state, why in status]
    return spark.createDataFrame(rows, "kind string, name string, status string, reason string, n_rows long")
