"""Patterns over graph tables as chains of equi-joins, and the documented queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.functions.text import number
from braidwork.plans.schema import Graph


@dataclass(frozen=True)
class Tables:
    """A graph: its declaration, node tables by label, edge tables by type."""

    graph: Graph
    nodes: dict[str, DataFrame]
    edges: dict[str, DataFrame]

    def node(self, label: str, name: str) -> DataFrame:
        """A label's table with columns name.property; its id is also name.id. Declared
        properties that the table lacks are null."""
        node = self.graph.nodes[label]
        df = self.nodes.get(label)
        if df is None:
            raise KeyError(f"no node table {label}")
        cols = [F.col(f"`{c}`").alias(f"{name}.{c}") for c in df.columns]
        cols += [F.lit(None).cast("string").alias(f"{name}.{c}") for c in node.columns if c not in df.columns]
        return df.select(F.col(f"`{node.key}`").alias(f"{name}.id"), *cols)

    def edge(self, kind: str, name: str, start: str, end: str) -> DataFrame:
        df = self.edges.get(kind)
        if df is None:
            raise KeyError(f"no edge table {kind}")
        rows = df.filter((F.col("startLabel") == start) & (F.col("endLabel") == end))
        props = [c for c in df.columns if c not in ("startId", "endId", "startLabel", "endLabel")]
        cols = [F.col(f"`{c}`").alias(f"{name}.{c}") for c in props]
        cols += [F.lit(None).cast("string").alias(f"{name}.{c}") for c in self.graph.edges[kind].properties if c not in props]
        return rows.select(F.col("startId").alias(f"{name}.start"), F.col("endId").alias(f"{name}.end"), *cols)


def c(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class Hop:
    """A step from a bound name over an edge type to a node. ``back`` walks the edge from
    its end; ``keep_where`` filters edge and node before the join."""

    source: str
    edge: str
    label: str
    name: str
    back: bool = False
    optional: bool = False
    where: Column | None = None
    edge_where: Column | None = None


def _ends(tables: Tables, labels: dict[str, str], hop: Hop) -> tuple[DataFrame, DataFrame, str]:
    """The edge of a hop, with its near end as ``name.from``; the node; the column of the far end."""
    here, there = labels[hop.source], hop.label
    edge = tables.edge(hop.edge, f"{hop.name}.rel", *((there, here) if hop.back else (here, there)))
    node = tables.node(there, hop.name)
    if hop.edge_where is not None:
        edge = edge.filter(hop.edge_where)
    if hop.where is not None:
        node = node.filter(hop.where)
    near, far = (f"{hop.name}.rel.end", f"{hop.name}.rel.start") if hop.back else (f"{hop.name}.rel.start", f"{hop.name}.rel.end")
    return edge.withColumn(f"{hop.name}.from", c(near)), node, far


def _step(tables: Tables, labels: dict[str, str], hop: Hop) -> DataFrame:
    """The edge and node of a hop, keyed by edge end ``name.from``."""
    edge, node, far = _ends(tables, labels, hop)
    return edge.join(node, c(far) == c(f"{hop.name}.id"))


def _path(item: Hop | list[Hop]) -> list[Hop]:
    return item if isinstance(item, list) else [item]


def _optional(item: Hop | list[Hop]) -> bool:
    return isinstance(item, list) or item.optional


def _start(tables: Tables, label: str, name: str, where: Column | None) -> DataFrame:
    out = tables.node(label, name)
    return out if where is None else out.filter(where)


def _take(tables: Tables, out: DataFrame, labels: dict[str, str], item: Hop | list[Hop]) -> DataFrame:
    """The rows with one more hop or optional path. A plain hop to nodes without a condition meets the edge
    and then the node, so the rows are dealt anew once, by the far end, and no node's
    properties are dealt along with an edge."""
    path = _path(item)
    first = path[0]
    if not _optional(item) and first.where is None:
        edge, node, far = _ends(tables, labels, first)
        out = out.join(edge, c(f"{first.source}.id") == c(f"{first.name}.from")).join(node, c(far) == c(f"{first.name}.id"))
        labels[first.name] = first.label
        return out
    part = _step(tables, labels, first)
    labels[first.name] = first.label
    for h in path[1:]:
        part = part.join(_step(tables, labels, h), c(f"{h.source}.id") == c(f"{h.name}.from"))
        labels[h.name] = h.label
    return out.join(part, c(f"{first.source}.id") == c(f"{first.name}.from"), "left" if _optional(item) else "inner")


def match(tables: Tables, label: str, name: str, hops: list[Hop | list[Hop]], where: Column | None = None) -> DataFrame:
    """Rows of a pattern that starts at ``label`` and takes the hops in turn.

    A list of hops is an optional path: it is joined as a whole, so either all of it is
    bound or none. Filters sit below the joins; Spark chooses the join of every hop.
    """
    out, labels = _start(tables, label, name, where), {name: label}
    for item in hops:
        out = _take(tables, out, labels, item)
    return out


def _leading(tables: Tables, labels: dict[str, str], rest: list[Hop | list[Hop]], columns: dict[str, str]) -> list[str] | None:
    """The report's columns before those that ``rest`` binds, if the first rows by them are enough: only
    optional paths are left, their columns come last, and rows equal in the columns before are at the same nodes
    where those paths begin. An optional path drops no row, so no later row can come first."""
    paths = [_path(item) for item in rest]
    later = {h.name for p in paths for h in p}
    own = [src for src in columns.values() if src.partition(".")[0] not in later]
    keys = [{f"{n}.id", f"{n}.{tables.graph.nodes[labels[n]].key}"} for n in {p[0].source for p in paths} - later]
    return own if all(_optional(x) for x in rest) and list(columns.values())[: len(own)] == own and all(k & set(own) for k in keys) else None


def first_rows(tables: Tables, label: str, name: str, hops: list[Hop | list[Hop]], columns: dict[str, str], limit: int, where: Column | None = None) -> DataFrame:
    """``report`` of ``match``. Optional paths at the end start from the first ``limit`` rows alone where
    these give the same report, so a path with many ends isn't multiplied by every row."""
    out, labels = _start(tables, label, name, where), {name: label}
    for k, item in enumerate(hops):
        lead = _leading(tables, labels, hops[k:], columns)
        if lead:
            out = out.orderBy(*[c(x) for x in lead if x in out.columns]).limit(limit)
        out = _take(tables, out, labels, item)
    return report(out, columns, limit)


def report(rows: DataFrame, columns: dict[str, str], limit: int) -> DataFrame:
    """The named columns in the order of their values, which makes the limit repeatable."""
    picked = [(c(src) if src in rows.columns else F.lit(None).cast("string")).alias(out) for out, src in columns.items()]
    return rows.select(*picked).orderBy(*columns).limit(limit)


def _same(*names: str) -> dict[str, str]:
    return {n.rpartition(".")[2]: n for n in names}


def methylation_by_gene(t: Tables, symbol: str, limit: int = 50) -> DataFrame:
    hops = [
        Hop("g", "MAPS_TO_GENE", "CpGSite", "cpg", back=True), Hop("cpg", "MEASURES_CPG", "MethylationObservation", "mo", back=True),
        Hop("mo", "HAS_METHYLATION_OBSERVATION", "Sample", "s", back=True), Hop("mo", "CLASSIFIED_USING", "MethylationStatusRule", "rule", optional=True),
    ]
    return first_rows(t, "Gene", "g", hops, _same("s.sampleId", "g.symbol", "cpg.cpgId", "cpg.sourceCpgId", "cpg.platformCode", "mo.betaValue", "mo.methylationStatus", "rule.methylationStatusRuleId", "mo.sourceDataset", "mo.sourceFile"), limit, c("g.symbol") == symbol)


def evidence_for_rule(t: Tables, observation: str, limit: int = 20) -> DataFrame:
    hops = [
        Hop("mo", "CLASSIFIED_USING", "MethylationStatusRule", "rule"),
        [Hop("rule", "SUPPORTS_ASSOCIATION_WITH", "Evidence", "e", back=True), Hop("e", "PROVIDES_EVIDENCE_FOR", "Publication", "pub", back=True)],
    ]
    return first_rows(t, "MethylationObservation", "mo", hops, _same("mo.methylationObservationId", "mo.betaValue", "mo.methylationStatus", "rule.methylationStatusRuleId", "rule.ruleName", "pub.publicationId", "pub.title", "pub.doi", "pub.pmid"), limit, c("mo.id") == observation)


def variants_within_gene(t: Tables, symbol: str, limit: int = 50) -> DataFrame:
    hops = [
        Hop("g", "IS_WITHIN_GENE", "Variant", "v", back=True), Hop("v", "OBSERVED_VARIANT", "VariantObservation", "vo", back=True),
        Hop("vo", "HAS_VARIANT_OBSERVATION", "Sample", "s", back=True),
    ]
    cols = _same("s.sampleId", "v.variantId", "vo.variantObservationId", "vo.variantCaller", "vo.somaticStatus", "vo.variantAlleleFrequency")
    cols |= {k: f"v.rel.{k}" for k in ("geneRegion", "transcriptId", "annotationSource", "annotationVersion")} | _same("vo.sourceDataset", "vo.sourceFile")
    return first_rows(t, "Gene", "g", hops, cols, limit, c("g.symbol") == symbol)


def paired_samples(t: Tables, kinds=("tumor_normal_match", "barcode_match"), limit: int = 50) -> DataFrame:
    hops = [Hop("a", "PAIRED_WITH", "Sample", "b", edge_where=c("b.rel.pairingType").isin(list(kinds)))]
    return first_rows(t, "Sample", "a", hops, {"sourceSample": "a.sampleId", "pairedSample": "b.sampleId", "sourceClass": "a.sampleClass", "pairedClass": "b.sampleClass", "pairingType": "b.rel.pairingType", "referenceRole": "b.rel.referenceRole"}, limit)


def cell_sets(t: Tables, cell_type: str, limit: int = 50) -> DataFrame:
    hops = [
        Hop("ct", "ANNOTATED_AS_CELL_TYPE", "CellSet", "cs", back=True), Hop("cs", "CONTRIBUTES_TO", "Sample", "s", back=True),
        Hop("cs", "HAS_CELL_STATE", "CellState", "state", optional=True),
    ]
    cols = _same("s.sampleId", "cs.cellSetId", "cs.cellSetType") | {"totalCellSetCount": "cs.cellCount"}
    cols |= {k: f"s.rel.{k}" for k in ("contributedCellCount", "fractionOfSampleCells", "fractionOfCellSet")}
    return first_rows(t, "CellType", "ct", hops, cols | _same("ct.cellTypeName", "state.cellStateName"), limit, F.lower(c("ct.cellTypeName")).contains(cell_type.lower()))


def single_cell_metadata(t: Tables, limit: int = 50) -> DataFrame:
    """The optional dataset is the one that represents the study, with its repository."""
    hops = [
        Hop("st", "HAS_SUBJECT", "Subject", "sub"), Hop("sub", "PROVIDED_SAMPLE", "Sample", "s"),
        Hop("s", "ASSAYED_BY", "Assay", "a", where=F.lower(c("a.isSingleCellAssay").cast("string")) == "true"),
        Hop("a", "USED_LIBRARY", "LibraryPreparation", "lib", optional=True),
        [Hop("st", "REPRESENTS_STUDY", "SingleCellDataset", "scd", back=True), Hop("scd", "HOSTS_DATASET", "Repository", "repo", back=True)],
    ]
    return first_rows(t, "Study", "st", hops, _same("st.studyId", "sub.subjectId", "s.sampleId", "a.assayId", "a.assayType", "lib.libraryStrategy", "lib.libraryChemistry", "lib.libraryPreparationId", "lib.libraryProtocol", "repo.repositoryName", "scd.singleCellDatasetId"), limit)


def drug_agents(t: Tables, subtype: str = "Drug", limit: int = 50) -> DataFrame:
    labels = F.transform(F.split(F.coalesce(c("i._subtypeLabel"), F.lit("")), "[:;,]"), lambda x: F.trim(x))
    hops = [
        Hop("sub", "PROVIDED_SAMPLE", "Sample", "s"), Hop("s", "UNDERWENT_INTERVENTION", "Intervention", "i", where=F.array_contains(labels, subtype)),
        Hop("i", "USES_AGENT", "ChemicalEntity", "agent", optional=True),
    ]
    cols = _same("sub.subjectId", "s.sampleId", "i.interventionId", "i.interventionName", "i.regimenName") | {"agentName": "agent.name"}
    return first_rows(t, "Subject", "sub", hops, cols | {k: f"agent.rel.{k}" for k in ("agentRole", "sequence", "doseValue", "doseUnit", "routeOfAdministration")}, limit)


def protein_evidence(t: Tables, uniprot: str, limit: int = 50) -> DataFrame:
    hops = [Hop("p", "SUPPORTS_ASSOCIATION_WITH", "Evidence", "e", back=True), Hop("e", "PROVIDES_EVIDENCE_FOR", "Publication", "pub", back=True)]
    cols = _same("p.proteinId", "p.proteinName", "e.evidenceId", "e.claimText", "e.evidenceType")
    return first_rows(t, "Protein", "p", hops, cols | {k: f"e.rel.{k}" for k in ("entityRole", "supportDirection")} | _same("pub.publicationId", "pub.title"), limit, c("p.uniprotId") == uniprot)


def protein_perturbations(t: Tables, limit: int = 50) -> DataFrame:
    hops = [Hop("s", "UNDERWENT_PERTURBATION", "Perturbation", "pert"), Hop("pert", "TARGETS", "Protein", "p")]
    cols = _same("s.sampleId", "pert.perturbationId", "pert.perturbationType", "p.proteinId", "p.proteinName")
    return first_rows(t, "Sample", "s", hops, cols | {k: f"p.rel.{k}" for k in ("targetRole", "targetLevel", "effectDirection", "confidenceScore")}, limit)


def perturbation_phenotypes(t: Tables, limit: int = 50) -> DataFrame:
    hops = [Hop("s", "UNDERWENT_PERTURBATION", "Perturbation", "pert"), Hop("pert", "HAS_PHENOTYPE_OBSERVATION", "PhenotypeObservation", "ph", optional=True)]
    cols = _same("s.sampleId", "pert.perturbationId", "pert.perturbationName", "pert.perturbationType")
    cols |= {k: f"ph.{k}" for k in ("phenotypeObservationId", "phenotypeName", "phenotypeType", "category", "status", "value", "unit", "observationDay")}
    return first_rows(t, "Sample", "s", hops, cols | {"daysToEvent": "ph.rel.daysToEvent"} | _same("ph.sourceDataset", "ph.sourceFile"), limit)


def diagnosis_detail(t: Tables, limit: int = 50) -> DataFrame:
    hops = [
        Hop("sub", "HAS_DIAGNOSIS", "Diagnosis", "d"), Hop("d", "OF_CONDITION", "Condition", "c"),
        Hop("d", "HAS_PATHOLOGY", "PathologyDetail", "path", optional=True), Hop("d", "HAS_PHENOTYPE_OBSERVATION", "PhenotypeObservation", "ph", optional=True),
    ]
    cols = _same("sub.subjectId", "d.diagnosisId") | {"diagnosisConditionId": "d.conditionId"} | _same("d.conditionSubtype", "d.pathologicStage", "d.conditionGrade", "c.conditionId", "c.conditionName", "c.conditionType", "c.mondoId", "c.externalOntologyIds", "c.sourceVocabulary")
    cols |= {k: f"c.rel.{k}" for k in ("mappingMethod", "ontologyMappingStatus", "confidenceScore")}
    cols |= _same("path.pathologyDetailId", "path.morphologyDescription", "ph.phenotypeObservationId", "ph.phenotypeName", "ph.status", "ph.value")
    return first_rows(t, "Subject", "sub", hops, cols | {"daysToEvent": "ph.rel.daysToEvent"}, limit)


def survival_records(t: Tables, limit: int = 50) -> DataFrame:
    hops = [Hop("sub", "HAS_SURVIVAL_RECORD", "Survival", "v")]
    return first_rows(t, "Subject", "sub", hops, _same("sub.subjectId", *(f"v.{k}" for k in ("survivalId", "survivalType", "timeOrigin", "timeToEventDays", "eventType", "eventOccurred", "lastFollowUpDays", "censoringReason"))), limit)


def classify_methylation(obs: DataFrame, rule_id: str, low: float, high: float, value: str = "betaValue", key: str = "methylationObservationId", status: str = "methylationStatus") -> tuple[DataFrame, DataFrame]:
    """Observations with a status by a rule's thresholds, and their edges to the rule."""
    beta = number(F.col(value))
    name = F.when(beta <= low, "hypomethylated").when(beta >= high, "hypermethylated").when(beta.isNotNull(), "intermediate").otherwise("")
    rows = obs.withColumn(status, name)
    edges = rows.filter(F.col(status) != "").select(F.col(key).alias("startId"), F.lit(rule_id).alias("endId"), F.lit("MethylationObservation").alias("startLabel"), F.lit("MethylationStatusRule").alias("endLabel"))
    return rows, edges


def rule_intervals(rules: DataFrame, rule_key: str = "methylationStatusRuleId", platform: str = "platformCode") -> DataFrame:
    """The disjoint ranges of values in which each rule gives each status: (rule, platform,
    status, low, low_open, high, high_open); null ends are open on that side.

    At or below hypoThreshold is hypomethylated, else at or above hyperThreshold
    hypermethylated, else between the intermediate bounds, where given, intermediate. A
    status whose thresholds a rule lacks has no range; blank or odd numbers are lacking.
    """
    r = rules.select(F.col(rule_key).alias("rule"), F.col(platform).alias("platform"), *[number(F.col(c)).alias(n) for n, c in (("h", "hypoThreshold"), ("t", "hyperThreshold"), ("a", "intermediateLowerBound"), ("b", "intermediateUpperBound"))])
    span = lambda status, low, low_open, high, high_open, there: F.when(there, F.struct(
        F.lit(status).alias("status"), low.cast("double").alias("low"), low_open.alias("low_open"), high.cast("double").alias("high"), high_open.alias("high_open")))
    none, yes, no, h, t, a, b = F.lit(None), F.lit(True), F.lit(False), *[F.col(c) for c in "htab"]
    below, above = a.isNull() | (a <= h), b.isNull() | (b >= t)  # whether a threshold is the nearer bound
    low = F.when(h.isNull() | ~below, a).otherwise(h)
    high = F.when(t.isNull() | ~above, b).otherwise(t)
    spans = F.array(
        span("hypomethylated", none, no, h, no, h.isNotNull()),
        span("hypermethylated", F.greatest(h, t), F.coalesce(h >= t, no), none, no, t.isNotNull()),
        span("intermediate", low, h.isNotNull() & below, high, t.isNotNull() & above, low.isNotNull() & high.isNotNull()),
    )
    return r.select("rule", "platform", F.explode(F.array_compact(spans)).alias("s")).select("rule", "platform", "s.*").filter("low is null or high is null or low < high or (low = high and not low_open and not high_open)")


def classify_by_rules(obs: DataFrame, rules: DataFrame, value: str = "betaValue", key: str = "methylationObservationId", platform: str = "platformCode", status: str = "methylationStatus", cells: int = 64) -> tuple[DataFrame, DataFrame]:
    """Observations with the status that the first rule of their platform (by id) gives them,
    and an edge with its status to every rule that gives one.

    Values from 0 to 1 fall in ``cells`` equal cells, those outside in the first or last; a rule's
    range is listed under the cells it meets, and observations meet it by platform and
    cell, so only rules that can apply are compared. Without a fitting rule the status is
    blank. Null platforms meet no rule.
    """
    cell = lambda x: F.least(F.greatest(F.floor(x * cells), F.lit(0)), F.lit(cells - 1)).cast("int")
    spans = rule_intervals(rules, platform=platform)
    end = lambda c, other: F.when(F.col(c).isNull(), F.lit(other)).otherwise(cell(F.col(c)))
    under = F.sequence(end("low", 0), end("high", cells - 1))
    listed = spans.withColumn("_cell", F.explode(under))
    beta = number(F.col(value))
    mine = obs.select(F.col(key).alias("startId"), F.col(platform).alias("platform"), beta.alias("_value"), cell(beta).alias("_cell")).filter("_value is not null and not isnan(_value)")
    v = F.col("_value")
    inside = (F.col("low").isNull() | (v > F.col("low")) | (~F.col("low_open") & (v == F.col("low")))) & (F.col("high").isNull() | (v < F.col("high")) | (~F.col("high_open") & (v == F.col("high"))))
    edges = mine.join(listed, ["platform", "_cell"]).filter(inside).select(
        "startId", F.col("rule").alias("endId"), F.lit("MethylationObservation").alias("startLabel"), F.lit("MethylationStatusRule").alias("endLabel"), "status"
    )
    first = edges.groupBy("startId").agg(F.min_by("status", "endId").alias("_status"))
    out = obs.drop(status).join(first, obs[key] == first["startId"], "left").withColumn(status, F.coalesce("_status", F.lit(""))).drop("startId", "_status")
    return out, edges
