"""Wide matrices and genotype files to long observation tables.

A matrix is read as text lines and exploded by position, never as a wide DataFrame, so
its width is data and not schema. Headers are tables of each file's own positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidwork.functions.text import strip_version
from braidwork.operators.omics import EXPRESSION, METHYLATION, VARIATION
from braidwork.sources.readers import path_exists, text_lines

_SHAPES = {
    "expression": (EXPRESSION, "expression_observation_id", "gene_id", "expression_value", "expression_unit"),
    "methylation": (METHYLATION, "methylation_observation_id", "cpg_id", "beta_value", None),
}


def _bare(c: Column) -> Column:
    """Text without one pair of quotes around it."""
    return F.regexp_replace(c, '^"(.*)"$', "$1")


def feature_id(c: Column, kind: str) -> Column:
    return strip_version(F.trim(c)) if kind == "ensembl" else F.trim(c)


def odd_features(features: DataFrame, column: str) -> DataFrame:
    """Distinct ids that don't look like Ensembl ids, to be reported."""
    return features.select(F.trim(column).alias("feature")).filter("feature <> '' and not startswith(feature, 'ENS')").distinct()


def _named_cells(cells: DataFrame, heads: DataFrame, on: list[str], rows_are: str, kind: str) -> DataFrame:
    """(sample_id, feature_id, value) of the non-blank cells of rows (row, cells, *on) whose
    columns are named by (*on, pos, head)."""
    long = cells.select(*on, "row", F.posexplode("cells").alias("pos", "cell"))
    long = long.join(heads, [*on, "pos"]).select("row", F.trim("head").alias("head"), _bare(F.col("cell")).alias("value")).filter(F.trim("value") != "")
    sample, feature = ("head", "row") if rows_are == "features" else ("row", "head")
    return long.select(F.col(sample).alias("sample_id"), feature_id(F.col(feature), kind).alias("feature_id"), "value").filter("feature_id <> ''")


def melt_lines(lines: DataFrame, header: list[str], label: str, kind: str = "other", rows_are: str = "features", ignore=(), deal: int = 0) -> DataFrame:
    """(sample_id, feature_id, value) of the non-blank cells of a matrix.

    ``lines`` has the data lines as ``value``; short lines are read as far as they go.
    ``deal`` spreads the lines evenly over that many tasks first; 0 leaves them where they
    are read.
    """
    at = header.index(label)
    heads = lines.sparkSession.createDataFrame([(k, h) for k, h in enumerate(header) if k != at and h not in ignore], "pos int, head string")
    cells = lines.select(F.split("value", "\t").alias("cells")).filter(F.size("cells") > at)
    named = cells.select(F.trim(_bare(F.get("cells", F.lit(at)))).alias("row"), "cells").filter("row <> ''")
    # A wide matrix of few lines has few splits: its lines are dealt out before the explode.
    return _named_cells(named.repartition(deal) if deal else named, heads, [], rows_are, kind)


def matrix_headers(lines: DataFrame, label: str) -> DataFrame:
    """One row a file of (value, file_path, at) lines: file_path, head_at, the position of the
    label column from 0 (null where it has none), the header's cells and a number that files
    with one header share."""
    first = lines.filter((F.col("at.block") == 0) & (F.col("value") != ""))
    least = first.groupBy("file_path").agg(F.min("at.line").alias("line"))
    heads = first.select("file_path", F.col("at.line").alias("line"), "value", F.col("at").alias("head_at")).join(least, ["file_path", "line"])
    cells = F.transform(F.split("value", "\t"), _bare)
    label_at = F.nullif(F.array_position(cells, F.lit(label)).cast("int") - 1, F.lit(-1))
    return heads.select("file_path", "head_at", label_at.alias("label_at"), cells.alias("header"), F.xxhash64("value").alias("header_id"))


def melt_files(lines: DataFrame, heads: DataFrame, kind: str = "other", rows_are: str = "features", ignore=(), deal: int = 0) -> DataFrame:
    """As melt_lines, for files of which each has its own header (``matrix_headers``).

    A line learns its file's label position and header number; the headers themselves, each
    once however many files share it, meet the cells by number and position.
    """
    with_label = heads.filter("label_at is not null")
    names = with_label.select("header_id", "label_at", "header").dropDuplicates(["header_id"]).select("header_id", "label_at", F.posexplode("header").alias("pos", "head"))
    names = names.filter((F.col("pos") != F.col("label_at")) & ~F.col("head").isin(list(ignore))).select("header_id", "pos", "head")
    data = lines.join(with_label.select("file_path", "head_at", "label_at", "header_id"), "file_path").filter(F.col("at") != F.col("head_at"))
    cells = data.select("header_id", "label_at", F.split("value", "\t").alias("cells")).filter(F.size("cells") > F.col("label_at"))
    named = cells.select("header_id", F.trim(_bare(F.get("cells", F.col("label_at")))).alias("row"), "cells").filter("row <> ''")
    return _named_cells(named.repartition(deal) if deal else named, names, ["header_id"], rows_are, kind)


def reconcile_samples(rows: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose sample is known, and the distinct samples that are not."""
    if known is None:
        return rows, None
    ids = known.select("sample_id").distinct()
    return rows.join(ids, "sample_id", "left_semi"), rows.select("sample_id").distinct().join(ids, "sample_id", "left_anti")


def stamp(rows: DataFrame, contract: list[str], assay: dict[str, str], dataset: str, source_file: str) -> DataFrame:
    """The contract's columns in order, then assay columns that it lacks."""
    fixed = {k: F.lit(v) for k, v in assay.items()} | {"source_dataset": F.lit(dataset), "source_file": F.lit(source_file)}
    rows = rows.withColumns(fixed)
    extra = [k for k in assay if k not in contract]
    return rows.select(*[F.col(c) if c in rows.columns else F.lit("").alias(c) for c in contract], *extra)


def observations(long: DataFrame, observation: str, unit: str = "", assay: dict[str, str] | None = None, dataset: str = "", source_file: str = "") -> DataFrame:
    contract, ident, feature, value, unit_column = _SHAPES[observation]
    assay = assay or {}
    name = F.col("feature_id")
    cols = {value: F.col("value")}
    if observation == "methylation":
        cols["source_cpg_id"] = name
        name = F.concat_ws(":", F.lit(assay.get("platform_code", "unknown")), name)
    cols |= {feature: name, ident: F.concat_ws(":", F.col("sample_id"), name)}
    if unit_column:
        cols[unit_column] = F.lit(unit)
    return stamp(long.withColumns(cols), contract, assay, dataset, source_file)


def melt_matrix(spark: SparkSession, path: str, spec: dict, known: DataFrame | None = None, dataset: str = "") -> tuple[DataFrame | None, DataFrame | None, str]:
    """Observations of a declared matrix or a folder of them, each with its own header; its
    unknown samples; and which files were skipped and why. The rows are None if all were."""
    if not path_exists(spark, path):
        return None, None, "source not found"
    lines = text_lines(spark, path)
    label = spec["feature_id_column"]
    heads = matrix_headers(lines, label)
    seen = heads.agg(F.count_if(F.col("label_at").isNotNull()).alias("n"), F.min(F.when(F.col("label_at").isNull(), F.element_at(F.split("file_path", "/"), -1))).alias("odd"), F.count_if(F.col("label_at").isNull()).alias("n_odd")).first()
    if not seen["n"]:
        return None, None, f"label column {label} not in header"
    why = f"label column {label} not in header of {seen['n_odd']} file(s), {seen['odd']} first" if seen["n_odd"] else ""
    tasks = spark.sparkContext.defaultParallelism
    deal = tasks if lines.rdd.getNumPartitions() < tasks else 0
    by_sample = spec.get("orientation") == "samples_x_genes"
    long = melt_files(lines, heads, spec.get("feature_id_type", "other"), "samples" if by_sample else "features", tuple(spec.get("ignore_columns") or ()), deal)
    kept, dropped = reconcile_samples(long, known)
    return observations(kept, spec["observation"], spec.get("unit", ""), spec.get("assay"), dataset, spec["input"]), dropped, why


def vcf_headers(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(file_path, pos, sample_id) of the sample columns of each file, and (file_path,
    gene_at) of the files whose annotation format names a Gene."""
    chrom = lines.filter(F.startswith("value", F.lit("#CHROM"))).select("file_path", F.split("value", "\t").alias("c"))
    samples = chrom.select("file_path", F.posexplode(F.slice("c", 10, F.greatest(F.size("c") - 9, F.lit(0)))).alias("pos", "sample_id"))
    parts = F.transform(F.split(F.regexp_extract("value", 'Format:\\s*([^">]+)', 1), "\\|"), lambda x: F.trim(x))
    csq = lines.filter(F.startswith("value", F.lit("##INFO=<ID=CSQ"))).select("file_path", (F.array_position(parts, "Gene").cast("int") - 1).alias("gene_at"))
    return samples, csq.filter("gene_at >= 0").groupBy("file_path").agg(F.max("gene_at").alias("gene_at"))


def split_multiallelic(lines: DataFrame) -> DataFrame:
    """One row for each ALT of a record with its 1-based index; short records go."""
    file = ["file_path"] if "file_path" in lines.columns else []
    cells = lines.filter("value <> '' and not startswith(value, '#')").select(*file, F.split("value", "\t").alias("c")).filter(F.size("c") >= 8)
    at = lambda k: F.get("c", F.lit(k))
    return cells.select(
        *file, at(0).alias("chromosome"), at(1).alias("position_start"), at(3).alias("ref"), at(6).alias("filter_status"), at(7).alias("info"),
        F.coalesce(at(8), F.lit("")).alias("format"), F.slice("c", 10, F.greatest(F.size("c") - 9, F.lit(0))).alias("calls"),
        F.posexplode(F.split(at(4), ",")).alias("allele", "alt"),
    ).withColumn("allele", F.col("allele") + 1)


def genotype_carriers(alleles: DataFrame, samples: list[str] | DataFrame) -> DataFrame:
    """One row for each sample whose genotype names the allele. ``samples``: the names of the
    sample columns, or (file_path, pos, sample_id) where each file has its own. Genotypes are
    judged first, so only carriers are named."""
    place = F.array_position(F.split("format", ":"), F.lit("GT")).cast("int")
    by_file = isinstance(samples, DataFrame)
    heads = samples if by_file else alleles.sparkSession.createDataFrame(list(enumerate(samples)), "pos int, sample_id string")
    calls = alleles.withColumn("gt_at", place).filter("gt_at > 0").select("*", F.posexplode("calls").alias("pos", "call"))
    genotype = F.coalesce(F.get(F.split("call", ":"), F.col("gt_at") - 1), F.lit(""))
    carried = F.array_contains(F.split(genotype, "[/|]"), F.col("allele").cast("string"))
    return calls.filter(carried).join(heads, ["file_path", "pos"] if by_file else ["pos"]).drop("pos", "call", "gt_at", "calls")


def _dash_id() -> Column:
    return F.concat_ws("-", "chromosome", "position_start", "ref", "alt")


def vcf_observations(carriers: DataFrame, assay: dict[str, str] | None = None, dataset: str = "", source_file: str = "") -> DataFrame:
    start = F.col("position_start")
    end = F.when(start.rlike("^[0-9]+$"), (start.try_cast("long") + F.length("ref") - 1).cast("string")).otherwise(start)
    rows = carriers.withColumns({"variant_id": _dash_id(), "position_end": end, "reference_allele": F.col("ref"), "alternate_allele": F.col("alt")})
    return stamp(rows.withColumn("variant_observation_id", F.concat_ws(":", "sample_id", "variant_id")), VARIATION, assay or {}, dataset, source_file)


def vcf_gene_edges(carriers: DataFrame, gene_at: int | None | DataFrame) -> DataFrame:
    """Distinct (variant_id, gene_id) of carried alleles, from the annotations whose allele
    is the ALT text. ``gene_at``: place of Gene in the annotation format, or (file_path,
    gene_at) where each file has its own."""
    if gene_at is None:
        return carriers.sparkSession.createDataFrame([], "variant_id string, gene_id string")
    by_file = isinstance(gene_at, DataFrame)
    csq = F.regexp_extract("info", "(?:^|;)CSQ=([^;]*)", 1)
    alleles = carriers.select(*(["file_path"] if by_file else []), _dash_id().alias("variant_id"), "alt", csq.alias("csq")).distinct()
    alleles = alleles.join(gene_at, "file_path") if by_file else alleles.withColumn("gene_at", F.lit(gene_at))
    parts = alleles.select("variant_id", "alt", "gene_at", F.explode(F.split("csq", ",")).alias("entry")).withColumn("parts", F.split("entry", "\\|"))
    genes = parts.filter(F.get("parts", F.lit(0)) == F.col("alt")).select("variant_id", strip_version(F.trim(F.get("parts", F.col("gene_at")))).alias("gene_id"))
    return genes.filter("gene_id <> ''").distinct()


def reshape_vcf(spark: SparkSession, path: str, spec: dict, dataset: str = "") -> tuple[DataFrame | None, DataFrame | None, str]:
    """Observations and gene edges of a genotype file or a folder of them; each file is read
    by its own header."""
    if not path_exists(spark, path):
        return None, None, "source not found"
    lines = text_lines(spark, path)
    samples, gene_at = vcf_headers(lines)
    carriers = genotype_carriers(split_multiallelic(lines), samples)
    return vcf_observations(carriers, spec.get("assay"), dataset, spec["input"]), vcf_gene_edges(carriers, gene_at), ""


def reshape(spark: SparkSession, spec: dict, raw: str, known: DataFrame | None = None, dataset: str = ""):
    """Runs one reshape step of a profile by its type."""
    path = f"{raw}/{spec['input']}"
    if spec["type"] == "matrix":
        return melt_matrix(spark, path, spec, known, dataset)
    if spec["type"] == "vcf":
        return reshape_vcf(spark, path, spec, dataset)
    raise ValueError(f"unknown reshape type {spec['type']}")
