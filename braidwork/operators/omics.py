"""Per-sample measurement files and patient survival to long observation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidwork.functions.text import blank, fallback_id, is_zero, number, platform_code, ratio_text, strip_version
from braidwork.operators.flatten import first_aliquot_id
from braidwork.sources.readers import file_id

# Column contracts, in order.
EXPRESSION = "expression_observation_id sample_id gene_id expression_value expression_unit assay_id source_dataset source_file pipeline_version".split()
METHYLATION = (
    "methylation_observation_id sample_id cpg_id source_cpg_id platform_code beta_value num_cpg_sites modification_type methylation_status "
    "chromosome start_position gene_symbol assay_id source_dataset source_file pipeline_version"
).split()
VARIATION = (
    "variant_observation_id sample_id variant_id gene_id chromosome position_start position_end reference_allele alternate_allele variant_class "
    "impact variant_allele_frequency tumor_read_count tumor_variant_count normal_read_count normal_variant_count filter_status somatic_status "
    "assay_id source_dataset source_file pipeline_version"
).split()
PLATFORMS = {"Illumina Human Methylation 450": "450k", "Illumina Methylation Epic": "epic"}
ENDPOINTS = {"OS": "OS", "DSS": "DSS", "DFS": "DFI", "PFS": "PFI"}
DAYS_PER_MONTH = 30.4368


def pipeline_version() -> Column:
    return blank(F.col("analysis.workflow_type"))


def file_provenance(files: DataFrame, third: Column | None = None) -> DataFrame:
    """One row a file: sample, assay, platform code and pipeline version."""
    third = F.col("analysis.workflow_type") if third is None else third
    return files.select(
        "file_id",
        blank(F.col("file_name")).alias("source_file"),
        first_aliquot_id().alias("sample_id"),
        fallback_id([F.col("platform"), F.col("experimental_strategy"), third]).alias("assay_id"),
        platform_code(F.col("platform"), PLATFORMS).alias("platform_code"),
        pipeline_version().alias("pipeline_version"),
    )


def _joined(rows: DataFrame, provenance: DataFrame, dataset: str) -> DataFrame:
    """Rows with what is known of their file. Spark broadcasts the file table while it is
    small and shuffles both beyond that."""
    return rows.withColumn("file_id", file_id(F.col("file_path"))).join(provenance, "file_id").withColumn("source_dataset", F.lit(dataset))


def expression_observations(counts: DataFrame, provenance: DataFrame, dataset: str = "") -> DataFrame:
    rows = counts.filter((F.col("gene_id") != "") & ~is_zero(F.col("tpm_unstranded")))
    gene = strip_version(F.col("gene_id"))
    return (
        _joined(rows, provenance, dataset)
        .withColumn("gene_id", gene)
        .withColumn("expression_observation_id", F.concat_ws(":", "sample_id", "gene_id"))
        .withColumn("expression_value", F.col("tpm_unstranded"))
        .withColumn("expression_unit", F.lit("TPM"))
        .select(*EXPRESSION)
    )


def methylation_observations(betas: DataFrame, provenance: DataFrame, dataset: str = "") -> DataFrame:
    dot = lambda c: F.when(F.col(c) == ".", F.lit("")).otherwise(F.col(c))
    cols = {
        "cpg_id": F.concat_ws(":", "platform_code", "probe"), "source_cpg_id": F.col("probe"), "num_cpg_sites": F.lit("1"),
        "modification_type": F.lit("5mC"), "methylation_status": F.lit(""), "chromosome": dot("chromosome"),
        "start_position": dot("start"), "gene_symbol": dot("gene_symbol"),
    }
    out = _joined(betas.filter("probe <> ''"), provenance, dataset).withColumns(cols)
    return out.withColumn("methylation_observation_id", F.concat_ws(":", "sample_id", "cpg_id")).select(*METHYLATION)


def with_fallback(rows: DataFrame, key: str, table: DataFrame, table_key: str, value: str, out: str) -> DataFrame:
    """``out`` is the table's value of the key, or the key itself where it has none."""
    named = table.select(F.col(table_key).alias("_k"), F.col(value).alias("_v"))
    return rows.join(named, F.col(key) == F.col("_k"), "left").withColumn(out, F.coalesce("_v", key)).drop("_k", "_v")


def variation_observations(calls: DataFrame, provenance: DataFrame, barcodes: DataFrame | None = None, keep: DataFrame | None = None, dataset: str = "") -> DataFrame:
    """``barcodes``: barcode to uuid; ``keep``: barcodes to keep, all if None."""
    rows = calls.filter("barcode <> ''")
    if keep is not None:
        rows = rows.join(keep.select(F.col("barcode")), "barcode", "left_semi")
    rows = with_fallback(rows, "barcode", barcodes, "barcode", "uuid", "_sample") if barcodes is not None else rows.withColumn("_sample", F.col("barcode"))
    whole = (F.col("_sample") != "") & (F.col("chromosome") != "") & (F.col("start") != "") & (F.col("ref") != "") & (F.col("alt") != "")
    cols = {
        "sample_id": F.col("_sample"), "variant_id": F.concat_ws(":", "chromosome", "start", "ref", "alt"), "gene_id": strip_version(F.col("gene")),
        "position_start": F.col("start"), "position_end": F.col("end"), "reference_allele": F.col("ref"), "alternate_allele": F.col("alt"),
        "variant_allele_frequency": ratio_text(F.col("t_alt"), F.col("t_depth")), "tumor_read_count": F.col("t_depth"),
        "tumor_variant_count": F.col("t_alt"), "normal_read_count": F.col("n_depth"), "normal_variant_count": F.col("n_alt"),
        "filter_status": F.col("filter"), "somatic_status": F.lit("Somatic"),
    }
    out = _joined(rows.filter(whole), provenance.drop("sample_id"), dataset).withColumns(cols)
    return out.withColumn("variant_observation_id", F.concat_ws(":", "sample_id", "variant_id")).select(*VARIATION)


def survival_endpoints(patients: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """One row for each case and endpoint whose event and time are both known."""
    found = patients.join(crosswalk.withColumnRenamed("case_submitter_id", "PATIENT_ID"), "PATIENT_ID")
    parts = []
    for raw, kind in ENDPOINTS.items():
        status, months = f"{raw}_STATUS", f"{raw}_MONTHS"
        if status not in patients.columns or months not in patients.columns:
            continue
        event = F.when(F.startswith(F.col(status), F.lit("1:")), F.lit("1")).when(F.startswith(F.col(status), F.lit("0:")), F.lit("0"))
        days = F.bround(number(F.col(months)) * DAYS_PER_MONTH).cast("long").cast("string")
        parts.append(F.struct(F.lit(kind).alias("survival_type"), event.alias("event"), days.alias("time_days")))
    rows = found.select("case_id", F.col("PATIENT_ID").alias("case_submitter_id"), F.inline(F.array(*parts))).filter("event is not null and time_days is not null")
    return rows.select("case_id", "case_submitter_id", F.concat_ws(":", "case_id", "survival_type").alias("survival_id"), "survival_type", "event", "time_days")


def unmatched_patients(patients: DataFrame, crosswalk: DataFrame) -> DataFrame:
    return patients.join(crosswalk, patients["PATIENT_ID"] == crosswalk["case_submitter_id"], "left_anti")
