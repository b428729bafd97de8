"""Readers of landed files. Every raw column is text; null and "" mean the same."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Which file hits belong to each measurement layer.
FILE_LAYERS = {
    "expression": {
        "experimental_strategy": "RNA-Seq", "data_type": "Gene Expression Quantification",
        "data_category": "Transcriptome Profiling", "analysis.workflow_type": "STAR - Counts", "access": "open",
    },
    "methylation": {
        "experimental_strategy": "Methylation Array", "data_type": "Methylation Beta Value", "data_category": "DNA Methylation", "access": "open",
    },
    "variation": {"data_type": "Masked Somatic Mutation", "data_category": "Simple Nucleotide Variation", "access": "open"},
}


#: The column that holds a row's place in its files, in tables read with ``ordered``.
ORDER_AT = "_order_at"


def _placed(df: DataFrame, text: bool) -> DataFrame:
    """Adds the place of each row: file, start of the file's part, row within it. Where a
    file is cut, and which task reads a part, doesn't change the order."""
    row = F.monotonically_increasing_id() if text else F.col("_metadata.row_index")
    block = F.col("_metadata.file_block_start") if text else F.lit(0).cast("long")
    return df.withColumn(ORDER_AT, F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block"), row.alias("row")))


def _hits(df: DataFrame) -> DataFrame:
    """Rows of response pages, or of lines that already hold one record each."""
    if "data" in df.columns and isinstance(df.schema["data"].dataType, T.StructType) and "hits" in df.schema["data"].dataType.names:
        return df.select(F.inline("data.hits"))
    return df


# The nested parts of a case record; [] marks lists.
CASE_PARTS = (
    "project", "project.program", "demographic", "diagnoses[]", "diagnoses[].pathology_details[]", "diagnoses[].treatments[]", "follow_ups[]", "exposures[]",
    "other_clinical_attributes[]", "samples[]", "samples[].portions[]", "samples[].portions[].analytes[]", "samples[].portions[].analytes[].aliquots[]",
)

#: Declared fields of each part ("" is the case itself), all text unless a type is given.
CASE_FIELDS: dict[str, list[str]] = {
    "": ["case_id", "submitter_id", "primary_site", "disease_type"],
    "project": ["project_id", "name", "state"],
    "project.program": ["program_id", "name"],
    "demographic": ["demographic_id", "gender", "race", "ethnicity", "vital_status", "days_to_birth long", "days_to_death long"],
    "diagnoses[]": ["diagnosis_id", "primary_diagnosis", "icd_10_code", "morphology", "tissue_or_organ_of_origin", "ajcc_pathologic_stage", "age_at_diagnosis long"],
    "diagnoses[].pathology_details[]": ["pathology_detail_id"],
    "diagnoses[].treatments[]": ["treatment_id", "treatment_type", "therapeutic_agents"],
    "follow_ups[]": ["follow_up_id", "days_to_follow_up long"],
    "exposures[]": ["exposure_id"],
    "other_clinical_attributes[]": ["other_clinical_attribute_id"],
    "samples[]": ["sample_id", "submitter_id", "sample_type"],
    "samples[].portions[]": ["portion_id"],
    "samples[].portions[].analytes[]": ["analyte_id"],
    "samples[].portions[].analytes[].aliquots[]": ["aliquot_id", "submitter_id"],
}


def nested_schema(fields: dict[str, list[str]]) -> T.StructType:
    """A record's schema from the fields of its parts, named by path as in CASE_FIELDS."""

    def struct(path: str) -> T.StructType:
        own = []
        for f in fields.get(path, ()):
            name, _, kind = f.partition(" ")
            own.append(T.StructField(name, T._parse_datatype_string(kind) if kind else T.StringType()))
        for part in fields:
            name = part.removeprefix(f"{path}." if path else "")
            if part and part != path and part.startswith(f"{path}." if path else "") and "." not in name:
                inner = struct(part)
                own.append(T.StructField(name.removesuffix("[]"), T.ArrayType(inner) if name.endswith("[]") else inner))
        return T.StructType(own)

    return struct("")


def case_schema(more: dict[str, list[str]] | None = None) -> T.StructType:
    """The declared schema of a case, with more fields of its parts if given."""
    more = more or {}
    return nested_schema({p: list(dict.fromkeys([*CASE_FIELDS.get(p, []), *more.get(p, [])])) for p in dict.fromkeys(["", *CASE_PARTS, *more])})


BAD = "_bad_record"


def read_pages(spark: SparkSession, path, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Records of response pages, or of lines that hold one record each, by a declared
    schema: no pass to infer one. Also (file, record) of the lines that are no JSON or
    don't fit the schema."""
    page = T.StructField("data", T.StructType([T.StructField("hits", T.ArrayType(schema))]))
    whole = T.StructType([page, *schema.fields, T.StructField(BAD, T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), "value")
    # A line is parsed once: what reads the generated column isn't pushed below it.
    read = lines.select("file", "value", F.explode(F.array(F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}))).alias("r"))
    bad = read.filter(F.col(f"r.{BAD}").isNotNull()).select("file", F.col("value").alias("record"))
    one = F.array(F.struct(*[F.col(f"r.`{n}`").alias(n) for n in schema.names]))
    hits = F.when(F.col("r.data").isNull(), one).otherwise(F.coalesce("r.data.hits", F.array().cast(T.ArrayType(schema))))
    return read.filter(F.col(f"r.{BAD}").isNull()).select(F.explode(hits).alias("hit")).select("hit.*"), bad


def bad_report(bad: DataFrame) -> DataFrame:
    """Bad records of each file."""
    return bad.groupBy("file").agg(F.count("*").alias("n_bad"), F.min("record").alias("first"))


def of_project(cases: DataFrame, project: str | None = None, program: str | None = None) -> DataFrame:
    if project:
        cases = cases.filter(F.col("project.project_id") == project)
    if program:
        cases = cases.filter(F.col("project.program.name") == program)
    return cases


def read_cases(spark: SparkSession, path, schema=None, project: str | None = None, program: str | None = None) -> DataFrame:
    """Cases of one project or program. Without a schema it is inferred; read_pages reads by
    ``case_schema()`` and reports bad records."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return of_project(_hits(reader.json(path)), project, program)


def read_file_metadata(spark: SparkSession, path, schema=None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return _hits(reader.json(path))


def file_selection(files: DataFrame, layer: str | dict[str, str], project=None, program=None, case_id=None) -> DataFrame:
    """File hits that equal every predicate of a layer, of one project, program or case."""
    where = FILE_LAYERS[layer] if isinstance(layer, str) else layer
    for name, value in where.items():
        files = files.filter(F.col(name) == value)
    any_case = lambda f: F.exists("cases", f)
    if project:
        files = files.filter(any_case(lambda c: c["project"]["project_id"] == project))
    if program:
        files = files.filter(any_case(lambda c: c["project"]["program"]["name"] == program))
    if case_id:
        files = files.filter(any_case(lambda c: c["case_id"] == case_id))
    return files


def text_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines as (value, file_path, at); ``at`` is the start of the file's part and the place
    within it."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("at"),
    )


def file_id(path: Column) -> Column:
    """Name of the folder a file lies in."""
    return F.element_at(F.split(path, "/"), -2)


def file_headers(lines: DataFrame, fields: dict[str, str], is_header: Column | None = None) -> DataFrame:
    """One row a file: file_path, place and length of its header line, and the positions of
    the named fields in it, from 0 (null where it lacks one).

    The header is the first line of the file, or the first that ``is_header`` marks. It
    stands in the first part of its file, so lines of later parts aren't grouped.
    """
    could = lines.filter(F.col("at.block") == 0 if is_header is None else (F.col("at.block") == 0) & is_header)
    could = could.select("file_path", F.col("at.line").alias("line"), "value", F.col("at").alias("head_at"))
    # Two steps: a number can be aggregated by hashing, a line of text would be sorted.
    first = could.groupBy("file_path").agg(F.min("line").alias("line"))
    heads = could.join(first, ["file_path", "line"])
    cells = F.split("value", "\t")
    places = F.transform(F.array(*[F.lit(h) for h in fields.values()]), lambda h: F.nullif(F.array_position(cells, h).cast("int") - 1, F.lit(-1)))
    return heads.select("file_path", "head_at", F.size(cells).alias("head_size"), places.alias("places"))


def _with_header(lines: DataFrame, fields: dict[str, str], is_header: Column | None, least: int | None, default: list[str] | None = None) -> DataFrame:
    """Named fields of tab lines; ``fields`` maps an output name to a header name.

    Each file's header is looked up once; a line takes its cells by position.
    """
    heads = file_headers(lines, fields, is_header)
    both = lines.join(heads, "file_path", "left").filter(F.col("head_at").isNull() | (F.col("at") != F.col("head_at")))
    if default is not None:
        plain = F.array(*[F.lit(default.index(h) if h in default else None).cast("int") for h in fields.values()])
        both = both.withColumns({"places": F.coalesce("places", plain), "head_size": F.coalesce("head_size", F.lit(len(default)))})
    # The cells come out of a generator: filters above it then read them, where otherwise
    # each would be pushed below and split the line again.
    cells = both.select("file_path", "at", "head_size", "places", F.explode(F.array(F.split("value", "\t"))).alias("cells"))
    cells = cells.filter(F.size("cells") >= (F.col("head_size") if least is None else F.lit(least)))
    pick = lambda k: F.coalesce(F.get("cells", F.get("places", F.lit(k))), F.lit(""))
    return cells.select("file_path", "at", *[pick(k).alias(n) for k, n in enumerate(fields)])


def read_star_counts(spark: SparkSession, paths) -> DataFrame:
    return star_counts(text_lines(spark, paths))


def star_counts(lines: DataFrame) -> DataFrame:
    """Gene counts of lines (value, file_path, at): blank, # and N_ lines are skipped, short
    rows dropped."""
    first = F.split_part("value", F.lit("\t"), F.lit(1))
    lines = lines.filter((F.trim("value") != "") & ~F.col("value").startswith("#") & ~first.startswith("N_"))
    names = ("gene_id", "gene_name", "gene_type", "unstranded", "tpm_unstranded", "fpkm_unstranded")
    return _with_header(lines, {n: n for n in names}, None, None)


BETA_FIELDS = {"probe": "Composite Element REF", "beta_value": "Beta_value", "chromosome": "Chromosome", "start": "Start", "end": "End", "gene_symbol": "Gene_Symbol"}


def read_beta_values(spark: SparkSession, paths) -> DataFrame:
    return beta_values(text_lines(spark, paths))


def beta_values(lines: DataFrame) -> DataFrame:
    """Beta values in the annotated layout, or as headerless probe and beta."""
    lines = lines.filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    return _with_header(lines, BETA_FIELDS, F.col("value").startswith("Composite Element REF"), 2, ["Composite Element REF", "Beta_value"])


MAF_FIELDS = {
    "gene_symbol": "Hugo_Symbol", "chromosome": "Chromosome", "start": "Start_Position", "end": "End_Position",
    "variant_class": "Variant_Classification", "variant_type": "Variant_Type", "ref": "Reference_Allele", "alt": "Tumor_Seq_Allele2",
    "barcode": "Tumor_Sample_Barcode", "gene": "Gene", "impact": "IMPACT", "t_depth": "t_depth", "t_alt": "t_alt_count",
    "n_depth": "n_depth", "n_alt": "n_alt_count", "filter": "FILTER",
}


def read_maf(spark: SparkSession, paths) -> DataFrame:
    """Mutation files, plain or gzip."""
    return maf_calls(text_lines(spark, paths))


def maf_calls(lines: DataFrame) -> DataFrame:
    """Mutation calls: # lines are skipped and the next is the header."""
    lines = lines.filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    return _with_header(lines, MAF_FIELDS, None, 2)


def files_by_line_ends(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files below a path whose lines are records, and those in which a quoted cell may
    hold a line end: there a line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (quotes % 2).alias("odd"))
    found = rows.groupBy("file").agg(F.max("odd").alias("odd")).collect()  # one row a file
    name = lambda r: unquote(r["file"])
    return sorted(name(r) for r in found if not r["odd"]), sorted(name(r) for r in found if r["odd"])


def read_raw_table(spark: SparkSession, path: str, ordered: bool = False, multi_line: bool | None = None) -> DataFrame:
    """A headed text table: tabs for .tsv and .tab, else commas; all text. ``ordered`` adds
    the place of each row.

    A quoted cell can hold line ends. ``multi_line`` says whether some do; None looks for
    them first. Files where they may occur are read by one task each, the others in parts.
    """
    sep = "\t" if path.rstrip("/").rsplit(".", 1)[-1] in ("tsv", "tab") else ","

    def read(paths, whole: bool) -> DataFrame:
        out = spark.read.csv(paths, header=True, sep=sep, escape='"', quote='"', inferSchema=False, multiLine=whole)
        return _placed(out, True) if ordered else out

    if multi_line is None:
        plain, quoted = files_by_line_ends(spark, path)
        if plain and quoted:
            return read(plain, False).unionByName(read(quoted, True), allowMissingColumns=True).na.fill("")
        multi_line = bool(quoted)
    return read(path, multi_line).na.fill("")


def _read_parquet(spark: SparkSession, path: str, ordered: bool) -> DataFrame:
    out = spark.read.parquet(path)
    return _placed(out, False) if ordered else out


def read_patient_survival(spark: SparkSession, paths) -> DataFrame:
    return spark.read.csv(paths, sep="\t", comment="#", header=True, escape='"').na.fill("")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def resolve_source(spark: SparkSession, name: str, interim: str, raw: str, ordered: bool = False) -> DataFrame | None:
    """The table of a name: interim before raw, Parquet before text; None if absent."""
    for folder in (interim, raw):
        if path_exists(spark, f"{folder}/{name}.parquet"):
            return _read_parquet(spark, f"{folder}/{name}.parquet", ordered)
        if path_exists(spark, f"{folder}/{name}"):
            return _read_parquet(spark, f"{folder}/{name}", ordered) if name.endswith(".parquet") else read_raw_table(spark, f"{folder}/{name}", ordered)
    return None


def read_graph(spark: SparkSession, folder: str, known=None, ordered: bool = False) -> tuple[dict[str, DataFrame], dict[str, DataFrame], list[str]]:
    """Node tables by label, edge tables by type, and the names that ``known`` lacks."""
    out, unknown = ({}, {}), []
    for kind, tables in zip(("nodes", "edges"), out, strict=True):
        for entry in list_names(spark, f"{folder}/{kind}"):
            name = entry.rsplit(".", 1)[0]
            if known is not None and name not in getattr(known, kind):
                unknown.append(f"{kind}/{name}")
                continue
            path = f"{folder}/{kind}/{entry}"
            tables[name] = read_raw_table(spark, path, ordered) if entry.endswith(".csv") else _read_parquet(spark, path, ordered)
    return *out, unknown
