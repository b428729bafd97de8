"""Nested case and file records to relational grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidwork.functions.text import blank


def _has(schema: T.DataType, path: str) -> bool:
    for part in path.split("."):
        if isinstance(schema, T.ArrayType):
            schema = schema.elementType
        if not isinstance(schema, T.StructType) or part not in schema.names:
            return False
        schema = schema[part].dataType
    return True


def field(df: DataFrame, path: str) -> Column:
    """Text of a nested field; empty where it is absent or null."""
    return blank(F.col(path)) if _has(df.schema, path) else F.lit("")


def flatten_scalars(schema: T.StructType, at: str = "", prefix: str = "", skip=()) -> list[Column]:
    """Scalar fields as text columns with dotted names; arrays are left out."""
    out = []
    for f in schema.fields:
        path, name = f"{at}`{f.name}`", f"{prefix}{f.name}"
        if name in skip or isinstance(f.dataType, (T.ArrayType, T.MapType)):
            continue
        out += flatten_scalars(f.dataType, f"{path}.", f"{name}.", skip) if isinstance(f.dataType, T.StructType) else [blank(F.col(path)).alias(name)]
    return out


def case_ident(cases: DataFrame) -> list[Column]:
    return [field(cases, "case_id").alias("case_id"), field(cases, "submitter_id").alias("case_submitter_id")]


IDENT = ("case_id", "case_submitter_id")


def _children(df: DataFrame, path: str, ident: list[Column], extra: list[Column] = ()) -> DataFrame | None:
    """One row for each element of an array, as ``item``."""
    if not _has(df.schema, path):
        return None
    return df.select(*ident, *extra, F.explode(path).alias("item"))


def _emit(rows: DataFrame | None, like: DataFrame, lead: tuple[str, ...], skip=()) -> DataFrame:
    """Lead columns and the item's scalars; an empty table if there is no such array."""
    if rows is None:
        return like.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in lead))
    return rows.select(*lead, *flatten_scalars(rows.schema["item"].dataType, "item.", skip=(*lead, *skip)))


def subjects(cases: DataFrame) -> DataFrame:
    """One row a case: its scalars and those of demographic and project."""
    own = [f for f in cases.schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    cols = [blank(F.col(f"`{f.name}`")).alias(f.name) for f in own if f.name not in ("case_id", "submitter_id")]
    for name in ("demographic", "project"):
        if name in cases.columns:
            cols += flatten_scalars(cases.schema[name].dataType, f"`{name}`.", f"{name}.")
    return cases.select(*case_ident(cases), *cols)


def diagnoses(cases: DataFrame) -> DataFrame:
    return _emit(_children(cases, "diagnoses", case_ident(cases)), cases, IDENT)


def pathology_details(cases: DataFrame) -> DataFrame:
    lead = (*IDENT, "diagnosis_id")
    if not _has(cases.schema, "diagnoses.pathology_details"):
        return _emit(None, cases, lead)
    d = _children(cases, "diagnoses", case_ident(cases))
    rows = d.select(*IDENT, field(d, "item.diagnosis_id").alias("diagnosis_id"), F.explode("item.pathology_details").alias("item"))
    return _emit(rows, cases, lead)


def follow_ups(cases: DataFrame) -> DataFrame:
    return _emit(_children(cases, "follow_ups", case_ident(cases)), cases, IDENT)


def other_clinical_attributes(cases: DataFrame) -> DataFrame:
    return _emit(_children(cases, "other_clinical_attributes", case_ident(cases)), cases, IDENT)


def exposures(cases: DataFrame) -> DataFrame:
    """One row an exposure, with the case's first diagnosis id or the empty text."""
    first = blank(F.get("diagnoses", F.lit(0))["diagnosis_id"]) if _has(cases.schema, "diagnoses.diagnosis_id") else F.lit("")
    return _emit(_children(cases, "exposures", case_ident(cases), [first.alias("diagnosis_id")]), cases, (*IDENT, "diagnosis_id"))


def samples(cases: DataFrame) -> DataFrame:
    """One row an aliquot; its scalars win over the sample's of the same name."""
    s = _children(cases, "samples", case_ident(cases))
    lead = (*IDENT, "sample_id", "sample_submitter_id", "gdc_sample_id", "gdc_sample_submitter_id")
    if s is None or not _has(s.schema, "item.portions.analytes.aliquots"):
        return _emit(None, cases, lead)
    flat = lambda st: [f.name for f in st.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    own = [n for n in flat(s.schema["item"].dataType) if n not in ("sample_id", "submitter_id")]
    named = [field(s, "item.sample_id").alias("gdc_sample_id"), field(s, "item.submitter_id").alias("gdc_sample_submitter_id")]
    of_sample = [blank(F.col(f"item.`{n}`")).alias(f"sample.{n}") for n in own]
    held = [*IDENT, "gdc_sample_id", "gdc_sample_submitter_id", *[f"`sample.{n}`" for n in own]]
    a = s.select(*IDENT, *named, *of_sample, F.explode("item.portions").alias("p"))
    a = a.select(*held, F.explode("p.analytes").alias("y")).select(*held, F.explode("y.aliquots").alias("a"))
    cols = {"sample_id": field(a, "a.aliquot_id"), "sample_submitter_id": field(a, "a.submitter_id"), "gdc_sample_id": F.col("gdc_sample_id"), "gdc_sample_submitter_id": F.col("gdc_sample_submitter_id")}
    cols |= {n: F.col(f"`sample.{n}`") for n in own}
    cols |= {n: blank(F.col(f"a.`{n}`")) for n in flat(a.schema["a"].dataType) if n not in ("aliquot_id", "submitter_id")}
    return a.select(*IDENT, *[c.alias(n) for n, c in cols.items()])


def _aliquots(samples_path: str = "samples", leaf: str = "aliquot_id") -> Column:
    """All values of an aliquot field below an array of samples, in order."""
    nested = F.transform(
        F.coalesce(F.col(samples_path), F.array()),
        lambda s: F.flatten(F.transform(F.coalesce(s["portions"], F.array()), lambda p: F.flatten(F.transform(F.coalesce(p["analytes"], F.array()), lambda y: F.transform(F.coalesce(y["aliquots"], F.array()), lambda q: F.coalesce(q[leaf], F.lit(""))))))),
    )
    return F.flatten(nested)


def _aliquot_ids(cases: DataFrame) -> Column:
    """The distinct aliquots of a case; one empty id if it has none."""
    ids = F.array_distinct(F.filter(_aliquots(), lambda x: x != "")) if _has(cases.schema, "samples.portions.analytes.aliquots.aliquot_id") else F.array().cast("array<string>")
    return F.when(F.size(ids) > 0, ids).otherwise(F.array(F.lit("")))


def treatments(cases: DataFrame) -> DataFrame:
    """One row for each treatment and distinct aliquot of the case; a case without
    aliquots gives one row with an empty sample_id."""
    lead = (*IDENT, "diagnosis_id", "sample_id")
    if not _has(cases.schema, "diagnoses.treatments"):
        return _emit(None, cases, lead)
    d = cases.select(*case_ident(cases), _aliquot_ids(cases).alias("ids"), F.explode("diagnoses").alias("d"))
    t = d.select(*IDENT, field(d, "d.diagnosis_id").alias("diagnosis_id"), "ids", F.explode("d.treatments").alias("item"))
    rows = t.select(*IDENT, "diagnosis_id", F.explode("ids").alias("sample_id"), "item")
    return _emit(rows, cases, lead)


def treatment_counts(cases: DataFrame) -> DataFrame:
    """How many rows ``treatments`` has of each case and aliquot. Every treatment of a case meets every aliquot,
    so they are counted per case and the rows, as many as the product of both, aren't made."""
    if not _has(cases.schema, "diagnoses.treatments"):
        return cases.sparkSession.createDataFrame([], "case_id string, sample_id string, n_treatments long")
    sizes = F.transform("diagnoses", lambda d: F.when(d["treatments"].isNotNull(), F.size(d["treatments"])).otherwise(0).cast("long"))
    n = cases.select(field(cases, "case_id").alias("case_id"), _aliquot_ids(cases).alias("ids"), F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x).alias("n")).filter("n > 0")
    rows = n.select("case_id", F.explode("ids").alias("sample_id"), "n")
    return rows.groupBy("case_id", "sample_id").agg(F.sum("n").alias("n_treatments"))


def programs(cases: DataFrame) -> DataFrame:
    named = cases.filter(field(cases, "project.program.name") != "")
    cols = flatten_scalars(cases.schema["project"].dataType["program"].dataType, "project.program.") if _has(cases.schema, "project.program.name") else []
    return named.select(*case_ident(cases), *cols)


def studies(cases: DataFrame) -> DataFrame:
    named = cases.filter(field(cases, "project.project_id") != "")
    lead = [field(cases, "project.project_id").alias("project_id"), field(cases, "project.name").alias("project_name"), field(cases, "project.program.name").alias("program_name")]
    rest = []
    if "project" in cases.columns:
        kinds = (T.StructType, T.ArrayType, T.MapType)
        rest = [blank(F.col(f"project.`{f.name}`")).alias(f.name) for f in cases.schema["project"].dataType.fields if f.name not in ("project_id", "name") and not isinstance(f.dataType, kinds)]
    return named.select(*case_ident(cases), *lead, *rest)


ENTITIES = {
    "subject": subjects, "diagnosis": diagnoses, "pathology_detail": pathology_details, "follow_up": follow_ups, "exposure": exposures,
    "other_clinical_attribute": other_clinical_attributes, "sample": samples, "treatment": treatments, "program": programs, "study": studies,
}


def emit_all(cases: DataFrame) -> dict[str, DataFrame]:
    return {name: build(cases) for name, build in ENTITIES.items()}


def first_aliquot_id() -> Column:
    """The first aliquot of the first sample of a file's first case, else empty."""
    at = F.get("cases", F.lit(0))
    for name in ("samples", "portions", "analytes", "aliquots"):
        at = F.get(at[name], F.lit(0))
    return blank(at["aliquot_id"])


def last_wins(df: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    """The last non-blank value of each non-blank key."""
    rows = df.filter((blank(F.col(key)) != "") & (blank(F.col(value)) != ""))
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def aliquot_map(files: DataFrame, order: str) -> DataFrame:
    """barcode to aliquot uuid over all nesting of all files; the last file wins."""
    q = files.select(order, F.posexplode("cases").alias("c_at", "c"))
    for name in ("samples", "portions", "analytes", "aliquots"):
        outer = [c for c in q.columns if c != "c"]
        q = q.select(*outer, F.posexplode(f"c.{name}").alias(f"{name}_at", "c"))
    at = F.struct(*[c for c in q.columns if c != "c"])
    return last_wins(q.select(F.col("c.submitter_id").alias("barcode"), F.col("c.aliquot_id").alias("uuid"), at.alias("at")), "barcode", "uuid", F.col("at"))


def case_crosswalk(subject_rows: DataFrame, order: str) -> DataFrame:
    return last_wins(subject_rows, "case_submitter_id", "case_id", F.col(order))


def cohort_intersection(kinds: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """Keys that stand in the table of every kind."""
    tagged = None
    for kind, df in kinds.items():
        part = df.select(*by, F.lit(kind).alias("kind")).filter(blank(F.col(by[-1])) != "")
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(*by).agg(F.count_distinct("kind").alias("n")).filter(F.col("n") == len(kinds)).drop("n")


def preferred_case(candidates: DataFrame, project_priority: str, sample_type: str, order: str, case: str = "case_id") -> DataFrame:
    """One case: by project priority, primary or tumour samples first, file order, id."""
    kind = F.lower(blank(F.col(sample_type)))
    other = ~(kind.contains("primary") | kind.contains("tumor"))
    return candidates.orderBy(project_priority, other, order, case).limit(1)
