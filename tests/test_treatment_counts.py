"""Treatments by case and aliquot are counted without making the rows."""

from collections import Counter

from braidwork.operators import flatten

SHAPE = (
    "case_id string, diagnoses array<struct<diagnosis_id string, treatments array<struct<treatment_id string>>>>, "
    "samples array<struct<portions array<struct<analytes array<struct<aliquots array<struct<aliquot_id string>>>>>>>>"
)


def case(name, treatments, *aliquots):
    diagnoses = None if treatments is None else [(f"d{k}", None if n is None else [(f"t{i}",) for i in range(n)]) for k, n in enumerate(treatments)]
    return (name, diagnoses, [([([([(a,) for a in ids],)],)],) for ids in aliquots] if aliquots else None)


def test_as_many_as_the_rows(session):
    cases = [
        case("c1", [2, 3], ["a", "b"], ["b", "c", "", None]), case("c1", [1], ["a"]), case("c2", [4]), case("c3", [0, None], ["a"]), case("c4", None, ["a"]),
        case("c5", [], ["a"]), case(None, [1], ["z"]), case("c6", [2], ["", None]), case("c7", [None, 1], [], ["q"]),
    ]
    df = session.createDataFrame(cases, SHAPE)
    want = Counter((r.case_id, r.sample_id) for r in flatten.treatments(df).collect())
    counted = flatten.treatment_counts(df)
    assert {(r.case_id, r.sample_id): r.n_treatments for r in counted.collect()} == dict(want) and sum(want.values()) == 24
    assert counted._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    bare = session.createDataFrame([("c",)], "case_id string")
    assert flatten.treatment_counts(bare).collect() == [] and flatten.treatment_counts(bare).columns == ["case_id", "sample_id", "n_treatments"]
