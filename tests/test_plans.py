import pytest

from braidwork.plans.names import Columns, camel, plain
from braidwork.plans.schema import Graph, Profile


def test_names():
    given = ("plot_soil", "Plot soil", "plotSoil", "days_to.harvest", "", "__q", "9 lives_left")
    assert [camel(x) for x in given] == ["plotSoil", "plotSoil", "plotSoil", "daysToHarvest", "", "q", "9LivesLeft"]
    assert plain("Num PH-Tests") == "numphtests"


HEADERS = ["farm_no", "owner.trade", "num_ph_tests", "kind", "o", "x_depth", "depth"]


@pytest.mark.parametrize(
    "prop, column, how",
    [
        ("chosen", "o", "choice"), ("absent", None, "unmatched"), ("ownerKind", "kind", "rename"), ("farmId", "farm_no", "rename"),
        ("metres", "depth", "common_rename"), ("other", None, "unmatched"), ("farmNo", "farm_no", "camel"), ("numPHTests", "num_ph_tests", "letters"),
        ("trade", "owner.trade", "last_part"), ("TRADE", "owner.trade", "last_part"), ("depth", "depth", "camel"), ("none", None, "unmatched"),
    ],
)
def test_every_kind_of_claim(prop, column, how):
    found = Columns(HEADERS, {"chosen": "o", "absent": "gone"}, {"kind": "ownerKind"}, {"farm_no": "farmId"}, {"kind": "other", "depth": "metres"}, ("x_",)).find(prop)
    assert (found.column, found.strategy) == (column, how)


def test_a_prefix_is_cut_after_whole_headers():
    assert Columns(["x_depth"], prefixes=("x_",)).find("depth").column == "x_depth"
    assert Columns(["x_depth", "depth"], prefixes=("x_",)).find("depth").column == "depth"


def test_alias_order_and_collisions():
    two = Columns(["left", "right"], aliases={"right": "side"}, profile_aliases={"left": "side"})
    assert two.find("side").column == "left"  # of two columns the profile's is first
    one = Columns(["left"], aliases={"left": "mine"}, profile_aliases={"left": "theirs"})
    assert one.find("mine").column == "left" and one.find("theirs").column is None
    assert Columns(["soil_ph", "soilPh", "z"]).collisions == {"soilPh": ["soil_ph", "soilPh"]}


def test_schema_problems():
    good = {"A": {"id": "aId", "properties": ["x", {"y": "float"}]}}
    assert Graph.of(good, {"E": {"pairs": [["A", "A"]]}}).nodes["A"].columns == ["aId", "x", "y"]
    for nodes, edges in (
        ({"A": {"id": ""}}, {}),
        ({"A": {"id": "i", "subtypeFrom": "s"}}, {}),
        ({"A": {"id": "i", "properties": [{"x": "money"}]}}, {}),
        (good, {"E": {"pairs": []}}),
        (good, {"E": {"pairs": [["A", "B"]]}}),
    ):
        with pytest.raises(ValueError):
            Graph.of(nodes, edges)


def test_includes():
    files = {
        "base": {"nodes": {"A": {"file": "a.tsv", "key": "a"}, "B": {"file": ["b.tsv", "c.tsv"], "key": "b"}}, "aliases": {"x": "y"}, "reshape": [{"type": "vcf"}], "include": ["top"]},
        "top": {"include": ["base"], "nodes": {"A": {"file": "z.tsv", "key": "z", "dedup": False}}, "aliases": {"q": "r"}},
    }
    p = Profile.of("top", files.__getitem__)
    assert p.nodes["A"].sources == ("z.tsv",) and not p.nodes["A"].dedup and p.nodes["B"].sources == ("b.tsv", "c.tsv")
    assert p.aliases == {"x": "y", "q": "r"} and p.reshape == ()
