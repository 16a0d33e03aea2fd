"""Hand-made rows for the text rules."""

import pytest
from pyspark.sql import functions as F

from tidecast.functions import attribution as at


def values(spark, texts, expression, column="s"):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, f"i int, {column} string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def label_as_dict(label):
    """Plain reading of the label rules, as the brute-force side."""
    if label is None:
        return None
    found = {}
    for item in label.split("_"):
        parts = item.split("-")
        if len(parts) == 2:
            found[parts[0]] = parts[1]
            continue
        for word in ("mapresults", "localuniversal"):
            if word in item.lower():
                found["placement"] = word
                break
        if "hotel-" in item.lower():
            pieces = item.split("hotel-")
            found["hotel_id"] = pieces[1] if len(pieces) > 1 else None
    return found


LABELS = [
    "cid-12_cid-13",
    "a-b-c",
    "MapResults",
    "x-hotel-9",
    "hotel-9",
    "",
    None,
    "cid-",
    "cid-1-2_cid-7_ucc-US",
    "placement-own_x-localUniversal-y",
    "LOCALUNIVERSAL_placement-own",
    "Hotel-9-1",
    "x-hotel-9hotel-8-z",
    "xcid-5",
    "cid-5_",
    "_cid-6",
    "cid-1\n_ucc-2",
    "mapresults-localuniversal-x",
]


def test_label_map_follows_the_rules(spark):
    maps = values(spark, LABELS, at.label_map(F.col("s")))
    assert maps == [label_as_dict(label) for label in LABELS]


@pytest.mark.parametrize("key", ["cid", "ucc", "placement", "hotel_id", "hotel", "x.y"])
def test_label_value_equals_the_map_entry(spark, key):
    got = values(spark, LABELS, at.label_value(F.col("s"), key))
    assert got == [None if m is None else m.get(key) for m in map(label_as_dict, LABELS)]


def test_affiliate_attributes(spark):
    names = ["acc_US.LU.PC", "acc_US.MR.Tablet", "accUS", "acc_US.ZZ.TV", None, "a_b.LU"]
    s = F.col("s")
    assert values(spark, names, at.affiliate_country(s)) == ["US", "US", None, "US", None, "b"]
    assert values(spark, names, at.affiliate_placement(s)) == [
        "localuniversal", "mapresults", None, None, None, "localuniversal",
    ]
    assert values(spark, names, at.affiliate_device(s)) == [
        "desktop", "tablet", None, None, None, None,
    ]


def test_hotel_from_label(spark):
    labels = ["hotel-12_xqdz", "hotel-abc_xqdz", "none", None]
    assert values(spark, labels, at.hotel_from_label(F.col("s"), F.lit(5))) == [12, 5, 5, 5]


def test_locale_and_device(spark):
    labels = ["linkmob-corede-hotel-1", "x-core-hotel", None, "plain"]
    s = F.col("s")
    assert values(spark, labels, at.locale_from_label(s)) == ["DE", "US", "US", "US"]
    assert values(spark, labels, at.device_from_label(s, F.lit("a.Mobile"))) == ["mobile"] * 4
    assert values(spark, labels, at.device_from_label(s, F.lit("a.PC"))) == [
        "mobile", "web", "web", "web",
    ]


def test_names_and_silos(spark):
    s = F.col("s")
    assert values(spark, ["US.DMeta.x.y"], at.distribution_from_name(s)) == ["US.DMeta"]
    assert values(spark, ["US.DMeta.x.y"], at.placement_from_name(s)) == ["x"]
    silos = ["USDMeta", "Search", None]
    assert values(spark, silos, at.distribution_from_silo(s, ["DMeta", "Mobile"])) == [
        "US", "", None,
    ]
    assert values(spark, ["account_4_FR.a.b"], at.pos_from_name(s, at.POS_AFTER_ACCOUNT_4)) == [
        "FR"
    ]
    greedy = at.pos_from_name(s, at.POS_AFTER_UNDERSCORE, at.POS_AFTER_UNDERSCORE_GROUP)
    assert values(spark, ["account_4_FR.a.b", "x"], greedy) == ["FR", ""]
