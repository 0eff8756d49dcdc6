import random

import pytest
from pyspark.sql import functions as F

from cauldra.llm import canonical as c

NAMES = [(1, "Raw Pu-erh"), (1, "Sheng"), (1, "生茶"), (2, "Ripe Pu-erh"), (3, "Teapot"), (3, "Tea Pot"), (4, "Tea Pet"), (5, "High Mountain Oolong"), (6, "Black Tea"), (6, "红茶")]
REF = c.Reference(NAMES)


@pytest.mark.parametrize("value, want", [("Raw Pu-erh", 1), ("raw puerh ", 1), ("Pu-erh, Raw", 1), ("Shop/Raw Pu-erh", 1), ("Tea > Ripe Pu-erh", 2), ("Rie Pu-erh", 2), ("Premium Black Tea", 6), ("Black Tea (all)", 6), ("*Teapot*", 3), ("Teapot 2021", 3), ("Tea Pets", 4), ("High Mutain Oolong", 5), ("HIGHMOUNTAINOOLONG", 5), ("生茶", 1), ("红", None), ("Tea Towel", None), ("Black Garlic", None), ("???", None), ("x" * 5000, None)])
def test_lookup(value, want):
    got = REF.lookup(value)
    assert (got and got[0]) == want


def test_symmetric_deletes_find_what_brute_force_finds():
    r = random.Random(1)
    keys = [c.compact(s) for _, s in REF.names]
    for _ in range(1500):
        k = list(r.choice(keys))
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(k) + 1)
            k[i : i + r.randint(0, 1)] = r.choice(["", r.choice("abcdefg")])
        k = "".join(k)
        near = {s for _, s in REF.names if c.edits(k, c.compact(s)) <= min(c.edits_allowed(k), c.edits_allowed(c.compact(s)))}
        assert near <= {s for _, s in REF.candidates(k)}


def test_distances():
    assert c.edits("abc", "acb") == 1 and c.edits("", "abc") == 3 and c.edits("kitten", "sitting") == 3
    assert c.weighted_distance("tea pot", "teapot") < 0.5 < c.weighted_distance("tea pit", "tea pet")
    assert c.weighted_distance("blaack", "black") < c.weighted_distance("blxack", "black")


@pytest.mark.parametrize("limit", [20_000, 0])
def test_map_values(spark, limit):
    ref = spark.createDataFrame([(1, "Raw Pu-erh", ["Sheng", None]), (6, "Black Tea", None)], "type_id long, type_name string, aka array<string>")
    df = spark.createDataFrame([("Sheng", 0), ("sheng", 0), ("Blck Tea", 0), ("Towel", 0), ("Towel", 0), (None, 0), ("  ", 0), (" ", 0)], "v string, entry int")
    got = {r["value"]: (r["entry"], r["rows"]) for r in c.map_values(df, "v", ref, "type_id", "type_name", "aka", broadcast_names=limit).collect()}
    assert got == {"Sheng": (1, 1), "sheng": (1, 1), "Blck Tea": (6, 1), "Towel": (0, 2)}
    assert c.map_values(df.limit(0), "v", ref, "type_id", "type_name", "aka", broadcast_names=limit).count() == 0
    assert {r["entry"] for r in c.map_values(df, "v", ref.limit(0), "type_id", "type_name", "aka", broadcast_names=limit).collect()} == {0}


def test_frequency_breaks_ties():
    names = [(1, "hongcha"), (2, "huangcha")]
    assert c.Reference(names, {1: 5, 2: 1}).rank("hungcha", [(1, "hongcha"), (2, "huangcha")])[2] in (1, 2)
    assert c.Reference([(1, "abcdef"), (2, "abcdeg")], {2: 9}).lookup("abcdex")[0] == 2
    assert c.Reference([(1, "abcdef"), (2, "abcdeg")], {1: 9}).lookup("abcdex")[0] == 1


def test_latest_listing(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 3)], "id long, t string, n int").select(F.struct(F.timestamp_seconds("n").alias("scraped_at"), F.lit("r").alias("run_id"), F.lit(0).alias("record_index")).alias("ingest_meta"), F.struct("id", F.col("t").alias("product_type")).alias("payload"))
    assert [tuple(r) for r in c.latest_listings(df, "product_type").collect()] == [(1, "b")]


def test_ties_are_alike_by_broadcast_and_by_join(spark):
    """Entries at one distance go by how often they are written exactly, whatever way the list is read."""
    ref = spark.createDataFrame([(1, "Lang", None), (2, "Gang", None), (3, "Ju Lang", ["Julang"]), (4, "Oolongs", None), (5, "Oolonga", None)], "type_id long, type_name string, aka array<string>")
    rows = ["Gang"] * 3 + ["Lang"] * 2 + ["G ang", "Mang", "Oolongx", "Ju  Lang", "julang", "Gang, Lang", None, " "]
    values = spark.createDataFrame([(x,) for x in rows], "v string")
    a, b = ({(r["value"], r["entry"], r["distance"], r["rows"]) for r in c.map_values(values, "v", ref, "type_id", "type_name", "aka", n).collect()} for n in (100, 0))
    assert a == b and {r[0]: r[1] for r in a}["Mang"] == 2
