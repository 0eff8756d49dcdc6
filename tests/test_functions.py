import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cauldra.functions import catalog as c
from cauldra.functions import pages, text as t
from cauldra.functions.trigrams import similarity
from cauldra.operators.resolve import name_trigrams


def one(spark, column, **values):
    schema = ", ".join(f"{k} {v[0]}" for k, v in values.items())
    return spark.createDataFrame([tuple(v[1] for v in values.values())], schema).select(column.alias("x")).first()["x"]


def many(spark, column, rows, schema="a string"):
    return [r["x"] for r in spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"i int, {schema}").orderBy("i").select(column.alias("x")).collect()]


def test_names_and_space(spark):
    rows = ["\tNorth  Slope \n Autumn", "North\u00a0Slope", "e\u0301 Q", None, "", "\u3000"]
    assert many(spark, t.name_key(F.col("a")), rows) == ["north slope autumn", "north slope", "\u00e9 q", None, "", ""]


def test_cents(spark):
    rows = ["23.40", "6.5", "0.345", "free", None, "nan", "inf", "1e400", "", "204"]
    assert many(spark, t.cents(F.col("a")), rows) == [2340, 650, 34, None, None, None, None, None, None, 20400]


def test_safe_int(spark):
    assert many(spark, t.safe_int(F.col("a")), ["88", " 88 ", "88.5", "1e2", "+5", "", None, "99999999999"]) == [88, 88, None, None, 5, None, None, None]


def test_weights(spark):
    rows = [("80 grams", None, None), ("2 kilograms", None, None), ("One disc (330 g)", None, None), ("4 x 7 g coins", None, None), ("Plain", None, "Large - 150g disc"), ("Plain", None, "Clay pot"), ("62.5g", None, None), ("2 x (40 g)", None, None), (None, "35 g", None), (None, None, None)]
    assert many(spark, c.net_grams(F.col("a"), F.col("b"), F.col("d")), rows, "a string, b string, d string") == [80, 2000, 330, 28, 150, None, 62, 40, 35, None]


def test_years(spark):
    rows = [("2031 Hollow", []), ("1980s stored batch", []), ("Small Discs", ["Harvest & Season_Late 2033"]), ("2008 Stored", ["Harvest & Season_Late 2033"]), ("2031年秋茶", []), ("q", ["Harvest & Season_1970s"]), ("2003 q", ["Pu-erh Harvest Season_Early 2032"]), (None, None)]
    assert many(spark, c.harvest_year(c.parsed_tags(F.col("b")), F.col("a")), rows, "a string, b array<string>") == [2031, None, 2033, 2033, None, 1970, 2032, None]


def test_tags(spark):
    tags = ["Producer_Quill", "Region_Elm Coast", "Region_Ash Hills", "Price per gram_  $0.3  to $0.4", "Odd_thing", "", "  ", None, " bare ", "Region_"]
    parsed = one(spark, c.parsed_tags(F.col("a")), a=("array<string>", tags))
    assert [(p["key"], p["value"]) for p in parsed] == [("producer", "Quill"), ("region", "Elm Coast"), ("region", "Ash Hills"), ("price per gram", "$0.3 to $0.4"), (None, "Odd_thing"), (None, "bare"), (None, "Region_")]
    assert one(spark, c.tag_map(c.parsed_tags(F.col("a"))), a=("array<string>", tags))["region"] == ["Elm Coast", "Ash Hills"]
    assert one(spark, c.other_tags(c.parsed_tags(F.col("a"))), a=("array<string>", tags)) == ["Odd_thing", "bare", "Region_"]


def test_hints_and_urls(spark):
    rows = [(["Producer_X"], "Y"), ([], "Copper  Kiln "), (None, "  "), (None, None)]
    got = many(spark, c.producer_hint(c.parsed_tags(F.col("a")), F.col("b")), rows, "a array<string>, b string")
    assert [g and tuple(g) for g in got] == [("X", "tag"), ("Copper Kiln", "vendor"), None, None]
    assert many(spark, t.product_url(F.col("a"), F.col("b")), [("https://x/", "tea"), ("https://x", " "), (None, "tea")], "a string, b string") == ["https://x/products/tea", None, None]
    assert many(spark, c.is_kind(F.col("a"), F.col("b"), "non-tea"), [(" Non-Tea ", None), ("Tea", ["non-TEA"]), (None, [None])], "a string, b array<string>") == [True, True, False]


def test_payload_hash_is_blind_to_key_order_only(spark):
    a, b, d = '{"b": {"y": 1, "x": "é"}, "a": [1, 2]}', '{"a":[1,2],"b":{"x":"é","y":1}}', '{"a":[2,1],"b":{"x":"é","y":1}}'
    ha, hb, hd, bad, twice = many(spark, t.payload_hash(F.col("a")), [a, b, d, "{no", '{"a":1,"a":2}'])
    want = hashlib.sha256(json.dumps(json.loads(a), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    assert ha == hb == want and hd != ha and bad is None and twice is None


def test_description_hash(spark):
    h = t.description_hash(F.col("a"), F.col("b"), F.col("d"))
    rows = [("Tea", "x", ["b", "a"]), ("Tea", "x", ["a", "b"]), ("tea", "x", ["a", "b"]), ("Téa", "x", None), ("Téa", "x", [])]
    got = many(spark, h, rows, "a string, b string, d array<string>")
    assert got[0] == got[1] != got[2] and got[3] == got[4]
    # Tags count in any Unicode form, and sort by the composed one.
    composed, apart = many(spark, h, [("Tea", "x", ["z", "\u00e9"]), ("Tea", "x", ["e\u0301", "z"])], "a string, b string, d array<string>")
    assert composed == apart != got[0]


def test_truthiness(spark):
    given = ["true", "false", '"no"', '""', "0", "0.0", "3", "[]", "[0]", "{}", '{"a":null}', "null", None]
    assert many(spark, t.truthy(F.parse_json("a")), given) == [True, False, True, False, False, False, True, False, True, False, True, False, False]


def test_person_hash(spark):
    got = many(spark, t.person_hash(F.col("a")), ["José", " JOSÉ ", "Jose", None])
    assert got[0] == got[1] != got[2] and got[3] is None and got[0].startswith("sha256:") and len(got[0]) == 71


@pytest.mark.parametrize("a, b, want", [("Silver Creek Leaf 5", "Silver Creek Leaf 7", 18 / 22), ("2031 Blue Hollow Harvest", "2031 Bluehollow Harvest", 22 / 26), ("Cedar Lane A 88", "Cedar Lane B 88", 14 / 18), ("word", "two words", 4 / 11)])
def test_trigrams(spark, a, b, want):
    assert one(spark, similarity(F.col("a"), F.col("b")), a=("string", a), b=("string", b)) == pytest.approx(want, abs=1e-6)
    x, y = name_trigrams(a), name_trigrams(b)
    assert len(x & y) / len(x | y) == pytest.approx(want, abs=1e-6)


PAGE = """<html><h1 itemprop='name'> Old  Garden </h1><span id="rating-average">88</span><meta itemprop="reviewCount" content="12">
<div class="description">Nice &amp; <b>soft</b></div><dl class="tea-description"><dt>Type</dt><dd>Green</dd><dt>Type</dt><dd>Other</dd><dt>Empty</dt><dd> </dd></dl>
<div class="tea-prep"><div class="prep-details"><span class="temp">90 C</span><span>no class</span></div></div><div id="availability"><h4>Gone</h4></div>
<div class="note" id="note_7"><meta itemprop="name" content="Ann"><span itemprop="ratingValue">90</span><p itemprop="description">Good<br>tea</p><abbr itemprop="datePublished" content="2024-01-02">x</abbr><span class="likes-count">3</span><a class="show-inline-comments" data-pluralize-count="2">c</a></div>
<div class="note" id="note_8"><span itemprop="ratingValue">50</span></div><div class="note" id="odd"><meta itemprop="name" content="Bo"></div>
<a href="/teas/s/one">1</a><a href="/teas/s/two">2</a><a href="/teas/s/one">1</a><a href="/teas/other/x">3</a><a href="/c?page=2">Next</a></html>"""


def test_review_page(spark):
    got = one(spark, pages.read_page(F.col("a")), a=("string", PAGE))
    assert (got["name"], got["average_rating"], got["rating_count"], got["description"]) == ("Old Garden", 88, 12, "Nice & soft")
    assert got["description_pairs"] == {"Type": "Green"} and got["prep"] == {"temp": "90 C"} and got["availability"] == "Gone" and got["has_next"]
    assert [tuple(n) for n in got["notes"]] == [(7, "Ann", 90, "Goodtea", "2024-01-02", 3, 2)]
    empty = one(spark, pages.read_page(F.col("a")), a=("string", None))
    assert empty["name"] is None and empty["notes"] == [] and not empty["has_next"]
    assert one(spark, pages.page_links(F.col("a"), r"/teas/s/\w+"), a=("string", PAGE)) == ["/teas/s/one", "/teas/s/two"]
