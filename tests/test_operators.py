import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cauldra.operators import analytics, bronze, recency, resolve, silver, snapshots, units
from cauldra.operators.nested import FlatTable, Level, child_keys, flatten_table, flatten_tables
from cauldra.sources import pages as shops

RECORD = "ingest_meta struct<source:string,scraped_at:timestamp,run_id:string,record_index:int,external_id:string>, payload struct<id:long,variants:array<struct<id:long,title:string,option1:string,grams:int>>,images:array<struct<id:long,variant_ids:array<long>>>,tags:array<string>>, child string, child_key int"


def rec(ident, variants=None, images=None, tags=None, at=datetime(2026, 1, 1)):
    return ({"source": "s", "scraped_at": at, "run_id": "r", "record_index": 0, "external_id": ident}, {"id": 1, "variants": variants, "images": images, "tags": tags}, "clash", 7)


def test_child_keys(spark):
    rows = [rec("1", [{"id": 5}, None, {"id": None}, {"id": 5}], [{"id": 9}], [" a ", "a", "", "  ", None]), rec("1"), rec("2"), rec("2", [], [], []), rec("3", [None]), rec(None, None, None, ["t"])]
    got = sorted(map(tuple, child_keys(spark.createDataFrame(rows, RECORD)).collect()), key=str)
    assert got == sorted([("1", "variant", "5"), ("1", "image", "9"), ("1", "tag", "a"), ("2", "none", ""), ("3", "none", ""), (None, "tag", "t")], key=str)
    assert child_keys(spark.createDataFrame([], RECORD)).count() == 0


def test_nested_levels_keep_ancestors_and_positions(spark):
    df = spark.createDataFrame([rec("1", None, [{"id": 9, "variant_ids": [1, 2]}, {"id": 8, "variant_ids": None}, None, {"id": 7, "variant_ids": [None]}]), rec("2")], RECORD)
    t = FlatTable([Level("payload.images", "i", {"image_id": "id"}), Level("variant_ids", "j")], {"variant_id": ""})
    got = [tuple(r) for r in flatten_table(df, {"ext": "ingest_meta.external_id"}, t).collect()]
    assert got == [("1", 9, 0, 0, 1), ("1", 9, 0, 1, 2), ("1", 7, 3, 0, None)]
    assert flatten_table(df, {"ext": "ingest_meta.external_id"}, t, keep_empty=True).count() == 4
    with pytest.raises(ValueError):
        flatten_table(df, {"i": "ingest_meta.external_id"}, t)
    assert set(flatten_tables(df, {"ext": "ingest_meta.external_id"}, {"x": t})) == {"x"}


def brute_changes(rows, last):
    by = {}
    for layer, source, key, ord_, _, content in rows:
        by[(layer, source, ord_, key)] = content
    out = set()
    for (layer, source), n in last.items():
        keys = {k[3] for k in by if k[:2] == (layer, source)}
        for o in range(2, n + 1):
            for key in keys:
                a, b = (layer, source, o - 1, key) in by, (layer, source, o, key) in by
                if b and not a:
                    out.add((layer, source, key, o, "added"))
                elif a and not b:
                    out.add((layer, source, key, o, "removed"))
                elif a and b and by[layer, source, o - 1, key] != by[layer, source, o, key]:
                    out.add((layer, source, key, o, "changed"))
    return out


@pytest.mark.parametrize("cells, chunk", [(1, 4), (8, 64), (3, 1)])
def test_snapshot_changes_equal_brute_force(spark, cells, chunk):
    r = random.Random(cells)
    last, rows = {("l", "big"): 5, ("l", "small"): 3, ("m", "gap"): 3}, []
    for (layer, source), n in last.items():
        state = {f"k{i}": "x" for i in range(200 if source == "big" else 8)}
        for o in range(1, n + 1):
            for k in list(state):
                if r.random() < 0.03:
                    state[k] = r.choice(["x", "y", None])
                if r.random() < 0.02:
                    del state[k]
            if r.random() < 0.5:
                state[f"n{o}"] = "x"
            if source == "gap" and o == 2:
                continue
            rows += [(layer, source, k, o, n, v) for k, v in state.items()]
    df = spark.createDataFrame(rows, "layer string, source string, item_key string, ord int, last_ord int, content string").withColumn("content", F.to_binary("content", F.lit("utf-8")))
    got = {tuple(x) for x in snapshots.snapshot_changes(df, cells, chunk).collect()}
    want = brute_changes(rows, last)
    assert got == want and want
    assert snapshots.snapshot_changes(df.limit(0), cells, chunk).count() == 0


def test_latest_row_of_a_run_counts_and_case_does_not(spark):
    day = lambda d, h=0: datetime(2026, 1, d, 1, h)
    runs = [(f"r{d}", "s", day(d), day(d, 50), "success" if d != 3 else "failed") for d in (1, 2, 3, 4)]
    raw = [(1, "s", "a", day(1, 1), "r1", "AA"), (2, "s", "a", day(1, 2), "r1", "bb"), (3, "s", "b", day(1, 1), "r1", "cc"), (4, "s", "a", day(2, 1), "r2", "BB"), (5, "s", "b", day(3, 1), "r3", "zz"), (6, "s", "c", day(4, 1), "r4", "dd"), (7, "s", "a", day(4, 1), "r4", "bb")]
    spark_runs = spark.createDataFrame(runs, "run_id string, source string, started_at timestamp, finished_at timestamp, status string")
    df = spark.createDataFrame(raw, "snapshot_id long, source string, external_id string, scraped_at timestamp, run_id string, payload_hash string")
    facts = spark.createDataFrame([(1, 10, day(1, 5), True, 5), (2, 10, day(2, 5), True, None), (3, 10, day(4, 5), None, None)], "snapshot_id long, vendor_product_id long, scraped_at timestamp, available boolean, price_cents int")
    vp, v = spark.createDataFrame([(10, 1)], "vendor_product_id long, vendor_id long"), spark.createDataFrame([(1, "s")], "vendor_id long, source_key string")
    got = {tuple(x) for x in snapshots.catalog_changes(df, facts, vp, v, spark_runs).collect()}
    assert got == {("bronze", "s", "b", "r2", "removed"), ("bronze", "s", "c", "r4", "added"), ("silver", "s", "10", "r2", "changed"), ("silver", "s", "10", "r4", "changed")}


@pytest.mark.parametrize(
    "text, want",
    [("9 grams", (9, "g")), ("1.76 oz (50 g)", (50, "g")), ("50 g / 1.76 oz", (50, "g")), ("7.1 oz", (201, "g")), ("4两", (200, "g")), ("半斤", (250, "g")), ("一斤", (500, "g")), ("0,1 kg", (100, "g")), ("10*25g", (250, "g")), ("5 pieces, 5 g each", (25, "g")), ("10 pack of 25 g", (250, "g")), ("20 bags @ 50g", (1000, "g")), ("25g x 10 pcs", (250, "g")), ("2 × 25 g", (50, "g")), ("One disc (357 g)", (357, "g")), ("1 pc / 500g", (500, "g")), ("Set of 4", None), ("12 inch", None), ("9.9 cm", None), ("Sample", None), ("a hundred grams", (100, "g")), ("Half a kilogram", (500, "g")), ("¼ lb", (113, "g")), ("1/2 lb", (227, "g")), (".25 lbs", (113, "g")), ("11.8 fluid ounces", (349, "ml")), ("22 cl", (220, "ml")), ("0,35l", (350, "ml")), ("180毫升", (180, "ml")), ("25 г", (25, "g")), ("1,000 g", (1000, "g")), ("", None), ("x" * 100_000, None)],
)
def test_quantities(text, want):
    got = units.quantity(text, None, None)
    assert (got and got[:2]) == want


def test_identities_choose_units_and_flag():
    assert units.resolve("8 oz / 237 ml")[1] == "ml"
    assert units.resolve("8 oz / 227 g")[:2] == (227.0, "g")
    assert units.resolve("100 g")[3] is True


def test_shipping_mass_outvotes_a_prior_and_ties_are_flagged(spark):
    # Half a litre of loose leaves ships as 150 g; 16 oz of mass could not.
    assert units.resolve("16 oz", 150.0)[1] == "ml" and units.resolve("16 oz", 500.0)[1] == "g"
    # Grams and grains both fit without columns, grams alone with them; a weight stated twice is one.
    assert units.resolve("50 gr")[3] is False and units.resolve("50 gr", 60.0)[:2] == (50.0, "g") and units.resolve("50 gr", 60.0)[3] is True
    assert units.resolve("3.5 oz (100 g)", 120.0)[3] is True
    rows = [rec("1", [{"id": 1, "option1": "8 oz", "title": "", "grams": 250}, {"id": 2, "option1": "50 g", "title": "", "grams": 60}])]
    got = {r["variant_id"]: (r["amount"], r["unit"], r["is_unique"]) for r in units.variant_quantities(spark.createDataFrame(rows, RECORD)).collect()}
    assert got == {1: (227, "g", False), 2: (50, "g", True)}


def test_all_statements_of_a_text_count():
    assert units.resolve("8 oz, 8 oz, 8 oz, 8 oz, 227 g")[:2] == (227.0, "g")
    assert units.resolve(" / ".join(["8 oz"] * 60))[1] == "g"


def test_variant_quantities_prefer_option_and_latest(spark):
    rows = [rec("1", [{"id": 1, "option1": "50 g", "title": "70 g", "grams": 60}, {"id": 2, "option1": "Gift Box", "title": "Gift Box / 9 g", "grams": None}, {"id": 3, "option1": None, "title": None}, {"id": None, "option1": "1 g"}, None]), rec("1", [{"id": 1, "option1": "55 g", "title": "", "grams": 0}], at=datetime(2026, 2, 1))]
    got = {r["variant_id"]: (r["amount"], r["unit"]) for r in units.variant_quantities(spark.createDataFrame(rows, RECORD)).collect()}
    assert got == {1: (55, "g"), 2: (9, "g")}
    assert units.variant_quantities(spark.createDataFrame([], RECORD)).count() == 0


def sequential(rows):
    """The ladder as one sequential pass over all rows and groups."""
    known, out = [], []
    for no, name, group in rows:
        own, key = resolve.name_trigrams(name), name.lower()
        here = [(i, n) for i, n, g in known if g == group]
        same = [i for i, n in here if n.lower() == key]
        if same:
            out.append((no, same[0], "exact"))
            continue
        close = sorted((-len(own & (t := resolve.name_trigrams(n))) / len(own | t), i) for i, n in here if len(own & resolve.name_trigrams(n)) >= 0.85 * len(own | resolve.name_trigrams(n)))[:5]
        if close and (len(close) < 2 or -close[0][0] >= 0.95 or close[1][0] - close[0][0] >= 0.10):
            out.append((no, close[0][1], "trigram"))
            continue
        known.append((no, name, group))
        out.append((no, no, "ambiguous_created" if close else "created"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_ladder_by_group_equals_sequential(spark, seed):
    r = random.Random(seed)
    base = ["Old Arbor Spring Harvest Mountain Reserve", "Lonely Garden Evening Blend Pressed"]
    rows = []
    for no in range(1, 181):
        name = r.choice(base) + r.choice(["", " Cake", " Cakes", " Cakes Brick", " Cake X1", " Cake X2", " Cake X3", " X", " Limited"])
        rows.append((no, name, (r.choice([1, None]), r.choice([2020, None]), 100)))
    df = spark.createDataFrame([(n, m, *g) for n, m, g in rows], "row_no long, name string, producer_id long, harvest_year int, weight_grams int")
    empty = spark.createDataFrame([], "product_id long, name string, producer_id long, harvest_year int, weight_grams int")
    got = {x["row_no"]: (-x["product_id"], x["decision"]) for x in resolve.resolve_products(df, empty).collect()}
    assert got == {n: (p, d) for n, p, d in sequential(rows)}


def test_ladder_vectors(spark):
    g = (1, 2024, 100)
    empty = "product_id long, name string, producer_id long, harvest_year int, weight_grams int"
    known = [(1, "Old Arbor Spring Harvest Mountain Reserve Cake X2", *g), (2, "Old Arbor Spring Harvest Mountain Reserve Cake X3", *g), (3, "Plain", None, None, None)]
    new = [(1, "Old Arbor Spring Harvest Mountain Reserve Cake X1", *g), (2, "plain", None, None, None), (3, "Plain", 1, None, None), (4, "PLAIN", None, None, None)]
    got = {x["row_no"]: (x["product_id"], x["decision"]) for x in resolve.resolve_products(spark.createDataFrame(new, "row_no long, name string, producer_id long, harvest_year int, weight_grams int"), spark.createDataFrame(known, empty)).collect()}
    assert got == {1: (-1, "ambiguous_created"), 2: (3, "exact"), 3: (-3, "created"), 4: (3, "exact")}


def test_producers(spark):
    known = spark.createDataFrame([(1, "North Maker", ["nm", None]), (2, "Silver Creek Leaf Workshops 77", None), (3, "Silver Creeks Leaf Workshop 77", [])], "producer_id long, canonical_name string, aliases array<string>")
    hints = spark.createDataFrame([("NM",), ("north  maker",), ("Silver Creek Leaf Workshop 77",), ("Nobody",), (None,), ("  ",)], "name string")
    told = resolve.resolve_producers(hints, known)
    got = {r["key"]: (r["producer_id"], r["how"]) for r in told.collect()}
    assert got == {"nm": (1, "alias"), "north maker": (1, "name"), "silver creek leaf workshop 77": (2, "trigram"), "nobody": (None, "create")}
    after = {r["producer_id"]: r["aliases"] for r in resolve.with_aliases(known, told).collect()}
    assert after[2] == ["silver creek leaf workshop 77"] and after[1] == ["nm", None, "north maker"]


def test_new_makers_in_order(spark):
    """Names take their turn: what one creates, later ones find, as in a loop."""
    r = random.Random(4)
    base = ["golden leaf mountain tea house", "old river gate trading company"]
    keys = list({r.choice(base) + "".join(r.choice(["", "s", " x", " xy", " xyz"]) for _ in range(3)) for _ in range(60)})
    r.shuffle(keys)
    made, want = [], {}
    for k in keys:
        g = resolve.name_trigrams(k)
        near = sorted((-len(g & h) / len(g | h), i) for i, (_, h) in enumerate(made) if len(g & h) >= 0.85 * len(g | h))
        want[k] = made[near[0][1]][0] if near else None
        if not near:
            made.append((k, g))
    hints = spark.createDataFrame([(k, i) for i, k in enumerate(keys)] * 2, "name string, at int")
    told = resolve.resolve_producers(hints, spark.createDataFrame([], "producer_id long, canonical_name string, aliases array<string>"))
    assert {x["key"]: x["like"] for x in told.collect()} == want and 1 < len(made) < len(keys)


def test_trigram_index_equals_all_pairs(spark):
    r = random.Random(3)
    words = ["tea", "house", "cloud", "mountain", "old", "river", "gate"]
    names = list({" ".join(r.choice(words) + r.choice(["", "s", "x"]) for _ in range(r.randint(1, 4))) for _ in range(60)})
    df = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    got = {(x["name"], x["id"]) for x in resolve.trigram_matches(df.select("name"), df, "name", "id", "name", 0.5).collect()}
    sim = lambda a, b: (lambda x, y: len(x & y) / len(x | y))(resolve.name_trigrams(a), resolve.name_trigrams(b))
    assert got == {(a, i) for a in names for i, b in enumerate(names) if sim(a, b) >= 0.5}


def test_recency(spark):
    now = datetime(2026, 2, 28)
    ago = lambda **k: now - timedelta(**k)
    seen = [(1, ago(days=0), True, 1), (2, ago(days=180), True, 1), (2, now, False, 1), (3, ago(days=900), True, 1), (3, now, False, 1), (4, datetime(2024, 2, 28), True, 1), (4, now, False, 1), (5, datetime(2024, 2, 27, 23, 59), True, 1), (5, now, None, 1), (7, now, True, 1), (7, now, False, 2)]
    df = spark.createDataFrame(seen, "id long, at timestamp, ok boolean, tie long")
    ids = spark.createDataFrame([(i,) for i in range(1, 8)], "id long")
    got = {r["id"]: r["class"] for r in recency.recency_classes(df, ids, F.lit(now), "id", "at", "ok", "tie").collect()}
    assert got == {1: "A", 2: "B", 3: "C", 4: "B", 5: "C", 6: "C", 7: "A"}


def test_ids_are_gapless_in_order(spark):
    df = spark.range(0, 1000, 1, 7).select(F.pmod(F.col("id") * 37, F.lit(1000)).alias("k"))
    got = [r["n"] for r in bronze.with_ids(df, "n", ["k"], 5).orderBy("k").collect()]
    assert got == list(range(6, 1006))
    assert bronze.with_ids(df.limit(0), "n", ["k"]).count() == 0


def test_first_wins_and_null_keys(spark):
    df = spark.createDataFrame([("s", None, "h", 2, "x"), ("s", None, "h", 1, "y"), ("s", "a", "h", 3, "z")], "source string, external_id string, payload_hash string, n int, extra string")
    got = {(r["external_id"], r["extra"]) for r in bronze.first_wins(df, order=[F.col("n")]).collect()}
    assert got == {(None, "y"), ("a", "z")}
    assert bronze.new_only(df, df.filter("external_id is null")).count() == 1


def test_upsert_keeps_product_and_takes_url(spark):
    cur = spark.createDataFrame([(1, "a", 10, "old"), (1, "b", 11, None)], "vendor_id long, vendor_external_id string, product_id long, vendor_url string")
    new = spark.createDataFrame([(1, "a", 99, None, 1), (1, "b", 99, "u1", 1), (1, "b", 99, "u2", 2), (1, "c", 12, "u3", 1)], "vendor_id long, vendor_external_id string, product_id long, vendor_url string, at int")
    got = {r["vendor_external_id"]: (r["product_id"], r["vendor_url"]) for r in silver.upsert_listings(cur, new).collect()}
    assert got == {"a": (10, "old"), "b": (11, "u2"), "c": (12, "u3")}


def test_nearest_by_blocks(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.standard_normal(4).tolist()) for i in range(90)] + [(90, [0.0] * 4)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    q = df.filter("id % 3 = 0").selectExpr("id as query_id", "v as qv")
    parts = analytics._nearest_by_blocks(df, q, "id", "v", 3, item_block=20, query_block=7).collect()
    best = {}
    for p in sorted(parts, key=lambda p: (p["query_id"], -p["sim"], p["id"])):
        best.setdefault(p["query_id"], []).append(p["id"])
    want = {(x["query_id"], x["rank"]): x["id"] for x in analytics.nearest(df, df.filter("id % 3 = 0"), "id", "v", 3).collect()}
    assert {(k, i + 1): x for k, ids in best.items() for i, x in enumerate(ids[:3])} == want


def test_nearest_equals_brute_force(spark):
    import numpy as np

    v = np.random.default_rng(0).standard_normal((60, 4)).astype("float32")
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)] + [(99, None), (98, [0.0] * 4)], "id long, v array<float>")
    got = {(r["query_id"], r["rank"]): r["id"] for r in analytics.nearest(df, df.filter("id % 20 = 0"), "id", "v", 3).collect()}
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in (0, 20, 40):
        s = n @ n[q]
        s[q] = -9
        assert [got[q, k] for k in (1, 2, 3)] == list(np.argsort(-s)[:3])


def test_ngrams_and_context(spark):
    df = spark.createDataFrame([(1, "A gaiwan, a Gaiwan!"), (2, None), (3, ""), (4, "one")], "id long, t string")
    assert {(r["ngram"], r["n"]) for r in analytics.ngram_counts(df, "t", 2).collect()} == {("a gaiwan", 2), ("gaiwan a", 1)}
    assert [(r["id"], r["position"], r["left"], r["right"]) for r in analytics.keyword_in_context(df, "id", "t", "gaiwan", 4).orderBy("position").collect()] == [(1, 0, "a ", ", a "), (1, 1, ", a ", "!")]


def test_shop_pages_retry_and_stop():
    said, waits = [(429, {"Retry-After": "3"}, b""), (503, {}, b""), (200, {}, b'{"products":[{"id":1},{"title":"no id"},{"id":2}]}'), (200, {}, b'{"products":[]}')], []
    got = list(shops.records("s", "https://x/", "r", 1000.0, lambda url: said.pop(0), waits.append))
    assert [g[5] for g in got] == ["1", "2"] and [g[4] for g in got] == [0, 1] and waits[:2] == [3.0, 2.0]
    with pytest.raises(OSError):
        list(shops.records("s", "https://x", "r", 1000.0, lambda url: (403, {}, b""), waits.append))


@pytest.mark.parametrize("cell_rows", [2000, 3])
def test_best_others_equal_sql(spark, monkeypatch, tmp_path, cell_rows):
    duckdb = pytest.importorskip("duckdb")
    from cauldra.plans import catalog_queries

    monkeypatch.setattr(resolve, "CELL_ROWS", cell_rows)
    r = random.Random(cell_rows)
    words = ["large", "Large", "larger", "hot", "hotter", "ring", "rings", "bolt", "bölt", "bold", "x1", "x2", "x3", "茶"]
    name = lambda: r.choice([None, "", " - ", "..."]) if r.random() < 0.1 else r.choice([" ", "  ", "-"]).join(r.choice(words) for _ in range(r.randint(1, 4)))
    rows = [(None if r.random() < 0.03 else r.choice([i, r.randint(0, 500)]), name(), r.choice(["a", "b", "b", None]), r.choice([1, 2, 2, 2, None])) for i in range(500)]
    # Rows alone in their block but for one that is alike, and an id with rows that are equal.
    rows += [(601, "Old Arbor Cake", "c", 1), (602, "Old Arbor Cakes", "c", 1), (603, "Old Arbor Cake", "d", 1), (604, "Old Arbor Cakes", "d", 1), (604, "Old Arbor Cakes", "d", 1), (605, "?", "e", 1), (606, "!", "e", 1), (607, "q", "f", 1)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{tmp_path}/part.parquet/*.parquet')")
    want = sorted(con.execute(f"SELECT p_partkey, other, label FROM ({catalog_queries.ORACLE['ambiguity_label']})").fetchall())
    got = sorted(tuple(x) for x in catalog_queries.ambiguity_label(spark, str(tmp_path)).collect())
    assert got == want
    assert (601, 602, "similar") in got and (603, 604, "ambiguous") in got and (605, 606, "similar") in got


def test_rows_of_equal_names_are_not_compared_in_pairs(spark, tmp_path):
    """All pairs of rows would be 400 million similarities; the job is cancelled after a minute and a half."""
    import threading

    from cauldra.plans import catalog_queries

    n = 20_000
    df = spark.range(n).select(F.col("id").alias("p_partkey"), F.format_string("large name %d", F.col("id") % 40).alias("p_name"))
    df = df.unionByName(spark.createDataFrame([(n, "Large, name!")], "p_partkey long, p_name string"))
    df.withColumns({"p_brand": F.lit("b"), "p_size": F.lit(1)}).write.parquet(f"{tmp_path}/part.parquet")
    stop = threading.Timer(90, spark.sparkContext.cancelAllJobs)
    stop.start()
    try:
        got = {x["p_partkey"]: (x["other"], x["label"]) for x in catalog_queries.ambiguity_label(spark, str(tmp_path)).collect()}
    finally:
        stop.cancel()
    assert got == {i: (i % 40 if i >= 40 else i + 40, "similar") for i in range(n)} | {n: (0, "ambiguous")}
