import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cauldra.plans.ingest import COLUMNS, ingest
from cauldra.plans.pipeline import load, normalize
from cauldra.plans.runs import Ledger, run_id
from cauldra.plans.store import Store
from cauldra.sources import raw, reviews
from cauldra.sources.config import Reviews, parse_config
from cauldra.streaming.incremental import load_new_files


def record(source, ident, at, title="2024 Old Garden", variants=(("1", "100 Grams"),), index=0, run="r1", **payload):
    body = {"id": int(ident), "title": title, "handle": f"h{ident}", "vendor": "North Maker", "product_type": "Green Tea", "tags": ["Region_Lime Valley"], "variants": [{"id": int(v), "title": o, "option1": o, "price": "23.40", "available": True, "grams": 125} for v, o in variants], **payload}
    return {"ingest_meta": {"source": source, "scraped_at": at, "run_id": run, "endpoint": "e", "record_index": index, "external_id": ident}, "payload": body}


def put(root, source, day, run, lines):
    d = root / f"source={source}" / f"date={day}"
    d.mkdir(parents=True, exist_ok=True)
    (d / f"run={run}.jsonl").write_text("\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines) + "\n", encoding="utf-8")


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_scan_quarantines_prunes_and_skips_strays(spark, tmp_path):
    root = tmp_path / "raw"
    good = record("s", "1", "2026-01-02T00:00:00Z")
    put(root, "s", "2026-01-02", "a", [good, "{no json here", {"ingest_meta": {"source": "s"}, "payload": {}}, "", {**good, "payload": [1]}])
    put(root, "s", "2026-01-05", "b", [good])
    put(root, "s", "notadate", "c", [good])
    (root / "source=s" / "date=2026-01-02" / "notes.txt").write_text("x")
    ok, bad = raw.split(raw.scan(spark, str(root)))
    assert (ok.count(), bad.count()) == (2, 3)
    assert raw.scan(spark, str(root), since=date(2026, 1, 3)).count() == 1
    assert raw.scan(spark, str(tmp_path / "missing")).count() == 0


def test_load_is_idempotent_and_first_wins(spark, tmp_path, store):
    root = tmp_path / "raw"
    a, b = record("s", "1", "2026-01-01T00:00:00Z"), record("s", "1", "2026-01-02T00:00:00Z", title="2024 New Garden")
    put(root, "s", "2026-01-01", "a", [a])
    put(root, "s", "2026-01-02", "b", [b])
    put(root, "s", "2026-01-03", "c", [{**a, "ingest_meta": {**a["ingest_meta"], "scraped_at": "2026-01-03T00:00:00Z"}}, "{bad"])
    first = load(spark, str(root), store).collect()[0]
    assert (first["records"], first["errors"], first["inserted"], first["skipped"]) == (3, 1, 2, 1)
    assert load(spark, str(root), store).collect()[0]["inserted"] == 0
    rows = store.read("bronze").orderBy("snapshot_id").collect()
    assert [r["snapshot_id"] for r in rows] == [1, 2]
    assert [r["scraped_at"].day for r in rows] == [1, 2]


def test_consecutive_dedup_keeps_the_return(spark, tmp_path, store):
    root = tmp_path / "raw"
    for day, title in ((1, "A"), (2, "B"), (3, "A"), (4, "A")):
        put(root, "s", f"2026-01-0{day}", f"r{day}", [record("s", "1", f"2026-01-0{day}T00:00:00Z", title=title)])
    load(spark, str(root), store, dedup="consecutive")
    assert [r["scraped_at"].day for r in store.read("bronze").orderBy("snapshot_id").collect()] == [1, 2, 3]
    load(spark, str(root), store, dedup="consecutive")
    assert store.read("bronze").count() == 3


def test_stream_equals_batch(spark, tmp_path, store):
    root = tmp_path / "raw"
    put(root, "s", "2026-01-01", "a", [record("s", str(i), "2026-01-01T00:00:00Z", index=i) for i in range(1, 6)])
    load_new_files(spark, str(root), store, str(tmp_path / "cp")).awaitTermination()
    put(root, "s", "2026-01-02", "b", [record("s", "1", "2026-01-02T00:00:00Z"), record("s", "9", "2026-01-02T00:00:00Z")])
    load_new_files(spark, str(root), store, str(tmp_path / "cp")).awaitTermination()
    batch = Store(spark, str(tmp_path / "batch"))
    load(spark, str(root), batch)
    key = lambda s: sorted((r["external_id"], r["payload_hash"]) for r in s.read("bronze").collect())
    assert key(store) == key(batch) and len(key(store)) == 6


def test_normalize_fans_out_resolves_and_repeats_without_change(spark, tmp_path, store):
    root = tmp_path / "raw"
    five = [(str(i), o) for i, o in enumerate(("50 Grams", "100 Grams", "250 Grams", "500 Grams", "1 Kilogram"), 1)]
    put(root, "s", "2026-01-01", "a", [record("s", "1", "2026-01-01T00:00:00Z", variants=five), record("s", "2", "2026-01-01T00:00:00Z", title="Pot", product_type="Non-Tea", index=1), record("s", "3", "2026-01-01T00:00:00Z", title="Loose", variants=(), index=2)])
    load(spark, str(root), store)
    got = {r["decision"]: r["n"] for r in normalize(spark, store, {"s": "https://s.example/"}, "2026-02-01").collect()}
    assert got == {"created": 5, "skipped": 1, "unmappable": 1}
    assert sorted(r["weight_grams"] for r in store.read("product").collect()) == [50, 100, 250, 500, 1000]
    assert {r["class"] for r in store.read("product").collect()} == {"A"}
    assert store.read("vendor_product").filter("vendor_url = 'https://s.example/products/h1'").count() == 5
    assert store.read("producer").count() == 1 and store.read("region").count() == 1
    before = {t: sorted(map(str, store.read(t).collect())) for t in ("product", "producer", "region", "vendor_product", "product_snapshot")}
    again = {r["decision"]: r["n"] for r in normalize(spark, store, {"s": "https://s.example/"}, "2026-02-01").collect()}
    assert again == {"exact": 5, "skipped": 1, "unmappable": 1}
    assert before == {t: sorted(map(str, store.read(t).select(*store.read(t).columns).collect())) for t in before}


def test_ledger_statuses(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "runs"))
    with ledger.run("s", "full") as r:
        assert ledger.all()[0]["status"] == "running"
    assert r.exit_code == 0 and ledger.all()[0]["status"] == "success"
    with ledger.run("s", "full") as r:
        r.error("x")
    assert r.exit_code == 1
    with pytest.raises(ValueError):
        with ledger.run("s", "full") as r:
            raise ValueError("no")
    assert r.exit_code == 2 and "ValueError: no" in r.error_summary
    assert len(run_id()) == 26 and run_id(1.0) < run_id(2.0)


def test_write_files_a_run_by_its_first_record(spark, tmp_path):
    rows = [record("s", "1", "2026-01-01T23:59:00Z", index=0), record("s", "2", "2026-01-02T00:01:00Z", index=1)]
    df = spark.createDataFrame([(r["ingest_meta"]["scraped_at"], i) for i, r in enumerate(rows)], "at string, i int").select(
        F.struct(F.lit("s").alias("source"), F.col("at").cast("timestamp").alias("scraped_at"), F.lit("r").alias("run_id"), F.lit("e").alias("endpoint"), F.col("i").alias("record_index"), F.col("i").cast("string").alias("external_id")).alias("ingest_meta"),
        F.lit("x").alias("payload"),
    )
    raw.write(df, str(tmp_path / "out"))
    assert [p.name for p in (tmp_path / "out" / "source=s").iterdir()] == ["date=2026-01-01"]
    assert [p.name for p in (tmp_path / "out" / "source=s" / "date=2026-01-01").glob("*.jsonl")] == ["run=r.jsonl"]
    assert raw.write(df.limit(0), str(tmp_path / "none")) == [] and not list((tmp_path / "none").glob("source=*"))


def test_what_is_written_is_read(spark, tmp_path):
    given = [record(s, str(i), f"2026-01-0{1 + i % 2}T00:00:0{i}Z", index=i, run=run, title="Été · 茶", note=None) for s, run in (("s", "r1"), ("s", "r2"), ("t", "r3")) for i in range(5)]
    text = spark.createDataFrame([(json.dumps(g, ensure_ascii=False),) for g in given], "value string")
    rows = text.select(F.from_json("value", "ingest_meta struct<source:string,scraped_at:timestamp,run_id:string,endpoint:string,record_index:int,external_id:string>, payload variant").alias("r")).select("r.*")
    root = str(tmp_path / "raw")
    made = raw.write(rows, root)
    assert len(made) == 3 and all(m.rsplit("/", 1)[1].startswith("run=") and m.endswith(".jsonl") for m in made)
    back = raw.scan(spark, root)
    assert back.filter("not ok").count() == 0
    key = lambda df: sorted(map(str, df.select("ingest_meta", F.to_json("payload").alias("p")).collect()))
    assert key(back) == key(rows)
    assert "茶" in open(made[0].removeprefix("file:"), encoding="utf-8").readline()
    # Written again, the run has a further file.
    assert len(raw.write(rows, root)) == 3 and raw.scan(spark, root).count() == 30


def test_makers_of_one_run_find_each_other(spark, tmp_path, store):
    root = tmp_path / "raw"
    names = ["Golden Leaf Mountain Tea House", "Golden Leaf Mountain Tea Houses", "Blue Gate", "golden leaf  mountain tea house"]
    put(root, "s", "2026-01-01", "a", [record("s", str(i), "2026-01-01T00:00:00Z", vendor=v, index=i, title=f"20{10 + i} Pot {i}") for i, v in enumerate(names, 1)])
    load(spark, str(root), store)
    normalize(spark, store, {}, "2026-02-01")
    made = {r["canonical_name"]: (r["producer_id"], r["aliases"]) for r in store.read("producer").collect()}
    assert made == {"Golden Leaf Mountain Tea House": (1, ["golden leaf mountain tea house", "golden leaf mountain tea houses"]), "Blue Gate": (2, ["blue gate"])}
    assert sorted(r["producer_id"] for r in store.read("product").collect()) == [1, 1, 1, 2]


def test_availability_by_what_counts_as_true(spark, tmp_path, store):
    root = tmp_path / "raw"
    given = [True, False, "yes", "", 1, 0, None, "false", [], {"a": 1}]
    put(root, "s", "2026-01-01", "a", [{**record("s", str(i), "2026-01-01T00:00:00Z", index=i), "payload": {**record("s", str(i), "x")["payload"], "variants": [{"id": i, "title": "50 g", "option1": "50 g", "price": "1", "available": v}]}} for i, v in enumerate(given, 1)])
    load(spark, str(root), store)
    normalize(spark, store, {}, "2026-02-01")
    got = {int(r["vendor_external_id"].split(":")[1]): r["available"] for r in store.read("product_snapshot").join(store.read("vendor_product"), "vendor_product_id").collect()}
    assert [got[i] for i in range(1, len(given) + 1)] == [bool(v) for v in given]


def test_ingest_isolates_sources(spark, tmp_path):
    config = parse_config("shops:\n  a: {base_url: 'https://a.example'}\n  b: {base_url: 'https://b.example', rate: 1}\n")
    ledger, root = Ledger(spark, str(tmp_path / "runs")), str(tmp_path / "raw")

    def read(spark, config, name, run):
        if name == "b":
            raise OSError("403")
        return spark.createDataFrame([(name, datetime(2026, 1, 1), run.run_id, "e", i, str(i), '{"id": %d}' % i) for i in range(3)], COLUMNS)

    assert ingest(spark, config, None, root, ledger, read=read) == {"a": "success", "b": "failed"}
    assert raw.scan(spark, root).filter("ok").count() == 3
    assert {(r["source"], r["status"], r["records_count"]) for r in ledger.all()} == {("a", "success", 3), ("b", "failed", None)}
    with pytest.raises(ValueError):
        ingest(spark, config, ["c"], root, ledger, read=read)


def test_config(monkeypatch):
    text = "shops: {a: {base_url: x}}\nreviews: {base_url: y, slugs: [s]}"
    assert parse_config(text).reviews.slugs == ("s",) and parse_config(text).reviews.rate == 0.1
    monkeypatch.setenv("CAULDRA_REVIEWS_RATE", "5")
    assert parse_config(text).reviews.rate == 5.0
    monkeypatch.setenv("CAULDRA_REVIEWS_RATE", "fast")
    with pytest.raises(ValueError):
        parse_config(text)
    monkeypatch.delenv("CAULDRA_REVIEWS_RATE")
    for bad in ("[]", "shops: [a]", "shops: {a: {}}", "shops: {a: {base_url: x, rate: -1}}", "shops: {a: {base_url: x, odd: 1}}", "reviews: {base_url: y, slugs: s}", "other: {}"):
        with pytest.raises(ValueError):
            parse_config(bad)


def test_walk_over_reviews():
    note = lambda i: f'<div class="note" id="note_{i}"><meta itemprop="name" content="A{i}"></div>'
    site = {
        "/companies/s/teas?page=1": '<a href="/teas/s/one">1</a><a href="/teas/o/x">x</a><a href="/teas/s/two">2</a><a href="?page=2">Next</a>',
        "/companies/s/teas?page=2": '<a href="/teas/s/two">2</a><a href="/teas/s/three">3</a>',
        "/teas/s/one": f'<h1 itemprop="name">One</h1>{note(1)}<a href="?page=2">Next</a>',
        "/teas/s/one?page=2": note(1) + note(2),
        "/teas/s/two": '<h1 itemprop="name">Two</h1>',
    }
    asked = []

    def get(url):
        asked.append(url)
        if url.endswith("/teas/s/two") and asked.count(url) == 1:
            return 503, {"Retry-After": "3"}, b""
        body = site.get(url.removeprefix("https://r.example"))
        return (404, {}, b"") if body is None else (200, {}, body.encode())

    slept = []
    got = list(reviews.records(Reviews("https://r.example", 100.0, slugs=("s",)), "run", 2, get, slept.append))
    assert [(g[4], g[5]) for g in got] == [(0, "one"), (1, "two")]
    assert [n["note_id"] for n in json.loads(got[0][6])["notes"]] == [1, 2] and 3.0 in slept
    with pytest.raises(OSError):
        list(reviews.records(Reviews("https://r.example", 100.0, slugs=("s",)), "run", None, get, slept.append))
