"""The two batch runs: raw files to the deduplicated layer, and from there to products and facts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import product_url
from ..operators import bronze, resolve, silver
from ..operators.recency import recency_classes
from ..session import checkpointed
from ..sources import raw
from .runs import Run
from .store import Store

BRONZE = "snapshot_id long, source string, external_id string, scraped_at timestamp, run_id string, payload string, payload_hash string"
PRODUCER = "producer_id long, canonical_name string, aliases array<string>"
REGION = "region_id long, country string, province string"
VENDOR = "vendor_id long, source_key string, base_url string"
PRODUCT = "product_id long, canonical_name string, producer_id long, region_id long, tea_type string, harvest_year int, weight_grams int, class string"
LISTING = "vendor_product_id long, vendor_id long, vendor_external_id string, product_id long, vendor_url string"
SNAPSHOT = "snapshot_id long, vendor_product_id long, scraped_at timestamp, available boolean, price_cents int, description_hash string"
COLUMNS = [c.strip().split(" ")[0] for c in BRONZE.split(", ")]


def load(spark: SparkSession, root: str, store: Store, since: date | None = None, run: Run | None = None, dedup: str = "global") -> DataFrame:
    """Raw files to bronze; returns counters per source. Run again, it inserts nothing.

    ``dedup``: ``global`` keeps the first of each (source, item, content) for ever; ``consecutive``
    keeps every change, so that a return to an earlier content is a row again.
    """
    scanned = raw.scan(spark, root, since)
    good, bad = raw.split(scanned)
    rows = bronze.hashed(good)
    there = store.read("bronze", BRONZE)
    if dedup == "global":
        fresh = bronze.new_only(bronze.first_wins(rows), there)
    else:
        order = [F.col("scraped_at"), F.coalesce("snapshot_id", F.lit(2**62)), *[F.col(c) for c in bronze.ARRIVAL]]
        both = there.unionByName(bronze.first_wins(rows, ["source", "external_id", "payload_hash", "scraped_at"]), allowMissingColumns=True)
        fresh = bronze.consecutive(both, order).filter("snapshot_id is null").drop("snapshot_id")
        fresh = bronze.new_only(fresh, there, ["source", "external_id", "payload_hash", "scraped_at"])
    start = there.agg(F.coalesce(F.max("snapshot_id"), F.lit(0)).alias("m")).first()["m"]
    numbered = checkpointed(bronze.with_ids(fresh, "snapshot_id", list(bronze.ARRIVAL), start).select(*COLUMNS))
    counters = checkpointed(bronze.load_counters(scanned, numbered))
    store.append("bronze", numbered, ["source"])
    if run is not None:
        total = counters.agg(F.sum("inserted").alias("i"), F.sum("errors").alias("e")).first()
        run.records_count = total["i"] or 0
        for row in bad.select("file").limit(20).collect():
            run.error(f"bad line in {row['file']}")
        run.errors_count = total["e"] or 0
    return counters


def normalize(spark: SparkSession, store: Store, base_urls: dict[str, str], as_of: str, since: date | None = None, source: str | None = None, run: Run | None = None) -> DataFrame:
    """Bronze rows since a date to dimensions, products, listings and facts; returns decisions.

    Rows are processed in the order (source, snapshot_id, variant). Run again over the same rows, it
    changes nothing. ``as_of`` is the time that recency classes are reckoned from.
    """
    rows = store.read("bronze", BRONZE)
    if since is not None:
        rows = rows.filter(F.col("scraped_at") >= F.lit(since).cast("timestamp"))
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    mapped = checkpointed(silver.map_products(silver.read_payload(rows)))
    kept = mapped.filter("gate <> 'skipped'")

    urls = spark.createDataFrame(list(base_urls.items()) or [("", "")], "source_key string, base_url string")
    vendor = silver.get_or_create(kept.select(F.col("source").alias("source_key")), store.read("vendor", VENDOR), ["source_key"], "vendor_id")
    vendor = store.write("vendor", vendor.drop("base_url").join(urls, "source_key", "left").select("vendor_id", "source_key", "base_url"))

    producer = store.read("producer", PRODUCER)
    order = F.struct("source", "snapshot_id", "variant_pos")
    hints = kept.select(F.col("producer.name").alias("name"), order.alias("at")).filter("name is not null")
    resolved = checkpointed(resolve.resolve_producers(hints, producer))
    # The first spelling of a key names the new producer.
    new = hints.withColumn("key", resolve.name_key(F.col("name"))).groupBy("key").agg(F.min_by("name", "at").alias("canonical_name"))
    start = producer.agg(F.coalesce(F.max("producer_id"), F.lit(0)).alias("m")).first()["m"]
    fresh = resolved.filter("how = 'create'").select("key", "at").join(new, "key").select("key", "canonical_name", F.col("at.source").alias("_a"), F.col("at.snapshot_id").alias("_b"), F.col("at.variant_pos").alias("_c"))
    made = checkpointed(bronze.with_ids(fresh, "producer_id", ["_a", "_b", "_c", "key"], start).select("key", "canonical_name", "producer_id"))
    producer = resolve.with_aliases(producer, resolved)
    known = resolved.select("key", "producer_id").filter("producer_id is not null").unionByName(made.select("key", "producer_id"))
    followers = resolved.filter("like is not null").select(F.col("key").alias("follower"), F.col("like").alias("key")).join(made, "key")
    known = checkpointed(known.unionByName(followers.select(F.col("follower").alias("key"), "producer_id")))
    theirs = followers.groupBy("producer_id").agg(F.array_sort(F.collect_set("follower")).alias("_more"))
    made = made.join(theirs, "producer_id", "left").withColumn("aliases", F.array_union(F.array("key"), F.coalesce("_more", F.array().cast("array<string>"))))
    producer = producer.unionByName(made.select("producer_id", "canonical_name", "aliases"))
    store.write("producer", producer)

    region = silver.get_or_create(kept.filter("region is not null").select("region.country", "region.province"), store.read("region", REGION), ["country", "province"], "region_id")
    region = store.write("region", region)

    ok = mapped.filter("gate = 'ok'")
    ok = ok.withColumn("key", resolve.name_key(F.col("producer.name"))).join(known, "key", "left").drop("key")
    ok = ok.join(region, ok["region.country"].eqNullSafe(region["country"]) & ok["region.province"].eqNullSafe(region["province"]), "left").drop("country", "province")
    ok = ok.join(vendor.select(F.col("source_key").alias("source"), "vendor_id", "base_url"), "source")
    ok = checkpointed(bronze.with_ids(ok, "row_no", ["source", "snapshot_id", "variant_pos"]))

    product = store.read("product", PRODUCT)
    decided = checkpointed(resolve.resolve_products(ok.withColumnRenamed("canonical_name", "name"), product.withColumnRenamed("canonical_name", "name")))
    fresh = decided.filter("product_id < 0").select("product_id").distinct().withColumn("row_no", -F.col("product_id"))
    start = product.agg(F.coalesce(F.max("product_id"), F.lit(0)).alias("m")).first()["m"]
    fresh = checkpointed(bronze.with_ids(fresh, "new_id", ["row_no"], start).select("product_id", "row_no", "new_id"))
    created = ok.join(fresh.select("row_no", "new_id"), "row_no").select(F.col("new_id").alias("product_id"), "canonical_name", "producer_id", "region_id", "tea_type", "harvest_year", "weight_grams", F.lit(None).cast("string").alias("class"))
    product = product.unionByName(created)
    placed = checkpointed(ok.join(decided.join(fresh.select("product_id", "new_id"), "product_id", "left").select("row_no", F.coalesce("new_id", "product_id").alias("product_id"), "decision"), "row_no"))

    listing = store.read("vendor_product", LISTING)
    urls_of = placed.select("vendor_id", "vendor_external_id", "product_id", product_url(F.col("base_url"), F.col("handle")).alias("vendor_url"), F.col("row_no").alias("at"))
    after = silver.upsert_listings(listing.drop("vendor_product_id"), urls_of).join(listing.select("vendor_product_id", "vendor_id", "vendor_external_id"), ["vendor_id", "vendor_external_id"], "left")
    top = listing.agg(F.coalesce(F.max("vendor_product_id"), F.lit(0)).alias("m")).first()["m"]
    unnumbered = after.filter("vendor_product_id is null").drop("vendor_product_id")
    listing = store.write("vendor_product", after.filter("vendor_product_id is not null").unionByName(bronze.with_ids(unnumbered, "vendor_product_id", ["vendor_id", "vendor_external_id"], top)))

    facts = store.read("product_snapshot", SNAPSHOT)
    incoming = placed.join(listing.select("vendor_product_id", "vendor_id", "vendor_external_id"), ["vendor_id", "vendor_external_id"]).select("snapshot_id", "vendor_product_id", "scraped_at", "available", "price_cents", "description_hash")
    facts = store.append("product_snapshot", silver.new_snapshots(incoming, facts))

    touched = placed.select("product_id").distinct()
    seen = facts.join(listing.select("vendor_product_id", "product_id"), "vendor_product_id").join(touched, "product_id", "left_semi")
    classes = recency_classes(seen, touched, F.lit(as_of).cast("timestamp"), "product_id", "scraped_at", "available", "vendor_product_id")
    product = product.join(classes.withColumnRenamed("class", "_c"), "product_id", "left").withColumn("class", F.coalesce("_c", "class")).drop("_c")
    store.write("product", product)

    counts = mapped.filter("gate <> 'ok'").groupBy(F.col("gate").alias("decision")).agg(F.count(F.lit(1)).alias("n")).unionByName(decided.groupBy("decision").agg(F.count(F.lit(1)).alias("n")))
    counts = checkpointed(counts)
    if run is not None:
        run.records_count = placed.count()
        for r in counts.filter("decision in ('unmappable', 'ambiguous_created')").collect():
            run.errors_count += r["n"]
            run.samples.append(f"{r['n']} {r['decision']}")
    return counts
