"""Queries of the catalogue operators, with oracle SQL. Every query runs over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import catalog as c
from ..functions import pages
from ..functions import text as t
from ..operators import analytics, bronze, recency, resolve, silver
from ..session import table

#: The time that recency classes are reckoned from, and the two of the change set.
AS_OF, EARLIER = "2026-03-01 00:00:00", "2026-01-15 00:00:00"
SINCE = "2026-01-15"


def scan_since(spark: SparkSession, d: str) -> DataFrame:
    """Rows since a date: the filter reaches the scan."""
    return table(spark, d, "raw_product_snapshot").filter(F.col("scraped_at") >= F.lit(SINCE).cast("timestamp")).select("snapshot_id", "source", "external_id")


def json_fields(spark: SparkSession, d: str) -> DataFrame:
    p = F.try_parse_json("payload")
    field = lambda path, kind: F.try_variant_get(p, path, kind)
    return table(spark, d, "raw_product_snapshot").select("snapshot_id", field("$.id", "long").alias("payload_id"), field("$.title", "string").alias("title"), field("$.variants[0].price", "string").alias("first_price"))


def payload_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Whether the stored hash is that of the payload's canonical form, however both are written."""
    return table(spark, d, "raw_product_snapshot").select("snapshot_id", (t.payload_hash(F.col("payload")) == F.lower("payload_hash")).alias("matches"))


def _content(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_product_snapshot").withColumn("payload_hash", F.lower("payload_hash"))


def bronze_first_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = _content(spark, d).select("source", "external_id", "payload_hash", "snapshot_id", "run_id")
    return bronze.first_wins(rows, order=[F.col("snapshot_id")])


def bronze_new_only(spark: SparkSession, d: str) -> DataFrame:
    """Contents of a later load that an earlier one lacks."""
    rows = _content(spark, d).select("source", "external_id", "payload_hash", "snapshot_id", "scraped_at")
    cut = F.lit(SINCE).cast("timestamp")
    fresh = bronze.first_wins(rows.filter(F.col("scraped_at") >= cut), order=[F.col("snapshot_id")])
    return bronze.new_only(fresh, rows.filter(F.col("scraped_at") < cut)).select("source", "external_id", "payload_hash", "snapshot_id")


def bronze_consecutive(spark: SparkSession, d: str) -> DataFrame:
    rows = _content(spark, d).select("source", "external_id", "payload_hash", "snapshot_id", "scraped_at")
    return bronze.consecutive(rows, [F.col("scraped_at"), F.col("snapshot_id")]).select("snapshot_id")


def load_counters(spark: SparkSession, d: str) -> DataFrame:
    rows = _content(spark, d)
    kept = bronze.first_wins(rows.select("source", "external_id", "payload_hash", "snapshot_id"), order=[F.col("snapshot_id")])
    lines = rows.select(F.col("source").alias("source_dir"), t.payload_hash(F.col("payload")).isNotNull().alias("ok"))
    return bronze.load_counters(lines, kept)


def numbered_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "vendor_product").select("vendor_external_id")
    return bronze.with_ids(rows, "row_no", ["vendor_external_id"])


def latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "product_snapshot").select("vendor_product_id", "snapshot_id", "scraped_at", "available", "price_cents")
    return recency.latest(rows, ["vendor_product_id"], [F.col("scraped_at"), F.col("snapshot_id")]).select("vendor_product_id", "snapshot_id", "available", "price_cents")


def _observed(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "product_snapshot").select("vendor_product_id", "scraped_at", "available")
    return facts.join(table(spark, d, "vendor_product").select("vendor_product_id", "product_id"), "vendor_product_id")


def last_available(spark: SparkSession, d: str) -> DataFrame:
    return _observed(spark, d).groupBy("product_id").agg(F.max(F.when(F.col("available"), F.col("scraped_at"))).alias("last_available_at"), F.count_if("available").alias("times_available"))


def _classes(spark: SparkSession, d: str, as_of: str, months: int) -> DataFrame:
    seen = _observed(spark, d).filter(F.col("scraped_at") <= F.lit(as_of).cast("timestamp"))
    return recency.recency_classes(seen, table(spark, d, "product"), F.lit(as_of).cast("timestamp"), "product_id", "scraped_at", "available", "vendor_product_id", months)


def tier_catalog(spark: SparkSession, d: str) -> DataFrame:
    return _classes(spark, d, AS_OF, 24)


def tier_changes(spark: SparkSession, d: str) -> DataFrame:
    return silver.distinct_from(_classes(spark, d, EARLIER, 1), _classes(spark, d, AS_OF, 1), "product_id", "class")


def tier_counts(spark: SparkSession, d: str) -> DataFrame:
    return tier_catalog(spark, d).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


def touched_products(spark: SparkSession, d: str) -> DataFrame:
    """Products with a fact since a date (semi join)."""
    recent = _observed(spark, d).filter(F.col("scraped_at") >= F.lit(SINCE).cast("timestamp"))
    return table(spark, d, "product").join(recent, "product_id", "left_semi").select("product_id", "producer_id")


def new_facts(spark: SparkSession, d: str) -> DataFrame:
    """Facts of a later load, one per listing and time, that an earlier one lacks."""
    rows = table(spark, d, "product_snapshot").select("snapshot_id", "vendor_product_id", "scraped_at", "available", "price_cents")
    cut = F.lit(SINCE).cast("timestamp")
    return silver.new_snapshots(rows.filter(F.col("scraped_at") >= cut), rows.filter(F.col("scraped_at") < cut)).select("snapshot_id", "vendor_product_id", "available", "price_cents")


def _listings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "white2tea").select(F.col("ingest_meta.source").alias("source"), F.col("ingest_meta.external_id").alias("external_id"), F.col("ingest_meta.scraped_at").alias("scraped_at"), F.monotonically_increasing_id().alias("snapshot_id"), F.col("ingest_meta.run_id").alias("run_id"), F.col("ingest_meta.record_index").alias("record_index"), F.col("payload").alias("p"))


def variant_fanout(spark: SparkSession, d: str) -> DataFrame:
    m = silver.map_products(_listings(spark, d))
    return m.select("external_id", "scraped_at", "variant_pos", "vendor_external_id", "price_cents", "available")


def map_counters(spark: SparkSession, d: str) -> DataFrame:
    return silver.map_counters(silver.map_products(_listings(spark, d)))


def mapped_products(spark: SparkSession, d: str) -> DataFrame:
    """Every variant with what it is mapped to, and its gate; hints, years and hashes have queries of
    their own."""
    m = silver.map_products(_listings(spark, d))
    return m.select("source", "external_id", "scraped_at", "variant_pos", "canonical_name", "tea_type", F.col("producer.name").alias("producer"), "weight_grams", "gate")


def price_cents(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "white2tea").select(F.explode("payload.variants").alias("v")).filter("v.id is not null")
    return v.select(F.col("v.id").alias("variant_id"), F.col("v.price").alias("price"), t.cents(F.col("v.price")).alias("cents"))


def name_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "white2tea").select(F.col("payload.title").alias("title")).distinct().select("title", t.name_key(F.col("title")).alias("name_key"))


def person_hashes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", t.person_hash(F.col("c_name")).alias("person"))


def weight_parse(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "white2tea").select(F.explode("payload.variants").alias("v")).filter("v is not null").select(F.col("v.option1").alias("option1")).filter("option1 is not null").distinct()
    return v.select("option1", c.option_grams(F.col("option1")).alias("grams"))


def year_parse(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "white2tea").select("ingest_meta.run_id", "ingest_meta.record_index", F.col("payload.title").alias("title"), F.col("payload.tags").alias("tags"))
    return w.select("run_id", "record_index", c.harvest_year(c.parsed_tags(F.col("tags")), F.col("title")).alias("harvest_year"))


def tag_parse(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "white2tea").select("ingest_meta.external_id", "ingest_meta.run_id", "ingest_meta.record_index", F.posexplode(c.parsed_tags(F.col("payload.tags"))).alias("pos", "tag"))
    return w.select("external_id", "run_id", "record_index", "pos", "tag.key", "tag.value")


def tag_keys(spark: SparkSession, d: str) -> DataFrame:
    """Values per known key, through the map form."""
    w = table(spark, d, "white2tea").select(F.explode(c.tag_map(c.parsed_tags(F.col("payload.tags")))).alias("key", "list"))
    return w.groupBy("key").agg(F.sum(F.size("list")).alias("n"), F.count_distinct(F.get("list", 0)).alias("first_values"))


def producer_hints(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "white2tea").select("ingest_meta.run_id", "ingest_meta.record_index", c.producer_hint(c.parsed_tags(F.col("payload.tags")), F.col("payload.vendor")).alias("h"))
    return w.select("run_id", "record_index", F.col("h.name").alias("name"), F.col("h.origin").alias("origin"))


def product_urls(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "white2tea").select(F.col("ingest_meta.source").alias("source_key"), F.col("payload.handle").alias("handle")).distinct()
    return w.join(table(spark, d, "vendor"), "source_key").select("source_key", "handle", t.product_url(F.col("base_url"), F.col("handle")).alias("url"))


def description_hashes(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "white2tea")
    return w.select("ingest_meta.run_id", "ingest_meta.record_index", t.description_hash(F.col("payload.title"), F.col("payload.body_html"), F.col("payload.tags")).alias("hash"))


def html_shapes(spark: SparkSession, d: str) -> DataFrame:
    """First heading and number of links of listings' pages, where fixed shapes do."""
    b = table(spark, d, "white2tea").select(F.col("payload.id").alias("payload_id"), F.col("payload.body_html").alias("b")).filter("b is not null").distinct()
    return b.select("payload_id", F.regexp_extract("b", r"<h2>([^<]*)</h2>", 1).alias("heading"), F.regexp_count("b", F.lit(r"<a href=")).alias("links"), F.md5("b").alias("page"))


def review_pages(spark: SparkSession, d: str) -> DataFrame:
    """Every customer with its orders, written as a review page and read back by the page operators."""
    note = F.concat(
        F.lit('<div class="note" id="note_'), F.col("o_orderkey"), F.lit('"><meta itemprop="name" content="'), F.col("o_orderpriority"), F.lit('"><span itemprop="ratingValue"> '), F.col("o_orderkey") % 100,
        F.lit('</span><p itemprop="description">Paid &amp; <b>'), F.col("o_orderstatus"), F.lit('</b></p><span class="likes-count">x</span></div>'),
    )
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", note.alias("note"))
    notes = orders.groupBy("c_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "note"))).alias("n"))
    c_ = table(spark, d, "customer").join(notes, "c_custkey", "left")
    link = F.concat(F.lit('<a href="/teas/s/n'), F.col("c_nationkey"), F.lit('">x</a>'))
    page = F.concat(
        F.lit("<html><h1 itemprop='name'>  "), F.col("c_name"), F.lit(' </h1><span id="rating-average">'), F.col("c_custkey") % 101, F.lit('</span><dl class="tea-description"><dt>Segment</dt><dd>'), F.col("c_mktsegment"),
        F.lit('</dd><dt>Segment</dt><dd>again</dd></dl><div class="tea-prep"><div class="prep-details"><span class="temp">'), F.col("c_nationkey"), F.lit(" C</span></div></div>"), link, link, F.lit('<a href="/teas/o/x">y</a>'),
        F.array_join(F.transform(F.coalesce("n", F.array().cast("array<struct<o_orderkey:long,note:string>>")), lambda x: x["note"]), ""), F.when(F.col("c_custkey") % 2 == 0, F.lit('<a href="?page=2">Next</a>')).otherwise(F.lit("<a href='/?page=2'>Nexts</a>")),
    )
    read = c_.select("c_custkey", page.alias("page")).select("c_custkey", pages.read_page(F.col("page")).alias("p"), pages.page_links(F.col("page"), r"/teas/s/\w+").alias("links"))
    last = F.try_element_at("p.notes", F.lit(-1))
    return read.select("c_custkey", "p.name", "p.average_rating", F.col("p.description_pairs")["Segment"].alias("segment"), F.col("p.prep")["temp"].alias("temp"), F.size("p.notes").alias("notes"), last["note_id"].alias("last_note"), last["author"].alias("last_author"), last["rating"].alias("last_rating"), last["body"].alias("last_body"), F.array_join("links", ",").alias("links"), "p.has_next")


def script_audit(spark: SparkSession, d: str) -> DataFrame:
    """Characters by script in every document."""
    n = lambda script: F.regexp_count("text", F.lit(rf"\p{{Is{script}}}")).alias(script.lower())
    return table(spark, d, "documents").select("doc_id", *[n(x) for x in ("Latin", "Cyrillic", "Han", "Hiragana", "Katakana")])


def axis_differences(spark: SparkSession, d: str) -> DataFrame:
    """How a supplier's returned lines differ from its accepted ones, axis by axis, large ones flagged."""
    axes = {"quantity": F.col("l_quantity"), "discount": F.col("l_discount") * 100, "tax": F.col("l_tax") * 100}
    side = lambda flag: F.map_from_entries(F.array(*[F.struct(F.lit(k), F.round(F.avg(F.when(F.col("l_returnflag") == flag, v)), 3)) for k, v in axes.items()]))
    by = table(spark, d, "lineitem").groupBy("l_suppkey").agg(side("R").alias("a"), side("A").alias("b"))
    told = by.select("l_suppkey", F.inline(analytics.axis_deltas(F.col("a"), F.col("b"), 0.5)))
    return told.select("l_suppkey", "axis", F.round("delta", 3).alias("delta"), "flagged")


def trigram_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Similar names within a brand and size, through the trigram index."""
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    near = resolve.trigram_matches(part.select(F.col("p_name").alias("name"), "p_brand", "p_size"), part, "name", "p_partkey", "p_name", 0.5, ["p_brand", "p_size"])
    own = part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("probe"), "p_brand", "p_size")
    return own.join(near, ["name", "p_brand", "p_size"]).filter("probe < p_partkey").select(F.col("probe").alias("a"), F.col("p_partkey").alias("b"), "sim")


def ambiguity_label(spark: SparkSession, d: str) -> DataFrame:
    """Per part the label that its two best candidates of the same brand and size give."""
    top = resolve.best_others(table(spark, d, "part"), "p_partkey", "p_name", ["p_brand", "p_size"], 0.3)
    label = F.when(F.col("second").isNotNull() & (F.col("sim") < resolve.CERTAIN) & (F.col("sim") - F.col("second") < resolve.LEAD), "ambiguous").otherwise("similar")
    return top.select("p_partkey", "other", label.alias("label"))


def null_safe_match(spark: SparkSession, d: str) -> DataFrame:
    """Products equal in maker, year, weight and style, null being a value."""
    p = table(spark, d, "product").select("product_id", "producer_id", "harvest_year", "weight_grams", "tea_style", t.name_key(F.col("canonical_name")).alias("k"))
    a, b = p.alias("a"), p.alias("b")
    same = [F.col(f"a.{x}").eqNullSafe(F.col(f"b.{x}")) for x in ("producer_id", "harvest_year", "weight_grams", "tea_style", "k")]
    return a.join(b, same).filter("a.product_id < b.product_id").select(F.col("a.product_id").alias("a"), F.col("b.product_id").alias("b"))


def get_or_create_dim(spark: SparkSession, d: str) -> DataFrame:
    """Regions of the tags added to a dimension of the known regions."""
    tags = table(spark, d, "white2tea").select(c.first_tag(c.parsed_tags(F.col("payload.tags")), "region").alias("province")).filter("province is not null")
    known = table(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("region_id"), F.lit(None).cast("string").alias("country"), F.col("r_name").alias("province"))
    return silver.get_or_create(tags.select(F.lit("China").alias("country"), "province"), known, ["country", "province"], "region_id")


def upserted_listings(spark: SparkSession, d: str) -> DataFrame:
    vendor = table(spark, d, "vendor")
    v = table(spark, d, "white2tea").select(F.col("ingest_meta.source").alias("source_key"), F.col("ingest_meta.scraped_at").alias("at"), F.col("payload.id").alias("pid"), F.col("payload.handle").alias("handle"), F.explode("payload.variants").alias("v")).filter("v.id is not null")
    incoming = v.join(vendor, "source_key").select("vendor_id", F.concat_ws(":", "pid", "v.id").alias("vendor_external_id"), F.lit(-1).cast("long").alias("product_id"), t.product_url(F.col("base_url"), F.col("handle")).alias("vendor_url"), "at")
    return silver.upsert_listings(table(spark, d, "vendor_product").select("vendor_id", "vendor_external_id", "product_id", "vendor_url"), incoming)


def alias_match(spark: SparkSession, d: str) -> DataFrame:
    """Vendor fields found by name or alias (array membership as an equi join)."""
    vendor = table(spark, d, "white2tea").select(F.col("payload.vendor").alias("name")).filter("name is not null").distinct()
    known = table(spark, d, "producer").select("producer_id", F.explode(F.array_union(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    return vendor.join(known, "name").groupBy("name").agg(F.min("producer_id").alias("producer_id"))


def resolved_producers(spark: SparkSession, d: str) -> DataFrame:
    hints = table(spark, d, "white2tea").select(F.col("payload.vendor").alias("name")).filter("name is not null")
    return resolve.resolve_producers(hints, table(spark, d, "producer")).select("key", "producer_id", "how")


def producer_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Aliases that makers gain by what is found for vendor fields."""
    hints = table(spark, d, "white2tea").select(F.col("payload.vendor").alias("name")).filter("name is not null")
    producer = table(spark, d, "producer")
    return resolve.new_aliases(producer, resolve.resolve_producers(hints, producer))


def ladder_products(spark: SparkSession, d: str) -> DataFrame:
    """The ladder over all products as they were typed, from an empty table."""
    p = table(spark, d, "product").select(F.col("product_id").alias("row_no"), F.col("canonical_name").alias("name"), "producer_id", "harvest_year", "weight_grams")
    return resolve.resolve_products(p, p.limit(0).select(F.col("row_no").alias("product_id"), "name", *resolve.GROUP))


def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest items of every item whose id is divisible by 20, against all."""
    e = table(spark, d, "embeddings")
    ident, vector = e.columns[0], next(f.name for f in e.schema if f.dataType.typeName() == "array")
    return analytics.nearest(e, e.filter(F.col(ident) % 20 == 0), ident, vector, 5).select("query_id", F.col(ident).alias("id"), "rank")


def status_pivot(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0)


def body_of_work(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "product").groupBy("producer_id", "harvest_year").agg(F.count(F.lit(1)).alias("products"), F.count_distinct("tea_type").alias("types"), F.max("weight_grams").alias("heaviest"))


def ngram_freq(spark: SparkSession, d: str) -> DataFrame:
    return analytics.ngram_counts(table(spark, d, "documents"), "text", 2, ["source"])


def keyword_context(spark: SparkSession, d: str) -> DataFrame:
    return analytics.keyword_in_context(table(spark, d, "documents"), "doc_id", "text", "gaiwan")


def hierarchy_rollup(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return base.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("customers"))


def run_statuses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "scrape_run").groupBy("source", "status").agg(F.count(F.lit(1)).alias("runs"), F.sum("errors_count").alias("errors"))


_ALL = (scan_since, json_fields, payload_hashes, bronze_first_wins, bronze_new_only, bronze_consecutive, load_counters, numbered_rows, latest_snapshot, last_available, tier_catalog, tier_changes, tier_counts, touched_products, new_facts, variant_fanout, map_counters, mapped_products, price_cents, name_keys, person_hashes, weight_parse, year_parse, tag_parse, tag_keys, producer_hints, product_urls, description_hashes, html_shapes, review_pages, script_audit, axis_differences, trigram_pairs, ambiguity_label, null_safe_match, get_or_create_dim, upserted_listings, alias_match, resolved_producers, producer_aliases, ladder_products, cosine_topk, status_pivot, body_of_work, ngram_freq, keyword_context, hierarchy_rollup, run_statuses)
QUERIES = {f.__name__: f for f in _ALL}

_ROWS = "SELECT source, external_id, lower(payload_hash) AS payload_hash, snapshot_id, run_id, scraped_at, payload FROM raw_product_snapshot"
_OBSERVED = "SELECT p.product_id, s.scraped_at, s.available, s.vendor_product_id FROM product_snapshot s JOIN vendor_product p USING (vendor_product_id)"
# White space as the Spark side's Unicode class has it.
_WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_KEYS = "|".join(k.replace("&", "&") for k in c.TAG_KEYS)
_TAGS = rf"""
    SELECT external_id, run_id, record_index, title, row_number() OVER (PARTITION BY n ORDER BY i) - 1 AS pos,
           regexp_extract(tag, '^({_KEYS})_((?s).+)$', 1) AS k, trim(regexp_replace(regexp_extract(tag, '^({_KEYS})_((?s).+)$', 2), '{_WS}+', ' ', 'g'), ' ') AS v, tag, n
    FROM (SELECT n, external_id, run_id, record_index, title, i, regexp_replace(raw, '^{_WS}+|{_WS}+$', '', 'g') AS tag
          FROM (SELECT row_number() OVER () AS n, ingest_meta.external_id AS external_id, ingest_meta.run_id AS run_id, ingest_meta.record_index AS record_index, payload.title AS title,
                       unnest(payload.tags) AS raw, generate_subscripts(payload.tags, 1) AS i FROM white2tea))
    WHERE tag IS NOT NULL AND tag <> ''"""
_VARIANTS = "SELECT ingest_meta.source AS source, ingest_meta.external_id AS external_id, ingest_meta.run_id AS run_id, ingest_meta.record_index AS record_index, ingest_meta.scraped_at AS scraped_at, payload, unnest(payload.variants) AS v FROM white2tea"
_TRI = "list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


def _tri(column: str) -> str:
    return _TRI.format(column)


def _tiers(as_of: str, months: int) -> str:
    return f"""
        SELECT p.product_id, CASE WHEN l.available THEN 'A' WHEN r.at >= TIMESTAMP '{as_of}' - INTERVAL {months} MONTH THEN 'B' ELSE 'C' END AS class
        FROM (SELECT DISTINCT product_id FROM product) p
        LEFT JOIN (SELECT * FROM (SELECT product_id, coalesce(available, false) AS available, row_number() OVER (PARTITION BY product_id ORDER BY scraped_at DESC, coalesce(available, false) DESC, vendor_product_id DESC) AS n
                   FROM ({_OBSERVED}) WHERE scraped_at <= TIMESTAMP '{as_of}') WHERE n = 1) l USING (product_id)
        LEFT JOIN (SELECT product_id, max(scraped_at) AS at FROM ({_OBSERVED}) WHERE available AND scraped_at <= TIMESTAMP '{as_of}' GROUP BY 1) r USING (product_id)"""


_CENTS = "TRY_CAST(round_even(TRY_CAST({0} AS DOUBLE) * 100, 0) AS INTEGER)"
_HTTP = "CASE WHEN trim({h}) <> '' THEN rtrim({b}, '/') || '/products/' || {h} END"

_BARE = f"'^{_WS}+|{_WS}+$'"
_MASS = r"(?:g|grams?|kg|kilograms?)"


def _stated(text: str, pattern: str, number: int, unit: int, count: int | None = None) -> str:
    part = lambda k: f"regexp_extract({text}, '(?i){pattern}', {k})"
    n = f"TRY_CAST({part(number)} AS DOUBLE)" + (f" * TRY_CAST({part(count)} AS DOUBLE)" if count else "")
    return f"round_even({n} * CASE WHEN lower({part(unit)}) LIKE 'k%' THEN 1000 ELSE 1 END, 0)"


def _option(text: str) -> str:
    one = rf"(\d+(?:\.\d+)?){_WS}*({_MASS})"
    return f"coalesce({_stated(text, rf'\({one}\)', 1, 2)}, {_stated(text, rf'(\d+){_WS}*x{_WS}*{one}\b', 2, 3, 1)}, {_stated(text, one + r'\b', 1, 2)})"


_TITLED = rf"TRY_CAST(regexp_extract(title, '(?i)(\d{{2,4}}){_WS}*(?:g|grams?)\b', 1) AS INTEGER)"
_MAPPED = f"""
    SELECT *, CASE WHEN skip THEN 'skipped' WHEN canonical_name IS NULL OR canonical_name = '' OR weight_grams IS NULL THEN 'unmappable' ELSE 'ok' END AS gate
    FROM (SELECT n, source, external_id, scraped_at, CAST(coalesce(row_number() OVER (PARTITION BY n ORDER BY i) - 1, 0) AS INTEGER) AS variant_pos, regexp_replace(nfc_normalize(title), {_BARE}, '', 'g') AS canonical_name,
                 nullif(regexp_replace(regexp_replace(nfc_normalize(kind), '{_WS}+', ' ', 'g'), '^ | $', '', 'g'), '') AS tea_type, coalesce(tagged, nullif(regexp_replace(regexp_replace(maker, '{_WS}+', ' ', 'g'), '^ | $', '', 'g'), '')) AS producer,
                 CASE WHEN v IS NOT NULL THEN CAST(coalesce({_option('v.option1')}, {_option('v.title')}, {_TITLED}) AS INTEGER) END AS weight_grams,
                 coalesce(lower(regexp_replace(kind, {_BARE}, '', 'g')) = 'non-tea', false) OR coalesce(len(list_filter(tags, lambda x: lower(regexp_replace(x, {_BARE}, '', 'g')) = 'non-tea')), 0) > 0 AS skip
          FROM (SELECT n, source, external_id, scraped_at, title, kind, maker, tags, unnest(vs) AS v, generate_subscripts(vs, 1) AS i,
                       nullif(regexp_replace(regexp_extract(list_filter(list_transform(tags, lambda x: regexp_replace(x, {_BARE}, '', 'g')), lambda x: regexp_matches(x, '^Producer_(?s:.*[^\\s])'))[1], '^Producer_((?s).+)$', 1), '{_WS}+', ' ', 'g'), '') AS tagged
                FROM (SELECT row_number() OVER () AS n, ingest_meta.source AS source, ingest_meta.external_id AS external_id, ingest_meta.scraped_at AS scraped_at, payload.title AS title, payload.product_type AS kind, payload.vendor AS maker, payload.tags AS tags,
                             CASE WHEN coalesce(len(list_filter(payload.variants, lambda x: x IS NOT NULL)), 0) = 0 THEN [NULL] ELSE list_filter(payload.variants, lambda x: x IS NOT NULL) END AS vs FROM white2tea)))"""
_RESOLVED = f"""
    WITH RECURSIVE probe AS (SELECT DISTINCT regexp_replace(regexp_replace(lower(nfc_normalize(payload.vendor)), '{_WS}+', ' ', 'g'), '^ | $', '', 'g') AS key FROM white2tea WHERE payload.vendor IS NOT NULL),
    al AS (SELECT key, min(producer_id) AS id FROM (SELECT producer_id, unnest(aliases) AS key FROM producer) WHERE key IS NOT NULL GROUP BY 1),
    nm AS (SELECT lower(canonical_name) AS key, min(producer_id) AS id FROM producer GROUP BY 1),
    rest AS MATERIALIZED (SELECT key, {_tri('key')} AS g FROM probe WHERE key <> '' AND key NOT IN (SELECT key FROM al) AND key NOT IN (SELECT key FROM nm)),
    pg AS MATERIALIZED (SELECT producer_id, {_tri('canonical_name')} AS g FROM producer),
    cl AS MATERIALIZED (SELECT key, arg_min(producer_id, (-sim, producer_id)) AS id, max(sim) AS sim FROM (
        SELECT key, producer_id, len(list_intersect(rest.g, pg.g)) / (len(rest.g) + len(pg.g) - len(list_intersect(rest.g, pg.g))) AS sim FROM rest, pg) WHERE sim >= 0.85 GROUP BY 1),
    peers AS MATERIALIZED (SELECT key, other, sim FROM (SELECT a.key, b.key AS other, len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) AS sim FROM rest a JOIN rest b ON a.key > b.key AND b.key NOT IN (SELECT key FROM cl)) WHERE sim >= 0.85),
    numbered AS MATERIALIZED (SELECT key, row_number() OVER (ORDER BY key) AS i, (SELECT list(other) FROM peers p WHERE p.key = rest.key) AS earlier FROM rest WHERE key NOT IN (SELECT key FROM cl)),
    walk AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS leaders
             UNION ALL SELECT n.i, CASE WHEN n.earlier IS NOT NULL AND list_has_any(leaders, n.earlier) THEN leaders ELSE list_append(leaders, n.key) END FROM walk JOIN numbered n ON n.i = walk.i + 1),
    led AS (SELECT unnest(leaders) AS key FROM walk WHERE i = (SELECT max(i) FROM walk)),
    lk AS (SELECT peers.key, max(sim) AS sim FROM peers WHERE other IN (SELECT key FROM led) GROUP BY 1),
    resolved AS (
        SELECT probe.key, CASE WHEN newer THEN NULL ELSE coalesce(al_id, nm_id, cl_id) END AS producer_id,
               CASE WHEN al_id IS NOT NULL THEN 'alias' WHEN nm_id IS NOT NULL THEN 'name' WHEN cl_id IS NOT NULL OR newer THEN 'trigram' ELSE 'create' END AS how
        FROM (SELECT probe.key, al.id AS al_id, nm.id AS nm_id, cl.id AS cl_id, al.id IS NULL AND nm.id IS NULL AND lk.sim IS NOT NULL AND (cl.sim IS NULL OR lk.sim > cl.sim) AS newer
              FROM probe LEFT JOIN al USING (key) LEFT JOIN nm USING (key) LEFT JOIN cl USING (key) LEFT JOIN lk USING (key) WHERE probe.key <> '') probe)"""

ORACLE = {
    "scan_since": f"SELECT snapshot_id, source, external_id FROM raw_product_snapshot WHERE scraped_at >= TIMESTAMP '{SINCE}'",
    "json_fields": "SELECT snapshot_id, CAST(payload->>'$.id' AS BIGINT) AS payload_id, payload->>'$.title' AS title, payload->>'$.variants[0].price' AS first_price FROM raw_product_snapshot",
    "payload_hashes": "SELECT snapshot_id, true AS matches FROM raw_product_snapshot",
    "bronze_first_wins": f"SELECT source, external_id, payload_hash, snapshot_id, run_id FROM (SELECT *, row_number() OVER (PARTITION BY source, external_id, payload_hash ORDER BY snapshot_id) AS n FROM ({_ROWS})) WHERE n = 1",
    "bronze_new_only": f"""
        SELECT source, external_id, payload_hash, min(snapshot_id) AS snapshot_id FROM ({_ROWS}) a WHERE scraped_at >= TIMESTAMP '{SINCE}'
        AND NOT EXISTS (SELECT 1 FROM ({_ROWS}) b WHERE b.scraped_at < TIMESTAMP '{SINCE}' AND a.source = b.source AND a.external_id = b.external_id AND a.payload_hash = b.payload_hash) GROUP BY 1, 2, 3""",
    "bronze_consecutive": f"SELECT snapshot_id FROM (SELECT snapshot_id, payload_hash, lag(payload_hash) OVER (PARTITION BY source, external_id ORDER BY scraped_at, snapshot_id) AS b FROM ({_ROWS})) WHERE b IS DISTINCT FROM payload_hash",
    "load_counters": f"""
        SELECT source, count(*) AS lines, count(*) AS records, 0 AS errors, count(DISTINCT (external_id, payload_hash)) AS inserted, count(*) - count(DISTINCT (external_id, payload_hash)) AS skipped FROM ({_ROWS}) GROUP BY 1""",
    "numbered_rows": "SELECT vendor_external_id, row_number() OVER (ORDER BY vendor_external_id) AS row_no FROM vendor_product",
    "latest_snapshot": "SELECT vendor_product_id, snapshot_id, available, price_cents FROM (SELECT *, row_number() OVER (PARTITION BY vendor_product_id ORDER BY scraped_at DESC, snapshot_id DESC) AS n FROM product_snapshot) WHERE n = 1",
    "last_available": f"SELECT product_id, max(scraped_at) FILTER (available) AS last_available_at, count(*) FILTER (available) AS times_available FROM ({_OBSERVED}) GROUP BY 1",
    "tier_catalog": _tiers(AS_OF, 24),
    "tier_changes": f"SELECT a.product_id, a.class AS before, b.class AS after FROM ({_tiers(EARLIER, 1)}) a JOIN ({_tiers(AS_OF, 1)}) b USING (product_id) WHERE a.class IS DISTINCT FROM b.class",
    "tier_counts": f"SELECT class, count(*) AS n FROM ({_tiers(AS_OF, 24)}) GROUP BY 1",
    "touched_products": f"SELECT product_id, producer_id FROM product WHERE product_id IN (SELECT product_id FROM ({_OBSERVED}) WHERE scraped_at >= TIMESTAMP '{SINCE}')",
    "new_facts": f"""
        SELECT snapshot_id, vendor_product_id, available, price_cents FROM (SELECT *, row_number() OVER (PARTITION BY vendor_product_id, scraped_at ORDER BY snapshot_id) AS n FROM product_snapshot WHERE scraped_at >= TIMESTAMP '{SINCE}') WHERE n = 1""",
    "variant_fanout": f"""
        SELECT external_id, scraped_at, CAST(row_number() OVER (PARTITION BY n ORDER BY i) - 1 AS INTEGER) AS variant_pos, pid || ':' || coalesce(CAST(v.id AS VARCHAR), '') AS vendor_external_id, {_CENTS.format('v.price')} AS price_cents, coalesce(v.available, false) AS available
        FROM (SELECT row_number() OVER () AS n, ingest_meta.external_id AS external_id, ingest_meta.scraped_at AS scraped_at, CAST(payload.id AS VARCHAR) AS pid, unnest(payload.variants) AS v, generate_subscripts(payload.variants, 1) AS i FROM white2tea) WHERE v IS NOT NULL
        UNION ALL
        SELECT ingest_meta.external_id, ingest_meta.scraped_at, 0, CAST(payload.id AS VARCHAR) || ':', NULL, false FROM white2tea WHERE coalesce(len(list_filter(payload.variants, lambda x: x IS NOT NULL)), 0) = 0""",
    "map_counters": f"""
        SELECT source, count(*) FILTER (first) AS rows, count(*) AS variants, count(*) FILTER (gate = 'skipped') AS skipped, count(*) FILTER (gate = 'unmappable') AS unmappable, count(*) FILTER (gate = 'ok') AS mapped
        FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY variant_pos) = 1 AS first FROM ({_MAPPED})) GROUP BY 1""",
    "price_cents": f"SELECT v.id AS variant_id, v.price AS price, {_CENTS.format('v.price')} AS cents FROM ({_VARIANTS}) WHERE v.id IS NOT NULL",
    "name_keys": f"SELECT title, regexp_replace(regexp_replace(lower(nfc_normalize(title)), '{_WS}+', ' ', 'g'), '^ | $', '', 'g') AS name_key FROM (SELECT DISTINCT payload.title AS title FROM white2tea)",
    "person_hashes": "SELECT c_custkey, 'sha256:' || sha256(lower(trim(c_name))) AS person FROM customer",
    "weight_parse": r"""
        SELECT option1, coalesce(
            CASE WHEN regexp_matches(option1, '(?i)\(\d+(\.\d+)?\s*(g|grams?|kg|kilograms?)\)') THEN round_even(CAST(regexp_extract(option1, '(?i)\((\d+(?:\.\d+)?)\s*(?:g|grams?|kg|kilograms?)\)', 1) AS DOUBLE) * CASE WHEN lower(regexp_extract(option1, '(?i)\(\d+(?:\.\d+)?\s*(g|grams?|kg|kilograms?)\)', 1)) LIKE 'k%' THEN 1000 ELSE 1 END, 0) END,
            CASE WHEN regexp_matches(option1, '(?i)\d+\s*x\s*\d+(\.\d+)?\s*(g|grams?|kg|kilograms?)\b') THEN round_even(CAST(regexp_extract(option1, '(?i)(\d+)\s*x\s*\d+(?:\.\d+)?\s*(?:g|grams?|kg|kilograms?)\b', 1) AS DOUBLE) * CAST(regexp_extract(option1, '(?i)\d+\s*x\s*(\d+(?:\.\d+)?)\s*(?:g|grams?|kg|kilograms?)\b', 1) AS DOUBLE) * CASE WHEN lower(regexp_extract(option1, '(?i)\d+\s*x\s*\d+(?:\.\d+)?\s*(g|grams?|kg|kilograms?)\b', 1)) LIKE 'k%' THEN 1000 ELSE 1 END, 0) END,
            CASE WHEN regexp_matches(option1, '(?i)\d+(\.\d+)?\s*(g|grams?|kg|kilograms?)\b') THEN round_even(CAST(regexp_extract(option1, '(?i)(\d+(?:\.\d+)?)\s*(?:g|grams?|kg|kilograms?)\b', 1) AS DOUBLE) * CASE WHEN lower(regexp_extract(option1, '(?i)\d+(?:\.\d+)?\s*(g|grams?|kg|kilograms?)\b', 1)) LIKE 'k%' THEN 1000 ELSE 1 END, 0) END)::INTEGER AS grams
        FROM (SELECT DISTINCT v.option1 AS option1 FROM (SELECT unnest(payload.variants) AS v FROM white2tea) WHERE v IS NOT NULL AND v.option1 IS NOT NULL)""",
    "year_parse": rf"""
        WITH tags AS ({_TAGS}), firsts AS (
            SELECT run_id, record_index, external_id, TRY_CAST(regexp_extract(arg_min(v, pos) FILTER (k = 'Harvest & Season' AND v <> ''), '((?:19|20)\d\d)', 1) AS INTEGER) AS a,
                   TRY_CAST(regexp_extract(arg_min(v, pos) FILTER (k = 'Pu-erh Harvest Season' AND v <> ''), '((?:19|20)\d\d)', 1) AS INTEGER) AS b, n FROM tags GROUP BY run_id, record_index, external_id, n),
        one AS (SELECT DISTINCT run_id, record_index, external_id, a, b FROM firsts)
        SELECT w.ingest_meta.run_id AS run_id, w.ingest_meta.record_index AS record_index, coalesce(a, b, TRY_CAST(regexp_extract(payload.title, '^((?:19|20)\d\d)\b', 1) AS INTEGER)) AS harvest_year
        FROM white2tea w LEFT JOIN one f ON f.run_id = w.ingest_meta.run_id AND f.record_index = w.ingest_meta.record_index AND f.external_id = w.ingest_meta.external_id""",
    "tag_parse": f"SELECT external_id, run_id, record_index, CAST(pos AS INTEGER) AS pos, CASE WHEN v <> '' THEN lower(k) END AS key, CASE WHEN v <> '' THEN v ELSE tag END AS value FROM ({_TAGS})",
    "tag_keys": f"SELECT lower(k) AS key, count(*) AS n, count(DISTINCT v) FILTER (first) AS first_values FROM (SELECT k, v, row_number() OVER (PARTITION BY n, k ORDER BY pos) = 1 AS first FROM ({_TAGS}) WHERE v <> '') GROUP BY 1",
    "producer_hints": rf"""
        SELECT ingest_meta.run_id AS run_id, ingest_meta.record_index AS record_index, name, CASE WHEN name IS NOT NULL THEN 'vendor' END AS origin
        FROM (SELECT ingest_meta, nullif(regexp_replace(regexp_replace(payload.vendor, '{_WS}+', ' ', 'g'), '^ | $', '', 'g'), '') AS name FROM white2tea)""",
    "product_urls": f"SELECT source_key, handle, {_HTTP.format(h='handle', b='base_url')} AS url FROM (SELECT DISTINCT ingest_meta.source AS source_key, payload.handle AS handle FROM white2tea) JOIN vendor USING (source_key)",
    "html_shapes": "SELECT payload_id, regexp_extract(b, '<h2>([^<]*)</h2>', 1) AS heading, CAST(len(regexp_extract_all(b, '<a href=')) AS INTEGER) AS links, md5(b) AS page FROM (SELECT DISTINCT payload.id AS payload_id, payload.body_html AS b FROM white2tea WHERE payload.body_html IS NOT NULL)",
    "trigram_pairs": f"""
        WITH t AS (SELECT p_partkey, p_brand, p_size, {_tri('p_name')} AS g FROM part),
        s AS (SELECT a.p_partkey AS a, b.p_partkey AS b, len(list_intersect(a.g, b.g)) AS n, len(a.g) AS x, len(b.g) AS y FROM t a JOIN t b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)
        SELECT a, b, n / (x + y - n) AS sim FROM s WHERE n / (x + y - n) >= 0.5""",
    "ambiguity_label": f"""
        WITH t AS (SELECT p_partkey, p_brand, p_size, {_tri('p_name')} AS g FROM part),
        s AS (SELECT a.p_partkey, b.p_partkey AS other, len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) AS sim FROM t a JOIN t b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey <> b.p_partkey),
        r AS (SELECT *, row_number() OVER w AS n, lead(sim) OVER w AS second FROM s WHERE sim >= 0.3 WINDOW w AS (PARTITION BY p_partkey ORDER BY sim DESC, other))
        SELECT p_partkey, other, CASE WHEN second IS NOT NULL AND sim < 0.95 AND sim - second < 0.10 THEN 'ambiguous' ELSE 'similar' END AS label FROM r WHERE n = 1""",
    "null_safe_match": f"""
        WITH p AS (SELECT product_id, producer_id, harvest_year, weight_grams, tea_style, regexp_replace(regexp_replace(lower(nfc_normalize(canonical_name)), '{_WS}+', ' ', 'g'), '^ | $', '', 'g') AS k FROM product)
        SELECT a.product_id AS a, b.product_id AS b FROM p a JOIN p b ON a.producer_id IS NOT DISTINCT FROM b.producer_id AND a.harvest_year IS NOT DISTINCT FROM b.harvest_year
        AND a.weight_grams IS NOT DISTINCT FROM b.weight_grams AND a.tea_style IS NOT DISTINCT FROM b.tea_style AND a.k IS NOT DISTINCT FROM b.k AND a.product_id < b.product_id""",
    "get_or_create_dim": f"""
        WITH fresh AS (SELECT DISTINCT arg_min(v, pos) AS province FROM ({_TAGS}) WHERE k = 'Region' AND v <> '' GROUP BY n)
        SELECT CAST(r_regionkey AS BIGINT) AS region_id, CAST(NULL AS VARCHAR) AS country, r_name AS province FROM region
        UNION ALL SELECT (SELECT max(r_regionkey) FROM region) + row_number() OVER (ORDER BY province), 'China', province FROM fresh""",
    "upserted_listings": f"""
        WITH i AS (SELECT vendor_id, CAST(payload.id AS VARCHAR) || ':' || CAST(v.id AS VARCHAR) AS vendor_external_id, {_HTTP.format(h='payload.handle', b='base_url')} AS url, scraped_at
                   FROM ({_VARIANTS}) x JOIN vendor ON source = source_key WHERE v.id IS NOT NULL),
        one AS (SELECT vendor_id, vendor_external_id, arg_max(url, scraped_at) FILTER (url IS NOT NULL) AS u FROM i GROUP BY 1, 2)
        SELECT vendor_id, vendor_external_id, coalesce(product_id, -1) AS product_id, coalesce(u, vendor_url) AS vendor_url FROM vendor_product FULL JOIN one USING (vendor_id, vendor_external_id)""",
    "alias_match": """
        SELECT name, min(producer_id) AS producer_id FROM (SELECT DISTINCT payload.vendor AS name FROM white2tea WHERE payload.vendor IS NOT NULL)
        JOIN (SELECT producer_id, canonical_name AS name FROM producer UNION SELECT producer_id, unnest(aliases) FROM producer) USING (name) GROUP BY 1""",
    "resolved_producers": f"{_RESOLVED} SELECT key, producer_id, how FROM resolved",
    "producer_aliases": f"""{_RESOLVED}
        SELECT DISTINCT r.producer_id, r.key AS alias FROM resolved r JOIN producer p ON p.producer_id = r.producer_id
        WHERE how IN ('name', 'trigram') AND NOT coalesce(list_contains(p.aliases, r.key), false)""",
    "mapped_products": f"SELECT source, external_id, scraped_at, variant_pos, canonical_name, tea_type, producer, weight_grams, gate FROM ({_MAPPED})",
    "review_pages": """
        WITH n AS (SELECT o_custkey, count(*) AS notes, max(o_orderkey) AS last_note, arg_max(o_orderpriority, o_orderkey) AS last_author, arg_max(o_orderstatus, o_orderkey) AS st FROM orders GROUP BY 1)
        SELECT c_custkey, c_name AS name, CAST(c_custkey % 101 AS INTEGER) AS average_rating, c_mktsegment AS segment, c_nationkey || ' C' AS temp, CAST(coalesce(notes, 0) AS INTEGER) AS notes, last_note, last_author,
               CAST(last_note % 100 AS INTEGER) AS last_rating, 'Paid & ' || st AS last_body, '/teas/s/n' || c_nationkey AS links, c_custkey % 2 = 0 AS has_next FROM customer LEFT JOIN n ON o_custkey = c_custkey""",
    "script_audit": "SELECT doc_id, " + ", ".join(f"CAST(len(regexp_extract_all(text, '\\p{{{x}}}')) AS INTEGER) AS {x.lower()}" for x in ("Latin", "Cyrillic", "Han", "Hiragana", "Katakana")) + " FROM documents",
    "axis_differences": """
        WITH m AS (SELECT l_suppkey, l_returnflag AS f, round(avg(l_quantity), 3) AS quantity, round(avg(l_discount * 100), 3) AS discount, round(avg(l_tax * 100), 3) AS tax FROM lineitem GROUP BY 1, 2),
        x AS (UNPIVOT m ON quantity, discount, tax INTO NAME axis VALUE v),
        s AS (SELECT l_suppkey, axis, max(v) FILTER (f = 'R') AS a, max(v) FILTER (f = 'A') AS b FROM x GROUP BY 1, 2)
        SELECT l_suppkey, axis, round(a - b, 3) AS delta, abs(a - b) > 0.5 AS flagged FROM s""",
    "keyword_context": r"""
        WITH d AS (SELECT doc_id, lower(text) AS t, string_split(lower(text), 'gaiwan') AS p FROM documents WHERE text IS NOT NULL),
        o AS (SELECT doc_id, t, CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) AS BIGINT) + 6 * (i - 1) + 1 AS s FROM (SELECT doc_id, t, p, unnest(range(1, len(p))) AS i FROM d)),
        v AS (SELECT * FROM o WHERE NOT (s > 1 AND regexp_matches(substr(t, s - 1, 1), '[\p{L}\p{M}\p{N}_]')) AND NOT regexp_matches(substr(t, s + 6, 1), '[\p{L}\p{M}\p{N}_]')),
        r AS (SELECT *, row_number() OVER w - 1 AS n, coalesce(lag(s) OVER w + 6, 1) AS a, coalesce(lead(s) OVER w, length(t) + 1) AS z FROM v WINDOW w AS (PARTITION BY doc_id ORDER BY s))
        SELECT doc_id, CAST(n AS INTEGER) AS position, right(substr(t, a, s - a), 30) AS "left", left(substr(t, s + 6, z - s - 6), 30) AS "right" FROM r""".replace("\\\\p", "\\p"),
    "ladder_products": f"""
        WITH RECURSIVE r AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY product_id) AS i, product_id AS row_no, regexp_replace(regexp_replace(lower(nfc_normalize(canonical_name)), '{_WS}+', ' ', 'g'), '^ | $', '', 'g') AS key, lower(canonical_name) AS low, {_tri('canonical_name')} AS t,
                   concat_ws('/', coalesce(CAST(producer_id AS VARCHAR), '-'), coalesce(CAST(harvest_year AS VARCHAR), '-'), coalesce(CAST(weight_grams AS VARCHAR), '-')) AS g FROM product),
        walk AS (
            SELECT CAST(0 AS BIGINT) AS i, CAST([] AS STRUCT(g VARCHAR, id BIGINT, low VARCHAR, t VARCHAR[])[]) AS known, CAST(NULL AS BIGINT) AS row_no, CAST(NULL AS BIGINT) AS product_id, CAST(NULL AS VARCHAR) AS decision
            UNION ALL
            SELECT i, CASE WHEN decision LIKE '%created' THEN list_append(known, {{'g': g, 'id': product_id, 'low': low, 't': t}}) ELSE known END, row_no, product_id, decision
            FROM (SELECT *, CASE WHEN len(e) > 0 THEN list_min(e) WHEN sure THEN c[1].id ELSE -row_no END AS product_id, CASE WHEN len(e) > 0 THEN 'exact' WHEN sure THEN 'trigram' WHEN len(c) > 0 THEN 'ambiguous_created' ELSE 'created' END AS decision
                  FROM (SELECT *, len(c) > 0 AND (len(c) < 2 OR -c[1].n >= 0.95 OR c[2].n - c[1].n >= 0.10) AS sure
                        FROM (SELECT i, known, row_no, g, low, t, list_transform(list_filter(near, lambda k: k.low = key), lambda k: k.id) AS e,
                                     list_sort(list_filter(list_transform(near, lambda k: {{'n': -len(list_intersect(t, k.t)) / (len(t) + len(k.t) - len(list_intersect(t, k.t))), 'a': -k.id, 'id': k.id}}), lambda k: k.n <= -0.85)) AS c
                              FROM (SELECT r.*, walk.known, list_filter(walk.known, lambda k: k.g = r.g) AS near FROM walk JOIN r ON r.i = walk.i + 1)))))
        SELECT row_no, product_id, decision FROM walk WHERE i > 0""",
    "cosine_topk": """
        WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
        SELECT query_id, id, CAST(n AS INTEGER) AS rank FROM (
            SELECT q.vec_id AS query_id, e.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.v, e.v) DESC, e.vec_id) AS n FROM e q JOIN e ON q.vec_id % 20 = 0 AND q.vec_id <> e.vec_id) WHERE n <= 5""",
    "description_hashes": """
        SELECT ingest_meta.run_id AS run_id, ingest_meta.record_index AS record_index,
               sha256(CAST(to_json({'body_html': nfc_normalize(payload.body_html), 'tags': list_sort(list_transform(list_filter(coalesce(payload.tags, CAST([] AS VARCHAR[])), lambda x: x IS NOT NULL), lambda x: nfc_normalize(x))), 'title': nfc_normalize(payload.title)}) AS VARCHAR)) AS hash FROM white2tea""",
    "status_pivot": "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1",
    "body_of_work": "SELECT producer_id, harvest_year, count(*) AS products, count(DISTINCT tea_type) AS types, max(weight_grams) AS heaviest FROM product GROUP BY 1, 2",
    "ngram_freq": r"""
        WITH w AS (SELECT source, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS t FROM documents WHERE text IS NOT NULL)
        SELECT source, g AS ngram, count(*) AS n FROM (SELECT source, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS g FROM w) GROUP BY 1, 2""",
    "hierarchy_rollup": "SELECT r_name, n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)",
    "run_statuses": "SELECT source, status, count(*) AS runs, CAST(sum(errors_count) AS BIGINT) AS errors FROM scrape_run GROUP BY 1, 2",
}
