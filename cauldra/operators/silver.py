"""From deduplicated raw rows to typed product rows, dimensions and facts.

Every step takes and returns DataFrames. Inserts ignore what is there (an anti join), dimensions are
fetched or created by null-safe keys, and tables are versions in directories with a pointer, since
plain Parquet has no merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import catalog as c
from ..functions import text as t
from .bronze import new_only

PAYLOAD = "struct<id:long,title:string,handle:string,body_html:string,vendor:string,product_type:string,tags:array<string>,variants:array<struct<id:long,title:string,option1:string,price:string,available:variant>>>"


def read_payload(bronze: DataFrame, schema: str = PAYLOAD) -> DataFrame:
    """Bronze rows with the payload text parsed by a declared schema; fields of another type are null."""
    return bronze.withColumn("p", F.from_json("payload", schema, {"mode": "PERMISSIVE"}))


def _available(rows: DataFrame) -> Column:
    """Availability as it was read: a boolean, or a value of any type by what counts as true."""
    kind = rows.schema["p"].dataType["variants"].dataType.elementType["available"].dataType.typeName()
    return t.truthy(F.col("v.available")) if kind == "variant" else F.coalesce("v.available", F.lit(False))


def map_products(rows: DataFrame, skip_kind: str = "non-tea") -> DataFrame:
    """One row per variant, or one row without variant for listings that have none.

    ``rows`` has the record under ``p`` and (source, external_id, scraped_at, snapshot_id). Columns of
    the result: the row's own, listing fields and variant fields; ``gate`` tells what a later step
    does with the row: ``skipped`` (of the kind to skip), ``unmappable`` (no name, or no weight), else
    ``ok``.
    """
    parsed = c.parsed_tags(F.col("p.tags"))
    base = rows.withColumn("_tags", parsed)
    name = F.regexp_replace(t.nfc(F.col("p.title")), r"(?U)^\s+|\s+$", "")
    listing = base.select(
        "source",
        "external_id",
        "scraped_at",
        "snapshot_id",
        name.alias("canonical_name"),
        t.name_key(F.col("p.title")).alias("normalized_name"),
        c.producer_hint(F.col("_tags"), F.col("p.vendor")).alias("producer"),
        F.when(c.first_tag(F.col("_tags"), "region").isNotNull(), F.named_struct(F.lit("country"), F.lit("China"), F.lit("province"), c.first_tag(F.col("_tags"), "region"))).alias("region"),
        c.harvest_year(F.col("_tags"), F.col("p.title")).alias("harvest_year"),
        t.blank_to_null(t.collapse(t.nfc(F.col("p.product_type")))).alias("tea_type"),
        t.description_hash(F.col("p.title"), F.col("p.body_html"), F.col("p.tags")).alias("description_hash"),
        c.is_kind(F.col("p.product_type"), F.col("p.tags"), skip_kind).alias("_skip"),
        F.col("p.handle").alias("handle"),
        F.col("p.id").cast("string").alias("_pid"),
        F.col("p.title").alias("_title"),
        F.posexplode_outer(F.filter("p.variants", lambda v: v.isNotNull())).alias("variant_pos", "v"),
    )
    weight = F.when(F.col("v").isNotNull(), c.net_grams(F.col("v.option1"), F.col("v.title"), F.col("_title")))
    gate = F.when(F.col("_skip"), "skipped").when((F.coalesce("canonical_name", F.lit("")) == "") | weight.isNull(), "unmappable").otherwise("ok")
    return listing.select(
        "source",
        "external_id",
        "scraped_at",
        "snapshot_id",
        "canonical_name",
        "normalized_name",
        "producer",
        "region",
        "harvest_year",
        "tea_type",
        "description_hash",
        "handle",
        F.coalesce("variant_pos", F.lit(0)).alias("variant_pos"),
        F.concat_ws(":", F.coalesce("_pid", "external_id"), F.coalesce(F.col("v.id").cast("string"), F.lit(""))).alias("vendor_external_id"),
        weight.alias("weight_grams"),
        _available(rows).alias("available"),
        t.cents(F.col("v.price")).alias("price_cents"),
        gate.alias("gate"),
    )


def map_counters(mapped: DataFrame) -> DataFrame:
    """(source, rows, variants, skipped, unmappable, mapped) per source."""
    return mapped.groupBy("source").agg(F.count_distinct("snapshot_id").alias("rows"), F.count(F.lit(1)).alias("variants"), F.count_if(F.col("gate") == "skipped").alias("skipped"), F.count_if(F.col("gate") == "unmappable").alias("unmappable"), F.count_if(F.col("gate") == "ok").alias("mapped"))


def get_or_create(incoming: DataFrame, dimension: DataFrame, key: list[str], ident: str) -> DataFrame:
    """The dimension with incoming keys that it lacks, numbered on from its largest id in key order.

    Distinct keys only; null is a value of a key. Columns of the dimension beyond key and id are null
    in new rows. Dimensions are small next to facts; ids come from one ordered pass over the new keys.
    """
    from .bronze import with_ids

    fresh = new_only(incoming.select(*key).distinct(), dimension, key)
    start = dimension.agg(F.coalesce(F.max(ident), F.lit(0)).alias("m")).first()["m"]
    numbered = with_ids(fresh, ident, key, start)
    return dimension.unionByName(numbered.withColumn(ident, F.col(ident).cast(dimension.schema[ident].dataType)), allowMissingColumns=True)


def upsert_listings(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Listings (vendor_id, vendor_external_id, product_id, vendor_url) after a load: new pairs are
    added; a known pair keeps its product and takes a new URL that is not null. Among several incoming
    rows of a pair the last by ``at`` gives the URL, the first the product."""
    pair = ["vendor_id", "vendor_external_id"]
    one = incoming.groupBy(*pair).agg(F.min_by("product_id", "at").alias("_p"), F.max_by("vendor_url", F.when(F.col("vendor_url").isNotNull(), F.col("at"))).alias("_u"))
    out = current.join(one, pair, "full_outer")
    return out.select(*pair, F.coalesce("product_id", "_p").alias("product_id"), F.coalesce("_u", "vendor_url").alias("vendor_url"))


def new_snapshots(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Facts whose (vendor_product_id, scraped_at) is not there yet, one per pair (first by
    snapshot_id)."""
    from .bronze import first_wins

    return new_only(first_wins(incoming, ["vendor_product_id", "scraped_at"], [F.col("snapshot_id")]), existing, ["vendor_product_id", "scraped_at"])


def distinct_from(old: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """(key, before, after) of rows whose value differs, null being a value."""
    both = old.select(key, F.col(column).alias("before")).join(new.select(key, F.col(column).alias("after")), key)
    return both.filter(~F.col("before").eqNullSafe(F.col("after")))
