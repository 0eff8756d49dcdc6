"""Queries of the text and entity-matching operators, with oracle SQL where SQL can tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed, table
from . import bpe, canonical, language, listings, markup, mixing, names


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    bodies = table(spark, d, "white2tea").select(F.col("payload.id").alias("payload_id"), F.col("payload.body_html").alias("body")).filter("body is not null").distinct()
    return markup.label_documents(bodies, "payload_id", "body").select("payload_id", F.inline("found")).distinct()


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    """Clean text of every listing's latest description."""
    latest = canonical.latest_listings(table(spark, d, "white2tea"), "body_html")
    return markup.label_documents(latest, "payload_id", "body_html").select("payload_id", "clean")


def _makers(spark: SparkSession, d: str) -> DataFrame:
    return names.linked_makers(*(table(spark, d, t) for t in ("producer", "white2tea", "vendor")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return names.name_pairs(checkpointed(_makers(spark, d)))


def p3_entities(spark: SparkSession, d: str) -> DataFrame:
    """One row per spelling with its maker and the number of spellings of that maker."""
    linked = checkpointed(_makers(spark, d))
    return linked.join(linked.groupBy("entity").agg(F.count(F.lit(1)).alias("spellings")), "entity").select("name", "entity", "spellings")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.listing_types(table(spark, d, "white2tea"), table(spark, d, "tea_type_ref"))


def p4_misses(spark: SparkSession, d: str) -> DataFrame:
    """The report of values that no entry of the list is meant by, with the listings that hold them."""
    listings = canonical.latest_listings(table(spark, d, "white2tea"), "product_type")
    told = canonical.map_values(listings, "product_type", table(spark, d, "tea_type_ref"), "type_id", "type_name", "aka")
    return told.filter("entry = 0").select(F.col("value").alias("product_type"), F.col("rows").alias("listings"))


def _products(spark: SparkSession, d: str) -> DataFrame:
    return checkpointed(listings.product_groups(*(table(spark, d, t) for t in ("white2tea", "producer", "vendor", "tea_type_ref"))))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return listings.listing_pairs(_products(spark, d))


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    """One row per listing with its product and the number of listings of that product."""
    groups = _products(spark, d)
    return groups.join(groups.groupBy("product").agg(F.count(F.lit(1)).alias("listings")), "product").select("payload_id", "product", "listings")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_column(table(spark, d, "documents"), "doc_id", "text")


def _sized_documents(spark: SparkSession, d: str) -> DataFrame:
    """Token counts, written once: each of the mixing passes then reads three narrow columns."""
    return checkpointed(bpe.encode_column(table(spark, d, "documents"), "doc_id", "text", ["source"], ids=None, count="tokens"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_sized_documents(spark, d), table(spark, d, "mix_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_target")
    return mixing.shares(mixing.mix(_sized_documents(spark, d), targets), targets)


def _identified(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return language.identify(docs, "doc_id", "text", language.fit(docs, "doc_id", "text", "lang"), ["lang"])


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return language.wrong_labels(_identified(spark, d), "doc_id", "lang").select("doc_id", "lang")


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every segment of every document with its language and confidence."""
    return _identified(spark, d).select("doc_id", F.inline("segments"))


QUERIES = {f.__name__: f for f in (p1_found, p1_clean, p3_found, p3_entities, p4_found, p4_misses, p7_found, p7_groups, p8_ids, p9_mix, p9_shares, p10_found, p10_segments)}

ORACLE: dict[str, str] = {}
