"""Queries of the general data-processing operators over the catalogue tables, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested, snapshots, units
from ..session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.child_keys(table(spark, d, "white2tea"))


def p2_variants(spark: SparkSession, d: str) -> DataFrame:
    """The variant table: one row per array element, in order, with its listing's key."""
    t = nested.flatten_table(table(spark, d, "white2tea"), nested.ROOT_KEYS, nested.CATALOG_TABLES["variant"])
    return t.select("external_id", "run_id", "record_index", "variant_pos", "variant_id", "option1", "price", "available")


def p2_image_variants(spark: SparkSession, d: str) -> DataFrame:
    """Two levels down: which variants an image shows, with both ancestors' keys."""
    t = nested.flatten_table(table(spark, d, "white2tea"), nested.ROOT_KEYS, nested.CATALOG_TABLES["image_variant"])
    return t.select("external_id", "run_id", "record_index", "image_pos", "image_id", "link_pos", "variant_id")


def p2_option_values(spark: SparkSession, d: str) -> DataFrame:
    t = nested.flatten_table(table(spark, d, "white2tea"), nested.ROOT_KEYS, nested.CATALOG_TABLES["option_value"])
    return t.select("external_id", "run_id", "record_index", "option_pos", "option_name", "value_pos", "value")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.catalog_changes(*(table(spark, d, t) for t in ("raw_product_snapshot", "product_snapshot", "vendor_product", "vendor", "scrape_run")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return units.variant_quantities(table(spark, d, "white2tea")).select("variant_id", "amount", "unit")


def p6_flagged(spark: SparkSession, d: str) -> DataFrame:
    """Variants whose unit combination is not the only one that fits."""
    return units.variant_quantities(table(spark, d, "white2tea")).filter(~F.col("is_unique"))


QUERIES = {f.__name__: f for f in (p2_found, p2_variants, p2_image_variants, p2_option_values, p5_found, p6_found, p6_flagged)}

_RECORDS = "SELECT ingest_meta.external_id AS external_id, ingest_meta.run_id AS run_id, ingest_meta.record_index AS record_index, payload FROM white2tea"

ORACLE = {
    "p2_found": """
        WITH kids AS (
            SELECT external_id, 'variant' AS child, CAST(x.id AS VARCHAR) AS child_key
            FROM (SELECT ingest_meta.external_id AS external_id, unnest(payload.variants) AS x FROM white2tea) WHERE x.id IS NOT NULL
            UNION SELECT external_id, 'image', CAST(x.id AS VARCHAR)
            FROM (SELECT ingest_meta.external_id AS external_id, unnest(payload.images) AS x FROM white2tea) WHERE x.id IS NOT NULL
            UNION SELECT external_id, 'tag', trim(x, ' ')
            FROM (SELECT ingest_meta.external_id AS external_id, unnest(payload.tags) AS x FROM white2tea) WHERE trim(x, ' ') <> '')
        SELECT * FROM kids
        UNION SELECT ingest_meta.external_id, 'none', '' FROM white2tea WHERE ingest_meta.external_id NOT IN (SELECT external_id FROM kids)""",
    "p2_variants": f"""
        SELECT external_id, run_id, record_index, CAST(i - 1 AS INTEGER) AS variant_pos, v.id AS variant_id, v.option1 AS option1, v.price AS price, v.available AS available
        FROM (SELECT external_id, run_id, record_index, unnest(payload.variants) AS v, generate_subscripts(payload.variants, 1) AS i FROM ({_RECORDS}))""",
    "p2_image_variants": f"""
        SELECT external_id, run_id, record_index, CAST(i - 1 AS INTEGER) AS image_pos, m.id AS image_id, CAST(j - 1 AS INTEGER) AS link_pos, variant_id
        FROM (SELECT external_id, run_id, record_index, i, m, unnest(m.variant_ids) AS variant_id, generate_subscripts(m.variant_ids, 1) AS j
              FROM (SELECT external_id, run_id, record_index, unnest(payload.images) AS m, generate_subscripts(payload.images, 1) AS i FROM ({_RECORDS})))""",
    "p2_option_values": f"""
        SELECT external_id, run_id, record_index, CAST(i - 1 AS INTEGER) AS option_pos, o.name AS option_name, CAST(j - 1 AS INTEGER) AS value_pos, value
        FROM (SELECT external_id, run_id, record_index, i, o, unnest(o."values") AS value, generate_subscripts(o."values", 1) AS j
              FROM (SELECT external_id, run_id, record_index, unnest(payload.options) AS o, generate_subscripts(payload.options, 1) AS i FROM ({_RECORDS})))""",
    "p5_found": """
        WITH runs AS (
            SELECT source, run_id, started_at, finished_at, row_number() OVER (PARTITION BY source ORDER BY started_at, run_id) AS ord,
                   count(*) OVER (PARTITION BY source) AS last_ord
            FROM scrape_run WHERE status = 'success'),
        every AS (
            SELECT 'bronze' AS layer, u.source, r.external_id AS item_key, u.ord, u.last_ord, r.scraped_at, r.snapshot_id, lower(r.payload_hash) AS content
            FROM raw_product_snapshot r JOIN runs u ON r.run_id = u.run_id
            UNION ALL
            SELECT 'silver', u.source, CAST(s.vendor_product_id AS VARCHAR), u.ord, u.last_ord, s.scraped_at, s.snapshot_id,
                   coalesce(CAST(s.price_cents AS VARCHAR), 'none') || '/' || coalesce(CAST(s.available AS VARCHAR), 'none')
            FROM product_snapshot s JOIN vendor_product p USING (vendor_product_id) JOIN vendor v USING (vendor_id)
            JOIN runs u ON u.source = v.source_key AND s.scraped_at BETWEEN u.started_at AND u.finished_at),
        items AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY layer, source, item_key, ord ORDER BY scraped_at DESC, snapshot_id DESC) AS n FROM every) WHERE n = 1),
        changes AS (
            SELECT b.layer, b.source, b.item_key, b.ord, CASE WHEN a.ord IS NULL THEN 'added' ELSE 'changed' END AS change
            FROM items b LEFT JOIN items a ON a.layer = b.layer AND a.source = b.source AND a.item_key = b.item_key AND a.ord = b.ord - 1
            WHERE b.ord > 1 AND (a.ord IS NULL OR a.content IS DISTINCT FROM b.content)
            UNION ALL
            SELECT a.layer, a.source, a.item_key, a.ord + 1, 'removed'
            FROM items a LEFT JOIN items b ON a.layer = b.layer AND a.source = b.source AND a.item_key = b.item_key AND b.ord = a.ord + 1
            WHERE a.ord < a.last_ord AND b.ord IS NULL)
        SELECT c.layer, c.source, c.item_key, u.run_id, c.change FROM changes c JOIN runs u ON u.source = c.source AND u.ord = c.ord""",
}
