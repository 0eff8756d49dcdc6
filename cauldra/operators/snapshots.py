"""What changed between full snapshots, by content-defined chunks.

Each snapshot is sorted by key inside cells (a cell is a hash range of keys, so no seller, however
large, is one task) and cut into chunks wherever a key's fingerprint meets a mask: the cuts depend on
keys alone, so an unchanged stretch of keys gives the same chunk in the next snapshot. A chunk carries
its digest and its rows. Chunks whose digest equals that of the same chunk in the neighbouring
snapshot are discarded; only rows of unmatched chunks are compared key by key.

Everything after the first two exchanges (one that pre-aggregates repeated rows, one by cell) runs in
the same partitioning: chunking, digests, matching and comparison need no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: One key in so many starts a chunk.
CHUNK_ROWS = 64
#: Rows of all snapshots that one cell is sized for.
CELL_ROWS = 20_000


def cell_count(rows: int, cell_rows: int = CELL_ROWS) -> int:
    """Cells per group of snapshots: a power of two, from the number of rows."""
    n = 1
    while n * cell_rows < rows:
        n *= 2
    return n


def latest_per_item(df: DataFrame, group: list[str], order: list[Column], content: list[Column]) -> DataFrame:
    """One row per item and snapshot: the contents of the row that comes last by ``order``.

    Aggregates before the shuffle, so an item delivered any number of times in a run moves once per
    map task.
    """
    return df.groupBy(*group).agg(F.max_by(F.struct(*content), F.struct(*order)).alias("content"))


def snapshot_changes(rows: DataFrame, cells: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Changes between consecutive snapshots.

    ``rows``: (layer, source, item_key, ord, last_ord, content), at most one row per item and ord.
    ``ord`` counts a source's snapshots from 1 to ``last_ord`` (constant per layer and source, so that
    empty snapshots count too). Result: (layer, source, item_key, ord, change), ord being that of the
    later snapshot; the first snapshot gives no rows. Contents compare null-safe: null is a value.
    Null keys form one item. An empty input gives an empty result.
    """
    cell = F.pmod(F.xxhash64("item_key"), F.lit(cells))
    r = rows.withColumn("cell", cell).repartition("layer", "source", "cell")
    group = ["layer", "source", "cell", "ord"]
    starts = F.pmod(F.xxhash64(F.lit("cut"), F.col("item_key")), F.lit(chunk_rows)) == 0
    in_key_order = Window.partitionBy(*group).orderBy(F.col("item_key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    # The chunk is named by its first key; rows before the first cut belong to the chunk of no name.
    r = r.withColumn("chunk", F.last(F.when(starts, F.col("item_key")), ignorenulls=True).over(in_key_order))

    mark = F.xxhash64("item_key", "content")
    other = F.xxhash64(F.lit("second"), F.col("content"), F.col("item_key"))
    chunks = r.groupBy(*group, "chunk").agg(
        F.max("last_ord").alias("last_ord"),
        F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("a"), F.bit_xor(other).alias("b")).alias("digest"),
        F.collect_list(F.struct("item_key", "content")).alias("entries"),
    )
    along = Window.partitionBy("layer", "source", "cell", "chunk").orderBy("ord")
    near = F.struct("ord", "digest")
    chunks = chunks.withColumn("_prev", F.lag(near).over(along)).withColumn("_next", F.lead(near).over(along))

    def matched(side: str, step: int) -> Column:
        return F.coalesce((F.col(f"{side}.ord") == F.col("ord") + step) & (F.col(f"{side}.digest") == F.col("digest")), F.lit(False))

    # A chunk takes part in two comparisons: as the later side at ord, as the earlier side at ord + 1.
    pairs = F.array_compact(
        F.array(
            F.when((F.col("ord") > 1) & ~matched("_prev", -1), F.struct(F.col("ord").alias("pair"), F.lit(True).alias("later"))),
            F.when((F.col("ord") < F.col("last_ord")) & ~matched("_next", 1), F.struct((F.col("ord") + 1).alias("pair"), F.lit(False).alias("later"))),
        )
    )
    left = chunks.withColumn("_pairs", pairs).filter(F.size("_pairs") > 0)
    sides = left.select("layer", "source", "cell", F.inline("_pairs"), "entries").select("layer", "source", "cell", "pair", "later", F.inline("entries"))
    compared = sides.groupBy("layer", "source", "cell", "pair", "item_key").agg(
        F.max("later").alias("after"),
        F.max(~F.col("later")).alias("before"),
        F.max(F.when(F.col("later"), F.struct("content"))).alias("new"),
        F.max(F.when(~F.col("later"), F.struct("content"))).alias("old"),
    )
    change = F.when(~F.col("before"), "added").when(~F.col("after"), "removed").when(~F.col("new").eqNullSafe(F.col("old")), "changed")
    return compared.withColumn("change", change).filter("change is not null").select("layer", "source", "item_key", F.col("pair").alias("ord"), "change")


def successful_runs(scrape_run: DataFrame) -> DataFrame:
    """(source, run_id, started_at, finished_at, ord, last_ord) of the full deliveries, ord by
    started_at (run_id on ties). The run ledger is small next to the snapshots; the window is over one
    source's runs."""
    ok = scrape_run.filter(F.col("status") == "success").select("source", "run_id", "started_at", "finished_at")
    by = Window.partitionBy("source")
    return ok.withColumn("ord", F.row_number().over(by.orderBy("started_at", "run_id"))).withColumn("last_ord", F.count(F.lit(1)).over(by))


def bronze_rows(raw: DataFrame, runs: DataFrame) -> DataFrame:
    """Items of the raw layer per successful run. The payload itself is never read: its hash stands
    for it, in whatever case it was written."""
    rows = raw.select("run_id", F.col("external_id").alias("item_key"), "scraped_at", "snapshot_id", F.lower("payload_hash").alias("h"))
    rows = rows.join(runs.select("run_id", "source", "ord", "last_ord"), "run_id")
    out = latest_per_item(rows, ["source", "item_key", "ord", "last_ord"], [F.col("scraped_at"), F.col("snapshot_id")], [F.col("h")])
    return out.select(F.lit("bronze").alias("layer"), "source", "item_key", "ord", "last_ord", F.unhex("content.h").alias("content"))


def silver_rows(snap: DataFrame, vendor_product: DataFrame, vendor: DataFrame, runs: DataFrame) -> DataFrame:
    """Items of the normalised layer per successful run: a row belongs to the run of its vendor's
    source whose interval holds it. The interval join is an equi join on (source, hour), so that a
    large source spreads over its hours; runs last hours at most."""
    sellers = vendor_product.select("vendor_product_id", "vendor_id").join(vendor.select("vendor_id", F.col("source_key").alias("source")), "vendor_id").select("vendor_product_id", "source")
    rows = snap.select("vendor_product_id", "scraped_at", "snapshot_id", "price_cents", "available").join(sellers, "vendor_product_id")
    hours = F.explode(F.sequence(F.date_trunc("hour", "started_at"), F.date_trunc("hour", "finished_at"), F.expr("interval 1 hour")))
    spans = runs.filter("finished_at >= started_at").withColumn("hour", hours)
    rows = rows.withColumn("hour", F.date_trunc("hour", "scraped_at")).join(spans, ["source", "hour"]).filter(F.col("scraped_at").between(F.col("started_at"), F.col("finished_at")))
    out = latest_per_item(rows, ["source", "vendor_product_id", "ord", "last_ord"], [F.col("scraped_at"), F.col("snapshot_id")], [F.col("price_cents"), F.col("available")])
    content = F.to_binary(F.to_json("content", {"ignoreNullFields": "false"}), F.lit("utf-8"))
    return out.select(F.lit("silver").alias("layer"), "source", F.col("vendor_product_id").cast("string").alias("item_key"), "ord", "last_ord", content.alias("content"))


def catalog_changes(raw: DataFrame, snap: DataFrame, vendor_product: DataFrame, vendor: DataFrame, scrape_run: DataFrame, chunk_rows: int = CHUNK_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(layer, source, item_key, run_id, change) of both layers, run_id being the later delivery's.

    The number of cells comes from the row counts in the Parquet footers, at any size of input.
    """
    runs = successful_runs(scrape_run)
    rows = bronze_rows(raw, runs).unionByName(silver_rows(snap, vendor_product, vendor, runs))
    cells = cell_count(raw.count() + snap.count(), cell_rows)
    changes = snapshot_changes(rows, cells, chunk_rows)
    return changes.join(runs.select("source", "ord", "run_id"), ["source", "ord"]).select("layer", "source", "item_key", "run_id", "change")
