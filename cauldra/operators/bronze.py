"""The deduplicated raw layer: first delivery of each content wins, later ones are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import payload_hash

KEY = ("source", "external_id", "payload_hash")


def hashed(records: DataFrame) -> DataFrame:
    """Bronze rows of scanned records, not yet deduplicated; the payload is kept as canonical JSON."""
    text = F.to_json("payload")
    return records.select(
        F.col("ingest_meta.source").alias("source"),
        F.col("ingest_meta.external_id").alias("external_id"),
        F.col("ingest_meta.scraped_at").alias("scraped_at"),
        F.col("ingest_meta.run_id").alias("run_id"),
        text.alias("payload"),
        payload_hash(text).alias("payload_hash"),
        "file_date",
        "source_dir",
        "file",
        "block",
        F.col("ingest_meta.record_index").alias("record_index"),
    )


#: The order of arrival within a load.
ARRIVAL = ("file_date", "source_dir", "file", "block", "record_index")


def first_wins(rows: DataFrame, key: tuple[str, ...] | list[str] = KEY, order: list[Column] | None = None) -> DataFrame:
    """One row per key, the first by ``order``. Aggregates before the shuffle, so a key that is
    delivered over and over moves once per map task. Null keys are equal to each other."""
    order = order or [F.col(c) for c in ARRIVAL]
    others = [c for c in rows.columns if c not in key]
    kept = rows.groupBy(*key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return kept.select(*key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*rows.columns)


def consecutive(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows whose content differs from the item's previous one: unlike ``first_wins``, a return to an
    earlier content is kept."""
    w = Window.partitionBy("source", "external_id").orderBy(*order)
    before = F.lag(F.struct("payload_hash")).over(w)
    return rows.withColumn("_before", before).filter(F.col("_before").isNull() | ~F.struct("payload_hash").eqNullSafe(F.col("_before"))).drop("_before")


def new_only(incoming: DataFrame, existing: DataFrame, key: tuple[str, ...] | list[str] = KEY) -> DataFrame:
    """Rows whose key is not there yet (insert, or else ignore). Null-safe on every key."""
    there = existing.select(*[F.col(k).alias(f"_{k}") for k in key])
    same = None
    for k in key:
        c = incoming[k].eqNullSafe(there[f"_{k}"])
        same = c if same is None else same & c
    return incoming.join(there, same, "left_anti")


def with_ids(rows: DataFrame, name: str, order: list[str], start: int = 0) -> DataFrame:
    """Rows with ever-increasing ids from ``start`` + 1 in a total order.

    A range sort, one count per partition and an offset each: no single task sees all rows. The sorted
    rows are checkpointed, since range bounds come from a sample and must not be drawn twice.
    """
    from ..session import checkpointed

    placed = checkpointed(rows.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_at"))
    out = placed.join(counts.select("_part", before.alias("_before")), "_part").withColumn(name, F.lit(start) + F.col("_before") + within)
    return out.drop("_part", "_at", "_before")


def load_counters(scanned: DataFrame, inserted: DataFrame) -> DataFrame:
    """(source, lines, records, errors, inserted, skipped) per source directory."""
    read = scanned.groupBy(F.col("source_dir").alias("source")).agg(F.count(F.lit(1)).alias("lines"), F.count_if("ok").alias("records"), F.count_if(~F.col("ok")).alias("errors"))
    new = inserted.groupBy("source").agg(F.count(F.lit(1)).alias("inserted"))
    out = read.join(new, "source", "left").na.fill(0, ["inserted"])
    return out.withColumn("skipped", F.col("records") - F.col("inserted"))
