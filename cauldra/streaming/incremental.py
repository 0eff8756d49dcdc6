"""Incremental load of raw files as a stream that stops when all files there are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import bronze
from ..plans.pipeline import BRONZE, COLUMNS
from ..plans.store import Store
from ..session import checkpointed
from ..sources import raw


def load_new_files(spark: SparkSession, root: str, store: Store, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Files not read before, in batches, into the bronze table; the query ends by itself.

    Each batch does what a batch load does (validate, hash, first wins, ignore what is there), so a
    batch that is replayed after a failure adds nothing twice.
    """
    lines = (
        spark.readStream.schema(f"{raw.ENVELOPE}, source string, date string")
        .option("pathGlobFilter", "run=*.jsonl")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("basePath", root)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(f"{root}/source=*/date=*")
    )
    placed = lines.select(F.col("source").alias("source_dir"), F.col("date").try_cast("date").alias("file_date"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), "ingest_meta", "payload", "_corrupt")

    def absorb(batch: DataFrame, _: int) -> None:
        whole = F.col("_corrupt").isNull() & F.expr("schema_of_variant(payload)").startswith("OBJECT")
        for f in raw.REQUIRED:
            whole = whole & F.col(f"ingest_meta.{f}").isNotNull()
        good = batch.filter(F.col("file_date").isNotNull() & F.coalesce(whole, F.lit(False)))
        there = store.read("bronze", BRONZE)
        fresh = bronze.new_only(bronze.first_wins(bronze.hashed(good)), there)
        start = there.agg(F.coalesce(F.max("snapshot_id"), F.lit(0)).alias("m")).first()["m"]
        numbered = checkpointed(bronze.with_ids(fresh, "snapshot_id", list(bronze.ARRIVAL), start).select(*COLUMNS))
        store.append("bronze", numbered, ["source"])

    return placed.writeStream.foreachBatch(absorb).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
