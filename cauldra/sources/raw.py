"""Raw records: date-partitioned JSON lines, read with quarantine and written once per run."""

from __future__ import annotations

import uuid
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "ingest_meta struct<source:string,scraped_at:timestamp,run_id:string,endpoint:string,record_index:int,external_id:string>, payload variant, _corrupt string"
REQUIRED = ("source", "scraped_at", "run_id", "endpoint", "record_index", "external_id")


def scan(spark: SparkSession, root: str, since: date | None = None, source: str | None = None) -> DataFrame:
    """(source_dir, file_date, file, line fields..., ok) of every non-blank line of ``run=*.jsonl``
    under ``source=*/date=*``.

    ``since`` and ``source`` prune directories before any file is opened. The date column is read as
    text and cast, so a directory with a bad date is skipped instead of failing the read. Lines that
    are no JSON, lack a required field or whose payload is no object have ``ok`` false. A missing root
    gives no rows.
    """
    if "://" not in root and not any(Path(root).glob("source=*/date=*/run=*.jsonl")):
        return spark.createDataFrame([], f"source_dir string, file_date date, file string, {ENVELOPE}, ok boolean")
    df = spark.read.schema(f"{ENVELOPE}, source string, date string").option("pathGlobFilter", "run=*.jsonl").option("columnNameOfCorruptRecord", "_corrupt").option("mode", "PERMISSIVE").option("basePath", root).json(f"{root}/source=*/date=*")
    day = F.col("date").try_cast("date")
    df = df.filter(day.isNotNull())
    if since is not None:
        df = df.filter(day >= F.lit(since))
    if source is not None:
        df = df.filter(F.col("source") == source)
    whole = F.col("_corrupt").isNull() & (F.expr("schema_of_variant(payload)").startswith("OBJECT"))
    for f in REQUIRED:
        whole = whole & F.col(f"ingest_meta.{f}").isNotNull()
    return df.select(F.col("source").alias("source_dir"), day.alias("file_date"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), "ingest_meta", "payload", "_corrupt", F.coalesce(whole, F.lit(False)).alias("ok"))


def split(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, quarantined lines)"""
    return scanned.filter("ok"), scanned.filter("not ok")


def write(records: DataFrame, root: str) -> list[str]:
    """Appends records (ingest_meta, payload) as JSON lines that ``scan`` reads; gives the files' paths.

    A run is filed under the UTC date of its first record by index, even if it crosses midnight, in
    files ``run=<run id>.jsonl``, in the order of the index; a run too large for one task, or one that
    is there already, has further files ``run=<run id>-<n>.jsonl``. No records, no files. Files are
    written aside and renamed when all are complete.
    """
    spark = records.sparkSession
    first = records.groupBy("ingest_meta.source", "ingest_meta.run_id").agg(F.min_by("ingest_meta.scraped_at", "ingest_meta.record_index").alias("_at"))
    out = records.withColumn("source", F.col("ingest_meta.source")).withColumn("run_id", F.col("ingest_meta.run_id")).join(first, ["source", "run_id"]).withColumn("date", F.to_date("_at"))
    placed = out.repartitionByRange("source", "run_id", "ingest_meta.record_index").sortWithinPartitions("source", "date", "run_id", "ingest_meta.record_index")
    root = root.rstrip("/")
    aside = f"{root}/_writing-{uuid.uuid4().hex}"
    placed.select("source", "date", F.col("run_id").alias("run"), "ingest_meta", "payload").write.partitionBy("source", "date", "run").json(aside)

    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = []
    for f in sorted(str(x.getPath()) for x in fs.globStatus(path(f"{aside}/source=*/date=*/run=*/part-*")) or []):
        *_, source, day, run, _ = f.split("/")
        fs.mkdirs(path(f"{root}/{source}/{day}"))
        n, to = 0, f"{root}/{source}/{day}/{run}.jsonl"
        while fs.exists(path(to)) or not fs.rename(path(f), path(to)):
            n += 1
            to = f"{root}/{source}/{day}/{run}-{n}.jsonl"
            if n > 10_000:
                raise OSError(f"cannot rename {f}")
        made.append(to)
    fs.delete(path(aside), True)
    return made
