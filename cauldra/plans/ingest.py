"""Ingest runs: one run of the ledger per source, each filed as raw JSON lines."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed
from ..sources import raw, reviews
from ..sources.config import Config
from ..sources.pages import CatalogSource
from .runs import Ledger, Run

COLUMNS = "source string, scraped_at timestamp, run_id string, endpoint string, record_index int, external_id string, payload string"
#: The name that the site of reviews goes by among the sources.
REVIEWS = "reviews"


def read_source(spark: SparkSession, config: Config, name: str, run: Run, limit: int | None = None) -> DataFrame:
    """The raw records of one source, by COLUMNS. A shop's pages are read by an executor; the walk over
    reviews is one chain of requests at the pace that its site asks for, and bounded by its limits."""
    if name == REVIEWS:
        return spark.createDataFrame(list(reviews.records(config.reviews, run.run_id, limit)), COLUMNS)
    shop = config.shops[name]
    spark.dataSource.register(CatalogSource)
    return spark.read.format("catalog_pages").options(shops=json.dumps({name: shop.base_url}), run_id=run.run_id, rate=str(shop.rate)).load()


def enveloped(rows: DataFrame) -> DataFrame:
    """Rows by COLUMNS as raw records (ingest_meta, payload)."""
    meta = [c for c in rows.columns if c != "payload"]
    return rows.select(F.struct(*meta).alias("ingest_meta"), F.parse_json("payload").alias("payload"))


def ingest(spark: SparkSession, config: Config, names: list[str] | None, root: str, ledger: Ledger, mode: str = "full", read: Callable[..., DataFrame] = read_source) -> dict[str, str]:
    """Status per source. A source that fails leaves the others alone; unknown names fail at once.
    ``mode`` is noted in the ledger, and all of a source is read in either."""
    known = [*config.shops, *([REVIEWS] if config.reviews else [])]
    if odd := set(names or ()) - set(known):
        raise ValueError(f"unknown sources {sorted(odd)}")
    done = {}
    for name in names or known:
        try:
            with ledger.run(name, mode) as run:
                # Read once: it is both counted and written.
                rows = checkpointed(read(spark, config, name, run))
                run.records_count = rows.count()
                raw.write(enveloped(rows), root)
            done[name] = run.status
        except Exception:  # noqa: BLE001 - the ledger has it
            done[name] = "failed"
    return done
