"""Latest state and recency classes of entities that are observed over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the last by ``order``. As an aggregate it combines before the shuffle, so a key
    with a third of all rows is no hot partition; null orders come first."""
    others = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in others])


def recency_classes(observed: DataFrame, entities: DataFrame, as_of: Column, key: str, at: str, flag: str, tie: str, months: int = 24) -> DataFrame:
    """(key, class) of every entity: A if its latest observation has the flag, B if any flagged one
    lies within ``months`` before ``as_of`` (inclusive), else C, also without observations.

    Of observations at one time the flagged one is the latest, then the larger ``tie``. One aggregate
    gives both the latest state and the last flagged time.
    """
    flagged = F.coalesce(F.col(flag), F.lit(False))
    seen = observed.groupBy(key).agg(F.max(F.struct(F.col(at), flagged.alias("f"), F.col(tie))).alias("_last"), F.max(F.when(flagged, F.col(at))).alias("_flagged"))
    out = entities.select(key).distinct().join(seen, key, "left")
    since = as_of - F.make_interval(months=F.lit(months))
    kind = F.when(F.coalesce("_last.f", F.lit(False)), "A").when(F.col("_flagged") >= since, "B").otherwise("C")
    return out.select(key, kind.alias("class"))
