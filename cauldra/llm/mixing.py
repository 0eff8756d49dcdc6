"""Mixing sources to target shares of the total size.

Each document gets a hash-random key. Within a source documents are ordered by that key, the running
sum of their sizes is taken, and the order is cut where the source's budget ends; a budget larger than
the source repeats it in whole epochs first. The running sum is distributed: keys fall into ranges of
equal width, the sums of the ranges (a table of bounded size) are accumulated first, and each range
then accumulates its own rows from its offset, so a source of any size spreads over its ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one range of keys is sized for.
RANGE_ROWS = 50_000


def budgets(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available, budget) per target source.

    ``sizes``: (source, available). With no ``total`` the largest total is taken that every source can
    fill within its cap. A source without documents, or with a share of null or zero, gets budget 0
    and does not bind the total. A given total that a source cannot reach leaves that source at its
    cap. Targets are the sources asked for: few rows, whatever the corpus.
    """
    t = targets.join(sizes, "source", "left").withColumn("available", F.coalesce("available", F.lit(0).cast("long"))).withColumn("_cap", F.col("available") * F.greatest(F.col("max_repeats"), F.lit(0)))
    whole = Window.partitionBy(F.lit(0))
    possible = F.min(F.when((F.col("target_share") > 0) & (F.col("_cap") > 0), F.col("_cap") / F.col("target_share"))).over(whole)
    size = F.lit(float(total)) if total is not None else F.coalesce(possible, F.lit(0.0))
    # A cap met exactly must not lose a token to rounding.
    wanted = F.floor(F.coalesce(F.col("target_share"), F.lit(0.0)) * size + 1e-6)
    return t.withColumn("budget", F.least(wanted, F.col("_cap")).cast("long")).select("source", "target_share", "max_repeats", "available", "budget")


def running_sums(docs: DataFrame, ranges: int) -> DataFrame:
    """``docs`` (doc_id, source, tokens) with ``before``: the sum of tokens that come earlier in the
    source's random order (hash of doc_id, then doc_id)."""
    keyed = docs.withColumn("_key", F.xxhash64(F.lit("mix"), "doc_id"))
    width = 2**64 / ranges
    keyed = keyed.withColumn("_range", F.floor((F.col("_key").cast("double") + 2.0**63) / width).cast("int"))
    sums = keyed.groupBy("source", "_range").agg(F.sum("tokens").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("source", "_range").orderBy("_key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    out = keyed.join(offsets, ["source", "_range"]).withColumn("before", F.col("_offset") + F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    return out.drop("_key", "_range", "_sum", "_offset")


def mix(docs: DataFrame, targets: DataFrame, total: int | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, source, tokens, repeats) of every selected document, repeats from 1 to max_repeats.

    ``docs``: (doc_id, source, tokens), doc_id unique; read three times, so it should be a written
    or cached table. The document that a cut goes through is taken when at least half of it lies
    before the cut, unless that would pass its cap. Documents of sources that are not targets, of
    size 0 or null, and with null source are not selected. Empty inputs give an empty selection.
    """
    docs = docs.filter("tokens > 0").select("doc_id", "source", "tokens")
    plan = budgets(docs.groupBy("source").agg(F.sum("tokens").alias("available")), targets.select("source", "target_share", "max_repeats"), total)
    ranges = max(1, -(-docs.count() // range_rows))
    epochs, rest = F.floor(F.col("budget") / F.col("available")), F.col("budget") % F.col("available")
    taken = F.col("before") + F.col("tokens") / 2 <= F.col("_rest")
    rows = running_sums(docs, ranges).join(plan.withColumn("_epochs", epochs).withColumn("_rest", rest).filter("budget > 0"), "source")
    repeats = F.least(F.col("_epochs") + F.when(taken, 1).otherwise(0), F.col("max_repeats").cast("long")).cast("int")
    return rows.withColumn("repeats", repeats).filter("repeats > 0").select("doc_id", "source", "tokens", "repeats")


def shares(selection: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, documents, most_repeats, tokens, share) for every target
    source, including those that gave nothing."""
    got = selection.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.max("repeats").alias("most_repeats"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"))
    out = targets.select("source", "target_share", "max_repeats").join(got, "source", "left").na.fill(0, ["documents", "most_repeats", "tokens"])
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    return out.withColumn("share", F.when(total > 0, F.col("tokens") / total).otherwise(0.0))
