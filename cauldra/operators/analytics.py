"""Analytic operators over the catalogue: vectors, n-grams, roll-ups, pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is null, empty or zero, or lengths differ."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (size > 0), dot(a, b) / size)


def nearest(items: DataFrame, queries: DataFrame, ident: str, vector: str, k: int, candidates: Column | None = None, block_rows: int = 256) -> DataFrame:
    """(query_id, id, sim, rank): the k most similar other items of each query, exactly.

    A stated set of queries against all items. Up to 64 blocks of queries are broadcast; more are cut
    into blocks, as the items are, and every block of queries meets every block of items in a task of
    its own, both bounded. Per task only the best k of a query survive before the shuffle. ``candidates`` restricts the items (an
    availability filter, for example). Ties go to the smaller id.
    """
    import numpy as np
    import pandas as pd

    q = queries.select(F.col(ident).alias("query_id"), F.col(vector).alias("qv")).filter("qv is not null")
    pool = (items if candidates is None else items.filter(candidates)).select(ident, vector).filter(F.col(vector).isNotNull())
    listed = q.toPandas() if q.limit(block_rows * 64 + 1).count() <= block_rows * 64 else None
    if listed is not None:
        # Bounded: at most 64 blocks of query vectors reach the driver and are broadcast.
        shared = items.sparkSession.sparkContext.broadcast((listed["query_id"].to_numpy(), np.stack(listed["qv"].to_numpy()) if len(listed) else np.zeros((0, 1))))

        def best(batches):
            ids, vectors = shared.value
            norm = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
            kept = []
            for b in batches:
                if not len(b) or not len(ids):
                    continue
                m = np.stack(b[vector].to_numpy()).astype(float)
                n = np.sqrt((m**2).sum(axis=1))
                own = b[ident].to_numpy()
                for at in range(0, len(ids), block_rows):
                    with np.errstate(invalid="ignore", divide="ignore"):
                        s = (vectors[at : at + block_rows].astype(float) @ m.T) / (norm[at : at + block_rows, None] * n[None, :])
                    for row, i in zip(s, ids[at : at + block_rows]):
                        row = np.where((own == i) | ~np.isfinite(row), -np.inf, row)
                        top = np.lexsort((own, -row))[:k]
                        top = top[np.isfinite(row[top])]
                        kept.append(pd.DataFrame({"query_id": i, ident: own[top], "sim": row[top]}))
                if len(kept) > 4 * len(ids):
                    kept = [pd.concat(kept).sort_values(["query_id", "sim", ident], ascending=[True, False, True]).groupby("query_id").head(k)]
            if kept:
                yield pd.concat(kept).sort_values(["query_id", "sim", ident], ascending=[True, False, True]).groupby("query_id").head(k)

        kind = items.schema[ident].dataType.simpleString()
        near = pool.mapInPandas(best, f"query_id {kind}, `{ident}` {kind}, sim double")
    else:
        near = _nearest_by_blocks(pool, q, ident, vector, k)
    from pyspark.sql import Window

    w = Window.partitionBy("query_id").orderBy(F.col("sim").desc(), F.col(ident))
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


#: Rows of a block of items, and of queries, that one task multiplies.
ITEM_BLOCK, QUERY_BLOCK = 50_000, 4_096


def _nearest_by_blocks(pool: DataFrame, q: DataFrame, ident: str, vector: str, k: int, item_block: int = ITEM_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The best k items of each query and block of items, by (block of queries, block of items)."""
    import numpy as np
    import pandas as pd

    items, queries = max(1, -(-pool.count() // item_block)), max(1, -(-q.count() // query_block))
    kind = pool.schema[ident].dataType.simpleString()
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    i = pool.withColumn("_i", F.pmod(F.xxhash64(ident), F.lit(items)).cast("int")).withColumn("_q", blocks(queries))
    j = q.withColumn("_q", F.pmod(F.xxhash64("query_id"), F.lit(queries)).cast("int")).withColumn("_i", blocks(items))

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            m, v = np.stack(a[vector].to_numpy()).astype(float), np.stack(b["qv"].to_numpy()).astype(float)
            own = a[ident].to_numpy()
            with np.errstate(invalid="ignore", divide="ignore"):
                m, v = m / np.linalg.norm(m, axis=1)[:, None], v / np.linalg.norm(v, axis=1)[:, None]
            for at in range(0, len(v), 256):
                for row, x in zip(v[at : at + 256] @ m.T, b["query_id"].to_numpy()[at : at + 256]):
                    row = np.where((own == x) | ~np.isfinite(row), -np.inf, row)
                    top = np.lexsort((own, -row))[:k]
                    top = top[np.isfinite(row[top])]
                    out.append(pd.DataFrame({"query_id": x, ident: own[top], "sim": row[top]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], ident: [], "sim": []})

    return i.groupBy("_q", "_i").cogroup(j.groupBy("_q", "_i")).applyInPandas(best, f"query_id {kind}, `{ident}` {kind}, sim double")


def ngram_counts(docs: DataFrame, text: str, n: int, by: list[str] | None = None) -> DataFrame:
    """(by columns, ngram, n) of word n-grams in lower case; counts combine before the shuffle."""
    words = F.filter(F.split(F.lower(text), r"(?U)[^\p{L}\p{N}]+"), lambda w: w != "")
    # The words are bound once as a lambda's variable; inlined, they would be split anew per n-gram.
    listed = F.transform(F.array(words), lambda w: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.concat_ws(" ", F.slice(w, i, F.lit(n))))))
    grams = F.get(listed, 0)
    return docs.select(*(by or []), F.explode(grams).alias("ngram")).groupBy(*(by or []), "ngram").agg(F.count(F.lit(1)).alias("n"))


def keyword_in_context(docs: DataFrame, key: str, text: str, word: str, width: int = 30) -> DataFrame:
    """(key, position, left, right) of every occurrence of a word, with the text around it."""
    pieces = F.split(F.lower(text), rf"(?U)\b{word}\b", -1)
    hits = docs.select(key, F.lower(text).alias("_t"), F.posexplode(F.when(F.size(pieces) > 1, F.slice(pieces, 1, F.size(pieces) - 1))).alias("position", "_before"), pieces.alias("_p"))
    return hits.select(key, "position", F.right("_before", F.lit(width)).alias("left"), F.left(F.get("_p", F.col("position") + 1), F.lit(width)).alias("right"))


def axis_deltas(a: Column, b: Column, over: float = 2.0) -> Column:
    """array<struct<axis,delta,flagged>> of two maps of scores, over the axes both have."""
    axes = F.array_sort(F.array_intersect(F.map_keys(a), F.map_keys(b)))
    delta = lambda x: F.element_at(a, x) - F.element_at(b, x)
    return F.transform(axes, lambda x: F.struct(x.alias("axis"), delta(x).alias("delta"), (F.abs(delta(x)) > over).alias("flagged")))
