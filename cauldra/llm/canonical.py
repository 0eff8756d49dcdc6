"""Freely typed values to the closest entry of a reference list.

A symmetric-delete dictionary maps every string that deleting up to two characters from a reference
name gives to that name. A value's own deletes are looked up in it, so all names within the bound are
found without comparing against the list. Candidates are ranked by a weighted Damerau-Levenshtein
distance (neighbouring keys, doubled letters, swaps and separators cost less), then by how often the
entry is written exactly, then by id. Values without a candidate are misses.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Reference names (with other accepted names) for which the dictionary is broadcast; a longer list
#: is looked up by a join on deletes instead.
BROADCAST_NAMES = 20_000
MAX_EDITS = 2
CACHED_VALUES = 100_000

#: Words that shops put before a category and that say nothing about it.
DRESSING = frozenset("premium organic fine loose our best the new all fresh quality finest shop products product tea-shop".split())

_KEYS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
_AT = {c: (y, x + y * 0.5) for y, row in enumerate(_KEYS) for x, c in enumerate(row)}


def spaced(value: str) -> str:
    """Lower case without accents, separators as single spaces."""
    t = unicodedata.normalize("NFKD", value).lower()
    t = "".join(c for c in t if not unicodedata.combining(c))
    return re.sub(r"[\W_]+", " ", unicodedata.normalize("NFC", t)).strip()


def readings(value: str) -> list[str]:
    """The ways a value may be meant, spaced, likeliest first: without brackets, years, numbers and
    breadcrumb; parts around a comma swapped; words of dressing off."""
    t = re.sub(r"\((?:all|\d+)\)|\[[^\]]*\]|\b(?:19|20)\d\d\b", " ", value)
    t = re.split(r"[>/|»]", t)[-1] if re.search(r"[>/|»]\s*\S", t) else t
    # Words run together with capitals are words.
    forms = [t]
    if t.count(",") == 1:
        a, b = t.split(",")
        forms = [f"{b} {a}", t]
    out = []
    for f in forms:
        words = spaced(f).split()
        bare = list(words)
        while len(bare) > 1 and bare[0] in DRESSING:
            bare = bare[1:]
        for w in (words, bare):
            if w:
                out.append(" ".join(w))
    return list(dict.fromkeys(out))


def compact(s: str) -> str:
    return s.replace(" ", "")


def edits_allowed(key: str) -> int:
    """Short names and names in Han or kana script must match exactly; others may err by length."""
    if not key.isascii() or len(key) <= 3:
        return 0
    return 1 if len(key) <= 5 else MAX_EDITS


def deletes(key: str, n: int) -> set[str]:
    """``key`` and all strings that deleting up to n of its characters gives."""
    out = last = {key}
    for _ in range(n):
        last = {k[:i] + k[i + 1 :] for k in last for i in range(len(k))}
        out = out | last
    return out


def _swap_cost(a: str, b: str) -> float:
    if a in _AT and b in _AT and abs(_AT[a][0] - _AT[b][0]) <= 1 and abs(_AT[a][1] - _AT[b][1]) <= 1:
        return 0.8
    return 1.0


def _gap_cost(s: str, i: int) -> float:
    """Of leaving out or adding s[i]."""
    if s[i] == " ":
        return 0.15
    if (i and s[i - 1] == s[i]) or (i + 1 < len(s) and s[i + 1] == s[i]):
        return 0.6
    return 0.7 if s[i] == "s" and i == len(s) - 1 else 1.0


def weighted_distance(a: str, b: str) -> float:
    """Damerau-Levenshtein distance (adjacent swaps) with weights."""
    rows = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for j in range(1, len(b) + 1):
        rows[0][j] = rows[0][j - 1] + _gap_cost(b, j - 1)
    for i in range(1, len(a) + 1):
        rows[i][0] = rows[i - 1][0] + _gap_cost(a, i - 1)
        for j in range(1, len(b) + 1):
            x, y = a[i - 1], b[j - 1]
            best = min(
                rows[i - 1][j - 1] + (0.0 if x == y else _swap_cost(x, y)),
                rows[i - 1][j] + _gap_cost(a, i - 1),
                rows[i][j - 1] + _gap_cost(b, j - 1),
            )
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[i - 2][j - 2] + 0.8)
            rows[i][j] = best
    return rows[-1][-1]


def edits(a: str, b: str) -> int:
    """Damerau-Levenshtein distance, all weights 1."""
    start, end = 0, 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j - 1] + (x != y), one[j] + 1, now[-1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            now.append(d)
        two, one = one, now
    return one[-1]


class Reference:
    """The dictionary: names (entry id, spaced name), how often each entry occurs, and the deletes."""

    def __init__(self, names: list[tuple[int, str]], frequency: dict[int, int] | None = None):
        self.names = sorted({(i, s) for i, n in names if n and (s := spaced(n))})
        self.frequency = frequency or {}
        #: No longer value can be within the bound of a name.
        self.longest = max((len(compact(s)) for _, s in self.names), default=0) + MAX_EDITS
        self.by_delete: dict[str, list[int]] = {}
        for at, (_, s) in enumerate(self.names):
            for x in deletes(compact(s), edits_allowed(compact(s))):
                self.by_delete.setdefault(x, []).append(at)

    def exact(self, value: str) -> int | None:
        for r in readings(value):
            key = compact(r)
            for at in () if len(key) > self.longest else self.by_delete.get(key, ()):
                if compact(self.names[at][1]) == key:
                    return self.names[at][0]
        return None

    def rank(self, reading: str, candidates) -> tuple | None:
        """(weighted distance, -frequency, entry) of the best of some (entry, spaced name)."""
        key, best = compact(reading), None
        for entry, s in candidates:
            other = compact(s)
            # The plural of a name is no error.
            d = 0 if key == other + "s" else edits(key, other)
            if d <= min(edits_allowed(key), edits_allowed(other)):
                got = (round(weighted_distance(reading, s), 6), -self.frequency.get(entry, 0), entry)
                best = got if best is None or got < best else best
        return best

    def candidates(self, reading: str) -> list[tuple[int, str]]:
        key = compact(reading)
        if len(key) > self.longest:
            return []
        found = {at for x in deletes(key, edits_allowed(key)) for at in self.by_delete.get(x, ())}
        return [self.names[at] for at in found]

    def lookup(self, value: str) -> tuple[int, float] | None:
        """(entry, weighted distance) of the closest entry; None is a miss."""
        best = [b for r in readings(value) if (b := self.rank(r, self.candidates(r)))]
        return (min(best)[2], min(best)[0]) if best else None


def _names(reference: DataFrame, entry: str, name: str, others: str | None) -> DataFrame:
    rows = reference.select(F.col(entry).cast("long").alias("entry"), F.col(name).alias("name"))
    if others:
        rows = rows.unionByName(reference.select(F.col(entry).cast("long").alias("entry"), F.explode(others).alias("name")))
    return rows.filter("name is not null").distinct()


def map_values(df: DataFrame, value: str, reference: DataFrame, entry: str, name: str, others: str | None = None, broadcast_names: int = BROADCAST_NAMES) -> DataFrame:
    """(value, entry, distance, rows) of every distinct non-blank value; entry 0 and null distance for
    misses, rows being the rows of ``df`` that hold the value.

    Null and blank values are left out; they ask for nothing. Repeated rows add to ``rows``. With an
    empty reference list everything is a miss. Values are made distinct (with counts) before any Python
    runs, so a value that a third of the rows hold is looked up once.
    """
    values = df.select(F.col(value).alias("value")).filter(F.trim(F.col("value")) != "").groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
    values = values.filter(F.regexp_replace("value", r"(?U)\s+", "") != "")
    names = _names(reference, entry, name, others)
    spark = df.sparkSession
    if names.limit(broadcast_names + 1).count() <= broadcast_names:
        listed = [(r["entry"], r["name"]) for r in names.collect()]
        counted = _exact_counts(values, listed)
        shared = spark.sparkContext.broadcast((listed, counted))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            look = lru_cache(CACHED_VALUES)(Reference(*shared.value).lookup)
            for b in batches:
                got = [look(v) or (0, None) for v in b["value"]]
                yield b.assign(entry=[g[0] for g in got], distance=[g[1] for g in got])[["value", "entry", "distance", "rows"]]

        return values.mapInPandas(run, "value string, entry long, distance double, rows long")
    return _mapped_by_join(values, names)


def _exact_counts(values: DataFrame, listed: list[tuple[int, str]]) -> dict[int, int]:
    """Rows that write each entry exactly: one number per reference entry."""
    shared = values.sparkSession.sparkContext.broadcast(listed)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ref = Reference(shared.value)
        for b in batches:
            b = b.assign(entry=[ref.exact(v) or 0 for v in b["value"]])
            yield b.groupby("entry", as_index=False)["rows"].sum()

    got = values.mapInPandas(run, "entry long, rows long").groupBy("entry").agg(F.sum("rows").alias("rows")).collect()
    return {r["entry"]: r["rows"] for r in got if r["entry"]}


def _mapped_by_join(values: DataFrame, names: DataFrame) -> DataFrame:
    """The same mapping for a long reference list: both sides' deletes meet in an equi join."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(e, s, x) for e, n in zip(b["entry"], b["name"]) if (s := spaced(n)) for x in deletes(compact(s), edits_allowed(compact(s)))]
            yield pd.DataFrame(rows, columns=["entry", "spaced", "cut"])

    def cut_values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(v, i, r, x) for v in b["value"] for i, r in enumerate(readings(v)) if len(compact(r)) <= longest for x in deletes(compact(r), edits_allowed(compact(r)))]
            yield pd.DataFrame(rows, columns=["value", "nth", "reading", "cut"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ref = Reference([])
        for b in batches:
            got = [ref.rank(r, [(e, s)]) for r, e, s in zip(b["reading"], b["entry"], b["spaced"])]
            same = [compact(r) == compact(s) for r, s in zip(b["reading"], b["spaced"])]
            out = pd.DataFrame({"value": b["value"], "nth": b["nth"], "entry": b["entry"], "distance": [g and g[0] for g in got], "same": same})
            yield out[out["distance"].notna()]

    longest = (names.agg(F.max(F.length("name")).alias("n")).first()["n"] or 0) + MAX_EDITS
    theirs = names.mapInPandas(cut, "entry long, spaced string, cut string")
    ours = values.mapInPandas(cut_values, "value string, nth int, reading string, cut string")
    pairs = ours.join(theirs, "cut").select("value", "nth", "reading", "entry", "spaced").distinct()
    scored = pairs.mapInPandas(score, "value string, nth int, entry long, distance double, same boolean")
    # As exact() has it: a value counts once, for the first entry that its first exact reading writes.
    first = scored.filter("same").groupBy("value").agg(F.min(F.struct("nth", "entry")).alias("m")).select("value", F.col("m.entry").alias("entry"))
    exact = first.join(values, "value").groupBy("entry").agg(F.sum("rows").alias("f"))
    best = scored.join(exact, "entry", "left").groupBy("value").agg(F.min(F.struct("distance", (-F.coalesce("f", F.lit(0))).alias("f"), "entry")).alias("b"))
    out = values.join(best, "value", "left")
    return out.select("value", F.coalesce("b.entry", F.lit(0).cast("long")).alias("entry"), F.col("b.distance").alias("distance"), "rows")


def latest_listings(records: DataFrame, *fields: str) -> DataFrame:
    """(payload_id, fields of payload) from the latest record of each listing; on equal scrape times
    the larger run id and record index count."""
    order = F.struct("ingest_meta.scraped_at", "ingest_meta.run_id", "ingest_meta.record_index")
    kept = F.struct(*[F.col(f"payload.{f}").alias(f) for f in fields])
    out = records.filter("payload.id is not null").groupBy(F.col("payload.id").alias("payload_id")).agg(F.max_by(kept, order).alias("_p"))
    return out.select("payload_id", *[F.col(f"_p.{f}").alias(f) for f in fields])


def listing_types(records: DataFrame, reference: DataFrame) -> DataFrame:
    """(payload_id, type_id) of every listing whose product_type is not blank; 0 for misses."""
    listings = latest_listings(records.filter(F.regexp_replace("payload.product_type", r"(?U)\s+", "") != ""), "product_type")
    told = map_values(listings, "product_type", reference, "type_id", "type_name", "aka")
    return listings.join(told.select(F.col("value").alias("product_type"), F.col("entry").alias("type_id")), "product_type").select("payload_id", "type_id")
