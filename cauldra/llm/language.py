"""Language of documents and of the segments of mixed documents.

Multinomial naive Bayes over hashed character n-grams. The log-probability matrix (buckets x
languages, a size fixed by parameters) is fitted on a bounded sample of rows whose label names one of
the languages, refitted once on those the first fit agrees with (labels may be wrong), and broadcast.
Texts are cut into sentences; sentences are scored in sparse batches, one weighted bincount per
language.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .bpe import spread

#: What labels may call a language (lower case, without region).
NAMES = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "it": ("it", "ita", "italian", "italiano"),
    "nl": ("nl", "nld", "dut", "dutch", "nederlands"),
    "ru": ("ru", "rus", "russian", "русский"),
    "zh": ("zh", "zho", "chi", "cmn", "chinese", "中文", "汉语", "漢語", "mandarin"),
    "ja": ("ja", "jpn", "jp", "japanese", "日本語"),
}
LANGUAGES = tuple(NAMES)

#: Labelled rows that the classifier is fitted on, at most (a hash sample of the labelled rows).
FIT_ROWS = 40_000
BUCKETS = 1 << 17
GRAMS = (1, 2, 3, 4)
SMOOTHING = 0.05
#: Characters that one numpy step scores.
STEP_CHARS = 60_000
CACHED_SENTENCES = 50_000

_NOISE = re.compile(r"https?://\S+|www\.\S+|<\|[^|>]*\|>|\{\{[^}]*\}\}")
_SPACE = re.compile(r"\s+")
_SENTENCE = re.compile(r"[^\n。！？!?.…]+(?:[.](?=\S)[^\n。！？!?.…]*)*(?:[。！？]+|[!?.…]+(?=[\s\"'”’»)\]]|$)|[!?.…]+|$|(?=\n))[\"'”’»)\]]*")
_WORD = re.compile(r"[^\W\d_]+")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")


def label_language(label: Column) -> Column:
    """The two-letter code that a label names, null if it names none of LANGUAGES."""
    base = F.regexp_extract(F.lower(F.trim(label)), r"^([^-_\s]+)", 1)
    known = F.create_map(*[F.lit(x) for code, names in NAMES.items() for n in names for x in (n, code)])
    return F.try_element_at(known, base)


def _full(sentence: str) -> bool:
    body = _NOISE.sub(" ", sentence)
    words = _WORD.findall(body)
    return (len(words) >= 4 and sum(map(len, words)) >= 12) or len(_CJK.findall(body)) >= 5


_known_full = lru_cache(maxsize=CACHED_SENTENCES)(_full)


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of every full sentence: enough letters, in words, to be one. Symbols, figures,
    single words and addresses are none."""
    return [m.span() for m in _SENTENCE.finditer(text) if (_known_full if len(m[0]) <= 400 else _full)(m[0])]


def plain(text: str) -> str:
    """The sentence as it is scored: addresses and markers off, folded, digits alike, single spaces.
    Words in brackets are quotations and left out where enough other text remains."""
    t = _NOISE.sub(" ", unicodedata.normalize("NFKC", text)).lower()
    rest = re.sub(r"\([^)]*\)|“[^”]*”|«[^»]*»", " ", t)
    if len(_WORD.findall(rest)) >= 3 or len(_CJK.findall(rest)) >= 5:
        t = rest
    return " " + _SPACE.sub(" ", re.sub(r"\d", "0", t)).strip() + " "


def grams_by_size(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size of n-grams (text number, bucket) of every n-gram of the texts, in the order of the
    texts; n-grams never cross texts."""
    size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), size)
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(codes) < n:
            break
        h = (h[: len(codes) - n + 1] * np.uint64(0x100000001B3)) ^ codes[n - 1 :]
        if n in GRAMS:
            inside = owner[: len(h)] == owner[n - 1 :]
            mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
            yield owner[: len(h)][inside], ((mixed >> np.uint64(33)) % np.uint64(BUCKETS)).astype(np.int64)[inside]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram of the texts, all sizes."""
    found = list(grams_by_size(texts))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([o for o, _ in found]), np.concatenate([b for _, b in found])


class Scorer:
    """Scores sentences with a fitted matrix; remembers the sentences it saw last."""

    def __init__(self, logp: np.ndarray):
        # One row per bucket, so that an n-gram reads one row.
        self.by_bucket = np.ascontiguousarray(logp.T)
        self.known: dict[str, tuple[int, float]] = {}

    def score(self, texts: list[str]) -> list[tuple[int, float]]:
        """(language number, confidence) of each text. Confidence is the posterior, with the evidence
        of n overlapping n-grams counted as that of sqrt(n), so that long texts don't all give 1."""
        new = list(dict.fromkeys(t for t in texts if t not in self.known))
        if len(self.known) + len(new) > CACHED_SENTENCES:
            self.known = {t: self.known[t] for t in texts if t in self.known}
        at = 0
        while at < len(new):
            step, chars = at, 0
            while at < len(new) and (at == step or chars + len(new[at]) <= STEP_CHARS):
                chars += len(new[at])
                at += 1
            part = new[step:at]
            points, count = np.zeros((len(part), self.by_bucket.shape[1])), np.zeros(len(part))
            for owner, bucket in grams_by_size(part):
                if len(owner):
                    start = np.flatnonzero(np.diff(owner, prepend=-1))
                    points[owner[start]] += np.add.reduceat(self.by_bucket[bucket], start, axis=0, dtype=np.float64)
                    count += np.bincount(owner, minlength=len(part))
            soft = points / np.sqrt(np.maximum(count, 1.0))[:, None]
            soft = np.exp(soft - soft.max(axis=1, keepdims=True))
            best = points.argmax(axis=1)
            sure = soft[np.arange(len(part)), best] / soft.sum(axis=1)
            self.known.update(zip(part, zip(best.tolist(), sure.tolist())))
        return [self.known[t] for t in texts]


def _split(rows: DataFrame, text: str, label: str) -> DataFrame:
    """(own, l): the distinct plain sentences of each labelled text, and the number of its language."""
    number = {c: i for i, c in enumerate(LANGUAGES)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shown = lru_cache(maxsize=CACHED_SENTENCES)(plain)
        for b in batches:
            own = [list(dict.fromkeys(shown(t[i:j]) for i, j in sentences(t))) for t in b["t"]]
            yield pd.DataFrame({"own": own, "l": b["l"].map(number)})

    return rows.select(F.col(text).alias("t"), F.col(label).alias("l")).mapInPandas(run, "own array<string>, l int")


def _counts(split: DataFrame, logp: np.ndarray | None) -> np.ndarray:
    """n-gram counts (languages x buckets) of labelled sentences. With a matrix, only sentences count
    whose language by it is the label's. What reaches the driver is bounded by the matrix's size."""
    known = None if logp is None else split.sparkSession.sparkContext.broadcast(logp)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None if known is None else Scorer(known.value)
        total = np.zeros(len(LANGUAGES) * BUCKETS, dtype=np.int64)
        for b in batches:
            of: dict[int, list[str]] = {}
            for own, l in zip(b["own"], b["l"]):
                of.setdefault(int(l), []).extend(own)
            for l, own in of.items():
                if scorer is not None and own:
                    own = [s for s, (g, _) in zip(own, scorer.score(own)) if g == l]
                if own:
                    total[l * BUCKETS : (l + 1) * BUCKETS] += np.bincount(grams(own)[1], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"cell": seen, "n": total[seen]})

    cells = split.mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = cells.toPandas()
    out = np.zeros(len(LANGUAGES) * BUCKETS)
    out[got["cell"].to_numpy(dtype=np.int64)] = got["n"]
    if known is not None:
        known.unpersist()
    return out.reshape(len(LANGUAGES), BUCKETS)


def _matrix(counts: np.ndarray) -> np.ndarray:
    smooth = counts + SMOOTHING
    return np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)


def fit(docs: DataFrame, key: str, text: str, label: str, rows: int = FIT_ROWS) -> np.ndarray:
    """The log-probability matrix. ``rows`` bounds the labelled rows used, taken by the hash of their
    key. Rows with null text or an unknown label are no training rows; languages without any stay at
    their smoothed uniform distribution."""
    labelled = docs.select(key, text, label_language(F.col(label)).alias("_label")).filter(F.col(text).isNotNull() & F.col("_label").isNotNull())
    n = labelled.count()
    if n > rows:
        # A little below the bound, so that the sample of hashes stays within it.
        labelled = labelled.filter(F.pmod(F.xxhash64(F.lit("fit"), key), F.lit(1_000_000)) < int(980_000 * rows / n))
    # Split into sentences once, for both fits.
    split = checkpointed(_split(spread(labelled, key), text, "_label"))
    first = _matrix(_counts(split, None))
    return _matrix(_counts(split, first))


SEGMENT = "array<struct<start:int,end:int,lang:string,confidence:double>>"


def identify(docs: DataFrame, key: str, text: str, logp: np.ndarray, keep: list[str] | None = None) -> DataFrame:
    """(key, kept columns, segments): neighbouring sentences of one language make a segment, given by
    character offsets with the mean confidence of its sentences. Null, empty and sentence-less texts
    have an empty list. Rows repeat as in the input."""
    keep = [k for k in keep or [] if k != key]
    matrix = docs.sparkSession.sparkContext.broadcast(logp)
    source = docs.select(key, *keep, F.col(text).alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(matrix.value)
        shown = lru_cache(maxsize=CACHED_SENTENCES)(plain)
        for b in batches:
            spans = [sentences(t) if t else [] for t in b["_text"]]
            flat = [shown(t[i:j]) for t, own in zip(b["_text"], spans) for i, j in own]
            told = iter(scorer.score(flat))
            found = []
            for own in spans:
                segments: list[dict] = []
                for i, j in own:
                    g, sure = next(told)
                    if segments and segments[-1]["lang"] == LANGUAGES[g]:
                        s = segments[-1]
                        s["end"], s["sum"], s["n"] = j, s["sum"] + sure, s["n"] + 1
                    else:
                        segments.append({"start": i, "end": j, "lang": LANGUAGES[g], "sum": sure, "n": 1})
                found.append([{"start": s["start"], "end": s["end"], "lang": s["lang"], "confidence": s["sum"] / s["n"]} for s in segments])
            yield b.drop(columns="_text").assign(segments=found)

    return spread(source, key).mapInPandas(run, ", ".join([*fields, f"segments {SEGMENT}"]))


def wrong_labels(identified: DataFrame, key: str, label: str) -> DataFrame:
    """(key, lang, confidence) of every document whose label is missing or names a language it is not
    in, or that is in several languages; one row per language, with the mean confidence of its
    segments. Documents without any sentence are none."""
    langs = F.array_distinct(F.transform("segments", lambda s: s["lang"]))
    one = identified.withColumn("_langs", langs).withColumn("_label", label_language(F.col(label)))
    case = (F.size("_langs") > 1) | ~F.coalesce(F.array_contains("_langs", F.col("_label")), F.lit(False))

    def sure(lang: Column) -> Column:
        own = F.filter("segments", lambda s: s["lang"] == lang)
        return F.aggregate(own, F.lit(0.0), lambda a, s: a + s["confidence"]) / F.size(own)

    told = F.transform("_langs", lambda x: F.struct(x.alias("lang"), sure(x).alias("confidence")))
    return one.filter((F.size("_langs") > 0) & case).select(key, F.inline(told))
